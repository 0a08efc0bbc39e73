import hashlib
import math
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from strata_spark.llm import common, media
from strata_spark.llm.media import AudioSpec


def test_resample_is_a_convolution_of_the_zero_stuffed_signal():
    x = np.random.default_rng(0).normal(size=640)
    for spec in (AudioSpec(), AudioSpec(up=3, down=4), AudioSpec(up=2, down=1)):
        h = media.lowpass(spec)
        stuffed = np.zeros(len(x) * spec.up)
        stuffed[:: spec.up] = x
        want = np.convolve(stuffed, h)[len(h) // 2 :][:: spec.down][: len(x) * spec.up // spec.down]
        assert np.allclose(media.resample(x, spec), want)


def test_a_tone_lies_in_its_band():
    spec = AudioSpec()
    t = np.arange(spec.rate) / spec.rate
    tone = (128 + 100 * np.sin(2 * math.pi * 1000 * t)).astype(np.uint8).tobytes()
    _, mel, energy = media.log_mel([tone], spec)
    centre = 700 * (10 ** ((np.arange(spec.mels) + 1) / (spec.mels + 1) * math.log10(1 + spec.new_rate / 2 / 700)) - 1)
    assert abs(centre[np.argmax(mel[10])] - 1000) < 120 and energy[10] > -12


def test_hysteresis():
    spec = AudioSpec(open_db=-10, close_db=-20)
    got = media.segments(np.array([-30, -15, -9, -15, -19, -21, -15, -9.0]), spec)
    at = spec.hop / spec.new_rate
    assert got == [pytest.approx((2 * at, 4 * at + spec.frame / spec.new_rate)), pytest.approx((7 * at, 7 * at + spec.frame / spec.new_rate))]


def test_odd_documents(spark, odd_docs, no_docs):
    full = media.features(media.store(odd_docs))
    got = media.described(full).join(odd_docs.select("doc_id", "text").distinct(), "doc_id").collect()
    assert full.count() == odd_docs.count()
    for r in got:
        data = (r.text or "").encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(data), len(payload), zlib.crc32(payload[-64:]))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert r.media_bytes == len(payload) + 44
    assert len({r.feature for r in got if r.doc_id == 4}) == 1
    assert media.described(media.features(media.store(no_docs))).count() == 0


def test_equal_texts_equal_features_wherever_they_stand():
    spec, r = AudioSpec(), np.random.default_rng(1)
    payloads = [media.padded(r.integers(0, 256, n, np.uint8).tobytes()) for n in (64, 5000, 300, 70_000)]
    together = media.log_mel(payloads, spec)
    ends = np.cumsum(together[0])
    for p, a, b in zip(payloads, ends - together[0], ends, strict=True):
        assert media.tensors(media.log_mel([p], spec)[1], spec) == media.tensors(together[1][a:b], spec)


def test_tensors_can_be_read(spark):
    spec = AudioSpec()
    _, mel, _ = media.log_mel([bytes(range(256)) * 40], spec)
    table = pa.ipc.open_stream(media.tensors(mel, spec)).read_all()
    shape = table.column("log_mel").type.shape
    assert list(shape) == [spec.tensor_frames, spec.mels] and table.column("start_s")[0].as_py() == 0


def test_media_and_tensors_are_stored_and_read_again(spark):
    from pathlib import Path

    from strata_spark.llm import common, queries

    at, shared = "/root/testdata/sf0.001", Path(common.shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    got = queries.op5_media(spark, at)
    new = {p.name.partition("-")[0]: str(p) for p in set(shared.iterdir()) - before}
    assert new.keys() == {"media", "features"} and any(new["features"] in f for f in got.inputFiles())
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text")
    want = media.described(media.features(media.store(docs)))
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    wav = spark.read.parquet(new["media"]).join(docs, "doc_id").first()
    assert media.from_wav(wav.media) == media.padded(wav.text.encode())
    assert pa.ipc.open_stream(spark.read.parquet(new["features"]).first().log_mel).read_all().num_rows > 0


@pytest.mark.parametrize("spec", [media.AudioSpec(), media.AudioSpec(up=2, down=3)])
def test_long_signals_are_worked_on_in_blocks(spec, monkeypatch):
    payload = np.random.default_rng(3).integers(0, 256, 64 * 900, np.uint8).tobytes()
    whole = media.log_mel([payload], spec)
    monkeypatch.setattr(media, "FRAMES_AT_ONCE", 10)
    for a, b in zip(whole, media.log_mel([payload], spec), strict=True):
        assert np.array_equal(a, b)


def by_definition(payload, spec):
    """Log-mel rows, energies and spans of one signal by scalar formulas: convolution, a plain DFT, triangles in mel, a two-state machine."""
    x = [(b - 128) / 128 for b in payload]
    wide = max(spec.up, spec.down)
    half = spec.half_taps * wide // 2
    h = []
    for k, t in enumerate(range(-half, half + 1)):
        u = t / wide
        sinc = 1.0 if u == 0 else math.sin(math.pi * u) / (math.pi * u)
        h.append(sinc * (0.5 - 0.5 * math.cos(2 * math.pi * (k + 1) / (2 * half + 2))) * spec.up / wide)
    y = []
    for m in range(len(x) * spec.up // spec.down):
        at = m * spec.down + half  # place in the convolution of the stuffed signal
        y.append(sum(h[at - n * spec.up] * x[n] for n in range(max(0, -(-(at - 2 * half) // spec.up)), min(len(x) - 1, at // spec.up) + 1)))
    mel = lambda f: 2595 * math.log10(1 + f / 700)
    edges = [700 * (10 ** (mel(spec.new_rate / 2) * k / (spec.mels + 1) / 2595) - 1) for k in range(spec.mels + 2)]
    n = 1 + max(0, math.ceil((len(y) - spec.frame) / spec.hop))
    rows, energies = [], []
    for f in range(n):
        frame = [y[f * spec.hop + k] if f * spec.hop + k < len(y) else 0.0 for k in range(spec.frame)]
        # what stands behind a signal is the filter's tail over silence
        for k in range(spec.frame):
            if f * spec.hop + k >= len(y):
                at = (f * spec.hop + k) * spec.down + half
                frame[k] = sum(h[at - i * spec.up] * x[i] for i in range(max(0, -(-(at - 2 * half) // spec.up)), len(x)))
        mean = sum(frame) / spec.frame
        frame = [(v - mean) * (0.5 - 0.5 * math.cos(2 * math.pi * k / (spec.frame - 1))) for k, v in enumerate(frame)]
        power = []
        for b in range(spec.frame // 2 + 1):
            re = sum(v * math.cos(2 * math.pi * b * k / spec.frame) for k, v in enumerate(frame))
            im = sum(v * math.sin(2 * math.pi * b * k / spec.frame) for k, v in enumerate(frame))
            power.append((re * re + im * im) / spec.frame)
        row = []
        for m in range(spec.mels):
            low, middle, high = edges[m : m + 3]
            total = 0.0
            for b, e in enumerate(power):
                hz = b * spec.new_rate / spec.frame
                total += e * max(0.0, min((hz - low) / (middle - low), (high - hz) / (high - middle)))
            row.append(10 * math.log10(total + 1e-10))
        rows.append(row)
        energies.append(10 * math.log10(sum(power) / len(power) + 1e-10))
    spans, open_at = [], None
    for f, e in enumerate(energies):
        if open_at is None and e >= spec.open_db:
            open_at = f
        elif open_at is not None and e < spec.close_db:
            spans.append((open_at, f))
            open_at = None
    spans += [(open_at, n)] if open_at is not None else []
    return rows, energies, [(a * spec.hop / spec.new_rate, ((b - 1) * spec.hop + spec.frame) / spec.new_rate) for a, b in spans]


@pytest.mark.parametrize("spec", [AudioSpec(frame=32, hop=16, mels=6), AudioSpec(up=3, down=4, frame=48, hop=24, mels=5, half_taps=4, open_db=-12.0, close_db=-14.0)])
def test_log_mel_and_segments_by_definition(spec):
    r = np.random.default_rng(7)
    quiet = 128 + r.integers(-3, 4, 200)
    loud = r.integers(0, 256, 300)
    for payload in (bytes(64), media.padded(b"A text, as bytes of a signal. " * 9), media.padded(np.concatenate([quiet, loud, quiet, loud[:90]]).astype(np.uint8).tobytes())):
        rows, energies, spans = by_definition(payload, spec)
        counts, mel, energy = media.log_mel([payload], spec)
        assert counts.tolist() == [len(rows)] and np.abs(mel - np.array(rows)).max() < 0.006 and np.abs(energy - np.array(energies)).max() < 0.006
        assert media.segments(np.array(energies), spec) == [pytest.approx(s) for s in spans]


@pytest.mark.parametrize("texts", [["ab"] * 4000, ["A text of a usual length. " * 100] * 3000], ids=["short", "usual"])
def test_a_worker_holds_little_of_an_arrow_batch(texts, monkeypatch):
    made = []
    monkeypatch.setattr(media, "add_columns", lambda df, column, ddl, make, **more: made.append((make, more)))
    media.store(None)
    media.features(None)
    values = pa.array(texts)
    for (make, more), new in zip(made, (1, 0), strict=True):
        out, peaks = [], []
        for part in common.slices([pa.RecordBatch.from_arrays([values], ["x"])], 0, **more):
            tracemalloc.start()
            out.append(make(part.column(0))[new])
            peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
            tracemalloc.stop()
        values = pa.concat_arrays(out)
        assert len(values) == len(texts) and max(peaks) < 30
    assert values.to_pylist() == [media.padded(t.encode()) for t in texts]


def test_groups_take_every_signal_once_and_are_bounded_with_their_silence():
    spec, r = AudioSpec(), np.random.default_rng(5)
    payloads = [bytes(64 * int(n)) for n in [*r.integers(1, 50, 3000), 9000, 1, 1, 9000]]
    found = list(media.groups(payloads, spec))
    assert [a for a, _ in found] == [0, *(b for _, b in found[:-1])] and found[-1][1] == len(payloads)
    for a, b in found:
        counts = media.frame_counts(np.array([len(p) for p in payloads[a:b]]) * spec.up // spec.down, spec)
        assert b == a + 1 or media.slots(counts, spec).sum() <= media.SAMPLES_AT_ONCE
    assert list(media.groups([], spec)) == []
