"""Media columns: audio kept as 8-bit WAV, with log-mel tensors and active segments as features.

A signal is resampled by a polyphase filter, cut into overlapping frames and shown by the log energies of
mel-spaced filters. Segments are found by hysteresis: energy above one threshold opens a segment, energy below
a lower one closes it. Tensors of a fixed shape are stored as an Arrow stream with the time span of each.
"""

from __future__ import annotations

import io
import math
import wave
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns

ALIGN = 64
#: Frames of one signal that are worked on at once; a multiple of every AudioSpec.up in use.
FRAMES_AT_ONCE = 1 << 9
#: Samples of several signals that are laid out at once, with the silence between, and bytes of texts or files that a worker takes at once.
SAMPLES_AT_ONCE = 1 << 18
BYTES_AT_ONCE = 2 << 20


@dataclass(frozen=True)
class AudioSpec:
    """rate: of the stored samples; up / down: the resampling ratio; frame, hop: of resampled samples; dB thresholds."""

    rate: int = 16000
    up: int = 1
    down: int = 2
    half_taps: int = 8
    frame: int = 512
    hop: int = 256
    mels: int = 32
    tensor_frames: int = 8
    open_db: float = -16.0
    close_db: float = -19.0

    @property
    def new_rate(self) -> int:
        return self.rate * self.up // self.down


def padded(data: bytes) -> bytes:
    """data and zeros up to a positive multiple of 64 bytes."""
    return data + bytes(max(ALIGN, -(-len(data) // ALIGN) * ALIGN) - len(data))


def to_wav(payload: bytes, rate: int) -> bytes:
    """The payload as the samples of an 8-bit mono WAV file; lossless."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


@lru_cache(maxsize=8)
def lowpass(spec: AudioSpec) -> np.ndarray:
    """A windowed sinc below the lower of both Nyquist rates, half_taps periods of it to each side."""
    wide = max(spec.up, spec.down)
    t = np.arange(-spec.half_taps * wide // 2, spec.half_taps * wide // 2 + 1)
    return np.sinc(t / wide) * np.hanning(len(t) + 2)[1:-1] * spec.up / wide


def resample(x: np.ndarray, spec: AudioSpec) -> np.ndarray:
    """Polyphase: output m is a dot product of the input with one phase of the filter; no zeros are multiplied."""
    h = lowpass(spec)
    up, down, middle = spec.up, spec.down, len(h) // 2
    n = len(x) * up // down
    padded_x = np.concatenate([np.zeros(len(h)), x, np.zeros(len(h) + down)])
    y = np.zeros(n)
    for r in range(up):  # outputs r, r + up, ... share a phase
        t = r * down + middle
        phase, base = t % up, t // up
        count = len(range(r, n, up))
        for j, tap in enumerate(h[phase::up]):
            at = base - j + len(h)
            y[r::up] += tap * padded_x[at : at + down * count : down][:count]
    return y


@lru_cache(maxsize=8)
def mel_filters(spec: AudioSpec) -> np.ndarray:
    """Triangles that are evenly spaced in mel, as (bins, mels)."""
    top = 2595 * math.log10(1 + spec.new_rate / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, spec.mels + 2) / 2595) - 1)
    bins = np.arange(spec.frame // 2 + 1) * spec.new_rate / spec.frame
    rise = (bins[:, None] - edges[None, :-2]) / (edges[1:-1] - edges[:-2])
    fall = (edges[None, 2:] - bins[:, None]) / (edges[2:] - edges[1:-1])
    return np.maximum(0, np.minimum(rise, fall))


def frame_counts(sizes: np.ndarray, spec: AudioSpec) -> np.ndarray:
    """Frames that cover so many resampled samples, one at least."""
    return 1 + np.maximum(0, -(-(sizes - spec.frame) // spec.hop))


def slots(counts: np.ndarray, spec: AudioSpec) -> np.ndarray:
    """Samples that signals of so many frames take when laid out one after the other: whole frames and silence, far more than a short text has."""
    return -(-((counts - 1) * spec.hop + spec.frame + 2 * spec.half_taps) // spec.up) * spec.down * spec.up


def groups(payloads: list[bytes], spec: AudioSpec):
    """Ranges of signals that take SAMPLES_AT_ONCE when laid out, or one longer signal."""
    each = slots(frame_counts(np.array([len(p) for p in payloads], np.int64) * spec.up // spec.down, spec), spec)
    ends, at = np.cumsum(each), 0
    while at < len(payloads):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - each[at] + SAMPLES_AT_ONCE, "right")))
        yield at, to
        at = to


def log_mel(payloads: list[bytes], spec: AudioSpec) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frames of each signal, and of all frames the log-mel rows and energies, both in dB to two places.

    Signals are laid out one after the other with silence between, so that one call of each step serves all; a
    long one alone is worked on in blocks of frames, with the samples around each block that the filter needs.
    """
    sizes = np.array([len(p) for p in payloads]) * spec.up // spec.down
    counts = frame_counts(sizes, spec)
    if len(payloads) == 1 and counts[0] > FRAMES_AT_ONCE:
        parts = [_features(*_block(payloads[0], f, min(int(counts[0]), f + FRAMES_AT_ONCE), spec), spec) for f in range(0, int(counts[0]), FRAMES_AT_ONCE)]
        return counts, *(np.concatenate(x) for x in zip(*parts, strict=True))
    starts = np.concatenate([[0], np.cumsum(slots(counts, spec))])
    signal = np.zeros(int(starts[-1]))
    for p, at in zip(payloads, starts, strict=False):
        signal[at : at + len(p)] = _samples(p)
    y = resample(signal, spec)
    first = np.repeat(starts[:-1] * spec.up // spec.down, counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return counts, *_features(y, first + nth * spec.hop, spec)


def _samples(payload: bytes) -> np.ndarray:
    return (np.frombuffer(payload, np.uint8).astype(np.float64) - 128) / 128


def _block(payload: bytes, first: int, last: int, spec: AudioSpec) -> tuple[np.ndarray, np.ndarray]:
    """The resampled signal of frames first to last, and where in it they begin; first is a multiple of spec.up."""
    wide = spec.down * spec.half_taps * max(spec.up, spec.down)
    at = first * spec.hop * spec.down // spec.up - wide
    to = -(-((last - 1) * spec.hop + spec.frame) * spec.down // spec.up) + wide
    x = _samples(payload[max(0, at) : to])
    x = np.concatenate([np.zeros(max(0, -at)), x, np.zeros(max(0, to - len(payload)))])
    y = resample(x, spec)[wide * spec.up // spec.down :]
    return y, np.arange(last - first) * spec.hop


def _features(y: np.ndarray, starts: np.ndarray, spec: AudioSpec) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel rows and energies of the frames that begin there."""
    frames = np.lib.stride_tricks.sliding_window_view(y, spec.frame)[starts]
    frames = (frames - frames.mean(axis=1, keepdims=True)) * np.hanning(spec.frame)
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2 / spec.frame
    db = lambda e: np.round(10 * np.log10(e + 1e-10), 2)
    return db(power @ mel_filters(spec)).astype(np.float32), db(power.mean(axis=1))


def segments(energy: np.ndarray, spec: AudioSpec) -> list[tuple[float, float]]:
    """Time spans in seconds of the active segments of one signal's frames."""
    mark = np.where(energy >= spec.open_db, 1, np.where(energy < spec.close_db, -1, 0))
    last = np.maximum.accumulate(np.where(mark != 0, np.arange(len(mark)), -1))
    on = np.concatenate([[False], (last >= 0) & (mark[last] == 1), [False]])
    edges = np.flatnonzero(on[1:] != on[:-1])
    span = lambda a, b: (a * spec.hop / spec.new_rate, ((b - 1) * spec.hop + spec.frame) / spec.new_rate)
    return [span(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def tensors(mel: np.ndarray, spec: AudioSpec) -> bytes:
    """An Arrow stream of fixed-shape tensors (tensor_frames x mels), the last one padded with silence, and their time spans."""
    import pyarrow as pa

    n = -(-len(mel) // spec.tensor_frames)
    full = np.full((n * spec.tensor_frames, spec.mels), -100, np.float32)
    full[: len(mel)] = mel
    starts = np.arange(n) * spec.tensor_frames * spec.hop / spec.new_rate
    ends = (np.minimum(np.arange(1, n + 1) * spec.tensor_frames, len(mel)) - 1) * spec.hop / spec.new_rate + spec.frame / spec.new_rate
    batch = pa.RecordBatch.from_arrays([pa.FixedShapeTensorArray.from_numpy_ndarray(full.reshape(n, spec.tensor_frames, spec.mels)), pa.array(starts), pa.array(ends)], ["log_mel", "start_s", "end_s"])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema) as w:
        w.write_batch(batch)
    return out.getvalue()


def store(docs: DataFrame, text: str = "text", spec: AudioSpec = AudioSpec()) -> DataFrame:
    """Adds n_bytes (of the text in UTF-8) and media (a WAV file whose samples are the padded bytes) to docs.

    Null is as empty: one block of 64 zeros. Rows are kept one to one, repeated ones too; an empty table gives
    an empty table; columns of these names are replaced. No shuffle.
    """

    def make(texts):
        import pyarrow as pa

        data = [(x or "").encode("utf-8", "surrogatepass") for x in texts.to_pylist()]
        return [pa.array([len(d) for d in data], pa.int64()), pa.array([to_wav(padded(d), spec.rate) for d in data], pa.binary())]

    return add_columns(docs, text, "n_bytes long, media binary", make, most=BYTES_AT_ONCE)


def features(docs: DataFrame, media: str = "media", spec: AudioSpec = AudioSpec()) -> DataFrame:
    """Adds payload (binary, the samples read back), log_mel (binary, an Arrow stream of tensors) and segments (array of start and end in seconds).

    Columns of these names are replaced. Null media have no payload and no features.
    """

    def make(files):
        import pyarrow as pa

        files = files.to_pylist()
        out: list = [(None, None, None)] * len(files)
        there = [i for i, f in enumerate(files) if f is not None]
        payloads = [from_wav(files[i]) for i in there]
        for at, to in groups(payloads, spec):
            counts, mel, energy = log_mel(payloads[at:to], spec)
            ends = np.cumsum(counts)
            for k, (a, b) in enumerate(zip(ends - counts, ends, strict=True), at):
                out[there[k]] = (payloads[k], tensors(mel[a:b], spec), [{"start_s": x, "end_s": y} for x, y in segments(energy[a:b], spec)])
        kinds = pa.binary(), pa.binary(), pa.list_(pa.struct([("start_s", pa.float64()), ("end_s", pa.float64())]))
        return [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]

    return add_columns(docs, media, "payload binary, log_mel binary, segments array<struct<start_s:double,end_s:double>>", make, most=BYTES_AT_ONCE)


def described(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and digests of what is stored and computed, and more columns as they are."""
    spans = F.transform("segments", lambda s: F.concat_ws("-", s.start_s.cast("decimal(18,3)").cast("string"), s.end_s.cast("decimal(18,3)").cast("string")))
    return docs.select(
        "doc_id",
        "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -ALIGN, ALIGN)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws("|", F.sha2("log_mel", 256), F.concat_ws(",", spans)).alias("feature"),
        *more,
    )
