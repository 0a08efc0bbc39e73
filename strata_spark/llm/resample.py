"""Importance resampling towards a target distribution of hashed n-grams.

A document is scanned once, its separators made one space: running CRCs are stored where words begin and end. The CRC
of any run of words comes from two of them: the register before the run, moved on by the run's length in GF(2), cancels
out of the register behind it. Buckets of features are counted over all documents and over the target; documents are
drawn by their summed gains with Gumbel noise, which makes the draw one without replacement in proportion to their weights.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import add_columns, staged, unused

#: Fixed value: the CRC-32 polynomial, reflected.
POLYNOMIAL = 0xEDB88320
BUCKETS = 10_000
LEAST_WORDS = 20
#: Bytes that can't be in a word become spaces, A-Z lower case.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@lru_cache(1)
def _steps() -> np.ndarray:
    """[k, j, b]: what byte j of a register, being b, becomes when 2**k zero bytes follow."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(POLYNOMIAL), byte >> 1).astype(np.uint32)
    base = np.arange(256, dtype=np.uint32)
    one = np.stack([byte, base, base << np.uint32(8), base << np.uint32(16)])  # the lowest byte is shifted out through the table
    out = [one]
    for _ in range(31):
        out.append(np.stack([_through(out[-1], _through(out[-1], base << np.uint32(8 * j))) for j in range(4)]))
    return np.stack(out)


def _through(tables: np.ndarray, registers: np.ndarray) -> np.ndarray:
    out = tables[0][registers & 255]
    for j in (1, 2, 3):
        out = out ^ tables[j][(registers >> np.uint32(8 * j)) & 255]
    return out


def shifted(registers: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """CRC registers after so many zero bytes each."""
    out, zeros, k = registers.astype(np.uint32), np.asarray(zeros, np.int64), 0
    most = int(zeros.max(initial=0))
    while most >> k:
        moved = (zeros >> k) & 1 == 1
        out[moved] = _through(_steps()[k], out[moved])
        k += 1
    return out


def scanned(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Registers before and behind each word of the document with its separators made one space, and words' lengths in bytes."""
    words = text.encode().translate(_TABLE).split()
    first, after, crc, running = [], [], zlib.crc32, 0
    for w in words:
        first.append(running)
        running = crc(w, running)
        after.append(running)
        running = crc(b" ", running)
    # zlib's values are registers xor all ones
    ones, n = np.uint32(0xFFFFFFFF), len(words)
    return np.array(first, np.uint32) ^ ones, np.array(after, np.uint32) ^ ones, np.fromiter(map(len, words), np.int64, n)


def run_crcs(first: np.ndarray, after: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """CRC-32 of each run of n words, joined by one space, from the registers before and behind it."""
    if len(sizes) < n:
        return np.empty(0, np.uint32)
    total = np.cumsum(sizes)
    length = total[n - 1 :] - total[: len(total) - n + 1] + sizes[: len(total) - n + 1] + n - 1
    ones = np.uint32(0xFFFFFFFF)
    # a run's own CRC starts from all ones: what the register before it and that start differ by is moved on and cancelled
    return after[n - 1 :] ^ shifted(first[: len(length)] ^ ones, length) ^ ones


def features(text: str, longest: int, buckets: int) -> tuple[int, np.ndarray]:
    """How many words a text has, and the buckets of all its runs of 1 to `longest` words, repeats included."""
    found = scanned(text)
    return len(found[2]), np.concatenate([run_crcs(*found, n) for n in range(1, longest + 1)]) % np.uint32(buckets)


def hashed(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """docs with n_words, n_features and features (buckets as little-endian 16- or 32-bit integers) in place of the text."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def make(texts):
        import pyarrow as pa

        found = [features(t or "", longest, buckets) for t in texts.to_pylist()]
        return [pa.array([n for n, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()), pa.array([f.astype(kind).tobytes() for _, f in found], pa.binary())]

    return add_columns(docs, text, "n_words long, n_features long, features binary", make).drop(text)


def counts(hashed_docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all documents: each task sends one row a bucket at most."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def count(batches):
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), kind), minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["bucket", "n"])

    return hashed_docs.select("features").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target to source in each bucket; as many numbers as buckets, a parameter."""
    spark = source.sparkSession
    both = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"])
    rows = both.select("bucket", "s", "t").toArrow()  # `buckets` rows
    at, s, t = (rows.column(c).to_numpy() for c in ("bucket", "s", "t"))
    ratio = (t + 1.0) * (float(s.sum()) + buckets) / ((s + 1.0) * (float(t.sum()) + buckets))
    out = np.zeros(buckets, np.int64)
    out[at] = np.floor(1000 * np.log(ratio)).astype(np.int64)
    return out


def weighted(hashed_docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """hashed documents with weight, the sum of their features' gains, in place of features."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def make(packed):
        import pyarrow as pa

        return [pa.array([int(gain[np.frombuffer(p.as_buffer(), kind)].sum()) for p in packed], pa.int64())]

    return add_columns(hashed_docs, "features", "weight long", make).drop("features")


def noise(seed: int, doc_id) -> F.Column:
    """floor(-1000 ln(-ln u)), u from a hash of seed and doc_id: Gumbel noise that no partitioning changes."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, percent: int, doc_id: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """scored with rank: 1, 2, 3 ... for the `percent` percent (rounded down) of documents of least_words or more with the highest
    scores, ties by doc_id (null first), null for others.

    A distributed sort: each row's rank is its place in its partition after the partitions before it, of which only the sizes are summed.
    """
    place, part = unused(scored, "place"), unused(scored, "part")
    long = F.col("n_words") >= least_words
    spread = unused(scored, "spread")  # equal rows don't have to meet in one partition
    rows = scored.where(long).withColumn(spread, F.monotonically_increasing_id()).orderBy(F.desc("score"), F.col(doc_id).asc_nulls_first(), spread).drop(spread)
    rows = staged(rows.withColumn(place, F.monotonically_increasing_id()), "resample-order")
    sizes = rows.groupBy(F.shiftright(place, 33).alias(part)).agg(F.count("*").alias("n"))  # a row a partition
    offsets = sizes.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias("before"), (F.sum("n").over(Window.partitionBy()) * percent).alias("hundredths"))
    joined = rows.withColumn(part, F.shiftright(place, 33)).join(F.broadcast(offsets), part)
    rank = F.col("before") + F.col(place).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = joined.withColumn("rank", F.when(rank <= F.floor(F.col("hundredths") / 100), rank)).drop(place, part, "before", "hundredths")
    return drawn.unionByName(scored.where(~long).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024, least_words: int = LEAST_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without text, with n_words, n_features, weight, score and rank (null: not drawn), drawn towards target's texts.

    Null and empty texts have no features and weight 0, and are too short to be drawn; a null doc_id has the noise of an empty
    one; repeated rows are drawn one by one; an empty table gives an empty one, and an empty target leaves smoothing only.
    Columns of these names are replaced, other columns stay. Texts are read once and whole; afterwards
    a document is two bytes a feature.
    """
    new = {"n_words", "n_features", "features", "weight", "score", "rank", "before", "hundredths"}
    clean = docs.drop(*[c for c in docs.columns if c.lower() in new and c.lower() not in (text.lower(), doc_id.lower())])
    rows = staged(hashed(clean, text, longest, buckets), "resample-features")
    goal = hashed(target.select(F.col("text")), "text", longest, buckets)
    gain = gains(counts(rows, buckets), counts(goal, buckets), buckets)
    scored = weighted(rows, gain).withColumn("score", F.col("weight") + noise(seed, F.col(doc_id)))
    return ranked(staged(scored, "resample-scores"), percent, doc_id, least_words)
