"""What the operators of this subpackage share: work folders, words, batches."""

from __future__ import annotations

import ctypes
import uuid
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import shared_dir

#: Paths that work_path() gave within each cleared() that is open.
_OPEN: list[list[str]] = []


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN:
        paths.append(path)
    return path


@contextmanager
def cleared(spark: SparkSession):
    """Deletes the work tables that operators write inside it, at its end: whatever reads them has to be written by then."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield
    finally:
        _OPEN.remove(paths)
        of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        for path in paths:
            of(path).getFileSystem(conf).delete(of(path), True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(doc_id: Column, by: int) -> Column:
    """CRC-32 of doc_id as text, null as the empty one, modulo a number: which rows are held out of learning."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


class Memo(dict):
    """A bounded cache for map(memo.__getitem__, keys). When full, what was asked for since the last time it
    was full is the elder half, from which keys come back when asked for. Long keys aren't kept."""

    def __init__(self, make, most: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.half, self.longest, self.elder = make, most // 2, longest, {}

    def __missing__(self, key):
        value = self.elder.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.half:
            self.elder = dict(self)
            self.clear()
        self[key] = value
        return value


#: Characters of the longest string about which a worker keeps what it has learnt, so that as many entries are as many bytes at most.
KEPT_LONGEST = 64


def trimmed(kept: dict[str, bytes], now, most: int, longest: int = KEPT_LONGEST) -> dict[str, bytes]:
    """kept without the long ones of the strings `now` just added; once there are over `most` others, only those of now, or none."""
    for k in now:
        if len(k) > longest:
            kept.pop(k, None)
    if len(kept) > most:
        kept = {k: kept[k] for k in now if k in kept} if len(now) <= most // 2 else {}
    return kept


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with well spread bits (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def split_runs(texts) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Runs of texts (an Arrow array; null is as empty) between spaces and \\x09-\\x0D, each distinct one numbered.

    Gives where each text's runs begin and end, the numbers of all runs in their order, and the distinct runs.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.fill_null(texts, "")))
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    empty = pc.equal(pc.binary_length(flat), 0)
    if pc.any(empty).as_py():
        ends -= np.concatenate([[0], np.cumsum(empty.to_numpy(zero_copy_only=False))])[ends]
        flat = flat.filter(pc.invert(empty))
    numbered = flat.dictionary_encode()
    n = len(numbered.dictionary)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), numbered.dictionary), " ")[0].as_py()  # faster than one by one
    return ends, numbered.indices.to_numpy(), joined.split(" ") if n else []


def hashed(words: list[str]) -> np.ndarray:
    """64-bit hashes of words."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def laid_out(packed: list[bytes], kind: np.dtype, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the numbered things pack, in the order of codes: new ends, and the values."""
    sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // kind.itemsize
    values, starts = np.frombuffer(b"".join(packed), kind), np.cumsum(sizes) - sizes
    each = sizes[codes]
    after = np.concatenate([[0], np.cumsum(each)])
    place = np.repeat(starts[codes] - after[:-1], each)
    place += np.arange(len(place))
    return after[ends], values[place]


def by_bytes(batch, column: str | int, most: int = 8 << 20):
    """Slices of an Arrow batch that hold about `most` bytes of a text column each, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


@lru_cache(maxsize=1)
def _trim():
    """The C library's own way to give freed memory back, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def slices(batches, column: str | int, most: int = 8 << 20):
    """The slices by_bytes() cuts of all batches; at their end, unused memory goes back, for the stages after it."""
    import pyarrow as pa

    try:
        for whole in batches:
            yield from by_bytes(whole, column, most)
    finally:
        pa.default_memory_pool().release_unused()
        _trim()(0)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in whatever case."""
    there = {c.lower() for c in df.columns}
    while f"_{name}".lower() in there:
        name = f"_{name}"
    return f"_{name}"


def add_columns(df: DataFrame, text: str, ddl: str, make, done=None, whole: bool = False, most: int = 8 << 20) -> DataFrame:
    """df with further columns that make(Arrow array of texts) returns as Arrow arrays; df's columns of these names go, in whatever case.

    Map side only. Batches are cut so that each call gets about `most` bytes of text, or one longer text; with whole,
    make gets them with all columns. done is called at the end of each partition, so that a worker keeps nothing for the stages after it.
    """
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(ddl)
    gone = {c.lower() for c in new.names}
    kept = [(i, f) for i, f in enumerate(df.schema.fields) if f.name.lower() not in gone]
    at = df.columns.index(text) if text in df.columns else [c.lower() for c in df.columns].index(text.lower())

    def run(batches):
        import pyarrow as pa

        try:
            for batch in slices(batches, at, most):
                yield pa.RecordBatch.from_arrays([batch.column(i) for i, _ in kept] + make(batch if whole else batch.column(at)), [f.name for _, f in kept] + new.names)
        finally:
            if done:
                done()

    return df.mapInArrow(run, StructType([f for _, f in kept] + new.fields))
