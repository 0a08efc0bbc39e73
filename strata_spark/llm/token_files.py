"""Token files: ORC with document ids in order, one stripe readable without the others.

Rows are dealt by ranges of doc_id and sorted, so row indexes, stripe statistics and Bloom filters on doc_id
let a reader skip files, stripes and row groups; ids lie in run-length encoded integer columns.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import distinct_words, pattern_words
from .common import laid_out, slices, split_runs, trimmed, work_path

#: Documents are separated by this id.
END = 2
#: Offsets of so many files, a few bytes each, are broadcast; those of more are joined by shuffling.
BROADCAST_PARTS = 100_000
#: Runs and words that a worker remembers each.
KEPT = 400_000
STRIPE_BYTES, INDEX_STRIDE, BLOOM_FPP = 16 << 20, 5000, 0.01


class _Library:
    """The tokenizers library, asked once for each run without white space, which its pattern never joins with another.

    Runs of settled letters are split into the pattern's words first, and many new words are asked for in one
    text; the token that ends a word says where the next one begins.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.kind, self.code = (np.uint16, "H") if self.model.get_vocab_size() <= 1 << 16 else (np.uint32, "I")
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        for token, i in self.model.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _learn(self, runs: list[str]) -> None:
        runs, split, others = pattern_words(runs)
        added = new = distinct_words(split).difference(self.words)
        merge = self.model.model.tokenize  # what comes before it leaves lower-case ASCII letters as they are
        simple = [w for w in new if w.isascii() and w.isalpha()]
        self.words.update((w, self._pack([t.id for t in merge(w)])) for w in simple)
        new = list(new.difference(simple))
        size = self.kind().itemsize
        for at in range(0, len(new), 5000):
            part = new[at : at + 5000]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            cut = [0, *((np.flatnonzero(self.ends[ids]) + 1) * size).tolist()]
            data = ids.tobytes()
            self.words.update((w, data[a:b]) for w, a, b in zip(part, cut[:-1], cut[1:], strict=True))
        word = self.words.__getitem__
        self.known.update((r, word(x) if type(x) is str else b"".join(map(word, x))) for r, x in zip(runs, split, strict=True))
        if others:
            self.known.update((c, self._pack(e.ids)) for c, e in zip(others, self.model.encode_batch_fast(others, add_special_tokens=False), strict=True))
        self.words = trimmed(self.words, added, KEPT)

    def encode_all(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and all ids in one array; END follows each text. texts is an Arrow array, null is as empty."""
        ends, codes, runs = split_runs(texts)
        if missing := [r for r in runs if r not in self.known]:
            self._learn(missing)
        codes = np.insert(codes, ends[1:], len(runs))
        out, ids = laid_out([*map(self.known.__getitem__, runs), self._pack([END])], np.dtype(self.kind), codes, ends + np.arange(len(ends)))
        self.known = trimmed(self.known, runs, KEPT)
        return np.diff(out), ids


@lru_cache(maxsize=2)
def _library(path: str) -> _Library:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    return _Library(path)


def write(docs: DataFrame, tokenizer: str, path: str, text: str = "text") -> None:
    """Writes token files of docs in ascending order of doc_id: doc_id, part, part_start, n_tokens, ids.

    part numbers the files in order of doc_id; part_start counts the ids before the document in its part.
    Null doc_ids come first; equal doc_ids are ordered by text. A null text is as an empty one: only END.
    """

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, start, library = TaskContext.get().partitionId(), 0, _library(tokenizer)
        for batch in slices(batches, "text"):
            sizes, ids = library.encode_all(batch.column("text"))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(sizes), part), pa.int32()), pa.array(start + ends[:-1], pa.int64()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))],
                ["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            start += int(ends[-1])

    rows = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        rows.mapInArrow(encode, "doc_id long, part int, part_start long, n_tokens int, ids array<int>")
        .write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_FPP)
        .option("orc.row.index.stride", INDEX_STRIDE).option("orc.stripe.size", STRIPE_BYTES).option("compression", "zstd").orc(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; filters on doc_id reach the ORC reader.

    The offsets of the parts come from one row per part, of columns other than ids.
    """
    rows = spark.read.schema("doc_id long, part int, part_start long, n_tokens int, ids array<int>").orc(path)
    parts = rows.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("part_offset"))
    parts = F.broadcast(offsets) if parts.count() <= BROADCAST_PARTS else offsets
    return rows.join(parts, "part").select("doc_id", (F.col("part_offset") + F.col("part_start")).alias("start"), F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def packed_crc32(ids: Column) -> Column:
    """Unsigned CRC-32 of an array of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(arrays):
        import pyarrow as pa

        values, ends = arrays.values.to_numpy(zero_copy_only=False).astype("<u4"), arrays.offsets.to_numpy()
        return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64())

    return crc(ids)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes docs as token files in the shared folder, reads them back and describes each document."""
    path = work_path(docs.sparkSession, "token-files")
    write(docs, tokenizer, path)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", packed_crc32("ids").alias("ids_crc32"))
