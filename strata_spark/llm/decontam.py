"""Benchmark decontamination by a prefix-filtered join.

A window is a set of (place, word) shingles that a document has to contain whole. Words are ordered by how
rare they are in all documents, so the prefix that has to be joined is a window's rarest word. Each place in a
document that has such a word gives, by the word's place in the window, the one place where the window can
begin; length and position bounds drop those that don't fit, and the words of the rest are compared.

A benchmark of bounded size is searched for map side. A larger one is joined: bit tables of bounded size, of its windows'
rarest words and of whole windows, tell which places of a document are worth sending; these are joined with the windows by
their words, so false hits of the tables find nothing.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, slices, staged, unused

#: Letters and digits of ASCII and all bytes of other characters make words; A-Z is lower-cased.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
WINDOW = 13
#: Windows of a benchmark that is held in each worker; those of a larger one are joined.
MOST_WINDOWS = 50_000
#: Bits of a bit table: 16 for each of its strings, as a power of two, at most 2**MOST_BITS (32 MB); more strings make more false hits, no misses.
BITS_EACH, MOST_BITS = 16, 28
#: Counted words that a task holds before it sends their counts.
HELD_WORDS = 500_000


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def windows(item: list[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    """The distinct windows of an item; a short item is one window."""
    return {tuple(item[i : i + size]) for i in range(max(1, len(item) - size + 1))} if item else set()


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()


def _count_windows(items: DataFrame, size: int) -> int:
    """About how many windows items have, at least as many as they have."""
    return items.agg(F.sum(F.greatest(F.lit(1), F.size(F.split("text", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")) - (size - 1)))).first()[0] or 0


def _frequencies(docs: DataFrame, text: str, vocabulary=None) -> DataFrame:
    """How often each word of a broadcast vocabulary, or each word at all, occurs in all documents; texts are read once."""

    def count(batches):
        import pyarrow as pa

        sent = lambda: pa.RecordBatch.from_pydict({"word": pa.array(found.keys(), pa.binary()), "n": pa.array(found.values(), pa.int64())})
        known, found = vocabulary.value if vocabulary else None, Counter()
        for batch in slices(batches, 0):
            for x in batch.column(0).to_pylist():
                found.update(filter(known.__contains__, words(x)) if vocabulary else words(x))
            if len(found) > HELD_WORDS:
                yield sent()
                found = Counter()
        yield sent()

    return docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _index(items: list, counts: dict[bytes, int], size: int) -> dict:
    """By rarest word: by (its place in the window, the window's length): by the window: its items."""
    index: dict = {}
    for item_id, text in items:
        for w in windows(words(text), size):
            rare, at = min((counts.get(x, 0), x, i) for i, x in enumerate(w))[1:]
            index.setdefault(rare, {}).setdefault((at, len(w)), {}).setdefault(w, set()).add(item_id)
    return index


def _search(index: dict, found: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Spans of words inside a window, in order and apart, and the items of these windows."""
    n, spans, items = len(found), [], set()
    for i, word in enumerate(found):
        if word in index:
            for (at, length), there in index[word].items():
                start = i - at
                if 0 <= start <= n - length and (ids := there.get(tuple(found[start : start + length]))):
                    spans.append((start, start + length))
                    items |= ids
    return _union(spans), items


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """Adds n_words, n_hit (words inside a window of the benchmark), item_ids (array, sorted strings) and contaminated.

    contaminated: n_hit > 0 and 20 * n_hit >= n_words. A benchmark of most_windows or fewer, a stated query set of bounded size, is
    broadcast and searched for in all rows, and documents aren't shuffled; a larger one is joined, with equal results. Null and empty texts
    have no words and are clean; items without words match nothing; items without an id count for n_hit only; repeated rows
    get equal results; an empty benchmark leaves all documents clean. Columns of these names and of the name _hits are replaced.
    """
    context, items = docs.sparkSession.sparkContext, _items(benchmark)
    n = _count_windows(items, size)
    if not n:
        out = add_columns(docs, text, "n_words long", lambda texts: [_long([len(words(x)) for x in texts.to_pylist()])])
        out = out.withColumns({"n_hit": F.lit(0).cast("long"), "item_ids": F.array().cast("array<string>")})
    elif n <= most_windows:
        rows = [tuple(r) for r in items.collect()]  # of bounded size
        vocabulary = context.broadcast({w for _, t in rows for w in words(t)})
        counts = {bytes(r.word): r.n for r in _frequencies(docs, text, vocabulary).collect()}
        out = _with_hits(docs, text, context.broadcast(_index(rows, counts, size)))
        vocabulary.destroy()
        out = out.withColumn("n_hit", _covered(F.col("_hits.spans"))).withColumn("item_ids", F.col("_hits.items")).drop("_hits")
    else:
        out = _joined(docs, items, text, size)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _covered(spans):
    """How many places spans (array of a, b) cover."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), start, lambda u, x: F.struct(F.greatest(u.end, x.b).alias("end"), (u.n + F.greatest(F.lit(0), x.b - F.greatest(u.end, x.a))).alias("n"))).n


def _hashed(strings: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, strings), np.uint64, len(strings))


def _bit_table(strings: DataFrame) -> tuple[int, np.ndarray]:
    """Bits, and a table with the bit of each string's hash set; strings has one binary column. Its size is bounded."""
    n = strings.count()
    bits = min(MOST_BITS, max(12, (BITS_EACH * n).bit_length()))

    def hashes(batches):
        import pyarrow as pa

        for batch in batches:
            h = _hashed(batch.column(0).to_pylist()) >> np.uint64(64 - bits)
            one = (np.uint64(1) << (h & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(6)).astype(np.int64)), pa.array(one)], ["at", "bit"])

    rows = strings.mapInArrow(hashes, "at long, bit long").groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()  # 2**bits / 64 rows at most
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return bits, table.view(np.uint64)


def _may_have(table: tuple[int, np.ndarray], strings: list[bytes]) -> np.ndarray:
    bits, words_ = table
    h = _hashed(strings) >> np.uint64(64 - bits)
    return (words_[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63))) & np.uint64(1) == 1


def _joined(docs: DataFrame, items: DataFrame, text: str, size: int) -> DataFrame:
    """docs with n_words, n_hit and item_ids, by a join of their places with the benchmark's windows."""
    context = docs.sparkSession.sparkContext

    def of_items(batches):
        import pyarrow as pa

        for batch in slices(batches, "text"):
            rows = [(i, b" ".join(w), len(w)) for i, t in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text")), strict=True) for w in windows(words(t), size)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.string(), pa.binary(), pa.int32()))], ["item_id", "window", "length"])

    owned = staged(items.mapInArrow(of_items, "item_id string, window binary, length int"), "windows")
    distinct = owned.select("window", "length").distinct()
    counts = _frequencies(docs, text)
    placed = distinct.select("window", F.posexplode(F.split(F.decode("window", "ISO-8859-1"), " ")).alias("at", "word")).withColumn("word", F.encode("word", "ISO-8859-1"))
    rare = placed.join(counts, "word", "left").groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "at")).alias("r"))
    rare = staged(rare.select("window", "r.word", "r.at").join(distinct, "window"), "rare-words")
    lengths = sorted(r.length for r in rare.select("length").distinct().collect())  # `size` numbers at most
    tables = context.broadcast((_bit_table(rare.select("word").distinct()), _bit_table(rare.select("window"))))
    row = unused(docs, "row")
    gone = {"n_words", "n_hit", "item_ids", "contaminated"}
    rows = staged(docs.drop(*[c for c in docs.columns if c.lower() in gone]).withColumn(row, F.monotonically_increasing_id()), "searched")

    def places(batches):
        import pyarrow as pa

        words_, whole = tables.value
        for batch in slices(batches, 1):
            out, sizes = [], []
            for r, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(x)
                sizes.append((r, len(found)))
                near = np.flatnonzero(_may_have(words_, found)) if found else np.zeros(0, int)
                for n in lengths:
                    starts = np.unique((near[:, None] - np.arange(n)).ravel())  # the rarest word may stand anywhere in a window
                    starts = starts[(starts >= 0) & (starts <= len(found) - n)].tolist()
                    strings = [b" ".join(found[a : a + n]) for a in starts]
                    out += [(r, None, a, strings[k]) for k, a in enumerate(starts) if hit[k]] if (hit := _may_have(whole, strings)).any() else []
            out += [(r, n, None, None) for r, n in sizes]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["r", "n_words", "a", "window"])

    sent = staged(rows.select(row, text).mapInArrow(places, "r long, n_words long, a int, window binary"), "places")
    hits = sent.where("window is not null").join(rare.select("window", "length"), "window").select("r", "a", (F.col("a") + F.col("length")).alias("b"), "window")
    spans = hits.groupBy("r").agg(_covered(F.collect_list(F.struct("a", "b"))).alias("n_hit"))
    ids = hits.select("r", "window").distinct().join(owned.where("item_id is not null").select("window", "item_id").distinct(), "window").groupBy("r").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    about = sent.where("window is null").select("r", "n_words").join(spans, "r", "left").join(ids, "r", "left").withColumnRenamed("r", row)
    out = rows.join(about, row)
    return out.withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long"))).withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<string>"))).drop(row)


def _long(values):
    import pyarrow as pa

    return pa.array(values, pa.int64())


def _with_hits(docs: DataFrame, text: str, index) -> DataFrame:
    """Adds n_words and what the benchmark hits: spans of words and items."""

    def make(texts):
        import pyarrow as pa

        known, sizes, hits = index.value, [], []
        for x in texts.to_pylist():
            found = words(x)
            spans, items = _search(known, found)
            sizes.append(len(found))
            hits.append({"spans": [{"a": a, "b": b} for a, b in spans], "items": sorted(x for x in items if x is not None)})
        kind = pa.struct([("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))), ("items", pa.list_(pa.string()))])
        return [_long(sizes), pa.array(hits, kind)]

    return add_columns(docs, text, "n_words long, _hits struct<spans:array<struct<a:int,b:int>>,items:array<string>>", make)
