"""Near duplicates by SetSketch registers.

A sketch has REGISTERS registers. Each is the least of an exponentially distributed hash over a document's
shingles, shown as its truncated logarithm, so registers of a union are the larger ones. Bands of ROWS
registers give bucket keys. Within a bucket, documents are compared with a pivot: the joint likelihood of
the registers gives an estimate, and pairs it doesn't rule out are compared on their whole shingle sets.

Buckets aren't paired off. First, each document of a bucket is compared with the bucket's least; links join
groups. Then only buckets with members of several groups go on: their members' registers are compared in
blocks of bounded size, and of the pairs across groups only those go on that the likelihood doesn't rule out.

With 36 bands of 4 registers a link of similarity 0.75 shares no bucket with probability 1e-6.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed, mix64, slices, split_runs, staged
from .graph import components

SHINGLE = 5
#: A link needs 100 * intersection >= 75 * union.
PERCENT = 75
REGISTERS, ROWS = 144, 4
BASE, RATE, TOP = 1.001, 20.0, 65534
#: Estimates have a standard error under 0.04; pairs with one below MAYBE aren't compared on their sets.
MAYBE = 0.58
#: Copies of a pivot that members are compared with in different tasks.
SALTS = 64
#: Members of a bucket whose registers are compared with those of as many others in one step.
BLOCK = 1024

_SEEDS = mix64(np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLY, _ADD = _SEEDS[:REGISTERS] | np.uint64(1), _SEEDS[REGISTERS:]


def shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of runs of `size` words, given their hashes; fewer words make one shingle, none make none."""
    n = max(1, len(h) - size + 1) if len(h) else 0
    s = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        s = mix64(s * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(s)


def _word_sets(texts):
    """For each text of an Arrow array: its words, A-Z lower-cased and joined by a space, as bytes, and its shingles."""
    import pyarrow as pa
    import pyarrow.compute as pc

    ends, codes, found = split_runs(pc.ascii_lower(texts))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.string()).take(pa.array(codes))), " ")
    h = hashed(found)[codes]
    for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        yield joined[k].as_buffer(), shingles(h[a:b])


def sketch(shingle_hashes: np.ndarray) -> np.ndarray:
    """The registers (uint16) of a set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingle_hashes), 512):
        h = shingle_hashes[at : at + 512, None] * _MULTIPLY + _ADD
        np.minimum(least, h.min(axis=0), out=least)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 2.0**-53)) / RATE
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """Keys (uint64) of the bands of sketches, as (sketches, bands)."""
    bands = np.ascontiguousarray(registers.reshape(len(registers), -1)).view(np.uint64) if ROWS == 4 else None
    return mix64(bands + mix64(np.arange(1, bands.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity of pairs of sketches of sets of known sizes: the likeliest on a grid, given in how many registers each is larger."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    grid = np.linspace(0, 1, 201)
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    j = grid[None, :] * np.minimum(u / v, v / u)[:, None]
    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    same = np.clip(1 - up - down, 1e-9, 1)
    likelihood = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + (a.shape[1] - larger - smaller)[:, None] * np.log(same)
    return j[np.arange(len(j)), likelihood.argmax(axis=1)]


def _sketched(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, content (hash of the words), n (shingles) and sketch (binary) of all documents."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in slices(batches, 1):
            content, n, registers = [], [], []
            for words, s in _word_sets(batch.column(1)):
                content.append(xxhash.xxh3_128_digest(words))
                n.append(len(s))
                registers.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(content, pa.binary()), pa.array(n, pa.int64()), pa.array(registers, pa.binary())], ["doc_id", "content", "n", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, "doc_id long, content binary, n long, sketch binary")


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, id, pivot) of the buckets with two members or more; the pivot is the least one."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                r = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(batch.num_rows, REGISTERS)
                keys = band_keys(r).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), keys.shape[1]))], ["key", "id"])

    rows = classes.select("id", "sketch").mapInArrow(run, "key long, id long")
    full = rows.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("most")).where("pivot < most").select("key", "pivot")
    return rows.join(staged(full, "bucket-keys"), "key")  # written, so that a join with a very full bucket can be split


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """pairs (pivot, id) with similar, an estimate, 0 where the sizes rule a link out."""

    def run(batches):
        import pyarrow as pa

        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, REGISTERS) for c in ("sketch", "sketch_p"))
                n, m = (batch.column(c).to_numpy().astype(float) for c in ("n", "n_p"))
                yield pa.RecordBatch.from_arrays([batch.column("pivot"), batch.column("id"), pa.array(np.where(100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m), estimate(a, b, n, m), 0.0))], ["pivot", "id", "similar"])

    of_pivot = classes.select(F.col("id").alias("pivot"), F.col("n").alias("n_p"), F.col("sketch").alias("sketch_p"))
    return pairs.join(classes.drop("items"), "id").join(of_pivot, "pivot").select("pivot", "id", "n", "n_p", "sketch", "sketch_p").mapInArrow(run, "pivot long, id long, similar double")


def _common(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Which of many's values the sorted array one has."""
    return one[np.minimum(np.searchsorted(one, many), len(one) - 1)] == many


def _sets(docs: DataFrame, text: str) -> DataFrame:
    """(id, n, items): the whole shingle sets, as packed 64-bit integers."""

    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, 1):
            sets = [s.tobytes() for _, s in _word_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["id", "items"])

    return docs.select("id", text).mapInArrow(run, "id long, items binary")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (pivot, id) whose whole shingle sets are similar enough.

    A pivot's set goes to SALTS tasks at most, and each member to one of them; a task holds one pivot's set.
    """

    def run(batches):
        import pyarrow as pa

        at, heads = None, []
        for batch in slices(batches, "items"):
            pivots, ids = [], []
            for pivot, salt, member, items in zip(*(batch.column(c).to_pylist() for c in ("pivot", "salt", "id", "items")), strict=True):
                if (pivot, salt) != at:
                    at, heads = (pivot, salt), []
                s = np.frombuffer(items, np.uint64)
                if member is None:
                    heads.append(s)
                    continue
                for p in heads:
                    common = int(_common(p, s).sum())
                    if 100 * common >= PERCENT * (len(p) + len(s) - common):
                        pivots.append(pivot)
                        ids.append(member)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(pivots, pa.int64()), pa.array(ids, pa.int64())], ["pivot", "id"])

    pairs = pairs.select("pivot", "id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"))
    members = pairs.join(sets, "id").select("pivot", "salt", "id", "items")
    heads = pairs.select("pivot", "salt").distinct().join(sets.withColumnRenamed("id", "pivot"), "pivot").select("pivot", "salt", F.lit(None).cast("long").alias("id"), "items")
    rows = members.unionByName(heads).repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", F.col("id").asc_nulls_first())
    return rows.mapInArrow(run, "pivot long, id long").distinct()


def _links_of_block(key: int, rows: list) -> list[tuple[int, int]]:
    """Links across groups between two blocks of a bucket, or within one: (side, id, label, n, sketch, items) each.

    A pair that shares several buckets is looked at in the one of its first common band. Its registers must
    allow the similarity by their likelihood; then the whole sets are compared. Groups that a link joins are one.
    """
    side, ids, labels, n, registers, items = (np.array(x, object) if k == 5 else np.array(x) for k, x in enumerate(zip(*rows, strict=True)))
    registers = np.frombuffer(b"".join(registers.tolist()), np.uint16).reshape(len(rows), REGISTERS)
    bands = registers.view(np.uint64)
    here = int(np.argmax(band_keys(registers[:1])[0].view(np.int64) == key))
    one, two = (np.flatnonzero(side == s) for s in (0, 1 if (side == 1).any() else 0))
    found = []
    for i in one:
        j = two[labels[two] != labels[i]]
        j = j[100 * np.minimum(n[j], n[i]) >= PERCENT * np.maximum(n[j], n[i])]
        j = j[(bands[j] == bands[i]).argmax(axis=1) == here]
        j = j[(registers[j] == registers[i]).sum(axis=1) >= (MAYBE - 0.05) * REGISTERS]
        if not len(j):
            continue
        similar = estimate(np.broadcast_to(registers[i], (len(j), REGISTERS)), registers[j], np.full(len(j), float(n[i])), n[j].astype(float))
        j = j[similar >= MAYBE]
        if not len(j):
            continue
        mine, theirs = np.frombuffer(items[i], np.uint64), [np.frombuffer(items[k], np.uint64) for k in j]
        sizes = np.array([len(t) for t in theirs])
        common = np.add.reduceat(_common(mine, np.concatenate(theirs)).astype(np.int64), np.cumsum(sizes) - sizes)
        for k in j[100 * common >= PERCENT * (len(mine) + sizes - common)]:
            if labels[k] != labels[i]:
                found.append((int(ids[i]), int(ids[k])))
                labels[labels == labels[k]] = labels[i]
    return found


def _linked_in_buckets(live: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Links (pivot, id) between different groups in the buckets of live (key, id, label).

    A bucket is cut into blocks of about `size` members, one with very many shingles counting as several. Large
    groups have blocks of their own, dealt by id, smaller ones share blocks, dealt by label, so no task sees a
    whole bucket; blocks of one and the same group don't meet.
    """

    def run(batches):
        import pyarrow as pa

        def close():
            found = _links_of_block(at[0], rows) if rows else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["pivot", "id"])

        at, rows = None, []
        for batch in slices(batches, "items"):
            columns = (batch.column(c).to_pylist() for c in ("key", "x", "y", "side", "id", "label", "n", "sketch", "items"))
            for key, x, y, *row in zip(*columns, strict=True):
                if (key, x, y) != at:
                    yield close()
                    at, rows = (key, x, y), []
                rows.append(row)
        yield close()

    weighed = staged(live.join(classes.select("id", (1 + F.floor(F.col("n") / 1024)).alias("weight")), "id"), "weights")
    of_group = staged(weighed.groupBy("key", "label").agg(F.sum("weight").alias("own")), "weights")
    of_small = staged(of_group.where(F.col("own") <= size).groupBy("key").agg(F.sum("own").alias("shared")), "weights")
    dealt = lambda c, weight: F.pmod(F.xxhash64(c), F.ceil(F.col(weight) / size))
    block = F.when(F.col("own") > size, F.xxhash64("label", dealt("id", "own"))).otherwise(dealt("label", "shared"))
    blocks = staged(weighed.join(of_group, ["key", "label"]).join(of_small, "key", "left").select("key", "id", "label", block.alias("block")), "blocks")
    groups = blocks.groupBy("key", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    other = groups.select("key", F.col("block").alias("y"), F.col("lo").alias("lo_y"), F.col("hi").alias("hi_y"))
    meet = groups.withColumnRenamed("block", "x").join(other, "key").where("x <= y and (lo < hi or lo_y < hi_y or lo <> lo_y)").select("key", "x", "y")
    left = blocks.join(meet.withColumn("block", F.col("x")), ["key", "block"]).withColumn("side", F.lit(0))
    right = blocks.join(meet.where("x < y").withColumn("block", F.col("y")), ["key", "block"]).withColumn("side", F.lit(1))
    rows = left.unionByName(right).drop("block").join(classes, "id").select("key", "x", "y", "side", "id", "label", "n", "sketch", "items")
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(run, "pivot long, id long").distinct()


def _numbered(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame | None, bool]:
    """docs with _doc, a number of each document; (_doc, of) with the doc_id of each, or None if _doc is doc_id; whether a doc_id is repeated.

    Rows that share a doc_id are one document if their texts are equal. Where a doc_id has several texts, all
    documents get new numbers, in the order of doc_id.
    """
    id_, digest = F.col("doc_id").cast("long"), F.coalesce(F.sha2(F.col(text), 256), F.lit(""))
    named = docs.where("doc_id is not null").select(id_.alias("of"))
    shared = named.groupBy("of").agg(F.count("*").alias("n")).where("n > 1").select("of")
    if shared.isEmpty():
        return docs.withColumn("_doc", id_), None, False
    shared = staged(shared, "shared-ids")
    with_text = docs.where("doc_id is not null").select(id_.alias("of"), digest.alias("digest"))
    if with_text.join(shared, "of").groupBy("of").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x < y").isEmpty():
        return docs.withColumn("_doc", id_), None, True
    of = staged(with_text.distinct().orderBy("of", "digest").withColumn("_doc", F.monotonically_increasing_id()), "documents")
    marked = docs.withColumns({"_of": id_, "_digest": digest})
    marked = marked.join(of.withColumnsRenamed({"of": "_of", "digest": "_digest"}), ["_of", "_digest"], "left").drop("_of", "_digest")
    return marked, of.select("_doc", "of"), True


def link(docs: DataFrame, text: str = "text", block: int = BLOCK) -> DataFrame:
    """What _link tells of each row of docs; rows that share a doc_id but not a text are documents of their own.

    kept compares doc_ids, so of linked rows that share the group's smallest one all are kept; deduplicated() leaves one.
    """
    marked, of, _ = _numbered(docs.select("doc_id", text), text)
    out = _link(marked.select(F.col("_doc").alias("doc_id"), text), text, block)
    if of is None:
        return out
    out = out.join(of.select(F.col("_doc").alias("doc_id"), F.col("of").alias("a")), "doc_id", "left").join(of.select(F.col("_doc").alias("component_id"), F.col("of").alias("b")), "component_id", "left")
    return out.select(F.col("a").alias("doc_id"), "n_shingles", F.col("b").alias("component_id"), F.coalesce(F.col("a") == F.col("b"), F.lit(True)).alias("kept"))


def _link(docs: DataFrame, text: str, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of docs.

    Words lie between white space, A-Z lower-cased; a set has the distinct shingles of 5 words. component_id is
    the smallest doc_id that links of similarity 0.75 reach. Null, empty and white texts have no shingles and
    are linked with nothing; rows with equal words are one class however many they are; a doc_id has one
    text; a null doc_id has a null component and is kept. An empty table gives none.
    """
    rows = staged(_sketched(docs, text), "sketches")
    sets = rows.where("n > 0 and doc_id is not null")
    of_content = staged(sets.groupBy("content").agg(F.min("doc_id").alias("id")), "contents")  # written, so that a join with very many copies can be split
    classes = staged(sets.join(of_content, "content").where("doc_id = id").select("id", "n", "sketch").distinct(), "classes")
    live = staged(_buckets(classes), "buckets")
    ids = live.select("id").distinct()
    items = _sets(docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text).alias("text")).join(ids, "id"), "text")
    classes = staged(classes.join(items.withColumn("n", (F.octet_length("items") / 8).cast("long")), ["id", "n"]).distinct(), "classes")
    sets = classes.select("id", "items")
    pairs = live.where("id <> pivot").select("pivot", "id").distinct()
    similar = _estimated(pairs, classes).where(F.col("similar") >= MAYBE).select("pivot", "id").distinct()
    links = staged(_linked(similar, sets), "links")
    labels = components(links.select(F.col("pivot").alias("a"), F.col("id").alias("b")))
    grouped = live.join(labels.withColumnRenamed("node", "id"), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    mixed = staged(grouped.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key"), "mixed-keys")
    more = staged(_linked_in_buckets(grouped.join(mixed, "key"), classes, block), "links")
    if not more.isEmpty():
        # Groups of the first step are nodes now.
        of = labels.select(F.col("node").alias("pivot"), F.col("label").alias("a")), labels.select(F.col("node").alias("id"), F.col("label").alias("b"))
        edges = more.join(of[0], "pivot", "left").join(of[1], "id", "left").select(F.coalesce("a", "pivot").alias("a"), F.coalesce("b", "id").alias("b"))
        upper = components(edges).select(F.col("node").alias("label"), F.col("label").alias("upper"))
        labels = labels.join(upper, "label", "left").select("node", F.coalesce("upper", "label").alias("label")).unionByName(upper.select(F.col("label").alias("node"), F.col("upper").alias("label"))).distinct()
    out = rows.join(of_content, "content", "left").withColumn("id", F.when(F.col("n") > 0, F.col("id")))
    out = out.join(labels.withColumnRenamed("node", "id"), "id", "left")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs with one document of each group: the smallest doc_id; rows without a doc_id stay.

    A row is dropped for its own text: rows that share a doc_id but not a text are documents of their own. Of
    rows that share both, the one whose columns have the least hash stays, whatever the order of rows.
    """
    marked, _, repeated = _numbered(docs, text)
    gone = _link(marked.select(F.col("_doc").alias("doc_id"), text), text).where("not kept").select(F.col("doc_id").alias("_doc")).distinct()
    kept = marked.join(gone, "_doc", "left_anti")
    if not repeated:
        return kept.select(docs.columns)
    row, order = F.struct(*docs.columns), F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind])
    one = kept.where("_doc is not null").groupBy("_doc").agg(F.min_by(row, order).alias("row")).select("row.*")
    return one.unionByName(kept.where("_doc is null").select(docs.columns))
