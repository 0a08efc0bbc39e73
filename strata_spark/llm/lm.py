"""Language-model scores by deleted interpolation.

Chances of a word after a word are mixed from three estimates: the share of the pair among the context's
occurrences, the word's share of all tokens, and an even share. The mixture's weights depend on how often the
context occurred (by powers of two) and are learnt by expectation maximisation on deleted counts: each training
token is left out of the counts that predict it.

Counting and looking up are exchanges between chunks of documents and parts of the key space. A chunk sends
each part its distinct keys with their counts, packed; a part adds up what all chunks sent and sends back the
sums for the keys of each. So a frequent pair costs one entry per chunk, and no table is held whole anywhere.
Chunks beyond GROUP are dealt to groups. Parts then meet within a group, and what a group has of a part is exchanged
again between the groups, in as many ranges as there are groups: so the number of parts stays, a task reads GROUP
messages at most, or one a group, and messages keep holding many keys.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, hashed, mix64, remainder, split_runs, work_path

#: Text of a chunk; a longer document is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Chunks that exchange counts directly; more of them do so by groups.
GROUP = 4096
#: Keys are sent in six bytes beside their part.
KEY_BYTES = 6
BUCKETS = 40
ROUNDS = 30
_END, _BEGIN = np.uint64(1), np.uint64(2)


def tokens(texts) -> list[np.ndarray]:
    """For each text of an Arrow array: hashes of the words between white space, A-Z lower-cased, and one end."""
    import pyarrow.compute as pc

    ends, codes, found = split_runs(pc.ascii_lower(texts))
    h = hashed(found)[codes]
    return [np.append(h[a:b], _END) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from: CRC-32 of doc_id as text leaves 2 when divided by 7."""
    return remainder(doc_id, 7) == 2


def pair_keys(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(context * np.uint64(0x9E3779B97F4A7C15) + word)


def _pack(a: np.ndarray) -> bytes:
    """Unsigned integers by planes of bytes, so that the mostly empty high bytes compress; 8 planes where 4 don't do."""
    planes = 4 if int(a.max(initial=0)) < 1 << 32 else 8
    return bytes([planes]) + zlib.compress(a.astype(f"<u{planes}").view(np.uint8).reshape(-1, planes).T.tobytes(), 1)


def _unpack(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b[1:]), np.uint8).reshape(b[0], -1).T).view(f"<u{b[0]}").ravel().astype(np.int64)


def _chunks(docs: DataFrame, text: str) -> DataFrame:
    """Chunks: chunk, rows (documents' ids, held-out marks and token numbers, packed) and the keys of the words numbered."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, k, waiting, size = TaskContext.get().partitionId(), 0, [], 0

        def close():
            nonlocal k
            ids, marks, seqs = zip(*waiting, strict=True)
            every = np.concatenate(seqs)
            words, number, count = np.unique(every, return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")  # frequent words get small numbers
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            row = {
                "chunk": pa.array([part << 32 | k], pa.int64()), "ids": pa.array([list(ids)], pa.list_(pa.int64())), "marks": pa.array([list(marks)], pa.list_(pa.bool_())),
                "sizes": pa.array([_pack(np.array([len(s) for s in seqs]))], pa.binary()), "numbers": pa.array([_pack(rank[number])], pa.binary()), "words": pa.array([words[order].tobytes()], pa.binary()),
            }
            k += 1
            waiting.clear()
            return pa.RecordBatch.from_pydict(row)

        for whole in batches:
            for batch in by_bytes(whole, "text", CHUNK_BYTES // 4):
                bytes_ = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
                for doc_id, mark, seq, n in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), tokens(batch.column("text")), bytes_, strict=True):
                    if waiting and size + n > CHUNK_BYTES:
                        yield close()
                        size = 0
                    waiting.append((doc_id, mark, seq))
                    size += n + 16
        if waiting:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("mark"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "chunk long, ids array<long>, marks array<boolean>, sizes binary, numbers binary, words binary")


class _Chunk:
    """A chunk's tokens and its distinct pairs, the same whenever it is read."""

    def __init__(self, row: dict):
        self.ids, self.marks = row["ids"], np.array(row["marks"], bool)
        self.sizes, self.number = _unpack(row["sizes"]).astype(np.int64), _unpack(row["numbers"]).astype(np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        n = len(self.words)
        before = np.concatenate([[n], self.number[:-1]])
        before[np.cumsum(self.sizes)[:-1]] = n  # the begin of a document
        self.before = before
        self.trained = np.repeat(~self.marks, self.sizes)
        pairs, self.pair = np.unique(before * (n + 1) + self.number, return_inverse=True)
        context = np.append(self.words, _BEGIN)[pairs // (n + 1)]
        self.pairs = pair_keys(context, self.words[pairs % (n + 1)])

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of words and of pairs."""
        return np.bincount(self.number[self.trained], minlength=len(self.words)), np.bincount(self.pair[self.trained], minlength=len(self.pairs))


def _deal(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys by part and key, and where each part begins."""
    part = mix64(keys ^ np.uint64(0xA5A5A5A5)) % np.uint64(parts)
    order = np.lexsort((keys, part))
    return order, np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))


def _short(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.view("<u8").ravel()


SENT = "kind int, cell long, sender long, keys binary, n binary"
ANSWERS = "kind int, cell long, sender long, sums binary, tokens long, distinct long"


def _table(ddl: str, rows: list[tuple]):
    """Rows as an Arrow table of these columns."""
    import pyarrow as pa

    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.table({name: pa.array(list(column), types[kind]) for (name, kind), column in zip(fields, zip(*rows, strict=True) if rows else [()] * len(fields), strict=True)})


def _messages(kind: int, keys: np.ndarray, n: np.ndarray, parts: int, first: int, sender: int) -> list[tuple]:
    """What a sender has of its keys, a row for each part with any; cells are numbered from first."""
    order, at = _deal(keys, parts)
    keys, n = keys[order], n[order]
    return [(kind, first + p, sender, _short(keys[a:b]), _pack(n[a:b])) for p, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)) if b > a]


def _added(keys: list[bytes], n: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of some messages, their sums, and where each message's keys stand among them, one after the other."""
    every, where = np.unique(np.concatenate([_long(k) for k in keys]), return_inverse=True)
    return every, np.bincount(where, np.concatenate([_unpack(x) for x in n]), len(every)).astype(np.int64), where


def _answers(kind: int, cell: int, senders: list[int], keys: list[bytes], total: np.ndarray, where: np.ndarray, tokens: int, distinct: int) -> list[tuple]:
    """Each sender's keys' sums in the order sent; tokens and distinct stand at the first row alone."""
    ends = np.cumsum([len(k) // KEY_BYTES for k in keys])
    rows = [(kind, cell, s, _pack(total[where[b - len(k) // KEY_BYTES : b]])) for s, k, b in zip(senders, keys, ends, strict=True)]
    return [(*row, *((0, 0) if i else (tokens, distinct))) for i, row in enumerate(rows)]


def _by_cell(batches):
    """kind, cell, and the lists of senders, keys and counts of each cell; batches are in the order of cells."""
    at, rows = None, []
    for batch in batches:
        for kind, cell, *row in zip(*(batch.column(c).to_pylist() for c in ("kind", "cell", "sender", "keys", "n")), strict=True):
            if (kind, cell) != at:
                if rows:
                    yield *at, *map(list, zip(*rows, strict=True))
                at, rows = (kind, cell), []
            rows.append(row)
    if rows:
        yield *at, *map(list, zip(*rows, strict=True))


def _dealt(sent: DataFrame) -> DataFrame:
    return sent.repartition("kind", "cell").sortWithinPartitions("kind", "cell", "sender")


def _totals(sent: DataFrame) -> DataFrame:
    """ANSWERS: the sums of each cell's keys over all senders, for each sender."""

    def add(batches):
        for kind, cell, senders, keys, n in _by_cell(batches):
            _, total, where = _added(keys, n)
            yield from _table(ANSWERS, _answers(kind, cell, senders, keys, total, where, int(total.sum()), int((total > 0).sum()))).to_batches()

    return _dealt(sent).mapInArrow(add, ANSWERS)


def _sums(chunks: DataFrame, parts: int, groups: int = 1) -> DataFrame:
    """ANSWERS: what the corpus has of the keys a chunk (sender) sent to a part (cell modulo parts), in the order sent.

    tokens and distinct, of words, add up to those of the corpus. With several groups, a group's sums of each part are
    dealt to as many ranges of keys, where the groups' sums meet; the answers come back the same way.
    """

    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row)
                group = int(mix64(np.array([row["chunk"]], np.uint64))[0] % np.uint64(groups))
                for kind, keys, n in zip((0, 1), (chunk.words, chunk.pairs), chunk.counts(), strict=True):
                    yield from _table(SENT, _messages(kind, keys, n, parts, group * parts, row["chunk"])).to_batches()

    sent = chunks.mapInArrow(send, SENT)
    if groups == 1:
        return _totals(sent)

    def merge(batches):
        for kind, cell, _, keys, n in _by_cell(batches):
            every, total, _ = _added(keys, n)
            yield from _table(SENT, _messages(kind, every, total, groups, cell % parts * groups, cell // parts)).to_batches()

    of_groups = _totals(_dealt(sent).mapInArrow(merge, SENT))
    back = of_groups.select("kind", (F.col("sender") * parts + F.expr(f"cell div {groups}")).alias("cell"), (F.col("cell") % groups).alias("range"), "sums", "tokens", "distinct")

    def hand_on(left, right):
        rows, found = left.to_pydict(), right.to_pydict()
        every, total, where = _added(rows["keys"], rows["n"])
        order, at = _deal(every, groups)
        for r, sums in zip(found["range"], found["sums"], strict=True):
            total[order[at[r] : at[r + 1]]] = _unpack(sums)
        return _table(ANSWERS, _answers(rows["kind"][0], rows["cell"][0], rows["sender"], rows["keys"], total, where, sum(found["tokens"]), sum(found["distinct"])))

    return sent.groupBy("kind", "cell").cogroup(back.groupBy("kind", "cell")).applyInArrow(hand_on, ANSWERS)


def _with_counts(row: dict, answers: list[tuple], parts: int):
    """A chunk and its corpus counts, per token: of the context, of the word and of the pair."""
    chunk = _Chunk(row)
    found = []
    for kind, keys in enumerate((chunk.words, chunk.pairs)):
        order, at = _deal(keys, parts)
        n = np.zeros(len(keys), np.int64)
        for k, part, sums in answers:
            if k == kind:
                n[order[at[part] : at[part + 1]]] = _unpack(sums)
        found.append(n)
    word, pair = found
    return chunk, word, word[chunk.number], pair[chunk.pair]


def _blocks(n: int, most: int = 1 << 17):
    """Slices of n tokens, so that the arrays made for each token stay small."""
    return (slice(at, at + most) for at in range(0, n, most))


class Mixture:
    """Weights (buckets x 3) of the pair's, the word's and the even share; contexts is the number of trained documents."""

    def __init__(self, weights: np.ndarray, tokens: int, distinct: int, documents: int):
        self.weights, self.tokens, self.distinct, self.documents = weights, tokens, distinct, documents

    def parts(self, context, word, pair, less: int | np.ndarray = 0):
        """The buckets and the three estimates; less: what the token itself adds to the counts, one number or one for each."""
        context, word, pair = context - less, word - less, pair - less
        seen = np.maximum(context, 1)
        bucket = np.where(context > 0, np.minimum(BUCKETS - 1, 1 + np.log2(seen).astype(np.int64)), 0)
        even = np.full(len(word), 1.0 / (self.distinct + 1))
        return bucket, np.stack([np.where(context > 0, pair / seen, 0.0), word / np.maximum(1, self.tokens - less), even], axis=1)

    def logs(self, context, word, pair, less: int | np.ndarray = 0) -> np.ndarray:
        out, less = np.empty(len(word)), np.broadcast_to(less, len(word))
        for s in _blocks(len(word)):
            bucket, p = self.parts(context[s], word[s], pair[s], less[s])
            out[s] = np.log10((self.weights[bucket] * p).sum(axis=1))
        return out


#: Deleted events are gathered by bucket and by the ratios of their estimates to the even share, in steps of an eighth of a power of two.
STEP, CELLS = 8, 512


def _cells(model: Mixture, context, word, pair) -> tuple[np.ndarray, np.ndarray]:
    """Events' cells and their numbers."""
    out = np.empty(len(word), np.int64)
    for s in _blocks(len(word)):
        bucket, p = model.parts(context[s], word[s], pair[s], less=1)
        with np.errstate(divide="ignore"):
            level = np.where(p[:, :2] > 0, np.clip(np.round(np.log2(p[:, :2] / p[:, 2:]) * STEP), -CELLS // 2 + 1, CELLS // 2 - 1) + CELLS // 2, 0).astype(np.int64)
        out[s] = (bucket * CELLS + level[:, 0]) * CELLS + level[:, 1]
    return np.unique(out, return_counts=True)


def learn(cells: np.ndarray, n: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Expectation maximisation over the gathered events."""
    bucket, two, one = cells // (CELLS * CELLS), cells // CELLS % CELLS, cells % CELLS
    ratio = lambda level: np.where(level > 0, 2.0 ** ((level - CELLS // 2) / STEP), 0.0)
    p = np.stack([ratio(two), ratio(one), np.ones(len(cells))], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        weights = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], axis=1) + 1e-3
        weights /= weights.sum(axis=1, keepdims=True)
    weights[0, 0] = 0  # nothing is known of what follows
    return weights / weights.sum(axis=1, keepdims=True)


def score(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and deleted_score for each row of docs.

    score takes the counts as they are, so the text of a training row, which is in them, looks known. deleted_score
    leaves each token of a training row out of the counts that predict it, as learning does; such scores compare
    with those of held-out rows, where both are equal, and are high where the text occurs elsewhere too.

    Words lie between white space, A-Z lower-cased; each text has an end token; null is as empty. Held-out
    rows are scored but not learnt from; a null doc_id counts as the text "". Repeated rows are counted and
    scored as often as they occur. Without training rows all words are unknown. An empty table gives none.
    Chunks and sums are kept in the shared folder. Words and pairs are told apart by 64-bit hashes, of which 48 bits and the part
    are compared, so counts are exact but for collisions: none is expected below some millions of distinct pairs a part.
    """
    spark = docs.sparkSession
    path, answers_path = work_path(spark, "lm-chunks"), work_path(spark, "lm-sums")
    _chunks(docs, text).write.parquet(path)
    chunks = spark.read.schema("chunk long, ids array<long>, marks array<boolean>, sizes binary, numbers binary, words binary").parquet(path)
    totals = chunks.select(F.sum(F.size("ids")).alias("docs"), F.sum(F.size(F.filter("marks", lambda m: ~m))).alias("trained"), F.count("*").alias("chunks")).first()
    parts = max(1, 2 * min(totals.chunks, GROUP))  # so a part has about as many keys of a group as half a chunk
    _sums(chunks, parts, max(1, math.ceil(totals.chunks / GROUP))).write.parquet(answers_path)
    answers = spark.read.schema(ANSWERS).parquet(answers_path)
    sizes = answers.where("kind = 0").agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    even = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    model = Mixture(even, sizes.n or 0, sizes.v or 0, totals.trained or 0)
    both = chunks.groupBy("chunk").cogroup(answers.select(F.col("sender").alias("chunk"), "kind", (F.col("cell") % parts).cast("int").alias("part"), "sums").groupBy("chunk"))

    def counted(left, right):
        rows, found = left.to_pylist(), right.to_pylist()
        chunk, word, w, pair = _with_counts(rows[0], [(a["kind"], a["part"], a["sums"]) for a in found], parts)
        context = np.append(word, model.documents)[chunk.before]
        return chunk, context, w, pair

    def events(left, right):
        import pyarrow as pa

        chunk, context, word, pair = counted(left, right)
        cells, n = _cells(model, context[chunk.trained], word[chunk.trained], pair[chunk.trained])
        return pa.table({"cell": pa.array(cells, pa.int64()), "n": pa.array(n, pa.int64())})

    def scores(left, right):
        import pyarrow as pa

        chunk, context, word, pair = counted(left, right)
        at = np.cumsum(chunk.sizes) - chunk.sizes
        base = np.log10((word + 1) / (model.tokens + model.distinct + 1))
        plain = model.logs(context, word, pair)
        deleted = model.logs(context, word, pair, less=chunk.trained.astype(np.int64))
        columns = [np.add.reduceat(x, at) for x in ((word > 0).astype(np.int64), base, plain, deleted)]
        arrays = [pa.array(chunk.ids, pa.int64()), pa.array(chunk.marks), pa.array(chunk.sizes, pa.int64()), pa.array(columns[0]), pa.array(np.full(len(at), model.tokens), pa.int64()), pa.array(columns[1]), pa.array(columns[2]), pa.array(columns[3])]
        return pa.table(dict(zip(("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "deleted_score"), arrays, strict=True)))

    gathered = both.applyInArrow(events, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS * CELLS * CELLS rows at most
    if len(gathered):
        gathered = gathered.sort_values("cell")
        model.weights = learn(gathered.cell.to_numpy(), gathered.n.to_numpy(float))
    return both.applyInArrow(scores, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, deleted_score double")
