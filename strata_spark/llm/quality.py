"""Document quality by a linear-chain conditional random field over lines.

Each line of a document is good or bad. A line is shown by binned measures of its own characters and words and
by those of the lines before and after it; neighbouring labels have weights too. The chance that a line is bad
given the whole document comes from forward and backward sums; weighted by line lengths these give the
document's share of bad text, and a logistic curve fitted on the same training rows makes it a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import add_columns, remainder

#: Labelled documents that a model is fitted on at most, those with the least hash of doc_id.
TRAINING_DOCUMENTS = 3000
#: Lines of these documents that it is fitted on at most; a document that would exceed them is left out.
TRAINING_LINES = 400_000
#: A document is good from this score on.
GOOD = 0.7
BINS = 8
_WORD, _MARK, _RUN, _ODD_END = re.compile(r"\w+"), re.compile(r"[^\w\s]"), re.compile(r"([^\w\s])\1"), re.compile(r"[^\w\s.,;:?)\"'](?=\s|$)")


def _measures(line: str, times: int) -> tuple:
    """Shares between 0 and 1; the last two are binned as logarithms."""
    n, words = max(1, len(line)), line.split()
    k = max(1, len(words))
    letters = sum(map(str.isalpha, line))
    return (
        letters / n,
        sum(map(str.isupper, line)) / max(1, letters),
        sum(map(str.isdigit, line)) / n,
        len(_MARK.findall(line)) / n * 2,
        len(_RUN.findall(line)) / k,
        len(_ODD_END.findall(line)) / k,
        len(set(words)) / k if words else 1.0,
        line.count(" ") / n * 3,
        sum(map(str.__eq__, words, words[1:])) / k,
        min(1.0, (times - 1) / 3),
        (sum(map(len, words)) / k) / 16,
        np.log2(n) / 12,
        np.log2(k) / 9,
    )


MEASURES = len(_measures("", 1))
FEATURES = 3 * MEASURES * (BINS + 1)


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (lines x 3 * MEASURES) and lengths of a document's lines; no text is one empty line."""
    lines = (text or "").split("\n")
    times: dict[str, int] = {}
    for x in lines:
        times[x] = times.get(x, 0) + 1
    m = np.array([_measures(x, times[x]) for x in lines])
    own = np.minimum(BINS - 1, np.maximum(0, (m * BINS).astype(np.int64)))
    outside = np.full((1, MEASURES), BINS)  # before the first and after the last line
    all_three = np.hstack([own, np.vstack([outside, own[:-1]]), np.vstack([own[1:], outside])])
    return (all_three + np.arange(3 * MEASURES) * (BINS + 1)).astype(np.int16), np.array([len(x) + 1 for x in lines])


@dataclass
class Model:
    """weights of features for `bad`, trans[from, to] of neighbouring labels (0 good, 1 bad), and the curve."""

    weights: np.ndarray
    trans: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def bad_share(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        chains = Chains([d[0] for d in docs])
        p = chains.marginals(self.weights, self.trans)[0]
        share = np.empty(len(docs))
        for k, (a, b) in enumerate(zip(chains.starts[:-1], chains.starts[1:], strict=True)):
            w = docs[k][1]
            share[k] = (p[a:b] * w).sum() / w.sum()
        return share

    def scores(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * _logit(1 - self.bad_share(docs)) + self.offset)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


class Chains:
    """Documents as chains that are worked on side by side, the longest first; lines lie end to end in features."""

    def __init__(self, features: list[np.ndarray]):
        self.features = np.vstack(features)
        sizes = np.array([len(f) for f in features])
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        order = np.argsort(-sizes, kind="stable")
        self.first, self.sizes = self.starts[order], sizes[order]
        self.alive = np.searchsorted(-self.sizes, -np.arange(self.sizes[0]), "left")  # chains with more than t lines

    def marginals(self, weights: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Chance of bad for each line, expected transitions, and the sum of log normalisers."""
        score = weights[self.features].sum(axis=1)
        emit = np.stack([np.zeros_like(score), score], axis=1)
        forward, backward = np.empty_like(emit), np.zeros_like(emit)
        steps = len(self.alive)
        forward[self.first] = emit[self.first]
        for t in range(1, steps):
            at = self.first[: self.alive[t]] + t
            before = forward[at - 1]
            forward[at] = emit[at] + np.logaddexp(before[:, :1] + trans[0], before[:, 1:] + trans[1])
        ends = self.first + self.sizes - 1
        total = np.logaddexp(forward[ends, 0], forward[ends, 1])
        norm = np.empty(len(score))
        expected = np.zeros((2, 2))
        for t in range(steps - 1, -1, -1):
            at = self.first[: self.alive[t]] + t
            norm[at] = total[: self.alive[t]]
            if t + 1 < steps:
                at, z = self.first[: self.alive[t + 1]] + t, total[: self.alive[t + 1]]
                after = emit[at + 1] + backward[at + 1]
                backward[at] = np.logaddexp(trans[:, 0] + after[:, :1], trans[:, 1] + after[:, 1:])
                expected += np.exp(forward[at][:, :, None] + trans + after[:, None, :] - z[:, None, None]).sum(axis=0)
        return np.exp(forward[:, 1] + backward[:, 1] - norm), expected, float(total.sum())


def fit(docs: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, rounds: int = 120, decay: float = 2e-4) -> Model:
    """Likeliest weights, with decay, when all lines have their document's label; then the curve of the scores."""
    chains = Chains([d[0] for d in docs])
    sizes = np.diff(chains.starts)
    bad = np.repeat(1.0 - good, sizes)
    seen = np.array([[((sizes - 1) * good).sum(), 0], [0, ((sizes - 1) * (1 - good)).sum()]])
    weights, trans = np.zeros(FEATURES), np.zeros((2, 2))
    moments = [np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)]
    for k in range(1, rounds + 1):
        p, expected, _ = chains.marginals(weights, trans)
        slope = np.bincount(chains.features.ravel(), np.repeat(bad - p, chains.features.shape[1]), FEATURES)
        g = np.concatenate([slope, (seen - expected).ravel()]) / len(bad) - decay * np.concatenate([weights, trans.ravel()])
        moments = [0.9 * moments[0] + 0.1 * g, 0.99 * moments[1] + 0.01 * g * g]
        step = 0.1 * (moments[0] / (1 - 0.9**k)) / (np.sqrt(moments[1] / (1 - 0.99**k)) + 1e-8)
        weights, trans = weights + step[:-4], trans + step[-4:].reshape(2, 2)
    model = Model(weights, trans)
    x = _logit(1 - model.bad_share(docs))
    a, b = 1.0, 0.0
    for _ in range(100):  # Newton's steps
        q = 1 / (1 + np.exp(-(a * x + b)))
        h = q * (1 - q) + 1e-6
        g = np.array([((good - q) * x).sum() - 0.01 * a, (good - q).sum()])
        m = np.array([[(h * x * x).sum() + 0.01, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        d = np.clip(np.linalg.solve(m, g), -1, 1)
        a, b = a + d[0], b + d[1]
    model.slope, model.offset = float(a), float(b)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from: CRC-32 of doc_id as text leaves 2 when divided by 4."""
    return remainder(doc_id, 4) == 2


def train(docs: DataFrame, labels: DataFrame, text: str = "text", most: int = TRAINING_DOCUMENTS, most_lines: int = TRAINING_LINES) -> Model | None:
    """A model of `most` labelled rows that aren't held out, by the least hash of doc_id; None without labels of both kinds.

    In the same order, documents are taken that fit into most_lines lines with those before them; one that doesn't is left out
    alone. Where there are labels of both kinds but documents of one kind only fit, that is an error. Of rows that share a
    doc_id, the one whose text has the least SHA-256 counts.
    """
    rows = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "quality").distinct()
    chosen = F.broadcast(rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most))  # of so many rows
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select("doc_id", body.alias("text")).join(chosen, "doc_id")
    lines = F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"))) + 1
    sizes = own.select("doc_id", "quality", F.struct(F.sha2("text", 256).alias("digest"), lines.alias("lines")).alias("one")).groupBy("doc_id", "quality").agg(F.min("one").alias("one"))
    fitting, left, kinds = [], most_lines, set()
    for r in sizes.select("doc_id", "quality", "one.*").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").collect():  # a few numbers for each of the chosen
        kinds.add(r.quality)
        if r.lines <= left:
            left -= r.lines
            fitting.append((r.doc_id, r.quality, r.digest))
    if len(kinds) < 2:
        return None
    if len({quality for _, quality, _ in fitting}) < 2:
        raise ValueError(f"no labelled documents of both kinds within {most_lines} lines")
    spark = docs.sparkSession
    taken = spark.createDataFrame(fitting, sizes.select("doc_id", "quality", "one.digest").schema)
    texts = docs.select("doc_id", body.alias("text")).withColumn("digest", F.sha2("text", 256)).join(F.broadcast(taken), ["doc_id", "digest"])
    texts = texts.dropDuplicates(["doc_id", "quality"]).select("doc_id", "quality", "text")
    got = add_columns(texts, "text", "features binary, sizes binary", _packed).select("doc_id", "quality", "features", "sizes").orderBy("doc_id", "quality").toPandas()  # of most_lines lines
    found = [(np.frombuffer(f, np.int16).reshape(-1, 3 * MEASURES), np.frombuffer(s, np.int64)) for f, s in zip(got.features, got.sizes, strict=True)]
    return fit(found, (got.quality == 1).to_numpy(float))


def _packed(texts):
    import pyarrow as pa

    found = [line_features(t) for t in texts.to_pylist()]
    return [pa.array([f.tobytes() for f, _ in found], pa.binary()), pa.array([s.astype(np.int64).tobytes() for _, s in found], pa.binary())]


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds score (0 to 1, higher: better) and predicted (1 from GOOD on) to docs; map side only.

    Null is as empty, which is one empty line. Without a model (no labels of both kinds) all scores are 1.
    Equal texts get equal scores; columns of these names are replaced; an empty table gives an empty table.
    """

    def make(texts):
        import pyarrow as pa

        s = model.scores([line_features(t) for t in texts.to_pylist()]) if model else np.ones(len(texts))
        return [pa.array(np.round(s, 6), pa.float64())]

    return add_columns(docs, text, "score double", make).withColumn("predicted", (F.col("score") >= GOOD).cast("int"))
