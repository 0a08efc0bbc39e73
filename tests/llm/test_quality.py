import numpy as np
import pytest
from pyspark.sql import functions as F

from strata_spark.llm import quality


def test_marginals_against_all_labellings():
    r = np.random.default_rng(0)
    docs = [r.integers(0, quality.FEATURES, (n, 3 * quality.MEASURES)) for n in (1, 4, 3, 4)]
    weights, trans = r.normal(size=quality.FEATURES), r.normal(size=(2, 2))
    chains = quality.Chains(docs)
    p, expected, total = chains.marginals(weights, trans)
    want, moves, logs = [], np.zeros((2, 2)), 0
    for d in docs:
        e = weights[d].sum(axis=1)
        n = len(e)
        paths = [[k >> t & 1 for t in range(n)] for k in range(2**n)]
        w = np.exp([sum(e[t] * x[t] for t in range(n)) + sum(trans[x[t], x[t + 1]] for t in range(n - 1)) for x in paths])
        logs += np.log(w.sum())
        w /= w.sum()
        want += [sum(w[k] for k, x in enumerate(paths) if x[t]) for t in range(n)]
        for k, x in enumerate(paths):
            for t in range(n - 1):
                moves[x[t], x[t + 1]] += w[k]
    assert np.allclose(p, want) and np.allclose(expected, moves) and total == pytest.approx(logs)


def test_held_out_accuracy(spark):
    at = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    model = quality.train(docs, labels)
    rows = quality.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    right = [r.predicted == r.quality for r in rows]
    assert len(right) > 50 and np.mean(right) > 0.93
    again = quality.train(docs.repartition(5), labels.repartition(3))
    assert np.allclose(model.weights, again.weights)


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1, 0), (3, 0, 0), (7, 0, 0), (8, 1, 0), (4, 1, None), (None, 1, 1), (9, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(odd_docs, labels)
    got = quality.score(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality.score(no_docs, model).count() == 0
    assert quality.train(odd_docs, labels.where("false")) is None
    assert {r.predicted for r in quality.score(odd_docs, None).collect()} == {1}


def test_an_oversized_document_is_left_out_alone(spark):
    good, bad = "A quiet line of words that go on.\nAnother one follows it here.", "@@ !! 77 $$ ##\n%% && 88 ((\n@@ !! 77 $$ ##"
    rows = [(i, good + f"\nNumber {i} it is." if i % 2 else bad + f" {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    used = [r.doc_id for r in labels.where(~quality.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).collect()]
    first = used[0]
    huge = spark.createDataFrame([(first, "x\n" * 2000 + "y")], "doc_id long, text string").unionByName(docs.where(F.col("doc_id") != first))
    model = quality.train(huge, labels, most_lines=1000)
    without = quality.train(docs.where(F.col("doc_id") != first), labels, most_lines=1000)
    assert np.allclose(model.weights, without.weights) and np.allclose(model.trans, without.trans)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert min(scores[i] for i in range(60) if i % 2) > max(scores[i] for i in range(60) if i % 2 == 0)
    alone = docs.where("doc_id % 2 = 0").unionByName(spark.createDataFrame([(i, "x\n" * 2000) for i in range(1, 60, 2)], docs.schema))
    with pytest.raises(ValueError, match="1000 lines"):
        quality.train(alone, labels, most_lines=1000)
    again = quality.train(docs.unionByName(docs).unionByName(docs.where("doc_id < 9").selectExpr("doc_id", "concat(text, 'z') as text")), labels)
    assert again is not None


def brute_score(text, model):
    """A document's score from its lines by the definition: all labellings of the chain, weighed by lengths, then the curve."""
    x, sizes = quality.line_features(text)
    emit, n = model.weights[x].sum(axis=1), len(x)
    p, total = np.zeros(n), 0.0
    for k in range(2**n):
        y = [k >> t & 1 for t in range(n)]
        w = np.exp(sum(emit[t] * y[t] for t in range(n)) + sum(model.trans[y[t], y[t + 1]] for t in range(n - 1)))
        total, p = total + w, p + w * np.array(y)
    share = np.clip(1 - (p / total * sizes).sum() / sizes.sum(), 1e-4, 1 - 1e-4)
    return 1 / (1 + np.exp(-(model.slope * np.log(share / (1 - share)) + model.offset)))


def test_scores_by_the_definition(spark):
    r = np.random.default_rng(4)
    model = quality.Model(r.normal(size=quality.FEATURES) / 8, r.normal(size=(2, 2)), 1.3, -0.4)
    texts = ["", "one", "A line.\n\n@@ !! 7\nA line.", "\n\n", *("\n".join("ab 1! " * int(r.integers(0, 9)) for _ in range(n)) for n in (2, 5, 9))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {i: (s, p) for i, s, p in quality.score(docs, model).select("doc_id", "score", "predicted").collect()}
    for i, t in enumerate(texts):
        want = brute_score(t, model)
        assert got[i] == (pytest.approx(want, abs=1e-6), int(round(want, 6) >= quality.GOOD))
