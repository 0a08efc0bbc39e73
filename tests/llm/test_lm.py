import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from strata_spark.llm import lm


def words(t):
    return [w.lower() for w in (t or "").replace("\r", " ").split(" ") if w] + [None]


def fixture(n=150):
    r = random.Random(1)
    v = [f"W{int(r.paretovariate(0.6)) % 400}" for _ in range(4000)]
    docs = [(i, " ".join(v[k : k + r.choice([0, 1, 5, 40])])) for i, k in enumerate(r.choices(range(3900), k=n))]
    return [*docs, (n, None), (n + 1, "unseen words only"), (n + 1, "unseen words only")]


def trained(i):
    return zlib.crc32(str(i).encode()) % 7 != 2


def test_base_against_brute_force_and_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 600)
    docs = fixture()
    got = lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    c = Counter(w for i, t in docs if trained(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = {(i, not trained(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in docs}
    assert {(*r[:5], round(r.base_score, 6)) for r in got} == want and len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)

    pairs, context = Counter(), Counter()
    for i, t in docs:
        if trained(i):
            for a, b in zip(["<begin>", *words(t)], words(t), strict=False):
                pairs[a, b] += 1
                context[a] += 1
    weights = learnt(docs, c, n, v, pairs, context)
    for r in got[:60]:
        text = dict(docs)[r.doc_id]
        total = 0
        for a, b in zip(["<begin>", *words(text)], words(text), strict=False):
            k = 0 if not context[a] else 1 + int(math.log2(context[a]))
            total += math.log10(weights[k][0] * (pairs[a, b] / context[a] if context[a] else 0) + weights[k][1] * c[b] / n + weights[k][2] / (v + 1))
        assert r.score == pytest.approx(total, abs=1e-6)


def test_deleted_scores_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 600)
    docs = fixture(80)
    got = lm.score(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    c = Counter(w for i, t in docs if trained(i) for w in words(t))
    n, v, pairs, context = sum(c.values()), len(c), Counter(), Counter()
    for i, t in docs:
        if trained(i):
            for a, b in zip(["<begin>", *words(t)], words(t), strict=False):
                pairs[a, b] += 1
                context[a] += 1
    weights = learnt(docs, c, n, v, pairs, context)
    for r in got:
        less, total, text = int(trained(r.doc_id)), 0, dict(docs)[r.doc_id]
        for a, b in zip(["<begin>", *words(text)], words(text), strict=False):
            m = context[a] - less
            k = 1 + int(math.log2(m)) if m else 0
            total += math.log10(weights[k][0] * ((pairs[a, b] - less) / m if m else 0) + weights[k][1] * (c[b] - less) / (n - less) + weights[k][2] / (v + 1))
        assert r.deleted_score == pytest.approx(total, abs=1e-6)
        assert not r.held_out or r.deleted_score == r.score


def test_groups_of_chunks_exchange_the_same_sums(spark, monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 600)
    docs = spark.createDataFrame(fixture(), "doc_id long, text string").repartition(3)
    rows = lambda: sorted(tuple(r) for r in lm.score(docs).collect())
    alone = rows()
    parts = {}
    for group in (1, 4, 9):
        monkeypatch.setattr(lm, "GROUP", group)
        with monkeypatch.context() as m:
            m.setattr(lm, "_sums", lambda chunks, n, groups, of=lm._sums: parts.update({group: (n, groups)}) or of(chunks, n, groups))
            got = rows()
        assert [r[:5] for r in got] == [r[:5] for r in alone]
        assert np.allclose([r[5:] for r in got], [r[5:] for r in alone])
    assert all(n == 2 * group and groups > 1 for group, (n, groups) in parts.items())


def test_texts_that_occur_twice_have_higher_deleted_scores(spark):
    r = random.Random(8)
    docs = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(60))) for i in range(200)]
    docs += [(200 + i, docs[i][1]) for i in range(20)]
    got = lm.score(spark.createDataFrame(docs, "doc_id long, text string"))
    once, twice = [x.deleted_score for x in got.where("doc_id between 20 and 199").collect()], []
    for x in got.where("doc_id < 20 or doc_id >= 200").collect():
        if trained(x.doc_id) and trained((x.doc_id + 200) % 400 if x.doc_id < 20 else x.doc_id - 200):
            twice.append(x.deleted_score)
    assert len(twice) >= 20 and min(twice) > max(once)


def learnt(docs, c, n, v, pairs, context):
    model = lm.Mixture(None, n, v, 0)
    events = [(context[a], c[b], pairs[a, b]) for i, t in docs if trained(i) for a, b in zip(["<begin>", *words(t)], words(t), strict=False)]
    return lm.learn(*[x.astype(float) if k else x for k, x in enumerate(lm._cells(model, *np.array(events).T))])


def test_weights_raise_the_likelihood_of_deleted_events():
    cells = np.array([(3 * lm.CELLS + 300) * lm.CELLS + 260, (3 * lm.CELLS) * lm.CELLS + 250, (3 * lm.CELLS) * lm.CELLS])
    w = lm.learn(cells, np.array([70.0, 20.0, 10.0]))
    assert np.allclose(w.sum(axis=1), 1) and w[3, 0] > 0.5 > w[3, 1] and w[0, 0] == 0


def test_chances_add_up_to_one():
    m = lm.Mixture(np.tile([0.5, 0.3, 0.2], (lm.BUCKETS, 1)), 10, 4, 3)
    word, pair = np.array([4, 3, 2, 1, 0]), np.array([3, 0, 1, 0, 0])
    p = 10 ** m.logs(np.full(5, 4), word, pair)
    assert p.sum() == pytest.approx(1)


def test_odd_documents(spark, odd_docs, no_docs):
    got = lm.score(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.score(no_docs).count() == 0
