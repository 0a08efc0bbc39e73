import random
import re

import numpy as np

from strata_spark.llm import graph, neardup


def sets(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    s = [sets(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 75 * len(s[i] | s[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(docs))


def fixture(n=240, seed=5):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdefgh", k=4))
    passage = [word() for _ in range(60)]
    texts = []
    for _ in range(n):
        kind = r.random()
        if texts and kind < 0.6:
            w = r.choice(texts).split()
            for _ in range(r.choice([0, 1, 2, 3, 5])):
                if w:
                    w[r.randrange(len(w))] = word()
        elif kind < 0.75:
            w = [word() for _ in range(r.choice([20, 60]))] + passage
        else:
            w = [word() for _ in range(r.choice([1, 3, 5, 40, 120]))]
        texts.append(" ".join(w))
    ids = r.sample(range(10_000), n)
    texts[1], texts[2], texts[3] = "", " \n", texts[0].upper()
    return list(zip(ids, texts, strict=True))


def test_against_brute_force(spark):
    for seed, block in ((5, neardup.BLOCK), (6, 3)):  # buckets in one block, and in several
        docs = fixture(seed=seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        got = sorted(map(tuple, neardup.link(df, block=block).collect()))
        assert got == brute(docs)
        assert len({x[2] for x in got}) < len(docs) - 50


def test_odd_documents(spark, odd_docs, no_docs):
    got = neardup.link(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {(r.component_id, r.kept) for r in got if r.doc_id is None} == {(None, True)}
    assert neardup.link(no_docs).count() == 0
    left = neardup.deduplicated(odd_docs)
    assert left.columns == odd_docs.columns and left.count() == odd_docs.count() - 1


def test_rows_that_share_a_doc_id_but_not_a_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, b), (5, a), (5, b), (5, c), (5, c), (2, c + " end"), (None, b), (7, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = neardup.deduplicated(docs)
    assert left.columns == docs.columns
    assert {tuple(r) for r in left.collect()} == {(3, b), (5, a), (2, c + " end"), (None, b), (7, None), (7, "")}
    assert left.count() == 6
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.link(docs).collect())
    assert got == [(0, 0, True), (2, 2, True), (3, 3, True), (5, 2, False), (5, 2, False), (5, 3, False), (5, 5, True), (7, 7, True), (7, 7, True)]


def test_registers_merge_and_estimate():
    r = np.random.default_rng(0)
    a, b = r.integers(0, 2**63, 3000).astype(np.uint64), r.integers(0, 2**63, 3000).astype(np.uint64)
    both = np.union1d(a[:2000], b[:1000])
    assert (neardup.sketch(both) == np.maximum(neardup.sketch(a[:2000]), neardup.sketch(b[:1000]))).all()
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        n = int(2000 * share * 2 / (1 + share))
        for _ in range(10):
            x = r.integers(0, 2**63, 4000 - n).astype(np.uint64)
            one, two = x[:2000], x[2000 - n :]
            errors.append(neardup.estimate(neardup.sketch(one)[None], neardup.sketch(two)[None], np.array([2000.0]), np.array([2000.0]))[0] - share)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045


def test_components(spark):
    r = random.Random(2)
    chain = [(i, i + 1) for i in range(200, 300)]
    edges = chain + [(7, x) for x in range(20, 60)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(150)] + [(5, 5)]
    got = {x.node: x.label for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(near):
        if node not in want:
            todo = [node]
            while todo:
                x = todo.pop()
                if x not in want:
                    want[x] = node
                    todo += near[x]
    assert got == want


def test_repeated_doc_ids_by_the_contracts_sql(spark):
    import duckdb

    from strata_spark.llm.queries import ORACLE

    a = " ".join(f"w{k}" for k in range(40))
    rows = [(5, a), (5, a + " more"), (5, "quite another text that stands alone here"), (3, "b " + a), (7, a), (7, a), (9, None), (9, ""), (2, "x"), (2, "x")]
    rows = [*rows, (11, " ".join(f"v{k}" for k in range(30))), (11, " ".join(f"v{k}" for k in range(31)))]
    got = sorted(tuple(r) for r in neardup.link(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id", "kept").collect())
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == sorted(c.execute(f"SELECT doc_id, n_shingles, component_id, kept FROM ({ORACLE['op6_near_duplicates']})").fetchall())
