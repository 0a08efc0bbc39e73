import random

import numpy as np
import pytest

from strata_spark.llm import licenses
from strata_spark.llm.decontam import words


def brute(text):
    w = words(text)
    out = []
    for name, t in licenses.TEMPLATES.items():
        tw = words(t)
        s = {tuple(tw[i : i + 5]) for i in range(len(tw) - 4)}
        most, hit = max(1, len(s) * 5 // 4), False
        for a in range(max(0, len(w) - 4)):
            stretch = {tuple(w[i : i + 5]) for i in range(a, min(a + most, len(w) - 4))}
            hit |= len(stretch & s) >= 0.75 * len(s)
        if hit:
            out.append(name)
    return sorted(out)


def fixture():
    r = random.Random(4)
    docs = []
    for i in range(120):
        w = [f"w{r.randrange(500)}" for _ in range(r.choice([0, 3, 10, 200]))]
        for t in r.sample(list(licenses.TEMPLATES.values()), r.choice([0, 1, 2])):
            t = t.split()
            for _ in range(r.choice([0, 0, 1, 2])):
                t[r.randrange(len(t))] = "changed"
            at = r.randrange(len(w) + 1)
            w[at:at] = t
        docs.append((i, " ".join(w)))
    return docs


def test_against_brute_force(spark):
    docs = fixture()
    got = {r.doc_id: r for r in licenses.described(licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    for i, t in docs:
        assert got[i].names == ",".join(brute(t)), t
    assert sum(g.n_licenses > 0 for g in got.values()) > 30


def test_templates_from_a_table(spark):
    rows = [("b", "one two three four five six"), ("a", "six five four three two one"), ("a", "six five four three two one"), (None, "x"), ("c", None)]
    table = spark.createDataFrame(rows, "name string, text string")
    got = licenses.templates_of(table)
    assert list(got.items()) == [("a", rows[1][1]), ("b", rows[0][1])]
    docs = spark.createDataFrame([(1, "x one two three four five six"), (2, "six five four")], "doc_id long, text string")
    assert {r.doc_id: r.names for r in licenses.described(licenses.scan(docs, templates=got)).collect()} == {1: "b", 2: ""}
    assert [r.names for r in licenses.described(licenses.scan(docs, templates=licenses.templates_of(table.limit(0)))).collect()] == ["", ""]
    with pytest.raises(ValueError, match="one name"):
        licenses.templates_of(spark.createDataFrame([("a", "x"), ("a", "y")], "name string, text string"))


def test_common_templates_are_told_apart(spark):
    rows = [(i, f"before {t} after") for i, t in enumerate(licenses.TEMPLATES.values())]
    got = {r.doc_id: r.names.split(",") for r in licenses.described(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(name in got[i] for i, name in enumerate(licenses.TEMPLATES))
    assert all(sorted(got[i]) == brute(t) for i, t in rows)


def test_spans():
    index = licenses.Index(licenses.TEMPLATES)
    s = licenses.in_order(words("x y z. Released under the MIT License. a b c " * 2))
    k = index.names.index("MIT")
    assert index.candidates(s) >= {k} and index.verify(s, k) == [(3, 8), (14, 19)]
    with pytest.raises(ValueError):
        licenses.Index({"short": "too short"})
    assert len(licenses.in_order(words("a b"))) == 0 and np.all(licenses.block_minima(s[:3]).shape == np.array([1, licenses.BANDS]))


def test_odd_documents(spark, odd_docs, no_docs):
    got = licenses.described(licenses.scan(odd_docs)).collect()
    assert len(got) == odd_docs.count() and all(r.n_licenses == 0 and r.spans == "" for r in got)
    assert licenses.scan(no_docs).count() == 0


def test_spans_by_sql(spark):
    import duckdb

    from strata_spark.llm.queries import ORACLE

    docs = fixture() + [(200, None), (201, ""), (202, "Released under the MIT License. " * 30), (203, "x " * 10 + "Released under the MIT License. y Released under the MIT License."), (202, "twice")]
    got = licenses.described(licenses.scan(spark.createDataFrame(docs, "doc_id long, text string"))).select("doc_id", "n_licenses", "names", "spans").collect()
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert sorted(map(tuple, got)) == sorted(c.execute(ORACLE["op9_licenses"]).fetchall())


def test_tables_of_templates_are_sized_by_their_keys():
    rng = random.Random(6)
    index = licenses.Index({f"t{k}": " ".join(f"w{rng.randrange(10**6)}" for _ in range(4000)) for k in range(6)})
    assert index.bits > 22 and index.there.mean() < 0.13
