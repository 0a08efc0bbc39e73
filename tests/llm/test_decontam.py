import random
import re

import numpy as np

from strata_spark.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    lower = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    items = [(i, lower(t)) for i, t in items]
    for doc_id, text in docs:
        w, hit, ids = lower(text), set(), set()
        for i, item in items:
            n = min(13, len(item))
            for a in range(len(item) - n + 1 if item else 0):
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == item[a : a + n]:
                        hit |= set(range(s, s + n))
                        ids |= {str(i)} if i is not None else set()
        yield doc_id, len(w), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(w)


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()]


def fixture():
    r = random.Random(3)
    w = [f"w{k}é" if k % 5 == 0 else f"W{k}" for k in range(40)]
    items = [(i, " ".join(r.choices(w, k=r.choice([0, 1, 5, 13, 14, 30])))) for i in range(12)]
    items += [(12, items[3][1]), (13, None), (None, "Nobody owns these words here"), (14, "the " * 20), (7, items[7][1])]
    docs = []
    for i in range(40):
        text = r.choices(w, k=r.choice([0, 3, 20, 60]))
        for _ in range(r.choice([0, 1, 2])):
            part = decontam.words(r.choice(items)[1] or "")
            a = r.randrange(len(part) + 1)
            at = r.randrange(len(text) + 1)
            text[at:at] = [x.decode() for x in part[a : a + r.choice([12, 13, 25])]]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(text)))
    return [*docs, (40, None), (41, "the " * 50), (42, "nobody OWNS these words here"), (42, "nobody OWNS these words here")], items


def test_against_brute_force(spark):
    docs, items = fixture()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute(docs, items))
    assert any(x[4] for x in want) and not all(x[4] for x in want)
    assert sorted(rows(decontam.find(d, b))) == want
    for parts in (1, 6):
        assert sorted(rows(decontam.find(d.repartition(parts), b.repartition(3), most_windows=20))) == want  # joined


def test_odd_documents(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "word " * 14), (2, "no id")], "item_id long, text string")
    got = decontam.find(odd_docs, items)
    assert {"score", "source"} < set(got.columns) and got.count() == odd_docs.count()
    assert sorted(r.text[:5] for r in got.where("contaminated").collect()) == ["no id", "word "]
    joined = decontam.find(odd_docs, items, most_windows=0)
    assert joined.columns == got.columns and joined.exceptAll(got).count() == got.exceptAll(joined).count() == 0
    assert decontam.find(no_docs, items).count() == decontam.find(no_docs, items, most_windows=0).count() == 0
    assert decontam.find(odd_docs, items.where("false")).where("contaminated or n_hit > 0").count() == 0


def test_false_hits_of_bit_tables_find_nothing(spark, monkeypatch):
    docs, items = fixture()
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontam, "_bit_table", lambda strings: (12, np.full(64, 2**64 - 1, np.uint64)))
    assert sorted(rows(decontam.find(d, b, most_windows=0))) == sorted(brute(docs, items))


def test_a_large_benchmark(spark):
    r = random.Random(8)
    items = [(i, " ".join(f"v{r.randrange(3000)}" for _ in range(40))) for i in range(2500)]  # 70,000 windows
    docs = [(i, " ".join(f"u{r.randrange(99)}" for _ in range(20)) + " " + " ".join(items[r.randrange(2500)][1].split()[5:25]) + " the end") for i in range(300)]
    got = decontam.find(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(got) == 300 and all((x.n_words, x.n_hit, len(x.item_ids), x.contaminated) == (42, 20, 1, True) for x in got)
