import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strata_spark.llm import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, longest, buckets):
    w = words(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def test_any_run_from_two_prefixes():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["Ab", "z9 ", "É", "\x00", "\x7f", "-", "世界", " ", "İ", " ", "x" * 300, "Z"]) for _ in range(rng.randint(0, 40)))
        for longest in (1, 2, 5):
            assert resample.features(text, longest, 10_000)[1].tolist() == runs(text, longest, 10_000)
            assert resample.features(text, longest, 10_000)[0] == len(words(text))


def test_shifts():
    for zeros in (0, 1, 2, 3, 255, 256, 100_001):
        got = resample.shifted(np.array([0xFFFFFFFF], np.uint32), [zeros])[0] ^ np.uint32(0xFFFFFFFF)
        assert got == zlib.crc32(b"\0" * zeros)


def brute(docs, target, longest=1, buckets=10_000, percent=10):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(runs(text, longest, buckets))
    for text in target:
        t.update(runs(text, longest, buckets))
    big, small = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (small + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        f = runs(text, longest, buckets)
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text)) >= 20])
    long = sorted((r for r in out if r[5]), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for k, r in enumerate(long[: percent * len(long) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())))


def test_small_tables(spark):
    rng = random.Random(2)
    docs = [(i if i % 50 else i // 100, " ".join(rng.choice(["alpha", "Beta", "gamma-delta", "é", "7"]) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (None, "null id " * 30), (1002, "The " * 50_000)]
    target = ["beta beta é", "Gamma", None]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"Rank": F.lit("mine"), "features": F.lit(1), "_place": F.lit(2), "before": F.lit(3)})
    goal = spark.createDataFrame([(t, i) for i, t in enumerate(target)], "text string, doc_id long")
    for longest, buckets, percent in ((1, 10_000, 10), (3, 70_000, 35), (2, 7, 100)):
        got = resample.resample(table.repartition(7), goal, percent, longest, buckets)
        assert rows(got) == sorted(map(str, brute(docs, target, longest, buckets, percent))), longest
        assert got.where("_place = 2").count() == len(docs)
    assert rows(resample.resample(table, goal.where("false"))) == sorted(map(str, brute(docs, [])))
    assert resample.resample(table.where("false"), goal).count() == 0


def test_equal_rows_are_ranked_apart(spark):
    docs = [(5, "same words " * 20)] * 300 + [(i, f"other words {i} " * 20) for i in range(300)]
    got = resample.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame([("same",)], "text string"), 50)
    assert sorted(r.rank for r in got.where("rank is not null").collect()) == list(range(1, 301))
    assert rows(got) == sorted(map(str, brute(docs, ["same"], percent=50)))


def test_whole_table(spark):
    at = "/root/testdata/sf0.01"
    docs, goal = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/benchmark.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in goal.collect()])
    assert rows(resample.resample(docs.select("doc_id", "text"), goal)) == sorted(map(str, want))
