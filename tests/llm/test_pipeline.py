from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strata_spark.llm import decontam, quality
from strata_spark.llm.queries import word_bpe

from .test_decontam import brute as contaminated
from .test_neardup import brute as groups
from .test_secrets import brute as secret_spans

corpus_pipeline = pytest.importorskip("corpus_pipeline")
AT = "/root/testdata/sf0.001"


def test_every_stage(spark):
    docs = spark.read.parquet(f"{AT}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    out = {}
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, f(spark, docs, AT)
        if name != "BPE":
            assert docs.columns == before.columns
        docs = docs.cache()
        out[name] = {r.doc_id: r for r in docs.collect()}
    assert len(stages) == len(out) == 5
    table = spark.read.parquet(f"{AT}/documents.parquet")
    model = quality.train(table, spark.read.parquet(f"{AT}/labels.parquet"))
    good = {r.doc_id: r.text for r in quality.score(table.select("doc_id", "text"), model).where(F.col("score") >= 0.7).collect()}
    assert out["quality classifier"].keys() == good.keys()
    kept = {r[0] for r in groups(list(good.items())) if r[3]}
    assert out["near duplicates"].keys() == kept and len(kept) < len(good)
    items = [tuple(r) for r in spark.read.parquet(f"{AT}/benchmark.parquet").collect()]
    clean = {r[0] for r in contaminated([(i, good[i]) for i in kept], items) if not r[4]}
    assert out["benchmark decontamination"].keys() == clean and len(clean) < len(kept)
    assert out["secret scan"].keys() == out["BPE"].keys() == clean
    for i, r in out["secret scan"].items():
        assert not secret_spans(r.text)[1] and r.n_chars == len(r.text)
        assert (r.text == good[i]) == (not secret_spans(good[i])[1])


def test_empty_tables_and_odd_documents(spark, odd_docs, no_docs, tmp_path):
    for name, f in corpus_pipeline.STAGES:
        got = f(spark, no_docs, AT)
        assert got.count() == 0, name
        assert name == "BPE" or got.columns == no_docs.columns
    got = {name: f(spark, odd_docs, AT).collect() for name, f in corpus_pipeline.STAGES}
    assert len(got["secret scan"]) == len(got["BPE"]) == odd_docs.count()
    same = [r for r in got["near duplicates"] if r.text == "The same row."]
    assert len(same) == 1 and sum(r.text is None for r in got["near duplicates"]) == 1  # null and empty texts stay
    assert len(got["near duplicates"]) == odd_docs.count() - 1


def test_long_texts_pass_the_stages_whole(spark):
    secret = "token=abcdefgh12345678"
    long = " ".join(f"w{k % 9973}x{k % 101}" + (f" {secret} " if k % 200_000 == 7 else "") for k in range(700_000))
    docs = spark.createDataFrame([(0, long, "en", "a", len(long)), (1, long + " and more", "en", "b", len(long) + 9), (2, "short", "en", "a", 5)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    assert sorted(r.doc_id for r in stages["near duplicates"](spark, docs, AT).collect()) == [0, 2]
    assert stages["benchmark decontamination"](spark, docs, AT).count() == 3
    masked = {r.doc_id: r for r in stages["secret scan"](spark, docs, AT).collect()}
    assert masked[0].text == long.replace("abcdefgh12345678", "[SECRET]") and masked[0].n_chars == len(masked[0].text)
    tokens = {r.doc_id: r for r in stages["BPE"](spark, docs, AT).collect()}
    want = Tokenizer.from_file(word_bpe()).encode(long, add_special_tokens=False).ids
    assert tokens[0].n_tokens == len(want) and np.frombuffer(tokens[0].token_ids, "<u4").tolist() == want


def test_a_run_leaves_its_result_only(spark):
    from strata_spark.llm.common import shared_dir

    root = Path(shared_dir(spark).removeprefix("file:"))
    before = set(root.iterdir())
    got = corpus_pipeline.run(spark, AT)
    assert len(set(root.iterdir()) - before) == 1 and got.count() > 0


def test_columns_of_documents_may_have_any_names(spark, odd_docs):
    odd = odd_docs.withColumns({"n_words": F.lit(7), "secrets": F.lit("mine"), "_hits_0": F.lit(1)})
    for name, f in corpus_pipeline.STAGES[:4]:
        got = f(spark, odd, AT)
        assert got.columns == odd.columns, name
        assert got.count() <= odd.count() and {r.n_words for r in got.collect()} <= {7}, name
    assert decontam.WINDOW == 13
