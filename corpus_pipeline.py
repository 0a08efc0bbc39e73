"""A corpus pipeline: stages that each work on all that the one before kept.

Every stage takes any table with the columns of documents and leaves other columns as they are, whatever their names. An empty table
gives an empty one; texts of any length are taken whole; rows aren't told apart by their order or partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata_spark.llm import bpe, decontam, neardup, quality, secrets
from strata_spark.llm.common import cleared, work_path
from strata_spark.llm.queries import _table, word_bpe


def _apart(docs: DataFrame, operator) -> DataFrame:
    """operator(docs) with docs' columns that it doesn't need under other names meanwhile, so that none clash with its own."""
    names = {c: f"_kept_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    return operator(docs.withColumnsRenamed(names)).select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good; it learns from the labelled ones of docs.

    A null text is judged as an empty one, repeated rows alike. Without labels of both kinds all documents stay.
    """
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return _apart(docs, lambda d: quality.score(d, model).where("predicted = 1"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id.

    Texts without words, null ones among them, are duplicates of nothing; rows without a doc_id stay; of repeated rows one stays.
    """
    return neardup.deduplicated(docs).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark; null texts and all are clean if it is empty. Repeated rows are judged alike."""
    return _apart(docs, lambda d: decontam.find(d, _table(spark, sf_dir, "benchmark")).where("not contaminated"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars follows, but for null and empty texts. A null source is an owner of its own."""
    out = _apart(docs, lambda d: secrets.masked(secrets.scan(d)))
    size = F.when(F.length("text") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids and the digest of what they decode to; a null or empty text has no tokens."""
    out = bpe.encode(docs.select("doc_id", "lang", "source", "text"), word_bpe(), and_decode=True)
    return out.select("doc_id", "lang", "source", "n_tokens", "token_ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", good_documents),
    ("near duplicates", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("BPE", tokens),
]

#: The classifier is fitted in floating point and the tokenizer's merges aren't SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written to the shared folder and read again; only the last one's table stays there."""
    last = work_path(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    with cleared(spark):
        for k, (name, stage) in enumerate(STAGES, 1):
            path = last if k == len(STAGES) else work_path(spark, "pipeline-" + name.replace(" ", "-"))
            with cleared(spark):
                out = stage(spark, docs, sf_dir)
                out.write.parquet(path)
            docs = spark.read.schema(out.schema).parquet(path)
    return docs
