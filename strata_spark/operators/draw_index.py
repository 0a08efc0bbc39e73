"""Bucket counts of exact draws kept as a table, for draws with other fractions and more years."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import digest_sums, digest_text, row_text
from ..sources import publish
from . import sampling


def _source(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df, and an observation of the departments and households that pass: their multiset's digest comes with whatever job reads them."""
    seen = Observation(name)
    n, first, second = digest_sums(row_text(F.col("dept"), F.col("household_id")))
    return df.observe(seen, n.alias("n"), first.alias("first"), second.alias("second")), seen


def _digest(seen: Observation) -> str:
    got = seen.get
    return digest_text(got["n"], got["first"], got["second"])


def _kept(spark: SparkSession, path: str) -> dict[int, dict]:
    """What the index was made from, by year: one small line of JSON each."""
    store = publish.Store(spark, path)
    years = [n for n in store.names(f"{path}/source") if n.startswith("year=")]
    if not years:
        return {}
    rows = spark.read.schema("year int, about string").parquet(f"{path}/source").collect()  # a row a year
    return {r.year: json.loads(r.about) for r in rows}


def ensure(households: DataFrame, path: str, years: range, seed: int, digits: int = sampling.DIGITS) -> DataFrame:
    """(dept, year, bucket, in_bucket) of the years, from the index at path; years that it lacks are counted in one pass and added.

    households has dept and household_id, of the whole country: filters come with the draw. An index of another seed or
    other digits is an error. A year's counts are published before the note that tells of them, so a run that stops
    between the two is repeated. Whether the households are those that were counted tells checked().
    """
    spark, path = households.sparkSession, path.rstrip("/")
    kept = _kept(spark, path)
    for year, about in kept.items():
        if (about["seed"], about["digits"]) != (seed, digits):
            raise ValueError(f"the index at {path} has seed {about['seed']} and {about['digits']} digits for {year}")
    if lacking := [y for y in years if y not in kept]:
        rows, seen = _source(households.select("dept", "household_id"), "counted households")
        publish.write_by_year(sampling.bucket_counts(rows, lacking, seed, digits), f"{path}/counts")
        about = json.dumps({"seed": seed, "digits": digits, "source": _digest(seen)})
        publish.write_by_year(spark.createDataFrame([(y, about) for y in lacking], "year int, about string").coalesce(1), f"{path}/source")
    return spark.read.schema("dept int, bucket string, in_bucket long, year int").parquet(f"{path}/counts").where(F.col("year").isin(*years))


def checked(households: DataFrame, path: str, years: range):
    """households, and a function to call once a job has read all of them: it raises if they aren't those that the index was made from."""
    sources = {about["source"] for y, about in _kept(households.sparkSession, path.rstrip("/")).items() if y in years}
    rows, seen = _source(households, "drawn households")

    def check() -> None:
        if {_digest(seen)} != sources:
            raise ValueError(f"the households have changed since the index at {path} was made")

    return rows, check
