"""Checks before a run."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that each level needs once geography is attached.
REQUIRED = {"dwelling": ("dwelling_id", "tract_id"), "household": ("household_id", "dwelling_id", "tract_id", "dept"), "person": ("person_id", "household_id", "tract_id")}


def missing_columns(df: DataFrame, required: Sequence[str], strict: bool = False) -> list[str]:
    """Required columns that df lacks; a warning, or an error if strict."""
    missing = [c for c in required if c not in df.columns]
    if missing and strict:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if missing:
        warnings.warn(f"missing columns: {', '.join(missing)}", stacklevel=2)
    return missing


def unknown_codes(requested: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """Requested codes that a code list lacks."""
    return requested.select(code).distinct().join(codes, code, "left_anti")


def known_codes(requested: DataFrame, codes: DataFrame, code: str) -> None:
    """An error that names ten requested codes at most that a code list lacks."""
    if lacking := [str(r[0]) for r in unknown_codes(requested, codes, code).orderBy(code).limit(10).collect()]:
        raise ValueError(f"unknown codes: {', '.join(lacking)}")


def missing_report(levels: dict[str, DataFrame]) -> DataFrame:
    """(level, n_rows, missing): rows of each level's table, and the required columns that it lacks, joined by commas."""
    out = None
    for level, df in levels.items():
        missing = ",".join(c for c in REQUIRED[level] if c not in df.columns)
        one = df.agg(F.count("*").alias("n_rows")).select(F.lit(level).alias("level"), "n_rows", F.lit(missing).alias("missing"))
        out = one if out is None else out.unionByName(one)
    return out


def orphans(children: DataFrame, parents: DataFrame, key: str, name: str) -> DataFrame:
    """(relation, orphans): rows whose parent is missing or null."""
    return children.join(parents.select(key), key, "left_anti").agg(F.count("*").alias("n_orphans")).select(F.lit(name).alias("relation"), "n_orphans")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, such as tracts in several circuits."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
