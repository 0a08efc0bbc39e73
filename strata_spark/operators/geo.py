"""Geography: tracts of households and persons, departments and provinces, filters, circuits, code labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import zero_filled

GEO = ("dept", "prov", "agglomerate")


def with_tract(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """children with the tract of their parent; those without a parent go."""
    return children.join(parents.select(key, "tract_id"), key)


def attach_geo(df: DataFrame, tracts: DataFrame) -> DataFrame:
    """df with dept, prov and agglomerate of its tract; unknown tracts go. The planner sees the dimension's size."""
    return df.join(tracts.select("tract_id", *GEO), "tract_id")


def filter_geo(df: DataFrame, departments: Sequence[int] | None = None, provinces: Sequence[int] | None = None) -> DataFrame:
    """Rows (of tracts, or of anything with dept and prov) in the departments or provinces; all without either."""
    if departments is not None and provinces is not None:
        raise ValueError("give departments or provinces, not both")
    if departments is not None:
        return df.where(F.col("dept").isin(*departments))
    return df.where(F.col("prov").isin(*provinces)) if provinces is not None else df


def circuit_bridge(circuits: DataFrame, tracts: DataFrame, width: int = 9) -> DataFrame:
    """(tract_id, prov, dept, circuit) from circuits (code, circuit) and tracts with a code; incomplete rows go.

    A tract in several circuits stays in each.
    """
    coded = tracts.select(zero_filled(F.col("code"), width).alias("code"), "tract_id", "prov", "dept")
    out = circuits.select("code", "circuit").join(coded, "code", "left").select(F.col("tract_id").cast("long").alias("tract_id"), "prov", "dept", "circuit")
    return out.dropna()


def labelled(df: DataFrame, codes: DataFrame, code: str, label: str) -> DataFrame:
    """df with a code's label; unknown codes have a null label."""
    return df.join(codes.select(code, label), code, "left")
