"""Counts of categories per small area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import age_bin

AREA = ("prov", "dept", "circuit")


def adults(persons: DataFrame, least: int = 16) -> DataFrame:
    """Persons from an age on, with their age bin."""
    return persons.where(F.col("age") >= least).withColumn("age_bin", age_bin(F.col("age")))


def in_circuits(persons: DataFrame, households: DataFrame, bridge: DataFrame) -> DataFrame:
    """Persons with tenure and each circuit of their household's tract; households carry tract_id."""
    return persons.join(households.select("household_id", "dwelling_id", "tract_id", "tenure"), "household_id").join(bridge, "tract_id")


def one_way(rows: DataFrame, column: str, area: Sequence[str] = AREA) -> DataFrame:
    """Counts per area and value, as <column>_count; null keys are left out."""
    known = rows.dropna(subset=[*area, column])
    return known.groupBy(*area, column).agg(F.count("*").alias(f"{column}_count"))


def one_way_all(rows: DataFrame, columns: Sequence[str], area: Sequence[str] = AREA) -> DataFrame:
    """All one-way tables in one pass: (area, variable, value, n)."""
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns])).alias("v")
    long = rows.dropna(subset=[*area]).select(*area, values).select(*area, "v.variable", "v.value").where("value is not null")
    return long.groupBy(*area, "variable", "value").agg(F.count("*").alias("n"))


#: Cells of a product of area codes and values that completed() makes at most.
MOST_CELLS = 50_000_000


def completed(table: DataFrame, column: str, domain: Sequence[str], product: bool = False, area: Sequence[str] = AREA, most_cells: int = MOST_CELLS) -> DataFrame:
    """A one-way table with zeros for values that an area lacks; with product, for every combination of area codes too.

    The product's cells are numbered, a digit for each column's code; numbers that the table lacks are decoded and added. Over
    most_cells it is an error, before a cell is made.
    """
    count = f"{column}_count"
    if not product:
        cells = table.select(*area).distinct().withColumn(column, F.explode(F.array(*map(F.lit, domain))))
        return cells.join(table, [*area, column], "left").fillna(0, [count])
    spark, lists, total = table.sparkSession, [], 1
    for c in area:
        codes = sorted(r[0] for r in table.select(c).distinct().limit(most_cells // max(1, total) + 1).collect())  # a code list of at most so many
        lists.append((c, codes))
        total *= len(codes)
        if total * len(domain) > most_cells:
            raise ValueError(f"more than {most_cells} cells")
    lists.append((column, list(domain)))
    cells, present, weight = spark.range(total * len(domain)).toDF("_cell"), table.where(F.col(column).isin(*domain)), 1
    inside, number = present, F.lit(0).cast("long")
    for c, codes in reversed(lists):  # the last column is the lowest digit
        pairs = F.broadcast(spark.createDataFrame(list(enumerate(codes)), f"_{c} long, {c} {table.schema[c].dataType.simpleString()}"))  # at most most_cells, checked
        cells = cells.withColumn(f"_{c}", F.expr(f"_cell div {weight} % {max(1, len(codes))}")).join(pairs, f"_{c}").drop(f"_{c}")
        inside, number = inside.join(pairs, c), number + F.col(f"_{c}") * weight
        weight *= len(codes)
    absent = cells.join(inside.select(number.alias("_cell")), "_cell", "left_anti").select(*area, column, F.lit(0).cast("long").alias(count))
    return present.select(*area, column, count).unionByName(absent)


def joint(rows: DataFrame, columns: Sequence[str], area: Sequence[str] = ("prov", "circuit")) -> DataFrame:
    """Counts per area and combination of values; null keys are left out."""
    return rows.dropna(subset=[*area, *columns]).groupBy(*area, *columns).agg(F.count("*").alias("n"))


def frequency(rows: DataFrame, column: str) -> DataFrame:
    """Values by falling number of rows; null is left out."""
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


#: Parts of a column's range whose rows are counted before values are looked at.
PARTS = 1024


def quantiles(rows: DataFrame, column: str, shares: Sequence[float] = (0.0, 0.3333, 0.6666, 1.0), by: Sequence[str] = (), parts: int = PARTS) -> DataFrame:
    """(by, share, value): exact quantiles of a numeric column, interpolated, for each area; null and NaN values and null areas are left out.

    By counted selection: equal values are counted, their numbers summed by parts of the range, and values are looked at only in
    the parts in which the ranks lie. No area's values meet in one buffer; an area's largest sorted run is one part.
    """
    value, by = F.col(column).cast("double"), list(by)
    counts = rows.dropna(subset=by) if by else rows
    counts = counts.select(*by, value.alias("_v")).where("_v is not null and not isnan(_v)").groupBy(*by, "_v").agg(F.count("*").alias("_n"))
    span = counts.groupBy(*by).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.sum("_n").alias("_all"))
    if by:
        counts = counts.join(span, by)
    else:
        counts = counts.withColumns({c: span.select(c).scalar() for c in ("_low", "_high", "_all")})
    width = F.col("_high") - F.col("_low")
    part = F.when((width > 0) & (width < float("inf")), F.least(F.lit(parts - 1), F.floor((F.col("_v") - F.col("_low")) / width * parts))).otherwise(0)
    counts = counts.withColumn("_part", part.cast("int"))
    up_to = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part"))  # PARTS rows an area at most
    sums = counts.groupBy(*by, "_part", "_all").agg(F.sum("_n").alias("_n")).withColumn("_upto", up_to)
    at = [(F.col("_all") - 1) * F.lit(q) for q in shares]
    ranks = F.array(*[F.struct(F.lit(float(q)).alias("share"), f(x).cast("long").alias("rank"), (x - F.floor(x)).alias("over"), F.lit(high).alias("high")) for q, x in zip(shares, at, strict=True) for f, high in ((F.floor, False), (F.ceil, True))])
    wanted = sums.withColumn("_r", F.explode(ranks)).where("_r.rank < _upto and _r.rank >= _upto - _n").select(*by, "_part", (F.col("_r.rank") - F.col("_upto") + F.col("_n")).alias("_rank"), "_r.share", "_r.over", "_r.high")
    keys = [*by, "_part"]
    within = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_v"))
    looked_at = counts.select(*keys, "_v", "_n").join(wanted.select(*keys).distinct(), keys, "left_semi").withColumn("_upto", within)
    found = looked_at.join(wanted, keys).where("_rank < _upto and _rank >= _upto - _n")
    ends = found.groupBy(*by, "share", "over").agg(F.max(F.when(~F.col("high"), F.col("_v"))).alias("_a"), F.max(F.when(F.col("high"), F.col("_v"))).alias("_b"))
    out = ends.select(*by, "share", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("over")).alias("value"))
    if by:
        return out
    return rows.sparkSession.createDataFrame([(float(q),) for q in shares], "share double").distinct().join(out, "share", "left")


def with_projection(table: DataFrame, projections: DataFrame) -> DataFrame:
    """A table with its department's projections; departments without any have nulls."""
    return table.join(projections, "dept", "left")
