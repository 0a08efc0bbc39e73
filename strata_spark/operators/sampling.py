"""Stratified household samples whose rate follows population projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import draw_hash, hash01
from .geo import GEO

#: The first so many hex digits of a hash are its bucket; buckets are counted for each stratum.
DIGITS = 2


def projection_ratios(projections: DataFrame, base_year: int, years: tuple[int, int] | None = None) -> DataFrame:
    """(dept, year, ratio) from a wide table with a column per year: the year's population by the base year's.

    A zero or null base gives a null ratio. years is half-open; one without a column is an error.
    """
    known = [c for c in projections.columns if c.isdigit()]
    wanted = known if years is None else [str(y) for y in range(*years)]
    if missing := sorted({*wanted, str(base_year)} - set(known)):
        raise ValueError(f"no projections for {', '.join(missing)}")
    long = projections.select("dept", F.col(str(base_year)).alias("base"), *[F.col(y).cast("double").alias(f"y{y}") for y in wanted])
    if not wanted:
        return long.selectExpr("dept", "cast(null as int) as year", "cast(null as double) as ratio").limit(0)
    out = long.unpivot(["dept", "base"], [f"y{y}" for y in wanted], "year", "population")
    return out.select("dept", F.substring("year", 2, 9).cast("int").alias("year"), F.try_divide("population", F.col("base").cast("double")).alias("ratio"))


def stratum_targets(households: DataFrame, ratios: DataFrame, frac: float, on_invalid: str = "skip") -> DataFrame:
    """(dept, year, n, ratio, rate, k, status): how many households each department gives in each year.

    k is frac * ratio * n, rounded half to even; 0 where the ratio or the rate can't be used. Departments without
    a ratio are absent. With `raise` reading such a stratum stops the job.
    """
    n = households.where("dept is not null").groupBy("dept").agg(F.count("*").alias("n"))
    return _targets(n.join(ratios, "dept"), frac, on_invalid).select("dept", "year", "n", "ratio", "rate", "k", "status")


def _targets(sizes: DataFrame, frac: float, on_invalid: str) -> DataFrame:
    """Adds rate, status and k to rows with n and ratio."""
    out = sizes.withColumn("rate", F.lit(frac) * F.col("ratio"))
    bad_ratio = F.col("ratio").isNull() | F.isnan("ratio") | (F.col("ratio") <= 0)
    bad_rate = (F.col("rate") > 1) | (F.col("rate") < 0)
    out = out.withColumn("status", F.when(bad_ratio, "skipped_invalid_ratio").when(bad_rate, "capped" if on_invalid == "cap" else "skipped_rate_out_of_range").otherwise("ok"))
    k = F.when(F.col("status") == "ok", F.bround(F.lit(frac) * F.col("ratio") * F.col("n"), 0)).when(F.col("status") == "capped", F.col("n")).otherwise(0).cast("long")
    if on_invalid == "raise":
        k = F.when(F.col("status") == "ok", k).otherwise(F.raise_error(F.concat(F.lit("department "), F.col("dept").cast("string"), F.lit(": "), F.col("status"))).cast("long"))
    return out.withColumn("k", k)


def report(counts: DataFrame, ratios: DataFrame, frac: float, on_invalid: str = "skip") -> DataFrame:
    """What stratum_targets() gives, from counted buckets in place of the households."""
    n = counts.groupBy("dept", "year").agg(F.sum("in_bucket").alias("n"))
    return _targets(n.join(ratios, ["dept", "year"]), frac, on_invalid).select("dept", "year", "n", "ratio", "rate", "k", "status")


def _hinted(strata: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(strata) if small else strata


def _bucketed(rows: DataFrame, seed: int, digits: int) -> DataFrame:
    """Adds a household's hash for its year and the part of the hashes' range that it lies in."""
    return rows.withColumn("draw", draw_hash(seed, F.col("year"), F.col("household_id"))).withColumn("bucket", F.substring("draw", 1, digits))


def bucket_counts(households: DataFrame, years: range | list[int], seed: int, digits: int = DIGITS) -> DataFrame:
    """(dept, year, bucket, in_bucket): households of each department by their hash for each year. Depends on no fraction and no ratio."""
    each = F.explode(F.array(*[F.lit(y) for y in years]).cast("array<int>")).alias("year")
    rows = households.where("dept is not null").select("dept", "household_id", each)
    return _bucketed(rows, seed, digits).groupBy("dept", "year", "bucket").agg(F.count("*").alias("in_bucket"))


def _cuts(counts: DataFrame) -> DataFrame:
    """(dept, year, last, rest) from (dept, year, k, bucket, in_bucket): the bucket of the k-th household, and how many of that one are drawn."""
    up_to = F.sum("in_bucket").over(Window.partitionBy("dept", "year").orderBy("bucket"))
    of_stratum = counts.where("k > 0").withColumn("upto", up_to).groupBy("dept", "year", "k").agg(
        F.coalesce(F.min(F.when(F.col("upto") >= F.col("k"), F.col("bucket"))), F.lit("g")).alias("last"),  # g: behind all digits
        F.coalesce(F.sum(F.when(F.col("upto") < F.col("k"), F.col("in_bucket"))), F.lit(0)).alias("taken"),
    )
    return of_stratum.select("dept", "year", "last", (F.col("k") - F.col("taken")).alias("rest"))


def _drawn(households: DataFrame, cuts: DataFrame, seed: int, small: bool, digits: int) -> DataFrame:
    rows = _bucketed(households.join(_hinted(cuts, small), "dept"), seed, digits).where("bucket <= last")
    apart = F.when(F.col("bucket") < F.col("last"), F.col("household_id"))  # taken anyway: spread, not sorted together
    rank = F.row_number().over(Window.partitionBy("dept", "year", apart).orderBy("draw", "household_id"))
    return rows.withColumn("rank", rank).where("bucket < last or rank <= rest").drop("rank", "draw", "bucket", "last", "rest")


def draw_exact(households: DataFrame, targets: DataFrame, seed: int, small: bool = False, digits: int = DIGITS) -> DataFrame:
    """households with year: k of each department and year, the first in the order of their hashes.

    Hashes are counted by stratum and bucket, in partial sums; the sums tell in which bucket the k-th household
    lies. Buckets before it are taken whole and only that one's households are ranked, so no stratum is sorted.
    Exact for any rows: many of one household_id share a bucket. small says that the strata are few (their
    number is bounded); they are broadcast then, and households aren't shuffled by department.
    """
    strata = targets.where("k > 0").select("dept", "year", "k")
    rows = households.select("dept", "household_id").join(_hinted(strata, small), "dept")
    counts = _bucketed(rows, seed, digits).groupBy(*strata.columns, "bucket").agg(F.count("*").alias("in_bucket"))
    return _drawn(households, _cuts(counts), seed, small, digits)


def _counted_targets(counts: DataFrame, ratios: DataFrame, frac: float, on_invalid: str) -> DataFrame:
    sizes = counts.withColumn("n", F.sum("in_bucket").over(Window.partitionBy("dept", "year")))
    return _targets(sizes.join(ratios.select("dept", "year", "ratio"), ["dept", "year"]), frac, on_invalid)


def draw_counted(households: DataFrame, counts: DataFrame, ratios: DataFrame, frac: float, seed: int, on_invalid: str = "skip", small: bool = False, digits: int = DIGITS) -> DataFrame:
    """The same from bucket_counts() of the households with this seed and these digits: one pass over households, whatever frac and the years.

    Of two fractions with the same counts, the smaller one's sample is part of the larger one's.
    """
    return _drawn(households, _cuts(_counted_targets(counts, ratios, frac, on_invalid)), seed, small, digits)


def thresholds(households: DataFrame, counts: DataFrame, ratios: DataFrame, frac: float, seed: int, on_invalid: str = "skip", small: bool = False, digits: int = DIGITS) -> DataFrame:
    """(dept, year, cut): hash and id of each stratum's k-th household, as a struct; only its bucket's households are looked at."""
    cuts = _cuts(_counted_targets(counts, ratios, frac, on_invalid))
    rows = _bucketed(households.select("dept", "household_id").join(_hinted(cuts, small), "dept"), seed, digits).where("bucket = last")
    rank = F.row_number().over(Window.partitionBy("dept", "year").orderBy("draw", "household_id"))
    return rows.withColumn("rank", rank).where("rank = rest").select("dept", "year", F.struct("draw", "household_id").alias("cut"))


def draw_up_to(households: DataFrame, cuts: DataFrame, seed: int, small: bool = False) -> DataFrame:
    """households with year up to each stratum's threshold: a filter, so rows keep their partitioning. household_id has to be unique in a stratum."""
    rows = households.join(_hinted(cuts, small), "dept").withColumn("draw", draw_hash(seed, F.col("year"), F.col("household_id")))
    return rows.where(F.struct("draw", "household_id") <= F.col("cut")).drop("draw", "cut")


def short_strata(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Strata with another number of drawn households than k."""
    got = drawn.groupBy("dept", "year").agg(F.count("*").alias("drawn"))
    return targets.where("k > 0").join(got, ["dept", "year"], "left").where("coalesce(drawn, 0) <> k")


def draw_bernoulli(households: DataFrame, targets: DataFrame, seed: int, small: bool = False) -> DataFrame:
    """households with year: each one by its own hash, so sizes vary around k. Works on streams of households too."""
    usable = targets.where("status in ('ok', 'capped')").select("dept", "year", "rate")
    out = households.join(_hinted(usable, small), "dept").where(hash01(draw_hash(seed, F.col("year"), F.col("household_id"))) < F.col("rate"))
    return out.drop("rate")


def sampled(children: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    """Rows of a table that belong to drawn households, for one year."""
    return children.join(drawn.select(key), key, "left_semi")


def sampled_by_year(children: DataFrame, drawn: DataFrame, key: str) -> DataFrame:
    """The same with year, for several years; households that share a dwelling take it once."""
    return children.join(drawn.select("year", key).distinct(), key)


def flatten(drawn: DataFrame, dwellings: DataFrame, persons: DataFrame, tracts: DataFrame) -> DataFrame:
    """One row per person of a drawn household, with household, dwelling and geography.

    Geography depends on the tract alone and is taken from the drawn households, so a null agglomerate loses no
    rows; where they have none, tracts are joined. Households without persons go.
    """
    placed = {"tract_id", *GEO} <= set(drawn.columns)
    base = drawn if placed else drawn.drop("tract_id", *GEO)
    out = base.join(dwellings.drop("tract_id") if placed else dwellings, "dwelling_id")
    return (out if placed else out.join(tracts.select("tract_id", *GEO), "tract_id")).join(persons, "household_id")


def level_counts(drawn: DataFrame, dwellings: DataFrame, persons: DataFrame) -> DataFrame:
    """(name, n_rows) of drawn households, of those with a dwelling and of the flat sample, from one pass over the draw."""
    homes = dwellings.groupBy("dwelling_id").agg(F.count("*").alias("homes"))
    members = persons.groupBy("household_id").agg(F.count("*").alias("members"))
    rows = drawn.select("household_id", "dwelling_id").join(homes, "dwelling_id", "left").join(members, "household_id", "left").fillna(0, ["homes", "members"])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    one = rows.agg(F.count("*").alias("drawn"), total("homes").alias("with_dwelling"), total(F.col("homes") * F.col("members")).alias("flat"))
    return one.unpivot([], ["drawn", "with_dwelling", "flat"], "name", "n_rows")
