"""Tables laid out once by key, so that draws over them need no exchange by household or dwelling."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import geo, sampling, validate


@dataclass(frozen=True)
class Layout:
    """Names of bucketed tables: homes (households with their dwelling's columns and geography) and persons by household_id, places
    (household, dwelling and geography alone) and dwellings by dwelling_id."""

    homes: str
    persons: str
    places: str
    dwellings: str


def lay_out(dwellings: DataFrame, households: DataFrame, persons: DataFrame, tracts: DataFrame, name: str, buckets: int = 200, folder: str | None = None) -> Layout:
    """Writes the tables <name>_homes, _persons, _places and _dwellings, in `folder` or the warehouse, replacing earlier ones.

    household_id and dwelling_id have to be keys of their tables; repeated ones are an error. Households without a known dwelling or tract
    aren't drawn and go. Each bucket is one sorted file; a household that holds a large share of all persons makes one large
    bucket, so such tables are better left as they are.
    """
    for df, key in ((households, "household_id"), (dwellings, "dwelling_id")):
        if again := validate.repeated_keys(df, key).limit(1).collect():
            raise ValueError(f"{key} {again[0][0]} is there {again[0].n} times")
    homes = households.join(dwellings, "dwelling_id").join(tracts.select("tract_id", *geo.GEO), "tract_id")
    layout = Layout(*(f"{name}_{part}" for part in ("homes", "persons", "places", "dwellings")))
    for table, rows, key in (
        (layout.homes, homes, "household_id"),
        (layout.persons, persons, "household_id"),
        (layout.places, homes.select("household_id", "dwelling_id", "tract_id", *geo.GEO), "dwelling_id"),
        (layout.dwellings, dwellings, "dwelling_id"),
    ):
        writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
        (writer.option("path", f"{folder.rstrip('/')}/{table}") if folder else writer).saveAsTable(table)
    return layout


def cuts(spark: SparkSession, layout: Layout, ratios: DataFrame, frac: float, years: range, seed: int, on_invalid: str = "skip", small: bool = False, counts: DataFrame | None = None) -> DataFrame:
    """Each stratum's threshold, from places; counts are those of a draw index, if there is one."""
    places = spark.table(layout.places)
    counts = sampling.bucket_counts(places, years, seed) if counts is None else counts
    return sampling.thresholds(places, counts, ratios, frac, seed, on_invalid, small)


def flat_sample(spark: SparkSession, layout: Layout, thresholds: DataFrame, seed: int, small: bool = False) -> DataFrame:
    """One row per person of a drawn household, with household, dwelling and geography: a filter of homes and a join within buckets."""
    return sampling.draw_up_to(spark.table(layout.homes), thresholds, seed, small).join(spark.table(layout.persons), "household_id")


def sampled_persons(spark: SparkSession, layout: Layout, thresholds: DataFrame, seed: int, small: bool = False) -> DataFrame:
    """Persons of drawn households, for one year."""
    drawn = sampling.draw_up_to(spark.table(layout.homes).select("household_id", "dept"), thresholds, seed, small)
    return sampling.sampled(spark.table(layout.persons), drawn, "household_id")


def sampled_dwellings(spark: SparkSession, layout: Layout, thresholds: DataFrame, seed: int, small: bool = False) -> DataFrame:
    """Dwellings of drawn households, for one year."""
    return sampling.sampled(spark.table(layout.dwellings), sampling.draw_up_to(spark.table(layout.places), thresholds, seed, small), "dwelling_id")

