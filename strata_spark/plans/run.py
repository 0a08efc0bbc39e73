"""Whole runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import digest_sums, digest_text, row_text
from ..operators import draw_index, geo, sampling, tabulate, validate
from ..sources import files
from ..spec import SampleSpec

#: Strata (departments times years) up to which they are broadcast; a country has some hundreds of departments.
BROADCAST_STRATA = 100_000
TABULATED = ("tenure", "activity", "sex", "age_bin", "literacy")


def _small(departments: int | None, spec: SampleSpec) -> bool:
    return departments is not None and departments * len(range(*spec.years)) <= BROADCAST_STRATA


def placed(dwellings: DataFrame, households: DataFrame, tracts: DataFrame) -> DataFrame:
    """Households with tract and geography."""
    return geo.attach_geo(geo.with_tract(households, dwellings, "dwelling_id"), tracts)


def draw(dwellings: DataFrame, households: DataFrame, tracts: DataFrame, projections: DataFrame, spec: SampleSpec, departments: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Drawn households with geography and year, and the stratum report, for all years of a spec at once; a lazy plan.

    departments says how many there are at most; where they are few, strata are broadcast, else joined by shuffling.
    """
    homes = placed(dwellings, households, geo.filter_geo(tracts, spec.departments, spec.provinces))
    ratios = sampling.projection_ratios(projections, spec.base_year, spec.years)
    small = _small(departments, spec)
    if spec.method == "bernoulli":
        targets = sampling.stratum_targets(homes, ratios, spec.frac, spec.on_invalid)
        return sampling.draw_bernoulli(homes, targets, spec.seed, small), targets
    counts = sampling.bucket_counts(homes, range(*spec.years), spec.seed)
    return sampling.draw_counted(homes, counts, ratios, spec.frac, spec.seed, spec.on_invalid, small), sampling.report(counts, ratios, spec.frac, spec.on_invalid)


def sample_job(dwellings: DataFrame, households: DataFrame, persons: DataFrame, tracts: DataFrame, projections: DataFrame, spec: SampleSpec, departments: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The flat sample of all years, and the stratum report. Columns that are missing give a warning."""
    _warn(dwellings, households, persons)
    drawn, targets = draw(dwellings, households, tracts, projections, spec, departments)
    return sampling.flatten(drawn, dwellings, persons, tracts), targets


def _warn(dwellings: DataFrame, households: DataFrame, persons: DataFrame) -> None:
    for level, df, known in (("dwelling", dwellings, ()), ("household", households, ("tract_id", "dept")), ("person", persons, ("tract_id",))):
        validate.missing_columns(df, [c for c in validate.REQUIRED[level] if c not in known])  # known: attached on the way


def observed(sample: DataFrame, years: range) -> tuple[DataFrame, Observation]:
    """sample, and an observation that the job which writes it fills: rows and digest sums of each year, in no further pass."""
    seen, row = Observation("sample by year"), row_text(*[F.col(c) for c in sorted(sample.columns) if c != "year"])
    sums = [c.alias(f"{name}{y}") for y in years for c, name in zip(digest_sums(row, F.col("year") == y), ("n", "first", "second"), strict=True)]
    return sample.observe(seen, *(sums or [F.count("*").alias("n")])), seen


def by_year(seen: Observation, years: range) -> dict[int, tuple[int, str]]:
    """Rows and digest of each year."""
    got = seen.get
    return {y: (got[f"n{y}"], digest_text(*(got[f"{name}{y}"] for name in ("n", "first", "second")))) for y in years}


def run_job(spark: SparkSession, census: str, projections: str, tract_reference: str, out: str, spec: SampleSpec, fmt: str = "parquet", departments: str | None = None, provinces: str | None = None, index: str | None = None) -> dict[int, tuple[int, str]]:
    """Reads the census folder and the reference files, draws, and writes sample and manifest below out: Parquet by year, or a named CSV file a year.

    Years written earlier stay, the spec's are replaced. The sample is evaluated once; drawn households, rows and order-free digest are
    observed as they are written, go to the manifest, and the last two are given back by year. Nothing is published unless an exact draw has as many households as asked for. Codes of the spec that the code lists
    departments and provinces (else the tract reference) lack stop the run. index is a folder that keeps the draw's
    bucket counts for other fractions and years; if the households aren't those that were counted, nothing is published.
    """
    tracts = files.read_tract_reference(spark, tract_reference)
    for codes, path, name, column in ((spec.departments, departments, "DPTO", "dept"), (spec.provinces, provinces, "PROV", "prov")):
        if codes:
            wanted = spark.createDataFrame([(c,) for c in codes], "code int")
            validate.known_codes(wanted, files.read_codes(spark, path, name) if path else tracts.select(F.col(column).alias("code")).distinct(), "code")
    dwellings, households, persons = files.read_tables(spark, census)
    _warn(dwellings, households, persons)
    years, wide = range(*spec.years), files.read_projections(spark, projections)
    ratios = sampling.projection_ratios(wide, spec.base_year, spec.years)
    small = _small(wide.count(), spec)  # rows of a small file: departments that can be drawn from
    check, counts, kept = None, None, geo.filter_geo(tracts, spec.departments, spec.provinces)
    if index is not None:
        counts = draw_index.ensure(placed(dwellings, households, tracts), index, years, spec.seed)
        homes, check = draw_index.checked(placed(dwellings, households, tracts), index, years)
        homes = geo.filter_geo(homes, spec.departments, spec.provinces)
        counts = counts.join(kept.select("dept").distinct(), "dept", "left_semi")
    else:
        homes = placed(dwellings, households, kept)
        counts = files.staged(sampling.bucket_counts(homes, years, spec.seed), f"{out.rstrip('/')}/_counts")
    report = sampling.report(counts, ratios, spec.frac, spec.on_invalid)
    if spec.method == "bernoulli":
        drawn = sampling.draw_bernoulli(homes, report, spec.seed, small)
    else:
        drawn = sampling.draw_counted(homes, counts, ratios, spec.frac, spec.seed, spec.on_invalid, small)
    per_year = Observation("drawn households by year")
    drawn = drawn.observe(per_year, F.count("*").alias("n"), *[F.count_if(F.col("year") == y).alias(f"n{y}") for y in years])
    sample, seen = observed(sampling.flatten(drawn, dwellings, persons, tracts), years)

    def before_publishing() -> None:
        if check:
            check()
        wanted = {r.year: r.k for r in report.groupBy("year").agg(F.sum("k").alias("k")).collect()}  # a row a year
        got = per_year.get
        if spec.method == "exact" and (short := [y for y in years if got[f"n{y}"] != wanted.get(y, 0)]):
            raise ValueError(f"other numbers of households than asked for in {', '.join(map(str, short))}")

    if fmt == "csv":
        files.write_named_csv(sample, out, spec, before=before_publishing)
    else:
        files.write_sample(sample, f"{out}/sample", fmt, spec.years, before_publishing)
    found, got = by_year(seen, years), per_year.get
    files.write_manifest(files.with_run(report, {y: (got[f"n{y}"], *v) for y, v in found.items()}), spec, f"{out}/manifest")
    if index is None:
        files.removed(spark, f"{out.rstrip('/')}/_counts")
    return found


def tabulate_job(dwellings: DataFrame, households: DataFrame, persons: DataFrame, bridge: DataFrame) -> DataFrame:
    """One-way tables of adults per circuit, in long form."""
    rows = tabulate.in_circuits(tabulate.adults(persons), geo.with_tract(households, dwellings, "dwelling_id"), bridge)
    return tabulate.one_way_all(rows, TABULATED)
