"""CSV and Parquet in and out."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from dataclasses import asdict
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import zero_filled
from ..spec import CENSUS, Hierarchy, SampleSpec
from . import publish


#: File names of yearly samples and of tables.
SAMPLE_NAME, TABLE_NAME = "table_f{frac}_{year}_{name}.csv", "agg_circuitos_{variable}.csv"


def read_columns(spark: SparkSession, path: str, types: dict[str, str], sep: str = ",", fmt: str | None = None) -> DataFrame:
    """Named columns of a CSV file with a header, or of Parquet, cast; other columns aren't parsed. Blank codes are null.

    fmt is csv or parquet, by default as the path ends. The header of a CSV file is read as strings first, as a
    schema given to its reader would bind by place, not by name. Columns of Parquet that have their type already
    stay as they are, so filters reach its scan.
    """
    if (fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")) == "parquet":
        df = spark.read.parquet(path)
        there = dict(df.dtypes)
        return df.select(*[F.col(f"`{c}`").alias(c) if there.get(c) == df.select(F.lit(None).cast(t).alias("x")).dtypes[0][1] else F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])
    df = spark.read.option("header", True).option("sep", sep).option("encoding", "utf-8").csv(path)
    return df.select(*[F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")).cast(t).alias(c) for c, t in types.items()])


def read_tables(spark: SparkSession, folder: str, names: tuple[str, str, str] = ("VIVIENDA.csv", "HOGAR.csv", "PERSONA.csv"), hierarchy: Hierarchy = CENSUS, sep: str = ";") -> tuple[DataFrame, ...]:
    """Dwellings, households and persons with the hierarchy's columns under our names."""
    out = []
    for name, columns in zip(names, (hierarchy.dwelling, hierarchy.household, hierarchy.person), strict=True):
        df = read_columns(spark, f"{folder}/{name}", {c: "long" if to.endswith("_id") else "int" for c, to in columns.items()}, sep)
        out.append(df.withColumnsRenamed(columns))
    return tuple(out)


def read_tract_reference(spark: SparkSession, path: str, tract: str = "RADIO_REF_ID", dept: str = "DPTO", prov: str = "PROV", agglomerate: str = "AGLOMERADO") -> DataFrame:
    types = {tract: "long", dept: "int", prov: "int", agglomerate: "int"}
    return read_columns(spark, path, types).toDF("tract_id", "dept", "prov", "agglomerate")


def read_tract_codes(spark: SparkSession, path: str, tract: str = "RADIO_REF_ID", dept: str = "DPTO", prov: str = "PROV_REF_ID", code: str = "radio") -> DataFrame:
    """(tract_id, dept, prov, code) of the tract reference, for circuits: the province by its reference number, the code as text."""
    return read_columns(spark, path, {tract: "long", dept: "int", prov: "int", code: "string"}).toDF("tract_id", "dept", "prov", "code")


def read_circuits(spark: SparkSession, path: str, code: str = "COD_2010", circuit: str = "circuito", width: int = 9) -> DataFrame:
    """(code, circuit) as text; zeros that a spreadsheet has cut off come back."""
    rows = read_columns(spark, path, {code: "string", circuit: "string"}).toDF("code", "circuit")
    return rows.withColumn("code", zero_filled(F.col("code"), width))


def read_codes(spark: SparkSession, path: str, code: str, label: str | None = None) -> DataFrame:
    """(code, label) of a code list such as DPTO, NOMDPTO or PROV, NOMPROV; the label's column is NOM and the code's by default."""
    return read_columns(spark, path, {code: "int", label or f"NOM{code}": "string"}).toDF("code", "label")


def read_projections(spark: SparkSession, path: str, dept: str = "DPTO", name: str | None = "NOMDPTO") -> DataFrame:
    """(dept, dept_name, one column per year) with the years as doubles; dept_name is left out where the file has none."""
    header = spark.read.option("header", True).csv(path).columns
    names = {name: "string"} if name in header else {}
    years = [c for c in header if c.isdigit()]
    return read_columns(spark, path, {dept: "int"} | names | dict.fromkeys(years, "double")).withColumnsRenamed({dept: "dept", name or "": "dept_name"})


def write_sample(sample: DataFrame, folder: str, fmt: str = "parquet", years: tuple[int, int] | None = None, before=None) -> list[int]:
    """folder/year=... for each year of the sample, from one evaluation of it. Years written earlier stay, the same year is replaced.

    years is half-open; those of it that the sample lacks are emptied. before() may raise to leave everything as it was.
    """
    return publish.write_by_year(sample, folder.rstrip("/"), fmt, range(*years) if years else None, before=before)


def write_named_csv(sample: DataFrame, folder: str, spec: SampleSpec, one_file: bool = True, before=None) -> dict[int, str]:
    """table_f{frac}_{year}_{name}.csv for each year of the spec, from one evaluation: one file each, where the file system can join files."""
    names = {year: SAMPLE_NAME.format(frac=spec.frac, year=year, name=spec.name) for year in range(*spec.years)}
    return publish.write_named_files(sample, folder.rstrip("/"), names, one_file, before)


def write_manifest(report: DataFrame, spec: SampleSpec, folder: str) -> None:
    """The manifest as JSON lines, by year; other years' manifests stay."""
    publish.write_by_year(run_manifest(report, spec), folder.rstrip("/"), "json", range(*spec.years))


def write_tables(long_table: DataFrame, folder: str, fmt: str = "csv") -> None:
    """A tabulation in long form, one folder per variable."""
    writer = long_table.write.mode("overwrite").partitionBy("variable")
    (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(folder)


def write_named_tables(long_table: DataFrame, folder: str, variables: tuple[str, ...], name: str = TABLE_NAME, one_file: bool = True) -> dict[str, str]:
    """A tabulation in long form (area, variable, value, n) as one CSV file per variable, from one evaluation; other files stay."""
    odd = [v for v in variables if not v.replace("_", "").isalnum()]
    if odd:
        raise ValueError(f"variables can't name files: {', '.join(odd)}")
    names = {v: name.format(variable=v) for v in variables}
    return publish.write_named_files(long_table.where(F.col("variable").isin(*variables)), folder.rstrip("/"), names, one_file, column="variable")


def run_manifest(report: DataFrame, spec: SampleSpec) -> DataFrame:
    """The stratum report with the run's parameters on each row."""
    return report.withColumns({f"spec_{k}": F.lit(None if v is None else str(v)) for k, v in asdict(spec).items()})


def with_run(report: DataFrame, found: dict[int, tuple[int, int, str]]) -> DataFrame:
    """The stratum report with each year's drawn households, and rows and digest of the sample."""
    pick = lambda k, kind: F.coalesce(*[F.when(F.col("year") == y, F.lit(v[k])) for y, v in found.items()], F.lit(None).cast(kind))
    return report.withColumns({"sample_households": pick(0, "long"), "sample_rows": pick(1, "long"), "sample_digest": pick(2, "string")})


@lru_cache
def _own_folder(application: str) -> str:
    """A folder of one application on one machine, deleted when Python ends."""
    path = tempfile.mkdtemp(prefix="spark-")
    atexit.register(shutil.rmtree, path, True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset on one machine (tests), a folder of this application's own. A cluster has to name one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = _own_folder(spark.sparkContext.applicationId)  # the setting can't be changed in a running session
    return base.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str) -> DataFrame:
    """df written as Parquet and read again, so that several plans share one evaluation."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    publish.Store(spark, path).delete(path)
