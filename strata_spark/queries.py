"""Queries over the star-schema tables seen as a hierarchy, and the same in SQL.

dwelling = customer, household = orders, person = lineitem; a tract is a nation and a digit of the customer's
key, a department is a nation, a province a region; projections are orders per nation and year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import digest_sums, row_text, zero_filled
from .operators import draw_index, geo, layout, sampling, tabulate, validate
from .plans import TABULATED, draw, sample_job
from .sources.files import work_path
from .spec import SampleSpec

BASE, YEARS, SEED, FRAC = 1995, tuple(range(1995, 2002)), 7, 0.05
ONE_YEAR = SampleSpec(frac=FRAC, years=(1998, 1999), base_year=BASE, seed=SEED)
ALL_YEARS = SampleSpec(frac=FRAC, years=(1996, 2002), base_year=BASE, seed=SEED)


class Tables:
    """The hierarchy of a folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def dwelling(self):
        return self.read("customer").selectExpr("cast(c_custkey as long) dwelling_id", "cast(c_nationkey * 10 + c_custkey % 10 as long) tract_id", "c_mktsegment housing_type")

    @property
    def household(self):
        return self.read("orders").selectExpr("cast(o_orderkey as long) household_id", "cast(o_custkey as long) dwelling_id", "o_orderpriority tenure", "o_orderstatus rooms")

    @property
    def person(self):
        return self.read("lineitem").selectExpr("cast(l_orderkey as long) household_id", "cast(l_linenumber as long) person_no", "cast(l_quantity as int) age", "l_returnflag sex", "l_linestatus activity", "cast(l_linenumber % 2 as int) literacy")

    @property
    def tract(self):
        digits = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("d")
        rows = self.read("nation").select("n_nationkey", "n_regionkey", digits)
        return rows.selectExpr("cast(n_nationkey * 10 + d as long) tract_id", "cast(n_nationkey as int) dept", "cast(n_regionkey as int) prov", "cast(nullif(n_nationkey % 3, 0) as int) agglomerate")

    @property
    def projection(self):
        orders = self.read("orders").selectExpr("o_custkey c_custkey", "cast(year(o_orderdate) as int) year")
        by_year = orders.join(self.read("customer").selectExpr("c_custkey", "cast(c_nationkey as int) dept"), "c_custkey")
        return by_year.groupBy("dept").agg(*[F.sum(F.when(F.col("year") == y, 1).otherwise(0)).cast("double").alias(str(y)) for y in YEARS])

    @property
    def bridge(self):
        codes = self.read("supplier").selectExpr("cast(s_nationkey * 10 + s_suppkey % 10 as string) code", "cast(s_suppkey % 4 as string) circuit").withColumn("code", zero_filled(F.col("code"))).distinct()
        return geo.circuit_bridge(codes, self.tract.withColumn("code", F.col("tract_id").cast("string")))

    @property
    def placed(self):
        return geo.attach_geo(geo.with_tract(self.household, self.dwelling, "dwelling_id"), self.tract)

    @property
    def adults_in_circuits(self):
        return tabulate.in_circuits(tabulate.adults(self.person), geo.with_tract(self.household, self.dwelling, "dwelling_id"), self.bridge)

    def ratios(self, years=None):
        return sampling.projection_ratios(self.projection, BASE, years)

    @property
    def departments(self):
        """How many there are; from the file's footer."""
        return self.read("nation").count()

    def drawn(self, spec: SampleSpec) -> DataFrame:
        return draw(self.dwelling, self.household, self.tract, self.projection, spec, self.departments)[0]


def _sample(spec):
    return lambda t: t.drawn(spec).select("household_id", "dwelling_id", "dept", "year")


def _wide_ratios(t):
    return t.projection.select("dept", *[F.try_divide(F.col(str(y)), F.col(str(BASE))).alias(f"r{y}") for y in YEARS])


FLAT = ["year", "household_id", "dwelling_id", "tract_id", "dept", "prov", "agglomerate", "housing_type", "tenure", "rooms", "person_no", "age", "sex", "activity", "literacy"]


def _flat(t):
    return sample_job(t.dwelling, t.household, t.person, t.tract, t.projection, ONE_YEAR, t.departments)[0].select(*FLAT)


def _indexed(t):
    """Two draws from one index of bucket counts: the years of ALL_YEARS at half its fraction, after 1998 was counted alone."""
    path, homes = work_path(t.spark, "draw-index"), t.placed
    draw_index.ensure(homes, path, range(1998, 1999), SEED)
    counts = draw_index.ensure(homes, path, range(*ALL_YEARS.years), SEED)
    small = sampling.draw_counted(homes, counts, t.ratios(ALL_YEARS.years), FRAC / 2, SEED, small=True)  # 25 departments
    return small.select("household_id", "dwelling_id", "dept", "year")


def _laid_out(t):
    folder = work_path(t.spark, "layout")
    tables = layout.lay_out(t.dwelling, t.household, t.person, t.tract, folder.rpartition("/")[2].replace("-", "_"), 16, folder)
    cuts = layout.cuts(t.spark, tables, t.ratios(ALL_YEARS.years), FRAC, range(*ALL_YEARS.years), SEED, small=True)
    return layout.flat_sample(t.spark, tables, cuts, SEED, small=True).select(*FLAT)


def _digests(t):
    flat = sample_job(t.dwelling, t.household, t.person, t.tract, t.projection, ALL_YEARS, t.departments)[0]
    n, first, second = digest_sums(row_text(*[F.col(c) for c in sorted(FLAT) if c != "year"]))
    return flat.groupBy("year").agg(n.alias("n_rows"), first.cast("string").alias("first"), second.cast("string").alias("second"))


def _row_counts(t):
    return sampling.level_counts(t.drawn(ONE_YEAR), t.dwelling, t.person)


def _orphans(t):
    names = (t.household, t.dwelling, "dwelling_id", "household"), (t.person, t.household, "household_id", "person"), (t.dwelling, t.tract, "tract_id", "dwelling")
    out = [validate.orphans(*x) for x in names]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _labels(t):
    codes = geo.labelled(t.tract.groupBy("dept", "prov").agg(F.count("*").alias("n_tracts")), t.read("nation").selectExpr("cast(n_nationkey as int) dept", "n_name dept_name"), "dept", "dept_name")
    return geo.labelled(codes, t.read("region").selectExpr("cast(r_regionkey as int) prov", "r_name prov_name"), "prov", "prov_name")


_QUERIES = {
    "projection_ratios_wide": _wide_ratios,
    "projection_ratios_long": lambda t: t.ratios(),
    "household_tract": lambda t: geo.with_tract(t.household, t.dwelling, "dwelling_id").select("household_id", "tract_id"),
    "person_tract": lambda t: geo.with_tract(t.person, geo.with_tract(t.household, t.dwelling, "dwelling_id"), "household_id").groupBy("tract_id").agg(F.count("*").alias("n_persons"), F.sum("age").alias("sum_age")),
    "dwelling_geo": lambda t: geo.attach_geo(t.dwelling, t.tract).select("dwelling_id", "tract_id", "dept", "prov", "agglomerate"),
    "household_geo": lambda t: t.placed.select("household_id", "tract_id", "dept", "prov", "agglomerate"),
    "person_geo": lambda t: geo.with_tract(t.person, t.placed.select("household_id", "tract_id"), "household_id").join(t.tract, "tract_id").groupBy("prov", "dept", "agglomerate").agg(F.count("*").alias("n_persons")),
    "filter_departments": lambda t: geo.filter_geo(t.placed, departments=[3, 7, 11]).select("household_id", "dept"),
    "filter_provinces": lambda t: geo.filter_geo(t.placed, provinces=[1, 4]).select("household_id", "prov"),
    "filter_year_range": lambda t: t.ratios((1996, 1999)),
    "stratum_targets": lambda t: sampling.stratum_targets(t.placed, t.ratios((1996, 2002)), 0.9),
    "sample_exact": _sample(ONE_YEAR),
    "sample_exact_multi_year": _sample(ALL_YEARS),
    "sample_exact_filtered": _sample(SampleSpec(frac=FRAC, years=(1998, 1999), base_year=BASE, seed=SEED, provinces=(2,))),
    "sample_bernoulli": _sample(SampleSpec(frac=FRAC, years=(1996, 2002), base_year=BASE, seed=SEED, method="bernoulli")),
    "sampled_households": lambda t: sampling.sampled(t.household, t.drawn(ONE_YEAR), "household_id"),
    "sampled_persons": lambda t: sampling.sampled(t.person, t.drawn(ONE_YEAR), "household_id"),
    "sampled_dwellings": lambda t: sampling.sampled(t.dwelling, t.drawn(ONE_YEAR), "dwelling_id"),
    "sampled_dwellings_multi_year": lambda t: sampling.sampled_by_year(t.dwelling, t.drawn(ALL_YEARS), "dwelling_id").select("year", "dwelling_id", "housing_type"),
    "flat_sample": _flat,
    "flat_sample_row_counts": _row_counts,
    "draw_bucket_counts": lambda t: sampling.bucket_counts(t.placed, range(*ALL_YEARS.years), SEED),
    "sample_exact_indexed": _indexed,
    "flat_sample_laid_out": _laid_out,
    "sample_digest": _digests,
    "circuit_bridge": lambda t: t.bridge,
    "tract_code_padded": lambda t: t.tract.select("tract_id", zero_filled(F.col("tract_id")).alias("code")),
    "adults_age_binned": lambda t: tabulate.adults(t.person).groupBy("age", "age_bin").agg(F.count("*").alias("n")),
    "age_bin_frequency": lambda t: tabulate.frequency(tabulate.adults(t.person), "age_bin"),
    "age_quantiles": lambda t: tabulate.quantiles(t.person, "age"),
    "age_quantiles_by_circuit": lambda t: tabulate.quantiles(t.adults_in_circuits, "age", (0.1, 0.25, 0.5, 0.9), tabulate.AREA),
    "crosstab_tenure": lambda t: tabulate.one_way(t.adults_in_circuits, "tenure"),
    "crosstab_activity": lambda t: tabulate.one_way(t.adults_in_circuits, "activity"),
    "crosstab_sex": lambda t: tabulate.one_way(t.adults_in_circuits, "sex"),
    "crosstab_age_bin": lambda t: tabulate.one_way(t.adults_in_circuits, "age_bin"),
    "crosstab_literacy": lambda t: tabulate.one_way(t.adults_in_circuits, "literacy"),
    "crosstab_all_long": lambda t: tabulate.one_way_all(t.adults_in_circuits, TABULATED),
    "crosstab_age_bin_complete": lambda t: tabulate.completed(tabulate.one_way(t.adults_in_circuits, "age_bin"), "age_bin", ["young", "middle", "old"]),
    "crosstab_age_bin_product": lambda t: tabulate.completed(tabulate.one_way(t.adults_in_circuits, "age_bin"), "age_bin", ["young", "middle", "old"], product=True),
    "crosstab_joint": lambda t: tabulate.joint(t.adults_in_circuits, TABULATED),
    "crosstab_with_projection": lambda t: tabulate.with_projection(tabulate.one_way(t.adults_in_circuits, "sex"), t.projection.select("dept", F.col("1995").alias("pop1995"), F.col("1998").alias("pop1998"))),
    "code_labels": _labels,
    "unknown_codes": lambda t: validate.unknown_codes(t.read("lineitem").selectExpr("cast(l_linenumber * 6 as int) dept"), t.tract, "dept"),
    "missing_columns": lambda t: validate.missing_report({"dwelling": t.dwelling, "household": t.placed, "person": geo.with_tract(t.person, t.placed, "household_id")}),
    "orphan_report": _orphans,
    "tracts_in_several_circuits": lambda t: validate.repeated_keys(t.bridge, "tract_id"),
}

_BASE = f"""WITH dwelling AS (SELECT c_custkey::BIGINT dwelling_id, (c_nationkey * 10 + c_custkey % 10)::BIGINT tract_id, c_mktsegment housing_type FROM customer),
household AS (SELECT o_orderkey::BIGINT household_id, o_custkey::BIGINT dwelling_id, o_orderpriority tenure, o_orderstatus rooms FROM orders),
person AS (SELECT l_orderkey::BIGINT household_id, l_linenumber::BIGINT person_no, l_quantity::INT age, l_returnflag sex, l_linestatus activity, (l_linenumber % 2)::INT literacy FROM lineitem),
tract AS (SELECT (n_nationkey * 10 + d)::BIGINT tract_id, n_nationkey::INT dept, n_regionkey::INT prov, nullif(n_nationkey % 3, 0)::INT agglomerate FROM nation, range(10) t(d)),
projection AS (SELECT c_nationkey::INT dept, {", ".join(f'count(*) FILTER (year(o_orderdate) = {y})::DOUBLE p{y}' for y in YEARS)} FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
ratios AS ({" UNION ALL ".join(f"SELECT dept, {y}::INT AS year, p{y} / nullif(p{BASE}, 0) AS ratio FROM projection" for y in YEARS)}),
code AS (SELECT DISTINCT lpad((s_nationkey * 10 + s_suppkey % 10)::VARCHAR, 9, '0') code, (s_suppkey % 4)::VARCHAR circuit FROM supplier),
bridge AS (SELECT tract_id, prov, dept, circuit FROM code JOIN tract ON lpad(tract_id::VARCHAR, 9, '0') = code),
hh AS (SELECT h.*, tract_id FROM household h JOIN dwelling USING (dwelling_id)),
placed AS (SELECT hh.*, dept, prov, agglomerate FROM hh JOIN tract USING (tract_id)),
adult AS (SELECT *, CASE WHEN age < 31 THEN 'young' WHEN age < 51 THEN 'middle' WHEN age < 110 THEN 'old' END age_bin FROM person WHERE age >= 16),
rows AS (SELECT adult.*, tract_id, tenure, prov, dept, circuit FROM adult JOIN hh USING (household_id) JOIN bridge USING (tract_id)),
size AS (SELECT dept, count(*) n FROM placed GROUP BY dept)
"""


def _targets(frac: float, where: str) -> str:
    return f"""SELECT dept, year, n, ratio, {frac}::DOUBLE * ratio AS rate,
CASE WHEN ratio IS NULL OR ratio <= 0 OR {frac}::DOUBLE * ratio > 1 THEN 0 ELSE round_even({frac}::DOUBLE * ratio * n, 0) END::BIGINT AS k,
CASE WHEN ratio IS NULL OR ratio <= 0 THEN 'skipped_invalid_ratio' WHEN {frac}::DOUBLE * ratio > 1 THEN 'skipped_rate_out_of_range' ELSE 'ok' END AS status
FROM size JOIN ratios USING (dept) WHERE {where}"""


def _drawn(where: str, bernoulli: bool = False, frac: float = FRAC) -> str:
    hashed = f"SELECT p.*, year, rate, k, md5('{SEED}:' || year || ':' || household_id) h FROM placed p JOIN target USING (dept) WHERE status = 'ok'"
    test = "('0x' || substr(h, 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate" if bernoulli else "rn <= k"
    return f", target AS ({_targets(frac, where)}), hashed AS ({hashed}), drawn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dept, year ORDER BY h, household_id) rn FROM hashed) WHERE {test}) "


_ONE, _ALL = _drawn("year = 1998"), _drawn("year >= 1996 AND year < 2002")
_SAMPLE = "SELECT household_id, dwelling_id, dept, year FROM drawn"
_FLAT = "SELECT d.year, d.household_id, d.dwelling_id, d.tract_id, d.dept, d.prov, d.agglomerate, housing_type, d.tenure, d.rooms, person_no, age, sex, activity, literacy FROM drawn d JOIN dwelling w USING (dwelling_id) JOIN person USING (household_id)"


def _one_way(c: str) -> str:
    return f"SELECT prov, dept, circuit, {c}, count(*) AS {c}_count FROM rows WHERE {c} IS NOT NULL GROUP BY prov, dept, circuit, {c}"


def _completed(areas: str) -> str:
    return f", t AS ({_one_way('age_bin')}), areas AS ({areas}) SELECT a.*, v.age_bin, coalesce(age_bin_count, 0) AS age_bin_count FROM areas a CROSS JOIN (VALUES ('young'), ('middle'), ('old')) v(age_bin) LEFT JOIN t USING (prov, dept, circuit, age_bin)"


_ROW_TEXT = " || ".join(f"coalesce('V' || length({c}::VARCHAR) || ':' || {c}::VARCHAR, 'N')" for c in sorted(FLAT) if c != "year")
_SQL = {
    "projection_ratios_wide": "SELECT dept, " + ", ".join(f"p{y} / nullif(p{BASE}, 0) AS r{y}" for y in YEARS) + " FROM projection",
    "projection_ratios_long": "SELECT * FROM ratios",
    "household_tract": "SELECT household_id, tract_id FROM hh",
    "person_tract": "SELECT tract_id, count(*) AS n_persons, sum(age)::BIGINT AS sum_age FROM person JOIN hh USING (household_id) GROUP BY tract_id",
    "dwelling_geo": "SELECT dwelling_id, tract_id, dept, prov, agglomerate FROM dwelling JOIN tract USING (tract_id)",
    "household_geo": "SELECT household_id, tract_id, dept, prov, agglomerate FROM placed",
    "person_geo": "SELECT prov, dept, agglomerate, count(*) AS n_persons FROM person JOIN placed USING (household_id) GROUP BY prov, dept, agglomerate",
    "filter_departments": "SELECT household_id, dept FROM placed WHERE dept IN (3, 7, 11)",
    "filter_provinces": "SELECT household_id, prov FROM placed WHERE prov IN (1, 4)",
    "filter_year_range": "SELECT * FROM ratios WHERE year >= 1996 AND year < 1999",
    "stratum_targets": _targets(0.9, "year >= 1996 AND year < 2002"),
    "sample_exact": _ONE + _SAMPLE,
    "sample_exact_multi_year": _ALL + _SAMPLE,
    "sample_exact_filtered": _ONE + _SAMPLE + " WHERE prov = 2",
    "sample_bernoulli": _drawn("year >= 1996 AND year < 2002", True) + _SAMPLE,
    "sampled_households": _ONE + "SELECT * FROM household WHERE household_id IN (SELECT household_id FROM drawn)",
    "sampled_persons": _ONE + "SELECT * FROM person WHERE household_id IN (SELECT household_id FROM drawn)",
    "sampled_dwellings": _ONE + "SELECT * FROM dwelling WHERE dwelling_id IN (SELECT dwelling_id FROM drawn)",
    "sampled_dwellings_multi_year": _ALL + "SELECT year, dwelling_id, housing_type FROM (SELECT DISTINCT year, dwelling_id FROM drawn) JOIN dwelling USING (dwelling_id)",
    "flat_sample": _ONE + _FLAT,
    "flat_sample_row_counts": _ONE + f"SELECT 'drawn' AS name, count(*) AS n_rows FROM drawn UNION ALL SELECT 'with_dwelling', count(*) FROM drawn JOIN dwelling USING (dwelling_id) UNION ALL SELECT 'flat', count(*) FROM ({_FLAT})",
    "draw_bucket_counts": f"SELECT dept, year::INT AS year, substr(md5('{SEED}:' || year || ':' || household_id), 1, {sampling.DIGITS}) AS bucket, count(*) AS in_bucket FROM placed, range({ALL_YEARS.years[0]}, {ALL_YEARS.years[1]}) y(year) GROUP BY ALL",
    "sample_exact_indexed": _drawn("year >= 1996 AND year < 2002", frac=FRAC / 2) + _SAMPLE,
    "flat_sample_laid_out": _ALL + _FLAT,
    "sample_digest": _ALL + f", flat AS ({_FLAT}), digests AS (SELECT year, md5({_ROW_TEXT}) h FROM flat) SELECT year, count(*) AS n_rows, sum(('0x' || substr(h, 1, 15))::BIGINT)::HUGEINT::VARCHAR AS first, sum(('0x' || substr(h, 16, 15))::BIGINT)::HUGEINT::VARCHAR AS second FROM digests GROUP BY year",
    "circuit_bridge": "SELECT tract_id, prov, dept, circuit FROM bridge",
    "tract_code_padded": "SELECT tract_id, lpad(tract_id::VARCHAR, 9, '0') AS code FROM tract",
    "adults_age_binned": "SELECT age, age_bin, count(*) AS n FROM adult GROUP BY age, age_bin",
    "age_bin_frequency": "SELECT age_bin, count(*) AS n FROM adult WHERE age_bin IS NOT NULL GROUP BY age_bin",
    "age_quantiles": " UNION ALL ".join(f"SELECT {q}::DOUBLE AS share, quantile_cont(age::DOUBLE, {q}) AS value FROM person" for q in (0.0, 0.3333, 0.6666, 1.0)),
    "age_quantiles_by_circuit": " UNION ALL ".join(f"SELECT prov, dept, circuit, {q}::DOUBLE AS share, quantile_cont(age::DOUBLE, {q}) AS value FROM rows GROUP BY prov, dept, circuit" for q in (0.1, 0.25, 0.5, 0.9)),
    **{f"crosstab_{c}": _one_way(c) for c in TABULATED},
    "crosstab_all_long": " UNION ALL ".join(f"SELECT prov, dept, circuit, '{c}' AS variable, {c}::VARCHAR AS value, count(*) AS n FROM rows WHERE {c} IS NOT NULL GROUP BY prov, dept, circuit, {c}" for c in TABULATED),
    "crosstab_age_bin_complete": _completed("SELECT DISTINCT prov, dept, circuit FROM t"),
    "crosstab_age_bin_product": _completed("SELECT * FROM (SELECT DISTINCT prov FROM t), (SELECT DISTINCT dept FROM t), (SELECT DISTINCT circuit FROM t)"),
    "crosstab_joint": f"SELECT prov, circuit, {', '.join(TABULATED)}, count(*) AS n FROM rows WHERE age_bin IS NOT NULL GROUP BY prov, circuit, {', '.join(TABULATED)}",
    "crosstab_with_projection": f", t AS ({_one_way('sex')}) SELECT t.*, p1995 AS pop1995, p1998 AS pop1998 FROM t LEFT JOIN projection USING (dept)",
    "code_labels": "SELECT t.*, n_name AS dept_name, r_name AS prov_name FROM (SELECT dept, prov, count(*) AS n_tracts FROM tract GROUP BY dept, prov) t LEFT JOIN nation ON n_nationkey = dept LEFT JOIN region ON r_regionkey = prov",
    "unknown_codes": "SELECT DISTINCT (l_linenumber * 6)::INT AS dept FROM lineitem WHERE (l_linenumber * 6)::INT NOT IN (SELECT dept FROM tract)",
    "missing_columns": " UNION ALL ".join(
        f"SELECT '{level}' AS level, (SELECT count(*) FROM {rows}) AS n_rows, coalesce((SELECT string_agg(c, ',' ORDER BY k) FROM (VALUES {', '.join(f'({k}, {chr(39)}{c}{chr(39)})' for k, c in enumerate(needed))}) need(k, c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE {shape}))), '') AS missing"
        for level, needed, rows, shape in (
            ("dwelling", ("dwelling_id", "tract_id"), "dwelling", "SELECT c_custkey dwelling_id, c_nationkey tract_id FROM customer"),
            ("household", ("household_id", "dwelling_id", "tract_id", "dept"), "placed", "SELECT o_orderkey household_id, o_custkey dwelling_id, c_nationkey tract_id, c_nationkey dept FROM orders, customer"),
            ("person", ("person_id", "household_id", "tract_id"), "(SELECT 1 FROM person JOIN placed USING (household_id)) x", "SELECT l_orderkey household_id, l_linenumber person_no, c_nationkey tract_id FROM lineitem, customer"),
        )
    ),
    "orphan_report": "SELECT 'household' AS relation, count(*) AS n_orphans FROM household WHERE dwelling_id NOT IN (SELECT dwelling_id FROM dwelling) UNION ALL SELECT 'person', count(*) FROM person WHERE household_id NOT IN (SELECT household_id FROM household) UNION ALL SELECT 'dwelling', count(*) FROM dwelling WHERE tract_id NOT IN (SELECT tract_id FROM tract)",
    "tracts_in_several_circuits": "SELECT tract_id, count(*) AS n FROM bridge GROUP BY tract_id HAVING count(*) > 1",
}

QUERIES = {name: (lambda spark, sf_dir, f=f: f(Tables(spark, sf_dir))) for name, f in _QUERIES.items()}
ORACLE = {name: _BASE + sql for name, sql in _SQL.items()}
