import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata_spark import sources
from strata_spark.functions import age_bin, draw_hash, hash01, zero_filled
from strata_spark.operators import draw_index, geo, layout, sampling, tabulate, validate
from strata_spark.plans import draw, run_job, sample_job
from strata_spark.plans.run import by_year, observed, placed
from strata_spark.spec import SampleSpec


@pytest.fixture
def tiny(spark):
    tracts = spark.createDataFrame([(1, 11, 1, None), (2, 11, 1, 5), (3, 12, 1, 5), (4, 21, 2, 6)], "tract_id long, dept int, prov int, agglomerate int")
    dwellings = spark.createDataFrame([(d, t) for d, t in ((1, 1), (2, 1), (3, 2), (4, 3), (5, 4), (6, 4), (7, 99))], "dwelling_id long, tract_id long")
    households = spark.createDataFrame([(h, d, "own" if h % 2 else None) for h, d in ((1, 1), (2, 1), (3, 2), (4, 3), (5, 4), (6, 5), (7, 5), (8, 77), (9, 7))], "household_id long, dwelling_id long, tenure string")
    persons = spark.createDataFrame([(p, p % 7 + 1, 10 + 5 * p) for p in range(20)] + [(20, 500, 30)], "person_id long, household_id long, age int")
    projections = spark.createDataFrame([(11, 10.0, 10.0, 20.0), (12, 0.0, 5.0, 5.0), (21, 10.0, 5.0, -1.0)], "dept int, `2010` double, `2015` double, `2016` double")
    return dwellings, households, persons, tracts, projections


def test_ratios(tiny):
    got = {(r.dept, r.year): r.ratio for r in sampling.projection_ratios(tiny[4], 2010, (2015, 2017)).collect()}
    assert got == {(11, 2015): 1.0, (11, 2016): 2.0, (12, 2015): None, (12, 2016): None, (21, 2015): 0.5, (21, 2016): -0.1}
    assert sampling.projection_ratios(tiny[4], 2010, (2020, 2020)).count() == 0
    with pytest.raises(ValueError, match="2017"):
        sampling.projection_ratios(tiny[4], 2010, (2015, 2018))


def test_rounding_and_guards(spark):
    households = spark.range(10).select(F.col("id").alias("household_id"), F.lit(1).alias("dept"))
    ratios = spark.createDataFrame([(1, i, r) for i, r in enumerate([0.05, 0.15, 0.25, 0.35, 1.0, 1.0000001, -0.1, None, 0.0, float("nan"), float("inf")])], "dept int, year int, ratio double")
    got = {r.year: (r.k, r.status) for r in sampling.stratum_targets(households, ratios, 1.0).collect()}
    assert [got[i] for i in range(5)] == [(0, "ok"), (2, "ok"), (2, "ok"), (4, "ok"), (10, "ok")]
    assert got[5] == got[10] == (0, "skipped_rate_out_of_range") and {got[i] for i in range(6, 10)} == {(0, "skipped_invalid_ratio")}
    assert {r.k for r in sampling.stratum_targets(households, ratios.where("year = 5"), 1.0, "cap").collect()} == {10}
    with pytest.raises(Exception, match="skipped"):
        sampling.stratum_targets(households, ratios, 1.0, "raise").collect()


def test_draw(spark):
    households = spark.range(3000).selectExpr("id household_id", "cast(id % 3 as int) dept")
    ratios = spark.createDataFrame([(d, y, r) for d, r in ((0, 1.0), (1, 0.5), (2, 2.0)) for y in (2015, 2016)], "dept int, year int, ratio double")
    targets = sampling.stratum_targets(households, ratios, 0.1)
    drawn = sampling.draw_exact(households, targets, 3)
    keys = {tuple(r) for r in drawn.select("year", "household_id").collect()}
    assert {(r.dept, r.year): r["count"] for r in drawn.groupBy("dept", "year").count().collect()} == {(d, y): k for d, k in ((0, 100), (1, 50), (2, 200)) for y in (2015, 2016)}
    assert len(keys) == 700 and keys == {tuple(r) for r in sampling.draw_exact(households.repartition(7), targets, 3, small=True, digits=1).select("year", "household_id").collect()}
    assert sampling.short_strata(drawn, targets).isEmpty() and not sampling.short_strata(drawn.where("household_id > 50"), targets).isEmpty()
    counts = sampling.bucket_counts(households.repartition(3), [2015, 2016], 3, digits=3)
    assert keys == {tuple(r) for r in sampling.draw_counted(households, counts, ratios, 0.1, 3, digits=3).select("year", "household_id").collect()}
    assert sorted(map(tuple, sampling.report(counts, ratios, 0.1).collect())) == sorted(map(tuple, targets.collect()))
    cuts = sampling.thresholds(households, counts, ratios, 0.1, 3, digits=3)
    assert keys == {tuple(r) for r in sampling.draw_up_to(households, cuts, 3).select("year", "household_id").collect()}
    half = {tuple(r) for r in sampling.draw_counted(households, counts, ratios, 0.05, 3, digits=3).select("year", "household_id").collect()}
    assert len(half) == 350 and half < keys  # nested
    plan = sampling.draw_counted(households, sampling.bucket_counts(households, [2015, 2016], 3), ratios, 0.1, 3, small=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 1 and not re.search(r"hashpartitioning\(dept#\d+, \d+\)", plan)  # by department alone
    some = households.where("dept < 2")
    assert {tuple(r) for r in sampling.draw_exact(some, targets.where("dept < 2"), 3).select("year", "household_id").collect()} == {tuple(r) for r in drawn.where("dept < 2").select("year", "household_id").collect()}
    n = sampling.draw_bernoulli(households, targets, 3).count()
    assert abs(n - 700) < 6 * 700**0.5
    u = households.select(hash01(draw_hash(1, F.lit(2015), F.col("household_id"))).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= u[0] < 0.01 and 0.99 < u[1] < 1 and abs(u[2] - 0.5) < 0.03


def test_draw_is_whole_where_a_household_id_holds_a_third_of_a_department(spark):
    rows = spark.range(6000).selectExpr("if(id % 3 = 0, -1, id) household_id", "cast(id % 2 as int) dept", "id row")
    ratios = spark.createDataFrame([(d, y, 1.0) for d in (0, 1) for y in range(2010, 2016)], "dept int, year int, ratio double")
    targets = sampling.stratum_targets(rows, ratios, 0.3)
    drawn = sampling.draw_exact(rows, targets, 3)
    assert sampling.short_strata(drawn, targets).isEmpty() and set(drawn.columns) == {*rows.columns, "year"}
    order = Window.partitionBy("dept", "year").orderBy(draw_hash(3, F.col("year"), F.col("household_id")), "household_id")
    want = rows.join(targets.select("dept", "year", "k"), "dept").withColumn("rn", F.row_number().over(order)).where("rn <= k").groupBy("dept", "year", "household_id").count()
    assert {tuple(r) for r in drawn.groupBy("dept", "year", "household_id").count().collect()} == {tuple(r) for r in want.collect()}
    assert sampling.draw_exact(rows, targets.withColumn("k", F.lit(10**12)), 3).count() == 6 * rows.count()


def test_flat_sample_keeps_null_agglomerates(tiny):
    flat, report = sample_job(*tiny, SampleSpec(frac=1.0, years=(2015, 2016), base_year=2010))
    rows = flat.collect()
    assert {r.household_id for r in rows if r.agglomerate is None} == {1, 2, 3}
    assert {r.status for r in report.collect()} == {"ok", "skipped_invalid_ratio"}
    assert {r.dept for r in rows} == {11, 21}
    with pytest.raises(ValueError):
        SampleSpec(departments=(1,), provinces=(2,))
    drawn, _ = draw(tiny[0], tiny[1], tiny[3], tiny[4], SampleSpec(frac=1.0, years=(2015, 2016), base_year=2010, departments=(21,), method="bernoulli"))
    assert {r.dept for r in drawn.collect()} <= {21}
    both = sampling.sampled_by_year(tiny[0], flat.select("year", "dwelling_id"), "dwelling_id")
    assert both.count() == len({r.dwelling_id for r in rows})


def test_geography(tiny, spark):
    dwellings, households, persons, tracts, _ = tiny
    placed = geo.attach_geo(geo.with_tract(households, dwellings, "dwelling_id"), tracts)
    assert {r.household_id for r in placed.collect()} == {1, 2, 3, 4, 5, 6, 7}
    assert {r.dept for r in geo.filter_geo(tracts, provinces=[1]).collect()} == {11, 12}
    with pytest.raises(ValueError):
        geo.filter_geo(tracts, [1], [1])
    codes = spark.createDataFrame([("2001",), ("123456789",), ("1234567890",), (None,)], "c string").select(zero_filled(F.col("c")).alias("z"))
    assert [r.z for r in codes.collect()] == ["000002001", "123456789", "1234567890", None]
    bridge = geo.circuit_bridge(spark.createDataFrame([("000000001", "a"), ("000000001", "b"), ("000000004", None), ("7", "c")], "code string, circuit string"), tracts.withColumn("code", F.col("tract_id").cast("string")))
    assert sorted((r.tract_id, r.circuit) for r in bridge.collect()) == [(1, "a"), (1, "b")]
    twice = tabulate.in_circuits(persons, geo.with_tract(households, dwellings, "dwelling_id"), bridge)
    once = geo.with_tract(persons, geo.with_tract(households, dwellings, "dwelling_id"), "household_id").where("tract_id = 1").count()
    assert twice.count() == 2 * once > 0
    assert [r.n for r in validate.repeated_keys(bridge, "tract_id").collect()] == [2]
    assert validate.orphans(households, dwellings, "dwelling_id", "h").first().n_orphans == 1
    assert [r.dept for r in validate.unknown_codes(spark.createDataFrame([(11,), (99,)], "dept int"), tracts, "dept").collect()] == [99]


def test_ages_and_tables(spark):
    ages = spark.createDataFrame([(a,) for a in (15, 16, 30, 31, 50, 51, 109, 110, None)], "age int")
    assert [r.b for r in ages.select(age_bin(F.col("age")).alias("b")).collect()] == [None, "young", "young", "middle", "middle", "old", "old", None, None]
    assert [(r.age_bin, r.n) for r in tabulate.frequency(tabulate.adults(ages), "age_bin").collect()] == [("middle", 2), ("old", 2), ("young", 2)]
    rows = spark.createDataFrame([(1, 10, "x", "young"), (1, 10, "x", "young"), (2, 20, "y", None), (2, 20, "y", "old")], "prov int, dept int, circuit string, age_bin string")
    table = tabulate.one_way(rows, "age_bin")
    assert sorted(map(tuple, table.collect())) == [(1, 10, "x", "young", 2), (2, 20, "y", "old", 1)]
    assert tabulate.completed(table, "age_bin", ["young", "middle", "old"]).count() == 6
    assert tabulate.completed(table, "age_bin", ["young", "middle", "old"], product=True).count() == 24


def test_missing_columns(tiny):
    with pytest.warns(UserWarning, match="tenancy"):
        assert validate.missing_columns(tiny[1], ["household_id", "tenancy"]) == ["tenancy"]
    with pytest.raises(ValueError):
        validate.missing_columns(tiny[1], ["tenancy"], strict=True)


def test_files(spark, tmp_path, tiny):
    census = tmp_path / "census"
    census.mkdir()
    (census / "VIVIENDA.csv").write_text("X;URP;VIVIENDA_REF_ID;V01;RADIO_REF_ID;TIPVV\nq;1;10;;7; 2\n")
    (census / "HOGAR.csv").write_text(";".join(["HOGAR_REF_ID", "VIVIENDA_REF_ID", *[f"H{k:02}" for k in range(5, 17)], "PROP", "TOTPERS"]) + "\n1;10" + ";3" * 14 + "\n")
    (census / "PERSONA.csv").write_text("PERSONA_REF_ID;HOGAR_REF_ID;P01;P02;P03;P05;P06;P07;P12;P08;P09;P10;CONDACT\n5;1;1;2;40;1;1;1;1;1;1;1;1\n")
    d, h, p = sources.read_tables(spark, str(census))
    assert d.first().asDict() == {"dwelling_id": 10, "tract_id": 7, "URP": 1, "TIPVV": 2, "V01": None}
    assert h.first().household_id == 1 and h.first().TOTPERS == 3 and p.first().P03 == 40
    (tmp_path / "proj.csv").write_text("DPTO,NOMDPTO,2010,2015\n11,Año,10,20\n")
    assert sources.read_projections(spark, str(tmp_path / "proj.csv")).first().asDict() == {"dept": 11, "dept_name": "Año", "2010": 10.0, "2015": 20.0}
    (tmp_path / "ref.csv").write_text("PROV,DPTO,AGLOMERADO,RADIO_REF_ID\n1,11,,7\n")
    assert tuple(sources.read_tract_reference(spark, str(tmp_path / "ref.csv")).first()) == (7, 11, 1, None)
    spec = SampleSpec(frac=1.0, years=(2015, 2017), base_year=2010, departments=(11,))
    flat, report = sample_job(*tiny, spec)
    for fmt in ("csv", "parquet"):
        sources.write_sample(flat, str(tmp_path / fmt), fmt)
        assert list((tmp_path / fmt / "year=2015").glob("*." + fmt))
        again = spark.read.option("header", True).csv(str(tmp_path / fmt)) if fmt == "csv" else spark.read.parquet(str(tmp_path / fmt))
        assert again.count() == flat.count() > 0
    assert sources.run_manifest(report, spec).first().spec_departments == "(11,)"
    sources.write_manifest(report, spec, str(tmp_path / "manifest"))
    assert spark.read.json(str(tmp_path / "manifest")).count() == report.count()
    sources.write_named_csv(flat, str(tmp_path / "named"), spec)
    assert sorted(p.name for p in (tmp_path / "named").iterdir()) == ["table_f1.0_2015_sample.csv", "table_f1.0_2016_sample.csv"]
    long_table = spark.createDataFrame([(1, "sex", "F", 3), (1, "age", "old", 2)], "prov int, variable string, value string, n long")
    for fmt in ("csv", "parquet"):
        sources.write_tables(long_table, str(tmp_path / f"tables-{fmt}"), fmt)
        assert sorted(p.name for p in (tmp_path / f"tables-{fmt}").glob("v*")) == ["variable=age", "variable=sex"]


def test_reference_files(spark, tmp_path):
    (tmp_path / "dptos.csv").write_text("DPTO,NOMDPTO\n2001,Comuna 01\n")
    codes = sources.read_codes(spark, str(tmp_path / "dptos.csv"), "DPTO")
    assert tuple(codes.first()) == (2001, "Comuna 01")
    with pytest.raises(ValueError, match="99"):
        validate.known_codes(spark.createDataFrame([(2001,), (99,)], "code int"), codes, "code")
    (tmp_path / "circuits.csv").write_text("x,circuito,COD_2010\n1,0007,20010101\n2,A,\n")
    (tmp_path / "ref.csv").write_text("PROV,DPTO,AGLOMERADO,RADIO_REF_ID,radio,PROV_REF_ID\n2,2001,,7,20010101,1\n")
    circuits, tracts = sources.read_circuits(spark, str(tmp_path / "circuits.csv")), sources.read_tract_codes(spark, str(tmp_path / "ref.csv"))
    assert {tuple(r) for r in circuits.collect()} == {("020010101", "0007"), (None, "A")}
    assert [tuple(r) for r in geo.circuit_bridge(circuits, tracts).collect()] == [(7, 1, 2001, "0007")]
    spark.range(9).selectExpr("id", "cast(id as string) s").write.parquet(str(tmp_path / "p.parquet"))
    scan = sources.read_columns(spark, str(tmp_path / "p.parquet"), {"id": "long"}).where("id = 3")
    assert scan.count() == 1 and "EqualTo(id,3)" in scan._jdf.queryExecution().toString()


def test_a_whole_run(spark, tmp_path):
    census = tmp_path / "census"
    census.mkdir()
    (census / "VIVIENDA.csv").write_text("VIVIENDA_REF_ID;RADIO_REF_ID;URP;TIPVV;V01\n" + "".join(f"{i};7;1;1;1\n" for i in range(20)))
    (census / "HOGAR.csv").write_text(";".join(["HOGAR_REF_ID", "VIVIENDA_REF_ID", *[f"H{k:02}" for k in range(5, 17)], "PROP", "TOTPERS"]) + "\n" + "".join(f"{i};{i}" + ";3" * 14 + "\n" for i in range(20)))
    (census / "PERSONA.csv").write_text("PERSONA_REF_ID;HOGAR_REF_ID;P01;P02;P03;P05;P06;P07;P12;P08;P09;P10;CONDACT\n" + "".join(f"{i};{i % 20};1;2;40;1;1;1;1;1;1;1;1\n" for i in range(60)))
    (tmp_path / "proj.csv").write_text("DPTO,NOMDPTO,2010,2015\n11,Año,10,20\n")
    (tmp_path / "ref.csv").write_text("PROV,DPTO,AGLOMERADO,RADIO_REF_ID\n1,11,,7\n")
    (tmp_path / "dptos.csv").write_text("DPTO,NOMDPTO\n11,Año\n")
    files = str(census), str(tmp_path / "proj.csv"), str(tmp_path / "ref.csv")
    run_job(spark, *files, str(tmp_path / "out"), SampleSpec(frac=0.1, years=(2015, 2016), departments=(11,), name="t"), departments=str(tmp_path / "dptos.csv"))
    run_job(spark, *files, str(tmp_path / "out"), SampleSpec(frac=0.1, years=(2015, 2016), name="t"), "csv")
    rows = spark.read.parquet(str(tmp_path / "out" / "sample"))
    assert rows.count() == 12 and rows.select("household_id").distinct().count() == 4
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "table_f0.1_2015_t.csv")).count() == 12
    assert spark.read.json(str(tmp_path / "out" / "manifest")).first().k == 4
    for more in ({"departments": str(tmp_path / "dptos.csv")}, {}):  # by a code list, or by the tract reference
        with pytest.raises(ValueError, match="unknown codes"):
            run_job(spark, *files, str(tmp_path / "out"), SampleSpec(departments=(12,)), **more)


def census_of(tmp_path, n=60):
    census = tmp_path / "census"
    census.mkdir()
    (census / "VIVIENDA.csv").write_text("VIVIENDA_REF_ID;RADIO_REF_ID;URP;TIPVV;V01\n" + "".join(f"{i};{7 + i % 2};1;1;1\n" for i in range(n)))
    (census / "HOGAR.csv").write_text(";".join(["HOGAR_REF_ID", "VIVIENDA_REF_ID", *[f"H{k:02}" for k in range(5, 17)], "PROP", "TOTPERS"]) + "\n" + "".join(f"{i};{i}" + ";3" * 14 + "\n" for i in range(n)))
    (census / "PERSONA.csv").write_text("PERSONA_REF_ID;HOGAR_REF_ID;P01;P02;P03;P05;P06;P07;P12;P08;P09;P10;CONDACT\n" + "".join(f"{i};{i % n};1;2;40;1;1;1;1;1;1;1;1\n" for i in range(3 * n)))
    (tmp_path / "proj.csv").write_text("DPTO,NOMDPTO,2010,2015,2016,2017\n11,A,10,20,5,10\n12,B,10,10,10,0\n")
    (tmp_path / "ref.csv").write_text("PROV,DPTO,AGLOMERADO,RADIO_REF_ID\n1,11,,7\n1,12,3,8\n")
    return str(census), str(tmp_path / "proj.csv"), str(tmp_path / "ref.csv")


def test_years_replace_only_themselves(spark, tmp_path):
    files, out = census_of(tmp_path), str(tmp_path / "out")
    spec = lambda year, frac=0.1, seed=1: SampleSpec(frac=frac, years=(year, year + 1), seed=seed, name="t")
    read = lambda: {y: rows for y in (2015, 2016, 2017) if (rows := sorted(map(str, spark.read.parquet(f"{out}/sample").where(f"year = {y}").collect())))}
    first = run_job(spark, *files, out, spec(2015))
    alone = read()
    assert alone.keys() == {2015} and len(alone[2015]) == first[2015][0] > 0
    run_job(spark, *files, out, spec(2016))
    both = read()
    assert both.keys() == {2015, 2016} and both[2015] == alone[2015]
    again = run_job(spark, *files, out, spec(2015, frac=0.2, seed=5))
    third = read()
    assert third[2016] == both[2016] and third[2015] != both[2015] and len(third[2015]) == again[2015][0]
    run_job(spark, *files, out, spec(2015, frac=0.001))  # draws nothing
    assert read().keys() == {2016}
    manifest = {(r.year, r.dept): r for r in spark.read.json(f"{out}/manifest").collect()}
    assert {(y, d): r.k for (y, d), r in manifest.items()} == {(2015, 11): 0, (2015, 12): 0, (2016, 11): 2, (2016, 12): 3}
    assert manifest[2016, 11].sample_households == 5 and manifest[2016, 11].sample_rows == len(both[2016]) and manifest[2015, 12].sample_rows == 0
    assert not [p.name for p in (tmp_path / "out").rglob("_*") if p.is_dir()]
    csv = lambda: {p.name: p.read_text() for p in (tmp_path / "out").glob("*.csv")}
    run_job(spark, *files, out, spec(2015), "csv")
    one = csv()
    run_job(spark, *files, out, spec(2017), "csv")
    assert csv()["table_f0.1_2015_t.csv"] == one["table_f0.1_2015_t.csv"] and csv().keys() == {"table_f0.1_2015_t.csv", "table_f0.1_2017_t.csv"}


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    rows = spark.range(20).selectExpr("id", "cast(2015 + id % 2 as int) year")
    sources.write_by_year(rows, str(tmp_path / "o"))

    def refuse():
        raise ValueError("no")

    bad = rows.withColumn("id", F.expr("if(id = 7, raise_error('bad'), id)"))
    for df, before in ((rows.where("id < 3"), refuse), (bad, None)):
        with pytest.raises(Exception, match="no|bad"):
            sources.write_by_year(df, str(tmp_path / "o"), before=before)
        assert spark.read.parquet(str(tmp_path / "o")).count() == 20 and {p.name for p in (tmp_path / "o").iterdir()} == {"year=2015", "year=2016"}


def test_named_files_from_one_evaluation(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(6000, numPartitions=5).selectExpr("id", "concat('a,', id) as `b,\"c`", "cast(2015 + id % 6 as int) year").mapInArrow(counted, "id long, `b,\"c` string, year int")
    spec = SampleSpec(frac=0.05, years=(2015, 2022), name="x")
    assert sources.write_named_csv(rows, str(tmp_path), spec) == dict.fromkeys(range(2015, 2022), "file")
    assert seen.value == 6000
    names = sorted(p.name for p in tmp_path.iterdir() if p.is_file() and not p.name.startswith("."))
    assert names == [f"table_f0.05_{y}_x.csv" for y in range(2015, 2022)]
    for y in range(2015, 2022):
        got = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / f"table_f0.05_{y}_x.csv"))
        assert got.columns == ["id", 'b,"c'] and sorted(int(r.id) for r in got.collect()) == [i for i in range(6000) if 2015 + i % 6 == y]
    sources.write_named_csv(rows.where("year = 2016"), str(tmp_path), SampleSpec(frac=0.05, years=(2016, 2017), name="x"), one_file=False)
    assert (tmp_path / "table_f0.05_2016_x.csv").is_dir() and spark.read.option("header", True).csv(str(tmp_path / "table_f0.05_2016_x.csv")).count() == 1000


def test_tables_as_named_files(spark, tmp_path):
    rows = [(p, f"c{c}", v, str(x), p + c + x) for p in range(3) for c in range(4) for v in ("sex", "age_bin") for x in range(2)]
    table = spark.createDataFrame(rows, "prov int, circuit string, variable string, value string, n long").repartition(4)
    assert sources.write_named_tables(table, str(tmp_path), ("sex", "age_bin", "tenure")) == dict.fromkeys(("sex", "age_bin", "tenure"), "file")
    for v in ("sex", "age_bin", "tenure"):
        got = spark.read.option("header", True).csv(str(tmp_path / f"agg_circuitos_{v}.csv"))
        assert got.columns == ["prov", "circuit", "value", "n"]
        assert sorted((int(r.prov), r.circuit, r.value, int(r.n)) for r in got.collect()) == sorted((a, b, x, n) for a, b, w, x, n in rows if w == v)
    before = (tmp_path / "agg_circuitos_age_bin.csv").read_text()
    sources.write_named_tables(table.where("prov = 1"), str(tmp_path), ("sex",))
    assert (tmp_path / "agg_circuitos_age_bin.csv").read_text() == before and len((tmp_path / "agg_circuitos_sex.csv").read_text().splitlines()) == 9
    with pytest.raises(ValueError, match="a/b"):
        sources.write_named_tables(table, str(tmp_path), ("a/b",))


def test_digests_tell_multisets_in_any_order(spark):
    rows = spark.createDataFrame([(i % 50, f"s{i % 7}", None if i % 3 else i, 2015 + i % 2) for i in range(400)], "a long, s string, n long, year int")
    years = range(2015, 2018)

    def of(df):
        df, seen = observed(df, years)
        df.write.format("noop").mode("overwrite").save()
        return by_year(seen, years)

    want = of(rows)
    assert want == of(rows.repartition(7, "s")) == of(rows.orderBy("n").coalesce(2)) and [want[y][0] for y in years] == [200, 200, 0]
    changed = of(rows.withColumn("s", F.expr("if(a = 3 and n = 303, 'x', s)")))
    assert changed[2015] != want[2015] or changed[2016] != want[2016]
    assert of(rows.unionByName(rows.limit(1)))[2015] != want[2015]
    pair = lambda a, b: spark.createDataFrame([(a, b, 2015)], "a string, b string, year int")
    assert len({of(pair(*x))[2015] for x in ((None, "a"), ("a", None), ("", "a"), ("a", ""), ("aV1:a", ""), (None, None), ("N", None))}) == 7


def test_draw_index(spark, tmp_path):
    files, at = census_of(tmp_path, 200), str(tmp_path / "index")
    out = lambda k: str(tmp_path / f"out{k}")
    spec = lambda frac, years: SampleSpec(frac=frac, years=years)
    run_job(spark, *files, out(1), spec(0.2, (2015, 2016)), index=at)
    made = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "index").glob("counts/year=2015/*.parquet")}
    with_index = run_job(spark, *files, out(2), spec(0.1, (2015, 2017)), index=at)
    assert made == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "index").glob("counts/year=2015/*.parquet")}  # not counted again
    assert {p.name for p in (tmp_path / "index" / "counts").glob("year=*")} == {"year=2015", "year=2016"}
    assert with_index == run_job(spark, *files, out(3), spec(0.1, (2015, 2017)))
    ids = lambda k: {r.household_id for r in spark.read.parquet(f"{out(k)}/sample").where("year = 2015").collect()}
    assert ids(2) < ids(1)  # nested
    assert run_job(spark, *files, out(4), SampleSpec(frac=0.1, years=(2015, 2016), departments=(12,)), index=at)[2015] == run_job(spark, *files, out(5), SampleSpec(frac=0.1, years=(2015, 2016), departments=(12,)))[2015]
    with pytest.raises(ValueError, match="seed"):
        run_job(spark, *files, out(6), SampleSpec(frac=0.1, years=(2015, 2016), seed=2), index=at)
    homes = tmp_path / "census" / "HOGAR.csv"
    homes.write_text(homes.read_text().replace("\n5;5;", "\n5005;5;"))
    with pytest.raises(ValueError, match="changed"):
        run_job(spark, *files, out(7), spec(0.1, (2015, 2016)), index=at)
    assert not list((tmp_path / "out7").rglob("*.parquet"))


def test_a_draw_from_an_index_reads_households_once(spark, tmp_path):
    spark.range(5000).selectExpr("id household_id", "cast(id % 4 as int) dept").write.parquet(str(tmp_path / "homes.parquet"))
    homes = spark.read.parquet(str(tmp_path / "homes.parquet"))
    ratios = spark.createDataFrame([(d, y, 1.0) for d in range(4) for y in (2015, 2016)], "dept int, year int, ratio double")
    draw_index.ensure(homes, str(tmp_path / "index"), range(2015, 2017), 3)
    counts = draw_index.ensure(homes, str(tmp_path / "index"), range(2015, 2017), 3)
    drawn = sampling.draw_counted(homes, counts, ratios, 0.07, 3)
    plan = drawn._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^]]*household_id", plan)) == 1 and drawn.count() == 8 * round(0.07 * 1250)
    again, check = draw_index.checked(homes, str(tmp_path / "index"), range(2015, 2017))
    sampling.draw_counted(again, counts, ratios, 0.07, 3).write.format("noop").mode("overwrite").save()
    check()
    other, check = draw_index.checked(homes.where("household_id > 0"), str(tmp_path / "index"), range(2015, 2017))
    other.write.format("noop").mode("overwrite").save()
    with pytest.raises(ValueError, match="changed"):
        check()


def test_laid_out_tables_need_no_exchange_by_key(spark, tmp_path):
    n = 4000
    tracts = spark.createDataFrame([(t, t % 3, 1, None) for t in range(9)], "tract_id long, dept int, prov int, agglomerate int")
    dwellings = spark.range(n).selectExpr("id dwelling_id", "id % 9 tract_id", "'x' kind")
    households = spark.range(n).selectExpr("id household_id", "id - id % 2 dwelling_id", "id % 5 rooms")
    persons = spark.range(3 * n).selectExpr("id person_id", "id % 4500 household_id")
    ratios = spark.createDataFrame([(d, y, 1.0 + d) for d in range(3) for y in (2015, 2016)], "dept int, year int, ratio double")
    tables = layout.lay_out(dwellings, households, persons, tracts, "laid", 8, str(tmp_path / "laid"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cuts = layout.cuts(spark, tables, ratios, 0.1, range(2015, 2017), 3, small=True)
        flat = layout.flat_sample(spark, tables, cuts, 3, small=True)
        one = layout.cuts(spark, tables, ratios.where("year = 2015"), 0.1, range(2015, 2016), 3, small=True)
        drawn_persons, drawn_dwellings = (f(spark, tables, one, 3, True) for f in (layout.sampled_persons, layout.sampled_dwellings))
        homes = placed(dwellings, households, tracts)
        drawn = sampling.draw_counted(homes, sampling.bucket_counts(homes, [2015, 2016], 3), ratios, 0.1, 3)
        want = sampling.flatten(drawn, dwellings, persons, tracts)
        columns = sorted(want.columns)
        assert sorted(map(str, flat.select(columns).collect())) == sorted(map(str, want.select(columns).collect())) and flat.count() > 500
        own = drawn.where("year = 2015")
        assert sorted(map(tuple, drawn_persons.collect())) == sorted(map(tuple, sampling.sampled(persons.select("household_id", "person_id"), own, "household_id").select(drawn_persons.columns).collect()))
        assert {r.dwelling_id for r in drawn_dwellings.collect()} == {r.dwelling_id for r in own.collect()}
        for df in (flat, drawn_persons, drawn_dwellings):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and not re.search(r"hashpartitioning\([^)]*(household|dwelling)_id", plan), plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    with pytest.raises(ValueError, match="household_id"):
        layout.lay_out(dwellings, households.unionByName(households.limit(1)), persons, tracts, "again", 2, str(tmp_path / "again"))


def test_quantiles_by_counted_selection(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    values = {"a": rng.normal(size=501).tolist(), "b": rng.integers(0, 5, 300).astype(float).tolist(), "c": [2.5], "d": (10 ** rng.uniform(-9, 9, 200)).tolist(), "e": [1.0, float("inf"), 2.0]}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("a", None), ("a", float("nan")), ("f", None), (None, 1.0)], "area string, v double").repartition(5)
    shares = (0.0, 0.1, 0.3333, 0.5, 0.9, 1.0)
    for parts in (3, 1024):
        got = {(r.area, r.share): r.value for r in tabulate.quantiles(rows, "v", shares, ["area"], parts).collect()}
        assert got.keys() == {(k, q) for k in values for q in shares}
        for (k, q), v in got.items():
            want = np.quantile(values[k], q) if k != "e" else {0.0: 1.0, 0.5: 2.0}.get(q)
            assert want is None or v == pytest.approx(want, rel=1e-12), (k, q)
        every = [v for k, vs in values.items() if k != "e" for v in vs]
        assert [r.value for r in tabulate.quantiles(rows.where("area <> 'e'"), "v", shares, parts=parts).orderBy("share").collect()] == pytest.approx(np.quantile(every, shares).tolist(), rel=1e-12)
    assert [r.value for r in tabulate.quantiles(rows.where("false"), "v", (0.5,)).collect()] == [None]
    plan = tabulate.quantiles(rows, "v", shares)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "CartesianProduct" not in plan


def test_product_of_codes(spark):
    rows = spark.createDataFrame([(1, 10, "x", "young", 2), (2, 20, "y", "old", 1), (2, 20, "y", "odd", 9)], "prov int, dept int, circuit string, age_bin string, age_bin_count long")
    got = tabulate.completed(rows, "age_bin", ["young", "middle", "old"], product=True)
    cells = {tuple(r)[:4]: r.age_bin_count for r in got.collect()}
    assert len(cells) == got.count() == 24 and {k for k, v in cells.items() if v} == {(1, 10, "x", "young"), (2, 20, "y", "old")}
    assert cells.keys() == {(p, d, c, a) for p in (1, 2) for d in (10, 20) for c in "xy" for a in ("young", "middle", "old")}
    assert "Cartesian" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan
    with pytest.raises(ValueError, match="cells"):
        tabulate.completed(rows, "age_bin", ["young", "middle", "old"], product=True, most_cells=23)
    assert tabulate.completed(rows.where("false"), "age_bin", ["young"], product=True).count() == 0


def test_bernoulli_draws_from_streams(spark, tmp_path, tiny):
    households = spark.range(500).selectExpr("id household_id", "11 dept")
    households.write.parquet(str(tmp_path / "in"))
    targets = sampling.stratum_targets(households, sampling.projection_ratios(tiny[4], 2010, (2015, 2016)), 0.2)
    stream = spark.readStream.schema(households.schema).parquet(str(tmp_path / "in"))
    drawn = sampling.draw_bernoulli(stream, targets, 1, small=True)
    q = drawn.writeStream.format("memory").queryName("drawn").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("drawn").count() == sampling.draw_bernoulli(households, targets, 1).count() > 50
