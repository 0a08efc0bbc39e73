from pathlib import Path

import duckdb
import pytest

from strata_spark.llm.queries import ORACLE, QUERIES

AT = Path("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    c = duckdb.connect()
    for p in AT.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = QUERIES[name](spark, str(AT))
    want = c.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(*names).collect()))) == sorted(map(str, want.fetchall()))
