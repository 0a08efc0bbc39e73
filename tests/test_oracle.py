import math
from pathlib import Path

import duckdb
import pytest

from strata_spark.queries import ORACLE, QUERIES

AT = Path("/root/testdata/sf0.001")


def normal(rows):
    return sorted((tuple(f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v) for v in r) for r in rows))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in AT.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, str(AT))
    want = duck.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert normal(df.select(*names).collect()) == normal(want.fetchall())
