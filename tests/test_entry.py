"""The entry without the subpackage, or with one that doesn't import, still has the library's own queries."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from strata_spark.queries import ORACLE, QUERIES

CODE = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.startswith({gone!r}):
            raise ImportError(name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(sorted(e.queries()) == {names!r}, sorted(e.oracle_sql()) == {sql!r})
"""


@pytest.mark.parametrize("gone", ["strata_spark.llm", "strata_spark.llm.common"])
def test_entry_without_subpackage(gone):
    code = CODE.format(gone=gone, names=sorted(QUERIES), sql=sorted(ORACLE))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parent.parent, timeout=120)
    assert out.stdout.split() == ["True", "True"], out.stderr


def test_a_session_without_a_shared_folder_gets_its_own(tmp_path):
    code = """
from pyspark.sql import SparkSession
from strata_spark.sources import files
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
paths = [files.work_path(spark, "a") for _ in range(2)]
assert files.staged(spark.range(3), paths[0]).count() == 3
assert len(set(paths)) == 2 and len({p.rsplit("/", 1)[0] for p in paths}) == 1, paths
"""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).parent.parent)}
    subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, check=True)
