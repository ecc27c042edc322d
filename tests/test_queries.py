"""Every registered query beside its SQL, and checks on the plans."""

import pathlib
import subprocess
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent / "tools"))

import compare_sql  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from cropspark import plans  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    return compare_sql.database(FOLDER)


@pytest.mark.parametrize("name", list(plans.queries()))
def test_query_matches_sql(spark, database, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert forbidden not in plan
    rows = [tuple(r) for r in df.collect()]
    assert rows
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        assert compare_sql.compare((df.columns, rows), compare_sql.run_sql(database, sql)[:2]) is None


def test_filters_and_columns_reach_the_scan(spark):
    df = entry.queries()["top5_fixed_year"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_linenumber" not in plan
    assert "TakeOrderedAndProject" in plan


def test_flagship(spark):
    assert entry.entry(spark).count() == 5


def test_year_range_reaches_the_scan(spark):
    for name in ("top5_fixed_year", "star_listing_selected"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_entry_works_without_the_training_data_package(tmp_path):
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "cropspark.llm" or name.startswith("cropspark.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = list(entry.queries())
assert names and not [n for n in names if n.startswith("op") and n[2].isdigit()] and "pipeline" not in names
assert set(entry.oracle_sql()) <= set(names)
"""
    root = pathlib.Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
