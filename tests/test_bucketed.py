"""Upserts into tables that are stored by their key."""

import random
import re

import pytest
from conftest import values

from cropspark.operators import star
from cropspark.sources import bucketed

SCHEMA = "k string, y int, a double, b string, c string"


def rows(keys, mark):
    return [(f"k{k % 40}", k, float(k), f"{mark}{k}", f"{mark}c") for k in keys]


@pytest.fixture
def table(spark, tmp_path):
    name = f"t{random.randrange(10**12)}"
    base = spark.createDataFrame(rows(range(300), "old"), SCHEMA)
    bucketed.create(base, name, str(tmp_path), ["k", "y"], 4)
    yield name
    spark.sql(f"DROP VIEW {name}")


def joined_sides(plan):
    """The subtrees below the join of a formatted physical plan, by their depth."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "FullOuter" in line)
    depth = [len(re.match(r"[\s:+\-|*()\d]*", line)[0]) for line in lines]
    sides, below = [], None
    for i in range(at + 1, len(lines)):
        if depth[i] <= depth[at] or not lines[i].strip():
            break
        if below is None or depth[i] <= below:
            below = depth[i]
            sides.append([])
        sides[-1].append(lines[i])
    return ["\n".join(s) for s in sides]


def test_only_the_batch_is_moved(spark, table):
    batch = spark.createDataFrame(rows(range(250, 350), "new"), SCHEMA).drop("c")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = bucketed.merged(spark, table, batch, ["a"])
        plan = df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    base, incoming = joined_sides(plan[1])
    assert "Exchange" not in base and "Bucketed: true" in base
    assert "Exchange hashpartitioning" in incoming and "Bucketed: true" not in incoming


def test_upsert_gives_what_the_operator_gives(spark, table, tmp_path):
    expected = spark.table(table)
    batches = [rows(range(250, 350), "new"), rows([5, 999], "newer"), rows([5, 999], "newer")]
    for batch in batches:
        df = spark.createDataFrame(batch, SCHEMA).drop("c")
        expected = spark.createDataFrame(star.upsert(expected, df, ["k", "y"], ["a"]).collect(), SCHEMA)
        before = bucketed.upsert_table(spark, table, df, ["a"])
        assert values(spark.table(table)) == values(expected) and spark.table(before).count() > 0
        assert bucketed.current(spark, table)[2:] == (["k", "y"], 4)
    # each version is written bucket by bucket: one file per bucket at most
    folder = bucketed.current(spark, table)[0]
    assert len(list(tmp_path.glob(f"{folder.split('.')[-1]}/part-*")) or list(tmp_path.rglob(f"{folder.split('.')[-1]}/part-*"))) <= 4


def test_key_types_duplicates_and_null_keys(spark, table):
    longs = spark.createDataFrame([("k1", 1, 7.0), ("k3", 1000, 8.0), (None, 4, 9.0)], "k string, y bigint, a double")
    bucketed.upsert_table(spark, table, longs, ["a"])
    got = {(r["k"], r["y"]): r["a"] for r in spark.table(table).where("y in (1, 1000)").collect()}
    assert got == {("k1", 1): 7.0, ("k3", 1000): 8.0} and spark.table(table).where("k is null").count() == 0
    before = bucketed.current(spark, table)[0]
    with pytest.raises(Exception, match="conflict key twice"):
        bucketed.upsert_table(spark, table, longs.union(longs), ["a"])
    assert bucketed.current(spark, table)[0] == before
    bucketed.upsert_table(spark, table, longs.union(longs.withColumn("a", longs["a"] + 1)), ["a"], on_duplicate="last", order=["a"])
    assert spark.table(table).where("y = 1000").first()["a"] == 9.0
