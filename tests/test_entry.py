"""Registered queries against DuckDB on the small test tables, and their plans."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(rows):
    def plain(value):
        if isinstance(value, float):
            return None if math.isnan(value) else repr(value)
        return value if value is None else str(value)

    return sorted([tuple(plain(v) for v in row) for row in rows], key=str)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = comparable(tuple(r) for r in df.select(*columns).collect())
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == comparable([row[i] for i in order] for row in result.fetchall())


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert "max_CPP_this_CH" in result.columns


def test_kmeans_labels(spark):
    found = entry.queries()["kmeans_clusters"](spark, SF_DIR)
    labels = {r.cluster_label for r in found.select("cluster_label").distinct().collect()}
    assert labels == set(range(10))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


RELATIONAL = [
    name
    for name in sorted(entry.oracle_sql())
    if not name.startswith(("vector", "mean", "quality_activity", "op5_", "op7_", "op10_"))
]


@pytest.mark.parametrize("name", RELATIONAL)
def test_plans_stay_in_the_jvm_without_products(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


def test_activity_scan_is_narrow_and_filtered(spark):
    plan = plan_of(entry.queries()["activity_video_peak"](spark, SF_DIR))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "events" in line)
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan
    assert "IsNotNull(user_id)" in scan or "IsNotNull..." in scan
    assert "event_id" not in scan.split("ReadSchema")[1]


def test_counts_are_combined_before_the_joins(spark):
    plan = plan_of(entry.queries()["activity_video_peak"](spark, SF_DIR))
    joins = [i for i, line in enumerate(plan.splitlines()) if "Join" in line]
    partial = [i for i, line in enumerate(plan.splitlines()) if "partial_count(1)" in line]
    assert partial and max(partial) > min(joins)


def test_text_scan_is_filtered_by_the_flagged_users(spark):
    joins = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = entry.queries()["suspicious_comment_text"](spark, SF_DIR)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", joins)
    assert plan.count("might_contain") >= 1
    # The filter stands above the comments that are returned, left of the semi join.
    left, _, ids = plan.partition("LeftSemi")[2].partition("scalar-subquery")
    assert "Filter" in left


def test_wide_peaks_read_the_comments_once(spark):
    plan = plan_of(entry.queries()["activity_all_channel_peak"](spark, SF_DIR))
    assert sum("FileScan" in line and "events" in line for line in plan.splitlines()) == 1
