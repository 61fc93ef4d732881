"""Sketched distinct counts against exact ones, stored and united."""

import pytest
from pyspark.sql import functions as F

from chattermark.operators import sketches

BOUND = 4 * sketches.relative_error()


@pytest.fixture(scope="module")
def visits(spark):
    """120,000 rows over 4 months and 3 channels, a third of them by one user, some by none."""
    return spark.range(120_000).select(
        (F.col("id") % 4).cast("int").alias("month"),
        (F.col("id") % 3).cast("string").alias("channel"),
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.hash("id") % 30_000).alias("user_id"),
        F.concat(F.lit("t"), F.col("id") % 9000).alias("text"),
    )


def exact(df, keys, column):
    counted = df.groupBy(*keys).agg(
        (F.countDistinct(column) + F.max(F.col(column).isNull()).cast("int")).alias("n")
    )
    return {tuple(r[k] for k in keys): r["n"] for r in counted.collect()}


@pytest.mark.parametrize("keys", [["month", "channel"], ["month"], []])
def test_counts_are_within_the_bound(spark, visits, tmp_path, keys):
    stored = str(tmp_path / "sketches")
    sketches.distinct_sketches(visits, ["month", "channel"], ["user_id", "text"]).write.parquet(stored)
    kept = spark.read.parquet(stored)
    assert kept.count() == 12
    united = sketches.united_sketches(kept, keys, ["user_id", "text"])
    found = sketches.distinct_counts(united, ["user_id", "text"]).collect()
    for column in ("user_id", "text"):
        expected = exact(visits, keys, column)
        assert len(found) == len(expected)
        for row in found:
            n = expected[tuple(row[k] for k in keys)]
            assert abs(row[f"{column}_count"] - n) <= BOUND * n
    assert sum(r.n_rows for r in found) == 120_000


def test_ranges_of_months(visits):
    kept = sketches.distinct_sketches(visits, ["month"], ["user_id"])
    some = sketches.united_sketches(kept.where("month between 1 and 2"), [], ["user_id"])
    n = exact(visits.where("month between 1 and 2"), [], "user_id")[()]
    assert abs(sketches.distinct_counts(some, ["user_id"]).first().user_id_count - n) <= BOUND * n


def test_missing_values_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 5)], "k string, v long")
    found = sketches.distinct_counts(sketches.distinct_sketches(rows, ["k"], ["v"]), ["v"]).collect()
    assert {r.k: (r.n_rows, r.v_count) for r in found} == {"a": (2, 1), "b": (1, 1)}
    none = sketches.distinct_sketches(rows.where("false"), ["k"], ["v"])
    assert sketches.distinct_counts(none, ["v"]).collect() == []
    assert sketches.distinct_counts(sketches.united_sketches(none, [], ["v"]), ["v"]).first()[:] == (0, 0)


def test_larger_sketches_are_closer():
    assert sketches.relative_error(14) == pytest.approx(sketches.relative_error(12) / 2)
