import pytest
from pyspark.sql import functions as F

from chattermark import schemas
from chattermark.operators import quality


def findings(df):
    return {(r.check_name, r.level, r.field): (r.value, r.detail) for r in df.collect()}


def activity(spark, *short):
    rows = [(*r, 1, 1, 1, 1, 1, 1, 1.0, 0.5, 2.0) for r in short]
    return spark.createDataFrame(rows, schemas.ACTIVITY)


def test_structure_of_an_empty_or_incomplete_table(spark):
    empty = spark.createDataFrame([], "user_id long, text string")
    found = findings(quality.check_structure(empty, ["user_id", "published_at"]))
    assert ("empty", "error", None) in found
    assert ("missing_field", "error", "published_at") in found
    assert found["total_columns", "info", None] == (2.0, None)
    assert not quality.is_valid(quality.check_structure(empty, ["user_id"]))


def test_structure_counts_nulls_and_types(spark):
    df = spark.createDataFrame([("1", None), (None, "x"), (None, "y")], "user_id string, other string")
    found = findings(quality.check_structure(df, ["user_id"]))
    assert found["nulls", "warning", "user_id"] == (2.0, None)
    assert found["column_with_nulls", "info", "other"] == (1.0, None)
    assert ("nulls", "warning", "other") not in found
    assert ("not_numeric", "warning", "user_id") in found


def test_activity(spark):
    df = activity(
        spark,
        ("a", 1, "c", "2024-01", 5),
        ("a", 2, "d", "2024-03", 100001),
        ("b", 3, None, "2024-02", -1),
        (None, None, "c", "2024-02", 1),
    )
    found = findings(quality.check_activity(df))
    assert found["high_comment_count", "warning", "number_comments_all_time"] == (100001.0, None)
    assert found["negative_comment_count", "error", "number_comments_all_time"] == (1.0, None)
    assert found["shared_username", "warning", "username"] == (1.0, None)
    assert found["date_range_min", "info", "month"] == (None, "2024-01")
    assert found["date_range_max", "info", "month"] == (None, "2024-03")
    assert found["unique_users", "info", "user_id"] == (4.0, None)
    assert found["unique_channels", "info", "channel_title"] == (3.0, None)
    assert not quality.is_valid(quality.check_activity(df))


def test_activity_without_findings_or_fields(spark):
    df = activity(spark, ("a", 1, "c", "2024-01", 5))
    assert quality.is_valid(quality.check_activity(df))
    assert {k[1] for k in findings(quality.check_activity(df))} == {"info"}
    short = findings(quality.check_activity(df.drop("username")))
    assert ("missing_field", "error", "username") in short
    assert not any(k[0] == "unique_users" for k in short)


def test_empty_activity(spark):
    found = findings(quality.check_activity(spark.createDataFrame([], schemas.ACTIVITY)))
    assert set(found) == {
        ("empty", "error", None), ("total_rows", "info", None), ("total_columns", "info", None),
    }


def text_table(spark, texts, dated=True):
    rows = spark.createDataFrame(list(enumerate(texts)), "comment_id long, text string")
    time = F.lit("2024-01-01").cast("timestamp_ntz") if dated else F.lit(None).cast("timestamp_ntz")
    return rows.select("comment_id", (F.col("comment_id") + 1).alias("user_id"), "text",
                       time.alias("published_at"))


def test_texts(spark):
    texts = ["same text", "same text", "same text", None, None, "abcd", "привет", "x" * 10]
    found = findings(quality.check_texts(text_table(spark, texts)))
    assert found["short_text", "warning", "text"] == (3.0, None)
    assert found["unique_text_ratio", "info", "text"] == (5 / 8, None)
    assert found["duplicate_text", "warning", "text"] == (1 - 5 / 8, None)
    lengths = [9, 9, 9, 4, 6, 10]
    assert found["avg_length", "info", "text"][0] == pytest.approx(sum(lengths) / 6)
    assert found["median_length", "info", "text"] == (9.0, None)
    assert found["max_length", "info", "text"] == (10.0, None)
    assert found["min_length", "info", "text"] == (4.0, None)
    assert found["nulls", "warning", "text"] == (2.0, None)
    assert ("no_dates", "warning", "published_at") not in found


def test_median_of_an_even_number_lies_between(spark):
    found = findings(quality.check_texts(text_table(spark, ["a", "ab", "abc", "a" * 10])))
    assert found["median_length", "info", "text"] == (2.5, None)


def test_texts_without_dates_or_rows(spark):
    found = findings(quality.check_texts(text_table(spark, ["abcdef"], dated=False)))
    assert found["no_dates", "warning", "published_at"] == (0.0, None)
    found = findings(quality.check_texts(text_table(spark, ["abcdef"]).limit(0)))
    assert [k[0] for k in found if k[1] != "info"] == ["empty"]
    assert not any(k[0].endswith("length") for k in found)


def test_clusters(spark):
    rows = [(0, float(i), 1.0) for i in range(6)]
    rows += [(1, None, 1.0), (1, float("inf"), 1.0), (1, float("-inf"), 2.0), (1, 1.0, None)]
    df = spark.createDataFrame(rows, "cluster_label int, proj_x double, proj_y double")
    found = findings(quality.check_clusters(df, expected_clusters=3))
    assert found["unique_clusters", "info", "cluster_label"] == (2.0, None)
    assert found["cluster_count", "warning", "cluster_label"] == (2.0, None)
    assert found["small_cluster", "warning", "cluster_label"] == (4.0, None)
    assert found["null_coordinate", "warning", "proj_x"] == (1.0, None)
    assert found["infinite_coordinate", "warning", "proj_x"] == (2.0, None)
    assert found["null_coordinate_count", "info", "proj_y"] == (1.0, None)
    assert ("infinite_coordinate", "warning", "proj_y") not in found
    assert quality.is_valid(quality.check_clusters(df))


def test_clusters_without_coordinates(spark):
    df = spark.createDataFrame([(1,)], "cluster_label int")
    found = findings(quality.check_clusters(df))
    assert set(found) == {("missing_field", "error", "proj_x"), ("missing_field", "error", "proj_y")}
