"""A key that holds a third of all rows: joins split it, figures stay whole."""

import pytest
from pyspark.sql import functions as F

N = 120_000
CONF = {
    # Small tables would be coalesced into one task, which leaves nothing to split.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


@pytest.fixture
def no_broadcast(spark):
    for key, value in CONF.items():
        spark.conf.set(key, value)
    yield
    for key in CONF:
        spark.conf.unset(key)


@pytest.fixture
def skewed(spark, tmp_path):
    from chattermark.sources.tables import CommentTables

    def hot(column, n):
        return F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.hash("id", F.lit(column)) % n)

    comments = spark.range(0, N, 1, 8).select(
        "id",
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 61))
        .cast("timestamp_ntz")
        .alias("published_at"),
        F.abs(hot("user", 3000)).cast("long").alias("user_id"),
        F.abs(hot("video", 400)).cast("long").alias("video_id"),
        (F.col("id") % 11).alias("like_count"),
        (F.col("id") % 2).alias("reply_count"),
    )
    comments.write.parquet(f"{tmp_path}/comments")
    return CommentTables(
        comments=spark.read.parquet(f"{tmp_path}/comments"),
        users=spark.range(2900).select("id", F.concat(F.lit("u"), "id").alias("username")),
        videos=spark.range(390).select("id", (F.col("id") % 20).alias("channel_id")),
        channels=spark.range(20).select("id", F.concat(F.lit("c"), "id").alias("title")),
    )


@pytest.mark.parametrize("grain", ["video", "channel"])
def test_hot_user_and_video(spark, no_broadcast, skewed, activity_of, grain):
    activity = activity_of(skewed, peak_grain=grain, period_format="%Y-%m-%d %H:%i")
    totals = activity.agg(F.sum("number_comments_all_time"), F.sum("total_likes_all_time"))
    found = tuple(totals.collect()[0])
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan

    kept = skewed.comments
    if grain == "video":
        kept = kept.filter("user_id < 2900 and video_id < 390")
    expected = kept.agg(F.count(F.lit(1)), F.sum("like_count")).head()
    assert found == tuple(expected)

    hot = activity.filter("user_id = 5").agg(F.sum("number_comments_all_time")).head()[0]
    assert hot == kept.filter("user_id = 5").count() > N / 3 * 0.9


def test_texts_of_a_hot_user(spark, no_broadcast, skewed):
    from chattermark.operators.suspects import comments_of_users

    texts = skewed.comments.withColumn("text", F.repeat(F.lit("x"), F.lit(20)))
    ids = skewed.users.filter("id < 50").select(F.col("id").alias("user_id"))
    found = comments_of_users(texts, ids).agg(F.count(F.lit(1)))
    assert found.collect()[0][0] == skewed.comments.filter("user_id < 50").count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_copies_of_one_text(spark):
    from chattermark.operators.quality import check_texts

    rows = spark.range(30_000).select(
        F.col("id").alias("comment_id"),
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(
            F.concat(F.lit("text "), F.col("id"))
        ).alias("text"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("published_at"),
    )
    found = {r.check_name: r.value for r in check_texts(rows).collect()}
    assert found["unique_text_ratio"] == pytest.approx(20_001 / 30_000)
