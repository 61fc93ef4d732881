"""Comments and videos stored so that activity needs no shuffle for their join.

Both tables are hashed into the same number of buckets by video; comments are
partitioned by month besides. A join on the video then reads bucket by bucket, with no
exchange on either side, and a date window reads its months only. The price is paid
once, at writing.

Buckets are those of Spark tables, so the tables live in the session's catalog. A video with a
third of all comments is one bucket of each month; `activity_of_layout` counts comments by user,
video and slot inside the bucket before they meet the videos, so what is joined is counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark.operators.activity import comment_activity, published_between
from chattermark.sources.tables import CommentTables

COMMENTS, VIDEOS = "comments_by_video", "videos_by_video"


def write_layout(tables: CommentTables, prefix: str, root: str, buckets: int = 64) -> None:
    """Store comments (bucketed by video, partitioned by month) and videos (bucketed by id).

    They become the catalog tables `<prefix>comments_by_video` and `<prefix>videos_by_video`,
    with files under `root`. Undated comments are in no window and are left out. Rows are dealt by
    bucket before the write, so every bucket of a month is one file.
    """
    dated = published_between(tables.comments, None, None).withColumn(
        "month", F.date_format("published_at", "yyyy-MM")
    )
    dated.repartition(buckets, "video_id").write.mode("overwrite").partitionBy("month").bucketBy(
        buckets, "video_id"
    ).sortBy("video_id").option("path", f"{root}/{COMMENTS}").saveAsTable(prefix + COMMENTS)
    tables.videos.repartition(buckets, "id").write.mode("overwrite").bucketBy(buckets, "id").sortBy(
        "id"
    ).option("path", f"{root}/{VIDEOS}").saveAsTable(prefix + VIDEOS)


def stored_comments(
    spark: SparkSession, prefix: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Stored comments of a window. Months outside it are pruned, the exact bounds filter the rest."""
    rows = spark.table(prefix + COMMENTS)
    if start is not None:
        rows = rows.where(F.col("month") >= start[:7])
    if end is not None:
        rows = rows.where(F.col("month") <= end[:7])
    return published_between(rows, start, end).drop("month")


def stored_videos(spark: SparkSession, prefix: str) -> DataFrame:
    return spark.table(prefix + VIDEOS)


def activity_of_layout(
    spark: SparkSession,
    prefix: str,
    users: DataFrame,
    channels: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    **options,
) -> DataFrame:
    """`comment_activity` over the stored tables."""
    return comment_activity(
        stored_comments(spark, prefix, start, end),
        users,
        stored_videos(spark, prefix),
        channels,
        start=start,
        end=end,
        **options,
    )
