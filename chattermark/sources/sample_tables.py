"""The driver's test tables, seen as comments, users, videos and channels.

Whole tables are mapped; no row is filtered out. Ids are shifted so that some
comments have an unknown user, video or channel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark.sources.tables import CommentTables

# Fixed values of the mapping, the same in the SQL the results are checked with.
USER_SHIFT = 7
VIDEO_SHIFT = 10
REPLIES = {"purchase": 2, "click": 1}

# Declared, so that no job has to look into the files for them.
COLUMNS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
    "value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "customer": "c_custkey long, c_name string",
    "part": "p_partkey long, p_size int",
    "nation": "n_nationkey int, n_name string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as comments, without text."""
    kind = F.col("event_type")
    replies = F.lit(0)
    for name, count in REPLIES.items():
        replies = F.when(kind == name, count).otherwise(replies)
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("published_at"),
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("video_id"),
        F.floor("value").cast("long").alias("like_count"),
        replies.cast("long").alias("reply_count"),
    )


def comments_with_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as comments; the text is the document of the same id, if there is one."""
    texts = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return comments(spark, sf_dir).join(texts, "id", "left")


def tables(spark: SparkSession, sf_dir: str, with_text: bool = False) -> CommentTables:
    load = comments_with_text if with_text else comments
    return CommentTables(
        comments=load(spark, sf_dir),
        users=read(spark, sf_dir, "customer").select(
            (F.col("c_custkey") + USER_SHIFT).alias("id"), F.col("c_name").alias("username")
        ),
        videos=read(spark, sf_dir, "part").select(
            (F.col("p_partkey") + VIDEO_SHIFT).alias("id"),
            F.floor(F.col("p_size") / 2).cast("long").alias("channel_id"),
        ),
        channels=read(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("title")
        ),
    )
