"""Tables about clusters: sizes, statistics and sample texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATS_GRAINS = ("row", "user")


def cluster_rows(df: DataFrame, cluster_id, label_column: str = "cluster_label") -> DataFrame:
    """Rows of one cluster."""
    return df.filter(F.col(label_column) == cluster_id)


def cluster_sizes(df: DataFrame, label_column: str = "cluster_label") -> DataFrame:
    """Number of rows by cluster."""
    return df.groupBy(label_column).agg(F.count(F.lit(1)).alias("count"))


def cluster_statistics(
    clustered: DataFrame,
    activity: DataFrame,
    stats_grain: str = "row",
    label_column: str = "cluster_label",
) -> DataFrame:
    """Size of each cluster and means of its commenters' activity.

    At `row` grain the figures are those of clustered comments left-joined with
    activity on the user, where a comment meets every activity row of its user.
    That join is not made: comments are counted by cluster and user, activity is
    summed by user, and the products of the two add up to the same figures, one
    row per cluster and user at most. At `user` grain each comment meets its
    user once: total comments, highest peak, and likes per comment overall.
    """
    if stats_grain not in STATS_GRAINS:
        raise ValueError(f"stats_grain must be one of {STATS_GRAINS}, not {stats_grain!r}")

    comments = clustered.groupBy(label_column, "user_id").agg(F.count(F.lit(1)).alias("weight"))
    if stats_grain == "row":
        measured = {
            "comments": "number_comments_all_time",
            "max_cpp": "max_CPP_this_CH",
            "likes_per_comment": "mean_likes_per_comment",
        }
        per_user = activity.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.sum(c).cast("double").alias(f"sum_{m}") for m, c in measured.items()],
            *[F.count(c).alias(f"n_{m}") for m, c in measured.items()],
        )
    else:
        measured = {"comments": None, "max_cpp": None, "likes_per_comment": None}
        folded = activity.groupBy("user_id").agg(
            F.sum("number_comments_all_time").cast("double").alias("sum_comments"),
            F.max("max_CPP_this_CH").cast("double").alias("sum_max_cpp"),
            F.try_divide(
                F.sum("total_likes_all_time").cast("double"), F.sum("number_comments_all_time")
            ).alias("sum_likes_per_comment"),
        )
        per_user = folded.select(
            "*",
            F.lit(1).alias("n_rows"),
            *[F.col(f"sum_{m}").isNotNull().cast("long").alias(f"n_{m}") for m in measured],
        )

    weight = F.col("weight")
    return (
        comments.join(per_user, "user_id", "left")
        .groupBy(label_column)
        .agg(
            F.sum(weight * F.coalesce("n_rows", F.lit(1))).alias("count"),
            *[
                F.try_divide(F.sum(weight * F.col(f"sum_{m}")), F.sum(weight * F.col(f"n_{m}"))).alias(
                    f"avg_{m}"
                )
                for m in measured
            ],
        )
    )


def cluster_samples(
    df: DataFrame,
    n_samples: int = 10,
    text_column: str = "text",
    label_column: str = "cluster_label",
    order_column: str = "comment_id",
) -> DataFrame:
    """The first texts of every cluster by comment id, in one job.

    Spark keeps only the first `n_samples` rows per cluster in each task before
    the shuffle, so a cluster of any size sends little to its final task.
    """
    first = Window.partitionBy(label_column).orderBy(order_column)
    return (
        df.select(label_column, order_column, text_column)
        .withColumn("rank", F.row_number().over(first))
        .filter(F.col("rank") <= n_samples)
    )


def samples_of_cluster(
    df: DataFrame,
    cluster_id,
    n_samples: int = 10,
    text_column: str = "text",
    order_column: str = "comment_id",
) -> DataFrame:
    """The first texts of one cluster by comment id."""
    return cluster_rows(df, cluster_id).orderBy(order_column).limit(n_samples).select(text_column)


def sample_lists(
    samples: DataFrame, label_column: str = "cluster_label", text_column: str = "text"
) -> DataFrame:
    """Samples as one list per cluster, named `cluster_<label>`."""
    return samples.groupBy(label_column).agg(
        F.sort_array(F.collect_list(F.struct("rank", text_column))).alias("ranked")
    ).select(
        F.concat(F.lit("cluster_"), F.col(label_column).cast("string")).alias("cluster"),
        F.col(f"ranked.{text_column}").alias("samples"),
    )
