"""Profile of the commenting population: the tables behind its charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chattermark.functions.measures import distinct_with_null, ratio
from chattermark.operators.suspects import effective_threshold, top_commenters


def cumulative_share(activity: DataFrame) -> DataFrame:
    """Share of all comments made by rows with at most so many comments.

    Rows are first summed by comment count, so the running total sees one row
    per distinct count. Distinct counts add up to no more than the number of
    comments, hence there are at most sqrt(2 * comments) of them: about 1.5
    million for 10**12 comments, which one task sorts with ease.
    """
    level = "number_comments_all_time"
    levels = activity.groupBy(level).agg(F.sum(level).alias("level_total"))
    upward = Window.orderBy(level).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    everything = Window.partitionBy()
    return levels.select(
        level,
        ratio(F.sum("level_total").over(upward), F.sum("level_total").over(everything)).alias(
            "cumshare"
        ),
    )


def commenter_density(
    activity: DataFrame, max_periods: int | None = 10, max_comments: int | None = None
) -> DataFrame:
    """Rows by comment count and number of active periods, both below their limits."""
    limits = {
        "number_periods_with_comments": max_periods,
        "number_comments_all_time": max_comments,
    }
    for column, limit in limits.items():
        if limit is not None:
            activity = activity.filter(F.col(column) < limit)
    return (
        activity.groupBy("number_comments_all_time", "number_periods_with_comments")
        .agg(F.count(F.lit(1)).alias("number_commenters"))
    )


def binned_density(
    density: DataFrame, comments_width: int = 1, periods_width: int = 1
) -> DataFrame:
    """Density summed into bins of the given widths, named by their lower edges."""

    def edge(column: str, width: int):
        return (F.floor(F.col(column) / width) * width).cast("long")

    return density.groupBy(
        edge("number_comments_all_time", comments_width).alias("comments_from"),
        edge("number_periods_with_comments", periods_width).alias("periods_from"),
    ).agg(F.sum("number_commenters").alias("number_commenters"))


def activity_over_time(df: DataFrame, date_column: str = "period") -> DataFrame:
    """Rows and distinct users by date column."""
    return df.groupBy(date_column).agg(
        F.count(F.lit(1)).alias("total_comments"),
        distinct_with_null("user_id").alias("unique_users"),
    )


def totals(activity: DataFrame, threshold: int | None = None) -> DataFrame:
    """One row of totals.

    `suspicious_users` counts flagged rows, one per user, channel and month, so
    the percentage can pass 100; `suspicious_distinct_users` counts users.
    """
    flagged = F.col("max_CPP_this_CH") >= effective_threshold(threshold)
    counted = (
        activity.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum("number_comments_all_time").alias("comments"),
            F.count_if(flagged).alias("flagged"),
        )
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("total_records"),
            F.count(F.lit(1)).alias("total_users"),
            F.coalesce(F.sum("comments"), F.lit(0)).alias("total_comments"),
            F.coalesce(F.sum("flagged"), F.lit(0)).alias("suspicious_users"),
            F.count_if(F.col("flagged") > 0).alias("suspicious_distinct_users"),
        )
    )
    users = F.col("total_users")
    return counted.select(
        "*",
        F.coalesce(ratio(F.col("suspicious_users"), users) * 100, F.lit(0.0)).alias(
            "suspicious_percentage"
        ),
        F.coalesce(ratio(F.col("total_comments"), users), F.lit(0.0)).alias(
            "avg_comments_per_user"
        ),
    )


def summary(
    activity: DataFrame,
    threshold: int | None = None,
    clustered: DataFrame | None = None,
    n_top: int = 10,
) -> DataFrame:
    """The summary record: totals, top commenters, and cluster sizes if there are any.

    The parts, one row, `n_top` rows and one row per cluster, are stacked and
    folded into a single row.
    """
    total = totals(activity, threshold)
    parts = total.select(F.struct(*total.columns).alias("totals"))
    top = top_commenters(activity, n_top)
    parts = parts.unionByName(
        top.select(
            F.struct("number_comments_all_time", "max_CPP_this_CH", "username").alias("top")
        ),
        allowMissingColumns=True,
    )
    if clustered is not None:
        sizes = clustered.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("count"))
        parts = parts.unionByName(
            sizes.select(F.struct("cluster_label", "count").alias("cluster")),
            allowMissingColumns=True,
        )
    folded = [
        F.first("totals", ignorenulls=True).alias("totals"),
        F.sort_array(F.collect_list("top"), asc=False).alias("top_commenters"),
    ]
    if clustered is not None:
        folded.append(F.sort_array(F.collect_list("cluster")).alias("cluster_distribution"))
    record = parts.agg(*folded)
    return record.select("totals.*", *record.columns[1:])
