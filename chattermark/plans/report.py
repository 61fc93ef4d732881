"""Report files and the whole analysis, from tables to report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark.operators.activity import comment_activity, in_report_order
from chattermark.operators.clusters import (
    cluster_samples,
    cluster_sizes,
    cluster_statistics,
    sample_lists,
)
from chattermark.operators.embedding import (
    ClusteredComments,
    Encoder,
    cluster_comments,
    encode_texts,
)
from chattermark.operators.profile import (
    activity_over_time,
    commenter_density,
    cumulative_share,
    summary,
)
from chattermark.operators.quality import check_activity, check_clusters, check_texts
from chattermark.operators.suspects import (
    by_peak,
    comments_of_users,
    effective_threshold,
    flag_suspicious,
    suspicious_usernames,
)
from chattermark.settings import AnalysisSettings, ClusterSettings
from chattermark.sources.sinks import write_csv, write_json, write_snapshot
from chattermark.sources.staging import run_folder, stage_at
from chattermark.sources.tables import CommentTables, from_catalog, require_tables


@dataclass
class Analysis:
    """What a run produced."""

    activity: DataFrame
    suspicious: DataFrame
    comments: DataFrame | None = None
    clustered: ClusteredComments | None = None
    files: dict[str, str] = field(default_factory=dict)


def load_activity(tables: CommentTables, options: AnalysisSettings = AnalysisSettings()) -> DataFrame:
    """Activity over the tables with the given settings."""
    return comment_activity(
        tables.comments,
        tables.users,
        tables.videos,
        tables.channels,
        start=options.start,
        end=options.end,
        period_format=options.period_format,
        user_sample=options.user_sample,
        min_comments=options.min_comments,
        peak_grain=options.peak_grain,
    )


def analysis_counts(
    activity: DataFrame, threshold: int | None = None, comments: DataFrame | None = None
) -> DataFrame:
    """One row: activity rows, flagged rows, and comments analysed."""
    flagged = F.col("max_CPP_this_CH") >= effective_threshold(threshold)
    rows = activity.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(flagged).alias("suspicious_users"),
        F.lit(0).cast("long").alias("comments_analyzed"),
    )
    if comments is not None:
        zero = F.lit(0).cast("long")
        rows = rows.unionByName(
            comments.agg(
                zero.alias("total_records"),
                zero.alias("suspicious_users"),
                F.count(F.lit(1)).alias("comments_analyzed"),
            )
        ).agg(*[F.sum(c).alias(c) for c in rows.columns])
    return rows


def write_report(
    activity: DataFrame,
    folder: str,
    threshold: int | None = None,
    clustered: DataFrame | None = None,
    n_samples: int = 5,
    max_periods: int = 10,
    expected_clusters: int | None = None,
    parallelism: int = 4,
) -> dict[str, str]:
    """Write the report of an activity table, and of clustered comments if given.

    Both tables are read several times: pass staged ones. Files are written
    `parallelism` at a time. Lists are in report order, tables in that of their keys, from one part
    file to the next by name. Returns the paths by name. One threshold holds throughout.
    """
    folder = folder.rstrip("/")
    suspicious = flag_suspicious(activity, threshold)
    planned: list[tuple[str, Callable[[DataFrame, str], str], DataFrame, str]] = []

    def put(name: str, write, df: DataFrame, kind: str = "parquet") -> None:
        planned.append((name, write, df, kind))

    def put_ordered(name: str, df: DataFrame, *keys: str) -> None:
        put(name, write_snapshot, df.orderBy(*keys))

    put_ordered("cumulative_share", cumulative_share(activity), "number_comments_all_time")
    put_ordered("activity_by_month", activity_over_time(activity, "month"), "month")
    put("summary", write_json, summary(activity, threshold, clustered), "json")
    put("counts", write_json, analysis_counts(activity, threshold, clustered), "json")
    if not suspicious.isEmpty():
        density = commenter_density(suspicious, max_periods)
        put_ordered(
            "commenter_density", density, "number_comments_all_time", "number_periods_with_comments"
        )
        listed = by_peak(suspicious).select("username", "user_id", "max_CPP_this_CH")
        put("suspicious_commenters", write_csv, listed, "csv")
        names = suspicious_usernames(activity, threshold).orderBy("username")
        put("suspicious_usernames", write_csv, names, "csv")
    put("quality_activity", write_snapshot, check_activity(activity))

    if clustered is not None and "cluster_label" in clustered.columns:
        put("clustered_comments", write_csv, clustered, "csv")
        samples = cluster_samples(clustered, n_samples)
        put("cluster_samples", write_json, sample_lists(samples), "json")
        put_ordered("cluster_sizes", cluster_sizes(clustered), "cluster_label")
        put_ordered("cluster_statistics", cluster_statistics(clustered, activity), "cluster_label")
        put("quality_clusters", write_snapshot, check_clusters(clustered, expected_clusters))
        if "text" in clustered.columns:
            put("quality_texts", write_snapshot, check_texts(clustered))

    def written(entry) -> tuple[str, str]:
        name, write, df, kind = entry
        return name, write(df, f"{folder}/{name}.{kind}")

    with ThreadPool(min(parallelism, len(planned))) as pool:
        return dict(pool.map(inheritable_thread_target(activity.sparkSession)(written), planned))


def run_analysis(
    tables: CommentTables,
    folder: str,
    options: AnalysisSettings = AnalysisSettings(),
    clusters: ClusterSettings = ClusterSettings(),
    include_texts: bool = True,
    text_window: tuple[str | None, str | None] | None = None,
    vector_column: str | None = None,
    load_encoder: Callable[[], Encoder] | None = None,
) -> Analysis:
    """Activity, flagged users, their texts clustered, and the report.

    Texts come from the window of the activity unless another is given. They are
    clustered by `vector_column` of the comments, or by the vectors of the
    encoder that `load_encoder` makes, or else by their words.

    The activity and the clustered comments are kept in `folder`/tables, where the
    results read them. All else that is staged is removed at the end, also after
    a failure.
    """
    spark, folder = tables.comments.sparkSession, folder.rstrip("/")
    with run_folder(spark, "analysis"):
        ordered = in_report_order(load_activity(tables, options))
        activity = stage_at(ordered, f"{folder}/tables/activity")
        suspicious = flag_suspicious(activity, options.threshold)
        result = Analysis(activity, suspicious)
        clustered = None
        if include_texts and not suspicious.isEmpty():
            start, end = text_window or (options.start, options.end)
            comments = comments_of_users(
                tables.comments,
                suspicious,
                start=start,
                end=end,
                user_sample=options.user_sample,
                keep=[vector_column] if vector_column else [],
            )
            if load_encoder and not vector_column:
                vector_column = "embedding"
                comments = encode_texts(comments, load_encoder, output_column=vector_column)
            placed = cluster_comments(comments, vector_column=vector_column, config=clusters)
            clustered = stage_at(placed.table, f"{folder}/tables/clustered")
            result.clustered = replace(placed, table=clustered)
            result.comments = clustered.select(*comments.columns)
        result.files = write_report(
            activity,
            folder,
            options.threshold,
            clustered,
            clusters.n_samples,
            expected_clusters=clusters.n_clusters,
        )
    return result


def run_catalog_analysis(
    spark: SparkSession, folder: str, prefix: str = "", **kwargs
) -> Analysis:
    """`run_analysis` over catalog tables, after checking that they are there."""
    require_tables(spark, prefix)
    return run_analysis(from_catalog(spark, prefix), folder, **kwargs)
