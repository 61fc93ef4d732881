"""

All queries read the whole test tables through the mapping in
`chattermark.sources.sample_tables`. That data covers one month and few
comments per minute, so the queries count by day and flag peaks from 2.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark import schemas
from chattermark.functions import texts
from chattermark.operators import (
    activity,
    clusters,
    distances,
    embedding,
    profile,
    quality,
    similar,
    sketches,
    suspects,
)
from chattermark.plans import report
from chattermark.settings import AnalysisSettings
from chattermark.sources import layout, sample_tables, sinks, snapshots, staging, tables

try:
    import corpus_pipeline
    from chattermark.llm import queries as llm
except ModuleNotFoundError as missing:  # both are removed together
    if missing.name not in ("corpus_pipeline", "chattermark.llm"):
        raise
    corpus_pipeline = llm = None

START, END = "2024-01-01", "2024-02-01"
TEXT_START, TEXT_END = "2024-01-02", "2024-01-28"
DAY = "%Y-%m-%d"
THRESHOLD = 2

Query = Callable[[SparkSession, str], DataFrame]


# --- Spark ---------------------------------------------------------------


def _activity(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    source = sample_tables.tables(spark, sf_dir)
    given = {"start": START, "end": END, "period_format": DAY, **options}
    return activity.comment_activity(
        source.comments, source.users, source.videos, source.channels, **given
    )


def _channel_activity(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return _activity(spark, sf_dir, peak_grain="channel", **options)


def _rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    for column in columns:
        df = df.withColumn(column, F.round(column, places))
    return df


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment texts of all commenters, those without a document included."""
    return sample_tables.comments_with_text(spark, sf_dir).withColumnRenamed("id", "comment_id")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments that have a document, with its language as cluster label."""
    documents = sample_tables.read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("comment_id"), "text", F.col("lang").alias("cluster_label")
    )
    found = sample_tables.comments(spark, sf_dir).withColumnRenamed("id", "comment_id")
    return found.join(documents, "comment_id")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_tables.read(spark, sf_dir, "embeddings")


def _by_dimension(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return df.select(id_column, F.posexplode(vector_column).alias("dim", "value")).withColumn(
        "value", F.round("value", 4)
    )


def activity_all_channel_peaks(spark, sf_dir, **options):
    wide = _channel_activity(spark, sf_dir, all_channel_peaks=True, **options)
    return wide.select(
        "username", "user_id", "channel_title", "month", "max_CPP_this_CH",
        "max_CPP_all_CH", "max_CPP_one_CH",
    )


def activity_stored_months(spark, sf_dir):
    """Activity of four months, stored while a third of March was missing, then brought up to date.

    Events are moved on by up to three months, as the tables cover one.
    """
    source = sample_tables.tables(spark, sf_dir)
    spread = F.expr("published_at + make_ym_interval(0, CAST(id % 4 AS INT))")
    source = replace(source, comments=source.comments.withColumn("published_at", spread))
    late = (F.month("published_at") == 3) & (F.col("id") % 3 == 0)
    path = staging.new_folder(spark, "activity-by-month")

    def between(comments):
        return lambda start, end: activity.comment_activity(
            comments, source.users, source.videos, source.channels, start=start, end=end, period_format=DAY
        )

    early = source.comments.where(~late)
    snapshots.update_months(spark, path, snapshots.changed_months(early), between(early))
    arrived = source.comments.where(late)
    snapshots.update_months(spark, path, snapshots.changed_months(arrived), between(source.comments))
    schema = between(early)("2024-01-01", "2024-02-01").schema
    return snapshots.read_months(spark, path, schema)


def activity_stored_layout(spark, sf_dir):
    """Activity from comments and videos stored in buckets by video."""
    source = sample_tables.tables(spark, sf_dir)
    prefix = f"layout_{uuid.uuid4().hex}_"
    layout.write_layout(source, prefix, staging.new_folder(spark, "layout"), buckets=8)
    return layout.activity_of_layout(
        spark, prefix, source.users, source.channels, start=START, end=END, period_format=DAY
    )


def suspicious_rows(spark, sf_dir):
    return suspects.by_peak(suspects.flag_suspicious(_channel_activity(spark, sf_dir), THRESHOLD))


def suspicious_comment_text(spark, sf_dir):
    flagged = suspects.flag_suspicious(_activity(spark, sf_dir), THRESHOLD)
    return suspects.comments_of_users(
        sample_tables.comments_with_text(spark, sf_dir), flagged, start=TEXT_START, end=TEXT_END
    ).orderBy("comment_id")


def cumulative_share(spark, sf_dir):
    return _rounded(profile.cumulative_share(_channel_activity(spark, sf_dir)), "cumshare")


def commenter_density_bins(spark, sf_dir):
    density = profile.commenter_density(_channel_activity(spark, sf_dir))
    return profile.binned_density(density, comments_width=5, periods_width=2)


def comment_timeseries(spark, sf_dir):
    dated = activity.comment_periods(sample_tables.comments(spark, sf_dir), DAY)
    return profile.activity_over_time(dated, "period")


def users_by_sketch(spark, sf_dir):
    """Comments and users of every channel over all days, from sketches by day and channel.

    The estimate itself is no fixed number, so the row says whether it lies within four standard errors.
    """
    source = sample_tables.tables(spark, sf_dir)
    titles = activity.video_titles(source.videos, source.channels, keep_orphans=True)
    placed = source.comments.join(titles, "video_id", "left").withColumn("day", F.to_date("published_at"))
    daily = staging.stage(sketches.distinct_sketches(placed, ["day", "channel_title"], ["user_id"]), "sketches")
    whole = sketches.distinct_counts(
        sketches.united_sketches(daily, ["channel_title"], ["user_id"]), ["user_id"]
    )
    exact = profile.activity_over_time(placed, "channel_title")
    bound = 4 * sketches.relative_error() * F.col("unique_users")
    return (
        whole.withColumnRenamed("channel_title", "title")
        .join(exact, F.col("title").eqNullSafe(F.col("channel_title")))
        .select(
            "channel_title",
            F.col("n_rows").alias("n_comments"),
            "unique_users",
            (F.abs(F.col("user_id_count") - F.col("unique_users")) <= bound).alias("estimate_close"),
        )
    )


def summary_totals(spark, sf_dir):
    return _rounded(
        profile.totals(_channel_activity(spark, sf_dir), THRESHOLD),
        "suspicious_percentage",
        "avg_comments_per_user",
    )


def summary_record(spark, sf_dir):
    """The nested summary, its lists spelled out as text."""
    record = profile.summary(_activity(spark, sf_dir), THRESHOLD, _labelled(spark, sf_dir))

    def spelled(column, *fields):
        return F.array_join(
            F.transform(column, lambda x: F.concat_ws(":", *[x[f].cast("string") for f in fields])),
            ",",
        ).alias(column)

    return record.select(
        "total_users",
        "total_comments",
        "suspicious_users",
        spelled("top_commenters", "username", "number_comments_all_time", "max_CPP_this_CH"),
        spelled("cluster_distribution", "cluster_label", "count"),
    )


def analysis_counts(spark, sf_dir):
    return report.analysis_counts(
        _activity(spark, sf_dir), THRESHOLD, suspicious_comment_text(spark, sf_dir)
    )


def quality_structure(spark, sf_dir):
    nameless = _channel_activity(spark, sf_dir).drop("username")
    return quality.check_structure(nameless, schemas.ACTIVITY_REQUIRED)


def quality_activity(spark, sf_dir):
    return _rounded(
        quality.check_activity(staging.stage(_channel_activity(spark, sf_dir), "activity")), "value"
    )


def quality_text(spark, sf_dir):
    return _rounded(quality.check_texts(_texts(spark, sf_dir)), "value")


def quality_clusters(spark, sf_dir):
    placed = _vectors(spark, sf_dir).select(
        F.col("label").alias("cluster_label"),
        F.get("embedding", F.lit(0)).alias("proj_x"),
        F.get("embedding", F.lit(1)).alias("proj_y"),
    )
    return quality.check_clusters(placed, expected_clusters=8)


def clean_comments(spark, sf_dir):
    rows = sample_tables.read(spark, sf_dir, "documents").filter(texts.is_usable("text"))
    return rows.select("doc_id", texts.strip("text").alias("text"))


def comment_preview(spark, sf_dir):
    rows = sample_tables.read(spark, sf_dir, "documents")
    return rows.select("doc_id", texts.preview("text").alias("preview"))


def short_texts(spark, sf_dir):
    return _texts(spark, sf_dir).filter(texts.is_short("text")).select("comment_id", "text")


def sql_parameters(spark, sf_dir):
    return tables.run_sql(
        spark,
        """
        SELECT video_id, count(*) AS n_comments, max(like_count) AS max_likes
        FROM {sampled_comments}
        WHERE published_at >= to_timestamp_ntz(:start) AND published_at < to_timestamp_ntz(:end)
        GROUP BY video_id HAVING count(*) >= :min_comments
        """,
        {"sampled_comments": sample_tables.comments(spark, sf_dir)},
        start=TEXT_START,
        end=TEXT_END,
        min_comments=90,
    )


def vector_pair_distances(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    pairs = vectors.select(
        F.col("vec_id").alias("id_a"), F.col("label").cast("long").alias("id_b")
    )
    return _rounded(
        distances.pair_distances(vectors, pairs),
        "cosine_similarity", "cosine_distance", "euclidean", "manhattan",
        places=4,
    )


def vector_matrix_means(spark, sf_dir):
    return _rounded(
        distances.matrix_row_means(_vectors(spark, sf_dir)),
        "mean_cosine_similarity", "mean_cosine_distance", "mean_squared_euclidean",
        places=4,
    )


def vector_normalized(spark, sf_dir):
    return _by_dimension(distances.normalized(_vectors(spark, sf_dir)), "vec_id", "unit")


def mean_pooling(spark, sf_dir):
    tokens = _vectors(spark, sf_dir).select(
        F.col("label").alias("doc_id"),
        F.col("embedding").alias("vec"),
        (F.get("embedding", F.lit(0)) > 0).cast("int").alias("mask"),
    )
    return _by_dimension(distances.mean_pooling(tokens), "doc_id", "embedding")


def vector_similar_pairs(spark, sf_dir):
    """All vectors and a shifted copy of each: pairs within 0.065, all of them found, equal vectors included.

    The copy's component number `vec_id % 64` is larger by 0.01 to 0.1.
    """
    vectors = _vectors(spark, sf_dir).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    at = (F.col("vec_id") % 64 + 1).cast("int")
    step = (F.col("vec_id") % 10 + 1) / 100
    moved = F.transform("v", lambda x, i: F.when(i + 1 == at, x + step).otherwise(x))
    shifted = vectors.withColumn("v", moved).withColumn("vec_id", -F.col("vec_id") - 1)
    both = vectors.unionByName(shifted)
    pairs = similar.similar_pairs(both, 0.065, vector_column="v", most=512, copies=True)
    return _rounded(pairs, "distance", places=4)


def _reduced(spark, sf_dir, n_components: int = 50) -> embedding.Reduction:
    vectors = embedding.as_vectors(_vectors(spark, sf_dir), "embedding", "features")
    return embedding.reduce_dimensions(vectors, n_components=n_components)


def pca_components(spark, sf_dir):
    placed = embedding.with_projection(_reduced(spark, sf_dir).table)
    return placed.select(
        "vec_id", "proj_x", "proj_y", vector_to_array("components").alias("components")
    )


def pca_lengths(spark, sf_dir):
    """All components keep lengths: that of a vector is its distance from the mean vector."""
    components = vector_to_array("components")
    squares = F.aggregate(components, F.lit(0.0), lambda total, x: total + x * x)
    return _reduced(spark, sf_dir, n_components=64).table.select(
        "vec_id", F.round(squares, 4).alias("squared_length")
    )


def pca_explained(spark, sf_dir):
    reduction = _reduced(spark, sf_dir, n_components=64)
    return reduction.table.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(reduction.explained_variance)).alias("n_components"),
        F.lit(round(reduction.explained, 6)).alias("explained"),
    )


def kmeans_event_types(spark, sf_dir):
    """Clusters of one-hot event types: one for each type, named by its smallest id."""
    events = sample_tables.read(spark, sf_dir, "events").select("event_id", "event_type")
    types = sorted(r[0] for r in events.select("event_type").distinct().collect())
    one_hot = F.array(*[(F.col("event_type") == t).cast("double") for t in types])
    points = embedding.as_vectors(events.withColumn("hot", one_hot), "hot", "features")
    model, _ = embedding.best_kmeans(points, "features", len(types), layout_column="event_id")
    labelled = model.transform(points).select("event_id", "cluster_label")
    names = labelled.groupBy("cluster_label").agg(F.min("event_id").alias("cluster_name"))
    return labelled.join(names, "cluster_label").select("event_id", "cluster_name")


def word_totals(spark, sf_dir):
    """Words of every document, from its hashed word counts."""
    documents = sample_tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    counts = F.unwrap_udt("counts").getField("values")
    total = F.aggregate(counts, F.lit(0.0), lambda total, x: total + x)
    return embedding.hashed_words(documents).select("doc_id", total.cast("long").alias("n_words"))


def csv_round_trip(spark, sf_dir):
    """All documents as CSV, read back."""
    documents = sample_tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    path = sinks.write_csv(documents, staging.new_folder(spark, "csv"))
    return sinks.read_csv(spark, path, "doc_id long, text string")


def catalog_check(spark, sf_dir):
    """The four tables as views: whether they and their columns are there, and their rows."""
    source = sample_tables.tables(spark, sf_dir, with_text=True)
    source.register("checked_")
    rows = None
    for name, df in source.items():
        one = df.agg(F.lit(f"checked_{name}").alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        rows = one if rows is None else rows.unionByName(one)
    found = tables.check_catalog(spark, "checked_").select(
        "table_name", "present", F.size("missing_columns").alias("n_missing")
    )
    return found.join(rows, "table_name")


def report_rows(spark, sf_dir):
    """Rows of the report files that describe the activity, after writing and reading back."""
    folder = staging.new_folder(spark, "report")
    counted = staging.stage(_activity(spark, sf_dir), "activity")
    files = report.write_report(counted, folder, THRESHOLD)
    rows = None
    for name, path in sorted(files.items()):
        kind = path.rsplit(".", 1)[1]
        if name == "quality_activity":
            continue
        if kind == "csv":
            columns = "a string, b string, c string" if name == "suspicious_commenters" else "a string"
            table = sinks.read_csv(spark, path, columns)
        else:
            table = spark.read.format(kind).load(path)
        one = table.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


def kmeans_clusters(spark, sf_dir):
    scores = staging.stage(
        _reduced(spark, sf_dir).table.select("vec_id", "components"), "scores"
    )
    model, _ = embedding.best_kmeans(scores, layout_column="vec_id")
    return model.transform(scores).select("vec_id", "cluster_label")


def comment_clusters(spark, sf_dir):
    return embedding.cluster_comments(_labelled(spark, sf_dir).drop("cluster_label")).table


def label_samples(spark, sf_dir):
    samples = clusters.cluster_samples(_labelled(spark, sf_dir), n_samples=5)
    return samples.select(
        "cluster_label", "rank", "comment_id", texts.preview("text").alias("preview")
    )


def report_tables(spark, sf_dir):
    """Runs the analysis, writes its report, and counts what can be read back."""
    source = sample_tables.tables(spark, sf_dir, with_text=True)
    options = AnalysisSettings(start=START, end=END, period_format=DAY, threshold=THRESHOLD)
    result = report.run_analysis(source, staging.new_folder(spark, "report"), options)
    counted = None
    for name, path in sorted(result.files.items()):
        kind = path.rsplit(".", 1)[1]
        reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
        rows = reader.format(kind).load(path)
        one = rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        counted = one if counted is None else counted.unionByName(one)
    return counted


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: suspicious activity, highest peaks first within each month."""
    flagged = suspects.flag_suspicious(_activity(spark, "/root/testdata/sf0.001"), THRESHOLD)
    return activity.in_report_order(flagged)


def queries() -> dict[str, Query]:
    return {
        "activity_video_peak": _activity,
        "activity_channel_peak": lambda s, d: activity.in_report_order(_channel_activity(s, d)),
        "activity_minute_peak": lambda s, d: _activity(s, d, period_format="%Y-%m-%d %H:%i"),
        "activity_channel_minute_peak": lambda s, d: _channel_activity(
            s, d, period_format="%Y-%m-%d %H:%i"
        ),
        "activity_hour_of_month": lambda s, d: _channel_activity(s, d, period_format="%Y-%m %H"),
        "activity_all_channel_peak": activity_all_channel_peaks,
        "activity_sampled": lambda s, d: _activity(s, d, user_sample=9, min_comments=3),
        "activity_stored_months": activity_stored_months,
        "activity_stored_layout": activity_stored_layout,
        "suspicious_rows": suspicious_rows,
        "suspicious_list": lambda s, d: suspects.suspicious_list(_activity(s, d), THRESHOLD),
        "suspicious_usernames": lambda s, d: suspects.suspicious_usernames(
            _channel_activity(s, d), THRESHOLD
        ),
        "suspicious_comment_text": suspicious_comment_text,
        "top_commenters": lambda s, d: suspects.top_commenters(_channel_activity(s, d)),
        "top_suspicious": lambda s, d: suspects.top_suspicious(
            _channel_activity(s, d), threshold=THRESHOLD
        ),
        "cumulative_share": cumulative_share,
        "commenter_density": lambda s, d: profile.commenter_density(_channel_activity(s, d)),
        "commenter_scatter": lambda s, d: profile.commenter_density(
            _channel_activity(s, d), max_periods=None, max_comments=60
        ),
        "commenter_density_bins": commenter_density_bins,
        "activity_timeseries": lambda s, d: profile.activity_over_time(
            _channel_activity(s, d), "month"
        ),
        "comment_timeseries": comment_timeseries,
        "users_by_sketch": users_by_sketch,
        "summary_totals": summary_totals,
        "summary_record": summary_record,
        "analysis_counts": analysis_counts,
        "quality_structure": quality_structure,
        "quality_activity": quality_activity,
        "quality_text": quality_text,
        "quality_clusters": quality_clusters,
        "clean_comments": clean_comments,
        "comment_preview": comment_preview,
        "short_texts": short_texts,
        "sql_parameters": sql_parameters,
        "vector_pair_distances": vector_pair_distances,
        "vector_matrix_means": vector_matrix_means,
        "vector_similar_pairs": vector_similar_pairs,
        "vector_normalized": vector_normalized,
        "mean_pooling": mean_pooling,
        "pca_components": pca_components,
        "pca_explained": pca_explained,
        "pca_lengths": pca_lengths,
        "kmeans_event_types": kmeans_event_types,
        "word_totals": word_totals,
        "csv_round_trip": csv_round_trip,
        "catalog_check": catalog_check,
        "report_rows": report_rows,
        "activity_all_channel_minute_peak": lambda s, d: activity_all_channel_peaks(
            s, d, period_format="%Y-%m-%d %H:%i"
        ),
        "kmeans_clusters": kmeans_clusters,
        "comment_clusters": comment_clusters,
        "label_distribution": lambda s, d: clusters.cluster_sizes(_labelled(s, d)),
        "label_statistics": lambda s, d: _rounded(
            clusters.cluster_statistics(_labelled(s, d), _activity(s, d)),
            "avg_comments", "avg_max_cpp", "avg_likes_per_comment",
        ),
        "label_statistics_by_user": lambda s, d: _rounded(
            clusters.cluster_statistics(_labelled(s, d), _activity(s, d), stats_grain="user"),
            "avg_comments", "avg_max_cpp", "avg_likes_per_comment",
        ),
        "label_samples": label_samples,
        "label_members": lambda s, d: clusters.cluster_rows(_vectors(s, d), 3, "label").select(
            "vec_id", "label"
        ),
        "label_sample_texts": lambda s, d: clusters.samples_of_cluster(_labelled(s, d), "fr"),
        "report_tables": report_tables,
        **({**llm.QUERIES, "pipeline": corpus_pipeline.run} if llm else {}),
    }


# --- SQL -----------------------------------------------------------------

_TABLES = """
comments AS (
    SELECT event_id AS id, ts AS published_at, user_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS video_id,
           CAST(floor(value) AS BIGINT) AS like_count,
           CAST(CASE event_type WHEN 'purchase' THEN 2 WHEN 'click' THEN 1 ELSE 0 END AS BIGINT)
               AS reply_count
    FROM events
),
users AS (SELECT c_custkey + 7 AS id, c_name AS username FROM customer),
videos AS (
    SELECT p_partkey + 10 AS id, CAST(floor(p_size / 2) AS BIGINT) AS channel_id FROM part
),
channels AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS title FROM nation)
"""

_LABELLED = """
labelled AS (
    SELECT c.*, c.id AS comment_id, d.text, d.lang AS cluster_label
    FROM comments c JOIN documents d ON d.doc_id = c.id
)
"""


def _activity_ctes(grain: str, pattern: str, sample: int = 100, min_comments: int = 1) -> str:
    """CTE `activity` at the given grain, and `placed`, the joined comments."""
    join = "JOIN" if grain == "video" else "LEFT JOIN"
    video = ", video_id" if grain == "video" else ""
    if grain == "video":
        ratios = """
            CASE WHEN n > 0 THEN round(likes::DOUBLE / n, 4) ELSE 0 END AS mean_likes_per_comment,
            CASE WHEN n > 0 THEN round(replies::DOUBLE / n, 4) ELSE 0 END
                AS mean_replies_per_comment,
            CASE WHEN replies > 0 THEN round(likes::DOUBLE / replies, 4) END
                AS mean_likes_per_reply"""
    else:
        ratios = """
            likes::DOUBLE / nullif(n, 0) AS mean_likes_per_comment,
            replies::DOUBLE / nullif(n, 0) AS mean_replies_per_comment,
            likes::DOUBLE / nullif(replies, 0) AS mean_likes_per_reply"""
    return f"""{_TABLES},
placed AS (
    SELECT c.user_id AS raw_user_id, u.id AS user_id, u.username, c.video_id, v.channel_id,
           ch.title AS channel_title, strftime(c.published_at, '{pattern}') AS period,
           c.like_count, c.reply_count
    FROM comments c
    {join} users u ON u.id = c.user_id
    {join} videos v ON v.id = c.video_id
    {join} channels ch ON ch.id = v.channel_id
    WHERE c.published_at >= TIMESTAMP '{START}' AND c.published_at < TIMESTAMP '{END}'
      AND c.user_id % 100 <= {sample}
),
per_period AS (
    SELECT user_id, username, channel_title, period{video}, count(*) AS n,
           sum(like_count) AS likes, sum(reply_count) AS replies,
           max(like_count) AS top_likes, max(reply_count) AS top_replies
    FROM placed GROUP BY user_id, username, channel_title, period{video}
),
per_month AS (
    SELECT user_id, username, channel_title, substr(period, 1, 7) AS month,
           CAST(sum(n) AS BIGINT) AS n, count(DISTINCT period) AS periods, max(n) AS peak,
           CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(replies) AS BIGINT) AS replies,
           max(top_likes) AS top_likes, max(top_replies) AS top_replies
    FROM per_period GROUP BY ALL
),
activity AS (
    SELECT username, user_id, channel_title, month, n AS number_comments_all_time,
           periods AS number_periods_with_comments, peak AS "max_CPP_this_CH",
           likes AS total_likes_all_time, replies AS total_replies_all_time,
           top_likes AS max_likes, top_replies AS max_replies, {ratios}
    FROM per_month WHERE n >= {min_comments}
)"""


def oracle_sql() -> dict[str, str]:
    day = "%Y-%m-%d"
    video = "WITH " + _activity_ctes("video", day)
    channel = "WITH " + _activity_ctes("channel", day)
    labelled = "WITH " + _TABLES + "," + _LABELLED
    spaces = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
    stripped = f"regexp_replace(text, '^{spaces}|{spaces}$', '', 'g')"
    preview = "CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END"
    flagged_users = (
        f'SELECT DISTINCT user_id FROM activity WHERE "max_CPP_this_CH" >= {THRESHOLD}'
    )
    flagged_texts = f"""
        SELECT c.id AS comment_id, c.published_at, c.user_id, c.video_id, c.like_count,
               c.reply_count, d.text
        FROM comments c LEFT JOIN documents d ON d.doc_id = c.id
        WHERE c.published_at >= TIMESTAMP '{TEXT_START}' AND c.published_at < TIMESTAMP '{TEXT_END}'
          AND c.user_id % 100 <= 100 AND c.user_id IN ({flagged_users})"""
    ties = "user_id NULLS FIRST, channel_title NULLS FIRST, month"

    def finding(name, level, field, value="NULL", detail="NULL", source="t", when="TRUE"):
        field = "NULL" if field is None else f"'{field}'"
        return (
            f"SELECT '{name}' AS check_name, '{level}' AS level, {field}::VARCHAR AS field, "
            f"round(({value})::DOUBLE, 6) AS value, ({detail})::VARCHAR AS detail "
            f"FROM {source} WHERE {when}"
        )

    def structure(columns, required):
        counts = ", ".join(f"count(*) - count({c}) AS nulls_{i}" for i, c in enumerate(columns))
        rows = [
            finding("empty", "error", None, "n_rows", when="n_rows = 0"),
            finding("total_rows", "info", None, "n_rows"),
            finding("total_columns", "info", None, str(len(columns))),
        ]
        for i, column in enumerate(columns):
            name = column.strip('"')
            if name in required:
                rows.append(
                    finding("nulls", "warning", name, f"nulls_{i}", when=f"nulls_{i} > 0")
                )
            rows.append(
                finding("column_with_nulls", "info", name, f"nulls_{i}", when=f"nulls_{i} > 0")
            )
        return counts, rows

    def with_null(column):
        return f"count(DISTINCT {column}) + max(({column} IS NULL)::INT)"

    activity_columns = [
        "username", "user_id", "channel_title", "month", "number_comments_all_time",
        "number_periods_with_comments", '"max_CPP_this_CH"', "total_likes_all_time",
        "total_replies_all_time", "max_likes", "max_replies", "mean_likes_per_comment",
        "mean_replies_per_comment", "mean_likes_per_reply",
    ]
    required = [
        "username", "user_id", "number_comments_all_time", "max_CPP_this_CH", "channel_title",
    ]
    counts, rows = structure(activity_columns[1:], required)
    rows.append(finding("missing_field", "error", "username"))
    quality_structure_sql = f"""{channel},
        t AS (SELECT count(*) AS n_rows, {counts} FROM activity) """ + " UNION ALL ".join(rows)

    counts, rows = structure(activity_columns, required)
    n = "number_comments_all_time"
    rows += [
        finding("high_comment_count", "warning", n, "most", when="most > 100000"),
        finding("negative_comment_count", "error", n, "negative", when="negative > 0"),
        finding("shared_username", "warning", "username", "shared", when="shared > 0"),
        finding("date_range_min", "info", "month", detail="first_month"),
        finding("date_range_max", "info", "month", detail="last_month"),
        finding("unique_users", "info", "user_id", "n_users"),
        finding("unique_channels", "info", "channel_title", "n_channels"),
    ]
    quality_activity_sql = f"""{channel},
        t AS (
            SELECT count(*) AS n_rows, {counts}, max({n}) AS most,
                   count(*) FILTER ({n} < 0) AS negative, min(month) AS first_month,
                   max(month) AS last_month, {with_null("user_id")} AS n_users,
                   {with_null("channel_title")} AS n_channels,
                   (SELECT count(*) FROM (
                        SELECT username FROM (SELECT DISTINCT username, user_id FROM activity)
                        GROUP BY username HAVING count(*) > 1)) AS shared
            FROM activity
        ) """ + " UNION ALL ".join(rows)

    text_columns = [
        "comment_id", "published_at", "user_id", "video_id", "like_count", "reply_count", "text",
    ]
    counts, rows = structure(text_columns, ["comment_id", "user_id", "text", "published_at"])
    rows += [
        finding("short_text", "warning", "text", "short", when="short > 0"),
        finding("duplicate_text", "warning", "text", "1 - n_texts / n_rows",
                when="1 - n_texts / n_rows > 0.1"),
        finding("avg_length", "info", "text", "avg_length"),
        finding("median_length", "info", "text", "median_length"),
        finding("max_length", "info", "text", "max_length"),
        finding("min_length", "info", "text", "min_length"),
        finding("unique_text_ratio", "info", "text", "n_texts / n_rows"),
        finding("short_text_count", "info", "text", "short"),
        finding("no_dates", "warning", "published_at", "dated", when="dated = 0"),
    ]
    quality_text_sql = f"""WITH {_TABLES},
        texts AS (
            SELECT c.id AS comment_id, c.published_at, c.user_id, c.video_id, c.like_count,
                   c.reply_count, d.text
            FROM comments c LEFT JOIN documents d ON d.doc_id = c.id
        ),
        t AS (
            SELECT count(*) AS n_rows, {counts}, {with_null("text")} AS n_texts,
                   count(*) FILTER (text IS NULL OR length(text) < 5) AS short,
                   count(published_at) AS dated, avg(length(text)) AS avg_length,
                   median(length(text)) AS median_length, max(length(text)) AS max_length,
                   min(length(text)) AS min_length
            FROM texts
        ) """ + " UNION ALL ".join(rows)

    axes = {"proj_x": "embedding[1]", "proj_y": "embedding[2]"}
    rows = [
        finding("unique_clusters", "info", "cluster_label", "n_clusters"),
        finding("cluster_count", "warning", "cluster_label", "n_clusters", when="n_clusters <> 8"),
        finding("small_cluster", "warning", "cluster_label", "smallest", when="smallest < 5"),
    ]
    counts = []
    for axis, value in axes.items():
        for kind, test in (("null", f"{value} IS NULL"), ("infinite", f"isinf({value})")):
            counts.append(f"count(*) FILTER ({test}) AS {kind}_{axis}")
            found = f"{kind}_{axis}"
            rows.append(
                finding(f"{kind}_coordinate", "warning", axis, found, when=f"{found} > 0")
            )
            rows.append(finding(f"{kind}_coordinate_count", "info", axis, found))
    quality_clusters_sql = f"""WITH t AS (
            SELECT count(DISTINCT label) AS n_clusters, {", ".join(counts)},
                   (SELECT min(size) FROM (SELECT count(*) AS size FROM embeddings
                                           GROUP BY label)) AS smallest
            FROM embeddings
        ) """ + " UNION ALL ".join(rows)

    doubles = "CAST({} AS DOUBLE[])"
    a, b = doubles.format("a.embedding"), doubles.format("b.embedding")
    cosine = f"list_cosine_similarity({a}, {b})"

    def wide_peaks(pattern):
        return f"""WITH {_activity_ctes("channel", pattern)},
            all_channels AS (
                SELECT raw_user_id, period, count(*) AS n_all FROM placed GROUP BY ALL
            ),
            one_channel AS (
                SELECT raw_user_id, user_id, username, channel_title, channel_id, period,
                       count(*) AS n_channel
                FROM placed GROUP BY ALL
            ),
            peaks AS (
                SELECT user_id, username, channel_title, substr(period, 1, 7) AS month,
                       max(n_all) AS all_peak, max(n_channel) AS one_peak
                FROM one_channel JOIN all_channels USING (raw_user_id, period) GROUP BY ALL
            )
            SELECT t.username, t.user_id, t.channel_title, t.month, t."max_CPP_this_CH",
                   p.all_peak AS "max_CPP_all_CH", p.one_peak AS "max_CPP_one_CH"
            FROM activity t JOIN peaks p
              ON t.user_id IS NOT DISTINCT FROM p.user_id
             AND t.username IS NOT DISTINCT FROM p.username
             AND t.channel_title IS NOT DISTINCT FROM p.channel_title AND t.month = p.month"""

    def label_statistics(columns, per_user):
        return f"""{video}, {_LABELLED}, per_user AS ({per_user})
            SELECT l.cluster_label, count(*) AS count, {columns}
            FROM labelled l LEFT JOIN per_user p ON p.user_id = l.user_id
            GROUP BY l.cluster_label"""

    averages = """round(avg(comments), 6) AS avg_comments, round(avg(peak), 6) AS avg_max_cpp,
                  round(avg(likes), 6) AS avg_likes_per_comment"""

    return {
        "activity_video_peak": f"{video} SELECT * FROM activity",
        "activity_channel_peak": f"{channel} SELECT * FROM activity",
        "activity_minute_peak": f"WITH {_activity_ctes('video', '%Y-%m-%d %H:%M')} "
        "SELECT * FROM activity",
        "activity_channel_minute_peak": f"WITH {_activity_ctes('channel', '%Y-%m-%d %H:%M')} "
        "SELECT * FROM activity",
        "activity_hour_of_month": f"WITH {_activity_ctes('channel', '%Y-%m %H')} "
        "SELECT * FROM activity",
        "activity_all_channel_peak": wide_peaks(day),
        "activity_all_channel_minute_peak": wide_peaks("%Y-%m-%d %H:%M"),
        "activity_stored_months": f"{video} SELECT * FROM activity".replace(
            "ts AS published_at", "ts + to_months(CAST(event_id % 4 AS INTEGER)) AS published_at"
        ).replace(f"TIMESTAMP '{END}'", "TIMESTAMP '2030-01-01'"),
        "activity_stored_layout": f"{video} SELECT * FROM activity",
        "activity_sampled": f"WITH {_activity_ctes('video', day, sample=9, min_comments=3)} "
        "SELECT * FROM activity",
        "suspicious_rows": f"""{channel}
            SELECT * FROM activity WHERE "max_CPP_this_CH" >= {THRESHOLD}""",
        "suspicious_list": f"""{video} SELECT username, user_id, "max_CPP_this_CH"
            FROM activity WHERE "max_CPP_this_CH" >= {THRESHOLD}""",
        "suspicious_usernames": f"""{channel} SELECT DISTINCT username FROM activity
            WHERE "max_CPP_this_CH" >= {THRESHOLD}""",
        "suspicious_comment_text": f"{video} {flagged_texts}",
        "top_commenters": f"""{channel}
            SELECT username, number_comments_all_time, "max_CPP_this_CH" FROM activity
            ORDER BY number_comments_all_time DESC, {ties} LIMIT 10""",
        "top_suspicious": f"""{channel}
            SELECT username, number_comments_all_time, "max_CPP_this_CH", channel_title
            FROM activity WHERE "max_CPP_this_CH" >= {THRESHOLD}
            ORDER BY "max_CPP_this_CH" DESC, {ties} LIMIT 10""",
        "cumulative_share": f"""{channel},
            ordered AS (
                SELECT {n}, sum({n}) OVER (ORDER BY {n}) AS upto, sum({n}) OVER () AS everything
                FROM activity
            )
            SELECT {n}, round(max(upto)::DOUBLE / max(everything)::DOUBLE, 6) AS cumshare
            FROM ordered GROUP BY {n}""",
        "commenter_density": f"""{channel}
            SELECT {n}, number_periods_with_comments, count(*) AS number_commenters
            FROM activity WHERE number_periods_with_comments < 10 GROUP BY ALL""",
        "commenter_scatter": f"""{channel}
            SELECT {n}, number_periods_with_comments, count(*) AS number_commenters
            FROM activity WHERE {n} < 60 GROUP BY ALL""",
        "commenter_density_bins": f"""{channel}
            SELECT CAST(floor({n} / 5) * 5 AS BIGINT) AS comments_from,
                   CAST(floor(number_periods_with_comments / 2) * 2 AS BIGINT) AS periods_from,
                   count(*) AS number_commenters
            FROM activity WHERE number_periods_with_comments < 10 GROUP BY 1, 2""",
        "activity_timeseries": f"""{channel}
            SELECT month, count(*) AS total_comments, {with_null("user_id")} AS unique_users
            FROM activity GROUP BY month""",
        "comment_timeseries": f"""WITH {_TABLES}
            SELECT strftime(published_at, '{day}') AS period, count(*) AS total_comments,
                   {with_null("user_id")} AS unique_users
            FROM comments GROUP BY 1""",
        "users_by_sketch": f"""WITH {_TABLES}
            SELECT ch.title AS channel_title, count(*) AS n_comments,
                   {with_null("c.user_id")} AS unique_users, TRUE AS estimate_close
            FROM comments c LEFT JOIN videos v ON v.id = c.video_id
            LEFT JOIN channels ch ON ch.id = v.channel_id
            GROUP BY ch.title""",
        "summary_totals": f"""{channel},
            t AS (
                SELECT count(*) AS total_records, {with_null("user_id")} AS total_users,
                       CAST(sum({n}) AS BIGINT) AS total_comments,
                       count(*) FILTER ("max_CPP_this_CH" >= {THRESHOLD}) AS suspicious_users,
                       (SELECT count(*) FROM ({flagged_users})) AS suspicious_distinct_users
                FROM activity
            )
            SELECT *, round(suspicious_users::DOUBLE / total_users * 100, 6)
                       AS suspicious_percentage,
                   round(total_comments::DOUBLE / total_users, 6) AS avg_comments_per_user
            FROM t""",
        "summary_record": f"""{video}, {_LABELLED},
            top AS (
                SELECT username, {n} AS n, "max_CPP_this_CH" AS peak FROM activity
                ORDER BY {n} DESC, {ties} LIMIT 10
            ),
            sizes AS (SELECT cluster_label, count(*) AS size FROM labelled GROUP BY 1)
            SELECT count(DISTINCT user_id) AS total_users,
                   CAST(sum({n}) AS BIGINT) AS total_comments,
                   count(*) FILTER ("max_CPP_this_CH" >= {THRESHOLD}) AS suspicious_users,
                   (SELECT string_agg(username || ':' || n || ':' || peak, ','
                                      ORDER BY n DESC, peak DESC, username DESC)
                    FROM top) AS top_commenters,
                   (SELECT string_agg(cluster_label || ':' || size, ',' ORDER BY cluster_label)
                    FROM sizes) AS cluster_distribution
            FROM activity""",
        "analysis_counts": f"""{video}
            SELECT count(*) AS total_records,
                   count(*) FILTER ("max_CPP_this_CH" >= {THRESHOLD}) AS suspicious_users,
                   (SELECT count(*) FROM ({flagged_texts})) AS comments_analyzed
            FROM activity""",
        "quality_structure": quality_structure_sql,
        "quality_activity": quality_activity_sql,
        "quality_text": quality_text_sql,
        "quality_clusters": quality_clusters_sql,
        "clean_comments": f"""SELECT doc_id, {stripped} AS text FROM documents
            WHERE length({stripped}) > 5""",
        "comment_preview": f"SELECT doc_id, {preview} AS preview FROM documents",
        "short_texts": """SELECT e.event_id AS comment_id, d.text
            FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id
            WHERE d.text IS NULL OR length(d.text) < 5""",
        "sql_parameters": f"""WITH {_TABLES}
            SELECT video_id, count(*) AS n_comments, max(like_count) AS max_likes FROM comments
            WHERE published_at >= TIMESTAMP '{TEXT_START}'
              AND published_at < TIMESTAMP '{TEXT_END}'
            GROUP BY video_id HAVING count(*) >= 90""",
        "vector_pair_distances": f"""
            SELECT a.vec_id AS id_a, b.vec_id AS id_b,
                   round({cosine}, 4) + 0.0 AS cosine_similarity,
                   round(1 - {cosine}, 4) + 0.0 AS cosine_distance,
                   round(list_distance({a}, {b}), 4) AS euclidean,
                   round(list_sum([abs(x[1] - x[2]) FOR x IN list_zip({a}, {b})]), 4) AS manhattan
            FROM embeddings a JOIN embeddings b ON b.vec_id = a.label""",
        "vector_matrix_means": f"""
            SELECT a.vec_id, round(avg({cosine}), 4) + 0.0 AS mean_cosine_similarity,
                   round(avg(1 - {cosine}), 4) AS mean_cosine_distance,
                   round(avg(list_distance({a}, {b}) ** 2), 4) AS mean_squared_euclidean
            FROM embeddings a CROSS JOIN embeddings b GROUP BY a.vec_id""",
        "vector_similar_pairs": """
            WITH v AS (
                SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
                UNION ALL
                SELECT -vec_id - 1, [CAST(x AS DOUBLE) + CASE WHEN i = vec_id % 64 + 1
                                     THEN (vec_id % 10 + 1) / 100 ELSE 0 END FOR x, i IN embedding]
                FROM embeddings
            )
            SELECT a.vec_id AS id_a, b.vec_id AS id_b,
                   round(list_distance(a.e, b.e), 4) AS distance
            FROM v a JOIN v b ON a.vec_id < b.vec_id
            WHERE list_distance(a.e, b.e) <= 0.065""",
        "vector_normalized": """
            WITH v AS (
                SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e,
                       sqrt(list_sum([x * x FOR x IN CAST(embedding AS DOUBLE[])])) AS length
                FROM embeddings
            )
            SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim,
                   round(e[i] / length, 4) + 0.0 AS value
            FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM v)""",
        "mean_pooling": """
            WITH v AS (
                SELECT label AS doc_id, CAST(embedding AS DOUBLE[]) AS e,
                       CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END AS mask
                FROM embeddings
            )
            SELECT doc_id, CAST(i - 1 AS INTEGER) AS dim,
                   round(sum(e[i] * mask) / greatest(sum(mask), 1e-9), 4) + 0.0 AS value
            FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM v) GROUP BY doc_id, i""",
        "label_distribution": f"""{labelled}
            SELECT cluster_label, count(*) AS count FROM labelled GROUP BY cluster_label""",
        "label_statistics": label_statistics(
            averages,
            f"""SELECT user_id, {n} AS comments, "max_CPP_this_CH" AS peak,
                       mean_likes_per_comment AS likes FROM activity""",
        ),
        "label_statistics_by_user": label_statistics(
            averages,
            f"""SELECT user_id, sum({n}) AS comments, max("max_CPP_this_CH") AS peak,
                       sum(total_likes_all_time)::DOUBLE / sum({n}) AS likes
                FROM activity GROUP BY user_id""",
        ),
        "label_members": "SELECT vec_id, label FROM embeddings WHERE label = 3",
        "label_sample_texts": f"""{labelled}
            SELECT text FROM labelled WHERE cluster_label = 'fr' ORDER BY comment_id LIMIT 10""",
        "label_samples": f"""{labelled},
            ranked AS (
                SELECT *, row_number() OVER (PARTITION BY cluster_label ORDER BY comment_id) AS r
                FROM labelled
            )
            SELECT cluster_label, CAST(r AS INTEGER) AS rank, comment_id, {preview} AS preview
            FROM ranked WHERE r <= 5""",
        "pca_lengths": """
            WITH v AS (
                SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x,
                       unnest(range(len(embedding))) AS i
                FROM embeddings
            ),
            m AS (SELECT i, avg(x) AS mean FROM v GROUP BY i)
            SELECT vec_id, round(sum((x - mean) * (x - mean)), 4) AS squared_length
            FROM v JOIN m USING (i) GROUP BY vec_id""",
        "pca_explained": """
            SELECT count(*) AS n_rows, CAST(64 AS INTEGER) AS n_components,
                   CAST(1.0 AS DOUBLE) AS explained
            FROM embeddings""",
        "kmeans_event_types": """
            SELECT event_id, min(event_id) OVER (PARTITION BY event_type) AS cluster_name
            FROM events""",
        "word_totals": r"""
            SELECT doc_id,
                   len(regexp_extract_all(coalesce(text, ''), '[\p{L}\p{M}\p{Nd}\p{Pc}]+')) AS n_words
            FROM documents""",
        "csv_round_trip": "SELECT doc_id, text FROM documents",
        "catalog_check": f"""WITH {_TABLES}
            SELECT 'checked_comments' AS table_name, TRUE AS present, 0 AS n_missing,
                   (SELECT count(*) FROM comments) AS n_rows
            UNION ALL SELECT 'checked_users', TRUE, 0, (SELECT count(*) FROM users)
            UNION ALL SELECT 'checked_videos', TRUE, 0, (SELECT count(*) FROM videos)
            UNION ALL SELECT 'checked_channels', TRUE, 0, (SELECT count(*) FROM channels)""",
        "report_rows": f"""{video},
            flagged AS (SELECT * FROM activity WHERE "max_CPP_this_CH" >= {THRESHOLD})
            SELECT 'activity_by_month' AS table_name, count(DISTINCT month) AS n_rows FROM activity
            UNION ALL SELECT 'counts', 1
            UNION ALL SELECT 'summary', 1
            UNION ALL SELECT 'cumulative_share', count(DISTINCT {n}) FROM activity
            UNION ALL SELECT 'commenter_density', count(*) FROM (
                SELECT DISTINCT {n}, number_periods_with_comments FROM flagged
                WHERE number_periods_with_comments < 10)
            UNION ALL SELECT 'suspicious_commenters', count(*) FROM flagged
            UNION ALL SELECT 'suspicious_usernames', count(DISTINCT username) FROM flagged""",
        **(llm.ORACLE_SQL if llm else {}),
    }
