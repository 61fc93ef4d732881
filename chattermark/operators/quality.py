"""Quality checks on the activity, text and cluster tables.

Each check returns rows `(check_name, level, field, value, detail)`. Findings
have level `error` or `warning` and appear only when they apply; summary
figures have level `info`. A table is valid when no row is an `error`.

Tables are read twice at most: once for the counts, and once, over few columns,
for distinct values. Pass staged tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark import schemas
from chattermark.functions.measures import distinct_with_null
from chattermark.functions.texts import is_short

# The limits above or below which a finding is raised.
HIGH_COMMENT_COUNT = 100000
HIGH_DUPLICATE_RATIO = 0.1
SMALL_CLUSTER = 5

ERROR, WARNING, INFO = "error", "warning", "info"


def is_valid(findings: DataFrame) -> bool:
    """Whether a check raised no error."""
    return findings.filter(F.col("level") == ERROR).isEmpty()


def _finding(
    name: str,
    level: str,
    field: str | None = None,
    value: Column | None = None,
    detail: Column | None = None,
    when: Column | None = None,
) -> Column:
    """One row of findings, or null where `when` does not hold."""
    row = F.struct(
        F.lit(name).alias("check_name"),
        F.lit(level).alias("level"),
        F.lit(field).cast("string").alias("field"),
        (F.lit(None) if value is None else value).cast("double").alias("value"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )
    return row if when is None else F.when(when, row)


def _as_rows(counted: DataFrame, findings: Iterable[Column]) -> DataFrame:
    """Findings on a one-row frame of counts, as rows."""
    return (
        counted.select(F.explode(F.array(*findings)).alias("finding"))
        .filter(F.col("finding").isNotNull())
        .select("finding.*")
    )


def _null_name(column: str) -> str:
    return f"nulls__{column}"


def _null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(f"`{c}`").isNull()).alias(_null_name(c)) for c in df.columns]


def _missing(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def _structure(df: DataFrame, required: Iterable[str]) -> list[Column]:
    """Findings every table is checked for; expects `n_rows` and the null counts."""
    required = list(required)
    total = F.col("n_rows")
    found = [
        _finding("empty", ERROR, value=total, when=total == 0),
        _finding("total_rows", INFO, value=total),
        _finding("total_columns", INFO, value=F.lit(len(df.columns))),
    ]
    found += [_finding("missing_field", ERROR, c) for c in _missing(df, required)]
    for column in df.columns:
        nulls = F.col(f"`{_null_name(column)}`")
        if column in required:
            found.append(_finding("nulls", WARNING, column, nulls, when=nulls > 0))
        found.append(_finding("column_with_nulls", INFO, column, nulls, when=nulls > 0))
    for column in schemas.NUMERIC_EXPECTED:
        if column in df.columns and not isinstance(df.schema[column].dataType, T.NumericType):
            found.append(_finding("not_numeric", WARNING, column))
    return found


def check_structure(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Empty table, missing fields, nulls and non-numeric fields."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *_null_counts(df))
    return _as_rows(counted, _structure(df, required))


def check_activity(df: DataFrame) -> DataFrame:
    """Structure, comment counts, names shared by several ids, and coverage.

    One pass folds rows by name and id, then by name, then into one row; a
    second one, over two columns, counts distinct users and channels.
    """
    if _missing(df, schemas.ACTIVITY_REQUIRED):
        return check_structure(df, schemas.ACTIVITY_REQUIRED)

    comments = F.col("number_comments_all_time")
    has_month = "month" in df.columns
    nulls = [_null_name(c) for c in df.columns]
    months = [F.min("month").alias("first_month"), F.max("month").alias("last_month")]
    by_pair = df.groupBy("username", "user_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *_null_counts(df),
        F.max(comments).alias("max_comments"),
        F.count_if(comments < 0).alias("n_negative"),
        *(months if has_month else []),
    )
    added = ["n_rows", "n_negative", *nulls]
    extremes = [F.max("max_comments").alias("max_comments")]
    if has_month:
        extremes += [
            F.min("first_month").alias("first_month"),
            F.max("last_month").alias("last_month"),
        ]
    by_name = by_pair.groupBy("username").agg(
        F.count(F.lit(1)).alias("n_ids"),
        *[F.sum(f"`{c}`").alias(c) for c in added],
        *extremes,
    )
    counted = by_name.agg(
        F.count_if(F.col("n_ids") > 1).alias("n_shared_names"),
        *[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in added],
        *extremes,
    )
    if has_month:
        coverage = df.agg(
            distinct_with_null("user_id").alias("n_users"),
            distinct_with_null("channel_title").alias("n_channels"),
        )
        counted = _fold([counted, coverage])

    filled = F.col("n_rows") > 0
    negative, shared_names = F.col("n_negative"), F.col("n_shared_names")
    most = F.col("max_comments")
    found = _structure(df, schemas.ACTIVITY_REQUIRED) + [
        _finding(
            "high_comment_count",
            WARNING,
            "number_comments_all_time",
            most,
            when=most > HIGH_COMMENT_COUNT,
        ),
        _finding(
            "negative_comment_count",
            ERROR,
            "number_comments_all_time",
            negative,
            when=negative > 0,
        ),
        _finding("shared_username", WARNING, "username", shared_names, when=shared_names > 0),
    ]
    if has_month:
        found += [
            _finding("date_range_min", INFO, "month", detail=F.col("first_month"), when=filled),
            _finding("date_range_max", INFO, "month", detail=F.col("last_month"), when=filled),
            _finding("unique_users", INFO, "user_id", F.col("n_users"), when=filled),
            _finding("unique_channels", INFO, "channel_title", F.col("n_channels"), when=filled),
        ]
    return _as_rows(counted, found)


def _fold(parts: list[DataFrame]) -> DataFrame:
    """One row holding the columns of several one-row frames."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(f"`{c}`").alias(c) for c in stacked.columns])


def check_texts(df: DataFrame) -> DataFrame:
    """Structure, short and repeated texts, length statistics, and dates.

    All counts are folded by length, of which there are few, and then into one
    row; the median is weighted. Distinct texts are counted apart, by their
    SHA-256 as 32 bytes, so texts and counts do not move together and copies of
    one text, however many, cost a row per task. Distinct lengths are at most
    sqrt(2 * characters).
    """
    if _missing(df, schemas.TEXT_REQUIRED):
        return check_structure(df, schemas.TEXT_REQUIRED)

    added = ["n_rows", "n_short", "n_dated", *[_null_name(c) for c in df.columns]]
    by_length = df.groupBy(F.char_length("text").alias("length")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_short("text")).alias("n_short"),
        F.count_if(F.col("published_at").isNotNull()).alias("n_dated"),
        *_null_counts(df),
    )
    known = F.when(F.col("length").isNotNull(), F.col("n_rows"))
    counted = by_length.agg(
        *[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in added],
        F.try_divide(F.sum(F.col("length") * F.col("n_rows")).cast("double"), F.sum(known)).alias(
            "avg_length"
        ),
        F.percentile("length", 0.5, F.col("n_rows")).alias("median_length"),
        F.max("length").alias("max_length"),
        F.min("length").alias("min_length"),
    )
    texts = df.select(F.unhex(F.sha2("text", 256)).alias("text_hash")).distinct()
    counted = _fold([counted, texts.agg(F.count(F.lit(1)).alias("n_texts"))])

    total, distinct = F.col("n_rows"), F.col("n_texts")
    filled = total > 0
    unique_ratio = F.try_divide(distinct.cast("double"), total)
    duplicates = 1 - unique_ratio
    short, dated = F.col("n_short"), F.col("n_dated")
    found = _structure(df, schemas.TEXT_REQUIRED) + [
        _finding("short_text", WARNING, "text", short, when=short > 0),
        _finding(
            "duplicate_text", WARNING, "text", duplicates, when=duplicates > HIGH_DUPLICATE_RATIO
        ),
        _finding("avg_length", INFO, "text", F.col("avg_length"), when=filled),
        _finding("median_length", INFO, "text", F.col("median_length"), when=filled),
        _finding("max_length", INFO, "text", F.col("max_length"), when=filled),
        _finding("min_length", INFO, "text", F.col("min_length"), when=filled),
        _finding("unique_text_ratio", INFO, "text", unique_ratio, when=filled),
        _finding("short_text_count", INFO, "text", short, when=filled),
        _finding("no_dates", WARNING, "published_at", dated, when=filled & (dated == 0)),
    ]
    return _as_rows(counted, found)


def check_clusters(df: DataFrame, expected_clusters: int | None = None) -> DataFrame:
    """Number and size of clusters, and unusable coordinates."""
    missing = _missing(df, schemas.CLUSTER_REQUIRED)
    if missing:
        counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
        return _as_rows(counted, [_finding("missing_field", ERROR, c) for c in missing])

    bad = {}
    for axis in ("proj_x", "proj_y"):
        bad[f"null_{axis}"] = F.count_if(F.col(axis).isNull())
        bad[f"infinite_{axis}"] = F.count_if(F.abs(F.col(axis)) == float("inf"))
    sizes = df.groupBy("cluster_label").agg(
        F.count(F.lit(1)).alias("size"), *[count.alias(name) for name, count in bad.items()]
    )
    counted = sizes.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.min("size").alias("smallest"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in bad],
    )
    n, smallest = F.col("n_clusters"), F.col("smallest")
    found = [_finding("unique_clusters", INFO, "cluster_label", n)]
    if expected_clusters:
        found.append(
            _finding("cluster_count", WARNING, "cluster_label", n, when=n != expected_clusters)
        )
    found.append(
        _finding("small_cluster", WARNING, "cluster_label", smallest, when=smallest < SMALL_CLUSTER)
    )
    for name in bad:
        kind, axis = name.split("_", 1)
        count = F.col(name)
        found.append(_finding(f"{kind}_coordinate", WARNING, axis, count, when=count > 0))
        found.append(_finding(f"{kind}_coordinate_count", INFO, axis, count))
    return _as_rows(counted, found)
