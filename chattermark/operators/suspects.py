"""Suspicious commenters: flagging, listing, and fetching their texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chattermark import settings
from chattermark.operators.activity import published_between, sample_users


def effective_threshold(threshold: int | None) -> int:
    """The threshold in force: none and 0 both mean the default."""
    return threshold or settings.DEFAULT_THRESHOLD


def flag_suspicious(activity: DataFrame, threshold: int | None = None) -> DataFrame:
    """Activity rows whose peak reaches the threshold."""
    return activity.filter(F.col("max_CPP_this_CH") >= effective_threshold(threshold))


def by_peak(activity: DataFrame) -> DataFrame:
    """Rows by falling peak. For the sink only: it shuffles."""
    return activity.orderBy(
        F.col("max_CPP_this_CH").desc(), "user_id", "channel_title", "month"
    )


def suspicious_list(activity: DataFrame, threshold: int | None = None) -> DataFrame:
    """Name, id and peak of every flagged row."""
    return flag_suspicious(activity, threshold).select("username", "user_id", "max_CPP_this_CH")


def suspicious_usernames(activity: DataFrame, threshold: int | None = None) -> DataFrame:
    """Distinct names of flagged users."""
    return flag_suspicious(activity, threshold).select("username").distinct()


def _top(df: DataFrame, column: str, n: int, output: list[str]) -> DataFrame:
    ranked = df.orderBy(F.col(column).desc(), "user_id", "channel_title", "month")
    return ranked.limit(n).select(*output)


def top_commenters(activity: DataFrame, n: int = 10) -> DataFrame:
    """The rows with most comments; ties go by user, channel and month."""
    return _top(
        activity,
        "number_comments_all_time",
        n,
        ["username", "number_comments_all_time", "max_CPP_this_CH"],
    )


def top_suspicious(activity: DataFrame, n: int = 10, threshold: int | None = None) -> DataFrame:
    """The flagged rows with the highest peaks; ties as in `top_commenters`."""
    return _top(
        flag_suspicious(activity, threshold),
        "max_CPP_this_CH",
        n,
        ["username", "number_comments_all_time", "max_CPP_this_CH", "channel_title"],
    )


def comments_of_users(
    comments: DataFrame,
    users: DataFrame,
    *,
    start: str | None = None,
    end: str | None = None,
    user_sample: int = settings.DEFAULT_USER_SAMPLE,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Comments, with text, of the users listed in `users.user_id`; `keep` names further columns.

    A semi join: the ids never leave the executors, and Spark broadcasts them
    only when their measured size allows it. The ids are not made distinct, which
    a semi join doesn't need and which would keep Spark from filtering the scan of
    the texts by a Bloom filter of the ids.
    """
    picked = sample_users(published_between(comments, start, end), user_sample)
    ids = users.select("user_id")
    return picked.join(ids, "user_id", "left_semi").select(
        F.col("id").alias("comment_id"),
        "published_at",
        "user_id",
        "video_id",
        "like_count",
        "reply_count",
        "text",
        *keep,
    )
