"""Activity: comments rolled up to user, channel title and month.

The measure of interest is the peak number of comments in one period (CPP).
It exists at two grains: `video` counts the comments of a user under one video
in one period, `channel` counts them over all videos of the channel.

Every grouping below combines on the map side before it shuffles, so a user,
video or period with very many comments reaches its final task as one row per
map task. At video grain the comments are first counted by user, video and
period, which needs no dimension table; joins and later shuffles then see
counts, not comments. At channel grain that step is only worth its shuffle
where a period is long enough to hold several comments; otherwise the comments
are joined as they are. Sums, maxima and counts come out the same.

Joins are left to Spark: small dimension tables are broadcast by their
measured size, large ones sort-merged, with hot keys split at run time.
Dimension ids are taken to be unique, as keys are.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chattermark import settings
from chattermark.functions.measures import guarded_ratio, ratio
from chattermark.functions.periods import SHORT_UNITS, month_text, slot, slot_text, slot_unit

PEAK_GRAINS = ("video", "channel")

_OUTPUT = (
    "username",
    "user_id",
    "channel_title",
    "month",
    "number_comments_all_time",
    "number_periods_with_comments",
    "max_CPP_this_CH",
    "total_likes_all_time",
    "total_replies_all_time",
    "max_likes",
    "max_replies",
    "mean_likes_per_comment",
    "mean_replies_per_comment",
    "mean_likes_per_reply",
)
_WIDE = ("max_CPP_all_CH", "max_CPP_one_CH")


def published_between(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Dated rows with start <= published_at < end; a bound of None is left open."""
    df = df.filter(F.col("published_at").isNotNull())
    if start is not None:
        df = df.filter(F.col("published_at") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col("published_at") < F.lit(end).cast("timestamp_ntz"))
    return df


def sample_users(df: DataFrame, user_sample: int = settings.DEFAULT_USER_SAMPLE) -> DataFrame:
    """Rows of the users whose id modulo 100 is at most `user_sample`.

    From 99 upwards this keeps every known user id; the filter is then a plain
    null check, which reaches the file scan.
    """
    if user_sample >= 99:
        return df.filter(F.col("user_id").isNotNull())
    return df.filter(F.col("user_id") % 100 <= user_sample)


def count_by_video_period(comments: DataFrame, period_format: str) -> DataFrame:
    """Comments, likes and replies by user, video and period slot."""
    return comments.groupBy(
        "user_id", "video_id", slot("published_at", period_format).alias("slot")
    ).agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count(F.lit(1)).alias("peak"),
        F.sum("like_count").alias("likes"),
        F.sum("reply_count").alias("replies"),
        F.max("like_count").alias("top_likes"),
        F.max("reply_count").alias("top_replies"),
    )


def as_counts(comments: DataFrame, period_format: str) -> DataFrame:
    """Single comments with the columns of `count_by_video_period`."""
    return comments.select(
        "user_id",
        "video_id",
        slot("published_at", period_format).alias("slot"),
        F.lit(1).cast("long").alias("n_comments"),
        F.lit(1).cast("long").alias("peak"),
        F.col("like_count").alias("likes"),
        F.col("reply_count").alias("replies"),
        F.col("like_count").alias("top_likes"),
        F.col("reply_count").alias("top_replies"),
    )


def video_titles(videos: DataFrame, channels: DataFrame, keep_orphans: bool) -> DataFrame:
    """Channel id and title of each video."""
    titles = channels.select(
        F.col("id").alias("channel_id"), F.col("title").alias("channel_title")
    )
    placed = videos.select(F.col("id").alias("video_id"), "channel_id").join(
        titles, "channel_id", "left" if keep_orphans else "inner"
    )
    placed = placed.select("video_id", "channel_id", "channel_title")
    return placed if keep_orphans else placed.distinct()


def _add_up(peak: Column) -> list[Column]:
    return [
        F.sum("n_comments").alias("n_comments"),
        peak.alias("peak"),
        F.sum("likes").alias("likes"),
        F.sum("replies").alias("replies"),
        F.max("top_likes").alias("top_likes"),
        F.max("top_replies").alias("top_replies"),
    ]


def _with_known_user(rows: DataFrame, users: DataFrame) -> DataFrame:
    """Attach usernames; rows of unknown users share the null user."""
    known = users.select(F.col("id").alias("known_id"), "username")
    return (
        rows.join(known, rows["user_id"] == known["known_id"], "left")
        .withColumn("raw_user_id", F.col("user_id"))
        .withColumn("user_id", F.col("known_id"))
        .drop("known_id")
    )


def comment_activity(
    comments: DataFrame,
    users: DataFrame,
    videos: DataFrame,
    channels: DataFrame,
    *,
    start: str | None = settings.DEFAULT_START,
    end: str | None = settings.DEFAULT_END,
    period_format: str = settings.DEFAULT_PERIOD_FORMAT,
    user_sample: int = settings.DEFAULT_USER_SAMPLE,
    min_comments: int = 1,
    peak_grain: str = "video",
    keep_orphans: bool | None = None,
    all_channel_peaks: bool = False,
) -> DataFrame:
    """Activity by user, channel title and month.

    With `keep_orphans`, comments with an unknown user, video or channel stay,
    grouped under null; without, they are dropped. The default is to keep them
    at channel grain and to drop them at video grain. At video grain the ratios
    are rounded to four places. Kept unknown users share one row, whose totals add
    them all up; its peak at video grain is that of the busiest single one, at
    channel grain that of all together.

    `all_channel_peaks` adds `max_CPP_all_CH`, the peak of the user's comments
    in one period over all channels, and `max_CPP_one_CH`, the peak by channel
    id, which differs from `max_CPP_this_CH` where titles or users merge.
    """
    if peak_grain not in PEAK_GRAINS:
        raise ValueError(f"peak_grain must be one of {PEAK_GRAINS}, not {peak_grain!r}")
    if keep_orphans is None:
        keep_orphans = peak_grain == "channel"

    picked = sample_users(published_between(comments, start, end), user_sample)
    combine = peak_grain == "video" or slot_unit(period_format) not in SHORT_UNITS
    counted = (count_by_video_period if combine else as_counts)(picked, period_format)
    titles = video_titles(videos, channels, keep_orphans)
    placed = counted.join(titles, "video_id", "left" if keep_orphans else "inner")

    # Known users keep their id through the roll-up, so the name can wait until
    # the rows are few. Unknown ones must merge before periods are counted.
    if keep_orphans:
        user_key, raw_user = ["user_id", "username"], "raw_user_id"
        rows = _with_known_user(placed, users)
    else:
        user_key, raw_user = ["user_id"], "user_id"
        rows = placed

    wide = []
    if all_channel_peaks:
        rows = _with_wide_counts(rows, user_key, raw_user)
        wide = [F.max(name).alias(name) for name in _WIDE]
    peak = F.max("peak") if peak_grain == "video" else F.sum("n_comments")
    by_period = rows.groupBy(*user_key, "channel_title", "slot").agg(*_add_up(peak), *wide)
    by_month = (
        by_period.withColumn("month", month_text("slot", period_format))
        .groupBy(*user_key, "channel_title", "month")
        .agg(*_add_up(F.max("peak")), F.count("slot").alias("n_periods"), *wide)
        .filter(F.col("n_comments") >= min_comments)
    )
    if not keep_orphans:
        by_month = by_month.join(
            users.select(F.col("id").alias("user_id"), "username"), "user_id"
        )
    return _finish(by_month, rounded=peak_grain == "video", extra=_WIDE if wide else ())


def _finish(by_month: DataFrame, rounded: bool, extra: Iterable[str]) -> DataFrame:
    likes, replies, n = F.col("likes"), F.col("replies"), F.col("n_comments")
    if rounded:
        ratios = [
            guarded_ratio(likes, n, otherwise=0),
            guarded_ratio(replies, n, otherwise=0),
            guarded_ratio(likes, replies),
        ]
    else:
        ratios = [ratio(likes, n), ratio(replies, n), ratio(likes, replies)]
    values = [
        F.col("username"),
        F.col("user_id"),
        F.col("channel_title"),
        F.col("month"),
        n,
        F.col("n_periods"),
        F.col("peak"),
        likes,
        replies,
        F.col("top_likes"),
        F.col("top_replies"),
        *ratios,
    ]
    return by_month.select(*[v.alias(name) for v, name in zip(values, _OUTPUT)], *extra)


def _with_wide_counts(rows: DataFrame, user_key: list[str], raw_user: str) -> DataFrame:
    """Rows by channel id and slot, with the counts of the two wider peaks.

    The user's count over all channels is a sum over the rows of one user and
    slot, one row per channel, so no window holds a user's whole history.
    """
    user = user_key if raw_user in user_key else [raw_user, *user_key]
    one_channel = rows.groupBy(*user, "channel_title", "channel_id", "slot").agg(
        *_add_up(F.max("peak")), F.sum("n_comments").alias("max_CPP_one_CH")
    )
    same_slot = Window.partitionBy(raw_user, "slot")
    return one_channel.withColumn("max_CPP_all_CH", F.sum("max_CPP_one_CH").over(same_slot))


def in_report_order(activity: DataFrame) -> DataFrame:
    """Month ascending, highest peak first, then by name. For the sink only: it shuffles."""
    return activity.orderBy(
        F.col("month").asc(),
        F.col("max_CPP_this_CH").desc(),
        "user_id",
        "channel_title",
    )


def comment_periods(comments: DataFrame, period_format: str) -> DataFrame:
    """Comments with their period as text."""
    return comments.withColumn(
        "period", slot_text(slot("published_at", period_format), period_format)
    )
