"""Declared schemas of the input tables and of the activity table."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


COMMENTS = _fields(
    ("id", T.LongType()),
    ("published_at", T.TimestampNTZType()),
    ("user_id", T.LongType()),
    ("video_id", T.LongType()),
    ("like_count", T.LongType()),
    ("reply_count", T.LongType()),
    ("text", T.StringType()),
)
USERS = _fields(("id", T.LongType()), ("username", T.StringType()))
VIDEOS = _fields(("id", T.LongType()), ("channel_id", T.LongType()))
CHANNELS = _fields(("id", T.LongType()), ("title", T.StringType()))

ACTIVITY = _fields(
    ("username", T.StringType()),
    ("user_id", T.LongType()),
    ("channel_title", T.StringType()),
    ("month", T.StringType()),
    ("number_comments_all_time", T.LongType()),
    ("number_periods_with_comments", T.LongType()),
    ("max_CPP_this_CH", T.LongType()),
    ("total_likes_all_time", T.LongType()),
    ("total_replies_all_time", T.LongType()),
    ("max_likes", T.LongType()),
    ("max_replies", T.LongType()),
    ("mean_likes_per_comment", T.DoubleType()),
    ("mean_replies_per_comment", T.DoubleType()),
    ("mean_likes_per_reply", T.DoubleType()),
)

TABLES = {
    "comments": COMMENTS,
    "users": USERS,
    "videos": VIDEOS,
    "channels": CHANNELS,
}

# Columns a table must carry before it is checked further, and those that must be
# numeric. The names are those of the tables users have.
ACTIVITY_REQUIRED = (
    "username",
    "user_id",
    "number_comments_all_time",
    "max_CPP_this_CH",
    "channel_title",
)
TEXT_REQUIRED = ("comment_id", "user_id", "text", "published_at")
CLUSTER_REQUIRED = ("cluster_label", "proj_x", "proj_y")
NUMERIC_EXPECTED = ("user_id", "number_comments_all_time", "max_CPP_this_CH")
