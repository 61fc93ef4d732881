import random

import pytest
from pyspark.sql import functions as F

from chattermark import schemas
from chattermark.functions.periods import format_tokens, slot, slot_text, slot_unit
from chattermark.operators.activity import (
    in_report_order,
    published_between,
    sample_users,
)

USERS = [(1, "ann"), (2, "bob")]
VIDEOS = [(10, 100), (11, 100), (12, 101), (13, 999)]
CHANNELS = [(100, "news"), (101, "news"), (102, "music")]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_peak_grain_separates_videos_of_one_channel(make_tables, activity_of):
    comments = [(i, "2024-01-05 10:00:30", 1, 10, 1, 0) for i in range(3)]
    comments += [(i, "2024-01-05 10:00:59", 1, 11, 2, 1) for i in range(3, 5)]
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    columns = ["number_comments_all_time", "number_periods_with_comments", "max_CPP_this_CH"]
    assert rows(activity_of(tables), *columns) == [(5, 1, 3)]
    assert rows(activity_of(tables, peak_grain="channel"), *columns) == [(5, 1, 5)]


def test_orphans_are_kept_at_channel_grain_and_dropped_at_video_grain(make_tables, activity_of):
    comments = [
        (1, "2024-01-05 10:00", 1, 10, 1, 0),
        (2, "2024-01-05 10:00", 7, 10, 1, 0),  # unknown user
        (3, "2024-01-05 10:00", 8, 10, 1, 0),  # unknown user, merges with the other
        (4, "2024-01-05 10:00", 1, 77, 1, 0),  # unknown video
        (5, "2024-01-05 10:00", 1, 13, 1, 0),  # unknown channel
    ]
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    columns = ["user_id", "username", "channel_title", "max_CPP_this_CH"]
    assert rows(activity_of(tables), *columns) == [(1, "ann", "news", 1)]
    kept = rows(activity_of(tables, peak_grain="channel"), *columns)
    assert kept == sorted(
        [(1, "ann", "news", 1), (None, None, "news", 2), (1, "ann", None, 2)], key=str
    )
    crossed = activity_of(tables, peak_grain="channel", keep_orphans=False)
    assert rows(crossed, *columns) == [(1, "ann", "news", 1)]
    assert len(rows(activity_of(tables, keep_orphans=True), *columns)) == 3


def test_ratios(make_tables, activity_of):
    comments = [(i, "2024-01-05 10:00", 1, 10, 1, 0) for i in range(2)]
    comments.append((2, "2024-01-06 10:00", 1, 10, None, None))
    comments += [(i, "2024-02-05 10:00", 2, 12, None, 3) for i in range(3, 6)]
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    columns = [
        "user_id", "mean_likes_per_comment", "mean_replies_per_comment", "mean_likes_per_reply",
        "total_likes_all_time", "max_likes",
    ]
    assert rows(activity_of(tables), *columns) == [
        (1, 0.6667, 0.0, None, 2, 1),
        (2, None, 3.0, None, None, None),
    ]
    exact = rows(activity_of(tables, peak_grain="channel"), *columns)
    assert exact[0][1] == 2 / 3


def test_channels_merge_by_title(make_tables, activity_of):
    comments = [
        (1, "2024-01-05 10:00", 1, 10, 0, 0),
        (2, "2024-01-05 10:00", 1, 12, 0, 0),
    ]
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    wide = activity_of(tables, peak_grain="channel", all_channel_peaks=True)
    columns = ["channel_title", "max_CPP_this_CH", "max_CPP_all_CH", "max_CPP_one_CH"]
    assert rows(wide, *columns) == [("news", 2, 2, 1)]
    wide = activity_of(tables, all_channel_peaks=True)
    assert rows(wide, *columns) == [("news", 1, 2, 1)]


def test_wide_peaks_of_unknown_users_stay_apart(make_tables, activity_of):
    comments = [(i, "2024-01-05 10:00", 50 + i, 10, 0, 0) for i in range(3)]
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    wide = activity_of(tables, peak_grain="channel", all_channel_peaks=True)
    columns = ["user_id", "max_CPP_this_CH", "max_CPP_all_CH", "max_CPP_one_CH"]
    assert rows(wide, *columns) == [(None, 3, 1, 1)]


def test_window_is_half_open_and_needs_a_user(make_tables, activity_of):
    comments = [
        (1, "2024-01-01 00:00", 1, 10, 0, 0),
        (2, "2024-02-01 00:00", 1, 10, 0, 0),
        (3, "2024-01-31 23:59:59", 1, 10, 0, 0),
        (4, "2024-01-15 00:00", None, 10, 0, 0),
        (5, None, 1, 10, 0, 0),
    ]
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    window = {"start": "2024-01-01", "end": "2024-02-01"}
    assert [r.id for r in published_between(tables.comments, **window).orderBy("id").collect()] == [
        1, 3, 4,
    ]
    for grain in ("video", "channel"):
        total = activity_of(tables, peak_grain=grain, **window)
        assert rows(total, "number_comments_all_time") == [(2,)]


def test_sampling_keeps_residues_up_to_and_including_k(make_tables):
    users = [0, 9, 10, 99, 100, 109, 110, -5, None]
    tables = make_tables([(i, "2024-01-01", u, 1, 0, 0) for i, u in enumerate(users)])

    def kept(k):
        picked = sample_users(tables.comments, k).orderBy("id").collect()
        return [r.user_id for r in picked]

    assert kept(9) == [0, 9, 100, 109, -5]
    assert kept(99) == kept(100) == users[:-1]


def test_min_comments_is_applied_to_the_roll_up(make_tables, activity_of):
    comments = [(1, "2024-01-01", 1, 10, 0, 0), (2, "2024-01-02", 1, 10, 0, 0)]
    comments.append((3, "2024-01-02", 2, 10, 0, 0))
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    assert rows(activity_of(tables, min_comments=2), "user_id") == [(1,)]


@pytest.mark.parametrize("grain", ["video", "channel"])
def test_no_comments_give_an_empty_table_with_the_schema(make_tables, activity_of, grain):
    result = activity_of(make_tables([], USERS, VIDEOS, CHANNELS), peak_grain=grain)
    assert result.collect() == []
    declared = [(f.name, f.dataType) for f in schemas.ACTIVITY.fields]
    assert [(f.name, f.dataType) for f in result.schema.fields] == declared


def test_unknown_grain(make_tables, activity_of):
    with pytest.raises(ValueError):
        activity_of(make_tables([]), peak_grain="planet")


@pytest.mark.parametrize(
    "period_format, expected, unit",
    [
        ("%Y-%m-%d %H:%i", "2024-03-09 07:05", "minute"),
        ("%Y-%m-%d", "2024-03-09", "day"),
        ("%Y-%m", "2024-03", "month"),
        ("%d.%m.%Y", "09.03.2024", "day"),
        ("%Y-%m-%dT%H:%i:%s", "2024-03-09T07:05:08", "second"),
        ("%Y-%m %H", "2024-03 07", None),
        ("%H o'clock", "07 o'clock", None),
        ("%Y%%%m", "2024%03", "month"),
    ],
)
def test_periods(make_tables, period_format, expected, unit):
    comments = make_tables([(1, "2024-03-09 07:05:08", 1, 1, 0, 0)]).comments
    text = slot_text(slot("published_at", period_format), period_format)
    assert comments.select(text).head()[0] == expected
    assert slot_unit(period_format) == unit


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "America/Sao_Paulo"])
@pytest.mark.parametrize("grain", ["video", "channel"])
@pytest.mark.parametrize("period_format", ["%Y-%m-%d %H:%i", "%Y-%m-%d", "%Y-%m %H"])
def test_clock_changes_play_no_part(spark, make_tables, activity_of, zone, grain, period_format):
    # Times that the zones skip or repeat: spring and autumn, and a midnight.
    times = ["2024-03-10 02:30", "2024-03-10 03:30", "2024-03-10 03:31", "2024-03-31 02:30",
             "2024-03-31 03:30", "2024-11-03 01:30", "2024-11-03 01:30", "2018-11-04 00:10",
             "2018-11-04 01:10", "1965-03-01 02:30"]
    rows = [(i, t, 1, 10, 1, 0) for i, t in enumerate(times)]
    tables = make_tables(rows, [(1, "ann")], [(10, 100)], [(100, "news")])
    options = {"peak_grain": grain, "period_format": period_format}
    expected = sorted(activity_of(tables, **options).collect())
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert sorted(activity_of(tables, **options).collect()) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if period_format.endswith("%i"):
        assert max(r.max_CPP_this_CH for r in expected if r.month == "2024-03") == 1


def test_unknown_period_code():
    with pytest.raises(ValueError):
        format_tokens("%Y-%W")


def random_comments(n=600, seed=3):
    pick = random.Random(seed)
    return [
        (
            i,
            f"2024-0{pick.randint(1, 2)}-0{pick.randint(1, 3)} 10:0{pick.randint(0, 2)}:00",
            # one user writes a third of all comments
            1 if pick.random() < 0.34 else pick.randint(1, 6),
            pick.choice([10, 11, 12, 13, 14]),
            pick.choice([None, 0, 1, 5]),
            pick.choice([0, 1, 2]),
        )
        for i in range(n)
    ]


def brute_force(comments, period_length, grain):
    """Activity worked out in plain Python, at either grain."""
    users, videos, titles = dict(USERS), dict(VIDEOS), dict(CHANNELS)
    groups = {}
    for _, time, user, video, likes, replies in comments:
        title = titles.get(videos.get(video))
        known = user if user in users else None
        if grain == "video" and (known is None or title is None):
            continue
        groups.setdefault((known, title, time[:7]), []).append(
            (time[:period_length], video, likes, replies)
        )
    result = []
    for (user, title, month), found in groups.items():
        cells = {}
        for period, video, _, _ in found:
            key = (period, video) if grain == "video" else period
            cells[key] = cells.get(key, 0) + 1
        likes = [x[2] for x in found if x[2] is not None]
        result.append(
            (
                user, title, month, len(found), len({x[0] for x in found}), max(cells.values()),
                sum(likes) if likes else None, sum(x[3] for x in found),
            )
        )
    return sorted(result, key=str)


@pytest.mark.parametrize("grain", ["video", "channel"])
@pytest.mark.parametrize("period_format, length", [("%Y-%m-%d %H:%i", 16), ("%Y-%m-%d", 10)])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_brute_force(spark, make_tables, activity_of, grain, period_format, length, broadcast):
    comments = random_comments()
    tables = make_tables(comments, USERS, VIDEOS, CHANNELS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = rows(
            activity_of(tables, peak_grain=grain, period_format=period_format),
            "user_id", "channel_title", "month", "number_comments_all_time",
            "number_periods_with_comments", "max_CPP_this_CH", "total_likes_all_time",
            "total_replies_all_time",
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == brute_force(comments, length, grain)


def test_channel_peak_is_never_below_video_peak(make_tables, activity_of):
    tables = make_tables(random_comments(seed=5), USERS, VIDEOS, CHANNELS)
    keys = ["user_id", "channel_title", "month"]
    video = activity_of(tables).select(*keys, F.col("max_CPP_this_CH").alias("v"))
    channel = activity_of(tables, peak_grain="channel")
    both = channel.join(video, keys)
    assert both.count() == video.count()
    assert both.filter("max_CPP_this_CH < v").isEmpty()


def test_report_order(make_tables, activity_of):
    tables = make_tables(random_comments(), USERS, VIDEOS, CHANNELS)
    found = in_report_order(activity_of(tables)).collect()
    order = [(r.month, -r.max_CPP_this_CH, r.user_id, r.channel_title) for r in found]
    assert order == sorted(order)


def test_peak_of_unknown_users(make_tables, activity_of):
    comments = [(1, "2024-01-01 10:00", 8, 10, 0, 0), (2, "2024-01-01 10:00", 9, 10, 0, 0)]
    tables = make_tables(comments, [(1, "ann")], [(10, 100)], [(100, "news")])
    for grain, peak in (("video", 1), ("channel", 2)):
        (row,) = activity_of(tables, peak_grain=grain, keep_orphans=True).collect()
        assert (row.user_id, row.number_comments_all_time, row.max_CPP_this_CH) == (None, 2, peak)
