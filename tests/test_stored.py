"""Tables kept by month and tables kept in buckets."""

import os

import pytest

import __spark_entry__ as entry
from chattermark.operators.activity import comment_activity, count_by_video_period
from chattermark.sources import layout, sample_tables, snapshots

SF_DIR = "/root/testdata/sf0.001"
USERS, VIDEOS, CHANNELS = [(1, "ann"), (2, "bob")], [(10, 5), (11, 6)], [(5, "news"), (6, "cats")]
COMMENTS = [
    (1, "2024-01-03 10:00", 1, 10, 1, 0), (2, "2024-01-31 23:59", 2, 10, 0, 1),
    (3, "2024-02-01 00:00", 1, 11, 2, 2), (4, "2024-02-10 12:00", 1, 11, 0, 0),
    (5, "2024-04-30 08:00", 2, 10, 5, 0), (6, None, 1, 10, 1, 1),
]


def between(tables):
    return lambda start, end: comment_activity(
        tables.comments, tables.users, tables.videos, tables.channels,
        start=start, end=end, period_format="%Y-%m-%d",
    )


def files_of(path):
    return {
        month: sorted((name, os.stat(f"{path}/{month}/{name}").st_mtime_ns) for name in os.listdir(f"{path}/{month}"))
        for month in os.listdir(path)
        if month.startswith("month=")
    }


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize(
    "months, runs",
    [
        ([], []),
        (["2024-02"], [("2024-02-01", "2024-03-01")]),
        (["2024-01", "2023-12", "2024-01", "2024-03"], [("2023-12-01", "2024-02-01"), ("2024-03-01", "2024-04-01")]),
    ],
)
def test_runs_of_months(months, runs):
    assert list(snapshots.runs_of_months(months)) == runs


def test_only_changed_months_are_rewritten(spark, make_tables, tmp_path):
    path = str(tmp_path / "activity")
    early = make_tables(COMMENTS[:3] + COMMENTS[4:], USERS, VIDEOS, CHANNELS)
    every = make_tables(COMMENTS, USERS, VIDEOS, CHANNELS)
    assert snapshots.stored_months(spark, path) == []
    months = snapshots.changed_months(early.comments)
    assert months == ["2024-01", "2024-02", "2024-04"]
    assert snapshots.update_months(spark, path, months, between(early)) == months
    before = files_of(path)
    assert snapshots.update_months(spark, path, [], between(every)) == months

    asked = []

    def watched(start, end):
        asked.append((start, end))
        return between(every)(start, end)

    arrived = every.comments.where("id = 4")
    snapshots.update_months(spark, path, snapshots.changed_months(arrived), watched)
    after = files_of(path)
    assert asked == [("2024-02-01", "2024-03-01")]
    assert before["month=2024-01"] == after["month=2024-01"] and before["month=2024-04"] == after["month=2024-04"]
    assert before["month=2024-02"] != after["month=2024-02"]
    whole = between(every)(None, None)
    assert rows(snapshots.read_months(spark, path, whole.schema)) == rows(whole)


def test_months_without_rows_go(spark, make_tables, tmp_path):
    path = str(tmp_path / "activity")
    tables = make_tables(COMMENTS, USERS, VIDEOS, CHANNELS)
    months = ["2024-01", "2024-02", "2024-04"]
    snapshots.update_months(spark, path, months, between(tables))
    left = make_tables([c for c in COMMENTS if c[0] != 5], USERS, VIDEOS, CHANNELS)
    assert snapshots.update_months(spark, path, ["2024-04", "2024-05"], between(left)) == months[:2]
    whole = between(left)(None, None)
    assert rows(snapshots.read_months(spark, path, whole.schema)) == rows(whole)


def test_failed_update_leaves_the_table(spark, make_tables, tmp_path):
    path = str(tmp_path / "activity")
    tables = make_tables(COMMENTS, USERS, VIDEOS, CHANNELS)
    snapshots.update_months(spark, path, ["2024-01"], between(tables))
    before = files_of(path)

    def failing(start, end):
        return between(tables)(start, end).selectExpr("*", "raise_error('broken') AS extra")

    with pytest.raises(Exception, match="broken"):
        snapshots.update_months(spark, path, ["2024-01"], failing)
    assert files_of(path) == before


def test_reading_a_range_prunes_partitions(spark, make_tables, tmp_path):
    path = str(tmp_path / "activity")
    tables = make_tables(COMMENTS, USERS, VIDEOS, CHANNELS)
    snapshots.update_months(spark, path, ["2024-01", "2024-02", "2024-04"], between(tables))
    schema = between(tables)(None, None).schema
    found = snapshots.read_months(spark, path, schema, "2024-02", "2024-03")
    assert {r.month for r in found.collect()} == {"2024-02"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    source = sample_tables.tables(spark, SF_DIR)
    layout.write_layout(source, "test_layout_", str(tmp_path_factory.mktemp("layout")), buckets=4)
    return source


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_on_the_video_needs_no_exchange(spark, stored):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        comments = layout.stored_comments(spark, "test_layout_", "2024-01-05", "2024-01-20")
        videos = layout.stored_videos(spark, "test_layout_").withColumnRenamed("id", "video_id")
        joined = comments.join(videos, "video_id")
        counted = count_by_video_period(comments, "%Y-%m-%d").join(videos, "video_id")
        bare = stored.comments.join(stored.videos.withColumnRenamed("id", "video_id"), "video_id")
        # A Bloom filter of one side may be built besides; it moves no row of the join.
        shuffle = "Exchange hashpartitioning"
        assert "SortMergeJoin" in plan_of(joined) and shuffle not in plan_of(joined)
        assert "SortMergeJoin" in plan_of(counted) and shuffle not in plan_of(counted)
        assert plan_of(bare).count(shuffle) == 2
        assert "PartitionFilters: [isnotnull(month" in plan_of(joined)
        wanted = "ts >= '2024-01-05' AND ts < '2024-01-20'"
        n = spark.read.parquet(f"{SF_DIR}/events.parquet").where(wanted).count()
        assert comments.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_layout_saves_exchanges_of_the_activity(spark, stored):
    window = {"start": entry.START, "end": entry.END, "period_format": entry.DAY}
    kept = layout.activity_of_layout(spark, "test_layout_", stored.users, stored.channels, **window)
    bare = comment_activity(stored.comments, stored.users, stored.videos, stored.channels, **window)
    assert plan_of(kept).count("Exchange hashpartitioning") < plan_of(bare).count("Exchange hashpartitioning")
    assert rows(kept) == rows(bare)


def test_layout_of_empty_tables(spark, make_tables, tmp_path):
    empty = make_tables([], [], [], [])
    layout.write_layout(empty, "empty_layout_", str(tmp_path), buckets=2)
    assert layout.activity_of_layout(spark, "empty_layout_", empty.users, empty.channels).collect() == []
