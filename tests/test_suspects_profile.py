import pytest
from pyspark.sql import functions as F

from chattermark import schemas
from chattermark.operators import profile, suspects


@pytest.fixture
def activity(spark):
    """Activity rows of (name, user, channel, month, comments, periods, peak)."""

    def build(*short):
        rows = [(*r, 4, 2, 3, 1, 1.0, 0.5, 2.0) for r in short]
        return spark.createDataFrame(rows, schemas.ACTIVITY)

    return build


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_flags(activity):
    df = activity(
        ("a", 1, "c", "2024-01", 20, 2, 10),
        ("b", 2, "c", "2024-01", 9, 1, 9),
        ("a", 1, "d", "2024-01", 30, 3, 12),
    )
    assert suspects.flag_suspicious(df).count() == 2
    assert suspects.flag_suspicious(df, 0).count() == 2
    assert suspects.flag_suspicious(df, 9).count() == 3
    assert values(suspects.suspicious_usernames(df)) == [("a",)]
    assert values(suspects.suspicious_list(df)) == [("a", 1, 10), ("a", 1, 12)]
    assert [r.max_CPP_this_CH for r in suspects.by_peak(df).collect()] == [12, 10, 9]


def test_top_k_breaks_ties_by_key(activity):
    df = activity(*[(f"u{i}", i, "c", "2024-01", 5, 1, 5) for i in range(20)])
    top = suspects.top_commenters(df, 3).collect()
    assert [r.username for r in top] == ["u0", "u1", "u2"]
    top = suspects.top_suspicious(df, 2, threshold=5).collect()
    assert [r.username for r in top] == ["u0", "u1"]


def test_comments_of_users(spark, make_tables):
    tables = make_tables(
        [
            (1, "2024-01-01", 1, 10, 0, 0, "first"),
            (2, "2024-01-02", 2, 10, 0, 0, "other"),
            (3, "2024-01-03", None, 10, 0, 0, "nobody"),
            (4, "2024-01-04", 1, 10, 0, 0, None),
        ]
    )
    ids = spark.createDataFrame([(1,), (1,), (None,)], "user_id long")
    found = suspects.comments_of_users(tables.comments, ids, start="2024-01-01", end="2024-01-04")
    assert values(found.select("comment_id", "text")) == [(1, "first")]
    everything = suspects.comments_of_users(tables.comments, ids)
    assert values(everything.select("comment_id")) == [(1,), (4,)]


def test_cumulative_share(activity):
    counts = [1, 1, 2, 2, 2, 7, 5]
    df = activity(*[("a", 1, "c", "2024-01", n, 1, 1) for n in counts])
    share = {r[0]: r[1] for r in profile.cumulative_share(df).collect()}
    assert share == pytest.approx({1: 2 / 20, 2: 8 / 20, 5: 13 / 20, 7: 1.0})


def test_density(activity):
    df = activity(
        ("a", 1, "c", "2024-01", 7, 3, 1),
        ("b", 2, "c", "2024-01", 7, 3, 1),
        ("c", 3, "c", "2024-01", 9, 9, 1),
        ("d", 4, "c", "2024-01", 60, 10, 1),
    )
    density = profile.commenter_density(df)
    assert values(density) == [(7, 3, 2), (9, 9, 1)]
    assert values(profile.commenter_density(df, None, 60)) == [(7, 3, 2), (9, 9, 1)]
    assert profile.commenter_density(df, max_periods=None).count() == 3
    assert values(profile.binned_density(density, 5, 4)) == [(5, 0, 2), (5, 8, 1)]
    assert values(profile.binned_density(density)) == values(density)


def test_time_series_counts_a_missing_user_once(activity):
    df = activity(
        ("a", 1, "c", "2024-01", 7, 3, 1),
        ("a", 1, "d", "2024-01", 7, 3, 1),
        (None, None, "c", "2024-01", 7, 3, 1),
        (None, None, "d", "2024-01", 7, 3, 1),
        ("b", 2, "d", "2024-02", 7, 3, 1),
    )
    assert values(profile.activity_over_time(df, "month")) == [("2024-01", 4, 2), ("2024-02", 1, 1)]


def test_totals(activity):
    df = activity(
        ("a", 1, "c", "2024-01", 20, 2, 10),
        ("a", 1, "d", "2024-01", 20, 2, 11),
        (None, None, "c", "2024-01", 10, 1, 1),
    )
    row = profile.totals(df).head()
    assert (row.total_records, row.total_users, row.total_comments) == (3, 2, 50)
    assert (row.suspicious_users, row.suspicious_distinct_users) == (2, 1)
    assert (row.suspicious_percentage, row.avg_comments_per_user) == (100.0, 25.0)


def test_totals_of_nothing(activity, spark):
    row = profile.totals(spark.createDataFrame([], schemas.ACTIVITY)).head()
    assert row.asDict() == {
        "total_records": 0, "total_users": 0, "total_comments": 0, "suspicious_users": 0,
        "suspicious_distinct_users": 0, "suspicious_percentage": 0.0, "avg_comments_per_user": 0.0,
    }


def test_summary(activity, spark):
    df = activity(*[(f"u{i}", i, "c", "2024-01", i, 1, i) for i in range(15)])
    labels = spark.range(10).select((F.col("id") % 3).cast("int").alias("cluster_label"))
    row = profile.summary(df, clustered=labels).head()
    assert row.total_users == 15 and row.suspicious_users == 5
    assert [t.username for t in row.top_commenters] == [f"u{i}" for i in range(14, 4, -1)]
    assert [tuple(c) for c in row.cluster_distribution] == [(0, 4), (1, 3), (2, 3)]
    assert "cluster_distribution" not in profile.summary(df).columns
