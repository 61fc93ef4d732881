import random

import pytest
from pyspark.sql import functions as F

from chattermark import schemas
from chattermark.operators import clusters


@pytest.fixture(scope="module")
def data(spark):
    pick = random.Random(11)
    comments = [
        (i, pick.choice([1, 1, 1, 2, 3, 4, None]), pick.choice([0, 0, 1, 2]), f"text {i}")
        for i in range(300)
    ]
    activity = [
        (f"u{u}", u, f"c{c}", "2024-01", n := pick.randint(1, 9), 1, pick.randint(1, n), n * 2,
         0, 1, 0, pick.choice([None, 0.5, 2.25]), 0.0, None)
        for u in (1, 2, 3, None)
        for c in range(5 * (u or 1))
    ]
    return (
        spark.createDataFrame(
            comments, "comment_id long, user_id long, cluster_label int, text string"
        ).cache(),
        spark.createDataFrame(activity, schemas.ACTIVITY).cache(),
    )


def test_row_statistics_equal_the_fanned_out_join(data):
    clustered, activity = data
    joined = clustered.join(activity, "user_id", "left")
    expected = {
        r.cluster_label: r
        for r in joined.groupBy("cluster_label")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg("number_comments_all_time").alias("avg_comments"),
            F.avg("max_CPP_this_CH").alias("avg_max_cpp"),
            F.avg("mean_likes_per_comment").alias("avg_likes_per_comment"),
        )
        .collect()
    }
    found = clusters.cluster_statistics(clustered, activity)
    assert found.columns == ["cluster_label", "count", "avg_comments", "avg_max_cpp",
                             "avg_likes_per_comment"]
    for row in found.collect():
        other = expected[row.cluster_label]
        assert row["count"] == other["count"]
        for column in found.columns[2:]:
            assert row[column] == pytest.approx(other[column])


def test_user_statistics_count_each_comment_once(data):
    clustered, activity = data
    found = clusters.cluster_statistics(clustered, activity, "user").collect()
    sizes = {r.cluster_label: r["count"] for r in clusters.cluster_sizes(clustered).collect()}
    assert {r.cluster_label: r["count"] for r in found} == sizes
    with pytest.raises(ValueError):
        clusters.cluster_statistics(clustered, activity, "channel")


def test_samples(data):
    clustered, _ = data
    samples = clusters.cluster_samples(clustered, 4)
    found = {}
    for row in samples.orderBy("cluster_label", "rank").collect():
        found.setdefault(row.cluster_label, []).append(row.text)
    ordered = clustered.orderBy("comment_id").collect()
    for label in (0, 1, 2):
        expected = [r.text for r in ordered if r.cluster_label == label][:4]
        assert found[label] == expected
        assert clusters.cluster_rows(clustered, label).count() == sum(
            r.cluster_label == label for r in ordered
        )
        one = clusters.samples_of_cluster(clustered, label, 4).collect()
        assert [r.text for r in one] == expected
    lists = {r.cluster: r.samples for r in clusters.sample_lists(samples).collect()}
    assert lists == {f"cluster_{label}": found[label] for label in found}


def test_samples_are_limited_before_the_shuffle(data, spark):
    plan = clusters.cluster_samples(data[0], 4)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
