"""Targets, quotas and what the mix takes."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from chattermark.llm.mixing import mix, shard_quotas, source_targets


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Shares of all words by weight; full sources drop out until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_weight for s in order}
        above = {s for s in order if s not in full and target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        full |= above


def plain_seats(targets, house):
    """Sainte-Laguë, one seat after another."""
    seats = Counter()
    for _ in range(house):
        winner = max(targets, key=lambda s: (targets[s] / (2 * seats[s] + 1), [-ord(c) for c in s]))
        seats[winner] += 1
    return seats


def key(source):
    return "n" if source is None else f"s{source}"


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 5, "b": 1000, "c": 300, "d": 10, None: 70},
        {"a": 1, "b": 1, "c": 10_000},
        {"a": 0, "b": 10},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(key(s), n) for s, n in sizes.items()], "stratum string, source_size long")
    found = {r.stratum: r.target for r in source_targets(df).collect()}
    expected = plain_targets(sizes)
    assert found == pytest.approx({key(s): t for s, t in expected.items()})
    assert sum(found.values()) == pytest.approx(sum(sizes.values()))


@pytest.mark.parametrize("shards", [1, 3])
def test_quotas_are_highest_quotients(spark, shards):
    targets = {"sa": 530.0, "sb": 240.0, "sc": 110.0, "sd": 61.0, "se": 7.0, "sf": 0.0}
    df = spark.createDataFrame([(s, 948, t) for s, t in targets.items()], "stratum string, source_size long, target double")
    df = df.withColumn("source_size", F.when(F.col("stratum") == "sa", 948).otherwise(0).cast("long"))
    got = defaultdict(dict)
    for r in shard_quotas(df, 100, shards).collect():
        got[r.shard][r.stratum] = r.seats
    block = math.ceil(948 / 100)
    house = math.ceil(948 / block)
    for shard in range(shards):
        seats = plain_seats({s: t for s, t in targets.items() if t}, house * (shard + 1) // shards)
        assert {s: n for s, n in got[shard].items() if n} == dict(seats)


def test_taken_meets_targets(documents):
    rows = mix(documents).collect()
    assert len(rows) == documents.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 3 * r.size
        assert sum(r.shard_words) == r.taken
    expected = plain_targets({s: sum(r.size for r in own) for s, own in by.items()})
    for source, own in by.items():
        assert all(r.target == pytest.approx(expected[source]) for r in own)
        # Within two blocks of the target; here a block is one word.
        assert abs(sum(r.taken for r in own) - expected[source]) <= 2 + 0.01 * expected[source]


def test_blocks_cut_long_documents(texts):
    rows = [(1, "w " * 5000, "a"), (2, "v " * 100, "b"), (3, "u " * 900, "c")]
    found = {r.doc_id: r for r in mix(texts(*rows), blocks=60).collect()}
    block = math.ceil(6000 / 60)
    for r in found.values():
        assert abs(r.taken - r.target) <= block and r.taken <= 3 * r.size


def test_reruns_and_layout_agree(documents):
    def taken(df, **options):
        return {r.doc_id: (r.taken, r.shard_words) for r in mix(df, **options).collect()}

    assert taken(documents.coalesce(1)) == taken(documents.repartition(9))
    assert taken(documents) != taken(documents, seed=1)


def test_nulls_repeats_clashing_names_and_empty_table(texts):
    df = texts((None, None, None), (1, "a b", None), (1, "a b", None), (2, "", "x"), (3, " é\tq", "x"))
    df = df.withColumns({"Taken": F.lit("old"), "words": F.lit(9), "bucket": F.lit("b")})
    found = mix(df)
    assert [c for c in found.columns if c.lower() == "taken"] == ["taken"]
    rows = found.collect()
    assert sorted(r["size"] for r in rows) == [0, 0, 2, 2, 2] and {r.words for r in rows} == {9}
    assert all(r.taken <= 3 * r["size"] for r in rows)
    assert mix(texts()).count() == 0
    assert {r.taken for r in mix(texts((1, None), (2, ""))).collect()} == {0}
