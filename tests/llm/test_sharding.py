"""Interleaved shards: counts, mixture, reruns, odd rows."""

from collections import Counter

from pyspark.sql import functions as F

from chattermark.llm.sharding import interleave


def placed(df, n=8, **options):
    return interleave(df, n, **options).collect()


def check_law(rows, n):
    per_shard = Counter(r.shard for r in rows)
    counts = [per_shard.get(s, 0) for s in range(n)]
    assert max(counts) - min(counts) <= 1
    for s in range(n):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_every_shard_matches_the_mixture(texts):
    rows = [(i, f"text {i}", "big" if i % 3 else f"small{i % 5}") for i in range(1003)]
    found = placed(texts(*rows))
    assert sorted(r.doc_id for r in found) == list(range(1003))
    check_law(found, 8)
    whole = Counter(s for _, _, s in rows)
    for shard in range(8):
        own = Counter(r.source for r in found if r.shard == shard)
        for source, n in whole.items():
            assert abs(own[source] - n / 8) < 2


def test_plain_definition(spark, documents):
    import hashlib

    rows = documents.select("doc_id", "text", "source").collect()
    digest = {r.doc_id: hashlib.md5(f"42:{r.doc_id}:{r.text}".encode()).hexdigest() for r in rows}
    ranked = []
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, s))
    for j, source in enumerate(sources):
        own = sorted(digest[r.doc_id] for r in rows if r.source == source)
        turns = 2 * len(sources)
        ranked += [((turns * i + 2 * j + 1) / (turns * len(own)), d) for i, d in enumerate(own)]
    position = {d: i for i, (_, d) in enumerate(sorted(ranked))}
    for r in placed(documents, 7):
        at = position[digest[r.doc_id]]
        shard = ((at + 1) * 7 - 1) // len(rows)
        assert (r.shard, r.slot) == (shard, at - shard * len(rows) // 7)


def test_layout_and_reruns_agree(texts):
    rows = [(i, f"t{i}", f"s{i % 4}") for i in range(300)]
    one = {r.doc_id: (r.shard, r.slot) for r in placed(texts(*rows).coalesce(1))}
    two = {r.doc_id: (r.shard, r.slot) for r in placed(texts(*rows[::-1]).repartition(9))}
    other = {r.doc_id: (r.shard, r.slot) for r in placed(texts(*rows), seed=7)}
    assert one == two != other


def test_nulls_repeats_and_long_texts(texts):
    rows = [(None, None, None), (None, None, None), (1, "", None), (1, "", ""), (1, "", ""), (2, "x" * 200_000, "")]
    found = placed(texts(*rows), 4)
    assert len(found) == 6
    check_law(found, 4)


def test_more_shards_than_rows_and_empty_table(texts):
    check_law(placed(texts((1, "a"), (2, "b")), 5), 5)
    assert placed(texts(), 3) == []


def test_clashing_names_and_stretches(texts):
    df = texts(*[(i, "t") for i in range(50)]).withColumns(
        {"Shard": F.lit("old"), "digest": F.lit(1), "bucket": F.lit(2), "stratum": F.lit("x")}
    )
    found = interleave(df, 3, stretches=2)
    assert [c for c in found.columns if c.lower() == "shard"] == ["shard"]
    rows = found.collect()
    check_law(rows, 3)
    assert {(r.digest, r.bucket, r.stratum) for r in rows} == {(1, 2, "x")}


def test_no_python_in_the_plan(documents):
    plan = interleave(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
