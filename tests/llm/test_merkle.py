"""Fingerprints, likeness, located edits, and the pairs of neighbours."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from chattermark.llm import merkle, queries
from chattermark.llm.neighbours import map_descending

SF_DIR = "/root/testdata/sf0.001"


def words(r, n):
    return " ".join(f"w{r.randrange(500)}" + ("." if r.random() < 0.1 else "") for _ in range(n))


def test_equal_roots_mean_equal_texts():
    r = random.Random(1)
    base = [words(r, 20) for _ in range(30)]
    marks = {}
    for _ in range(300):
        text = "\n".join(r.choice(base) for _ in range(r.randrange(6)))
        text += r.choice(["", " ", "\n", "x"])
        mark = merkle.fingerprint(text)
        assert marks.setdefault(mark[:64], text) == text
        assert merkle.fingerprint(text) == mark


def test_edits_are_located():
    r = random.Random(2)
    lines = [words(r, 30) for _ in range(200)]
    edited = list(lines)
    edited[70] = edited[70].replace("w", "v", 1)
    del edited[150]
    edited.insert(20, "a new line")
    left, right = merkle.fingerprint("\n".join(lines)), merkle.fingerprint("\n".join(edited))
    assert merkle.differing(left, right) == [(20, 20, 20, 21), (70, 71, 71, 72), (150, 151, 151, 151)]
    assert 0.95 < merkle.likeness(left, right) < 1
    assert merkle.differing(left, left) == [] and merkle.likeness(left, left) == 1


def test_likeness_follows_the_common_part():
    r = random.Random(3)
    text, other = words(r, 3000), words(r, 3000)
    mark = merkle.fingerprint(text)
    for share in (0.1, 0.5, 0.9):
        cut = int(len(text) * share)
        value = merkle.likeness(mark, merkle.fingerprint(text[:cut] + other[cut:]))
        assert value == pytest.approx(share, abs=0.05)
    assert merkle.likeness(mark, merkle.fingerprint(other)) < 0.05
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(None)) == 1
    assert merkle.likeness(merkle.fingerprint(""), mark) == 0


def plain_pairs(rows):
    order = sorted(rows, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] is not None, x[1] or ""))
    return [(d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order)]


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_neighbours(texts, ranges):
    r = random.Random(ranges)
    ids = r.sample(range(-500, 10_000_000_000), 60)
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], "again"), (ids[1], None), (None, "no id"), (None, None)]
    found = map_descending(
        texts(*rows).repartition(5),
        lambda i, t, n: {"a": i, "b": t, "c": n},
        "a long, b string, c string",
        ranges,
    ).collect()
    key = str
    assert sorted(map(key, map(tuple, found))) == sorted(map(key, plain_pairs(rows)))


@pytest.mark.parametrize("rows", [[], [(1, "only")], [(None, "b"), (None, "a")], [(3, "x"), (3, "x")]])
def test_neighbours_of_few_rows(texts, rows):
    found = map_descending(texts(*rows), lambda i, t, n: {"a": i, "b": t, "c": n}, "a long, b string, c string")
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, plain_pairs(rows)))


def test_edited_texts_of_the_query(spark, documents):
    rows = {r.doc_id: r.text or "" for r in documents.collect()}
    order = sorted(rows, reverse=True)
    found = {r.doc_id: r for r in queries.op4_merkle(spark, SF_DIR).collect()}
    assert set(found) == set(rows)
    for i, doc_id in enumerate(order):
        text, following = rows[doc_id], rows[order[(i + 1) % len(order)]]
        part = len(text) // 3
        edited = text[: len(text) - part] + following[:part]
        row = found[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert row.fingerprint == merkle.fingerprint(text)
        assert row.edited_fingerprint == merkle.fingerprint(edited)
        assert row.near_edited == merkle.likeness(row.fingerprint, row.edited_fingerprint)
        assert row.near_next == merkle.likeness(row.fingerprint, merkle.fingerprint(following))


def test_columns(texts):
    df = texts((1, "a b\nc"), (1, "a b\nc"), (None, None), (2, "x " * 100_000)).withColumn("Fingerprint", F.lit(0))
    found = merkle.with_fingerprints(df)
    assert found.columns.count("fingerprint") == 1 and "Fingerprint" not in found.columns
    rows = found.collect()
    assert len({r.fingerprint for r in rows}) == 3
    pairs = found.select(
        "doc_id",
        merkle.likeness_of("fingerprint", "fingerprint").alias("near"),
        merkle.edits_between("fingerprint", F.lit(merkle.fingerprint("a b\nd"))).alias("edits"),
        merkle.is_equal(F.col("fingerprint"), F.lit(merkle.fingerprint(""))).alias("empty"),
    ).collect()
    assert {r.near for r in pairs} == {1.0} and sum(r.empty for r in pairs) == 1
    assert [tuple(e) for r in pairs if r.doc_id == 1 for e in r.edits] == [(1, 2, 1, 2)] * 2
    assert merkle.with_fingerprints(texts()).count() == 0
