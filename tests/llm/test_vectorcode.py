"""Vector codes against plain integer rounds, and the tree against all distances."""

import hashlib
import math

import numpy as np
import pytest

from chattermark.llm import queries, vectorcode
from chattermark.llm.gnat import Gnat, ceil_roots, floor_roots

SCHEMA = "vec_id long, embedding array<double>, label int"


def in_long(value):
    return value if value < 1 << 63 else None


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """{(vec_id, vector): (code, error)} and the codebooks, by the definition."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max((len(r[1]) for r in kept), default=0)
    width = -(-width // parts) * parts
    size = width // parts
    numbers = [
        [math.floor(x) * 4096 if abs(x) > 1e15 else math.floor(4096 * x) for x in r[1]] + [0] * (width - len(r[1]))
        for r in kept
    ]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for v in numbers]
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def assigned():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(v[p], e, strict=True)), i) for i, e in enumerate(books[p])) for p in range(parts)]
            for v in cut
        ]

    for _ in range(rounds if kept else 0):
        nearest = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p] for v, n in zip(cut, nearest, strict=True) if n[p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    result = [
        (r[0], "".join(f"{i:02x}" for _, i in n), in_long(sum(d for d, _ in n)))
        for r, n in zip(kept, assigned(), strict=True)
    ]
    return sorted(result, key=str), books


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA)
    books = vectorcode.fit(table, **options)
    coded = vectorcode.encode(table, books)
    return sorted([(r.vec_id, r.code, r.error) for r in coded.collect()], key=str), books


@pytest.mark.parametrize("seed, width, spread", [(0, 16, 1.0), (1, 8, 0.001), (2, 24, 1e9)])
def test_same_codes_as_plain_rounds(spark, seed, width, spread):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=width) * spread).tolist(), i % 3) for i in range(60)]
    rows += [rows[3], (None, rows[5][1], None)]
    codes, books = found(spark, rows)
    expected, plain = plain_codes(rows)
    assert codes == expected
    assert [[[int(v) for v in e] for e in part] for part in books.entries] == plain
    text = ",".join(str(v) for part in plain for entry in part for v in entry)
    assert books.sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_unusual_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, None, 0), (2, [1.0, None], 0), (3, [nan], 0), (4, [-inf], 0), (5, [], 1), (5, [], 1),
        (6, [0.5], 1), (7, [0.1] * 9, None), (None, [2.0] * 8, None),
    ]
    codes, _ = found(spark, rows)
    assert codes == plain_codes(rows)[0]
    assert {c[0] for c in codes} == {5, 6, 7, None}


def test_components_no_long_can_hold(spark):
    rows = [(i, [1e300 * (i % 3), -3e17, 1e-300, 5.0 * i] * 2, 0) for i in range(40)]
    codes, books = found(spark, rows)
    expected, plain = plain_codes(rows)
    assert codes == expected
    assert [[[int(v) for v in e] for e in part] for part in books.entries] == plain


def test_empty_table_and_empty_vectors(spark):
    assert found(spark, [])[0] == []
    assert found(spark, [(1, [], 0), (2, [], 0)])[0] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]


def test_other_columns_stay_and_clashing_ones_give_way(spark):
    table = spark.createDataFrame(
        [(1, [1.0] * 8, "a", "b", "c")], "vec_id long, embedding array<float>, Code string, part string, carried_row string"
    )
    row = vectorcode.encode(table, vectorcode.fit(table)).first().asDict()
    assert row["part"] == "b" and row["carried_row"] == "c" and row["code"] == "00" * 8 and "Code" not in row


def test_group_errors(spark):
    table = spark.createDataFrame([(1, 5), (1, 6), (None, 1), (None, 2), (2, None)], "label int, error long")
    rows = vectorcode.with_group_error(table).collect()
    assert sorted([(r.label, r.label_error) for r in rows], key=str) == sorted(
        [(1, 11), (1, 11), (None, 3), (None, 3), (2, None)], key=str
    )


@pytest.mark.parametrize("spread", [2, 50, 10**6, 10**25])
def test_tree_finds_the_first_nearest_entry(spread):
    rng = np.random.default_rng(spread % 97)
    for n in (1, 2, 4, 5, 16, 37):
        entries = rng.integers(-3, 4, (n, 3)) * min(spread, 10**6)
        asked = rng.integers(-4, 5, (300, 3)) * min(spread, 10**6)
        if spread > 10**6:
            entries, asked = entries.astype(object) * spread, asked.astype(object) * spread
        index, distance = Gnat(entries).nearest(asked)
        squares = ((asked[:, None] - entries[None]) ** 2).sum(2)
        assert (index == squares.argmin(1)).all() and (distance == squares.min(1)).all()


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(5)
    centres = rng.integers(-4000, 4000, (64, 4))
    asked = centres[rng.integers(0, 64, 2000)] + rng.integers(-40, 40, (2000, 4))
    tree = Gnat(centres)
    tree.nearest(asked)
    assert tree.measured < 2000 * 32


def test_roots_are_exact():
    values = np.array([0, 1, 2, 3, 4, (1 << 60) - 1, 1 << 60, (1 << 31) ** 2 - 1, (1 << 30) ** 2 + 1])
    assert floor_roots(values).tolist() == [math.isqrt(int(v)) for v in values]
    assert ceil_roots(values).tolist() == [math.isqrt(int(v) - 1) + 1 if v else 0 for v in values]


def test_limbs_add_up():
    for total in (0, 5, -5, 1 << 40, -(1 << 40) - 1, 1 << 200, -(3**150)):
        assert sum(value << (vectorcode.LIMB * place) for place, value in vectorcode.limbs(total)) == total


def test_registered_query(spark, tmp_path):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=16).tolist(), i % 2) for i in range(40)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    result = queries.op11_vectorcode(spark, str(tmp_path)).collect()
    codes, plain = plain_codes(rows)
    assert sorted([(r.vec_id, r.code, r.error) for r in result], key=str) == codes
    label_of = {r[0]: r[2] for r in rows}
    totals = {k: sum(c[2] for c in codes if label_of[c[0]] == k) for k in (0, 1)}
    assert all(r.label_error == totals[label_of[r.vec_id]] for r in result)
    assert len({r.codebooks_sha256 for r in result}) == 1
