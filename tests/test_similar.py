"""Similar pairs against all pairs: nothing lost by splits, blocks or copies, nothing found twice."""

import numpy as np
import pytest

from chattermark.operators import similar

SCHEMA = "vec_id long, embedding array<double>"


def plain_pairs(rows, distance):
    """By comparing all classes of equal vectors."""
    classes = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            key = tuple(0.0 + x for x in v)
            classes[key] = min(i, classes.get(key, i))
    ids = sorted((i, v) for v, i in classes.items())
    matrix = np.array([v for _, v in ids])
    out = {}
    for a in range(len(ids)):
        gaps = np.sqrt(((matrix[a + 1 :] - matrix[a]) ** 2).sum(1))
        out |= {(ids[a][0], ids[a + 1 + b][0]): gaps[b] for b in np.flatnonzero(gaps <= distance)}
    return out


def found_pairs(spark, rows, distance, **options):
    got = similar.similar_pairs(spark.createDataFrame(rows, SCHEMA), distance, **options).collect()
    assert len({(r.id_a, r.id_b) for r in got}) == len(got)
    return {(r.id_a, r.id_b): r.distance for r in got}


def clustered(seed, n=600, dim=8, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dim))
    return [(i, (centres[rng.integers(40)] + rng.normal(size=dim) * spread).tolist()) for i in range(n)]


@pytest.mark.parametrize("most, distance", [(8, 0.1), (60, 0.2), (10_000, 0.2)])
def test_all_pairs_are_found_however_cells_are_cut(spark, most, distance):
    rows = clustered(most)
    expected = plain_pairs(rows, distance)
    found = found_pairs(spark, rows, distance, most=most, directions=4)
    assert len(expected) > 50
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-12 for k in found)


def test_vectors_no_line_parts_are_compared_in_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(200)]
    assert found_pairs(spark, rows, 2.5, most=30, directions=2).keys() == plain_pairs(rows, 2.5).keys()


def test_pairs_at_the_edges_of_pieces(spark):
    rows = [(i, [i * 0.25, 0.0]) for i in range(200)] + [(1000 + i, [0.0, i * 0.25]) for i in range(1, 200)]
    found = found_pairs(spark, rows, 0.25, most=16, directions=3)
    assert found.keys() == plain_pairs(rows, 0.25).keys()


def test_copies_are_one_class(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500, 0, -1)] + [(-5, [1.0, 2.1]), (-6, [9.0, 9.0]), (-4, [-0.0, 0.0]), (7000, [0.0, -0.0])]
    assert found_pairs(spark, rows, 0.2, most=10).keys() == {(-5, 1)}
    table = spark.createDataFrame(rows, SCHEMA)
    classes = {r.id: (r.class_id, r.n_members) for r in similar.vector_classes(table).collect()}
    assert classes[321] == (1, 500) and classes[-5] == (-5, 1) and classes[7000] == (-4, 2)


def test_unusual_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, [nan, 0.0]), (3, [inf, 0.0]), (4, [None, 0.0]), (None, [0.0, 0.0]), (5, [0.0, 0.1]), (6, [0.0, 0.0])]
    assert found_pairs(spark, rows, 1.0).keys() == {(5, 6)}
    assert found_pairs(spark, [], 1.0) == {}
    assert found_pairs(spark, [(1, []), (2, [])], 1.0) == {}
    assert found_pairs(spark, [(1, [1.0]), (2, [1.0]), (3, [2.0])], 0.0) == {}
    with pytest.raises(ValueError):
        found_pairs(spark, rows, -1.0)


def test_tables_find_what_they_promise_and_nothing_else(spark):
    rows = clustered(9, n=1500, dim=16, spread=0.04)
    distance = 0.2
    expected = plain_pairs(rows, distance)
    options = {"tables": 6, "projections": 4, "width": 1.6}
    found = found_pairs(spark, rows, distance, most=64, **options)
    assert found.keys() <= expected.keys()
    recall = len(found) / len(expected)
    assert similar.expected_recall(distance, 1.6, 6, 4) > 0.95
    assert recall >= 0.9
    one = found_pairs(spark, rows, distance, tables=1, projections=4, width=0.4)
    promised = similar.expected_recall(distance, 0.4, 1, 4)
    assert promised < 0.9 and promised - 0.1 < len(one) / len(expected) < 0.9


def test_large_bucket_of_a_table_is_cut_without_loss(spark):
    rows = clustered(2, n=500, spread=0.02)
    options = {"tables": 3, "projections": 1, "width": 5.0}
    whole = found_pairs(spark, rows, 0.05, most=10_000, **options)
    assert found_pairs(spark, rows, 0.05, most=16, directions=4, **options) == whole


def test_cosine_distance_by_unit_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(150)] + [(900, [0.0, 0.0, 0.0])]
    unit = similar.unit_length(spark.createDataFrame(rows, SCHEMA))
    found = {(r.id_a, r.id_b) for r in similar.similar_pairs(unit, (2 * 0.02) ** 0.5).collect()}
    matrix = np.array([v for _, v in rows[:-1]])
    matrix /= np.linalg.norm(matrix, axis=1)[:, None]
    near = np.argwhere(np.triu(1 - matrix @ matrix.T <= 0.02, 1))
    assert found == {(int(a), int(b)) for a, b in near}


def test_cells_stay_small_where_lines_part_them(spark):
    rows = spark.createDataFrame([(i, [i * 1.0, 0.0]) for i in range(4000)], SCHEMA)
    classes = rows.select(rows.vec_id.alias("id"), rows.embedding.alias("vector"))
    placed = similar._placed(classes, 2, 1, 0, 1.0, 42)
    largest = similar._cells(placed, 1.0, 2, 50).groupBy("cell").count().agg({"count": "max"}).first()[0]
    assert largest <= 50


def test_guests_along_several_lines_are_within_one_distance_in_all(spark):
    points = np.random.default_rng(8).normal(size=(1500, 8))
    points[::50] = points[1::50] + 0.05  # pairs 0.141 apart
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id long, vector array<double>")
    made = []
    original = similar._cells
    similar._cells = lambda *given: made.append(original(*given)) or made[0]
    try:
        pairs = similar.similar_pairs(rows, 0.2, id_column="id", vector_column="vector", most=24)
        found = {(r.id_a, r.id_b) for r in pairs.collect()}
    finally:
        similar._cells = original
    gaps = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    assert found == {(int(i), int(j)) for i, j in zip(*np.nonzero(gaps <= 0.2), strict=True) if i < j}
    assert len(found) >= 30
    assert made[0].count() < 2.6 * len(points)


def pairs_of_all_rows(rows, distance):
    """By comparing all rows, as often as they come."""
    return sorted(
        (i, j)
        for i, v in rows
        for j, w in rows
        if i < j and np.sqrt(((np.array(v) - np.array(w)) ** 2).sum()) <= distance
    )


@pytest.mark.parametrize("most", [8, 10_000])
def test_copies_have_all_their_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(similar, "CHUNK", 7)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(12, 3))
    points[6:] = points[:6] + 0.03
    # Some vectors once, some several times, one forty times; ids that two rows or two vectors share.
    rows = [(n, points[n % 12].tolist()) for n in range(30)] + [(100 + n, points[3].tolist()) for n in range(40)]
    rows += [(5, points[5].tolist()), (7, points[2].tolist()), (8, points[2].tolist()), (200, [0.0, 50.0, 0.0]), (201, [-0.0, 50.0, 0.0])]
    table = spark.createDataFrame(rows, SCHEMA)
    got = similar.similar_pairs(table, 0.1, most=most, copies=True).collect()
    expected = pairs_of_all_rows(rows, 0.1)
    assert sorted((r.id_a, r.id_b) for r in got) == expected
    assert (200, 201) in expected and len(expected) > 1000
    vector = dict(rows[:30])
    assert all(abs(r.distance - np.linalg.norm(np.subtract(vector[r.id_a], vector[r.id_b]))) < 1e-12
               for r in got if r.id_b < 30 and r.id_a not in (5, 7, 8) and r.id_b not in (5, 7, 8))
    assert {r.distance for r in got if r.id_a >= 100} == {0.0}


def test_query_finds_the_pairs_of_equal_vectors(spark, tmp_path):
    import __spark_entry__

    rng = np.random.default_rng(6)
    points = rng.normal(size=(5, 64))
    rows = [(n, points[n % 5].tolist(), 0) for n in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = __spark_entry__.vector_similar_pairs(spark, str(tmp_path)).collect()
    both = [(i, np.array(v, dtype="float32").astype(float)) for i, v, _ in rows]
    both += [(-i - 1, v + np.eye(64)[i % 64] * (i % 10 + 1) / 100) for i, v in both]
    assert sorted((r.id_a, r.id_b) for r in got) == pairs_of_all_rows(both, 0.065)


def test_vectors_move_a_few_times_and_are_cut_on_in_the_tasks(spark, monkeypatch):
    points = np.random.default_rng(12).normal(size=(3000, 32))
    points /= np.linalg.norm(points, axis=1)[:, None]
    points[::30] = points[1::30] + 0.01  # pairs 0.057 apart
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    made = []
    original = similar._cells

    def counted(*given):
        made.append((cells := original(*given)).count())
        return cells

    monkeypatch.setattr(similar, "_cells", counted)
    assert found_pairs(spark, rows, 0.07, most=32).keys() == plain_pairs(rows, 0.07).keys()
    assert made[-1] == 3000
    monkeypatch.setattr(similar, "LEAST", 1)  # cut between tasks, then in them
    found = found_pairs(spark, rows, 0.07, most=32)
    assert found.keys() == plain_pairs(rows, 0.07).keys() and len(found) >= 100
    assert 3000 < made[-1] < 12_000


@pytest.mark.parametrize("most, least", [(8, 1), (8, 100), (64, 1), (600, 1)])
def test_all_pairs_are_found_however_tasks_share_the_cutting(spark, monkeypatch, most, least):
    monkeypatch.setattr(similar, "LEAST", least)
    monkeypatch.setattr(similar, "GATHERED", 20)
    rows = clustered(21, dim=3)
    rows += [(i + 1000, [x * 0.01 for x in v]) for i, v in rows[:150]]  # no line cuts these
    rows += [(2000, [1e3, 1e3, 1e3]), (2001, [1e3, 1e3, 1e3 + 0.05])]
    expected = plain_pairs(rows, 0.1)
    found = found_pairs(spark, rows, 0.1, most=most, directions=5)
    assert found.keys() == expected.keys() and (2000, 2001) in found
    assert all(abs(found[k] - expected[k]) < 1e-12 for k in found)


def test_one_huge_vector_hides_no_pair(spark):
    rows = [(0, [1e200, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 0.05]), (3, [9.0, 0.0])]
    assert found_pairs(spark, rows, 0.1, most=2).keys() == {(1, 2)}
