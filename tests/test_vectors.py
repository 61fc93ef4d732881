import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from chattermark.operators import distances

SCHEMA = "vec_id long, embedding array<float>"


@pytest.fixture(scope="module")
def matrix():
    return np.random.default_rng(1).normal(size=(40, 7)).astype("float32")


@pytest.fixture(scope="module")
def vectors(spark, matrix):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], SCHEMA)


def test_all_pairs_by_list(spark, matrix, vectors):
    ids = range(len(matrix))
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids], "id_a long, id_b long")
    found = distances.pair_distances(vectors, pairs).toPandas().sort_values(["id_a", "id_b"])
    x = matrix.astype("float64")
    gaps = x[:, None, :] - x[None, :, :]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)

    def cells(column):
        return found[column].to_numpy().reshape(len(x), len(x))

    np.testing.assert_allclose(cells("cosine_similarity"), unit @ unit.T, atol=1e-12)
    np.testing.assert_allclose(cells("cosine_distance"), 1 - unit @ unit.T, atol=1e-12)
    np.testing.assert_allclose(cells("euclidean"), np.sqrt((gaps**2).sum(2)), atol=1e-12)
    np.testing.assert_allclose(cells("manhattan"), np.abs(gaps).sum(2), atol=1e-12)
    assert np.allclose(np.diag(cells("euclidean")), 0)
    np.testing.assert_allclose(cells("manhattan"), cells("manhattan").T)


def test_zero_missing_and_unknown_vectors(spark):
    vectors = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, None)], SCHEMA)
    pairs = spark.createDataFrame([(1, 2), (2, 3), (2, 9)], "id_a long, id_b long")
    found = {(r.id_a, r.id_b): r for r in distances.pair_distances(vectors, pairs).collect()}
    assert set(found) == {(1, 2), (2, 3)}
    assert found[1, 2].cosine_similarity == 0 and found[1, 2].euclidean == 5
    assert found[1, 2].manhattan == 7
    assert found[2, 3].euclidean is None


def test_unequal_lengths_are_refused(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], SCHEMA)
    pairs = spark.createDataFrame([(1, 2)], "id_a long, id_b long")
    with pytest.raises(PythonException, match="differ in length"):
        distances.pair_distances(vectors, pairs).collect()


def test_normalized(matrix, vectors, spark):
    zero = spark.createDataFrame([(99, [0.0] * 7)], SCHEMA)
    found = distances.normalized(vectors.union(zero)).orderBy("vec_id").collect()
    x = matrix.astype("float64")
    expected = x / np.linalg.norm(x, axis=1, keepdims=True)
    np.testing.assert_allclose([r.unit for r in found[:-1]], expected, atol=1e-12)
    assert found[-1].unit == [0.0] * 7


def test_matrix_row_means(matrix, vectors):
    found = distances.matrix_row_means(vectors).orderBy("vec_id").toPandas()
    x = matrix.astype("float64")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    squared = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.testing.assert_allclose(found["mean_cosine_similarity"], (unit @ unit.T).mean(1), atol=1e-9)
    np.testing.assert_allclose(
        found["mean_cosine_distance"], (1 - unit @ unit.T).mean(1), atol=1e-9
    )
    np.testing.assert_allclose(found["mean_squared_euclidean"], squared.mean(1), atol=1e-9)


def test_matrix_row_means_of_few(spark):
    one = spark.createDataFrame([(1, [3.0, 4.0])], SCHEMA)
    row = distances.matrix_row_means(one).head()
    assert row.mean_cosine_similarity == pytest.approx(1)
    assert row.mean_squared_euclidean == pytest.approx(0)
    none = spark.createDataFrame([], SCHEMA)
    assert distances.matrix_row_means(none).collect() == []
    assert distances.matrix_row_means(none).columns == distances.matrix_row_means(one).columns


def test_mean_pooling(spark):
    tokens = spark.createDataFrame(
        [
            (1, 0, [1.0, 2.0], 1),
            (1, 1, [3.0, 6.0], 1),
            (1, 2, [100.0, 100.0], 0),
            (2, 0, [5.0, 5.0], 0),
            (2, 1, [7.0, 7.0], 0),
            (3, 0, [1.0, 1.0], 3),
            (3, 1, [5.0, 9.0], 1),
            (4, 0, [4.0, 4.0], None),
        ],
        "doc_id long, pos int, vec array<float>, mask int",
    )
    pooled = {r.doc_id: r.embedding for r in distances.mean_pooling(tokens).collect()}
    assert pooled == {1: [2.0, 4.0], 2: [0.0, 0.0], 3: [2.0, 3.0], 4: [0.0, 0.0]}


def test_a_document_may_hold_most_tokens(spark):
    tokens = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"),
        F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vec"),
        F.lit(1).alias("mask"),
    )
    hot = distances.mean_pooling(tokens).filter("doc_id = 0").head()
    assert hot.embedding == pytest.approx([14998.5, 1.0])
