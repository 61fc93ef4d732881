"""Vector operators: distances, normalising and pooling.

A whole distance matrix has a row for every pair of vectors, which no cluster
holds for a large table. Distances are therefore computed for the pairs a table
lists; of the whole matrix its row means are given, exactly and in linear time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chattermark.functions.vectors import as_matrix, doubles, measures

# Fixed value: smallest divisor of a masked mean.
SMALLEST_MASK = 1e-9

_ROW_MEANS = ("mean_cosine_similarity", "mean_cosine_distance", "mean_squared_euclidean")


def pair_distances(
    vectors: DataFrame,
    pairs: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The measures of each pair `(id_a, id_b)` whose vectors both exist.

    Two equi joins. Ids that many pairs share are spread by the skew handling
    of the join, as neither join needs its rows grouped afterwards.
    """

    def side(letter: str) -> DataFrame:
        return vectors.select(
            F.col(id_column).alias(f"id_{letter}"), F.col(vector_column).alias(f"vector_{letter}")
        )

    found = pairs.select("id_a", "id_b").join(side("a"), "id_a").join(side("b"), "id_b")
    return found.select("id_a", "id_b", measures("vector_a", "vector_b").alias("m")).select(
        "id_a", "id_b", "m.*"
    )


def normalized(
    vectors: DataFrame, vector_column: str = "embedding", output_column: str = "unit"
) -> DataFrame:
    """Adds the vectors scaled to length 1; a zero vector stays as it is."""
    scaled = Normalizer(p=2.0, inputCol="__dense", outputCol="__unit").transform(
        vectors.withColumn("__dense", array_to_vector(vector_column))
    )
    return scaled.withColumn(output_column, vector_to_array("__unit")).drop("__dense", "__unit")


def matrix_row_means(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Row means of the all-pairs matrices, self pairs included.

    The mean cosine similarity of a vector to all others is its product with
    the mean unit vector; the mean squared Euclidean distance follows from the
    mean vector and the mean squared length. Only those two mean vectors and
    one number, fixed in size, pass through the driver.
    """
    unit = normalized(vectors.filter(F.col(vector_column).isNotNull()), vector_column, "unit")
    folded = unit.agg(
        Summarizer.mean(array_to_vector("unit")).alias("unit"),
        Summarizer.metrics("mean", "variance", "count")
        .summary(array_to_vector(vector_column))
        .alias("plain"),
    )
    if unit.isEmpty():
        empty = F.lit(None).cast("double")
        return unit.select(id_column, *[empty.alias(name) for name in _ROW_MEANS])
    means = folded.head()
    n = means.plain["count"]
    mean_unit, mean_plain = means.unit.toArray(), means.plain["mean"].toArray()
    # Mean squared distance = squared distance to the mean + total variance.
    spread = float(means.plain["variance"].toArray().sum()) * (n - 1) / n

    @F.arrow_udf(doubles("similarity", "centred"))
    def against_means(plain: pa.Array, unit: pa.Array) -> pa.Array:
        gap = as_matrix(plain) - mean_plain
        return pa.StructArray.from_arrays(
            [pa.array(as_matrix(unit) @ mean_unit), pa.array(np.einsum("ij,ij->i", gap, gap))],
            names=["similarity", "centred"],
        )

    scored = unit.select(id_column, against_means(vector_column, "unit").alias("m"))
    return scored.select(
        id_column,
        *[
            value.alias(name)
            for value, name in zip(
                (
                    F.col("m.similarity"),
                    1 - F.col("m.similarity"),
                    F.col("m.centred") + F.lit(spread),
                ),
                _ROW_MEANS,
            )
        ],
    )


def mean_pooling(
    tokens: DataFrame,
    id_column: str = "doc_id",
    vector_column: str = "vec",
    mask_column: str = "mask",
    output_column: str = "embedding",
) -> DataFrame:
    """Mean of the token vectors of each document, weighted by the mask.

    The sums combine on the map side, so a document with very many tokens adds
    one vector per task to the shuffle. All-zero masks give the zero vector.
    """
    mask = F.coalesce(F.col("mask"), F.lit(0.0))
    masked = tokens.select(
        id_column,
        F.col(vector_column).alias("vec"),
        F.col(mask_column).cast("double").alias("mask"),
    ).select(
        id_column,
        mask.alias("mask"),
        array_to_vector(F.transform("vec", lambda x: x * mask)).alias("vec"),
    )
    pooled = masked.groupBy(id_column).agg(
        Summarizer.sum(F.col("vec")).alias("total"),
        F.greatest(F.sum("mask"), F.lit(SMALLEST_MASK)).alias("weight"),
    )
    return pooled.select(
        id_column,
        F.transform(vector_to_array("total"), lambda x: x / F.col("weight")).alias(output_column),
    )
