"""Texts to vectors, to components, to clusters.

Vectors come from one of three places: the built-in lexical features (hashed
words weighted by inverse document frequency and projected to fewer dimensions,
which compare wording, not meaning), an encoder the caller supplies, or a vector column that is there
already. Reduction and clustering are Spark ML; only models of fixed size (one
d x d covariance, k centres) pass through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import IDF, PCA, HashingTF, RegexTokenizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark import settings
from chattermark.settings import ClusterSettings
from chattermark.sources.staging import stage

Encoder = Callable[[list[str]], "list[list[float]]"]

#: Points that a task of a fit holds at most, on average; copies of one text or vector that go to one task.
POINTS, COPIES = 200_000, 10_000
#: From so many rows on, the covariance of vectors of at most so many dimensions is added up by blocks of rows.
BLOCKED, BLOCKED_WIDTH, BLOCK = 100_000, 1024, 4096


def hashed_words(
    df: DataFrame, text_column: str = "text", output_column: str = "counts", n_features: int = 1 << 18
) -> DataFrame:
    """Adds word counts, words of any script, hashed into `n_features` places.

    Whole texts are used; a missing text counts as an empty one.
    """
    filled = df.withColumn("__text", F.coalesce(text_column, F.lit("")))
    words = RegexTokenizer(inputCol="__text", outputCol="__words", pattern=r"(?U)\W+")
    hashed = HashingTF(inputCol="__words", outputCol=output_column, numFeatures=n_features)
    return hashed.transform(words.transform(filled)).drop("__text", "__words")


def fit_weights(
    df: DataFrame, input_column: str = "counts", output_column: str = "weights"
) -> PipelineModel:
    """Model that weights counts by inverse document frequency."""
    return Pipeline(stages=[IDF(inputCol=input_column, outputCol=output_column)]).fit(df)


def project_words(
    df: DataFrame, input_column: str, output_column: str, n_dimensions: int = 512
) -> DataFrame:
    """Adds sparse vectors projected to `n_dimensions`, scaled to length 1.

    A sparse random projection: every place is added to one dimension, with a
    sign, both by a hash. Products of vectors keep their expected value. The vectors stay
    sparse, as short texts fill few dimensions.
    """

    def some_projected(vectors: pa.StructArray) -> pa.StructArray:
        indices, values = vectors.field("indices"), vectors.field("values")
        each = indices.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        mixed = indices.flatten().to_numpy(zero_copy_only=False).astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        signed = (1.0 - 2.0 * (mixed >> np.uint64(63)).astype(float)) * values.flatten().to_numpy(zero_copy_only=False)
        where = ((mixed >> np.uint64(20)) % np.uint64(n_dimensions)).astype("int64")
        at, inverse = np.unique(np.repeat(np.arange(len(each)), each) * n_dimensions + where, return_inverse=True)
        sums = np.bincount(inverse, weights=signed, minlength=len(at))
        row = at // n_dimensions
        length = np.sqrt(np.bincount(row, weights=sums * sums, minlength=len(each)))
        length[length == 0] = 1.0
        ends = np.append(0, np.cumsum(np.bincount(row, minlength=len(each)))).astype("int32")
        # The parts of a sparse vector as Spark stores it.
        parts = {
            "type": pa.array(np.zeros(len(each), dtype="int8")),
            "size": pa.array(np.full(len(each), n_dimensions, dtype="int32")),
            "indices": pa.ListArray.from_arrays(pa.array(ends), pa.array((at % n_dimensions).astype("int32"))),
            "values": pa.ListArray.from_arrays(pa.array(ends), pa.array(sums / length[row])),
        }
        return pa.StructArray.from_arrays(list(parts.values()), names=list(parts))

    @F.arrow_udf(VectorUDT())
    def projected(vectors: pa.Array) -> pa.Array:
        return pa.concat_arrays([some_projected(vectors.slice(at, 500)) for at in range(0, len(vectors), 500)])

    return df.withColumn(output_column, projected(F.unwrap_udt(input_column)))


def lexical_features(
    df: DataFrame,
    text_column: str = "text",
    output_column: str = "features",
    n_features: int = 1 << 18,
    n_dimensions: int = 512,
) -> tuple[DataFrame, PipelineModel]:
    """Adds a vector column from a column of texts."""
    counts = hashed_words(df, text_column, "__counts", n_features)
    model = fit_weights(counts, "__counts", "__weights")
    weighted = project_words(model.transform(counts), "__weights", output_column, n_dimensions)
    return weighted.drop("__counts", "__weights"), model


_kept: dict[str, Encoder] = {}


def kept_encoder(key: str, load_encoder: Callable[[], Encoder]) -> Encoder:
    """The encoder of this worker process; that of an earlier query gives way."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = load_encoder()
    return _kept[key]


def encode_texts(
    df: DataFrame,
    load_encoder: Callable[[], Encoder],
    text_column: str = "text",
    output_column: str = "embedding",
    batch_size: int = settings.DEFAULT_BATCH_SIZE,
) -> DataFrame:
    """Adds the vectors a caller's encoder gives to batches of texts.

    `load_encoder` runs once per Python worker and query, not per task or row, as long as Spark
    gives its workers further tasks; a worker that Spark starts anew loads it anew.
    """
    key = uuid.uuid4().hex

    @F.arrow_udf("array<float>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = kept_encoder(key, load_encoder)
        for texts in batches:
            words = [text or "" for text in texts.to_pylist()]
            rows: list = []
            for first in range(0, len(words), batch_size):
                rows.extend(encoder(words[first : first + batch_size]))
            yield pa.array(rows, type=pa.list_(pa.float32()))

    return df.withColumn(output_column, encode(text_column))


def as_vectors(df: DataFrame, column: str, output_column: str) -> DataFrame:
    """Adds a column as ML vectors, from arrays or from vectors."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return df.withColumn(output_column, F.col(column))
    return df.withColumn(output_column, array_to_vector(column))


@dataclass(frozen=True)
class Reduction:
    """Components of a vector column and how much of its variance they hold."""

    table: DataFrame
    model: PipelineModel
    explained_variance: list[float] = field(default_factory=list)

    @property
    def explained(self) -> float:
        return float(sum(self.explained_variance))


def _sums_of_products(column: str):
    """A function of batches of vectors: the sums of all products of two places, of each place, and the number of rows."""

    def blocks(vectors: pa.StructArray, width: int | None) -> Iterator[np.ndarray]:
        """Rows that hold anything, as matrices."""
        values = vectors.field("values")
        each = values.value_lengths().to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(each))
        flat = values.flatten().to_numpy(zero_copy_only=False)
        if width is None:
            where = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
            width = vectors.field("size")[0].as_py() if len(vectors) else 0
        else:
            where = np.tile(np.arange(width), len(vectors))
        for first in range(0, len(vectors), BLOCK):
            last = min(first + BLOCK, len(vectors))
            some = np.zeros((last - first, width))
            part = slice(ends[first], ends[last])
            some[np.repeat(np.arange(last - first), each[first:last]), where[part]] = flat[part]
            yield some

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = totals = None
        n_rows = 0
        for batch in batches:
            vectors = batch.column(column)
            n_rows += len(vectors)
            lengths = vectors.field("values").value_lengths().to_numpy(zero_copy_only=False)
            sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
            sizes = {*pc.unique(vectors.field("size")).drop_null().to_pylist(), *lengths[~sparse].tolist()}
            if len(sizes) > 1 or products is not None and sizes != {len(totals)}:
                raise ValueError(f"vectors differ in length: {sorted(sizes)}")
            if products is None:
                width = sizes.pop()
                products, totals = np.zeros((width, width)), np.zeros(width)
            for kind, length in ((sparse & (lengths > 0), None), (~sparse, len(totals))):
                for some in blocks(vectors.filter(pa.array(kind)), length):
                    products += some.T @ some
                    totals += some.sum(0)
        if n_rows:
            rows = [*products, totals, np.array([float(n_rows)])]
            task = TaskContext.get().partitionId()
            names = ["place", "task", "sums"]
            for first in range(0, len(rows), 64):
                some = rows[first : first + 64]
                places = pa.array(np.arange(first, first + len(some)))
                yield pa.RecordBatch.from_arrays([places, pa.array([task] * len(some)), pa.array(some)], names=names)

    return summed


def _of_all_tasks(table: pa.Table) -> pa.Table:
    """The sums of one place, added up in the order of the tasks."""
    table = table.sort_by("task")
    added = np.zeros(len(table["sums"][0]))
    for sums in table["sums"]:
        added += sums.values.to_numpy()
    return pa.table({"place": table["place"][:1], "sums": pa.array([added])})


def rows_of_same_covariance(df: DataFrame, column: str) -> DataFrame:
    """Few rows, two for each dimension, with mean zero and the covariance of a vector column.

    A row of many words costs Spark's own sum of products the square of their number, one by one; blocks of
    rows are multiplied some ten times as fast. Each task sends one matrix, whose rows are added up in
    as many groups.
    """
    sums = df.select(F.unwrap_udt(column).alias("vector")).where("vector IS NOT NULL").mapInArrow(
        _sums_of_products("vector"), "place long, task long, sums array<double>"
    )
    added = sums.groupBy("place").applyInArrow(_of_all_tasks, "place long, sums array<double>").toArrow()
    *products, totals, (n_rows,) = added.sort_by("place")["sums"].to_pylist()
    mean = np.array(totals) / n_rows
    covariance = (np.array(products) - n_rows * np.outer(mean, mean)) / max(n_rows - 1, 1)
    variances, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    rows = (directions * np.sqrt(np.maximum(variances, 0.0) * (len(mean) - 0.5))).T
    both = [(i, row.tolist()) for i, row in enumerate(np.vstack([rows, -rows]))]
    table = df.sparkSession.createDataFrame(both, "id long, row array<double>")
    return table.select(array_to_vector("row").alias(column))


def reduce_dimensions(
    df: DataFrame,
    input_column: str = "features",
    output_column: str = "components",
    n_components: int = settings.DEFAULT_COMPONENTS,
    n_rows: int = 0,
) -> Reduction:
    """Adds the first principal components, centred.

    The model projects without subtracting the mean, so the mean is taken off
    the short projected vectors instead: the result is the same, and sparse
    input stays sparse. Component signs are arbitrary. Where `n_rows` says that there are many rows,
    components are taken of few rows with the same covariance.
    """
    head = df.select(input_column).head()
    if head is None:
        raise ValueError("no vectors to reduce")
    k = min(n_components, len(head[0]))
    pca = PCA(k=k, inputCol=input_column, outputCol="__projected")
    if n_rows >= BLOCKED and len(head[0]) <= BLOCKED_WIDTH:
        pca = pca.fit(rows_of_same_covariance(df, input_column))
    model = Pipeline(
        stages=[
            pca,
            StandardScaler(
                withMean=True, withStd=False, inputCol="__projected", outputCol=output_column
            ),
        ]
    ).fit(df)
    table = model.transform(df).drop("__projected")
    return Reduction(table, model, model.stages[0].explainedVariance.toArray().tolist())


def with_projection(df: DataFrame, column: str = "components") -> DataFrame:
    """Adds `proj_x` and `proj_y`, the first two components, for display; 0 where there is none."""
    values = vector_to_array(column)
    axes = {f"proj_{name}": F.coalesce(F.get(values, F.lit(i)), F.lit(0.0)) for i, name in enumerate("xy")}
    return df.withColumns(axes)


def distinct_vectors(df: DataFrame, column: str, at_most: int) -> int:
    """Number of distinct vectors, counted no further than `at_most`.

    Hashes are grouped in 65,536 groups, of which each shows whether it has one
    or more. So the cost does not depend on the number of distinct vectors; the
    count may be low only where it is in the thousands.
    """
    hashed = df.select(F.xxhash64(vector_to_array(column)).alias("h"))
    groups = hashed.groupBy(F.pmod("h", F.lit(1 << 16)).alias("g")).agg(
        F.min("h").alias("low"), F.max("h").alias("high")
    )
    shown = groups.agg(F.sum(F.when(F.col("low") == F.col("high"), 1).otherwise(2))).head()[0]
    return min(shown or 0, at_most)


def best_kmeans(
    df: DataFrame,
    column: str = "components",
    n_clusters: int = settings.DEFAULT_CLUSTERS,
    restarts: int = settings.DEFAULT_RESTARTS,
    seed: int = settings.DEFAULT_SEED,
    max_iterations: int = settings.DEFAULT_ITERATIONS,
    parallelism: int | None = None,
    trial_iterations: int = 5,
    finalists: int = 3,
    layout_column: str | None = None,
    partitions: int = 16,
    copies_column: str | None = None,
) -> tuple[KMeansModel | None, list[float]]:
    """The cheapest of several k-means fits, and the cost of each.

    All restarts run for `trial_iterations`; the `finalists` cheapest are then
    fitted until their centres rest, mostly after 20 to 50 iterations. The cost
    of the others is that of their trial. Fits of a round run side by side, all
    of them unless `parallelism` says otherwise.

    Points are dealt to `partitions` tasks by hash of `layout_column` (of the
    vector if none is given) and sorted by it, as the choice of first centres
    depends on their order. So equal data and settings give equal labels, on any
    number of cores and from any layout.

    Rows where `copies_column` is true become one point for each vector they hold, which
    weighs as much as there are of them: centres and costs are those of all rows.

    The number of clusters is lowered to the number of distinct vectors if that
    is smaller. There is no model when that leaves a single cluster.
    """
    spread = F.xxhash64(layout_column or vector_to_array(column)).alias("__spread")
    rows = df.select(column, spread)
    weights = {}
    if copies_column:
        is_copy, weights = F.coalesce(copies_column, F.lit(False)), {"weightCol": "__weight"}
        copies = df.where(is_copy).groupBy(vector_to_array(column).alias("__values"))
        folded = copies.agg(F.count(F.lit(1)).cast("double").alias("__weight")).select(
            array_to_vector("__values").alias(column), F.xxhash64("__values").alias("__spread"), "__weight"
        )
        rows = df.where(~is_copy).select(column, spread, F.lit(1.0).alias("__weight")).unionByName(folded)
    # One stored copy for all fits; each would otherwise store its own.
    points = (
        rows.repartition(partitions, "__spread")
        .sortWithinPartitions("__spread")
        .drop("__spread")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        k = distinct_vectors(points, column, n_clusters)
        if k < 2:
            return None, []

        def fitted(chosen: list[int], iterations: int) -> dict[int, KMeansModel]:
            common = {"k": k, "featuresCol": column, "predictionCol": "cluster_label", **weights}
            estimators = [KMeans(seed=s, maxIter=iterations, **common) for s in chosen]
            fit = inheritable_thread_target(df.sparkSession)(lambda e: e.fit(points))
            with ThreadPool(min(parallelism or len(chosen), len(chosen))) as pool:
                return dict(zip(chosen, pool.map(fit, estimators), strict=True))

        models = fitted([seed + i for i in range(restarts)], min(trial_iterations, max_iterations))
        if max_iterations > trial_iterations:
            by_cost = sorted(models, key=lambda s: (models[s].summary.trainingCost, s))
            models |= fitted(by_cost[:finalists], max_iterations)
    finally:
        points.unpersist()
    costs = {s: m.summary.trainingCost for s, m in models.items()}
    return models[min(costs, key=lambda s: (costs[s], s))], list(costs.values())


def row_hash(df: DataFrame, column: Column) -> Column:
    """A hash of a column and all plain ones, so that rows equal in the column alone do not meet in one task."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.UserDefinedType, T.VariantType)
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, nested)]
    return F.xxhash64(column, *plain)


def spread_copies(df: DataFrame) -> tuple[DataFrame, bool]:
    """`df` with `__spread`: `__same`, or `__own` where `__many`, more than `COPIES` rows, share their `__same`; and whether any do."""
    counts = df.groupBy("__same").count().where(F.col("count") > COPIES)
    many = stage(counts.select("__same", F.lit(True).alias("__many")), "copies")
    spread = F.when(F.col("__many"), F.col("__own")).otherwise(F.col("__same"))
    dealt = df.join(many, "__same", "left").withColumn("__spread", spread).drop("__same", "__own")
    return dealt, not many.isEmpty()


@dataclass(frozen=True)
class ClusteredComments:
    """Comments with cluster label and projection, and the models behind them."""

    table: DataFrame
    explained: float | None = None
    costs: tuple[float, ...] = ()
    models: tuple[Model, ...] = ()


def _unplaced(df: DataFrame, label: int | None, place: float | None) -> DataFrame:
    return df.select(
        "*",
        F.lit(label).cast("int").alias("cluster_label"),
        F.lit(place).cast("double").alias("proj_x"),
        F.lit(place).cast("double").alias("proj_y"),
    )


def cluster_comments(
    df: DataFrame,
    text_column: str = "text",
    vector_column: str | None = None,
    config: ClusterSettings = ClusterSettings(),
) -> ClusteredComments:
    """Adds `cluster_label`, `proj_x` and `proj_y` to a table of comments.

    Vectors are taken from `vector_column` if given, else from the texts. They
    may have as many dimensions as the driver can hold a square matrix of, some
    thousands. Rows without a vector stay, with null in the three columns. An
    empty table comes back empty, with the three columns; comments that are all
    alike share one cluster.
    """
    if text_column not in df.columns:
        raise ValueError(f"column {text_column!r} not found")
    # Texts are read and split once; all fitting reads the staged vectors. Copies go to
    # one task only while they are few, as one text, or none, may be that of most comments.
    if vector_column:
        staged = stage(df, "vectors")
        without = staged.where(F.col(vector_column).isNull())
        staged = staged.where(F.col(vector_column).isNotNull())
        vectors = as_vectors(staged, vector_column, "__features")
        values = vector_to_array("__features")
        vectors = vectors.withColumns({"__same": F.xxhash64(values), "__own": row_hash(df, values)})
    else:
        tasks = max(config.partitions, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        text = F.col(text_column)
        dealt = df.withColumns({"__same": F.xxhash64(text), "__own": row_hash(df, text)}).repartition(tasks, "__own")
        staged = stage(hashed_words(dealt, text_column, "__counts", config.n_features), "counts")
        without = None
    output = [*df.columns, "cluster_label", "proj_x", "proj_y"]

    def whole(placed: DataFrame) -> DataFrame:
        if without is None:
            return placed.select(*output)
        return placed.select(*output).unionByName(_unplaced(without, None, None).select(*output))

    rows = staged.count()
    if rows < 2:
        return ClusteredComments(whole(_unplaced(staged, 0, 0.0)))
    partitions = max(config.partitions, -(-rows // POINTS))

    models: list[Model] = []
    if not vector_column:
        models.append(fit_weights(staged, "__counts", "__weights"))
        weighted = models[0].transform(staged)
        vectors = project_words(weighted, "__weights", "__features", config.n_dimensions)
        vectors = vectors.drop("__counts", "__weights")
    # The same tasks hold the same rows whatever the machine; all steps below add up in that order.
    dealt, any_copies = spread_copies(vectors)
    features = dealt.repartition(partitions, "__spread").sortWithinPartitions("__spread")
    if not vector_column:
        features = stage(features, "features")
    reduction = reduce_dimensions(features, "__features", "__components", config.n_components, rows)
    models.append(reduction.model)
    placed = with_projection(reduction.table, "__components")
    kmeans, costs = best_kmeans(
        placed,
        "__components",
        config.n_clusters,
        config.restarts,
        config.seed,
        config.max_iterations,
        trial_iterations=config.trial_iterations,
        finalists=config.finalists,
        layout_column="__spread",
        partitions=partitions,
        copies_column="__many" if any_copies else None,
    )
    if kmeans is None:
        single = placed.withColumn("cluster_label", F.lit(0))
        return ClusteredComments(whole(single), reduction.explained, (), tuple(models))
    models.append(kmeans)
    return ClusteredComments(
        whole(kmeans.transform(placed)), reduction.explained, tuple(costs), tuple(models)
    )
