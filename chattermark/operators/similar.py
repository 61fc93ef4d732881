"""Similar pairs: all pairs of vectors within a Euclidean distance.

Vectors are dealt to cells, only those of one cell are compared, and every pair that is
returned has its exact distance.

* Tables. With `tables` and `projections`, vectors first fall into the buckets of so many
  hash tables: a bucket is where `projections` random lines, cut into pieces of `width`, agree. Each
  pair has `tables` chances to meet; more tables find more, more projections compare less.
  With no projections there is one bucket, and nothing is lost.
* Splits. A bucket of more rows than a task holds is cut along one of `directions` orthogonal
  lines into pieces of four distances. Along a line two vectors are never farther apart than they
  are, so a pair lies in one piece or in adjoining ones; a row near the lower edge of its piece
  is also a guest of the piece below. A split therefore loses no pair and finds none twice. Pieces
  still too large are cut along the next line. Guests are few, as a piece is four distances long, and
  as the lines are orthogonal: the squares of all the ways a guest has gone from its piece add up to the square of one distance at most.
* Blocks. What no line cuts, vectors that all lie within a few distances of each other, is compared block by
  block. Nothing is capped or sampled.
* Tasks. What a task holds it cuts on in memory, in the same way, until pieces have `most` rows, and
  compares those. There a guest costs a number, between tasks a whole vector; so tasks hold as much
  as `HELD` bytes of vectors, or a sixteenth of all, and vectors move few times.

Equal vectors are one class before all that, and classes are what is compared. Pairs are those of
class representatives (the smallest id), with the membership in `vector_classes`; or, with `copies`, those
of all rows, equal vectors included, as many as there are. Members are then dealt to chunks of
`CHUNK` ids, and pairs of chunks are expanded in the tasks, so a class of any size fits.

Vectors that are null or hold a null, NaN or infinite component, and rows without an id, have
no pairs and no class. All vectors must have one length.

Shuffles: distinct vectors once, then only numbers along the lines while cells are cut, and the
vectors once more to their cells, as often as they are guests. Row counts and the largest component are all the driver sees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chattermark.functions.vectors import as_matrix
from chattermark.sources.staging import new_folder, run_folder, stage, stage_at

MOST = 2048
DIRECTIONS = 16
BLOCK = 512
CHUNK = 256
#: Bytes of vectors that a cell has at most where lines cut it, and rows it may have in any case.
HELD, LEAST = 1 << 26, 8192
#: Pairs that a task gathers before it hands them on.
GATHERED = 100_000
FOUND = ("x", "y", "a", "b", "n_x", "n_y", "distance")


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of rows with an id and a vector of finite components."""
    rows = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite)


def unit_length(vectors: DataFrame, vector_column: str = "embedding") -> DataFrame:
    """Vectors of length one, without those of no length: a cosine distance d is then sqrt(2 d)."""
    values = F.col(vector_column).cast("array<double>")
    length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))
    scaled = F.transform(values, lambda x: x / F.col("vector_length"))
    return (
        vectors.withColumn("vector_length", length)
        .where("vector_length > 0")
        .withColumn(vector_column, scaled)
        .drop("vector_length")
    )


def _representatives(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vector").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n_members"))


def _names(vector: str = "vector") -> list:
    """128 bits that name a vector, the same for 0 and -0."""
    values = F.transform(vector, lambda x: x + 0.0)
    return [F.xxhash64(values).alias("name_1"), F.xxhash64(F.lit(1), values).alias("name_2")]


def vector_classes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(id, class_id, n_members): the smallest id among equal vectors, for every usable row."""
    rows = usable(vectors, id_column, vector_column)
    return rows.join(_representatives(rows), "vector").select("id", "class_id", "n_members")


def _lines(dim: int, count: int, seed: int) -> np.ndarray:
    """Unit vectors as columns, orthogonal ones as far as the dimension allows."""
    drawn = np.random.default_rng([seed, dim]).normal(size=(dim, count))
    unit, _ = np.linalg.qr(drawn[:, : min(dim, count)])
    extra = drawn[:, unit.shape[1] :]
    return np.hstack([unit, extra / np.linalg.norm(extra, axis=0)])


def _placed(
    classes: DataFrame, directions: int, tables: int, projections: int, width: float, seed: int
) -> DataFrame:
    """Classes with `places` along the lines and the `bucket` of each table."""

    @F.arrow_udf("array<double>")
    def places(vectors: pa.Array) -> pa.Array:
        rows = as_matrix(vectors)
        out = rows @ _lines(rows.shape[1], directions, seed) if rows.size else np.zeros((len(rows), directions))
        return _list_array(out, pa.float64())

    @F.arrow_udf("array<bigint>")
    def buckets(vectors: pa.Array) -> pa.Array:
        rows = as_matrix(vectors)
        draw = np.random.default_rng([seed, rows.shape[1], 1])
        lines = draw.normal(size=(rows.shape[1], tables * projections))
        offsets = draw.uniform(0, width, tables * projections)
        pieces = np.floor((rows @ lines + offsets) / width).astype("int64")
        out = np.zeros((len(rows), tables), dtype="int64")
        for t in range(tables):
            for p in range(projections):
                out[:, t] = out[:, t] * 1_000_003 + pieces[:, t * projections + p]
        return _list_array(out, pa.int64())

    bucket = buckets("vector") if projections else F.array_repeat(F.lit(0).cast("long"), 1)
    orthogonal = F.least(F.size("vector"), F.lit(directions)).alias("orthogonal")
    return classes.select("*", places("vector").alias("places"), bucket.alias("buckets"), orthogonal)


def _list_array(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(rows) + 1, dtype="int32") * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), kind))


def _cut(rows: DataFrame, line: int, reach: float) -> DataFrame:
    """Rows of crowded cells in the pieces along one line that they belong to or visit.

    Cells that one piece would hold whole (not `parts`) stay as they are. `spent` is the sum of squares
    of the ways a guest has gone along orthogonal lines, to the edges of the pieces it visits; a pair's distance
    is no shorter than its root. `places` begin with that along this line, which goes.
    """
    size = 4 * reach
    place = F.get("places", F.lit(0))
    piece = F.floor(place / size)
    counts = F.lit(line) < F.col("orthogonal")
    spent = F.when(counts, F.col("spent")).otherwise(0.0)
    down, up = (F.pow(way, 2) for way in (place - piece * size, (piece + 1) * size - place))
    above, below = (spent + way <= reach * reach for way in (down, up))
    none = F.array().cast("array<struct<piece:bigint,home:boolean,spent:double>>")

    def visit(number, home, way=F.lit(0.0)):
        gone = F.when(counts, F.col("spent") + way).otherwise(F.col("spent"))
        return F.array(F.struct(number.alias("piece"), home.alias("home"), gone.alias("spent")))

    stays = F.concat(
        visit(piece, F.col("home")),
        F.when(above, visit(piece - 1, F.lit(False), down)).otherwise(none),
        F.when(below & ~F.col("home"), visit(piece + 1, F.lit(False), up)).otherwise(none),
    )
    stays = F.when(F.col("parts"), stays).otherwise(visit(F.lit(0).cast("long"), F.col("home")))
    return rows.select("*", F.explode(stays).alias("stay")).select(
        F.when(F.col("parts"), F.xxhash64("cell", F.lit(line), "stay.piece")).otherwise(F.col("cell")).alias("cell"),
        "id",
        F.slice("places", F.lit(2), F.greatest(F.size("places") - 1, F.lit(0))).alias("places"),
        "orthogonal",
        F.col("stay.home").alias("home"),
        F.col("stay.spent").alias("spent"),
    )


def _cells(placed: DataFrame, reach: float, directions: int, most: int) -> DataFrame:
    """(cell, id, home, block, mixed): who is compared where."""
    bucket = F.posexplode("buckets").alias("table", "bucket")
    rows = placed.select("id", "places", "orthogonal", bucket).select(
        F.xxhash64("table", "bucket").alias("cell"), "id", "places", "orthogonal",
        F.lit(True).alias("home"), F.lit(0.0).alias("spent"),
    )
    plain = ("cell", "id", "home", F.lit(0).alias("block"), F.lit(False).alias("mixed"))
    done: DataFrame | None = None
    for line in range(directions + 1):
        place = F.get("places", F.lit(0))
        spread = F.max(place) - F.min(place)
        sizes = rows.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n_rows"), (spread > 4 * reach).alias("parts"), F.max("home").alias("homes")
        )
        crowded = stage(sizes.where((F.col("n_rows") > most) & F.col("homes")), "crowded-cells")
        if not crowded.limit(1).count():
            break
        stay = rows.join(crowded, "cell", "left_anti").select(*plain)
        done = stay if done is None else done.unionByName(stay)
        left = rows.join(crowded, "cell")
        if line == directions:
            return done.unionByName(_blocks(left, most))
        rows = stage(_cut(left, line, reach), "cut-cells")
    rest = rows.select(*plain)
    return rest if done is None else done.unionByName(rest)


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Every two blocks of a cell as a cell of their own."""
    n_blocks = F.ceil(F.col("n_rows") / most)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), n_blocks).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int"))))
    pair = [F.least("block", "other"), F.greatest("block", "other")]
    return met.select(
        F.xxhash64("cell", *pair).alias("cell"), "id", "home", "block", (F.col("block") != F.col("other")).alias("mixed")
    )


def _near(
    rows: np.ndarray, places: np.ndarray, orthogonal: int, home: np.ndarray, reach: float, distance: float, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, distance) of the pairs of a cell's rows, at least one of them at home there.

    Cuts along the lines in turn, as `_cells` does, into pieces of four distances or, where these hold less, half of `most` rows.
    """
    squares = np.einsum("ij,ij->i", rows, rows)
    some = max(1, 8 * BLOCK * BLOCK // max(rows.shape[1], 1))  # differences at once, as many numbers as eight blocks have

    def compared(own: np.ndarray, guests: np.ndarray):
        every = np.concatenate([own, guests])
        # A product is quick but rounds; what may be within, or has no product, is measured anew by differences.
        slack = distance * distance + 1e-9 * (1 + 2 * squares[every].max(initial=0.0))
        for a in range(0, len(own), BLOCK):
            left = own[a : a + BLOCK]
            for b in range(a, len(every), BLOCK):
                right = every[b : b + BLOCK]
                gaps = squares[left, None] + squares[None, right] - 2 * rows[left] @ rows[right].T
                i, j = np.nonzero(~(gaps > slack))
                kept = i + a < j + b
                i, j = left[i[kept]], right[j[kept]]
                for first in range(0, len(i), some):
                    x, y = i[first : first + some], j[first : first + some]
                    exact = np.sqrt(((rows[x] - rows[y]) ** 2).sum(1))
                    near = exact <= distance
                    yield x[near], y[near], exact[near]

    def cut(own: np.ndarray, guests: np.ndarray, spent: np.ndarray, line: int):
        """Pairs of own rows and of own rows and guests; `spent` is as in `_cut`."""
        if not len(own) or len(own) + len(guests) < 2:
            return
        while line < places.shape[1] and len(own) * (len(own) + len(guests)) > most * most:
            place = places[own, line]
            order = np.argsort(place, kind="stable")
            own, place = own[order], place[order]
            starts = [0]
            while (end := max(np.searchsorted(place, place[starts[-1]] + 4 * reach), starts[-1] + max(most // 2, 1))) < len(own):
                starts.append(int(np.searchsorted(place, place[end])))
                if starts[-1] == starts[-2]:  # the rest of a piece of equal places
                    starts[-1] = int(np.searchsorted(place, place[end], "right"))
            starts = [x for x in starts if x < len(own)]
            visits = places[guests, line]
            for first, last in pairwise([*starts, len(own)]):
                low, high = place[first], place[last - 1]
                above = slice(last, int(np.searchsorted(place, high + reach, "right")))
                way = np.maximum(np.maximum(low - visits, visits - high), 0.0) ** 2
                gone = spent + way if line < orthogonal else np.maximum(spent, way)
                stays = gone <= reach * reach
                if len(starts) == 1:
                    guests, spent = guests[stays], gone[stays]
                else:
                    yield from cut(
                        own[first:last],
                        np.concatenate([own[above], guests[stays]]),
                        np.concatenate([(place[above] - high) ** 2, gone[stays]]),
                        line + 1,
                    )
            if len(starts) > 1:
                return
            line += 1
        yield from compared(own, guests)

    every = np.arange(len(rows))
    yield from cut(every[home], every[~home], np.zeros(int((~home).sum())), 0)


def _search(distance: float, reach: float, directions: int, most: int, seed: int):
    """A function of batches of rows in order of their cells, returning the pairs of each cell."""

    def of_cell(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pa.Table.from_batches(parts).combine_chunks()
        home = cell["home"].to_numpy()
        if len(home) < 2 or not home.any():
            return
        ids, block = cell["id"].to_numpy(), cell["block"].to_numpy()
        mixed = cell["mixed"][0].as_py()
        rows = cell["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(home), -1)
        lines = _lines(rows.shape[1], directions, seed) if rows.size else np.zeros((0, directions))
        held: list[tuple[np.ndarray, ...]] = []

        def gathered() -> pa.RecordBatch:
            i, j, exact = (np.concatenate(part) for part in zip(*held, strict=True))
            held.clear()
            i, j = np.where(ids[i] < ids[j], (i, j), (j, i))
            both = [cell[c].combine_chunks().take(pa.array(at)) for c in ("id", "class_id", "n_members") for at in (i, j)]
            return pa.RecordBatch.from_arrays([*both, pa.array(exact)], names=list(FOUND))

        near = _near(rows, rows @ lines, min(rows.shape[1], directions), home, reach, distance, most)
        for i, j, exact in near:
            if mixed:
                kept = block[i] != block[j]
                i, j, exact = i[kept], j[kept], exact[kept]
            if len(i):
                held.append((i, j, exact))
            if sum(len(part[0]) for part in held) >= GATHERED:
                yield gathered()
        if held:
            yield gathered()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            ends = np.flatnonzero(np.diff(cells)) + 1
            for first, last in pairwise([0, *ends.tolist(), len(cells)]):
                if parts and cells[first] != current:
                    yield from of_cell(parts)
                    parts = []
                if last > first:
                    current = cells[first]
                    parts.append(batch.slice(first, last - first))
        if parts:
            yield from of_cell(parts)

    return pairs


def _chunks_of(number: str):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(number) - 1) / CHUNK)))


def _expanded(found: DataFrame, placed: DataFrame, rows: DataFrame) -> DataFrame:
    """(id_a, id_b, distance) of the members of classes that are pairs, and of each class of several."""
    several = placed.where("n_members > 1").select(F.col("id").alias("key"), "class_id", "n_members", *_names())
    members = rows.select("id", *_names()).join(several, ["name_1", "name_2"])
    # Copies of a row have one id, so rows of one id are told apart by nothing, and any deal of them will do.
    n_chunks = F.floor((F.col("n_members") - 1) / CHUNK) + 1
    chunks = members.groupBy("key", F.pmod(F.xxhash64("id"), n_chunks).alias("chunk")).agg(
        F.collect_list("id").alias("ids")
    )

    lone = found.where("n_x = 1 AND n_y = 1").select("a", "b", "distance")
    itself = several.select(
        F.col("key").alias("x"), F.col("key").alias("y"), F.col("class_id").alias("a"), F.col("class_id").alias("b"),
        F.col("n_members").alias("n_x"), F.col("n_members").alias("n_y"), F.lit(0.0).alias("distance"),
    )
    met = (
        found.where("n_x > 1 OR n_y > 1")
        .unionByName(itself)
        .withColumn("chunk_x", _chunks_of("n_x"))
        .withColumn("chunk_y", _chunks_of("n_y"))
        .where("x != y OR chunk_x <= chunk_y")
    )
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(tasks, "x", "chunk_x", "y", "chunk_y")
    for side, id_of in (("x", "a"), ("y", "b")):
        of_side = chunks.select(F.col("key").alias(side), F.col("chunk").alias(f"chunk_{side}"), F.col("ids").alias("ids"))
        ids = F.coalesce("ids", F.when(F.col(f"n_{side}") == 1, F.array(id_of)))
        met = met.join(of_side, [side, f"chunk_{side}"], "left").withColumn(f"ids_{side}", ids).drop("ids")
    twice = (F.col("x") == F.col("y")) & (F.col("chunk_x") == F.col("chunk_y"))
    each = (
        met.select("ids_y", "distance", twice.alias("twice"), F.explode("ids_x").alias("a"))
        .select("a", "distance", "twice", F.explode("ids_y").alias("b"))
        .where("a < b OR NOT twice")
    )
    return lone.unionByName(each.select("a", "b", "distance"))


def similar_pairs(
    vectors: DataFrame,
    distance: float,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    tables: int = 1,
    projections: int = 0,
    width: float | None = None,
    directions: int = DIRECTIONS,
    most: int = MOST,
    seed: int = 42,
    copies: bool = False,
) -> DataFrame:
    """(id_a, id_b, distance) of all pairs of different vectors within `distance`, smaller id first.

    With `copies`, of all pairs of rows with different ids, equal vectors and rows that come twice included.

    `width` is eight distances unless given. All pairs are found if `projections` is 0; else a pair
    of different vectors is found with a chance that `expected_recall` gives.
    """
    if distance < 0 or (projections and tables < 1):
        raise ValueError("distance must not be negative, and projections need a table")
    spark = vectors.sparkSession
    reach = distance * (1 + 1e-9) + 1e-12
    width = width or 8 * reach
    rows = usable(vectors, id_column, vector_column)
    classes = _representatives(rows).withColumn("id", F.monotonically_increasing_id())
    placed = stage(_placed(classes, directions, tables, projections, width, seed), "placed-vectors")
    largest = F.array_max(F.transform("vector", F.abs))
    n_rows, dim, component = placed.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.max(largest)).head()
    # Places are sums of products and round; so much do two vectors seem farther apart at most.
    dim, component = max(dim or 0, 1), component or 0.0
    reach += 4 * (dim + 4) * float(np.finfo(float).eps) * math.sqrt(dim) * component
    held = max(most, min(HELD // (8 * dim), max(LEAST, -(-n_rows // 16))))
    path = new_folder(spark, "vector-cells")
    with run_folder(spark, "cutting"):  # what was cut on the way goes
        cells = stage_at(_cells(placed, reach, directions, held), path)
    shares = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * cells.count() // held))
    compared = (
        cells.join(placed.select("id", "vector", "class_id", "n_members"), "id")
        .repartition(shares, "cell")
        .sortWithinPartitions("cell")
    )
    kind = placed.schema["class_id"].dataType.simpleString()
    found = compared.mapInArrow(
        _search(distance, reach, directions, most, seed),
        f"x long, y long, a {kind}, b {kind}, n_x long, n_y long, distance double",
    )
    if projections and tables > 1:
        found = found.distinct()
    pairs = found
    if copies and not placed.where("n_members > 1").isEmpty():
        pairs = _expanded(stage(found, "class-pairs"), placed, rows)
    return pairs.where("a != b").select(
        F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"), "distance"
    )


def expected_recall(distance: float, width: float, tables: int, projections: int) -> float:
    """Chance that a pair so far apart meets in a table: normal lines, pieces of `width`."""
    if not projections:
        return 1.0
    t = width / distance
    phi = 0.5 * (1 + math.erf(-t / math.sqrt(2)))
    same = 1 - 2 * phi - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))
    return 1 - (1 - same**projections) ** tables
