"""Vectors as short codes: the index of the nearest codebook entry for each of their parts.

Components become whole numbers, `floor(4096 * x)`, and all that follows is exact:
vectors are cut into equal consecutive parts, each part position has a codebook of
16 entries that starts as that part of the vectors of the smallest ids, and rounds of
assigning parts and averaging (floors of integer means) move the entries. Nearest
entries are found by a tree over each codebook (`gnat`), which gives the same answer
as comparing with every entry.

Work and memory. A round is one pass over the vectors: tasks add up their parts by
entry, Spark adds up the tasks' sums, and the driver gets parts x entries x
components numbers, whatever the number of vectors. No vector is shuffled. The codebooks travel
with the tasks. A lost executor repeats its tasks only.

Results for unusual rows:
* a null vector, or one with a null, NaN or infinite component: the row is dropped;
* vectors of different lengths: shorter ones are filled up with zeros to the longest
  length, which is raised to a multiple of the number of parts in the same way;
* an empty vector is all zeros; if all are empty, every index and error is 0;
* null ids come last when the first vectors are chosen, rows of one id in the order of
  their vectors; equal vectors get equal codes, repeated rows stay repeated rows;
* fewer kept rows than entries: as many entries as rows; no rows: an empty result;
* errors that no long can hold are null; codes are exact for every finite component;
* other columns stay; an input column named `code` or `error` gives way.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from chattermark.llm.frames import ROW, carry, restore
from chattermark.llm.gnat import Gnat, largest_square_root, whole_numbers

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Sums travel in limbs of so many bits, so that tasks' sums never overflow a long.
LIMB = 40
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Codebooks:
    """One array of entries (entry, component) for each part, of Python's whole numbers."""

    width: int
    entries: list[np.ndarray]

    def sha256(self) -> str:
        """Digest of all components in decimal by part, entry and position, joined by commas."""
        numbers = (str(int(v)) for part in self.entries for v in part.flat)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def kept_vectors(vectors: DataFrame, vector_column: str) -> DataFrame:
    """Rows whose vector has finite components only; it stands in `vector`, the row beside it."""
    carried = carry(vectors, vector=F.col(f"`{vector_column}`").cast("array<double>"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return carried.where(F.col("vector").isNotNull() & finite)


def as_rows(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers, filled up to `width`."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    scaled = flat * float(SCALE)
    if len(flat) and not np.abs(scaled).max() < 2.0**62:
        numbers = np.array([_floor(float(v)) for v in flat], dtype=object)
    else:
        numbers = np.floor(scaled).astype("int64")
    if (lengths == width).all():
        return numbers.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=numbers.dtype)
    out[np.arange(width) < lengths[:, None]] = numbers
    return out


def _floor(value: float) -> int:
    return math.floor(value) * SCALE if abs(value) >= 2.0**53 else math.floor(value * SCALE)


class Assigner:
    """Nearest entries of all parts of a batch."""

    def __init__(self, books: Codebooks, parts: int) -> None:
        self.length = books.width // parts
        most = largest_square_root(self.length)
        self.most = most
        self.narrow = all(abs(v) <= most for part in books.entries for v in part.flat)
        wide = [Gnat(part) for part in books.entries] if not self.narrow else None
        self.wide = wide
        self.books = books
        self.trees = [Gnat(p.astype("int64")) for p in books.entries] if self.narrow else wide

    def __call__(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(part's rows, indexes, squared distances) for each part position."""
        rows = whole_numbers(rows, self.most)
        trees = self.trees
        if rows.dtype == object or not self.narrow:
            rows = rows.astype(object)
            self.wide = self.wide or [Gnat(p) for p in self.books.entries]
            trees = self.wide
        for p, tree in enumerate(trees):
            part = rows[:, p * self.length : (p + 1) * self.length]
            yield part, *tree.nearest(part)


def fit(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> Codebooks:
    """Codebooks learned from all kept vectors."""
    kept = kept_vectors(vectors, vector_column)
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    width = -(-longest // parts) * parts
    first = (
        kept.select(F.col(ROW).getField(id_column).alias("id"), "vector")
        .orderBy(F.col("id").asc_nulls_last(), "vector")
        .limit(entries)
        .collect()
    )
    start = np.zeros((len(first), width), dtype=object)
    for i, row in enumerate(first):
        start[i, : len(row["vector"])] = [_floor(v) for v in row["vector"]]
    books = Codebooks(width, np.split(start, parts, axis=1))
    for _ in range(rounds if first else 0):
        books = _moved(kept.select("vector"), books, parts)
    return books


def _moved(kept: DataFrame, books: Codebooks, parts: int) -> Codebooks:
    """Codebooks after one round: every used entry becomes the floored mean of its parts."""
    length = books.width // parts
    schema = "part int, entry int, position int, limb int, total long"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(books, parts)
        n = len(books.entries[0])
        counts = np.zeros((parts, n), dtype=object)
        totals = np.zeros((parts, n, length), dtype=object)
        for batch in batches:
            for p, (part, index, _) in enumerate(assign(as_rows(batch.column(0), books.width))):
                order = np.argsort(index, kind="stable")
                used, begin = np.unique(index[order], return_index=True)
                if len(used):
                    totals[p, used] += np.add.reduceat(part[order], begin, axis=0).astype(object)
                    counts[p, used] += np.diff(np.append(begin, len(index)))
        rows = []
        for p, e in zip(*np.nonzero(counts), strict=True):
            rows.append((p, e, -1, 0, int(counts[p, e])))
            for i, total in enumerate(totals[p, e]):
                rows += [(p, e, i, limb, value) for limb, value in limbs(int(total))]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        types = [pa.int32()] * 4 + [pa.int64()]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["part", "entry", "position", "limb", "total"])

    added: dict[tuple[int, int, int], int] = {}
    rows = kept.mapInArrow(sums, schema).groupBy("part", "entry", "position", "limb").agg(F.sum("total"))
    for p, e, i, limb, total in rows.collect():
        added[p, e, i] = added.get((p, e, i), 0) + (total << (LIMB * limb))
    moved = [part.copy() for part in books.entries]
    for (p, e, i), total in added.items():
        if i >= 0:
            moved[p][e, i] = total // added[p, e, -1]
    return Codebooks(books.width, moved)


def limbs(total: int) -> list[tuple[int, int]]:
    """A whole number as (place, limb); limbs but the last are not negative."""
    out = []
    place = 0
    while not -(1 << LIMB) <= total < 1 << LIMB:
        out.append((place, total & ((1 << LIMB) - 1)))
        total >>= LIMB
        place += 1
    return [*out, (place, total)]


def encode(
    vectors: DataFrame, books: Codebooks, vector_column: str = "embedding", parts: int = PARTS
) -> DataFrame:
    """Kept rows with `code` (two hex digits a part) and `error` (squared distances, added up)."""
    kept = kept_vectors(vectors, vector_column).select("vector", ROW)
    schema = StructType(
        [kept.schema[ROW], StructField("code", StringType()), StructField("error", LongType())]
    )

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = Assigner(books, parts)
        digits = np.array([f"{i:02x}" for i in range(max(len(books.entries[0]), 1))], dtype=object)
        for batch in batches:
            text = np.full(batch.num_rows, "", dtype=object)
            error = np.zeros(batch.num_rows, dtype=object)
            for _, index, distance in assign(as_rows(batch.column(0), books.width)):
                text = text + digits[index]
                error = error + distance.astype(object)
            whole = [int(v) if v <= LONGEST else None for v in error]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(text, pa.string()), pa.array(whole, pa.int64())],
                names=[ROW, "code", "error"],
            )

    coded = kept.mapInArrow(codes, schema)
    return restore(coded, code=F.col("code"), error=F.col("error"))


def with_group_error(coded: DataFrame, group_column: str = "label") -> DataFrame:
    """`label_error` beside every row: errors added up over equal labels, nulls together.

    Errors are combined in every task before they move, and the sums are joined back,
    so a label that holds a third of all rows is never one task's. A sum that no long
    can hold is null.
    """
    sums = coded.groupBy(F.col(group_column).alias("summed_group")).agg(
        F.try_sum("error").alias("label_error")
    )
    same = coded[group_column].eqNullSafe(sums["summed_group"])
    return coded.join(sums, same, "left").drop("summed_group")
