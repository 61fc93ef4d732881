"""Packs documents into training sequences by order-preserving dynamic programming.

A document is its token ids and one end id. Documents stand one after the other, in the
order in which the table is read, and windows of at most 1024 tokens are cut out of that
stream. A window may end after a document at no charge, after a sentence or line for
`SENTENCE`, and inside a long sentence for `WITHIN`; every window costs `WINDOW` and what it is
padded with, which is nothing if its length is a power of two. The cuts minimise the sum:

    f(j) = charge(j) + WINDOW + min( f(i) + padding(j - i) : j - 1024 <= i < j )

With full padding this is the least f(i) + i of a moving range, which a monotone queue
gives in constant time; powers of two are eleven further places to look at.

Work and memory. Nothing is shuffled: each task packs the stream of its partition, some
hundred thousand tokens at a time. The windows within the last 16 of such a stretch are
not used but decided with the next stretch, by when they no longer depend on its end. A document is cut wherever its
tokens fall, so one of any length passes through; only its own ids are held whole. A lost
executor repeats its partitions, with the same result.

Results for unusual rows:
* a null or empty text is the end id alone, a piece of one token;
* ids may be null, repeated or of any type, rows may be repeated: each row is a document of its own;
* other columns stay beside every piece; input columns named like a result give way;
* an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from chattermark.llm.frames import ROW, carry, restore
from chattermark.llm.tokens import Vocabulary, vocabulary

LENGTH = 1024
END_ID = 0
SENTENCE = 4
WITHIN = 48
WINDOW = 2
#: Inside sentences, places to cut are so many tokens apart.
GRID = 32
STRETCH = 1 << 17
LOOKAHEAD = 16
RESULT = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def padding(length: int, most: int = LENGTH) -> int:
    """What a window of `length` tokens is filled up with."""
    return 0 if length & (length - 1) == 0 else most - length


def charges(document_ends: np.ndarray, sentence_ends: np.ndarray) -> np.ndarray:
    """The charge of a cut after each token; -1 where there is none."""
    out = np.full(len(document_ends), -1, dtype="int64")
    out[sentence_ends] = SENTENCE
    out[document_ends] = 0
    marked = np.flatnonzero(out >= 0)
    last = np.zeros(len(out), dtype="int64")
    last[marked] = marked + 1
    since = np.arange(1, len(out) + 1) - np.maximum.accumulate(np.append(0, last)[:-1])
    out[(out < 0) & (since % GRID == 0)] = WITHIN
    return out


def cuts(charge: np.ndarray, most: int = LENGTH) -> list[int]:
    """Ends of the cheapest windows over a stretch, whose end is always one."""
    n = len(charge)
    at = np.flatnonzero(charge >= 0) + 1
    if not len(at) or at[-1] != n:
        at = np.append(at, n)
    prices = (np.maximum(charge[at - 1], 0) + WINDOW).tolist()
    places = [0, *at.tolist()]
    into, unpadded = _unpadded(at, n, most)
    cost = [0]
    came_from = [0]
    keys, origins = deque([0]), deque([0])  # f(i) + i, least first, and the number of its place
    seen = 0
    for k, price in enumerate(prices, 1):
        j = places[k]
        while places[origins[0]] < j - most:
            origins.popleft()
            keys.popleft()
        origin = origins[0]
        best = keys[0] + most - j
        while into[seen] == k:
            i = unpadded[seen]
            if cost[i] < best:
                best, origin = cost[i], i
            seen += 1
        best += price
        cost.append(best)
        came_from.append(origin)
        best += j
        while keys and keys[-1] >= best:
            keys.pop()
            origins.pop()
        keys.append(best)
        origins.append(k)
    ends = []
    k = len(prices)
    while k:
        ends.append(places[k])
        k = came_from[k]
    return ends[::-1]


def _unpadded(at: np.ndarray, n: int, most: int) -> tuple[list[int], list[int]]:
    """Pairs of places (into, from), by number, that lie a power of two apart; `into` ends with 0."""
    number = np.full(n + 1, -1, dtype="int64")
    number[at] = np.arange(1, len(at) + 1)
    number[0] = 0
    into, origin = [], []
    for power in (1 << k for k in range(most.bit_length()) if 1 << k <= most):
        source = at - power
        there = np.where(source >= 0, number[np.maximum(source, 0)], -1)
        into.append(np.flatnonzero(there >= 0) + 1)
        origin.append(there[there >= 0])
    targets = np.concatenate(into)
    order = np.argsort(targets, kind="stable")
    return [*targets[order].tolist(), 0], np.concatenate(origin)[order].tolist()


class Stream:
    """Documents in, windows out; each window is a list of (document, start, ids)."""

    def __init__(self, words: Vocabulary, stretch: int = STRETCH) -> None:
        self.words = words
        self.stretch = max(stretch, 2 * LOOKAHEAD * LENGTH)
        self.waiting: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, document: int, ids: np.ndarray) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Take one document's ids with its end; gives the windows that are decided by now."""
        charge = charges(np.arange(1, len(ids) + 1) == len(ids), self.words.sentence_ends(ids))
        done = 0
        while done < len(ids):
            part = slice(done, done + self.stretch - self.size)
            self.waiting.append((document, done, ids[part], charge[part]))
            self.size += len(ids[part])
            done += len(ids[part])
            if self.size >= self.stretch:
                yield from self.windows(self.size - LOOKAHEAD * LENGTH)

    def windows(self, upto: int | None = None) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Cut what waits; windows that end beyond `upto` stay waiting."""
        ends = cuts(np.concatenate([part[3] for part in self.waiting])) if self.waiting else []
        at = 0
        rest = deque(self.waiting)
        for end in ends:
            if upto is not None and end > upto:
                break
            window = []
            while at < end:
                document, start, ids, charge = rest.popleft()
                take = min(len(ids), end - at)
                window.append((document, start, ids[:take]))
                at += take
                if take < len(ids):
                    rest.appendleft((document, start + take, ids[take:], charge[take:]))
            yield window
        self.waiting = list(rest)
        self.size -= at


def pack(documents: DataFrame, tokenizer_path: str, text_column: str = "text") -> DataFrame:
    """A row per piece of a document: the document's columns, and where the piece lies.

    `ids` holds the piece's ids as little-endian unsigned 32-bit numbers, `start` the ids of its
    document before it, `doc_tokens` all ids of the document with its end id. Pieces of one `sequence_id`
    follow one another by `offset`.
    """
    carried = carry(documents, text_of_row=F.col(f"`{text_column}`").cast("string"))
    row_field = carried.schema[ROW]
    kinds = [LongType(), LongType(), BinaryType(), LongType(), LongType(), LongType()]
    results = [StructField(name, kind) for name, kind in zip(RESULT, kinds, strict=True)]
    schema = StructType([row_field, *results])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer_path)
        stream = Stream(words)
        held: dict[int, tuple[pa.Array, int, int]] = {}  # rows whose pieces are not all out
        begun = TaskContext.get().partitionId() << 33
        n_windows = n_documents = 0

        def batch_of(windows) -> pa.RecordBatch | None:
            nonlocal n_windows
            rows: list[pa.Array] = []
            columns: list[list] = [[] for _ in RESULT]
            for window in windows:
                offset = 0
                for document, start, ids in window:
                    row, total, left = held[document]
                    left -= len(ids)
                    if left:
                        held[document] = row, total, left
                    else:
                        del held[document]
                    rows.append(row)
                    values = (start, len(ids), ids.astype("<u4").tobytes(), total, begun + n_windows, offset)
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                    offset += len(ids)
                n_windows += 1
            if not rows:
                return None
            types = [pa.binary() if i == 2 else pa.int64() for i in range(len(RESULT))]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(rows), *arrays], names=[ROW, *RESULT])

        for batch in batches:
            windows = []
            whole_rows = batch.column(0)
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(words.ids(text or ""), np.uint32(END_ID))
                held[n_documents] = whole_rows.slice(i, 1), len(ids), len(ids)
                windows += stream.add(n_documents, ids)
                n_documents += 1
            out = batch_of(windows)
            if out is not None:
                yield out
        out = batch_of(stream.windows())
        if out is not None:
            yield out

    placed = carried.mapInArrow(packed, schema)
    return restore(placed, **{name: F.col(name) for name in RESULT})
