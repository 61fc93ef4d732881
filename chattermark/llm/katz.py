"""An n-gram language model with Katz backoff, counted and evaluated on all texts.

Probability of a token after its history: if the n-gram was seen, its count,
discounted after Good and Turing, over the count of the history; else the
backoff weight of the history times the probability after the shorter history.
Backoff weights are exact: what the discounted n-grams of a history leave over,
divided by what the shorter order gives to all tokens not seen after it.

Counts and weights live in tables partitioned by order and by hash of the
n-gram. Texts are read once and kept as chunks of some million tokens, in a
table bucketed by chunk. For each order a chunk sends its distinct n-grams
with its own counts, packed and sorted, to the partitions of the table; these
add up and reply with the counts of the whole corpus, in the order of the request.
Weights of histories are gathered and replied to in the same way. So a token is
never a row of a shuffle: what moves is about six bytes for each distinct n-gram
of a chunk and a byte for the reply. Tables read again by the next step are
joined to the chunks by bucket, without moving the chunks.

A hot n-gram costs one entry per chunk. Partitions grow in number with the
tokens, so the memory of a task is bounded by `part_tokens`, `chunk_tokens` and
the longest text. The driver sees counts of counts.

Details: a text is its words between white space of 0x09 to 0x0D and blanks, A
to Z lowered, then one end, a token like any other. Histories begin with a mark
for the start. Words not seen in training are one token, whose probability is
what unigrams leave over. Counts above `LARGEST` keep all but a millionth, so
every history leaves something. Words and n-grams are told apart by 64-bit hashes.

Defined results: null and empty texts are the end alone; a row without id is
scored and learned from like any other; repeated rows count each time. Without
training rows, every token has probability 1 as an unseen one. An empty table
gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chattermark.llm.packing import pack, pack_sorted, smallest, unpack, unpack_sorted
from chattermark.llm.shingles import MULTIPLIER, mixed, word_hashes
from chattermark.sources.staging import new_folder, stage

#: Counts up to this one are discounted.
LARGEST = 5
KEPT_ABOVE = 1 - 1e-6
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)

CHUNK = "chunk long, n_tokens long, ids binary, has_id binary, held_out binary, lengths binary, words binary, tokens binary"
REQUEST = "chunk long, part int, keys binary, first binary, second binary, third binary"
REPLY = "what string, chunk long, part int, keys binary, first binary, second binary, stats array<long>"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


@dataclass(frozen=True)
class Discounts:
    """Counts of all training tokens, and by order the factor for each count up to LARGEST."""

    tokens: int
    types: int
    factors: tuple[tuple[float, ...], ...] = ()

    def of(self, order: int, counts: np.ndarray) -> np.ndarray:
        table = np.array([0.0, *self.factors[order - 1], KEPT_ABOVE])
        return table[np.minimum(counts, LARGEST + 1)]


def good_turing(counts_of_counts: list[int]) -> tuple[float, ...]:
    """Discount factors of counts 1 to LARGEST, from the numbers of n-grams seen 1, 2, ... times.

    Where the estimate is no proper discount, as in small tables, half a count
    is taken off.
    """
    n = [0, *counts_of_counts]
    most = (LARGEST + 1) * n[LARGEST + 1] / n[1] if n[1] else 0.0
    out = []
    for r in range(1, LARGEST + 1):
        plain = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        factor = (plain - most) / (1 - most) if most != 1 else 0.0
        out.append(factor if 0 < factor < 1 else 1 - 0.5 / r)
    return tuple(out)


class Chunk:
    """The texts of a chunk as one sequence, each begun by START; keys of the n-grams that end at each place."""

    def __init__(self, row: pd.Series, order: int) -> None:
        lengths = unpack(row["lengths"]).astype("int64")
        words, tokens = unpack_sorted(row["words"]), unpack(row["tokens"]).astype("int64")
        self.lengths, self.order = lengths, order
        self.ids, self.has_id = unpack(row["ids"]), unpack(row["has_id"]).astype(bool)
        self.held_out = unpack(row["held_out"]).astype(bool)
        starts = np.cumsum(lengths + 1) - lengths - 1
        size = int((lengths + 1).sum())
        self.is_event = np.ones(size, dtype=bool)
        self.is_event[starts] = False
        sequence = np.full(size, START, dtype="uint64")
        sequence[self.is_event] = words[tokens]
        # Four bytes number the documents, places and n-grams of a chunk: many arrays are as long as its tokens.
        self.document = np.repeat(np.arange(len(lengths), dtype="int32"), lengths + 1)
        self.place = np.arange(size, dtype="int32")
        self.place -= starts.astype("int32")[self.document]
        self.trains = ~self.held_out[self.document]
        self.keys = [sequence]
        for m in range(2, order + 1):
            key = np.zeros(size, dtype="uint64")
            key[1:] = mixed(self.keys[-1][:-1] * MULTIPLIER + sequence[1:], m)
            self.keys.append(key)
        self.found: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def has(self, m: int) -> np.ndarray:
        """Places where an n-gram of `m` tokens ends; for one token also the starts."""
        return self.place >= m - 1

    def distinct(self, m: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct keys of an order, and for each place the index of its own."""
        if m not in self.found:
            has = self.has(m)
            keys, inverse = numbered(self.keys[m - 1][has])
            at = np.zeros(len(has), dtype="int32")
            at[has] = inverse
            self.found[m] = keys, at
        return self.found[m]

    def own_counts(self, m: int) -> np.ndarray:
        keys, at = self.distinct(m)
        use = self.has(m) & self.trains
        return np.bincount(at[use], minlength=len(keys))


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct values, and for each value its number among them, in four bytes."""
    order = np.argsort(values)
    ranked = values[order]
    new = np.ones(len(ranked), dtype=bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
    keys = ranked[new]
    del ranked
    numbers = np.empty(len(values), dtype="int32")
    numbers[order] = np.cumsum(new, dtype="int32") - np.int32(1)
    return keys, numbers


def chunks_of(documents: DataFrame, held_out: Column, chunk_tokens: int) -> DataFrame:
    """Texts as packed sequences of word numbers, some million tokens a row."""

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        serial = TaskContext.get().partitionId() << 24
        ids, held, parts, size = [], [], [], 0

        def row() -> pd.DataFrame:
            words, tokens = np.unique(np.concatenate(parts), return_inverse=True)
            known = np.array([x is not None for x in ids])
            return pd.DataFrame(
                {
                    "chunk": [serial],
                    "n_tokens": [size],
                    "ids": [pack(np.array([x or 0 for x in ids], dtype="int64"))],
                    "has_id": [pack(known.astype("uint8"))],
                    "held_out": [pack(np.array(held, dtype="uint8"))],
                    "lengths": [pack(np.array([len(p) for p in parts], dtype="int32"))],
                    "words": [pack_sorted(words)],
                    "tokens": [pack(tokens.astype("uint32"))],
                }
            )

        for batch in batches:
            words = word_hashes(batch["text"])
            for doc_id, found, out in zip(batch["doc_id"], words, batch["held_out"], strict=True):
                tokens = np.append(found, END)
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(bool(out))
                parts.append(tokens)
                size += len(tokens)
                if size >= chunk_tokens:
                    yield row()
                    ids, held, parts, size = [], [], [], 0
                    serial += 1
        if parts:
            yield row()

    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    return narrow.mapInPandas(packed, CHUNK)


def portions(keys: np.ndarray, parts: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted keys, one for each part of the key space that has some."""
    if not len(keys):
        return
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype("int64")
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        yield int(part[a]), slice(int(a), int(b))


def add_counts(rows: pd.DataFrame, order: int) -> pd.DataFrame:
    """Totals of n-gram counts in a part: replies to the chunks, the part of the table, counts of counts.

    A reply marks the n-grams the chunk owns, so that each is dealt with by one chunk.
    """
    rows = rows.sort_values("chunk")
    keys = [unpack_sorted(x) for x in rows["keys"]]
    own = [unpack(x).astype("int64") for x in rows["first"]]
    every, counts = np.concatenate(keys), np.concatenate(own)
    distinct, at = np.unique(every, return_inverse=True)
    totals = np.bincount(at, weights=counts, minlength=len(distinct)).astype("int64")
    trained = np.flatnonzero(counts)
    _, first = np.unique(every[trained], return_index=True)
    owned = np.zeros(len(every), dtype="uint8")
    owned[trained[first]] = 1
    ends = np.cumsum([len(k) for k in keys])
    table = (totals > 0) & (distinct != START if order == 1 else True)
    in_table = totals[table]
    by_count = np.bincount(np.minimum(in_table, LARGEST + 2), minlength=LARGEST + 3)
    stats = [int(in_table.sum()), len(in_table), *(int(x) for x in by_count[1 : LARGEST + 2])]
    replies = [
        ("reply", chunk, part, None, pack(smallest(totals[at[a:b]])), pack(owned[a:b]), None)
        for chunk, part, a, b in zip(rows["chunk"], rows["part"], [0, *ends[:-1]], ends, strict=True)
    ]
    model = ("model", None, rows["part"].iloc[0], pack_sorted(distinct[table]), pack(smallest(in_table)), None, stats)
    return pd.DataFrame([*replies, model], columns=[c.split()[0] for c in REPLY.split(", ")])


def counts_adder(order: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return add_counts(rows, order)

    return add


def add_weights(rows: pd.DataFrame) -> pd.DataFrame:
    """Backoff weights of the histories in a part, from the chunks' sums over n-grams they own."""
    rows = rows.sort_values("chunk")
    keys = [unpack_sorted(x) for x in rows["keys"]]
    sums = [unpack(x).reshape(2, -1) for x in rows["first"]]
    counts = np.concatenate([unpack(x).astype("int64") for x in rows["second"]])
    every = np.concatenate(keys)
    distinct, at = np.unique(every, return_inverse=True)
    taken, below = (
        np.bincount(at, weights=np.concatenate([s[i] for s in sums]), minlength=len(distinct)) for i in (0, 1)
    )
    history = np.zeros(len(distinct))
    history[at] = counts
    weights = (1 - taken / history) / (1 - below)
    ends = np.cumsum([len(k) for k in keys])
    replies = []
    for chunk, part, wanted, a, b in zip(rows["chunk"], rows["part"], rows["third"], [0, *ends[:-1]], ends, strict=True):
        mask = unpack(wanted).astype(bool)
        replies.append(("reply", chunk, part, None, pack(weights[at[a:b]][mask]), None, None))
    model = ("model", None, rows["part"].iloc[0], pack_sorted(distinct), pack(weights), None, None)
    return pd.DataFrame([*replies, model], columns=[c.split()[0] for c in REPLY.split(", ")])


class Known:
    """What a chunk knows from replies: counts and owned n-grams by order, weights of wanted histories."""

    def __init__(self, replies: pd.DataFrame) -> None:
        self.replies = replies.sort_values("part")

    def _joined(self, kind: str, column: str, empty: str) -> np.ndarray:
        rows = self.replies[self.replies["kind"] == kind][column]
        return np.concatenate([unpack(x) for x in rows]) if len(rows) else np.empty(0, empty)

    def counts(self, m: int) -> np.ndarray:
        return self._joined(f"counts{m}", "first", "int64").astype("int64")

    def owned(self, m: int) -> np.ndarray:
        return self._joined(f"counts{m}", "second", "uint8").astype(bool)

    def weights(self, m: int) -> np.ndarray:
        return self._joined(f"weights{m}", "first", "float64")


class Evaluation:
    """Counts of n-grams and histories at every place of a chunk."""

    def __init__(self, chunk: Chunk, known: Known, discounts: Discounts, orders: int) -> None:
        self.chunk, self.known, self.discounts = chunk, known, discounts
        self.count = {m: self._count(m) for m in range(1, orders + 1)}

    def _count(self, m: int) -> np.ndarray:
        """Counts at every place, in as few bytes as hold the largest."""
        out = smallest(self.known.counts(m))[self.chunk.distinct(m)[1]]
        out[~self.chunk.has(m)] = 0
        return out

    def history(self, m: int) -> np.ndarray:
        """Count of the history of the m-gram that ends at each place."""
        out = np.zeros_like(self.count[m - 1])
        out[1:] = self.count[m - 1][:-1]
        out[~(self.chunk.has(m) & self.chunk.is_event)] = 0
        return out

    def seen(self, m: int) -> np.ndarray:
        """Probability of the last token of m-grams that were seen in training, at their places."""
        count = self.count[m]
        below = self.discounts.tokens if m == 1 else np.maximum(self.history(m), 1)
        return self.discounts.of(m, count) * count / below

    def open(self, m: int) -> np.ndarray:
        """Places where order m backs off with a weight: a known history, an unseen n-gram."""
        return (self.history(m) > 0) & (self.count[m] == 0)

    def wanted(self, m: int) -> np.ndarray:
        """Which distinct histories need their weight."""
        keys, at = self.chunk.distinct(m - 1)
        mask = np.zeros(len(keys), dtype=bool)
        mask[at[np.flatnonzero(self.open(m)) - 1]] = True
        return mask


def weight_request(chunk: Chunk, known: Known, discounts: Discounts, m: int) -> tuple[np.ndarray, ...]:
    """Sums over the m-grams the chunk owns, by history: (history keys, taken, below, counts, wanted)."""
    state = Evaluation(chunk, known, discounts, m)
    _, at = chunk.distinct(m)
    keys, history_at = chunk.distinct(m - 1)
    has = chunk.has(m) & chunk.is_event
    _, first = np.unique(at[has], return_index=True)
    places = np.flatnonzero(has)[first]
    places = places[known.owned(m)[at[places]]]
    index = history_at[places - 1]
    count = state.count[m][places]
    taken = np.bincount(index, weights=discounts.of(m, count) * count, minlength=len(keys))
    below = np.bincount(index, weights=state.seen(m - 1)[places], minlength=len(keys))
    wanted = state.wanted(m)
    use = (taken > 0) | wanted
    return keys[use], taken[use], below[use], known.counts(m - 1)[use], wanted[use]


def scores_of(chunk: Chunk, known: Known, discounts: Discounts, unseen: float) -> pd.DataFrame:
    """One row per document, from the recursion over the orders at every place."""
    state = Evaluation(chunk, known, discounts, chunk.order)
    log = np.zeros(len(chunk.place))
    undecided = chunk.is_event.copy()
    for m in range(chunk.order, 1, -1):
        hit = undecided & chunk.has(m) & (state.count[m] > 0)
        log[hit] += np.log10(state.seen(m)[hit])
        undecided &= ~hit
        falls = np.flatnonzero(undecided & state.open(m))
        weights = np.zeros(len(chunk.distinct(m - 1)[0]))
        weights[state.wanted(m)] = known.weights(m)
        log[falls] += np.log10(weights[chunk.distinct(m - 1)[1][falls - 1]])
    known_word = undecided & (state.count[1] > 0)
    log[known_word] += np.log10(state.seen(1)[known_word])
    log[undecided & ~known_word] += np.log10(unseen)

    n, total = len(chunk.lengths), discounts.tokens + 0.1 * (discounts.types + 1)
    events, where = chunk.is_event, chunk.document[chunk.is_event]
    count = state.count[1][events]
    return pd.DataFrame(
        {
            "doc_id": pd.Series(chunk.ids, dtype="Int64").mask(~chunk.has_id),
            "held_out": chunk.held_out,
            "n_tokens": chunk.lengths,
            "n_known": np.bincount(where[count > 0], minlength=n),
            "train_tokens": discounts.tokens,
            "base_score": np.bincount(where, weights=np.log10((count + 0.1) / total), minlength=n),
            "score": np.bincount(where, weights=log[events], minlength=n),
        }
    )


def katz_scores(
    documents: DataFrame,
    held_out: Column,
    *,
    order: int = 2,
    chunk_tokens: int = 2_000_000,
    part_tokens: int = 2_000_000,
) -> DataFrame:
    """Scores of all `documents` (doc_id, text) under a model of those not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score, the log10 probability of the text.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = documents.sparkSession
    name = f"katz_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        chunks_of(documents, held_out, chunk_tokens)
        .write.bucketBy(buckets, "chunk")
        .option("path", new_folder(spark, name))
        .saveAsTable(name, format="parquet")
    )
    chunks = spark.table(name)
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(16, -(-tokens // part_tokens))

    replies: DataFrame | None = None
    discounts = Discounts(0, 0)
    for m in range(1, order + 1):
        request = with_replies(chunks, None, count_requests(m, parts), REQUEST)
        table = stage(answered(request, counts_adder(m)), f"katz-counts{m}")
        stats = table.where("what = 'model'").select(*[F.sum(F.col("stats")[i]) for i in range(LARGEST + 3)]).first()
        stats = [int(x or 0) for x in stats]
        n, types = (stats[0], stats[1]) if m == 1 else (discounts.tokens, discounts.types)
        discounts = Discounts(n, types, (*discounts.factors, good_turing(stats[2:])))
        if m == 1:
            unseen = unseen_mass(stats, discounts)
        replies = collected(replies, table, f"counts{m}")
    for m in range(2, order + 1):
        request = with_replies(chunks, replies, weight_requests(m, parts, discounts), REQUEST)
        table = stage(answered(request, add_weights), f"katz-weights{m}")
        replies = collected(replies, table, f"weights{m}")

    def scored(row: pd.Series, known: Known) -> pd.DataFrame:
        return scores_of(Chunk(row, order), known, discounts, unseen)

    result = stage(with_replies(chunks, replies, scored, SCORES), "katz-scores")
    spark.sql(f"DROP TABLE {name}")
    return result


def unseen_mass(stats: list[int], discounts: Discounts) -> float:
    """What the discounted unigrams leave to the unseen word."""
    if not stats[0]:
        return 1.0
    small = sum(r * n * d for r, n, d in zip(range(1, LARGEST + 1), stats[2:], discounts.factors[0], strict=False))
    large = stats[0] - sum(r * n for r, n in zip(range(1, LARGEST + 1), stats[2:], strict=False))
    return 1 - (small + KEPT_ABOVE * large) / stats[0]


def collected(replies: DataFrame | None, table: DataFrame, kind: str) -> DataFrame:
    own = table.where("what = 'reply'").select(F.lit(kind).alias("kind"), "chunk", "part", "first", "second")
    return own if replies is None else replies.union(own)


def answered(requests: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """All requests that go to one part of a table, added up together."""
    return requests.groupBy("part").applyInPandas(function, REPLY)


def with_replies(
    chunks: DataFrame,
    replies: DataFrame | None,
    function: Callable[[pd.Series, Known], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """`function` of every chunk and its replies. Only replies move: chunks are bucketed."""
    if replies is None:

        def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for _, row in batch.iterrows():
                    yield function(row, Known(pd.DataFrame({"kind": [], "part": []})))

        return chunks.mapInPandas(alone, schema)

    def together(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return function(rows.iloc[0], Known(own))

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(together, schema)


def count_requests(m: int, parts: int) -> Callable[[pd.Series, Known], pd.DataFrame]:
    def request(row: pd.Series, _: Known) -> pd.DataFrame:
        chunk = Chunk(row, m)
        keys, counts = chunk.distinct(m)[0], chunk.own_counts(m)
        return pd.DataFrame(
            [
                (row["chunk"], part, pack_sorted(keys[s]), pack(smallest(counts[s])), None, None)
                for part, s in portions(keys, parts)
            ],
            columns=[c.split()[0] for c in REQUEST.split(", ")],
        )

    return request


def weight_requests(m: int, parts: int, discounts: Discounts) -> Callable[[pd.Series, Known], pd.DataFrame]:
    def request(row: pd.Series, known: Known) -> pd.DataFrame:
        keys, taken, below, counts, wanted = weight_request(Chunk(row, m), known, discounts, m)
        return pd.DataFrame(
            [
                (
                    row["chunk"],
                    part,
                    pack_sorted(keys[s]),
                    pack(np.concatenate([taken[s], below[s]])),
                    pack(smallest(counts[s])),
                    pack(wanted[s].astype("uint8")),
                )
                for part, s in portions(keys, parts)
            ],
            columns=[c.split()[0] for c in REQUEST.split(", ")],
        )

    return request
