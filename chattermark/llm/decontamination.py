"""Finds passages of a benchmark in documents, also edited ones.

A passage counts when some window of a document is within `max_edits` of the
item's length in edit distance. Candidates come from the CGK embedding: a
random walk through a text repeats or skips characters by coin flips that
depend on step and character, so texts at a small edit distance become strings
at a small Hamming distance. Bit-sampling tables over those strings put near
ones in one bin; the number of tables follows from the wanted recall. Every
candidate is then verified by exact edit distance.

Windows begin at every character but blanks, so a text without blanks or a passage
glued to other text loses none. A count filter leaves out those that can't match:
`k` edits destroy at most `q k` of the q-grams of a passage, so a window must
hold all others: of all items of its class, and of a single one around it, where
edits can have moved them. This loses nothing, and it spares nearly all windows the walk.

Items are cut in classes of similar length, so a window has a defined size. The
items go to all tasks in blocks of at most `block_chars` characters; each block
is one pass over the documents, with no shuffle. Nothing is collected but items.

Texts are compared lower-cased, with runs of white space as one blank. Defined
results: null and empty texts and items match nothing; equal items each match;
rows that repeat are rows of their own. An empty table gives an empty table; an
empty benchmark leaves every document clean. An input column named like an
output column is replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark.llm.frames import carry, restore

MATCH = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("edits", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)
GAP = 8  # zeros between documents, no fewer than the longest q-gram
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
BITS = 16
STEP = 1 << 15  # q-grams numbered at once, which a processor's cache holds


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def folded(codes: np.ndarray) -> np.ndarray:
    """One byte per character, never 0. Equal characters stay equal, so no distance grows."""
    return (codes % 255 + 1).astype("uint8")


def pattern_bits(item: str) -> dict[str, int]:
    """For each character the places in the item that hold it, as bits."""
    bits: dict[str, int] = {}
    for i, char in enumerate(item):
        bits[char] = bits.get(char, 0) | 1 << i
    return bits


def nearest(bits: dict[str, int], length: int, region: str) -> tuple[int, int]:
    """Smallest edit distance of an item to any part of the region, and where that part ends.

    Myers' bit vectors: a column of the table is two numbers with a bit per row,
    which hold where the distance grows and falls.
    """
    everything, last = (1 << length) - 1, 1 << (length - 1)
    grows, falls, edits = everything, 0, length
    best, end = length, 0
    for at, char in enumerate(region, 1):
        equal = bits.get(char, 0)
        vertical = equal | falls
        horizontal = (((equal & grows) + grows) ^ grows) | equal
        up = falls | (everything & ~(horizontal | grows))
        down = grows & horizontal
        if up & last:
            edits += 1
        elif down & last:
            edits -= 1
            if edits < best:
                best, end = edits, at
        up, down = up << 1, down << 1
        grows = (down | ~(vertical | up)) & everything
        falls = up & vertical & everything
    return best, end


class LengthClass:
    """Items of similar length, with their q-grams and their tables.

    `agreement` is the share of sampled positions that an edited passage keeps;
    with it, `tables` of `positions` bits each reach the recall.
    """

    def __init__(self, members: list[tuple[int, str]], settings: dict, seed: int) -> None:
        share = settings["max_edits"]
        self.items = [codes_of(text) for _, text in members]
        self.bits = [pattern_bits(text) for _, text in members]
        self.backward = [pattern_bits(text[::-1]) for _, text in members]
        self.ids = [item_id for item_id, _ in members]
        self.limits = [int(share * len(c)) for c in self.items]
        self.low = min(len(c) for c in self.items)
        self.high = max(len(c) for c in self.items)
        edits = int(share * self.low)
        self.q = max(1, min(8, int((0.85 * self.low + 1) / (edits + 1))))
        # The least that a matching window holds, over the lengths in the class.
        self.least = min(max(1, len(c) - self.q + 1 - self.q * k) for c, k in zip(self.items, self.limits, strict=True))
        self.span = self.high + max(self.limits)

        rng = np.random.default_rng(seed)
        steps = 2 * self.low
        chance = settings["agreement"] ** settings["positions"]
        tables = max(1, math.ceil(math.log(1 - settings["recall"]) / math.log(1 - chance)))
        walks = settings["walks"]
        self.walks = []
        for w in range(walks):
            own = tables // walks + (w < tables % walks)
            if own:
                coins = rng.integers(0, 2, (steps, 256), dtype="uint8")
                self.walks.append((coins, rng.integers(0, steps, (own, settings["positions"]))))
        buffer = np.concatenate([folded(c)[: self.low] for c in self.items])
        starts = np.arange(len(self.items)) * self.low
        self.bins = []
        for keys in self.keys(buffer, starts):
            order = np.argsort(keys, kind="stable")
            self.bins.append((keys[order], order))

    def keys(self, buffer: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        """For each table the key of every window, from one walk after the other."""
        padded = np.concatenate([buffer, np.repeat(buffer[-1:], self.low + 1)])
        for coins, tables in self.walks:
            wanted = np.unique(tables)
            place = {int(p): i for i, p in enumerate(wanted)}
            seen = np.empty((len(wanted), len(starts)), dtype="uint8")
            at, ends = starts.astype("int64"), starts + self.low
            free = self.low  # before that step no walk is at its end
            for step in range(int(wanted[-1]) + 1):
                if step == free:
                    free += self.low - int((at - starts).max(initial=0))
                if step < free:
                    char = padded.take(at)
                else:
                    char = padded.take(np.minimum(at, ends))
                    char[at >= ends] = 0
                if step in place:
                    seen[place[step]] = char
                # Widened beforehand, which is faster than an addition of unlike types.
                at += coins[step].astype("int64").take(char)
            for table in tables:
                key = np.full(len(starts), 7, dtype="uint64")
                for p in table:
                    key = (key ^ seen[place[int(p)]]) * MULTIPLIER
                    key ^= key >> np.uint64(29)
                yield key

    def index_grams(self, grams: list[np.ndarray]) -> None:
        """Keep which cells of q-grams each item has, and the first and last place of each."""
        self.cells = np.unique(np.concatenate(grams))
        self.spread = []
        for own in grams:
            cells, first = np.unique(own, return_index=True)
            self.spread.append((cells, first, len(own) - 1 - np.unique(own[::-1], return_index=True)[1]))
        self.has = np.zeros((len(grams), len(self.cells)), dtype=bool)
        for row, own in zip(self.has, grams, strict=True):
            row[np.searchsorted(self.cells, own)] = True

    def windows(self, hits: np.ndarray) -> np.ndarray:
        """The starts of windows that hold `least` of the ascending places `hits`."""
        if len(hits) < self.least:
            return np.empty(0, dtype="int64")
        width = self.span - self.q + 1
        first, last = hits[: len(hits) - self.least + 1], hits[self.least - 1 :]
        near = last - first < width
        low, high = np.maximum(last[near] - width + 1, 0), first[near]
        if not len(low):
            return low
        # Both ends ascend: what an interval shares with those before is left out.
        low[1:] = np.maximum(low[1:], high[:-1] + 1)
        sizes = high - low + 1
        return np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())

    def possible(self, starts: np.ndarray, hits: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """For each item and start whether the region around it holds enough of the item's q-grams.

        `hits` are the places of q-grams of the class, `cells` their cells. A passage in the region begins
        between `limit` before the start and three times as much behind it, and edits move its q-grams by
        `limit` more, so others don't count.
        """
        most = max(self.limits)
        before = np.searchsorted(starts, hits + most, "right") - 1
        near = (before >= 0) & (hits - starts[before] < self.high + 2 * most)
        hits, cells = hits[near], cells[near]
        ranks = np.searchsorted(self.cells, cells)
        enough = np.zeros((len(self.items), len(starts)), dtype=bool)
        for j, limit in enumerate(self.limits):
            held = self.has[j][ranks]
            length, own = len(self.items[j]), hits[held]
            needed = length - self.q + 1 - self.q * limit
            if len(own) >= needed:
                low = np.searchsorted(own, starts - limit)
                high = np.searchsorted(own, starts + (length + 2 * limit - self.q + 1))
                enough[j] = high - low >= needed
                some = np.flatnonzero(enough[j])
                if len(some):
                    enough[j, some] = self.in_place(j, own, cells[held], starts[some]) >= needed
        return enough

    def in_place(self, j: int, hits: np.ndarray, cells: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How many of an item's q-grams may lie where a passage near each start has them."""
        limit, (known, first, last) = self.limits[j], self.spread[j]
        at = np.searchsorted(known, cells)
        # Where the item would begin: of a q-gram that it repeats, anywhere between two places.
        low, high = np.sort(hits - last[at]), np.sort(hits - first[at])
        return np.searchsorted(low, starts + 4 * limit, "right") - np.searchsorted(high, starts - 2 * limit)

    def candidates(self, buffer: np.ndarray, starts: np.ndarray, enough: np.ndarray) -> set[tuple[int, int]]:
        """(start, index of an item) of windows that share a bin with an item which is `enough` there."""
        found = [np.empty(0, dtype="int64")]
        for (keys, order), own in zip(self.bins, self.keys(buffer, starts), strict=True):
            left = np.searchsorted(keys, own)
            hit = np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == own)
            if not len(hit):
                continue
            left, right = left[hit], np.searchsorted(keys, own[hit], "right")
            sizes = right - left
            at = np.repeat(hit, sizes)
            items = order[np.arange(sizes.sum()) + np.repeat(left - np.cumsum(sizes) + sizes, sizes)]
            near = enough[items, at]
            found.append(at[near] * len(self.items) + items[near])
        at, items = np.divmod(np.unique(np.concatenate(found)), len(self.items))
        return set(zip(starts[at].tolist(), items.tolist(), strict=True))


class Block:
    """Some items of a benchmark, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], settings: dict) -> None:
        ready = sorted(
            ((item_id, t) for item_id, t in ((i, normal(t)) for i, t in items) if t),
            key=lambda x: (len(x[1]), x[0]),
        )
        self.classes: list[LengthClass] = []
        group: list = []
        for member in ready:
            if group and len(member[1]) > 1.15 * len(group[0][1]):
                self.classes.append(LengthClass(group, settings, settings["seed"] + len(self.classes)))
                group = []
            group.append(member)
        if group:
            self.classes.append(LengthClass(group, settings, settings["seed"] + len(self.classes)))
        self.size = 1 << settings["cell_bits"]
        # q-grams of the items: for each q, tables in which every class has a bit of a cell.
        self.tables: list[tuple[int, np.ndarray, list[LengthClass]]] = []
        for q in sorted({c.q for c in self.classes}):
            own = [c for c in self.classes if c.q == q]
            for i in range(0, len(own), BITS):
                cells = np.zeros(self.size, dtype="uint16")
                for bit, c in enumerate(own[i : i + BITS]):
                    grams = [self.cells(folded(item), q, len(cells)) for item in c.items]
                    c.index_grams(grams)
                    c.grams = grams
                    cells[c.cells] |= np.uint16(1 << bit)
                self.tables.append((q, cells, own[i : i + BITS]))

    @staticmethod
    def cells(buffer: np.ndarray, q: int, size: int) -> np.ndarray:
        """The cell of the q-gram at every position that has one."""
        padded = np.concatenate([buffer, np.zeros(8, dtype="uint8")])
        grams = np.ndarray((max(0, len(buffer) - q + 1),), dtype="<u8", buffer=padded, strides=(1,))
        hashed = grams << np.uint64(8 * (8 - q))
        hashed *= MULTIPLIER
        hashed >>= np.uint64(64 - size.bit_length() + 1)
        return hashed.view("int64")

    def marked(self, buffer: np.ndarray, q: int, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the q-grams of the buffer that items may hold, and their cells."""
        found = [np.empty((2, 0), dtype="int64")]
        for at in range(0, len(buffer) - q + 1, STEP):
            every = self.cells(buffer[at : at + STEP + q - 1], q, len(cells))
            hits = np.flatnonzero(cells.take(every))
            found.append(np.stack([hits + at, every[hits]]))
        return tuple(np.concatenate(found, 1))

    def likely(
        self, buffer: np.ndarray, begins: np.ndarray
    ) -> Iterator[tuple[LengthClass, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each class the starts, where `begins` is true, of windows that hold enough q-grams of its items.

        Before them the places of all q-grams that items may hold, and their cells; with each start, of which
        items the region around it holds enough.
        """
        for q, cells, classes in self.tables:
            marked, places = self.marked(buffer, q, cells)
            marks = cells[places]
            for bit, c in enumerate(classes):
                own = (marks & np.uint16(1 << bit)) > 0
                hits = marked[own]
                starts = c.windows(hits)
                starts = starts[begins[starts]]
                if not len(starts):
                    continue
                enough = c.possible(starts, hits, places[own])
                some = enough.any(0)
                if some.any():
                    yield c, marked, places, starts[some], enough[:, some]

    def matches(self, texts: list[str]) -> list[list[tuple]]:
        """Per normal text the matches: (item_id, from, to, edits, similarity)."""
        found: list[list[tuple]] = [[] for _ in texts]
        codes = [codes_of(t) for t in texts]
        offsets = np.cumsum([0, *(len(c) + GAP for c in codes)])
        buffer = np.zeros(int(offsets[-1]) + 1, dtype="uint8")
        for c, at in zip(codes, offsets[:-1], strict=True):
            buffer[at : at + len(c)] = folded(c)
        blank = folded(codes_of(" "))[0]
        begins = (buffer != blank) & (buffer != 0)
        around = np.zeros(self.size, dtype=bool)
        for c, marked, places, *likely in self.likely(buffer, begins):
            done: dict[tuple[int, int], int] = {}
            for start, j in sorted(c.candidates(buffer, *likely)):
                d = int(np.searchsorted(offsets, start, "right")) - 1
                local = start - int(offsets[d])
                if local < done.get((d, j), 0):
                    continue
                limit, length = c.limits[j], len(c.items[j])
                begin = max(0, local - limit)
                stop = min(len(codes[d]), local + length + 2 * limit)
                here = int(offsets[d])
                first, last = np.searchsorted(marked, [here + begin, here + max(begin, stop - c.q + 1)])
                region = places[first:last]
                around[region] = True
                held = np.count_nonzero(around[c.grams[j]])
                around[region] = False
                if held < length - c.q + 1 - c.q * limit:
                    continue  # one q-gram over and over
                edits, end = nearest(c.bits[j], length, texts[d][begin:stop])
                if 0 < edits <= limit:
                    # The window may be off by so much that the region cuts the passage.
                    begin, stop = max(min(begin, done.get((d, j), 0)), begin - 2 * limit, 0), stop + 2 * limit
                    edits, end = nearest(c.bits[j], length, texts[d][begin:stop])
                if edits <= limit:
                    # Backwards from its end, the same search finds where the passage begins.
                    _, back = nearest(c.backward[j], length, texts[d][begin : begin + end][::-1])
                    last = begin + end
                    found[d].append((c.ids[j], last - back, last, edits, 1 - edits / length))
                    done[d, j] = last
        return found


def original_spans(text: str, matches: list[tuple]) -> list[dict]:
    """Matches as spans of whole words of the original text, in code points."""
    words = [m.span() for m in re.finditer(r"\S+", text)]
    normal_text, out = normal(text), []
    for item_id, start, end, edits, similarity in matches:
        first = normal_text.count(" ", 0, start)
        last = normal_text.count(" ", 0, max(start, end - 1))
        out.append(
            {
                "item_id": item_id,
                "start": words[first][0],
                "end": words[min(last, len(words) - 1)][1],
                "edits": edits,
                "similarity": similarity,
            }
        )
    return sorted(out, key=lambda m: (m["start"], m["item_id"]))


def item_blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items, block by block, each of `block_chars` characters or a single item."""
    block, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        if block and size + len(row["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def with_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    max_edits: float = 0.1,
    recall: float = 0.99,
    agreement: float = 0.55,
    positions: int = 5,
    walks: int = 3,
    cell_bits: int = 21,
    block_chars: int = 500_000,
    piece_chars: int = 4_000_000,
    seed: int = 42,
) -> DataFrame:
    """`documents` with `matches`: (item_id, start, end, edits, similarity) in order of start."""
    settings = {
        "max_edits": max_edits, "recall": recall, "agreement": agreement, "positions": positions,
        "walks": walks, "cell_bits": cell_bits, "seed": seed,
    }
    done = carry(documents, text=F.col("text"), matches=F.array().cast(T.ArrayType(MATCH)))
    for items in item_blocks(benchmark, block_chars):
        shared = documents.sparkSession.sparkContext.broadcast(items)
        looked_for = finder(shared, settings, piece_chars)
        done = done.withColumn("matches", F.concat("matches", looked_for("text")))
    return restore(done, matches=F.col("matches"))


def finder(shared, settings: dict, piece_chars: int):
    """A function of the text column that looks for the items of one block."""

    def looked_for(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        block = Block(shared.value, settings)
        for texts in batches:
            out: list[list[dict]] = []
            piece: list[str] = []
            size = 0
            for text in texts:
                piece.append(text or "")
                size += len(piece[-1])
                if size >= piece_chars:
                    out += matched(block, piece)
                    piece, size = [], 0
            out += matched(block, piece)
            yield pd.Series(out, dtype=object)

    # Spark would otherwise search once more for every filter on the matches that it moves below.
    return F.pandas_udf(looked_for, T.ArrayType(MATCH)).asNondeterministic()


def matched(block: Block, texts: list[str]) -> list[list[dict]]:
    if not texts:
        return []
    found = block.matches([normal(t) for t in texts])
    return [original_spans(t, m) if m else [] for t, m in zip(texts, found, strict=True)]


def contaminated(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """(doc_id, item_id, start, end, edits, similarity) of every passage found."""
    found = with_matches(documents.select("doc_id", "text"), benchmark, **settings)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(documents: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents that hold no passage of the benchmark."""
    found = with_matches(documents, benchmark, **settings)
    return found.where(F.size("matches") == 0).select(*documents.columns)
