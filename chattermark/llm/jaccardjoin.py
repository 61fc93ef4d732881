"""Groups documents whose sets of word shingles have a high Jaccard similarity.

Exact, by prefix filters under several global orders of the shingles. If two
sets are similar enough, then under any order the first few shingles of each,
a number that follows from the set's size, have one in common. So a pair has to
share a prefix shingle under every order; only pairs that do are compared.

The first order puts rare shingles first. Any order is valid, so rarity may be
approximate: shingles are counted in 2 ** `sketch_bits` cells, an array of fixed
size. A passage that many documents share fills its cells and goes to the end
of the order, out of nearly all prefixes. The other orders are seeded scrambles.

Before sets are sent, pairs are held against a bound on what tells them apart. The parity
of a set says for each of about as many cells as it has shingles whether their number in the
cell is odd. Parities differ in no more cells than sets differ in shingles, so a
pair whose parities differ too much is not similar, and nearly all other pairs are.

Large groups of near copies are not expanded into pairs. Documents with equal
sets are one node. In each bucket, the nodes that share a prefix shingle, the
first and the last are hubs; every node is compared with the hub it shares most buckets
with, which is linear. Nodes that are linked so become components. Then every node is
compared with the nearest one by parity from another component; in a bucket of more than `BLOCK` nodes,
those outside the largest component are compared with a few of its members instead. Buckets that
then still hold several components are compared by parity, every node outside the
largest component with all nodes of other ones, block by block where they are many.
These comparisons take place in the tasks, from one row per node of a bucket; rows of
pairs are only those whose sets have to be compared. Pairs within a component need no
comparison, as they can't change it. No bucket is cut.

Exactness rests on 64-bit hashes of shingles and of whole sets.

Defined results: null and empty texts have no shingles, are linked with nothing
and are their own component. Rows that repeat an id are rows of their own. A row
without id takes part; the component of rows that all lack an id is null. An
empty table gives an empty table. Input columns named like an output column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chattermark.llm import cells
from chattermark.llm.components import components
from chattermark.llm.frames import carry, restore
from chattermark.llm.shingles import mixed, shingle_sets
from chattermark.sources.staging import stage

#: Seeds of the scrambled orders that candidates must pass besides the first.
OTHER_ORDERS = (1, 2)
PARITY_SEED = 3
#: Cells of a parity, as powers of two; larger ones tell longer sets apart.
FEWEST_CELLS, MOST_CELLS = 6, 16
#: Members of a component that an outsider is compared with.
HUBS = 4
#: Nodes that are compared by parity with all nodes of a block of theirs.
BLOCK, ACROSS = 1000, 4000
#: Rows of a task that compares by parity, shares of them held at once, and bytes of parities side by side.
NEAR_ROWS, NEAR_SHARES, NEAR_BYTES = 100_000, 8, 1 << 20
#: Sets compared with a hub in one task.
MEMBERS = 500
#: Rows of which a task holds texts and sets at once.
ROWS = 500
COLUMNS = ["doc_id", "n_shingles", "node", "parity", "block", "counts"]


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of `n` of which a similar set must hold one, under any order."""
    return n - (percent * n + 99) // 100 + 1


def can_differ(n: int, percent: int) -> bool:
    """Whether a set of `n` can be similar to another one than itself."""
    return 100 * n >= percent * (n + 1) or 100 * (n - 1) >= percent * n


def node_of(shingles: np.ndarray) -> int:
    """A signed 64-bit name of the set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype("int64")))


def document_sets(documents: DataFrame, k: int, percent: int, bits: int) -> DataFrame:
    """One pass: (doc_id, n_shingles, node, parity) of every row, and (block, counts) of each task.

    The node is null for an empty set. Rows with a block hold what the
    task counted in 2 ** `bits` cells, and no document.
    """

    def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, dtype="int64")
        for batch in batches:
            sizes, nodes, parities = [], [], []
            for shingles in shingle_sets(batch["text"], k):
                sizes.append(len(shingles))
                parities.append(parity(shingles, percent))
                nodes.append(node_of(shingles) if len(shingles) else None)
                # A set may fall into a cell more than once.
                np.add.at(total, (shingles >> np.uint64(64 - bits)).view("int64"), 1)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_shingles": sizes,
                    "node": pd.array(nodes, dtype="Int64"),
                    "parity": parities,
                    "block": pd.array([None] * len(sizes), dtype="Int32"),
                    "counts": None,
                }
            )
        counts = cells.packed_blocks(total)
        yield counts.assign(doc_id=None, n_shingles=None, node=None, parity=None)[COLUMNS]

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInPandas(named, f"doc_id long, n_shingles long, node long, parity binary, {cells.SCHEMA}")


def prefixes(documents: DataFrame, k: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(token, node): the prefix of each set under the order by rarity.

    A task gives a set once, so copies within its rows cost nothing more.
    """
    shared = documents.sparkSession.sparkContext.broadcast(counts.astype("int32"))
    shift = np.uint64(64 - int(len(counts)).bit_length() + 1)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, given = shared.value, set()
        for batch in batches:
            tokens, nodes = [], []
            for found in shingle_sets(batch["text"], k):
                n = len(found)
                if not can_differ(n, percent):
                    continue
                node = node_of(found)
                if node in given:
                    continue
                if len(given) < 1_000_000:
                    given.add(node)
                order = np.lexsort((found, counts[(found >> shift).astype("int64")]))
                tokens.append(found[order[: prefix_length(n, percent)]])
                nodes.append(node)
            if tokens:
                each = [len(t) for t in tokens]
                yield pd.DataFrame(
                    {
                        "token": np.concatenate(tokens).view("int64"),
                        "node": np.repeat(np.array(nodes, dtype="int64"), each),
                    }
                )

    return documents.select("text").mapInPandas(cut, "token long, node long")


def led_pairs(buckets: DataFrame) -> DataFrame:
    """(hub, node): every node with the one it shares most buckets with, of their first and last nodes."""
    return (
        buckets.select("node", F.explode(F.array("low", "high")).alias("hub"))
        .where("node <> hub")
        .groupBy("node", "hub")
        .agg(F.count("*").alias("times"))
        .groupBy("node")
        .agg(F.max_by("hub", F.struct("times", "hub")).alias("hub"))
        .select("hub", "node")
    )


def prefix_under(shingles: np.ndarray, percent: int, seed: int) -> np.ndarray:
    """The set's prefix under the scrambled order of `seed`, as scrambled shingles."""
    p = prefix_length(len(shingles), percent)
    order = mixed(shingles, seed)
    return np.partition(order, p - 1)[:p] if p < len(order) else order


def parity(shingles: np.ndarray, percent: int) -> bytes | None:
    """Bits of the cells that hold an odd number of shingles; none where only an equal set is similar.

    A parity of half as many cells is its first half xor its second.
    """
    if not can_differ(len(shingles), percent):
        return None
    size = 1 << min(max((len(shingles) - 1).bit_length(), FEWEST_CELLS), MOST_CELLS)
    held = np.bincount((mixed(shingles, PARITY_SEED) & np.uint64(size - 1)).view("int64"), minlength=size)
    return np.packbits((held & 1).astype("uint8")).tobytes()


class Parities:
    """The parities of sets of `sizes` shingles, to be compared by number."""

    def __init__(self, packed: list[bytes], sizes: np.ndarray, percent: int) -> None:
        self.packed, self.sizes, self.percent = packed, sizes.astype("int64"), percent
        self.widths = np.array([len(x) for x in packed], dtype="int64")
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def table(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Parities of a width and, halved, of twice the width; and where each lies in the table."""
        if width not in self.tables:
            own, wide = np.flatnonzero(self.widths == width), np.flatnonzero(self.widths == 2 * width)
            halves = self._rows(wide, 2 * width).reshape(len(wide), 2, width // 8)
            place = np.zeros(len(self.packed), dtype="int64")
            place[np.append(own, wide)] = np.arange(len(own) + len(wide))
            self.tables[width] = np.concatenate([self._rows(own, width), halves[:, 0] ^ halves[:, 1]]), place
        return self.tables[width]

    def _rows(self, at: np.ndarray, width: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.packed[i] for i in at), dtype="uint64").reshape(len(at), width // 8)

    def apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The cells in which the parities of each pair differ; -1 where the sets can't be similar."""
        first, second = self.sizes[left], self.sizes[right]
        total = first + second
        most = total - 2 * -(-self.percent * total // (100 + self.percent))
        out = np.full(len(left), -1, dtype="int64")
        # Similar sets have sizes less than twice one another, so widths are equal or one is twice the other.
        fit = 100 * np.minimum(first, second) >= self.percent * np.maximum(first, second)
        widths = np.minimum(self.widths[left], self.widths[right])
        for width in np.unique(widths[fit]).tolist():
            rows, place = self.table(width)
            at = np.flatnonzero(fit & (widths == width))
            step = max(1, NEAR_BYTES // width)
            for some in (at[i : i + step] for i in range(0, len(at), step)):
                differ = np.bitwise_count(rows[place[left[some]]] ^ rows[place[right[some]]]).sum(1, dtype="int64")
                out[some] = np.where(differ <= most[some], differ, -1)
        return out


def share_prefix(left: np.ndarray, right: np.ndarray, percent: int, seed: int) -> bool:
    """Whether two sets share a prefix shingle under the scrambled order of `seed`."""
    first, second = (prefix_under(x, percent, seed) for x in (left, right))
    return len(np.intersect1d(first, second, assume_unique=True)) > 0


def with_parity(rows: DataFrame, nodes: DataFrame, column: str = "node", suffix: str = "") -> DataFrame:
    """Rows with the size and parity of a node; nodes that are similar to equal sets alone have none."""
    known = nodes.where("parity is not null").groupBy(F.col("node").alias(column)).agg(
        F.first("n_shingles").alias(f"n{suffix}"), F.first("parity").alias(f"parity{suffix}")
    )
    return rows.join(known, column)


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, node) whose sizes and parities allow that they are similar."""

    @F.pandas_udf("boolean")
    def near(n_hub: pd.Series, n_node: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        sizes = np.concatenate([n_hub.to_numpy(), n_node.to_numpy()])
        at = np.arange(len(left))
        return pd.Series(Parities([*left, *right], sizes, percent).apart(at, at + len(left)) >= 0)

    left = with_parity(pairs, nodes, "hub", "_hub")
    both = with_parity(left, nodes, "node", "_node")
    return both.where(near("n_hub", "n_node", "parity_hub", "parity_node")).select("hub", "node")


def near_in_cells(percent: int, nearest: bool):
    """A function of rows (cell, node, component, leads, n, parity): (hub, node, apart) of pairs in one cell.

    Of a pair one must lead, and the components differ. With `nearest`, each node comes with its nearest one.
    """

    def near(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("cell")
        number, found = pd.factorize(rows["node"].to_numpy())
        known = rows.iloc[np.unique(number, return_index=True)[1]]
        parities = Parities(list(known["parity"]), known["n"].to_numpy(), percent)
        component, leads = rows["component"].to_numpy(), rows["leads"].to_numpy(dtype=bool)
        cell = rows["cell"].to_numpy()
        after = np.searchsorted(cell, cell, "right") - 1 - np.arange(len(cell))
        out = [np.empty((2, 0), dtype="int64")]
        at, distance = np.arange(len(cell)), 0
        while True:
            distance += 1
            at = at[after[at] >= distance]
            if not len(at):
                break
            differ = component[at] != component[at + distance]
            i = at[differ & (leads[at] | leads[at + distance])]
            left, right = number[i], number[i + distance]
            apart = parities.apart(left, right)
            kept = apart >= 0
            left, right = left[kept], right[kept]
            # A pair as one number, the smaller one first.
            out.append(np.stack([np.minimum(left, right) * len(found) + np.maximum(left, right), apart[kept]]))
        pairs, apart = np.concatenate(out, 1)
        pairs, first = np.unique(pairs, return_index=True)
        apart = apart[first]
        hub, node = np.divmod(pairs, max(1, len(found)))
        if nearest:
            hub, node, apart = np.append(hub, node), np.append(node, hub), np.append(apart, apart)
            order = np.lexsort((hub, apart, node))
            order = order[np.diff(node[order], prepend=-1) != 0]
            hub, node, apart = hub[order], node[order], apart[order]
        return pd.DataFrame({"hub": found[hub], "node": found[node], "apart": apart})

    return near


def near_pairs(opened: DataFrame, nodes: DataFrame, percent: int, nearest: bool = False) -> DataFrame:
    """Distinct (hub, node) from different components of a bucket whose sizes and parities allow that they are similar.

    A bucket of more than `BLOCK` nodes is a cell for each block of those outside its largest
    component and each block of all its nodes. With `nearest`, such buckets are left out, and every node
    comes once, with the nearest.
    """
    plain = ("node", "component")
    small = opened.where(F.col("nodes") <= BLOCK).select(
        F.xxhash64("token").alias("cell"), *plain, F.lit(True).alias("leads")
    )
    if not nearest:
        large = opened.where(F.col("nodes") > BLOCK).select(
            "*",
            F.ceil(F.col("outside") / BLOCK).alias("blocks"),
            F.ceil(F.col("nodes") / ACROSS).alias("others"),
        )

        def cell(rows: DataFrame, block, other, leads: bool) -> DataFrame:
            dealt = rows.withColumn("block", block).withColumn("other", other)
            return dealt.select(F.xxhash64("token", "block", "other").alias("cell"), *plain, F.lit(leads).alias("leads"))

        def every(count: str):
            return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

        def one(count: str, seed: int):
            return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(count))

        small = small.union(
            cell(large.where("component <> largest"), one("blocks", 1), every("others"), True)
        ).union(cell(large, every("blocks"), one("others", 2), False))
    rows = stage(small, "cells")
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // NEAR_ROWS))
    dealt = (
        with_parity(rows, nodes)
        .withColumn("share", F.pmod("cell", F.lit(tasks * NEAR_SHARES)))
        .repartition(tasks, "share")
        .groupBy("share")
        .applyInPandas(near_in_cells(percent, nearest), "hub long, node long, apart long")
    )
    if nearest:
        dealt = dealt.groupBy("node").agg(F.min_by("hub", F.struct("apart", "hub")).alias("hub"))
    return dealt.select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node")).distinct()


def similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    """The other orders' filters, then the exact comparison."""
    if not all(share_prefix(left, right, percent, seed) for seed in OTHER_ORDERS):
        return False
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= percent * (len(left) + len(right) - common)


def may_be_among(rows: DataFrame, keys: DataFrame, bits: int) -> DataFrame:
    """`rows` without most of those whose key is not in `keys`; both have a `key`, which is never null.

    A row stays if its cell of 2 ** `bits` holds a key. The cells, 64 to a number, are a table of fixed size; full, it filters nothing.
    """

    def placed(frame: DataFrame) -> DataFrame:
        cell = F.pmod(F.xxhash64("key"), F.lit(1 << bits))
        return frame.withColumn("word", F.floor(cell / 64)).withColumn("place", F.pmod(cell, F.lit(64)).cast("int"))

    held = placed(keys.select("key")).groupBy("word").agg(F.expr("bit_or(shiftleft(1L, place))").alias("held"))
    found = placed(rows).join(F.broadcast(held), "word").where(F.getbit("held", "place") == 1)
    return found.select(*rows.columns)


def with_sets(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows of (node, text, ...) with the shingles in place of the text, where it makes that node."""
    texts = rows["text"].drop_duplicates()
    made = {t: (node_of(s), s.tobytes()) if len(s) else (0, b"") for t, s in zip(texts, shingle_sets(texts, k), strict=True)}
    got = [made[text] for text in rows["text"]]
    # Another row of the same id may hold another text.
    right = [a == b for (a, _), b in zip(got, rows["node"], strict=True)]
    return rows.drop(columns="text").assign(shingles=[s for _, s in got])[right]


def verified(
    pairs: DataFrame, documents: DataFrame, nodes: DataFrame, *, k: int, percent: int, filter_bits: int = 20
) -> DataFrame:
    """The pairs (hub, node) whose sets are similar, as (a, b).

    Sets are made again from one document of each node, and those to be compared
    with a hub are sent to it, in portions of `MEMBERS`, each with the hub's set.
    Texts that are not wanted are left out by a filter of fixed size before the
    shuffle, and by the join behind it. The filter is no Python, as a task holds a
    worker for each of the Python operators it chains, and executors keep them.
    """
    pairs = stage(pairs, "pairs")
    portions = pairs.groupBy("hub").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("portions"))
    members = pairs.join(portions, "hub").select(
        "hub", "node", F.expr("cast(pmod(xxhash64(node), portions) as int)").alias("portion"), F.lit(0).alias("leads")
    )
    hubs = portions.select(
        "hub",
        F.col("hub").alias("node"),
        F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"),
        F.lit(1).alias("leads"),
    )
    no_id = F.lit(-(2**63))
    first = nodes.groupBy("node").agg(F.coalesce(F.min("doc_id"), no_id).alias("key"))
    wanted = stage(members.union(hubs).join(first, "node"), "wanted")

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                yield with_sets(batch.iloc[first : first + ROWS], k)

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, "uint64") for x in rows["shingles"]]
        leads = np.flatnonzero(rows["leads"].to_numpy())
        hub = sets[leads[0]] if len(leads) else np.empty(0, "uint64")
        holds = [len(hub) > 0 and not lead and similar(hub, s, percent) for s, lead in zip(sets, rows["leads"], strict=True)]
        return rows.loc[holds, ["hub", "node"]].rename(columns={"hub": "a", "node": "b"})

    texts = documents.select(F.coalesce(F.col("doc_id").cast("long"), no_id).alias("key"), "text")
    return (
        may_be_among(texts, wanted, filter_bits)
        .join(wanted, "key")
        .select("hub", "node", "portion", "leads", "text")
        .mapInPandas(made, "hub long, node long, portion int, leads int, shingles binary")
        .groupBy("hub", "portion")
        .applyInPandas(compared, "a long, b long")
    )


def star(label: DataFrame) -> DataFrame:
    """Links (a, b) that hold the components of `label` together."""
    return label.select(F.col("node").alias("a"), F.col("component").alias("b"))


def open_buckets(buckets: DataFrame, label: DataFrame) -> DataFrame:
    """(token, node, component, largest, nodes, outside) of buckets with several components.

    A node without links is its own component; `largest` is the component of the
    bucket that has the most nodes in all. `nodes` counts all of the bucket, `outside` those of other components.
    """
    sizes = label.groupBy("component").agg(F.count("*").alias("size"))
    placed = buckets.select("token", "node").distinct().join(label.join(sizes, "component"), "node", "left").select(
        "token",
        "node",
        F.coalesce("component", "node").alias("component"),
        F.coalesce("size", F.lit(1)).alias("size"),
    )
    several = (
        placed.groupBy("token", "component")
        .agg(F.max("size").alias("size"), F.count("*").alias("here"))
        .groupBy("token")
        .agg(
            F.count("*").alias("components"),
            F.max(F.struct("size", "component", "here")).alias("most"),
            F.sum("here").alias("nodes"),
        )
        .where("components > 1")
        .select("token", F.col("most.component").alias("largest"), "nodes", F.expr("nodes - most.here").alias("outside"))
    )
    return placed.join(several, "token").select("token", "node", "component", "largest", "nodes", "outside")


def outsiders(opened: DataFrame) -> DataFrame:
    """(hub, node): nodes outside a bucket's largest component, with some members of it.

    `HUBS` pairs for every such node at most, however many buckets it is in and however large they are.
    """
    picked = [F.min_by("node", F.xxhash64("node", F.lit(i))) for i in range(HUBS)]
    members = opened.where("component = largest").groupBy("token").agg(F.array_distinct(F.array(*picked)).alias("hubs"))
    return (
        opened.where("component <> largest")
        .join(members, "token")
        .select(F.explode("hubs").alias("hub"), "node")
        .groupBy("node", "hub")
        .agg(F.count("*").alias("times"))
        .groupBy("node")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("times", "hub")), False), 1, HUBS).alias("hubs"))
        .select(F.explode("hubs.hub").alias("hub"), "node")
    )


def similar_groups(
    documents: DataFrame, *, k: int = 4, percent: int = 85, sketch_bits: int = 20
) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) of every row.

    Two documents are linked when 100 x common >= `percent` x union; the component
    is named by its smallest doc_id.
    """
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    made = stage(document_sets(documents, k, percent, sketch_bits), "shingle-sets")
    every = made.where("block is null")
    nodes, named = every.select("doc_id", "n_shingles", "node"), every.where("node is not null")
    counts = cells.gathered(made.where("block is not null").select("block", "counts"), 1 << sketch_bits)

    by_token = Window.partitionBy("token")
    buckets = (
        prefixes(documents, k, percent, counts)
        .withColumn("low", F.min("node").over(by_token))
        .withColumn("high", F.max("node").over(by_token))
        .where("low <> high")
    )
    buckets = stage(buckets, "buckets")
    checked = {"documents": documents, "nodes": named, "k": k, "percent": percent}
    # Every node is compared with one hub first; in a group of near copies that links many.
    hubs = stage(likely(led_pairs(buckets), named, percent), "hubs")
    first = stage(verified(hubs, **checked), "similar")
    label = components(first)

    # Then with its nearest one of another component, or with a few of the largest one's members.
    opened = stage(open_buckets(buckets, label), "open-buckets")
    led = likely(outsiders(opened.where(F.col("nodes") > BLOCK)), named, percent)
    near = stage(near_pairs(opened, named, percent, nearest=True), "near-pairs")
    pairs = stage(led.union(near).distinct().join(hubs, ["hub", "node"], "left_anti"), "pairs")
    more = stage(verified(pairs, **checked), "similar")
    label = components(star(label).union(more))
    done = hubs.union(pairs).select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node"))

    still_open = stage(open_buckets(buckets, label), "open-buckets")
    # Where all nodes of a bucket were compared, those without a near one have no pair to come.
    again = near.select("node").union(near.select("hub")).distinct()
    in_small = still_open.where(F.col("nodes") <= BLOCK).join(again, "node", "left_semi")
    still_open = still_open.where(F.col("nodes") > BLOCK).unionByName(in_small)
    rest = near_pairs(still_open, named, percent).join(done, ["hub", "node"], "left_anti")
    second = stage(verified(rest, **checked), "similar")
    of_node = components(star(label).union(second))
    rows = nodes.join(of_node, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = rows.where("node is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return rows.join(smallest, "component", "left").select(
        "doc_id",
        "n_shingles",
        "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(documents: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """`documents` with one row of each group of similar ones, that of the smallest id.

    Documents without words are no group and all stay.
    """
    groups = similar_groups(documents, k=k, percent=percent)
    no_id = F.lit(-(2**63))
    stays = groups.where((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    # One text per id and group; rows that repeat an id but are no copies stay apart by node.
    stays = stays.select(F.coalesce("doc_id", no_id).alias("key"), "node").distinct()

    @F.pandas_udf("long")
    def node(texts: pd.Series) -> pd.Series:
        return pd.Series([node_of(s) if len(s) else None for s in shingle_sets(texts, k)], dtype="Int64")

    rows = carry(documents, key=F.coalesce(F.col("doc_id").cast("long"), no_id), node=node("text"))
    same = Window.partitionBy("key", "node").orderBy("key")
    marked = rows.join(stays.withColumn("stays", F.lit(True)), ["key", "node"], "left").withColumn(
        "copy", F.row_number().over(same)
    )
    return restore(marked.where("node is null or (stays and copy = 1)"))
