"""Mixes sources to target weights by Sainte-Laguë apportionment of equal blocks.

The words of all documents make `blocks` blocks of equal size. Sources get them
by the highest quotients `target / (2 i + 1)`, so quotas are whole and add up.
The method gives one seat after another, so quotas of a shard are the seats
given between two house sizes; no shard can get a negative number.

Within a source the documents stand in a seeded order, end to end, and every
block is a stretch of that line. Whole passes take the line as often as the
quota covers it; the rest of the quota is a seeded choice of blocks. A document
is taken with the words that lie in chosen blocks, so what is taken meets the
quota to within a block, whatever the lengths of documents.

No order is global and no source passes through one task: a document's place on
its line is the sum of the words in earlier buckets of the seeded digest, which
is a table of one row per (source, bucket), plus a running sum in its bucket.
Weights, targets and quotients are tables of a few rows per source.

Defined results: a null text has no words and is never taken; null sources are
one source, the last; a table without words takes nothing. Rows that repeat are
rows of their own. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chattermark.llm.frames import carry, hex_bucket, restore, seeded_order, stratum_key

HEX_DIGITS = 3
#: A prime above any number of blocks of a source, and so coprime to all of them.
STEP = 2_147_483_647
CYCLE = (5.0, 2.0, 1.0)


def word_count(text: Column) -> Column:
    """Number of maximal runs without white space of the range 0x09 to 0x0D and blanks."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = CYCLE, most: float = 3.0) -> DataFrame:
    """(stratum, source_size) with `target`: all words shared by weight, at most `most` times the size.

    What a full source can't take is shared again by weight among the others.
    That ends where one level `words per weight` fits all: sources are sorted by
    the level at which they are full, and the level follows from running sums.
    """
    order = F.row_number().over(Window.orderBy(F.col("stratum") == "n", "stratum")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    upward = Window.orderBy("full_at", "stratum")
    below = upward.rowsBetween(Window.unboundedPreceding, -1)
    onward = upward.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = (
        sizes.withColumn("weight", weight)
        .withColumn("room", F.col("source_size") * F.lit(float(most)))
        .withColumn("full_at", F.col("room") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("used", F.coalesce(F.sum("room").over(below), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("used")) / F.sum("weight").over(onward))
    )
    # The first source that its level does not fill sets the level; later ones only fall.
    fits = F.when(F.col("level") <= F.col("full_at"), F.col("level"))
    common = F.max(fits).over(everything)
    return levels.withColumn(
        "target", F.least(F.col("room"), F.coalesce(common, F.lit(0.0)) * F.col("weight"))
    ).select("stratum", "source_size", "target")


def block_words(blocks: int) -> Column:
    """Words in a block when the whole table makes `blocks` of them."""
    everything = F.sum("source_size").over(Window.partitionBy())
    return F.greatest(F.ceil(everything / blocks), F.lit(1)).cast("long")


def shard_quotas(targets: DataFrame, blocks: int, n_shards: int) -> DataFrame:
    """(stratum, shard, seats): blocks of a source in shards 0 to `shard`, by highest quotients.

    With H seats for n sources, the seats of one differ from its exact share x by
    at most x n / 2 H + 1. So the seats below that band are certain, and only the
    quotients within it, a few per source, are ranked.
    """
    house = Window.partitionBy("shard")
    n_sources = F.count("*").over(house)
    # Targets add up to all words, which are whole, while their sum is rounded.
    all_seats = F.ceil(F.sum("source_size").over(Window.partitionBy()) / F.col("block")).cast("long")
    shares = (
        targets.withColumn("block", block_words(blocks))
        .withColumn("all_seats", all_seats)
        .where(F.col("target") > 0)
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
        .withColumn("house", F.expr(f"(all_seats * (shard + 1)) div {n_shards}"))
        .withColumn("share", F.col("house") * F.col("target") / F.sum("target").over(house))
        .withColumn("slack", F.ceil(F.col("share") * n_sources / (2 * F.greatest("house", F.lit(1)))) + 2)
        .withColumn("sure", F.greatest(F.floor("share") - F.col("slack"), F.lit(0)))
        .withColumn("open_seats", F.col("house") - F.sum("sure").over(house))
    )
    last = F.ceil("share").cast("long") + F.col("slack")
    highest = house.orderBy(F.col("quotient").desc(), "stratum", "seat")
    contested = (
        shares.withColumn("seat", F.explode(F.sequence(F.col("sure"), last)))
        .withColumn("quotient", F.col("target") / (2 * F.col("seat") + 1))
        .withColumn("won", F.row_number().over(highest) <= F.col("open_seats"))
    )
    return contested.groupBy("stratum", "shard").agg(
        (F.first("sure") + F.sum(F.col("won").cast("long"))).alias("seats")
    )


def mix(
    documents: DataFrame,
    *,
    weights: tuple[float, ...] = CYCLE,
    most: int = 3,
    blocks: int = 100_000,
    n_shards: int = 8,
    identity: tuple[str, ...] = ("doc_id", "text"),
    size: str | None = None,
    seed: int = 42,
) -> DataFrame:
    """`documents` with `size`, `source_size`, `target`, `taken` and `shard_words`.

    `taken` counts the words the mix takes of the document, repeats included;
    `shard_words` splits them by shard. `weights` are dealt to the sources in
    order of code points, over and over. `size` names a column that already
    holds the number of words.
    """
    words = F.col(size).cast("long") if size else word_count(F.col("text"))
    digest = seeded_order(seed, *[F.col(c) for c in identity])
    keyed = carry(documents, stratum=stratum_key(F.col("source")), words=words, digest=digest)
    keyed = keyed.withColumn("bucket", hex_bucket(F.col("digest"), HEX_DIGITS))

    before = Window.partitionBy("stratum").orderBy("bucket")
    buckets = keyed.groupBy("stratum", "bucket").agg(F.sum("words").alias("bucket_words"))
    starts = buckets.select(
        "stratum",
        "bucket",
        F.coalesce(
            F.sum("bucket_words").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("words_before"),
    )
    sizes = buckets.groupBy("stratum").agg(F.sum("bucket_words").alias("source_size"))
    targets = source_targets(sizes, weights, most)
    seats = (
        shard_quotas(targets, blocks, n_shards)
        .groupBy("stratum")
        .agg(F.sort_array(F.collect_list(F.struct("shard", "seats"))).alias("quotas"))
    )
    plan = (
        targets.withColumn("block", block_words(blocks))
        .withColumn("n_blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
        .join(seats, "stratum", "left")
        .withColumn("shift", hex_bucket(seeded_order(seed, F.col("stratum")), 8))
        # Blocks of the line taken up to each shard, over all passes; the last block may be short.
        .withColumn(
            "until",
            F.expr(
                f"""transform(quotas, q -> least({most} * n_blocks,
                    cast(round(q.seats * block * n_blocks / source_size) as bigint)))"""
            ),
        )
        .drop("quotas")
    )
    starts = starts.join(plan, "stratum")

    run = Window.partitionBy("stratum", "bucket").orderBy("digest")
    placed = (
        keyed.withColumn(
            "ahead",
            F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            - F.col("words"),
        )
        .join(starts, ["stratum", "bucket"])
        .withColumn("line_start", F.col("words_before") + F.col("ahead"))
        .withColumn("line_end", F.col("line_start") + F.col("words"))
    )
    # A block's turn is its place in the seeded order; pass p takes it as number p * n_blocks + turn.
    turn = f"pmod(j * {STEP} + shift, n_blocks)"
    stretch = "(least(line_end, (j + 1) * block) - greatest(line_start, j * block))"
    passes = f"greatest(0, ceil((u - {turn}) / n_blocks))"
    upto = f"""transform(until, u -> aggregate(
        sequence(line_start div block, (line_end - 1) div block), 0L,
        (s, j) -> s + cast({stretch} * {passes} as bigint)))"""
    placed = placed.withColumn(
        "upto", F.when((F.col("words") > 0) & F.col("until").isNotNull(), F.expr(upto))
    )
    none = F.array_repeat(F.lit(0).cast("long"), n_shards)
    by_shard = F.expr("transform(upto, (x, i) -> x - if(i = 0, 0L, upto[i - 1]))")
    return restore(
        placed,
        size=F.col("words"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        taken=F.coalesce(F.element_at("upto", -1), F.lit(0).cast("long")),
        shard_words=F.coalesce(by_shard, none),
    )
