"""Shards that all hold the mixture of the whole table: stratified interleaving.

Rows of a source are put in a seeded random order and get the fractional rank
`(rank - 1 + phase) / rows of the source`. The phase is `(2 j + 1) / (2 S)` for
source j of S in sorted order, so that sources of one size take turns and do
not all step over a cut together. Sorted by it, every stretch of the table
holds each source in its share, so the sorted table is cut into runs whose row
counts differ by one at most.

Both orders are global, and neither passes through one task. Ranks come from
counts of (source, leading digits of the seeded digest), so a source that
holds a third of the rows is ranked in thousands of windows. Positions come
from intervals of the fractional rank, whose sizes follow from the source
counts alone. The running sums see one row per source and bucket, and the
numbering of sources one row per source, in one task: sources should be some ten thousand
at most, and sources times rows below 10**15.

Defined results: null sources are a stratum of their own, apart from the empty
string. Rows equal in the identity columns (a null there counts as empty) are
interchangeable; all are kept. An empty table gives an empty table. Input
columns named like an output column are replaced, all others are carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chattermark.llm.frames import ROW, carry, hex_bucket, restore, seeded_order, stratum_key

HEX_DIGITS = 3


def interleave(
    rows: DataFrame,
    n_shards: int = 8,
    *,
    source: str = "source",
    identity: tuple[str, ...] = ("doc_id", "text"),
    seed: int = 42,
    stretches: int = 4096,
) -> DataFrame:
    """`rows` with `shard` (from 0) and `slot`, the place in the shard (from 0).

    `stretches` is the number of intervals of the fractional rank that are
    sorted apart from one another.
    """
    if n_shards < 1 or stretches < 1:
        raise ValueError("n_shards and stretches must be at least 1")
    digest = seeded_order(seed, *[F.col(c) for c in identity])
    keyed = carry(rows, stratum=stratum_key(F.col(source)), digest=digest)
    keyed = keyed.withColumn("bucket", hex_bucket(F.col("digest"), HEX_DIGITS))

    by_source = Window.partitionBy("stratum")
    before = by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        keyed.groupBy("stratum", "bucket")
        .agg(F.count("*").alias("rows"))
        .select(
            "stratum",
            "bucket",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ranks_before"),
            F.sum("rows").over(by_source).alias("source_rows"),
        )
    )
    all_sources = Window.orderBy("stratum")
    sources = keyed.groupBy("stratum").agg(F.count("*").alias("n")).select(
        "stratum",
        "n",
        (2 * F.row_number().over(all_sources) - 1).cast("long").alias("phase"),
        (2 * F.count("*").over(Window.partitionBy())).alias("turns"),
    )
    counts = counts.join(sources.select("stratum", "phase", "turns"), "stratum")
    in_bucket = Window.partitionBy("stratum", "bucket").orderBy("digest")
    ranked = (
        keyed.withColumn("place", F.row_number().over(in_bucket))
        .join(counts, ["stratum", "bucket"])
        .withColumn("turn", F.expr("turns * (ranks_before + place - 1) + phase"))
        .withColumn("fraction", F.col("turn") / (F.col("turns") * F.col("source_rows")))
        .withColumn("stretch", F.expr(f"(turn * {stretches}) div (turns * source_rows)"))
        .select(ROW, "digest", "stratum", "fraction", "stretch")
    )

    # Ranks of a source below stretch b: those with turn * stretches < turns * b * source_rows.
    room = f"turns * n * stretch - phase * {stretches}"
    starts = (
        sources
        .withColumn("stretch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stretches - 1).cast("long"))))
        .withColumn("below", F.expr(f"greatest(0, ({room} + turns * {stretches} - 1) div (turns * {stretches}))"))
        .groupBy("stretch")
        .agg(F.sum("below").alias("positions_before"), F.sum("n").alias("total"))
    )
    in_stretch = Window.partitionBy("stretch").orderBy("fraction", "digest", "stratum")
    placed = (
        ranked.withColumn("place", F.row_number().over(in_stretch))
        .join(starts, "stretch")
        .withColumn("position", F.col("positions_before") + F.col("place") - 1)
        .withColumn("shard", F.expr(f"((position + 1) * {n_shards} - 1) div total"))
        .withColumn("slot", F.expr(f"position - (shard * total) div {n_shards}"))
    )
    return restore(placed, shard=F.col("shard").cast("int"), slot=F.col("slot"))
