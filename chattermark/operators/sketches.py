"""Distinct counts that add up: HyperLogLog sketches by group, united over any groups.

Exact distinct counts of a range of months have to see the rows again. A sketch of a
group is a few kilobytes whatever the group's size, and the union of sketches is the sketch of
the union: one row per month and channel is stored once, and users over any range of months, or
over all channels, come from those rows alone.

The estimate's standard error is `relative_error(lg_size)`, 1.6 % for the default. The exact paths
(`profile.activity_over_time`, `quality.check_texts`) stay the default everywhere; this one is for
tables whose months are looked at again and again.

A missing value counts as one value, as in the exact paths, and is kept as a flag beside the sketch. Groups
combine on the map side, so a hot month or channel is one sketch per task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_SIZE = 12


def relative_error(lg_size: int = LG_SIZE) -> float:
    """One standard error, as a share of the count."""
    return 1.04 / math.sqrt(1 << lg_size)


def distinct_sketches(
    df: DataFrame, keys: list[str], columns: list[str], lg_size: int = LG_SIZE
) -> DataFrame:
    """`keys`, `n_rows`, and for each column `<column>_sketch` and `<column>_missing`.

    Columns may be whole numbers, texts or binary.
    """
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for column in columns:
        measures.append(F.hll_sketch_agg(F.col(column), lg_size).alias(f"{column}_sketch"))
        measures.append(F.coalesce(F.max(F.col(column).isNull()), F.lit(False)).alias(f"{column}_missing"))
    return df.groupBy(*keys).agg(*measures)


def united_sketches(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Sketches of coarser groups, with the columns of `distinct_sketches`; they unite again."""
    measures = [F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows")]
    for column in columns:
        measures.append(F.hll_union_agg(F.col(f"{column}_sketch")).alias(f"{column}_sketch"))
        measures.append(F.coalesce(F.max(f"{column}_missing"), F.lit(False)).alias(f"{column}_missing"))
    return sketches.groupBy(*keys).agg(*measures)


def distinct_counts(sketches: DataFrame, columns: list[str]) -> DataFrame:
    """Sketches with `<column>_count`, the estimate with a missing value counted as one, in their place."""
    out = sketches
    for column in columns:
        estimate = F.hll_sketch_estimate(F.col(f"{column}_sketch")) + F.col(f"{column}_missing").cast("long")
        out = out.withColumn(f"{column}_count", estimate).drop(f"{column}_sketch", f"{column}_missing")
    return out
