"""Maps every document together with the one that follows it by id."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bounds(documents: DataFrame, ranges: int) -> list[int]:
    """Ids that occur, ascending, cutting the table into about equal ranges; the largest id is last."""
    shares = [i / ranges for i in range(1, ranges)]
    row = documents.agg(
        F.percentile_approx("doc_id", shares or [1.0], 10_000).alias("cuts"),
        F.max("doc_id").alias("last"),
    ).first()
    return sorted({int(x) for x in [*(row["cuts"] or []), row["last"]] if x is not None})


def map_descending(
    documents: DataFrame,
    function: Callable[[int | None, str | None, str | None], dict],
    schema: str,
    ranges: int | None = None,
) -> DataFrame:
    """`function(doc_id, text, next text)` of every row, in descending order of `doc_id`.

    The row after the last is the first. Ids are cut into ranges at ids that
    occur; the driver sees those bounds only. Texts are shuffled once, by range.
    The first row of a range is also sent to the range before it, where it
    follows the last one. Each range is sorted by Spark and read as a stream.

    Null ids come last; equal ids stand in the order of their texts. If no row
    has an id, the table is one range.
    """
    spark = documents.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = np.array(id_bounds(narrow, ranges), dtype="int64")
    n = max(len(bounds), 1)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch["doc_id"].notna().to_numpy()
            ids = batch["doc_id"].fillna(0).to_numpy(dtype="int64")
            at = np.searchsorted(bounds, ids)
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            batch["range"] = np.where(known, n - 1 - at, n - 1)
            batch["copy"] = 0
            opens = known & (bounds[np.minimum(at, n - 1)] == ids) if len(bounds) else ~known
            ahead = batch[opens].copy()
            ahead["range"] = (ahead["range"] - 1) % n
            ahead["copy"] = 1
            yield pd.concat([batch, ahead])

    def paired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: tuple | None = None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                doc_id = None if pd.isna(row.doc_id) else int(row.doc_id)
                if waiting is not None:
                    out.append(function(waiting[0], waiting[1], row.text))
                waiting = None if row.copy else (doc_id, row.text)
            yield pd.DataFrame(out, columns=names)

    names = [part.split()[0] for part in schema.split(",")]
    return (
        narrow.mapInPandas(dealt, "doc_id long, text string, range int, copy int")
        .repartition(max(1, ranges // 2), "range")
        .sortWithinPartitions("range", "copy", F.col("doc_id").desc_nulls_last(), "text")
        .mapInPandas(paired, schema)
    )
