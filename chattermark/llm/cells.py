"""Counts in an array of fixed size, gathered from all tasks.

Tasks send their arrays in packed blocks, Spark adds those up block by block,
and the driver gets one array, whose size does not depend on the data.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

BLOCK = 1 << 14
SCHEMA = "block int, counts binary"


def packed_blocks(counts: np.ndarray) -> pd.DataFrame:
    """The blocks of an array that are not all zero."""
    blocks = counts.astype("int64", copy=False).reshape(-1, min(BLOCK, len(counts)))
    used = np.flatnonzero(blocks.any(1))
    return pd.DataFrame({"block": used, "counts": [zlib.compress(blocks[i].tobytes(), 1) for i in used]})


def added(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = None
    for batch in batches:
        for packed in batch["counts"]:
            counts = np.frombuffer(zlib.decompress(packed), dtype="int64")
            total = counts.copy() if total is None else total + counts
    yield pd.DataFrame({"block": [key[0]], "counts": [zlib.compress(total.tobytes(), 1)]})


def gathered(rows: DataFrame, size: int) -> np.ndarray:
    """The sum of all tasks' arrays of `size` cells, from rows of (block, counts)."""
    out = np.zeros(size, dtype="int64").reshape(-1, min(BLOCK, size))
    for row in rows.groupBy("block").applyInPandas(added, SCHEMA).collect():
        out[row["block"]] = np.frombuffer(zlib.decompress(row["counts"]), dtype="int64")
    return out.reshape(-1)
