"""Removes lines that several documents share.

Lines are compared by key: white space stripped at both ends, A to Z lowered.
A key that is long enough and stands in enough documents loses all its lines
but those in the document with the largest id. Three steps, each a plain
Spark job: explode the keys to (document, 128-bit hash) and stage them; count
documents per hash; give every document the hashes it has to drop, and
reassemble its other lines by position.

The text is read twice and shuffled once, for the last join. What is counted
is one narrow row per document and key, combined on the map side, so a line of
a third of all documents arrives as one row per map task.

Defined results: a null text is one empty line, as is an empty one. Documents
are told apart by `doc_id`: rows that repeat an id count as one document and
lose the same keys; rows without id count together as one document, which is
the largest only where no other holds the key. An empty table gives an empty
table. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark.llm.frames import carry, restore
from chattermark.sources.staging import stage

#: The white space of the contract, 0x09 to 0x0D and the blank.
BLANKS = b"\t\n\x0b\x0c\r "
NO_ID = -(2**63)

KEPT = T.StructType(
    [
        T.StructField("kept", T.StringType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_dropped", T.LongType()),
    ]
)


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line's key, or None where the key is too short."""
    key = line.strip(BLANKS).lower()  # on bytes, this lowers A to Z alone
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def line_keys(documents: DataFrame, min_chars: int) -> DataFrame:
    """Distinct (doc_id, key) of all lines that are long enough."""

    def exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch["id"], batch["text"], strict=True):
                found = {line_hash(x, min_chars) for x in (text or "").encode().split(b"\n")}
                found.discard(None)
                ids += [doc_id] * len(found)
                keys += found
            yield pd.DataFrame({"id": pd.Series(ids, dtype="int64"), "key": keys})

    narrow = documents.select(F.coalesce("doc_id", F.lit(NO_ID)).cast("long").alias("id"), "text")
    return narrow.mapInPandas(exploded, "id long, key binary")


def shared_keys(keys: DataFrame, min_documents: int) -> DataFrame:
    """Keys found in enough documents, with the largest id that holds each."""
    return (
        keys.distinct()
        .groupBy("key")
        .agg(F.count("*").alias("documents"), F.max("id").alias("keeper"))
        .where(F.col("documents") >= min_documents)
    )


def drop_shared_lines(
    documents: DataFrame, *, min_chars: int = 20, min_documents: int = 3
) -> DataFrame:
    """`documents` with `text` rid of shared lines, `n_lines` before it and `n_dropped`."""
    keys = stage(line_keys(documents, min_chars), "line-keys")
    # Staged, so that the join reads both sides from shuffles, and Spark can split a hot key.
    shared = stage(shared_keys(keys, min_documents), "shared-lines")
    drops = (
        keys.join(shared, "key")
        .where(F.col("id") != F.col("keeper"))
        .groupBy("id")
        .agg(F.collect_set("key").alias("drop"))
    )

    @F.pandas_udf(KEPT)
    def reassembled(texts: pd.Series, drop: pd.Series) -> pd.DataFrame:
        out = []
        for text, gone in zip(texts, drop, strict=True):
            lines = (text or "").encode().split(b"\n")
            kept = lines
            if gone is not None:
                unwanted = {bytes(x) for x in gone}
                kept = [x for x in lines if line_hash(x, min_chars) not in unwanted]
            out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    joined = carry(
        documents, id=F.coalesce("doc_id", F.lit(NO_ID)).cast("long"), text=F.col("text")
    ).join(drops, "id", "left")
    done = joined.withColumn("done", reassembled("text", "drop"))
    return restore(
        done,
        text=F.col("done.kept"),
        n_lines=F.col("done.n_lines"),
        n_dropped=F.col("done.n_dropped"),
    )
