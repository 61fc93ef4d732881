"""Small helpers the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "carried_row"


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, most: int = MOST_BATCH_BYTES) -> None:
    """Let Python tasks of this session get rows in batches of `most` bytes, four megabytes by default.

    Batches are bounded by rows otherwise, and ten thousand long texts are many
    megabytes, of which a worker holds several copies.
    """
    spark.conf.set(BATCH_BYTES, str(most))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of texts, for operators that run Python on it."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carry(df: DataFrame, **computed: Column) -> DataFrame:
    """The whole input row as one struct beside computed columns, so no name can clash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *[
        column.alias(name) for name, column in computed.items()
    ])


def restore(df: DataFrame, **added: Column) -> DataFrame:
    """The input columns again, with `added`; an input column of an added name gives way."""
    taken = {name.lower() for name in added}
    kept = [f.name for f in df.schema[ROW].dataType.fields if f.name.lower() not in taken]
    return df.select(
        *[F.col(ROW).getField(name).alias(name) for name in kept],
        *[column.alias(name) for name, column in added.items()],
    )


def stratum_key(column: Column) -> Column:
    """A grouping key that is never null; null and the empty string stay apart."""
    return F.when(column.isNull(), "n").otherwise(F.concat(F.lit("s"), column.cast("string")))


def seeded_order(seed: int, *columns: Column) -> Column:
    """MD5 of the seed and the columns as hex text; rows equal in them all get one value."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def hex_bucket(digest: Column, digits: int) -> Column:
    """The leading hex digits of a digest as a number, so that buckets follow its order."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")
