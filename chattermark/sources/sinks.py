"""Result files: CSV lists, JSON records and Parquet snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.linalg import VectorUDT

# The writer and the reader trim texts unless told otherwise; a reader would also take a
# carriage return for a line end.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "quoteAll": True,
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "lineSep": "\n",
}
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, VectorUDT)


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, texts as they are; vectors and other nested columns are left out.

    A null and an empty text differ: the empty one is quoted.
    """
    flat = [f.name for f in df.schema.fields if not isinstance(f.dataType, _NESTED)]
    df.select(*flat).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table written by `write_csv`, with every text as it was."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(path)


def _json_ready(field: T.StructField) -> Column:
    plain = (T.StringType, T.BooleanType, T.NumericType, T.ArrayType, T.MapType, T.StructType)
    column = F.col(f"`{field.name}`")
    return column if isinstance(field.dataType, plain) else column.cast("string").alias(field.name)


def write_json(df: DataFrame, path: str) -> str:
    """One JSON record a line; values JSON has no type for become text."""
    df.select(*[_json_ready(f) for f in df.schema.fields]).write.mode("overwrite").option(
        "ignoreNullFields", False
    ).json(path)
    return path


def write_snapshot(df: DataFrame, path: str) -> str:
    """Parquet, as a point to resume from."""
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)
