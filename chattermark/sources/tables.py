"""The four input tables, from files, a catalog or a database."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chattermark import schemas


@dataclass(frozen=True)
class CommentTables:
    """Comments with the users, videos and channels they refer to."""

    comments: DataFrame
    users: DataFrame
    videos: DataFrame
    channels: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in schemas.TABLES]

    def register(self, prefix: str = "") -> None:
        """Make the tables visible to SQL as temporary views."""
        for name, df in self.items():
            df.createOrReplaceTempView(prefix + name)


def from_parquet(spark: SparkSession, root: str) -> CommentTables:
    """Tables stored as Parquet folders `<root>/<table>`, read with declared schemas."""
    return CommentTables(
        **{
            name: spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")
            for name, schema in schemas.TABLES.items()
        }
    )


def from_catalog(spark: SparkSession, prefix: str = "") -> CommentTables:
    """Tables or views of the catalog named `<prefix><table>`."""
    return CommentTables(**{name: spark.table(prefix + name) for name in schemas.TABLES})


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str,
    password: str,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for one database table.

    The partitioning arguments go together: with them the table is read in
    `num_partitions` ranges of the column; the bounds only place the cuts.
    """
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "fetchsize": str(fetch_size),
        # Times without a zone stay as they are stored.
        "preferTimestampNTZ": "true",
    }
    ranges = {
        "partitionColumn": partition_column,
        "lowerBound": lower_bound,
        "upperBound": upper_bound,
        "numPartitions": num_partitions,
    }
    given = {k: str(v) for k, v in ranges.items() if v is not None}
    if given and len(given) < len(ranges):
        raise ValueError(f"give all or none of {', '.join(ranges)}")
    return {**options, **given}


def bounds_query(table: str, column: str = "id") -> str:
    """A derived table with the smallest and the largest id, which an index answers."""
    return f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}) bounds"


def read_options(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def from_jdbc(
    spark: SparkSession,
    url: str,
    *,
    user: str,
    password: str,
    prefix: str = "",
    num_partitions: int = 64,
    fetch_size: int = 10_000,
) -> CommentTables:
    """Tables of a database, each read in `num_partitions` ranges of its `id`.

    The bounds of each table are asked of the database first; they only place the
    cuts. An empty table has none and is read as it is.
    """
    common = {"user": user, "password": password, "fetch_size": fetch_size}

    def load(name: str) -> DataFrame:
        table = prefix + name
        bounds = read_options(spark, jdbc_options(url, bounds_query(table), **common)).head()
        ranges = {}
        if bounds is not None and bounds["low"] is not None:
            ranges = {
                "partition_column": "id",
                "lower_bound": int(bounds["low"]),
                "upper_bound": int(bounds["high"]) + 1,
                "num_partitions": num_partitions,
            }
        return read_options(spark, jdbc_options(url, table, **common, **ranges))

    return CommentTables(**{name: load(name) for name in schemas.TABLES})


def check_catalog(spark: SparkSession, prefix: str = "") -> DataFrame:
    """Which required tables exist, and which of their columns are missing.

    Reads the catalog only; no table is scanned.
    """
    rows = []
    for name, schema in schemas.TABLES.items():
        exists = spark.catalog.tableExists(prefix + name)
        columns = [c.name for c in spark.catalog.listColumns(prefix + name)] if exists else []
        missing = [f.name for f in schema.fields if f.name not in columns]
        rows.append((prefix + name, exists, len(columns), missing))
    return spark.createDataFrame(
        rows,
        T.StructType(
            [
                T.StructField("table_name", T.StringType()),
                T.StructField("present", T.BooleanType()),
                T.StructField("n_columns", T.IntegerType()),
                T.StructField("missing_columns", T.ArrayType(T.StringType())),
            ]
        ),
    )


def require_tables(spark: SparkSession, prefix: str = "") -> None:
    """Raise when a required table is absent from the catalog."""
    absent = check_catalog(spark, prefix).filter(~F.col("present"))
    names = [row.table_name for row in absent.collect()]
    if names:
        raise LookupError(f"tables not found: {', '.join(names)}")


def run_sql(
    spark: SparkSession,
    statement: str,
    tables: dict[str, DataFrame] | None = None,
    **params,
) -> DataFrame:
    """Run a SELECT with named parameters (`:start_date`) over the given tables.

    Values are bound as literals, never spliced into the text. The statement names
    the tables in braces, `FROM {comments}`; views of the session stay as they are.
    """
    return spark.sql(statement, args=params, **(tables or {}))
