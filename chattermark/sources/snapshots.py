"""Activity kept by month: a stored table whose months are brought up to date one by one.

A month of activity depends on the comments of that month alone, so when comments
arrive or change, only their months are counted again. Each month is a partition;
an update replaces the partitions it computed and leaves the files of all others as they
are. A month that has no rows any more loses its partition, as the overwriting write alone
would leave the old one in place.

The months to recompute are read with filters on `published_at`, so a source that is itself
partitioned or sorted by time is pruned to them. Readers give a range of months, which prunes partitions.
A failed update leaves every month either old or new, and running it again mends it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chattermark.sources.staging import new_folder, remove, stage_at

MONTH = "%Y-%m"


def next_month(month: str) -> str:
    """The month after one given as `2024-01`."""
    first = dt.datetime.strptime(month, MONTH)
    return (first.replace(day=28) + dt.timedelta(days=4)).strftime(MONTH)


def runs_of_months(months: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Consecutive months as (first day, day after the last), so one scan reads a run."""
    ordered = sorted(set(months))
    begin = 0
    for i, month in enumerate(ordered):
        if i + 1 == len(ordered) or ordered[i + 1] != next_month(month):
            yield f"{ordered[begin]}-01", f"{next_month(month)}-01"
            begin = i + 1


def changed_months(comments: DataFrame) -> list[str]:
    """Months of the given comments, say of those that arrived; one short text a month."""
    month = F.date_format("published_at", "yyyy-MM").alias("month")
    rows = comments.where("published_at IS NOT NULL").select(month).distinct().collect()
    return sorted(row["month"] for row in rows)


def stored_months(spark: SparkSession, path: str) -> list[str]:
    """Months that have a partition, from the folder's listing alone; none if there is no folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(name.split("=", 1)[1] for name in names if name.startswith("month="))


def update_months(
    spark: SparkSession,
    path: str,
    months: Iterable[str],
    activity_between: Callable[[str, str], DataFrame],
) -> list[str]:
    """Recompute `months` of the table at `path`; returns the months it holds afterwards.

    `activity_between(start, end)` gives the activity of comments from one day up to
    another, with its `month` as text. It is counted once, staged, and written from there.
    """
    wanted = sorted(set(months))
    if not wanted:
        return stored_months(spark, path)
    parts = [activity_between(start, end) for start, end in runs_of_months(wanted)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    columns = rows.columns
    folder = new_folder(spark, "months")
    try:
        fresh = stage_at(rows.where(F.col("month").isin(wanted)), folder)
        present = {row["month"] for row in fresh.select("month").distinct().collect()}
        # One task may write all of a small month; large ones spread over tasks by user.
        spread = fresh.repartition("month", F.pmod(F.xxhash64("user_id", "channel_title"), F.lit(8)))
        spread.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "month"
        ).parquet(path)
    finally:
        remove(spark, folder)
    for month in set(wanted) - present:
        remove(spark, f"{path}/month={month}")
    return stored_months(spark, path)


def read_months(
    spark: SparkSession, path: str, schema, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Activity of the months from `first` to `last`, both included; only their files are read.

    `schema` is that of the activity, as an empty table has no file to tell it.
    """
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    if first is not None:
        rows = rows.where(F.col("month") >= first)
    if last is not None:
        rows = rows.where(F.col("month") <= last)
    return rows.select(*[f.name for f in schema])
