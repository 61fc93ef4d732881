"""A session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_CONF = {
    # Periods are formatted strings, so the zone has to be pinned.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot users, videos and the group of unknown ones are split at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Texts of a few users are filtered at their scan, whatever the table's size.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


def build_session(
    app_name: str = "chattermark",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; `conf` is applied over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
