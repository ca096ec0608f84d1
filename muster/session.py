"""A Spark session set up the way the package expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Timestamps are zone-less UTC, and Spark formats them in the session's zone.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No recording of the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**ADVISED, **REQUIRED, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
