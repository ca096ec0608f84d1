"""The tables that remember what was scheduled and sent.

Parquet, laid out by mailing and day: a job for one day reads and rewrites one
folder however long the history is, and rows are sorted by address inside, so
that file statistics narrow lookups.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from muster.operators.keyed import latest_state, upsert
from muster.sources import schemas
from muster.sources.scratch import cut, intermediate

LAYOUT = ("mailing_name", "ds")
# What identifies a row to be replaced; two people may share an address.
REPLACE_KEYS = ("ds", "email", "secondary_id", "mailing_name")
# What identifies a send.
SEND_KEYS = ("ds", "cons_id", "email", "secondary_id", "mailing_name")


def sequence_number(run_ts: dt.datetime) -> int:
    """Order of job runs: microseconds of the run's UTC time."""
    return (run_ts - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def current_sends(log: DataFrame) -> DataFrame:
    """Current state of each send; what ended in an error is not a send."""
    latest = latest_state(log, SEND_KEYS, "seq")
    failed = F.coalesce(F.col("mailing_recipient_id") == schemas.ERROR, F.lit(False))
    return latest.where(~failed).drop("seq")


class Ledger:
    """Schedulings, payloads and the send log under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def init(self, *mailing_names: str) -> Ledger:
        """Create empty tables for the given mailings."""
        created = dict(schemas.ledger_schemas())
        for name in mailing_names:
            created[self._payload_table(name)] = schemas.payload_schema(name)
        for table, schema in created.items():
            empty = self.spark.createDataFrame([], schema)
            empty.write.mode("ignore").partitionBy(*LAYOUT).parquet(self._path(table))
        return self

    def schedulings(self) -> DataFrame:
        return self._read("schedulings", schemas.SCHEDULINGS)

    def payloads(self, mailing_name: str) -> DataFrame:
        return self._read(self._payload_table(mailing_name), schemas.payload_schema(mailing_name))

    def send_log(self) -> DataFrame:
        return self._read("send_log", schemas.SEND_LOG)

    def sends(self) -> DataFrame:
        """Current sends.  Filters on day and mailing reach the scan, as both
        are part of the key the log is folded by."""
        return current_sends(self.send_log())

    def replace_payloads(self, mailing_name: str, ds: dt.date, staged: DataFrame) -> None:
        table = self._payload_table(mailing_name)
        self._replace(table, mailing_name, ds, self.payloads(mailing_name), staged)

    def replace_schedulings(
        self, mailing_name: str, ds: dt.date, kept: DataFrame, staged: DataFrame
    ) -> None:
        self._replace("schedulings", mailing_name, ds, kept, staged)

    def append_sends(self, rows: DataFrame, run_ts: dt.datetime) -> None:
        """Add new states to the send log.

        The log is only ever added to; writing the same rows again with the
        same run time changes nothing.
        """
        rows = rows.withColumn("seq", F.lit(sequence_number(run_ts)).cast("long"))
        rows = rows.select(*schemas.SEND_LOG.fieldNames())
        # A few files a day and not one from every task; a rebalance splits crowded days.
        rows = rows.hint("rebalance", *map(F.col, LAYOUT))
        self._write(rows.write.mode("append"), "send_log")

    def compact_sends(self, mailing_name: str, ds: dt.date) -> None:
        """Rewrite one day of the send log as its current states.

        What ended in an error is no send and goes; ``sends`` stays the same.
        The states are written elsewhere first, so that a run that dies leaves
        the day as it was.
        """
        today = (F.col("mailing_name") == mailing_name) & (F.col("ds") == F.lit(ds))
        latest = latest_state(self.send_log().where(today), SEND_KEYS, "seq")
        failed = F.coalesce(F.col("mailing_recipient_id") == schemas.ERROR, F.lit(False))
        with intermediate(self.spark):
            self._replace_day("send_log", mailing_name, ds, cut(latest.where(~failed)))

    def _replace(
        self, table: str, mailing_name: str, ds: dt.date, kept: DataFrame, staged: DataFrame
    ) -> None:
        """Rewrite the folder of one day."""
        today = (F.col("mailing_name") == mailing_name) & (F.col("ds") == F.lit(ds))
        self._replace_day(table, mailing_name, ds, upsert(kept.where(today), staged, REPLACE_KEYS))

    def _replace_day(self, table: str, mailing_name: str, ds: dt.date, content: DataFrame) -> None:
        """Dynamic overwrite replaces exactly the folders it writes rows to.  A
        row without an address is always among them, so that a day that has
        become empty is replaced as well; readers leave it out.
        """
        marker = self.spark.range(1).select(
            *[
                F.lit({"ds": ds, "mailing_name": mailing_name}.get(field.name))
                .cast(field.dataType)
                .alias(field.name)
                for field in content.schema
            ]
        )
        # All sort columns, so that a single crowded address can be split.
        order = ["email", "secondary_id", "cons_id"]
        content = content.unionByName(marker).repartitionByRange(*order)
        writer = content.sortWithinPartitions(*order).write.mode("overwrite")
        self._write(writer.option("partitionOverwriteMode", "dynamic"), table)

    def _write(self, writer, table: str) -> None:
        writer.partitionBy(*LAYOUT).parquet(self._path(table))

    def _read(self, table: str, schema) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(self._path(table))
        return rows.where(F.col("email").isNotNull()).select(*schema.fieldNames())

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    @staticmethod
    def _payload_table(mailing_name: str) -> str:
        return f"payloads_{mailing_name}"
