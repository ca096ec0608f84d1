"""The approval mailing as a stream of changed events and timeslots."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from muster.config import MailingConfig
from muster.functions import dates
from muster.operators.keyed import first_per_key
from muster.plans.approval import just_approved, schedule_approvals
from muster.sources import schemas
from muster.sources.arrivals import Arrivals
from muster.sources.ledger import Ledger, sequence_number
from muster.sources.scratch import cut, intermediate


def _changed(spark: SparkSession, table: str, folder: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schemas.INPUTS[table])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def changed_events(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of event rows from the files that arrive in a folder."""
    return _changed(spark, "org_events", folder, max_files_per_trigger)


def changed_timeslots(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of timeslot rows from the files that arrive in a folder."""
    return _changed(spark, "timeslots", folder, max_files_per_trigger)


class Waiting:
    """Events that have no timeslot to come yet, and timeslots whose event may still come.

    Either wakes the other.  What was mailed, is over or can no longer be mailed
    goes when a stream starts, so the tables hold what is still open and not the
    history.
    """

    def __init__(self, ledger: Ledger, cfg: MailingConfig):
        root = f"{ledger.root}/waiting_{cfg.mailing_name}"
        self.ledger, self.cfg = ledger, cfg
        self.events = Arrivals(ledger.spark, f"{root}/events", schemas.INPUTS["org_events"], ["id"])
        self.timeslots = Arrivals(ledger.spark, f"{root}/timeslots", schemas.INPUTS["timeslots"], ["id"])

    def add(self, events: DataFrame, timeslots: DataFrame, seq: int, batch: int) -> None:
        self.events.add(events, seq, batch)
        self.timeslots.add(self.to_come(timeslots), seq, batch)

    def woken(self, events: DataFrame, timeslots: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Last versions of the events that a batch's events and timeslots concern, and of their timeslots."""
        concerned = cut(
            events.select("id").unionByName(timeslots.select(F.col("event_id").alias("id"))).dropna().distinct()
        )
        known = self.events.latest().join(concerned, "id", "left_semi")
        slots = self.timeslots.latest().join(
            concerned.select(F.col("id").alias("event_id")), "event_id", "left_semi"
        )
        return tuple(rows.drop("_seq", "_batch") for rows in (known, slots))

    def to_come(self, timeslots: DataFrame) -> DataFrame:
        return timeslots.where(
            dates.starts_within(F.col("start_date"), self.cfg.ds, None, self.cfg.calendar_zone)
        )

    def tidy(self) -> None:
        mailed = (
            self.ledger.schedulings()
            .where((F.col("mailing_name") == self.cfg.mailing_name) & F.col("secondary_id").isNotNull())
            .select(F.col("secondary_id").alias("id"), F.col("email").alias("creator__email_address"))
        )
        self.events.compact(
            lambda rows: just_approved(self.cfg, rows).join(
                mailed.distinct(), ["id", "creator__email_address"], "left_anti"
            )
        )
        self.timeslots.compact(self.to_come)


def mail_approvals(
    events: DataFrame,
    tables: Callable[[], Mapping[str, DataFrame]],
    ledger: Ledger,
    cfg: MailingConfig,
    checkpoint: str,
    run_ts: Callable[[], dt.datetime],
    timeslots: DataFrame | None = None,
) -> StreamingQuery:
    """Run the approval job on each batch of changed events and timeslots, until none is left.

    An event is mailed about once both it and a timeslot to come have arrived, in
    whichever order and however many batches apart; what the one has to wait for
    is kept beside the ledger.  Timeslots that ``tables()`` holds count as well.

    "Never twice" has no time limit, so the ledger decides it, not state with a
    watermark.  That also makes a repeated batch harmless.  An event that
    changed twice in a batch counts once, as last reviewed; a timeslot, as the
    one that starts last.
    """
    waiting = Waiting(ledger, cfg)
    waiting.tidy()
    arriving = events.select(F.struct(*schemas.INPUTS["org_events"].fieldNames()).alias("event"))
    if timeslots is not None:
        slot = F.struct(*schemas.INPUTS["timeslots"].fieldNames()).alias("slot")
        arriving = arriving.unionByName(timeslots.select(slot), allowMissingColumns=True)
    else:
        slot_type = schemas.INPUTS["timeslots"]
        arriving = arriving.withColumn("slot", F.lit(None).cast(slot_type))

    def schedule(batch: DataFrame, number: int) -> None:
        now = run_ts()
        with intermediate(ledger.spark):
            changed = cut(
                first_per_key(
                    batch.where("event IS NOT NULL").select("event.*"),
                    ["id"], [F.desc_nulls_last("reviewed_date"), F.asc("approval_status")],
                )
            )
            slots = cut(
                first_per_key(
                    batch.where("slot IS NOT NULL").select("slot.*"),
                    ["id"], [F.desc_nulls_last("start_date"), F.asc_nulls_last("event_id")],
                )
            )
            waiting.add(changed, slots, sequence_number(now), number)
            concerned, starting = waiting.woken(changed, slots)
            given = tables()
            if "timeslots" in given:
                starting = starting.unionByName(given["timeslots"].select(*starting.columns))
            current = {"org_events": cut(concerned), "timeslots": starting}
            schedule_approvals(ChainMap(current, given), ledger, cfg, now)

    return (
        arriving.writeStream.foreachBatch(schedule)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
