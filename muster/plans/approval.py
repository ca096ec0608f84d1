"""Mail to hosts whose event has just been approved."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.config import MailingConfig
from muster.functions import dates
from muster.operators.keyed import without_history
from muster.plans.scheduling import publish
from muster.sources.ledger import Ledger
from muster.sources.scratch import cut


def first_starts(cfg: MailingConfig, timeslots: DataFrame, events: DataFrame) -> DataFrame:
    """Earliest timeslot from ``ds`` on of each of ``events``, deleted ones included."""
    upcoming = timeslots.where(
        dates.starts_within(F.col("start_date"), cfg.ds, None, cfg.calendar_zone)
    )
    return (
        upcoming.join(events.select(F.col("id").alias("event_id")), "event_id", "left_semi")
        .groupBy("event_id")
        .agg(F.min("start_date").alias("start_timestamp"))
        .withColumn(
            "start_date", dates.day_in_zone(F.col("start_timestamp"), cfg.calendar_zone)
        )
    )


def just_approved(cfg: MailingConfig, events: DataFrame) -> DataFrame:
    """Recently reviewed, approved, undeleted events of volunteer hosts."""
    since = max(dt.datetime.combine(cfg.approval_start_ds, dt.time()), cfg.approved_since)
    return events.where(
        (F.col("created_by_volunteer_host") == "1")
        & (F.col("approval_status") == "APPROVED")
        & F.col("deleted_date").isNull()
        # A null region is in no state, and so not outside the excluded ones.
        & ~F.col("location__region").isin(*cfg.approval_excluded_states)
        & (F.col("reviewed_date") >= dates.utc_literal(since))
    )


def approved_events(cfg: MailingConfig, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Just approved events with a timeslot still to come, as rows to stage."""
    events = just_approved(cfg, tables["org_events"])
    starts = first_starts(cfg, tables["timeslots"], events).withColumnRenamed("event_id", "id")
    local = dates.in_zone(F.col("start_timestamp"), F.col("timezone"))
    event_id = F.col("id").cast("string")
    return events.join(starts, "id").select(
        F.lit(cfg.ds).alias("ds"),
        F.lit(None).cast("long").alias("cons_id"),
        F.col("creator__email_address").alias("email"),
        F.col("id").alias("secondary_id"),
        F.lit(cfg.mailing_name).alias("mailing_name"),
        F.col("creator__given_name").alias("firstname"),
        F.col("creator__family_name").alias("lastname"),
        F.concat(F.lit(f"{cfg.base_url}/event/"), event_id).alias("event_url"),
        F.concat(F.lit(f"{cfg.base_url}/dashboard/event/"), event_id).alias("event_dashboard_url"),
        F.col("visibility").alias("event_visibility"),
        F.col("title").alias("event_title"),
        F.col("summary").alias("event_summary"),
        F.col("description").alias("event_description"),
        "event_type",
        F.col("location__venue").alias("event_venue"),
        F.col("location__address_line_1").alias("event_addr1"),
        F.col("location__locality").alias("event_city"),
        F.col("location__region").alias("event_state"),
        F.col("location__postal_code").alias("event_zip"),
        F.col("location__lat").alias("latitude"),
        F.col("location__lon").alias("longitude"),
        F.col("timezone").alias("event_timezone"),
        F.col("start_date").alias("event_start_date"),
        dates.timestamp_text(local).alias("event_start_timestamp_local"),
        F.col("reviewed_date").alias("event_reviewed_at"),
    )


def approval_staging(approved: DataFrame, schedulings: DataFrame) -> DataFrame:
    """Approved events whose host was never written to about them."""
    return without_history(cut(approved), schedulings, ["email", "secondary_id", "mailing_name"])


def schedule_approvals(
    tables: Mapping[str, DataFrame],
    ledger: Ledger,
    cfg: MailingConfig,
    run_ts: dt.datetime,
) -> DataFrame:
    """The approval job."""
    history = ledger.schedulings().where(F.col("mailing_name") == cfg.mailing_name)
    staging = approval_staging(approved_events(cfg, tables), history)
    return publish(staging, ledger, cfg, run_ts, reset=False)
