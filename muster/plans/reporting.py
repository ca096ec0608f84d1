"""Forecasts and counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import dates
from muster.operators.keyed import matched
from muster.plans.sending import SENT_KEYS, of_mailing, send_order, with_payloads


def scheduled_payloads(
    schedulings: DataFrame, payloads: DataFrame, mailing_name: str, ds: dt.date | None = None
) -> DataFrame:
    return with_payloads(of_mailing(schedulings, mailing_name, ds), payloads)


def forecast_detail(
    schedulings: DataFrame,
    payloads: DataFrame,
    mailing_name: str,
    fields: Sequence[str],
    ds: dt.date | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One row per recipient of a day, in order, up to ``limit``."""
    rows = scheduled_payloads(schedulings, payloads, mailing_name, ds).orderBy(*send_order())
    rows = rows.select("email", *[f for f in fields if f != "email"])
    return rows if limit is None else rows.limit(limit)


def forecast_all_time(
    schedulings: DataFrame, payloads: DataFrame, mailing_name: str, fields: Sequence[str]
) -> DataFrame | None:
    """Recipients by day and payload fields; nothing to do without fields."""
    if not fields:
        return None
    return (
        scheduled_payloads(schedulings, payloads, mailing_name)
        .groupBy("ds", *fields)
        .agg(F.count("*").alias("cons_count"))
        .orderBy(F.desc("ds"), F.desc("cons_count"))
    )


def forecast_by_week(
    schedulings: DataFrame, payloads: DataFrame, mailing_name: str
) -> DataFrame:
    return (
        scheduled_payloads(schedulings, payloads, mailing_name)
        .groupBy(dates.week_start(F.col("ds")).alias("week_begin"))
        .agg(F.count("*").alias("cons_count"))
        .orderBy(F.desc("week_begin"))
    )


def event_reach(
    schedulings: DataFrame, payloads: DataFrame, sends: DataFrame, mailing_name: str
) -> DataFrame:
    """How many were, and will be, invited to each event, by day."""
    rows = scheduled_payloads(schedulings, payloads, mailing_name)
    sent = of_mailing(sends, mailing_name, None)
    marked = matched(rows, sent, SENT_KEYS, "left", flag="was_sent")
    return marked.groupBy("event_url", "ds").agg(
        F.count("was_sent").alias("invited"),
        (F.count("*") - F.count("was_sent")).alias("to_invite"),
    )
