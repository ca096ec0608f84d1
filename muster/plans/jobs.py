"""Sending, as two steps around an outside deliverer.

The deliverer takes the request table of ``prepare_send`` and returns the
answers; ``record_*`` put them into the ledger.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from muster.plans import reporting, sending
from muster.sources import schemas, sinks
from muster.sources.ledger import Ledger
from muster.sources.scratch import cut, intermediate

SUMMARY_ALL_TIME_TAB = "Summary All-Time"
SUMMARY_BY_WEEK_TAB = "Summary By Week"


def prepare_send(
    ledger: Ledger,
    ds: dt.date,
    mailing_name: str,
    mailing_id: str,
    sent_ds: dt.date,
    run_ts: dt.datetime,
    batch_size: int = 1000,
    limit: int | None = None,
    whitelist: DataFrame | None = None,
) -> DataFrame:
    """Batches to send for a day, with their placeholders stored first."""
    pending = sending.pending_sends(
        ledger.schedulings(), ledger.payloads(mailing_name), ledger.sends(), mailing_name, ds
    )
    batch = cut(sending.send_batches(pending, batch_size, limit, whitelist=whitelist))
    ledger.append_sends(sending.placeholder_sends(batch, mailing_id, sent_ds, run_ts), run_ts)
    return batch


def _record(
    ledger: Ledger,
    outcomes: DataFrame,
    awaiting: str,
    mailing_name: str,
    ds: dt.date | None,
    run_ts: dt.datetime,
) -> None:
    """Store what became of a mailing's sends, of one day or of all.

    Day and mailing are parts of the send log's layout, so one day's answers
    read one day's folder.
    """
    sends, met = (sending.of_mailing(rows, mailing_name, ds) for rows in (ledger.sends(), outcomes))
    with intermediate(ledger.spark):
        ledger.append_sends(cut(sending.resolved_sends(sends, met, awaiting, run_ts)), run_ts)


def record_send_responses(
    ledger: Ledger, log: DataFrame, mailing_name: str, ds: dt.date | None, run_ts: dt.datetime
) -> None:
    outcomes = sending.classify_send_responses(log)
    _record(ledger, outcomes, schemas.PLACE, mailing_name, ds, run_ts)


def record_ses_responses(
    ledger: Ledger,
    log: DataFrame,
    configuration_set_name: str,
    mailing_name: str,
    ds: dt.date | None,
    run_ts: dt.datetime,
) -> None:
    outcomes = sending.classify_ses_responses(log, configuration_set_name)
    _record(ledger, outcomes, schemas.PLACE, mailing_name, ds, run_ts)


def record_deferred_responses(
    ledger: Ledger, log: DataFrame, mailing_name: str, ds: dt.date | None, run_ts: dt.datetime
) -> None:
    outcomes = sending.classify_deferred_responses(log)
    _record(ledger, outcomes, schemas.DEFER, mailing_name, ds, run_ts)


def forecast(
    ledger: Ledger,
    ds: dt.date,
    mailing_name: str,
    fields: Sequence[str],
    path: str,
    tab: str,
    limit: int,
) -> bool:
    """Report of one day's recipients; none if there are none."""
    detail = reporting.forecast_detail(
        ledger.schedulings(), ledger.payloads(mailing_name), mailing_name, fields, ds, limit
    )
    return sinks.write_report(detail, path, tab)


def summarize_all_time(
    ledger: Ledger, mailing_name: str, fields: Sequence[str], path: str
) -> bool:
    """Reports by day and fields, and by week; none without fields."""
    if not fields:
        return False
    schedulings, payloads = ledger.schedulings(), ledger.payloads(mailing_name)
    summary = reporting.forecast_all_time(schedulings, payloads, mailing_name, fields)
    weeks = reporting.forecast_by_week(schedulings, payloads, mailing_name)
    sinks.write_report(summary, path, SUMMARY_ALL_TIME_TAB)
    sinks.write_report(weeks, path, SUMMARY_BY_WEEK_TAB)
    return True
