"""Audiences for a recurring mailing: who gets it, and their personal values."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions import text
from muster.operators.keyed import first_per_key
from muster.operators.position import in_batches, with_position
from muster.plans import sending
from muster.sources import schemas
from muster.sources.scratch import cut


class Audience(NamedTuple):
    """``recipients`` are the rows the other three are made of."""

    recipients: DataFrame
    group: DataFrame
    identity_map: DataFrame
    dataset: DataFrame


def identity_column(mailing_name: str) -> str:
    return f"cons_id_{mailing_name}"


def recurring_recipients(
    schedulings: DataFrame,
    payloads: DataFrame,
    sends: DataFrame,
    ds_list: Sequence[dt.date],
    mailing_name: str,
    limit: int | None = None,
    batch_size: int = 1000,
) -> DataFrame:
    """Pending sends of several days, with ``day_number`` in the listed order.

    What an earlier run set aside for these days counts as pending again.
    """
    sends = sending.reset_sends(
        sends, ds_list, mailing_name, schemas.RECURRING_MAILING_ID, schemas.PLACE_RECUR
    )
    listed = F.array(*[F.lit(ds) for ds in ds_list])
    pending = sending.pending_sends(
        schedulings.where(F.col("ds").isin(*ds_list)), payloads, sends, mailing_name
    ).withColumn("day_number", F.array_position(listed, F.col("ds")))
    if limit:
        positioned = with_position(pending, recipient_order())
        pending = in_batches(positioned, batch_size, limit)
        pending = pending.drop("position", "batch", "batch_index")
    return pending


def recipient_order():
    return [F.asc("day_number"), *sending.send_order()]


def recurring_audience(
    recipients: DataFrame, mailing_name: str, columns: Sequence[str]
) -> Audience:
    """Group, identity map and personalisation dataset of the recipients.

    Group and map keep a person who is reached under two addresses twice; the
    dataset keeps the first row of each person.
    """
    identity = identity_column(mailing_name)
    wanted = [c for c in recipients.columns if c in columns and c != "cons_id"]
    kinds = {f.name: f.dataType for f in recipients.schema}
    once = first_per_key(
        recipients.select("cons_id", "day_number", "ds", "email", "secondary_id", "scheduled_at",
                          *[F.col(c).alias(f"_value_{c}") for c in wanted]),
        ["cons_id"],
        recipient_order(),
    )

    def value(name: str):
        column = F.col(f"_value_{name}")
        folded = text.fold_ascii(column) if isinstance(kinds[name], T.StringType) else column
        return folded.alias(name)

    return Audience(
        recipients=recipients,
        group=recipients.select("cons_id"),
        identity_map=recipients.select("cons_id", F.col("cons_id").alias(identity)),
        dataset=once.select(F.col("cons_id").alias(identity), *[value(c) for c in wanted]),
    )


def prepare_recurring(
    ledger,
    ds_list: Sequence[dt.date],
    mailing_name: str,
    columns: Sequence[str],
    sent_ds: dt.date,
    run_ts: dt.datetime,
    limit: int | None = None,
    batch_size: int = 1000,
) -> Audience:
    """The recurring job: set recipients aside in the ledger, return their tables."""
    code, mailing_id = schemas.PLACE_RECUR, schemas.RECURRING_MAILING_ID
    sends = ledger.sends()
    recipients = cut(
        recurring_recipients(
            ledger.schedulings(), ledger.payloads(mailing_name), sends, ds_list,
            mailing_name, limit, batch_size,
        )
    )
    before = dt.timedelta(microseconds=1)
    ledger.append_sends(
        cut(sending.taken_back(sends, ds_list, mailing_name, mailing_id, code)), run_ts - before
    )
    ledger.append_sends(
        sending.placeholder_sends(recipients, mailing_id, sent_ds, run_ts, code), run_ts
    )
    return recurring_audience(recipients, mailing_name, columns)
