"""From the best event per person to the ledgers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.config import MailingConfig
from muster.functions import dates
from muster.operators.keyed import without
from muster.plans.events import event_features, score_events
from muster.plans.matching import best_by_person, best_events, described
from muster.plans.people import build_constituents
from muster.sources import schemas
from muster.sources.ledger import Ledger
from muster.sources.scratch import cut, intermediate


def reset_schedulings(
    schedulings: DataFrame, sends: DataFrame, cfg: MailingConfig
) -> DataFrame:
    """Schedulings without those of the day, unless the day has begun to be sent."""
    ours = (F.col("ds") == F.lit(cfg.ds)) & (F.col("mailing_name") == cfg.mailing_name)
    others = schedulings.where(~F.coalesce(ours, F.lit(False)))
    begun = sends.where(ours).select("ds", "mailing_name").distinct()
    kept = schedulings.where(ours).join(begun, ["ds", "mailing_name"], "left_semi")
    return others.unionByName(kept)


def outside_quiet_period(
    candidates: DataFrame, schedulings: DataFrame, cfg: MailingConfig
) -> DataFrame:
    """Candidates whose address was not scheduled in the days up to ``ds``."""
    recent = schedulings.where(
        (F.col("mailing_name") == cfg.mailing_name)
        & F.col("ds").between(F.lit(cfg.quiet_start_ds), F.lit(cfg.ds))
    )
    return without(candidates, recent, ["email", "secondary_id", "mailing_name"])


def invite_staging(
    best: DataFrame, schedulings: DataFrame, sends: DataFrame, cfg: MailingConfig
) -> DataFrame:
    """Who is written to on ``ds``.

    Only those whose best event of the whole window starts exactly on the
    event day; the others wait for a later ``ds``.
    """
    due = best.where(F.col("event_start_date") == F.lit(cfg.event_ds))
    return outside_quiet_period(due, reset_schedulings(schedulings, sends, cfg), cfg)


def invite_candidates(
    cfg: MailingConfig, tables: Mapping[str, DataFrame], people: DataFrame | None = None
) -> DataFrame:
    """Best event of everybody who has one in reach.  ``people``, if given, are stored."""
    if people is None:
        people = cut(build_constituents(cfg, tables))
    return best_events(people, cut(score_events(event_features(cfg, tables))), cfg)


def as_payloads(staging: DataFrame, schema, prepared_at: dt.datetime) -> DataFrame:
    """Staged rows in the columns and types of a payload table, by name."""
    rows = staging.withColumn("payload_prepared_at", dates.utc_literal(prepared_at))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def as_schedulings(staging: DataFrame, scheduled_at: dt.datetime) -> DataFrame:
    return staging.select(
        *schemas.KEYS, dates.utc_literal(scheduled_at).alias("scheduled_at")
    )


def publish(
    staging: DataFrame,
    ledger: Ledger,
    cfg: MailingConfig,
    run_ts: dt.datetime,
    reset: bool = True,
) -> DataFrame:
    """Replace the staged keys in the payload table and then in the schedulings.

    In this order, so that a scheduling always has its payload; readers join
    both, so a run that stops half way shows nothing new.  Staging is stored
    first: it depends on the ledger it is about to change.  With ``reset``, the
    day's other schedulings go too, unless sending has begun.
    """
    staged = cut(staging)
    payloads = as_payloads(staged, schemas.payload_schema(cfg.mailing_name), run_ts)
    ledger.replace_payloads(cfg.mailing_name, cfg.ds, payloads)
    kept = ledger.schedulings()
    if reset:
        kept = reset_schedulings(kept, ledger.sends(), cfg)
    ledger.replace_schedulings(cfg.mailing_name, cfg.ds, kept, as_schedulings(staged, run_ts))
    return staged


def schedule_invites(
    tables: Mapping[str, DataFrame],
    ledger: Ledger,
    cfg: MailingConfig,
    run_ts: dt.datetime,
    people: DataFrame | None = None,
) -> DataFrame:
    """The daily invite job."""
    best = invite_candidates(cfg, tables, people)
    staging = invite_staging(best, ledger.schedulings(), ledger.sends(), cfg)
    return publish(staging, ledger, cfg, run_ts)


def _days(cfg: MailingConfig, days: int) -> Iterator[MailingConfig]:
    for n in range(days + 1):
        yield cfg.on(cfg.ds + dt.timedelta(days=n))


def schedule_horizon(
    tables: Mapping[str, DataFrame],
    ledger: Ledger,
    cfg: MailingConfig,
    run_ts: dt.datetime,
    days: int = 7,
) -> None:
    """The invite job for ``ds`` and the days after it.

    All days are decided in one pass (``plan_horizon``); then each is published.
    """
    with intermediate(ledger.spark):
        staged = cut(plan_horizon(tables, ledger.schedulings(), ledger.sends(), cfg, days))
        for day in _days(cfg, days):
            with intermediate(ledger.spark):
                publish(staged.where(F.col("ds") == F.lit(day.ds)), ledger, day, run_ts)


def plan_horizon(
    tables: Mapping[str, DataFrame],
    schedulings: DataFrame,
    sends: DataFrame,
    cfg: MailingConfig,
    days: int = 7,
) -> DataFrame:
    """Who is written to on ``ds`` and each of the days after it.

    The same as the invite job day by day, each seeing what the days before it
    staged, but people are put together once, and their places are matched once
    with the venues of all days.  Only the quiet period ties days to each other:
    it is decided by address, over the days in order.
    """
    every = list(_days(cfg, days))
    people = cut(build_constituents(cfg, tables))
    # Stored day by day: in one plan, Spark reads what all days have shuffled in common
    # tasks, and few of them.
    by_day = [cut(score_events(event_features(day, tables))) for day in every]
    events = reduce(DataFrame.unionByName, by_day)
    best, won = best_by_person(people, events, cfg)
    due = cut(best.where(F.col("event_start_date") == F.date_add("ds", cfg.invite_lead_days)))
    staged = after_quiet_days(due, _history(schedulings, sends, every), cfg)
    return described(staged, won, events, cfg)


def _history(schedulings: DataFrame, sends: DataFrame, every: list[MailingConfig]) -> DataFrame:
    """(email, ds) of the invitations that a horizon finds and does not replace.

    Of its own days, those that have begun to be sent.
    """
    first, last = every[0], every[-1]
    ours = schedulings.where(
        (F.col("mailing_name") == first.mailing_name)
        & F.col("secondary_id").isNull()
        & F.col("ds").between(F.lit(first.quiet_start_ds), F.lit(last.ds))
    ).select("email", "ds")
    begun = sends.where(
        (F.col("mailing_name") == first.mailing_name) & (F.col("ds") >= F.lit(first.ds))
    ).select("ds")
    before = ours.where(F.col("ds") < F.lit(first.ds))
    return before.unionByName(ours.join(begun.distinct(), "ds", "left_semi").where(F.col("ds") >= F.lit(first.ds)))


def after_quiet_days(due: DataFrame, history: DataFrame, cfg: MailingConfig) -> DataFrame:
    """Rows of the days on which their address may be written to.

    An address is written to on a day if it was not in the days before, as far as
    the quiet period goes: neither by the history nor by what this scan has
    decided for earlier days.  Whoever shares an address is written to on the
    same days.  An address has as many elements as there are days, however many
    rows it has.
    """
    days = due.groupBy("email").agg(F.array_sort(F.collect_set("ds")).alias("_asked"))
    known = history.groupBy("email").agg(F.collect_set("ds").alias("_known"))
    nothing = F.array().cast("array<date>")

    def decide(written: Column, day: Column) -> Column:
        before = F.concat(written, F.coalesce("_known", nothing))
        quiet = F.exists(before, lambda d: (d > F.date_sub(day, cfg.quiet_period_days)) & (d <= day))
        return F.when(quiet, written).otherwise(F.array_append(written, day))

    written = F.aggregate("_asked", nothing, decide)
    open_ = days.join(known, "email", "left").select("email", F.explode(written).alias("ds"))
    # Without an address, nothing is known about earlier mail.
    return due.join(open_, ["email", "ds"], "left_semi").unionByName(due.where(F.col("email").isNull()))
