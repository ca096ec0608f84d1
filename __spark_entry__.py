"""

Every query runs over whole tables.  Dates, timestamps and decimals are shown
as text or doubles, and doubles rounded to four places, so that two engines can
be compared by value.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle
from muster.functions import dates, geo, text
from muster.plans import (
    approval,
    audience,
    events,
    jobs,
    matching,
    people,
    reporting,
    scheduling,
    sending,
)
from muster.operators.keyed import upsert
from muster.operators.personalization import personalization_long
from muster.sources import ledger as ledgers
from muster.sources import schemas, sinks
from muster.sources.sample import APPROVAL, DS, INVITE, RUN_TS, sample_tables
from muster.sources.scratch import cut, new_folder
from muster.sources.tables import run_sql
from muster.streaming.approval import changed_events, changed_timeslots, mail_approvals

REPORT_FIELDS = ["event_state", "event_url", "event_type"]
RECUR_DAYS = [dt.date(2020, 2, 5) + dt.timedelta(days=n) for n in range(7)]
DEFERRED_TS = RUN_TS + dt.timedelta(hours=2)
SENT_TS = RUN_TS + dt.timedelta(hours=1)
MESSAGES = "event_alert"


def plain(df: DataFrame, *columns: str) -> DataFrame:
    """Columns in types that compare by value in any engine."""
    chosen = []
    for name in columns or df.columns:
        column, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, T.TimestampNTZType):
            column = dates.timestamp_text(column)
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.DoubleType):
            column = F.round(column, 4)
        chosen.append(column.alias(name))
    return df.select(*chosen)


# People, events and matching


def constituents(t, _spark):
    return plain(people.build_constituents(INVITE, t).drop("ds"))


def suppression_anti(t, _spark):
    return people.unsuppressed(t["cons_sub"].select("cons_id", "cons_email_id"), t)


def zip_fallback(t, _spark):
    located = people.with_zip_fallback(t["cons_addr"], t["zips"])
    return plain(located, "cons_id", "zip", "latitude", "longitude")


def rsvp_counts(t, _spark):
    return events.rsvp_counts(t["participations"])


def next_timeslots(t, _spark):
    return plain(
        events.next_timeslots(INVITE, t),
        "next_timeslot_id", "event_id", "start_date", "start_timestamp", "max_attendees",
        "rsvp_count", "spots_remaining",
    )


def timeslot_text(t, _spark):
    return plain(
        events.next_timeslots(INVITE, t),
        "event_id", "formatted_start_times", "csv_timeslot_urls", "csv_start_times",
    )


def event_features(t, _spark):
    return plain(events.event_features(INVITE, t).drop("ds", "event_ds"))


def event_features_by_tag(t, _spark):
    import dataclasses

    cfg = dataclasses.replace(
        INVITE, tag_ids=(1, 2), state_whitelist=("R0", "R1", "R2"), state_blacklist=("R1",)
    )
    return plain(events.event_features(cfg, t), "event_id", "event_type", "event_state")


def scored_events(t):
    return events.score_events(events.event_features(INVITE, t))


def event_scores(t, _spark):
    return plain(scored_events(t), "event_id", "event_type", "dayofweek", "score_event")


def event_window(t, _spark):
    ds, lead = F.col("ds"), INVITE.invite_lead_days
    weekday = dates.sunday_zero_weekday(dates.event_day(ds, lead))
    days = t["orders"].groupBy(F.to_date("o_orderdate").alias("ds")).agg(F.count("*").alias("n"))
    return plain(
        days.select(
            "ds",
            dates.event_day(ds, lead).alias("event_ds"),
            dates.quiet_start(ds, INVITE.quiet_period_days).alias("quiet_start"),
            dates.approval_start(ds, 30).alias("approval_start"),
            weekday.alias("weekday"),
            dates.window_length(weekday).alias("window_length"),
            dates.window_end(ds, lead).alias("window_end"),
            "n",
        )
    )


def haversine(t, _spark):
    """Distance of each event from its host."""
    hosts = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cons_id"))
    homes = t["cons_addr"].select("cons_id", "latitude", "longitude")
    miles = geo.haversine_miles(*[F.col(c) for c in ("latitude", "longitude", "location__lat", "location__lon")])
    joined = t["org_events"].join(hosts, "id").join(homes, "cons_id")
    return plain(joined.select(F.col("id").alias("event_id"), "cons_id", miles.alias("miles")))


def _pairs(t, **join):
    everybody = people.build_constituents(INVITE, t)
    pairs = matching.nearby_pairs(everybody, cut(scored_events(t)), INVITE.radius, **join)
    return plain(pairs, "cons_id", "event_id", "distance_to_event")


def nearby_pairs(t, _spark):
    return _pairs(t)


def nearby_pairs_grid(t, _spark):
    """The same pairs by the join meant for more events than can be broadcast."""
    return _pairs(t, max_broadcast_bytes=0)


def _roomy_pairs(t):
    everybody = people.build_constituents(INVITE, t)
    return matching.capacity_filter(everybody, cut(scored_events(t)), INVITE)


def capacity_filter(t, _spark):
    return plain(
        _roomy_pairs(t),
        "cons_id", "event_id", "cons_count", "recipients_per_available_spots", "distance_to_event",
    )


def score_pairs(t, _spark):
    return plain(matching.score_pairs(_roomy_pairs(t)), "cons_id", "event_id", "score_event_cons")


def best(t):
    return scheduling.invite_candidates(INVITE, t)


def best_event(t, _spark):
    return plain(
        best(t),
        "cons_id", "email", "event_id", "distance_to_event", "score_event", "score_event_cons",
        "event_start_date",
    )


# Scheduling


def staging(t):
    return scheduling.invite_staging(best(t), t["schedulings"], t["sends"], INVITE)


def invite_staging(t, _spark):
    return staging(t).select("cons_id", "email", "event_id")


def payload_upsert(t, _spark):
    rows = staging(t).select("ds", "cons_id", "email", "secondary_id", "mailing_name", "event_url")
    target = t["payloads"].select(*rows.columns)
    done = upsert(target, cut(rows), ledgers.REPLACE_KEYS)
    return plain(done, "ds", "cons_id", "email", "event_url")


def scheduling_upsert(t, _spark):
    rows = cut(scheduling.as_schedulings(staging(t), RUN_TS))
    done = upsert(t["schedulings"], rows, ledgers.REPLACE_KEYS)
    return plain(done, *[k for k in ("ds", "cons_id", "email", "secondary_id", "mailing_name")])


def reset_schedulings(t, _spark):
    cfg = APPROVAL.on(dt.date(2020, 2, 1))
    kept = scheduling.reset_schedulings(t["schedulings"], t["sends"], cfg)
    return plain(kept, "ds", "cons_id", "email", "secondary_id", "mailing_name")


def new_ledger(t, spark):
    """A ledger on files that holds the sample's schedulings."""
    ledger = ledgers.Ledger(spark, new_folder(spark, "ledger")).init("event_invite", "event_approval")
    rows = t["schedulings"].select(*schemas.SCHEDULINGS.fieldNames())
    rows.write.mode("append").partitionBy(*ledgers.LAYOUT).parquet(f"{ledger.root}/schedulings")
    ledger.append_sends(t["sends"], RUN_TS - dt.timedelta(days=1))
    return ledger


def ledger_publish(t, spark):
    """The invite job on a ledger, run twice; the second run changes nothing."""
    ledger = new_ledger(t, spark)
    for _ in range(2):
        scheduling.schedule_invites(t, ledger, INVITE, RUN_TS)
    published = reporting.scheduled_payloads(
        ledger.schedulings(), ledger.payloads("event_invite"), "event_invite", DS
    )
    return plain(
        published,
        "ds", "cons_id", "email", "distance_to_event", "event_url", "event_formatted_start_times",
    )


def _horizon(t, days):
    staged = scheduling.plan_horizon(t, t["schedulings"], t["sends"], INVITE, days)
    return plain(staged, "ds", "cons_id", "email", "event_id", "event_start_date")


def schedule_two_days(t, _spark):
    return _horizon(t, 1)


def schedule_eight_days(t, _spark):
    """Today and the seven days after it."""
    return _horizon(t, 7)


# Approval


def next_timeslot_min(t, _spark):
    return plain(
        approval.first_starts(APPROVAL, t["timeslots"], t["org_events"]),
        "event_id", "start_timestamp", "start_date",
    )


def approved_events(t, _spark):
    return plain(
        approval.approved_events(APPROVAL, t),
        "ds", "email", "secondary_id", "mailing_name", "firstname", "lastname", "event_url",
        "event_dashboard_url", "event_state", "event_start_date", "event_start_timestamp_local",
        "event_reviewed_at",
    )


def approval_staging(t, _spark):
    staged = approval.approval_staging(approval.approved_events(APPROVAL, t), t["schedulings"])
    return staged.select("email", "secondary_id", "event_url")


ARRIVING_ROWS = 250_000  # of a table, written by one task


def _arrived(t, spark, name, batches):
    """The folder of a table that arrives in some batches, and the files of each."""
    folder = new_folder(spark, name)
    rows = t[name].select(*schemas.INPUTS[name].fieldNames())
    files = max(1, -(-rows.count() // (batches * ARRIVING_ROWS)))
    rows.repartition(batches * files).write.parquet(folder)
    return folder, files


def _mailed(ledger):
    mailed = reporting.scheduled_payloads(
        ledger.schedulings(), ledger.payloads("event_approval"), "event_approval", DS
    )
    return mailed.select("email", "secondary_id", "event_url")


def approval_stream(t, spark):
    """All events arrive as files and run through the stream into a ledger."""
    ledger, (folder, files) = new_ledger(t, spark), _arrived(t, spark, "org_events", 2)
    query = mail_approvals(
        changed_events(spark, folder, max_files_per_trigger=files), lambda: t, ledger, APPROVAL,
        new_folder(spark, "progress"), lambda: RUN_TS,
    )
    query.awaitTermination()
    return _mailed(ledger)


def approval_stream_late_timeslots(t, spark):
    """Events arrive in one batch, and their timeslots in three, two of them later."""
    ledger = new_ledger(t, spark)
    arrived, events_at_once = _arrived(t, spark, "org_events", 1)
    slots, slots_at_once = _arrived(t, spark, "timeslots", 3)
    others = {name: table for name, table in t.items() if name not in ("org_events", "timeslots")}
    query = mail_approvals(
        changed_events(spark, arrived, max_files_per_trigger=events_at_once), lambda: others, ledger, APPROVAL,
        new_folder(spark, "progress"), lambda: RUN_TS,
        changed_timeslots(spark, slots, max_files_per_trigger=slots_at_once),
    )
    query.awaitTermination()
    return _mailed(ledger)


# Sending


def pending(t):
    return sending.pending_sends(t["schedulings"], t["payloads"], t["sends"], "event_invite")


def batches(t, **options):
    return sending.send_batches(pending(t), 50, **options)


def pending_sends(t, _spark):
    return plain(
        pending(t),
        "email", "secondary_id", "cons_id", "ds", "event_url", "event_title", "distance_to_event",
        "scheduled_at",
    )


def pending_count(t, _spark):
    return plain(pending(t).groupBy("ds").agg(F.count("*").alias("c")))


def pending_total(t, _spark):
    return sending.count_rows(pending(t))


def deferrals_total(t, _spark):
    return sending.count_rows(sending.pending_deferrals(t["sends"], "event_invite"))


def send_batches(t, _spark):
    return batches(t).select("email", "position", "batch", "batch_index")


def send_batches_limited(t, _spark):
    """The limit of a mailing, met by whole batches."""
    return batches(t, limit=70).select("email", "position", "batch", "batch_index")


def whitelist(t, _spark):
    return batches(t, whitelist=t["messages"]).select("email", "position")


def override_round_robin(t, _spark):
    routed = sending.overridden(batches(t), ["stress+{{n}}@example.net", "second@example.net"])
    return routed.select("email", "position", "destination")


def outbound_requests(t, _spark):
    return sending.outbound_requests(batches(t), "M2", cc=["copy@example.net"])


def template_requests(t, _spark):
    requests = sending.template_requests(
        batches(t), "from@example.org", "reply@example.org", "invites",
        override=["stress+{{n}}@example.net"], bcc=["bcc@example.org"],
    )
    lists = ("to_addresses", "bcc_addresses", "reply_to_addresses")
    return requests.withColumns({name: F.array_join(name, ",") for name in lists})


def placeholder_sends(t, _spark):
    return plain(sending.placeholder_sends(pending(t), "M2", DS, RUN_TS))


IDS = ("secondary_id", "email", "mailing_recipient_id", "mailing_send_id")


def classify_send(t, _spark):
    return sending.classify_send_responses(t["send_responses"]).select(*IDS, "deferred_task_id")


def classify_deferred(t, _spark):
    outcomes = sending.classify_deferred_responses(t["deferred_responses"])
    return outcomes.select(*IDS, "deferred_task_id")


def classify_ses(t, _spark):
    return sending.classify_ses_responses(t["ses_responses"], "invites").select(*IDS)


def apply_outcomes(t, _spark):
    """Every message from placeholder to its last known state."""
    placed = sending.placeholder_sends(t["messages"], "M1", DS, RUN_TS)
    log = placed.withColumn("seq", F.lit(ledgers.sequence_number(RUN_TS)).cast("long"))
    sent = sending.classify_send_responses(t["send_responses"])
    log = cut(sending.apply_outcomes(log, sent, schemas.PLACE, SENT_TS))
    resolved = sending.classify_deferred_responses(t["deferred_responses"])
    log = sending.apply_outcomes(log, resolved, schemas.DEFER, DEFERRED_TS)
    return plain(
        ledgers.current_sends(log),
        *schemas.KEYS, "mailing_recipient_id", "mailing_send_id", "deferred_task_id",
    )


def ledger_sending(t, spark):
    """``apply_outcomes`` through the ledger, whose days are compacted at the end."""
    ledger = ledgers.Ledger(spark, new_folder(spark, "ledger")).init()
    ledger.append_sends(sending.placeholder_sends(t["messages"], "M1", DS, RUN_TS), RUN_TS)
    jobs.record_send_responses(ledger, t["send_responses"], MESSAGES, None, SENT_TS)
    jobs.record_deferred_responses(ledger, t["deferred_responses"], MESSAGES, None, DEFERRED_TS)
    for day in ledger.send_log().select("ds").distinct().collect():
        ledger.compact_sends(MESSAGES, day.ds)
    return plain(
        ledger.sends(),
        *schemas.KEYS, "mailing_recipient_id", "mailing_send_id", "deferred_task_id",
    )


def reset_sends(t, _spark):
    days = [dt.date(2020, 2, 10), dt.date(2020, 2, 11)]
    kept = sending.reset_sends(t["sends"], days, "event_invite", "M1", schemas.PLACE)
    return plain(kept, "ds", "cons_id", "email", "mailing_recipient_id")


def pending_deferrals(t, _spark):
    deferrals = sending.pending_deferrals(t["sends"], "event_invite")
    return plain(
        sending.deferral_batches(deferrals, 50),
        "ds", "cons_id", "email", "deferred_task_id", "position",
    )


def send_status_summary(t, _spark):
    return plain(sending.send_status_summary(t["schedulings"], t["sends"], "event_invite"))


def group_responses(t, _spark):
    """Answers about one group per supplier, in the three forms they take."""
    key = F.col("s_suppkey").cast("string")
    body = (
        F.when(
            F.col("s_acctbal") < 0,
            F.concat(F.lit("<api><errors><error><message>No group "), F.col("s_name"),
                     F.lit("</message></error></errors></api>")),
        )
        .when(F.col("s_nationkey") < 8, F.concat(F.lit("It already exists with id: "), key))
        .when(F.col("s_nationkey") < 16,
              F.concat(F.lit("<api><cons_group><id>"), key, F.lit("</id></cons_group></api>")))
        .otherwise(F.concat(F.lit('<api><cons_group id="'), key, F.lit('"/></api>')))
    )
    log = t["supplier"].select("s_suppkey", F.lit(200).alias("status"), body.alias("body"))
    return sending.parse_group_responses(log).select("s_suppkey", "group_id", "error")


# Reports


def forecast_detail(t, _spark):
    rows = reporting.forecast_detail(
        t["schedulings"], t["payloads"], "event_invite",
        ["ds", "event_state", "event_url", "event_title"],
    )
    return plain(rows)


def forecast_all_time(t, _spark):
    return plain(
        reporting.forecast_all_time(t["schedulings"], t["payloads"], "event_invite", REPORT_FIELDS)
    )


def forecast_by_week(t, _spark):
    return plain(reporting.forecast_by_week(t["schedulings"], t["payloads"], "event_invite"))


def forecast_report(t, spark):
    """The report by day and state, written and read back."""
    folder = new_folder(spark, "report")
    summary = reporting.forecast_all_time(
        t["schedulings"], t["payloads"], "event_invite", ["event_state"]
    )
    sinks.write_report(summary, folder, jobs.SUMMARY_ALL_TIME_TAB)
    return sinks.read_report(
        spark, folder, jobs.SUMMARY_ALL_TIME_TAB, "ds STRING, event_state STRING, cons_count BIGINT"
    )


def event_reach(t, _spark):
    return plain(reporting.event_reach(t["schedulings"], t["payloads"], t["sends"], "event_invite"))


def ad_hoc_sql(t, spark):
    sql = """SELECT a.state_cd, count(*) AS people
             FROM {cons_addr} a JOIN {cons_sub} s ON s.cons_id = a.cons_id
             WHERE s.isunsub = 0 GROUP BY a.state_cd"""
    return run_sql(spark, sql, cons_addr=t["cons_addr"], cons_sub=t["cons_sub"])


# Audiences


AUDIENCE_COLUMNS = ["firstname", "event_title", "event_state"]


def recurring(t):
    recipients = audience.recurring_recipients(
        t["schedulings"], t["payloads"], t["sends"], RECUR_DAYS, "event_invite"
    )
    return audience.recurring_audience(recipients, "event_invite", AUDIENCE_COLUMNS)


def audience_group(t, _spark):
    return recurring(t).group


def audience_map(t, _spark):
    return recurring(t).identity_map


def audience_dataset(t, _spark):
    return recurring(t).dataset


def long_values(t, _spark):
    return personalization_long(recurring(t).dataset, AUDIENCE_COLUMNS, "inv")


def personalization_files(t, spark):
    """The datasets, written and read back under their headers."""
    folder = new_folder(spark, "datasets")
    sinks.write_personalization(cut(recurring(t).dataset), AUDIENCE_COLUMNS, "inv", folder)

    def dataset(column: str) -> DataFrame:
        schema = f"cons_id_event_invite BIGINT, {column} STRING"
        read = sinks.read_personalization(spark, folder, f"inv_{column}", schema)
        return read.withColumnRenamed(column, "value").withColumn("slug", F.lit(f"inv_{column}"))

    return reduce(DataFrame.unionByName, map(dataset, AUDIENCE_COLUMNS))


def identity_map_file(t, spark):
    folder = new_folder(spark, "identities")
    sinks.write_identity_map(recurring(t).identity_map, folder)
    return sinks.read_identity_map(spark, folder, "cons_id BIGINT, cons_id_event_invite BIGINT")


def recipient_group_file(t, spark):
    folder = new_folder(spark, "group")
    sinks.write_recipient_group(recurring(t).group, folder)
    return sinks.read_group(spark, folder)


# Values


def payload_massage(t, _spark):
    columns = ("email", "event_title", "event_type", "distance_to_event", "cons_id")
    return sending.massage(t["payloads"].select(*columns))


def ascii_fold(t, _spark):
    return t["documents"].select("doc_id", text.fold_ascii(F.col("text")).alias("folded"))


def ascii_fold_scripts(t, _spark):
    """Customers' segments written in other scripts, letter for letter, and folded back;
    and Hangul syllables by number."""
    segment = F.lower("c_mktsegment")
    written = [
        t["customer"].select("c_custkey", F.lit(script).alias("script"), F.translate(segment, *letters).alias("text"))
        for script, letters in oracle.SCRIPTS.items()
    ]
    number = F.lpad(F.hex(F.lit(0xAC00) + F.col("c_custkey") % 11172), 4, "0")
    syllable = F.decode(F.unhex(number), "UTF-16BE")
    written.append(t["customer"].select("c_custkey", F.lit("hangul").alias("script"), syllable.alias("text")))
    rows = reduce(DataFrame.unionByName, written)
    return rows.select("c_custkey", "script", text.fold_ascii(F.col("text")).alias("folded"))


def name_case(t, _spark):
    first, last = text.repair_names(F.col("firstname"), F.col("lastname"))
    return t["cons"].select("cons_id", first.alias("firstname"), last.alias("lastname"))


REGISTERED = {
    f.__name__: f
    for f in (
        constituents, suppression_anti, zip_fallback, rsvp_counts, next_timeslots, timeslot_text,
        event_features, event_features_by_tag, event_scores, event_window, haversine, nearby_pairs,
        nearby_pairs_grid, capacity_filter, score_pairs, best_event, invite_staging, payload_upsert,
        scheduling_upsert, reset_schedulings, ledger_publish, schedule_two_days, schedule_eight_days, next_timeslot_min,
        approved_events, approval_staging, approval_stream, approval_stream_late_timeslots, pending_sends, pending_count,
        pending_total, deferrals_total, send_batches, send_batches_limited, whitelist, override_round_robin, outbound_requests, template_requests,
        placeholder_sends, classify_send, classify_deferred, classify_ses, apply_outcomes, ledger_sending,
        reset_sends, pending_deferrals, send_status_summary, group_responses, forecast_detail,
        forecast_all_time, forecast_by_week, forecast_report, event_reach, ad_hoc_sql,
        audience_group, audience_map, audience_dataset, personalization_files,
        identity_map_file, recipient_group_file, payload_massage, ascii_fold, ascii_fold_scripts, name_case,
    )
} | {"personalization_long": long_values}


def _query(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(sample_tables(spark, sf_dir), spark)


try:
    from muster.llm import queries as llm
except ModuleNotFoundError as error:
    if not (error.name or "").startswith(("muster.llm", "corpus_pipeline")):
        raise
    llm = None  # the subpackage has been left out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: _query(build) for name, build in REGISTERED.items()}
    return own | llm.queries() if llm else own


def oracle_sql() -> dict[str, str]:
    own = oracle.oracle_sql()
    return own | llm.oracle_sql() if llm else own


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: which event each person should be invited to."""
    return queries()["best_event"](spark, "/root/testdata/sf0.001")
