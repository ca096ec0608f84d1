"""What is still to be sent, and what became of it."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from muster.functions import dates, text
from muster.functions import responses as answers
from muster.operators.keyed import having, same_key, without
from muster.operators.position import in_batches, with_position
from muster.sources import schemas
from muster.sources.ledger import SEND_KEYS, current_sends, sequence_number

# Fixed value: stands for the number of the message in an override address.
NUMBER_PLACEHOLDER = "{{n}}"

PAYLOAD_KEYS = ("ds", "cons_id", "email", "secondary_id")
SENT_KEYS = ("ds", "email", "secondary_id", "mailing_name")


def of_mailing(rows: DataFrame, mailing_name: str, ds: dt.date | None) -> DataFrame:
    rows = rows.where(F.col("mailing_name") == mailing_name)
    return rows if ds is None else rows.where(F.col("ds") == F.lit(ds))


def with_payloads(schedulings: DataFrame, payloads: DataFrame) -> DataFrame:
    """Schedulings that have a payload, as payload rows with ``scheduled_at``.

    The payload table belongs to one mailing, so its mailing name is not
    compared.
    """
    times = schedulings.select(*PAYLOAD_KEYS, "scheduled_at").alias("l")
    joined = times.join(payloads.alias("r"), same_key("l", "r", PAYLOAD_KEYS))
    return joined.select("l.scheduled_at", "r.*")


def pending_sends(
    schedulings: DataFrame,
    payloads: DataFrame,
    sends: DataFrame,
    mailing_name: str,
    ds: dt.date | None = None,
) -> DataFrame:
    """Schedulings with a payload, an ASCII address and no send yet.

    Of one day, or of all days.
    """
    due = of_mailing(schedulings, mailing_name, ds)
    due = due.where(text.is_plain_address(F.col("email")))
    unsent = without(due, of_mailing(sends, mailing_name, ds), SENT_KEYS)
    if ds is not None:
        payloads = payloads.where(F.col("ds") == F.lit(ds))
    return with_payloads(unsent, payloads)


def count_rows(rows: DataFrame, name: str = "c") -> DataFrame:
    return rows.agg(F.count("*").alias(name))


def send_order(last: str = "scheduled_at") -> list[Column]:
    return [F.asc_nulls_last(name) for name in ("ds", "email", "secondary_id", last, "cons_id")]


def whitelisted(rows: DataFrame, addresses: DataFrame) -> DataFrame:
    """Rows to one of the listed addresses."""
    return having(rows, addresses, ["email"])


def send_batches(
    pending: DataFrame,
    batch_size: int,
    limit: int | None = None,
    exact: bool = False,
    whitelist: DataFrame | None = None,
) -> DataFrame:
    """Pending sends in order, numbered in batches, up to the limit."""
    if whitelist is not None:
        pending = whitelisted(pending, whitelist)
    return in_batches(with_position(pending, send_order()), batch_size, limit, exact)


def placeholder_sends(
    batch: DataFrame,
    mailing_id: str,
    sent_ds: dt.date,
    run_ts: dt.datetime,
    code: str = schemas.PLACE,
) -> DataFrame:
    """Send rows to be stored before anything is sent, so that a run that dies
    half way does not send twice."""
    return batch.select(
        *schemas.KEYS,
        F.lit(sent_ds).alias("sent_ds"),
        dates.utc_literal(run_ts).alias("sent_at"),
        F.lit(mailing_id).alias("mailing_id"),
        F.lit(code).alias("mailing_recipient_id"),
        F.lit(code).alias("mailing_send_id"),
        F.lit(None).cast("string").alias("deferred_task_id"),
    )


def massage(payloads: DataFrame, untouched: Sequence[str] = ()) -> DataFrame:
    """Payload values as text, empty ones as ``''``, names in mixed case."""
    blank = {
        f.name: text.blank_if_falsy(F.col(f.name), f.dataType)
        for f in payloads.schema
        if f.name not in untouched
    }
    massaged = payloads.withColumns(blank)
    if {"firstname", "lastname"} <= set(payloads.columns):
        first, last = text.repair_names(F.col("firstname"), F.col("lastname"))
        massaged = massaged.withColumns({"firstname": first, "lastname": last})
    return massaged


def _destination(override: Sequence[str], address: Column, number: Column) -> Column:
    if not override:
        return address
    listed = F.array(*[F.lit(a) for a in override])
    chosen = F.get(listed, F.pmod(number, F.lit(len(override))))
    return F.replace(chosen, F.lit(NUMBER_PLACEHOLDER), number.cast("string"))


def overridden(batch: DataFrame, override: Sequence[str]) -> DataFrame:
    """Batch rows with the ``destination`` they go to: the override addresses
    in turn, or the real address."""
    return batch.withColumn(
        "destination", _destination(override, F.col("email"), F.col("batch_index"))
    )


NUMBERS = ("position", "batch", "batch_index")


def _json_value(value: Column, kind: T.DataType) -> Column:
    """A value as JSON: numbers and truths bare, anything empty as ``""``."""
    blank = text.blank_if_falsy(value, kind)
    bare = isinstance(kind, (T.NumericType, T.BooleanType))
    if isinstance(kind, T.DecimalType):
        value = value.cast("double")  # a JSON number has no scale
    member = F.to_json(F.struct((value if bare else blank).alias("v")))
    written = F.substring(member, F.lit(len('{"v":') + 1), F.length(member) - len('{"v":}'))
    return F.when(blank == "", F.lit('""')).otherwise(written)


def _requests(batch: DataFrame, override: Sequence[str]) -> DataFrame:
    """Numbers, original address, ``destination`` and the members of the payload in ``p``.

    The payload names the address the mail really goes to, and keeps the types
    of its values.
    """
    routed = overridden(batch, override)
    if {"firstname", "lastname"} <= set(batch.columns):
        first, last = text.repair_names(F.col("firstname"), F.col("lastname"))
        routed = routed.withColumns({"firstname": first, "lastname": last})
    members = [
        F.concat(
            F.lit(f"{json.dumps(field.name)}:"),
            _json_value(F.col("destination" if field.name == "email" else field.name), field.dataType),
        )
        for field in batch.schema
        if field.name not in NUMBERS
    ]
    return routed.select(
        *NUMBERS,
        F.col("email").alias("original_email"),
        "destination",
        "mailing_name",
        F.concat_ws(",", *members).alias("p"),
    )


def _payload_json(prefix: Column | None) -> Column:
    members = [F.col("p")]
    if prefix is not None:
        members.append(F.concat(F.lit('"subject_prefix":'), _json_value(prefix, T.StringType())))
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def outbound_requests(
    batch: DataFrame,
    mailing_id: str,
    override: Sequence[str] = (),
    cc: Sequence[str] = (),
) -> DataFrame:
    """One request per recipient, and one copy of it per cc address."""
    rows = _requests(batch, override)
    original = F.col("original_email")
    own_prefix = F.concat(F.lit("[orig "), original, F.lit("] ")) if override else None
    copy_prefix = F.concat(F.lit("[orig "), original, F.lit("]"))
    request = F.struct(
        F.lit("to").alias("kind"),
        F.col("destination").alias("email"),
        _payload_json(own_prefix).alias("payload"),
    )
    copies = [
        F.struct(
            F.lit("cc").alias("kind"),
            F.lit(address).alias("email"),
            _payload_json(copy_prefix).alias("payload"),
        )
        for address in cc
    ]
    return (
        rows.withColumn("request", F.explode(F.array(request, *copies)))
        .select(
            "position", "batch", "batch_index",
            "original_email",
            "request.kind",
            "request.email",
            F.lit(mailing_id).alias("mailing_id"),
            F.lit(0).alias("email_opt_in"),
            text.url_quote(F.col("request.payload")).alias("trigger_values"),
        )
    )


def template_requests(
    batch: DataFrame,
    from_email: str,
    reply_to_email: str,
    configuration_set_name: str,
    override: Sequence[str] = (),
    bcc: Sequence[str] = (),
) -> DataFrame:
    """One templated request per recipient for the e-mail service."""
    rows = _requests(batch, override)
    prefix = None
    if override:
        prefix = F.concat(
            F.lit("[ override "), F.col("destination"),
            F.lit(" orig "), F.col("original_email"), F.lit(" ]"),
        )
    return rows.select(
        "position", "batch", "batch_index",
        "original_email",
        F.lit(from_email).alias("source"),
        F.array("destination").alias("to_addresses"),
        F.array(*[F.lit(a) for a in bcc]).cast("array<string>").alias("bcc_addresses"),
        F.array(F.lit(reply_to_email)).alias("reply_to_addresses"),
        F.col("mailing_name").alias("template"),
        _payload_json(prefix).alias("template_data"),
        F.lit(configuration_set_name).alias("configuration_set_name"),
    )


def _ids(recipient: Column, send: Column, task: Column | None = None) -> Column:
    task = F.lit(None).cast("string") if task is None else task
    return F.struct(
        recipient.alias("mailing_recipient_id"),
        send.alias("mailing_send_id"),
        task.alias("deferred_task_id"),
    )


def _code(code: str) -> Column:
    return _ids(F.lit(code), F.lit(code))


def _received_ids(body: Column) -> tuple[Column, Column]:
    """Condition that the answer holds both ids, and the ids."""
    recipient = answers.json_field(body, "mailing_recipient_id")
    send = answers.json_field(body, "mailing_send_id")
    return recipient.isNotNull() & send.isNotNull(), _ids(recipient, send)


def classify_send_responses(log: DataFrame) -> DataFrame:
    """Outcome of each answer to a send request; the first rule that fits counts.

    An accepted request whose answer names no task stays at its placeholder,
    and so does one whose answer is JSON that says something but lacks an id:
    it may have been sent, so it must not become pending again.
    """
    status, body = F.col("status"), F.coalesce("body", F.lit(""))
    task = answers.json_field(body, "deferred_task_id")
    have_ids, ids = _received_ids(body)
    accepted = (status == 202) & (body != "")
    outcome = (
        F.when(answers.says(body, answers.UNSUBSCRIBED_TEXT), _code(schemas.UNSUB))
        .when(answers.says(body, answers.INVALID_TEXT), _code(schemas.INVAL))
        .when(accepted & task.isNull(), _code(schemas.PLACE))
        .when(accepted, _ids(F.lit(schemas.DEFER), F.lit(schemas.DEFER), task))
        .when(status == 503, _code(schemas.ERROR))
        .when(have_ids, ids)
        .when(answers.says_something(body), _code(schemas.PLACE))
        .otherwise(_code(schemas.ERROR))
    )
    return log.select(*schemas.KEYS, outcome.alias("outcome")).select(*schemas.KEYS, "outcome.*")


def classify_deferred_responses(log: DataFrame) -> DataFrame:
    """Outcome of each answer about a deferred send.

    "Not ready" and "too many questions" leave the send deferred under its
    task, to be asked for again.
    """
    status, body = F.col("status"), F.coalesce("body", F.lit(""))
    have_ids, ids = _received_ids(body)
    unresolved = (status == 202) | answers.says(body, answers.RATE_LIMIT_TEXT)
    outcome = (
        F.when(unresolved, _ids(F.lit(schemas.DEFER), F.lit(schemas.DEFER), F.col("deferred_task_id")))
        .when(answers.says(body, answers.UNSUBSCRIBED_TEXT), _code(schemas.UNSUB))
        .when(answers.says(body, answers.INVALID_TEXT), _code(schemas.INVAL))
        .when(answers.says(body, answers.ALREADY_DELIVERED_TEXT), _code(schemas.UNKNO))
        .when(have_ids, ids)
        .otherwise(_code(schemas.ERROR))
    )
    return log.select(*schemas.KEYS, outcome.alias("outcome")).select(*schemas.KEYS, "outcome.*")


def classify_ses_responses(log: DataFrame, configuration_set_name: str) -> DataFrame:
    """Outcome of each answer of the e-mail service: its message id or an error."""
    message = answers.json_field(F.col("body"), "MessageId")
    outcome = F.when(
        message.isNotNull(), _ids(message, F.lit(configuration_set_name))
    ).otherwise(_code(schemas.ERROR))
    return log.select(*schemas.KEYS, outcome.alias("outcome")).select(*schemas.KEYS, "outcome.*")


def resolved_sends(
    sends: DataFrame, outcomes: DataFrame, awaiting: str, run_ts: dt.datetime
) -> DataFrame:
    """New states of the sends that wait under the code ``awaiting``."""
    waiting = sends.where(
        (F.col("mailing_recipient_id") == awaiting) & (F.col("mailing_send_id") == awaiting)
    )
    joined = waiting.alias("l").join(outcomes.alias("r"), same_key("l", "r", SEND_KEYS))
    return joined.select(
        *[f"l.{name}" for name in (*schemas.KEYS, "sent_ds")],
        dates.utc_literal(run_ts).alias("sent_at"),
        "l.mailing_id",
        "r.mailing_recipient_id",
        "r.mailing_send_id",
        "r.deferred_task_id",
    )


def apply_outcomes(
    log: DataFrame, outcomes: DataFrame, awaiting: str, run_ts: dt.datetime
) -> DataFrame:
    """Send log with the outcomes added.

    Nothing is deleted: the fold of the log shows a failed send no more, which
    makes its scheduling pending again.
    """
    rows = resolved_sends(current_sends(log), outcomes, awaiting, run_ts)
    stamped = rows.withColumn("seq", F.lit(sequence_number(run_ts)).cast("long"))
    return log.unionByName(stamped)


def matching_sends(
    sends: DataFrame, days: Sequence[dt.date], mailing_name: str, mailing_id: str, code: str
) -> Column:
    """Condition on sends of the days that stand at ``code``; null never fits."""
    fits = (
        F.col("ds").isin(*days)
        & (F.col("mailing_name") == mailing_name)
        & (F.col("mailing_id") == mailing_id)
        & (F.col("mailing_recipient_id") == code)
        & (F.col("mailing_send_id") == code)
    )
    return F.coalesce(fits, F.lit(False))


def reset_sends(
    sends: DataFrame, days: Sequence[dt.date], mailing_name: str, mailing_id: str, code: str
) -> DataFrame:
    """Sends without those of the days that stand at ``code``."""
    return sends.where(~matching_sends(sends, days, mailing_name, mailing_id, code))


def taken_back(
    sends: DataFrame, days: Sequence[dt.date], mailing_name: str, mailing_id: str, code: str
) -> DataFrame:
    """The rows ``reset_sends`` drops, as states to add to the send log."""
    gone = sends.where(matching_sends(sends, days, mailing_name, mailing_id, code))
    return gone.withColumns(
        {name: F.lit(schemas.ERROR) for name in ("mailing_recipient_id", "mailing_send_id")}
    )


def pending_deferrals(
    sends: DataFrame, mailing_name: str, ds: dt.date | None = None
) -> DataFrame:
    """Sends whose result is still to be fetched."""
    return of_mailing(sends, mailing_name, ds).where(
        (F.col("mailing_recipient_id") == schemas.DEFER)
        & (F.col("mailing_send_id") == schemas.DEFER)
    )


def deferral_batches(deferrals: DataFrame, batch_size: int, limit: int | None = None) -> DataFrame:
    return in_batches(with_position(deferrals, send_order("sent_at")), batch_size, limit)


def send_status(recipient: Column) -> Column:
    """Status a send row shows: its code, or that it was delivered."""
    return F.when(recipient.isin(*schemas.CODES), recipient).otherwise(F.lit("SENT"))


def send_status_summary(
    schedulings: DataFrame,
    sends: DataFrame,
    mailing_name: str,
    ds: dt.date | None = None,
) -> DataFrame:
    """Sends per day and status, with what was never sent as PENDING."""
    due = of_mailing(schedulings, mailing_name, ds)
    done = of_mailing(sends, mailing_name, ds)
    statuses = done.select("ds", send_status(F.col("mailing_recipient_id")).alias("status"))
    waiting = without(due, done, SENT_KEYS).select("ds", F.lit("PENDING").alias("status"))
    return (
        statuses.unionByName(waiting)
        .groupBy("ds", "status")
        .agg(F.count("*").alias("n"))
    )


def parse_group_responses(log: DataFrame) -> DataFrame:
    """Id of the recipient group named in an answer, or the error it reports."""
    parsed = answers.group_xml(F.col("body"))
    return (
        log.withColumn("_xml", parsed)
        .withColumn(
            "group_id",
            F.coalesce(
                answers.existing_group_id(F.col("body")),
                F.col("_xml.cons_group._id"),
                F.col("_xml.cons_group.id"),
            ).cast("long"),
        )
        .withColumn(
            "error",
            F.when(
                F.col("status") != 200,
                F.concat(
                    F.lit("Status code: "), F.col("status").cast("string"),
                    F.lit(". Message: "), F.col("body"),
                ),
            ).otherwise(F.col("_xml.errors.error.message")),
        )
        .drop("_xml")
    )
