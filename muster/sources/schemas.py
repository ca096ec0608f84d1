"""Schemas of the input tables, the ledgers and the payload tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Codes that stand in an id column until a real id is known.
PLACE = "PLACE"  # about to be sent
DEFER = "DEFER"  # accepted, result to be fetched later
ERROR = "ERROR"  # failed, to be retried
UNSUB = "UNSUB"  # address has unsubscribed
INVAL = "INVAL"  # address is not valid
UNKNO = "UNKNO"  # result was fetched before but not stored
PLACE_RECUR = "PLACE_RECUR"  # handed to a recurring mailing
RECURRING_MAILING_ID = "RECUR"
SES_MAILING_ID = "ses"

CODES = (PLACE, DEFER, ERROR, UNSUB, INVAL, UNKNO, PLACE_RECUR)


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "MONEY": T.DecimalType(10, 2),
}


def _schema(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


KEY_FIELDS = (
    "ds DATE, cons_id BIGINT, email STRING, secondary_id BIGINT, mailing_name STRING"
)
KEYS = ("ds", "cons_id", "email", "secondary_id", "mailing_name")

INPUTS = {
    "cons_sub": _schema("cons_id BIGINT, cons_email_id BIGINT, chapter_id INT, isunsub INT"),
    "cons_email": _schema("cons_email_id BIGINT, email STRING, is_primary BOOLEAN"),
    "cons": _schema("cons_id BIGINT, firstname STRING, lastname STRING"),
    "cons_addr": _schema(
        "cons_id BIGINT, is_primary INT, addr1 STRING, city STRING, state_cd STRING,"
        " zip STRING, latitude DOUBLE, longitude DOUBLE"
    ),
    "suppressed_isp": _schema("cons_id BIGINT"),
    "suppressed_inactive": _schema("cons_id BIGINT"),
    "suppressed_seed": _schema("cons_id BIGINT"),
    "zips": _schema("zip STRING, latitude DOUBLE, longitude DOUBLE"),
    "state_abbr": _schema("state_abbr STRING, state STRING"),
    "org_events": _schema(
        "id BIGINT, title STRING, summary STRING, description STRING, event_type STRING,"
        " timezone STRING, visibility STRING, approval_status STRING,"
        " deleted_date TIMESTAMP_NTZ, is_virtual INT, created_by_volunteer_host STRING,"
        " reviewed_date TIMESTAMP_NTZ, location__venue STRING, location__is_private INT,"
        " location__address_line_1 STRING, location__locality STRING,"
        " location__region STRING, location__postal_code STRING, location__lat DOUBLE,"
        " location__lon DOUBLE, organization__state STRING, creator__email_address STRING,"
        " creator__given_name STRING, creator__family_name STRING"
    ),
    "timeslots": _schema(
        "id BIGINT, event_id BIGINT, start_date TIMESTAMP_NTZ, max_attendees INT,"
        " deleted_date TIMESTAMP_NTZ"
    ),
    "participations": _schema("timeslot_id BIGINT, status STRING"),
    "event_tags": _schema("event_id BIGINT, tag_id BIGINT"),
}

SCHEDULINGS = _schema(f"{KEY_FIELDS}, scheduled_at TIMESTAMP_NTZ")

SENDS = _schema(
    f"{KEY_FIELDS}, sent_ds DATE, sent_at TIMESTAMP_NTZ, mailing_id STRING,"
    " mailing_recipient_id STRING, mailing_send_id STRING, deferred_task_id STRING"
)
SEND_COLUMNS = tuple(SENDS.fieldNames())

# The log of send states.  ``seq`` grows with each job run; the row with the
# latest one is the current state of a key, and the code ERROR takes it back.
SEND_LOG = T.StructType([*SENDS.fields, T.StructField("seq", T.LongType())])

INVITE_PAYLOAD = _schema(
    f"{KEY_FIELDS}, cons_city STRING, cons_state STRING, cons_zip STRING,"
    " distance_to_event MONEY, event_url STRING, event_title STRING,"
    " event_summary STRING, event_type STRING, event_venue STRING, event_addr1 STRING,"
    " event_city STRING, event_state STRING, event_zip STRING, event_timezone STRING,"
    " event_start_timestamp_local STRING, payload_prepared_at TIMESTAMP_NTZ,"
    " cons_state_name STRING, firstname STRING, lastname STRING,"
    " event_start_formatted_date_local STRING, event_start_formatted_time_local STRING,"
    " event_start_day_of_week_local STRING, event_formatted_start_times STRING,"
    " event_csv_timeslot_urls STRING, event_csv_start_times STRING"
)

APPROVAL_PAYLOAD = _schema(
    f"{KEY_FIELDS}, firstname STRING, lastname STRING, event_url STRING,"
    " event_dashboard_url STRING, event_visibility STRING, event_title STRING,"
    " event_summary STRING, event_description STRING, event_type STRING,"
    " event_venue STRING, event_addr1 STRING, event_city STRING, event_state STRING,"
    " event_zip STRING, event_timezone STRING, event_start_timestamp_local STRING,"
    " event_reviewed_at TIMESTAMP_NTZ, payload_prepared_at TIMESTAMP_NTZ"
)

# What is kept of one exchange with a delivery service.
RESPONSES = _schema(f"{KEY_FIELDS}, deferred_task_id STRING, status INT, body STRING")


def payload_schema(mailing_name: str) -> T.StructType:
    """Payload schema of a mailing; invite mailings share one under many names."""
    return APPROVAL_PAYLOAD if mailing_name == "event_approval" else INVITE_PAYLOAD


def ledger_schemas() -> dict[str, T.StructType]:
    return {"schedulings": SCHEDULINGS, "send_log": SEND_LOG}
