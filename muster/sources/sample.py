"""The entities of an outreach programme, made from the sample star schema.

Every row of the tables read takes part: all customers are people with an
address, an e-mail and a subscription, all orders are events, all line items
are timeslots and RSVPs, all logged events are answers of the delivery
services.  Remainders only vary the *attributes* of a row, so that every
branch of the pipelines is met.

The SQL is common to Spark and other engines but for the pieces in
``Dialect``; table names are in braces.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import string
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from muster.config import MailingConfig
from muster.functions import responses
from muster.sources.tables import LazyTables, run_sql

BASE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,"
    " c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,"
    " p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,"
    " l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,"
    " value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}
BASE_TABLES = tuple(BASE_SCHEMAS)

DS = dt.date(2020, 2, 12)
RUN_TS = dt.datetime(2020, 2, 12, 9, 0)

INVITE = MailingConfig(
    ds=DS,
    mailing_name="event_invite",
    max_recipients_per_spot=25,
    event_types=("PHONE_BANK", "BARNSTORM", "TRAINING", "CANVASS", "COMMUNITY"),
)
APPROVAL = MailingConfig(
    ds=DS,
    mailing_name="event_approval",
    approval_excluded_states=("R3",),
    approval_lookback_days=(DS - dt.date(1999, 12, 1)).days,
    approved_since=dt.datetime(1999, 12, 1),
)


@dataclasses.dataclass(frozen=True)
class Dialect:
    days_since_1995: str
    plus_minutes: str
    divided: str
    ntz: str


SPARK = Dialect(
    days_since_1995="datediff(CAST({0} AS DATE), DATE '1995-01-01')",
    plus_minutes="timestampadd(MINUTE, CAST({1} AS INT), {0})",
    divided="({0} div {1})",
    ntz="TIMESTAMP_NTZ",
)


def entity_sql(dialect: Dialect) -> dict[str, str]:
    """SQL of each entity over the base tables and the entities before it."""

    def scattered(base: str, step: int, key: str) -> str:
        return f"{base} + CAST(({key} * {step}) % 1000 AS DOUBLE) / 1000"

    def divided(number: str, by: int) -> str:
        return dialect.divided.format(number, by)

    def at(moment: str) -> str:
        return f"CAST('{moment}' AS {dialect.ntz})"

    first = at('2020-02-01 00:00:00')
    days = dialect.days_since_1995.format("l_shipdate")
    minutes = f"(min({days}) % 28) * 1440 + 780 + 60 * (min(l_partkey) % 14)"
    unsubscribed = responses.UNSUBSCRIBED_TEXT
    invalid = responses.INVALID_TEXT
    delivered = responses.ALREADY_DELIVERED_TEXT
    limited = responses.RATE_LIMIT_TEXT
    both_ids = (
        """'{{"mailing_recipient_id": "r' || task || '", "mailing_send_id": "s' || task || '"}}'"""
    )
    return {
        "zips": """
            SELECT lpad(CAST(n_nationkey AS STRING), 5, '0') AS zip,
                   CAST(30.5 AS DOUBLE) + 2 * n_regionkey AS latitude,
                   CAST(-99.5 AS DOUBLE) + 3 * n_regionkey AS longitude
            FROM {nation} WHERE n_nationkey % 5 <> 4""",
        "state_abbr": """
            SELECT 'R' || CAST(r_regionkey AS STRING) AS state_abbr, r_name AS state FROM {region}""",
        "cons": """
            SELECT c_custkey AS cons_id,
                   CASE WHEN c_custkey % 3 = 0 THEN upper(c_mktsegment)
                        ELSE lower(c_mktsegment) END AS firstname,
                   CASE WHEN c_custkey % 3 = 0 THEN upper(c_name)
                        ELSE lower(c_name) END AS lastname
            FROM {customer}""",
        "cons_email": """
            SELECT c_custkey AS cons_email_id,
                   CASE WHEN c_custkey % 23 = 0 THEN 'usér' ELSE 'user' END
                     || CAST(c_custkey AS STRING) || '@example.com' AS email,
                   true AS is_primary
            FROM {customer}""",
        "cons_sub": """
            SELECT c_custkey AS cons_id, c_custkey AS cons_email_id, 1 AS chapter_id,
                   CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS isunsub
            FROM {customer}""",
        "cons_addr": f"""
            SELECT c_custkey AS cons_id, 1 AS is_primary,
                   CAST(c_custkey AS STRING) || ' Main St' AS addr1, n_name AS city,
                   'R' || CAST(n_regionkey AS STRING) AS state_cd,
                   lpad(CAST(n_nationkey AS STRING), 5, '0') AS zip,
                   CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 0
                        ELSE {scattered("30 + 2 * n_regionkey", 7919, "c_custkey")} END AS latitude,
                   CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN 0
                        ELSE {scattered("-100 + 3 * n_regionkey", 104729, "c_custkey")} END AS longitude
            FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
        "suppressed_isp": "SELECT c_custkey AS cons_id FROM {customer} WHERE c_custkey % 13 = 5",
        "suppressed_inactive": "SELECT c_custkey AS cons_id FROM {customer} WHERE c_acctbal < 0",
        "suppressed_seed": "SELECT c_custkey AS cons_id FROM {customer} WHERE c_custkey % 29 = 3",
        "org_events": f"""
            SELECT o_orderkey AS id,
                   'Event ' || CAST(o_orderkey AS STRING) AS title,
                   'Summary of ' || o_orderpriority AS summary,
                   'Priced ' || CAST(CAST(o_totalprice AS BIGINT) AS STRING) AS description,
                   CASE substr(o_orderpriority, 1, 1)
                        WHEN '1' THEN 'PHONE_BANK' WHEN '2' THEN 'BARNSTORM'
                        WHEN '3' THEN 'TRAINING' WHEN '4' THEN 'CANVASS'
                        ELSE 'COMMUNITY' END AS event_type,
                   CASE n_regionkey WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'America/Chicago'
                        WHEN 2 THEN 'America/Denver' WHEN 3 THEN 'America/Los_Angeles'
                        ELSE 'America/Puerto_Rico' END AS timezone,
                   CASE WHEN o_orderkey % 31 = 0 THEN 'PRIVATE' ELSE 'PUBLIC' END AS visibility,
                   CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'APPROVED' END AS approval_status,
                   CAST(NULL AS {dialect.ntz}) AS deleted_date,
                   CASE WHEN o_orderkey % 37 = 0 THEN 1 ELSE 0 END AS is_virtual,
                   CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END AS created_by_volunteer_host,
                   o_orderdate AS reviewed_date,
                   'Venue ' || CAST(o_custkey AS STRING) AS location__venue,
                   CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS location__is_private,
                   CAST(o_orderkey AS STRING) || ' Elm St' AS location__address_line_1,
                   n_name AS location__locality,
                   CASE WHEN o_orderkey % 41 = 0 THEN NULL
                        ELSE 'R' || CAST(n_regionkey AS STRING) END AS location__region,
                   lpad(CAST(c_nationkey AS STRING), 5, '0') AS location__postal_code,
                   CASE WHEN o_orderkey % 43 = 0 THEN NULL
                        ELSE {scattered("30 + 2 * n_regionkey", 6007, "o_orderkey")} END AS location__lat,
                   CASE WHEN o_orderkey % 43 = 0 THEN NULL
                        ELSE {scattered("-100 + 3 * n_regionkey", 3571, "o_orderkey")} END AS location__lon,
                   'R' || CAST(n_regionkey AS STRING) AS organization__state,
                   'host' || CAST(o_custkey AS STRING) || '@example.com' AS creator__email_address,
                   c_mktsegment AS creator__given_name, c_name AS creator__family_name
            FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey
                 JOIN {{nation}} ON c_nationkey = n_nationkey""",
        "timeslots": f"""
            SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS event_id,
                   {dialect.plus_minutes.format(first, minutes)} AS start_date,
                   CASE WHEN l_linenumber = 7 THEN NULL
                        ELSE CAST(min(l_quantity) AS INT) % 5 END AS max_attendees,
                   CASE WHEN (l_orderkey * 10 + l_linenumber) % 47 = 0
                        THEN {at('2020-01-31 00:00:00')} END AS deleted_date
            FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber""",
        "participations": """
            SELECT l_orderkey * 10 + l_linenumber AS timeslot_id,
                   CASE l_returnflag WHEN 'R' THEN 'CANCELLED' WHEN 'N' THEN 'REGISTERED'
                        ELSE 'CONFIRMED' END AS status
            FROM {lineitem}""",
        "event_tags": """
            SELECT p_partkey * 10 AS event_id, CAST(p_size % 3 AS BIGINT) AS tag_id FROM {part}
            UNION ALL
            SELECT p_partkey * 10, CAST(1 AS BIGINT) FROM {part} WHERE p_size % 2 = 0""",
        # Everybody was scheduled on one of seven days; hosts of dearer orders
        # have had their mail.
        "schedulings": f"""
            SELECT DATE '2020-02-11' - CAST(cons_id % 7 AS INT) AS ds,
                   cons_id, email, CAST(NULL AS BIGINT) AS secondary_id,
                   'event_invite' AS mailing_name,
                   {at('2020-02-01 06:00:00')} AS scheduled_at
            FROM {{cons_email}} e JOIN {{cons_sub}} s ON e.cons_email_id = s.cons_email_id
            UNION ALL
            SELECT DATE '2020-02-01', CAST(NULL AS BIGINT), 'host' || CAST(o_custkey AS STRING)
                   || '@example.com', o_orderkey, 'event_approval',
                   {at('2020-02-01 06:00:00')}
            FROM {{orders}} WHERE o_totalprice < 250000""",
        # One market segment is still to be sent.
        "sends": f"""
            SELECT ds, s.cons_id, email, secondary_id, mailing_name, ds AS sent_ds,
                   {at('2020-02-11 08:00:00')} AS sent_at, 'M1' AS mailing_id,
                   code AS mailing_recipient_id, code AS mailing_send_id,
                   CASE WHEN code = 'DEFER' THEN 't' || CAST(s.cons_id AS STRING) END AS deferred_task_id
            FROM {{schedulings}} s JOIN (
                 SELECT c_custkey AS cons_id,
                        CASE {divided("c_custkey", 7)} % 6 WHEN 0 THEN 'PLACE' WHEN 1 THEN 'DEFER'
                             WHEN 2 THEN 'UNSUB' WHEN 3 THEN 'INVAL' WHEN 4 THEN 'UNKNO'
                             ELSE 'r' || CAST(c_custkey AS STRING) END AS code
                 FROM {{customer}} WHERE c_mktsegment <> 'MACHINERY') c ON s.cons_id = c.cons_id""",
        # People of the highest balances have a scheduling without a payload.
        "payloads": f"""
            SELECT ds, s.cons_id, email, secondary_id, mailing_name, city AS cons_city,
                   state_cd AS cons_state, zip AS cons_zip,
                   CAST(CAST(s.cons_id % 26 AS DOUBLE) / 4 AS DECIMAL(10, 2)) AS distance_to_event,
                   'https://events.example.org/event/' || CAST(s.cons_id % 40 AS STRING) || '/' AS event_url,
                   CASE WHEN s.cons_id % 5 = 0 THEN NULL
                        ELSE 'Event ' || CAST(s.cons_id % 40 AS STRING) END AS event_title,
                   CASE s.cons_id % 4 WHEN 0 THEN 'CANVASS' WHEN 1 THEN 'TRAINING'
                        WHEN 2 THEN 'PHONE_BANK' ELSE '' END AS event_type,
                   state_cd AS event_state, firstname, lastname
            FROM {{schedulings}} s
                 JOIN {{cons_addr}} a ON s.cons_id = a.cons_id
                 JOIN {{cons}} n ON s.cons_id = n.cons_id
                 JOIN {{customer}} c ON s.cons_id = c_custkey
            WHERE mailing_name = 'event_invite' AND c_acctbal < 9500""",
        # Every logged event is one message: its request, and its later result.
        "messages": f"""
            SELECT CAST(ts AS DATE) AS ds, user_id AS cons_id,
                   'user' || CAST(user_id AS STRING) || '@example.com' AS email,
                   event_id AS secondary_id, 'event_alert' AS mailing_name,
                   't' || CAST(event_id AS STRING) AS task, event_id, value, props
            FROM {{events}}""",
        # Every kind of answer, also JSON without ids, cut off, doubled and with more behind it.
        "send_responses": f"""
            SELECT ds, cons_id, email, secondary_id, mailing_name,
                   CAST(NULL AS STRING) AS deferred_task_id,
                   CASE WHEN event_id % 12 IN (2, 6) THEN 202 WHEN event_id % 12 = 3 THEN 503
                        ELSE 200 END AS status,
                   CASE event_id % 12
                        WHEN 0 THEN '{unsubscribed} ' || email
                        WHEN 1 THEN 'Error: {invalid}'
                        WHEN 2 THEN '{{{{"deferred_task_id": "' || task || '"}}}}'
                        WHEN 3 THEN props
                        WHEN 4 THEN {both_ids}
                        WHEN 5 THEN 'oops ' || CAST(value AS STRING)
                        WHEN 7 THEN '{{{{"mailing_recipient_id": "r' || task || '"}}}}'
                        WHEN 8 THEN '{{{{"mailing_recipient_id": null, "mailing_send_id": null}}}}'
                        WHEN 9 THEN {both_ids} || ' trailing'
                        WHEN 10 THEN {both_ids} || {both_ids}
                        WHEN 11 THEN '{{{{"mailing_recipient_id": "r' || task
                        ELSE '' END AS body
            FROM {{messages}}""",
        "deferred_responses": f"""
            SELECT ds, cons_id, email, secondary_id, mailing_name, task AS deferred_task_id,
                   CASE WHEN {divided("event_id", 7)} % 8 = 6 THEN 202 ELSE 200 END AS status,
                   CASE {divided("event_id", 7)} % 8
                        WHEN 0 THEN '{unsubscribed} ' || email
                        WHEN 1 THEN 'Error: {invalid}'
                        WHEN 2 THEN '{delivered}.'
                        WHEN 3 THEN '{{{{"mailing_recipient_id": "r' || task
                             || '", "mailing_send_id": "s' || task || '"}}}}'
                        WHEN 4 THEN '{{{{"mailing_recipient_id": "r' || task || '"}}}}'
                        WHEN 5 THEN 'oops ' || props
                        WHEN 6 THEN ''
                        ELSE '{limited}' END AS body
            FROM {{messages}}""",
        "ses_responses": f"""
            SELECT ds, cons_id, email, secondary_id, mailing_name,
                   CAST(NULL AS STRING) AS deferred_task_id, 200 AS status,
                   CASE WHEN value > 10 THEN '{{{{"MessageId": "m' || task || '"}}}}'
                        ELSE NULL END AS body
            FROM {{messages}}""",
    }


def needed(sql: str) -> list[str]:
    return [name for _, name, _, _ in string.Formatter().parse(sql) if name]


def _builder(spark: SparkSession, sql: str):
    return lambda tables: run_sql(spark, sql, **{name: tables[name] for name in needed(sql)})


def _reader(spark: SparkSession, folder: str, name: str):
    reader = spark.read.schema(BASE_SCHEMAS[name])
    return lambda _tables: reader.parquet(f"{folder}/{name}.parquet")


def sample_tables(spark: SparkSession, folder: str) -> Mapping[str, DataFrame]:
    """Entities over the sample tables of a folder, each built when asked for."""
    builders = {name: _reader(spark, folder, name) for name in BASE_TABLES}
    builders.update({name: _builder(spark, sql) for name, sql in entity_sql(SPARK).items()})
    return LazyTables(builders)
