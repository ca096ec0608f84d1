"""Small hand-written tables."""

import datetime as dt

from muster.sources import schemas

ZONE = "America/New_York"
DS = dt.date(2020, 2, 12)
EVENT_DS = dt.date(2020, 2, 15)
RUN_TS = dt.datetime(2020, 2, 12, 9)


def at(day, hour=0, minute=0, month=2):
    return dt.datetime(2020, month, day, hour, minute)


def table(spark, name, *rows, **defaults):
    """Rows given as dicts over the defaults; what is not named is null."""
    schema = schemas.INPUTS.get(name) or getattr(schemas, name)
    full = [{**dict.fromkeys(schema.fieldNames()), **defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in full], schema)


EVENT = dict(
    event_type="CANVASS", timezone=ZONE, visibility="PUBLIC", approval_status="APPROVED",
    is_virtual=0, location__region="FL", location__lat=28.0, location__lon=-81.0,
    location__is_private=0, location__address_line_1="1 Elm St", title="t", summary="s",
    created_by_volunteer_host="1", reviewed_date=at(10), creator__email_address="h@x.org",
)


def world(spark, events, slots, participations=(), people=1, people_at=(28.0, -81.0), zips=()):
    """Tables with the given events and timeslots and some people in Florida."""
    ids = range(1, people + 1)
    empty = lambda name: table(spark, name)
    return {
        "cons_sub": table(spark, "cons_sub", *[dict(cons_id=i, cons_email_id=i) for i in ids],
                          chapter_id=1, isunsub=0),
        "cons_email": table(spark, "cons_email",
                            *[dict(cons_email_id=i, email=f"p{i}@x.org") for i in ids], is_primary=True),
        "cons": table(spark, "cons", *[dict(cons_id=i, firstname="A", lastname="B") for i in ids]),
        "cons_addr": table(spark, "cons_addr", *[dict(cons_id=i) for i in ids], is_primary=1,
                           state_cd="FL", latitude=people_at[0], longitude=people_at[1]),
        "suppressed_isp": empty("suppressed_isp"),
        "suppressed_inactive": empty("suppressed_inactive"),
        "suppressed_seed": empty("suppressed_seed"),
        "zips": table(spark, "zips", *zips),
        "state_abbr": table(spark, "state_abbr", dict(state_abbr="FL", state="Florida")),
        "org_events": table(spark, "org_events", *events, **EVENT),
        "timeslots": table(spark, "timeslots", *slots),
        "participations": table(spark, "participations", *participations),
        "event_tags": table(spark, "event_tags"),
    }


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().toString()
