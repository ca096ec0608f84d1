"""Which events can be advertised, and how they are described."""

from __future__ import annotations

import datetime as dt
from collections import ChainMap
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from muster.config import MailingConfig
from muster.functions import dates
from muster.plans.people import in_states
from muster.sources.scratch import cut

# Weights in the score of an event.
WEEKEND_WEIGHT = 2
TYPE_WEIGHTS = {"PHONE_BANK": 256, "BARNSTORM": 16, "TRAINING": 16}
# How the texts about timeslots are put together.
LIST_SEPARATOR = "|"
AND_SEPARATOR = " and "
TIME_PREFIX = " at "
SLOTS_WITHOUT_TIMES = 3
# Ids of slots that are broadcast, about 50 MB as a hash table.
MAX_BROADCAST_SLOTS = 1_000_000


def rsvp_counts(participations: DataFrame) -> DataFrame:
    """RSVPs per timeslot; cancelled ones and those of no status do not count."""
    return (
        participations.where(F.col("status") != "CANCELLED")
        .groupBy("timeslot_id")
        .agg(F.count("*").alias("rsvp_count"))
    )


def _of_slots(participations: DataFrame, slots: DataFrame) -> DataFrame:
    """Participations in the slots, so that the RSVPs of all other days aren't
    counted and moved; without the filter beyond so many slots, when counting
    before moving is cheaper than moving to filter.  ``slots`` are stored."""
    wanted = slots.select(F.col("id").alias("timeslot_id"))
    if wanted.count() > MAX_BROADCAST_SLOTS:
        return participations
    return participations.join(F.broadcast(wanted), "timeslot_id", "left_semi")


def next_timeslots(
    cfg: MailingConfig,
    tables: Mapping[str, DataFrame],
    next_on: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Next timeslot of each event in the showcase days, and texts on all of them.

    Days are days of the calendar zone; texts are in the zone of the event.
    ``next_on``, a first day and the day after the last: only events whose next
    timeslot is on these days; for others no texts are made.
    """
    # Read twice, and to be found among all timeslots.
    upcoming = cut(
        tables["timeslots"]
        .where(
            F.col("deleted_date").isNull()
            & dates.starts_within(
                F.col("start_date"), cfg.event_ds, cfg.showcase_end_ds, cfg.calendar_zone
            )
        )
        .select("id", "event_id", "start_date", "max_attendees")
    )
    # RSVPs are counted before they move and meet slots while those are narrow;
    # from the join with the events on, everything stays partitioned by event.
    rsvps = rsvp_counts(_of_slots(tables["participations"], upcoming)).withColumnRenamed("timeslot_id", "id")
    zones = tables["org_events"].select(F.col("id").alias("event_id"), "timezone")
    slots = upcoming.join(rsvps, "id", "left").join(zones, "event_id")
    if next_on:
        # The join has brought an event's slots together, in order: this moves nothing.
        first = F.min("start_date").over(Window.partitionBy("event_id"))
        next_day, (first_day, end) = F.col("_next_day"), next_on
        slots = (
            slots.withColumn("_next_day", dates.day_in_zone(first, cfg.calendar_zone))
            .where((next_day >= F.lit(first_day)) & (next_day < F.lit(end)))
            .drop("_next_day")
        )
    slot = F.col("first_slot")
    spots = slot["max_attendees"] - F.coalesce(slot["rsvp_count"], F.lit(0).cast("long"))
    return _describe(_slot_texts(cfg, slots)).select(
        F.lit(cfg.ds).alias("ds"),
        F.lit(cfg.event_ds).alias("event_ds"),
        slot["id"].alias("next_timeslot_id"),
        "event_id",
        dates.day_in_zone(slot["start"], cfg.calendar_zone).alias("start_date"),
        slot["start"].alias("start_timestamp"),
        slot["max_attendees"].alias("max_attendees"),
        slot["rsvp_count"].alias("rsvp_count"),
        spots.alias("spots_remaining"),
        "formatted_start_times", "csv_timeslot_urls", "csv_start_times",
    )


def _slot_texts(cfg: MailingConfig, slots: DataFrame) -> DataFrame:
    local = dates.in_zone(F.col("start_date"), F.col("timezone"))
    weekday, clock = dates.weekday_text(local), dates.short_clock_text(local)
    url = F.concat(
        F.lit(f"{cfg.base_url}/event/"), F.col("event_id").cast("string"),
        F.lit("/?timeslot="), F.col("id").cast("string"),
    )
    return slots.select(
        "event_id",
        dates.day_in_zone(F.col("start_date"), cfg.calendar_zone).alias("day"),
        F.struct(
            F.col("start_date").alias("start"),
            "id",
            "max_attendees",
            "rsvp_count",
            url.alias("url"),
            F.concat(weekday, F.lit(TIME_PREFIX), clock).alias("weekday_at"),
            clock.alias("clock"),
            dates.day_text(local).alias("local_day"),
        ).alias("slot"),
    )


def _listed(array: Column, text, separator: str) -> Column:
    return F.array_join(F.transform(array, text), separator)


def _listed_once(array: Column, text, separator: str) -> Column:
    """As ``_listed``, each text only at its first place."""
    return F.array_join(F.array_distinct(F.transform(array, text)), separator)


def _describe(texts: DataFrame) -> DataFrame:
    """First slot and text lists per event.

    Slots are ordered by (start, id), so equal starts leave no choice.  Two
    steps, day and then event, keep every array as short as what it prints.
    """
    slots = F.col("slots")
    times = F.when(
        F.size(slots) < SLOTS_WITHOUT_TIMES,
        F.concat(F.lit(TIME_PREFIX), _listed(slots, lambda s: s["clock"], AND_SEPARATOR)),
    ).otherwise(F.lit(""))
    by_day = (
        texts.groupBy("event_id", "day")
        .agg(F.sort_array(F.collect_list("slot")).alias("slots"))
        .withColumn("times", times)
        .select(
            "event_id",
            F.struct(
                slots[0].alias("first_slot"),
                _listed(slots, lambda s: s["url"], LIST_SEPARATOR).alias("urls"),
                _listed(slots, lambda s: s["weekday_at"], LIST_SEPARATOR).alias("start_times"),
                F.array_distinct(
                    F.transform(slots, lambda s: F.concat(s["local_day"], F.col("times")))
                ).alias("synopses"),
            ).alias("day"),
        )
    )
    days = F.col("days")
    synopses = F.array_distinct(F.flatten(F.transform(days, lambda d: d["synopses"])))
    return (
        by_day.groupBy("event_id")
        .agg(F.sort_array(F.collect_list("day")).alias("days"))
        .select(
            "event_id",
            days[0]["first_slot"].alias("first_slot"),
            F.array_join(synopses, AND_SEPARATOR).alias("formatted_start_times"),
            _listed_once(days, lambda d: d["urls"], LIST_SEPARATOR).alias("csv_timeslot_urls"),
            _listed_once(days, lambda d: d["start_times"], LIST_SEPARATOR).alias("csv_start_times"),
        )
    )


def advertisable(cfg: MailingConfig, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Public, approved, physical events of a wanted type, state and tag."""
    events = tables["org_events"].where(
        (F.col("visibility") == "PUBLIC")
        & (F.col("approval_status") == "APPROVED")
        & F.col("deleted_date").isNull()
        & F.col("event_type").isin(*cfg.event_types)
        & (F.col("is_virtual") != 1)
        & in_states(F.coalesce("location__region", "organization__state"), cfg)
    )
    if cfg.tag_ids:
        tagged = tables["event_tags"].where(F.col("tag_id").isin(*cfg.tag_ids))
        tagged = tagged.select(F.col("event_id").alias("id"))
        events = events.join(tagged, "id", "left_semi")
    return events


def event_url(cfg: MailingConfig, event_id: Column) -> Column:
    """Link to an event; the plain invite mailing adds the day for tracking."""
    tracking = ""
    if cfg.mailing_name == "event_invite":
        tracking = f"?utm_source=email-{cfg.ds:%Y%m%d}-{cfg.mailing_name}"
    return F.concat(
        F.lit(f"{cfg.base_url}/event/"), event_id.cast("string"), F.lit(f"/{tracking}")
    )


def event_features(
    cfg: MailingConfig,
    tables: Mapping[str, DataFrame],
    next_slots: DataFrame | None = None,
) -> DataFrame:
    """Advertisable events that start in the event window, described."""
    events = advertisable(cfg, tables)
    if next_slots is None:
        # Only what can be advertised, and starts in the window, needs texts.
        days = cfg.event_ds, cfg.window_end_ds
        next_slots = next_timeslots(cfg, ChainMap({"org_events": events}, tables), days)
    starting = next_slots.where(
        (F.col("start_date") >= F.lit(cfg.event_ds))
        & (F.col("start_date") < F.lit(cfg.window_end_ds))
    ).select(
        F.col("event_id").alias("id"),
        F.col("start_date").alias("event_start_date"),
        "start_timestamp", "spots_remaining", "formatted_start_times",
        "csv_timeslot_urls", "csv_start_times",
    )
    centres = tables["zips"].select(
        F.col("zip").alias("location__postal_code"),
        F.col("latitude").alias("_zip_lat"),
        F.col("longitude").alias("_zip_lon"),
    )
    local = dates.in_zone(F.col("start_timestamp"), F.col("timezone"))
    shown_address = F.when(F.col("location__is_private") == 1, F.lit("")).otherwise(
        F.col("location__address_line_1")
    )
    return (
        events.join(starting, "id")
        .join(centres, "location__postal_code", "left")
        .select(
            F.lit(cfg.ds).alias("ds"),
            F.lit(cfg.event_ds).alias("event_ds"),
            F.col("id").alias("event_id"),
            event_url(cfg, F.col("id")).alias("event_url"),
            F.col("title").alias("event_title"),
            F.col("summary").alias("event_summary"),
            "event_type",
            F.col("location__venue").alias("event_venue"),
            shown_address.alias("event_addr1"),
            F.col("location__locality").alias("event_city"),
            F.coalesce("location__region", "organization__state").alias("event_state"),
            F.col("location__postal_code").alias("event_zip"),
            F.coalesce("location__lat", "_zip_lat").alias("event_latitude"),
            F.coalesce("location__lon", "_zip_lon").alias("event_longitude"),
            F.col("timezone").alias("event_timezone"),
            "event_start_date",
            dates.timestamp_text(local).alias("event_start_timestamp_local"),
            dates.padded_date_text(local).alias("event_start_formatted_date_local"),
            dates.clock_text(local).alias("event_start_formatted_time_local"),
            dates.padded_weekday_text(local).alias("event_start_day_of_week_local"),
            dates.sunday_zero_weekday(F.col("event_start_date")).alias("dayofweek"),
            F.col("spots_remaining").alias("event_spots_remaining"),
            F.col("formatted_start_times").alias("event_formatted_start_times"),
            F.col("csv_timeslot_urls").alias("event_csv_timeslot_urls"),
            F.col("csv_start_times").alias("event_csv_start_times"),
        )
    )


def score_events(features: DataFrame) -> DataFrame:
    """Events with their own part of the score."""
    day_weight = F.when(F.col("dayofweek").isin(0, 6), WEEKEND_WEIGHT).otherwise(1)
    type_weight = F.lit(1)
    for kind, weight in TYPE_WEIGHTS.items():
        type_weight = F.when(F.col("event_type") == kind, weight).otherwise(type_weight)
    return features.withColumn("score_event", day_weight * type_weight)
