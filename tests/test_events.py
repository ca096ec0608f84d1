import dataclasses
import datetime as dt

from pyspark.sql import functions as F

from muster.config import MailingConfig
from muster.functions import dates
from muster.plans import events, matching
from tests.helpers import DS, EVENT_DS, at, rows, table, world

CFG = MailingConfig(ds=DS, mailing_name="event_invite")


def test_window_length_by_weekday(spark):
    days = [dt.date(2020, 2, 16) + dt.timedelta(days=n) for n in range(7)]
    assert [dates.window_days(d) for d in days] == [3, 3, 2, 5, 4, 3, 3]
    frame = spark.createDataFrame([(d - dt.timedelta(days=3),) for d in days], "ds date")
    got = rows(frame, dates.window_end(F.col("ds"), 3))
    assert got == sorted((d + dt.timedelta(days=n),) for d, n in zip(days, [3, 3, 2, 5, 4, 3, 3]))


def test_config_days():
    assert (CFG.event_ds, CFG.window_end_ds) == (EVENT_DS, dt.date(2020, 2, 18))
    assert (CFG.quiet_start_ds, CFG.approval_start_ds) == (dt.date(2020, 2, 10), dt.date(2020, 1, 13))


def test_day_belongs_to_the_calendar_zone(spark):
    tables = world(spark, [dict(id=1), dict(id=2)],
                   [dict(id=10, event_id=1, start_date=at(16, 4, 30)),
                    dict(id=20, event_id=2, start_date=at(15, 4, 30))])
    got = rows(events.next_timeslots(CFG, tables), "event_id", "start_date")
    assert got == [(1, EVENT_DS)]


def test_only_events_whose_next_slot_is_in_the_window_are_described(spark):
    tables = world(spark, [dict(id=1), dict(id=2), dict(id=3)],
                   [dict(id=10, event_id=1, start_date=at(15, 20)), dict(id=11, event_id=1, start_date=at(18, 20)),
                    dict(id=20, event_id=2, start_date=at(18, 20)), dict(id=30, event_id=3, start_date=at(18, 4, 30))])
    every = rows(events.next_timeslots(CFG, tables), "event_id", "next_timeslot_id", "csv_start_times")
    inside = events.next_timeslots(CFG, tables, (CFG.event_ds, CFG.window_end_ds))
    assert [row[0] for row in every] == [1, 2, 3]
    assert rows(inside, "event_id", "next_timeslot_id", "csv_start_times") == [every[0], every[2]]
    assert rows(events.event_features(CFG, tables), "event_id") == [(1,), (3,)]


def test_timeslots_are_searched_once(spark, tmp_path):
    tables = world(spark, [dict(id=1)], [dict(id=10, event_id=1, start_date=at(15, 20))])
    tables["timeslots"].write.parquet(f"{tmp_path}/timeslots")
    stored = dict(tables, timeslots=spark.read.parquet(f"{tmp_path}/timeslots"))
    found = events.next_timeslots(CFG, stored)
    assert not [f for f in found.inputFiles() if str(tmp_path) in f]
    assert rows(found) == rows(events.next_timeslots(CFG, tables))


def test_utc_range_equals_local_days(spark):
    """The range on the stored column against the local day, over DST changes."""
    hours = [dt.datetime(2020, month, 1) + dt.timedelta(minutes=30 * n)
             for month in (3, 11) for n in range(48 * 20)]
    frame = spark.createDataFrame([(h,) for h in hours], "ts timestamp_ntz")
    for first in (dt.date(2020, 3, 8), dt.date(2020, 11, 1), dt.date(2020, 11, 2)):
        end = first + dt.timedelta(days=4)
        local = dates.day_in_zone(F.col("ts"), "America/New_York")
        inside = dates.starts_within(F.col("ts"), first, end, "America/New_York")
        wrong = frame.where(inside != ((local >= F.lit(first)) & (local < F.lit(end))))
        assert wrong.count() == 0


def texts(spark, slots, zone="America/New_York"):
    tables = world(spark, [dict(id=1, timezone=zone)],
                   [dict(id=n, event_id=1, start_date=s) for n, s in enumerate(slots, 1)])
    return events.next_timeslots(CFG, tables).first()


def test_time_text_of_one_two_and_three_slots(spark):
    one = texts(spark, [at(15, 20)])
    assert one.formatted_start_times == "Saturday, February 15 at 3:00pm"
    two = texts(spark, [at(15, 22), at(15, 20)])
    assert two.formatted_start_times == "Saturday, February 15 at 3:00pm and 5:00pm"
    assert two.csv_start_times == "Saturday at 3:00pm|Saturday at 5:00pm"
    three = texts(spark, [at(15, 18), at(15, 20), at(15, 22)])
    assert three.formatted_start_times == "Saturday, February 15"
    assert three.csv_timeslot_urls.count("|") == 2


def test_slots_of_two_local_days_in_one_calendar_day(spark):
    split = texts(spark, [at(16, 5, 30), at(16, 22)], zone="America/Los_Angeles")
    assert split.formatted_start_times == (
        "Saturday, February 15 at 9:30pm and 2:00pm and Sunday, February 16 at 9:30pm and 2:00pm"
    )


def test_equal_starts_are_ordered_by_id(spark):
    tied = texts(spark, [at(15, 20), at(15, 20)])
    assert tied.next_timeslot_id == 1
    assert tied.csv_timeslot_urls.endswith("timeslot=1|https://events.example.org/event/1/?timeslot=2")


def test_texts_list_four_days_and_no_deleted_slot(spark):
    tables = world(
        spark, [dict(id=1)],
        [dict(id=n, event_id=1, start_date=at(day, 20)) for n, day in enumerate((14, 15, 18, 19), 1)]
        + [dict(id=9, event_id=1, start_date=at(15, 18), deleted_date=at(1))],
    )
    row = events.next_timeslots(CFG, tables).first()
    assert row.next_timeslot_id == 2
    assert row.csv_start_times == "Saturday at 3:00pm|Tuesday at 3:00pm"


def test_rsvps_leave_out_cancelled_and_unknown(spark):
    tables = world(spark, [dict(id=1)], [dict(id=5, event_id=1, start_date=at(15, 20), max_attendees=2)],
                   [dict(timeslot_id=5, status=s) for s in ("CONFIRMED", "CANCELLED", None)])
    assert events.next_timeslots(CFG, tables).first().spots_remaining == 1


def features(spark, cfg=CFG, **event):
    tables = world(spark, [dict(id=1, **event)], [dict(id=5, event_id=1, start_date=at(15, 20))])
    return events.event_features(cfg, tables)


def test_event_filters(spark):
    assert features(spark).count() == 1
    for unfit in (
        dict(visibility="PRIVATE"), dict(approval_status="PENDING"), dict(deleted_date=at(1)),
        dict(event_type="TRAINING"), dict(is_virtual=1), dict(is_virtual=None),
    ):
        assert features(spark, **unfit).count() == 0, unfit
    no_state = dict(location__region=None, organization__state=None)
    assert features(spark, **no_state).count() == 1
    assert features(spark, dataclasses.replace(CFG, state_blacklist=("GA",)), **no_state).count() == 0
    assert features(spark, dataclasses.replace(CFG, state_whitelist=("GA",))).count() == 0


def test_listed_tags_do_not_multiply_an_event(spark):
    tables = world(spark, [dict(id=1), dict(id=2)],
                   [dict(id=i, event_id=i, start_date=at(15, 20)) for i in (1, 2)])
    tables["event_tags"] = table(spark, "event_tags", *[dict(event_id=1, tag_id=t) for t in (1, 2)])
    cfg = dataclasses.replace(CFG, tag_ids=(1, 2))
    assert rows(events.event_features(cfg, tables), "event_id") == [(1,)]


def test_feature_texts(spark):
    row = features(spark, location__is_private=1).first()
    assert row.event_addr1 == ""
    assert row.event_start_timestamp_local == "2020-02-15 15:00:00"
    assert row.event_start_formatted_date_local == "Saturday , February  15, 2020"
    assert row.event_start_formatted_time_local == "03:00 pm"
    assert row.event_start_day_of_week_local == "Saturday "
    assert row.event_url == "https://events.example.org/event/1/?utm_source=email-20200212-event_invite"
    other = features(spark, dataclasses.replace(CFG, mailing_name="gotv")).first()
    assert other.event_url == "https://events.example.org/event/1/"


def test_event_scores(spark):
    frame = spark.createDataFrame(
        [(d, k) for d in (0, 1, 6) for k in ("PHONE_BANK", "TRAINING", "BARNSTORM", "CANVASS")],
        "dayofweek int, event_type string")
    got = {(r.dayofweek, r.event_type): r.score_event for r in events.score_events(frame).collect()}
    assert got[0, "PHONE_BANK"] == 512 and got[1, "PHONE_BANK"] == 256
    assert got[6, "TRAINING"] == 32 and got[1, "BARNSTORM"] == 16 and got[1, "CANVASS"] == 1


def test_spots_decide_about_room(spark):
    frame = spark.createDataFrame(
        [(100, s) for s in (0, -1, None, 3)], "people bigint, spots bigint")
    ratio = matching.recipients_per_spot(F.col("people"), F.col("spots"))
    got = {r.spots: r.ratio for r in frame.withColumn("ratio", ratio).collect()}
    assert got == {0: 1_000_000, -1: -100, None: None, 3: 33}
