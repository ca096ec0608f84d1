import dataclasses
import datetime as dt

from muster.config import MailingConfig
from muster.plans import approval, matching, scheduling
from muster.sources import schemas
from muster.sources.ledger import Ledger
from muster.sources.scratch import cut
from muster.sources.sample import APPROVAL, INVITE, RUN_TS as SAMPLE_TS
from tests.helpers import DS, RUN_TS, at, plan_of, rows, table, world

CFG = MailingConfig(ds=DS, mailing_name="event_invite")


def day(n):
    return dt.date(2020, 2, n)


def scheduled(spark, *rows_, **defaults):
    defaults = {"mailing_name": "event_invite", "email": "p1@x.org", **defaults}
    return table(spark, "SCHEDULINGS", *rows_, **defaults)


def no_sends(spark):
    return table(spark, "SENDS")


def best(spark, *starts):
    """One person; an event per start, the later ones preferred."""
    kinds = ["CANVASS", "TRAINING", "PHONE_BANK"]
    cfg = dataclasses.replace(CFG, event_types=tuple(kinds))
    events = [dict(id=n, event_type=kinds[n]) for n, _ in enumerate(starts)]
    slots = [dict(id=n, event_id=n, start_date=s) for n, s in enumerate(starts)]
    return scheduling.invite_candidates(cfg, world(spark, events, slots))


def test_better_event_later_waits(spark):
    nobody = scheduled(spark)
    today = scheduling.invite_staging(best(spark, at(15, 20)), nobody, no_sends(spark), CFG)
    assert today.count() == 1
    later = scheduling.invite_staging(best(spark, at(15, 20), at(16, 20)), nobody, no_sends(spark), CFG)
    assert later.count() == 0


def test_quiet_period_edges(spark):
    due = best(spark, at(15, 20)).cache()
    for n, blocked in ((12, True), (10, True), (9, False), (13, False)):
        history = scheduled(spark, dict(ds=day(n)))
        staged = scheduling.outside_quiet_period(due, history, CFG)
        assert (staged.count() == 0) == blocked, n
    other = scheduled(spark, dict(secondary_id=5), dict(mailing_name="x"), dict(email="q@x.org"), ds=day(11))
    assert scheduling.outside_quiet_period(due, other, CFG).count() == 1
    assert "LeftAnti" in plan_of(scheduling.outside_quiet_period(due, other, CFG))


def test_reset_unless_sending_has_begun(spark):
    known = scheduled(spark, dict(ds=DS), dict(ds=day(11)), dict(ds=DS, mailing_name="other"))
    cleared = scheduling.reset_schedulings(known, no_sends(spark), CFG)
    assert cleared.count() == 2
    begun = table(spark, "SENDS", dict(ds=DS, mailing_name="event_invite", email="z@x.org"))
    assert scheduling.reset_schedulings(known, begun, CFG).count() == 3


def ledger_at(spark, folder, *names):
    return Ledger(spark, str(folder)).init(*names)


def test_publishing_twice_equals_once(spark, tmp_path):
    ledger = ledger_at(spark, tmp_path, "event_invite")
    tables = world(spark, [dict(id=1)], [dict(id=1, event_id=1, start_date=at(15, 20))], people=3)
    states = []
    for _ in range(2):
        scheduling.schedule_invites(tables, ledger, CFG, RUN_TS)
        states.append((rows(ledger.schedulings()), rows(ledger.payloads("event_invite"))))
    assert states[0] == states[1] and len(states[0][0]) == 3
    assert ledger.payloads("event_invite").schema == schemas.INVITE_PAYLOAD


def test_a_day_that_became_empty_is_emptied(spark, tmp_path):
    ledger = ledger_at(spark, tmp_path, "event_invite")
    slots = [dict(id=1, event_id=1, start_date=at(15, 20))]
    scheduling.schedule_invites(world(spark, [dict(id=1)], slots), ledger, CFG, RUN_TS)
    assert ledger.schedulings().count() == 1
    gone = world(spark, [dict(id=1, deleted_date=at(11))], slots)
    scheduling.schedule_invites(gone, ledger, CFG, RUN_TS)
    assert ledger.schedulings().count() == 0


def test_schedulings_stay_once_sending_has_begun(spark, tmp_path):
    ledger = ledger_at(spark, tmp_path, "event_invite")
    slots = [dict(id=1, event_id=1, start_date=at(15, 20))]
    tables = world(spark, [dict(id=1)], slots, people=2)
    scheduling.schedule_invites(tables, ledger, CFG, RUN_TS)
    before = rows(ledger.schedulings())
    sent = table(spark, "SENDS", dict(ds=DS, cons_id=1, email="p1@x.org", mailing_name="event_invite"))
    ledger.append_sends(sent, RUN_TS)
    staged = scheduling.schedule_invites(tables, ledger, CFG, RUN_TS + dt.timedelta(hours=1))
    assert staged.count() == 0 and rows(ledger.schedulings()) == before


def test_other_days_and_mailings_are_not_rewritten(spark, tmp_path):
    ledger = ledger_at(spark, tmp_path, "event_invite", "event_approval")
    slots = [dict(id=1, event_id=1, start_date=at(15, 20)), dict(id=2, event_id=1, start_date=at(19, 20))]
    tables = world(spark, [dict(id=1)], slots)
    approving = dataclasses.replace(CFG, mailing_name="event_approval")
    approval.schedule_approvals(tables, ledger, approving, RUN_TS)
    scheduling.schedule_horizon(tables, ledger, CFG, RUN_TS, days=4)
    found = rows(ledger.schedulings(), "mailing_name", "ds", "email")
    # The second slot is on offer from its own lead day on, after the quiet days.
    assert found == [("event_approval", DS, "h@x.org"), ("event_invite", DS, "p1@x.org"),
                     ("event_invite", day(16), "p1@x.org")]


def test_horizon_keeps_the_quiet_period(spark, tmp_path, sample):
    ledger = ledger_at(spark, tmp_path, "event_invite")
    scheduling.schedule_horizon(sample, ledger, INVITE, SAMPLE_TS, days=2)
    days = {}
    for ds, email in rows(ledger.schedulings(), "ds", "email"):
        days.setdefault(email, []).append(ds)
    assert sum(map(len, days.values())) > 50
    for several in days.values():
        several.sort()
        assert all((b - a).days >= INVITE.quiet_period_days for a, b in zip(several, several[1:]))


def day_by_day(tables, schedulings, sends, cfg, days):
    """The invite job for each day in turn, as the horizon must come out."""
    found = []
    for n in range(days + 1):
        today = cfg.on(cfg.ds + dt.timedelta(days=n))
        staged = cut(scheduling.invite_staging(scheduling.invite_candidates(today, tables), schedulings, sends, today))
        found += rows(staged, *COMPARED)
        kept = scheduling.reset_schedulings(schedulings, sends, today)
        schedulings = kept.unionByName(scheduling.as_schedulings(staged, RUN_TS))
    return sorted(found, key=repr)


COMPARED = ("ds", "cons_id", "email", "event_id", "event_url", "distance_to_event", "event_csv_start_times")


def test_horizon_equals_day_by_day(spark, sample):
    known = sample["schedulings"].select(*schemas.SCHEDULINGS.fieldNames())
    # Within the horizon, one day has begun to be sent and the other is replaced.
    emails = [r.email for r in known.where("ds = '2020-02-11' AND cons_id IS NOT NULL").limit(4).collect()]
    planned = scheduled(spark, *[dict(ds=day(n), email=e) for n in (13, 14) for e in emails], dict(ds=day(13), email=None))
    known = known.unionByName(planned)
    sends = sample["sends"].unionByName(table(spark, "SENDS", dict(ds=day(14), mailing_name="event_invite", email="z@x.org")))
    staged = scheduling.plan_horizon(sample, known, sends, INVITE, days=4)
    want = day_by_day(sample, known, sends, INVITE, days=4)
    assert len({r[0] for r in want}) == 5 and len(want) > 60
    assert rows(staged, *COMPARED) == want


def test_who_shares_an_address_is_written_to_on_the_same_days(spark):
    due = spark.createDataFrame(
        [(day(n), i, email) for i, email, days in (
            (1, "a", (12, 13, 15, 18)), (2, "a", (12, 14, 15)), (3, None, (12, 13)), (4, "b", (16, 17, 19, 20)),
            (5, "c", (12,)),
        ) for n in days],
        "ds DATE, cons_id BIGINT, email STRING",
    )
    history = spark.createDataFrame([("b", day(14)), ("b", day(14)), ("c", day(10)), (None, day(12))], "email STRING, ds DATE")
    got = rows(scheduling.after_quiet_days(due, history, CFG), "cons_id", "ds")
    assert got == sorted(
        [(1, day(12)), (2, day(12)), (1, day(15)), (2, day(15)), (1, day(18)), (3, day(12)), (3, day(13)),
         (4, day(17)), (4, day(20))], key=repr)


def test_horizon_matches_places_and_stores_people_once(spark, sample, monkeypatch):
    written = []
    for module in (scheduling, matching):
        monkeypatch.setattr(module, "cut", lambda df: written.append(df.columns) or cut(df))
    searches = []
    search = matching.nearest_within_radius
    monkeypatch.setattr(matching, "nearest_within_radius", lambda *a, **k: searches.append(1) or search(*a, **k))
    scheduling.plan_horizon(sample, sample["schedulings"], sample["sends"], INVITE, days=3)
    people = [columns for columns in written if {"firstname", "latitude"} <= {*columns} and "event_id" not in columns]
    assert len(people) == 1 and len(searches) == 1


def approved(spark, slot=at(20, 20), **event):
    tables = world(spark, [dict(id=1, **event)], [dict(id=1, event_id=1, start_date=slot)])
    cfg = dataclasses.replace(CFG, mailing_name="event_approval")
    return approval.approved_events(cfg, tables)


def test_approval_filters(spark):
    row = approved(spark).first()
    assert (row.email, row.secondary_id, row.cons_id) == ("h@x.org", 1, None)
    assert row.event_start_timestamp_local == "2020-02-20 15:00:00"
    for unfit in (
        dict(location__region=None), dict(location__region="NH"), dict(approval_status="PENDING"),
        dict(created_by_volunteer_host="0"), dict(deleted_date=at(1)),
        dict(reviewed_date=at(12, month=1)), dict(slot=at(12, 4)),
    ):
        assert approved(spark, **unfit).count() == 0, unfit
    assert approved(spark, reviewed_date=at(13, month=1)).count() == 1
    assert approved(spark, slot=at(12, 5)).count() == 1


def test_deleted_timeslots_still_count_as_to_come(spark):
    tables = world(spark, [dict(id=1)], [dict(id=1, event_id=1, start_date=at(20), deleted_date=at(1))])
    cfg = dataclasses.replace(CFG, mailing_name="event_approval")
    assert approval.approved_events(cfg, tables).count() == 1


def test_never_twice_about_one_event(spark):
    once = approved(spark)
    for history, staged in (
        (dict(secondary_id=1, ds=day(1)), 0), (dict(secondary_id=2), 1), (dict(secondary_id=None), 1),
        (dict(secondary_id=1, email="other@x.org"), 1), (dict(secondary_id=1, mailing_name="event_invite"), 1),
    ):
        known = scheduled(spark, {"email": "h@x.org", "mailing_name": "event_approval", **history})
        assert approval.approval_staging(once, known).count() == staged, history


def test_counts_of_the_documented_sample(spark, sample):
    """The measured row counts of the survey, which looked at a fifth of the events."""
    def fifth(df, key):
        return df.where(f"{key} % 10 IN (0, 1)")

    tables = {
        **sample,
        "org_events": fifth(sample["org_events"], "id"),
        "timeslots": fifth(sample["timeslots"], "event_id"),
    }
    found = scheduling.invite_candidates(INVITE, tables)
    total = found.selectExpr("count(*)", "round(sum(distance_to_event), 6)", "sum(event_id)").first()
    assert tuple(total) == (105, 1439.594788, 75033)
    starts = {r[0].day: r[1] for r in found.groupBy("event_start_date").count().collect()}
    assert starts == {15: 48, 16: 30, 17: 27}
    known = sample["schedulings"].where("mailing_name = 'event_invite' AND cons_id % 4 = 0")
    assert scheduling.invite_staging(found, known, sample["sends"], INVITE).count() == 44
    approved = approval.approved_events(APPROVAL, tables)
    mailed = fifth(sample["org_events"], "id").where("id % 20 = 0").selectExpr(
        "creator__email_address AS email", "id AS secondary_id", "'event_approval' AS mailing_name")
    assert (approved.count(), approval.approval_staging(approved, mailed).count()) == (13, 2)


def test_horizon_stores_each_day_by_itself(spark, sample, monkeypatch):
    stored, cut = [], scheduling.cut

    def seen(df):
        stored.append(df)
        return cut(df)

    monkeypatch.setattr(scheduling, "cut", seen)
    scheduling.plan_horizon(sample, sample["schedulings"], sample["sends"], INVITE, 2)
    days = [df for df in stored if "score_event" in df.columns and "cons_id" not in df.columns]
    assert [[str(row.ds) for row in df.select("ds").distinct().collect()] for df in days] == [
        ["2020-02-12"], ["2020-02-13"], ["2020-02-14"]]
