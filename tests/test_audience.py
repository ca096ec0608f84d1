import datetime as dt
import gzip

import pytest

from muster.operators.personalization import personalization_long
from muster.plans import audience, jobs, reporting
from muster.sources import schemas, sinks
from muster.sources.ledger import Ledger
from tests.helpers import DS, RUN_TS, rows, table

KEY = dict(ds=DS, mailing_name="event_invite")
NEXT = DS + dt.timedelta(days=1)


def invite(spark, *keys):
    keyed = [dict(KEY, **k) for k in keys]
    plain = [{k: v for k, v in row.items() if k in schemas.KEYS} for row in keyed]
    return table(spark, "SCHEDULINGS", *plain, scheduled_at=RUN_TS), table(spark, "INVITE_PAYLOAD", *keyed)


def recipients(spark, tables, days=(DS,), sends=None, **options):
    sends = table(spark, "SENDS") if sends is None else sends
    return audience.recurring_recipients(*tables, sends, days, "event_invite", **options)


def test_dataset_keeps_the_first_row_of_a_person(spark):
    tables = invite(spark, dict(cons_id=1, email="b@x", event_title="two"),
                    dict(cons_id=1, email="a@x", event_title="oné"), dict(cons_id=2, email="c@x"))
    made = audience.recurring_audience(recipients(spark, tables), "event_invite", ["event_title"])
    assert rows(made.group) == [(1,), (1,), (2,)]
    assert rows(made.identity_map) == [(1, 1), (1, 1), (2, 2)]
    assert made.identity_map.columns == ["cons_id", "cons_id_event_invite"]
    assert rows(made.dataset) == [(1, "one"), (2, None)]


def test_days_count_in_the_listed_order(spark):
    tables = invite(spark, dict(cons_id=1, email="a@x", event_title="today"),
                    dict(cons_id=1, email="a@x", ds=NEXT, event_title="tomorrow"))
    for days, title in (((DS, NEXT), "today"), ((NEXT, DS), "tomorrow"), ((NEXT,), "tomorrow")):
        made = audience.recurring_audience(recipients(spark, tables, days), "event_invite", ["event_title"])
        assert rows(made.dataset, "event_title") == [(title,)]


def test_limit_is_global_and_in_order(spark):
    tables = invite(spark, *[dict(cons_id=i, email=f"{i}@x", ds=ds) for i in range(4) for ds in (DS, NEXT)])
    got = recipients(spark, tables, (NEXT, DS), limit=5, batch_size=2)
    assert rows(got, "ds").count((NEXT,)) == 4 and got.count() == 6


def test_recurring_job_can_be_repeated(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path)).init("event_invite")
    schedulings, payloads = invite(spark, dict(cons_id=1, email="a@x"), dict(cons_id=2, email="b@x"))
    ledger.replace_payloads("event_invite", DS, payloads)
    ledger.replace_schedulings("event_invite", DS, ledger.schedulings(), schedulings)
    ledger.append_sends(table(spark, "SENDS", dict(KEY, cons_id=2, email="b@x", mailing_recipient_id="r")), RUN_TS)
    for hour in (1, 2):
        made = audience.prepare_recurring(
            ledger, [DS], "event_invite", ["event_title"], DS, RUN_TS + dt.timedelta(hours=hour))
        assert rows(made.group) == [(1,)]
        assert rows(ledger.sends(), "cons_id", "mailing_id", "mailing_recipient_id") == [
            (1, "RECUR", "PLACE_RECUR"), (2, None, "r")]


def test_long_slug_is_refused_before_any_write(spark, tmp_path):
    frame = spark.createDataFrame([(1, "x")], ["cons_id_m", "c" * 26])
    sinks.write_personalization(frame, ["c" * 26], "pre", str(tmp_path / "ok"))
    with pytest.raises(ValueError):
        sinks.write_personalization(frame, ["c" * 26], "long", str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
    files = list((tmp_path / "ok").glob("*/*.csv.gz"))
    assert files and {f.parent.name for f in files} == {"pre_" + "c" * 26}
    assert {gzip.open(f, "rt").readline() for f in files} == {f"cons_id_m,{'c' * 26}\n"}


def test_long_form(spark):
    frame = spark.createDataFrame([(1, "x", 2.5), (2, None, None)], "cons_id_m int, a string, b double")
    assert rows(personalization_long(frame, ["a", "b"], "p")) == [
        (1, "p_a", "x"), (1, "p_b", "2.5"), (2, "p_a", None), (2, "p_b", None)]


def test_group_file_is_replaced_and_blank_lines_hold_nobody(spark, tmp_path):
    path = str(tmp_path / "group")
    for ids in ([1, 2], [3], []):
        sinks.write_recipient_group(spark.createDataFrame([(i,) for i in ids], "cons_id bigint"), path)
        assert rows(sinks.read_group(spark, path)) == [(str(i),) for i in ids]
    (tmp_path / "text").write_text("\n 5 \n\n6\n  \n")
    assert rows(sinks.read_group(spark, str(tmp_path / "text"))) == [("5",), ("6",)]


def test_reports(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger")).init("event_invite")
    schedulings, payloads = invite(
        spark, dict(cons_id=1, email="a@x", event_state="FL"), dict(cons_id=2, email="b@x", event_state="FL"))
    out = str(tmp_path / "out")
    assert not jobs.forecast(ledger, DS, "event_invite", ["event_state"], out, "today", 10)
    assert not (tmp_path / "out" / "today").exists()
    ledger.replace_payloads("event_invite", DS, payloads)
    ledger.replace_schedulings("event_invite", DS, ledger.schedulings(), schedulings)
    assert jobs.forecast(ledger, DS, "event_invite", ["event_state"], out, "today", 1)
    assert rows(sinks.read_report(spark, out, "today", "email STRING, s STRING")) == [("a@x", "FL")]
    assert not jobs.summarize_all_time(ledger, "event_invite", [], out)
    assert jobs.summarize_all_time(ledger, "event_invite", ["event_state"], out)
    weeks = sinks.read_report(spark, out, jobs.SUMMARY_BY_WEEK_TAB, "w STRING, n INT")
    assert rows(weeks) == [("2020-02-10", 2)]


def test_reach_splits_sent_and_to_come(spark):
    tables = invite(spark, *[dict(cons_id=i, email=f"{i}@x", event_url="u") for i in range(3)])
    sends = table(spark, "SENDS", dict(KEY, cons_id=0, email="0@x"), dict(KEY, cons_id=9, email="9@x"))
    got = reporting.event_reach(*tables, sends, "event_invite")
    assert rows(got, "event_url", "invited", "to_invite") == [("u", 1, 2)]
    assert reporting.forecast_all_time(*tables, "event_invite", []) is None
