import datetime as dt
import json
import re
import unicodedata
import urllib.parse
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from muster.functions import responses as answers
from muster.functions import text
from muster.operators import position
from muster.operators.position import with_position
from muster.plans import jobs, sending
from muster.sources import schemas
from muster.sources.ledger import Ledger, current_sends, sequence_number
from tests.helpers import DS, RUN_TS, plan_of, rows, table

KEY = dict(ds=DS, mailing_name="event_invite")
LATER = RUN_TS + dt.timedelta(hours=1)
IDS = ("mailing_recipient_id", "mailing_send_id", "deferred_task_id")


def responses(spark, *answers_):
    return table(spark, "RESPONSES", *[
        dict(KEY, secondary_id=n, email="a@x.org", deferred_task_id=f"t{n}", status=s, body=b)
        for n, (s, b) in enumerate(answers_)])


UNSUB = f"Sorry. {answers.UNSUBSCRIBED_TEXT} a@x.org"
INVAL = f"{answers.INVALID_TEXT}."
BOTH = '{"mailing_recipient_id":"r1","mailing_send_id":"s1"}'


def test_send_answers(spark):
    cases = [
        (200, UNSUB, ("UNSUB", "UNSUB", None)), (503, UNSUB, ("UNSUB", "UNSUB", None)),
        (202, INVAL, ("INVAL", "INVAL", None)), (202, '{"deferred_task_id":"t1"}', ("DEFER", "DEFER", "t1")),
        (503, "busy", ("ERROR", "ERROR", None)), (503, BOTH, ("ERROR", "ERROR", None)),
        (200, BOTH, ("r1", "s1", None)), (200, "oops", ("ERROR", "ERROR", None)),
        (202, "", ("ERROR", "ERROR", None)), (200, None, ("ERROR", "ERROR", None)),
        (202, "accepted", ("PLACE", "PLACE", None)), (200, "{}", ("ERROR", "ERROR", None)),
    ]
    got = sending.classify_send_responses(responses(spark, *[(s, b) for s, b, _ in cases]))
    assert [r[1:] for r in sorted(rows(got, "secondary_id", *IDS))] == [want for *_, want in cases]


def test_deferred_answers(spark):
    cases = [
        (200, UNSUB, ("UNSUB", "UNSUB", None)), (200, INVAL, ("INVAL", "INVAL", None)),
        (200, answers.ALREADY_DELIVERED_TEXT, ("UNKNO", "UNKNO", None)), (200, BOTH, ("r1", "s1", None)),
        (200, '{"mailing_recipient_id":"r1"}', ("ERROR", "ERROR", None)),
        (500, "oops", ("ERROR", "ERROR", None)), (202, "", ("DEFER", "DEFER", "t6")),
        (429, answers.RATE_LIMIT_TEXT, ("DEFER", "DEFER", "t7")),
    ]
    got = sending.classify_deferred_responses(responses(spark, *[(s, b) for s, b, _ in cases]))
    assert [r[1:] for r in sorted(rows(got, "secondary_id", *IDS))] == [want for *_, want in cases]


def test_service_answers(spark):
    got = sending.classify_ses_responses(
        responses(spark, (200, '{"MessageId":"m1","ResponseMetadata":{}}'), (None, None)), "set")
    assert rows(got, *IDS[:2]) == [("ERROR", "ERROR"), ("m1", "set")]


def test_group_answers(spark):
    log = spark.createDataFrame([
        (1, 200, '<?xml version="1.0"?><api><cons_group id="7"><name>n</name></cons_group></api>'),
        (2, 200, "<api><cons_group><id>8</id></cons_group></api>"),
        (3, 409, "A group already exists with id: 9"),
        (4, 200, "<api><errors><error><message>no</message></error></errors></api>"),
        (5, 200, "no xml <"), (6, 200, "<api></api>"),
    ], "n int, status int, body string")
    got = {r.n: (r.group_id, r.error) for r in sending.parse_group_responses(log).collect()}
    assert got == {1: (7, None), 2: (8, None),
                   3: (9, "Status code: 409. Message: A group already exists with id: 9"),
                   4: (None, "no"), 5: (None, None), 6: (None, None)}


def invite(spark, *keys):
    """Schedulings and payloads of the same keys."""
    keyed = [dict(KEY, email="a@x.org", **k) if "email" not in k else dict(KEY, **k) for k in keys]
    return (table(spark, "SCHEDULINGS", *keyed, scheduled_at=RUN_TS),
            table(spark, "INVITE_PAYLOAD", *keyed))


def sent(spark, *keys, code="PLACE", **more):
    return table(spark, "SENDS", *[dict(KEY, email="a@x.org", **k) for k in keys],
                 mailing_id="M", mailing_recipient_id=code, mailing_send_id=code, **more)


def pending(spark, tables, sends):
    return sending.pending_sends(*tables, sends, "event_invite", DS)


def test_null_keys_match(spark):
    one = invite(spark, dict(cons_id=1))
    assert pending(spark, one, sent(spark)).count() == 1
    assert pending(spark, one, sent(spark, dict(cons_id=1))).count() == 0
    assert pending(spark, invite(spark, {}), sent(spark)).count() == 1
    assert "LeftAnti" in plan_of(pending(spark, one, sent(spark)))


def test_two_objects_to_one_address(spark):
    two = invite(spark, dict(secondary_id=1), dict(secondary_id=2))
    assert rows(pending(spark, two, sent(spark, dict(secondary_id=1))), "secondary_id") == [(2,)]


def test_shared_address_is_hidden_by_one_send(spark):
    two = invite(spark, dict(cons_id=1), dict(cons_id=2))
    assert pending(spark, two, sent(spark)).count() == 2
    assert pending(spark, two, sent(spark, dict(cons_id=1))).count() == 0


def test_foreign_addresses_and_missing_payloads_are_not_pending(spark):
    schedulings, payloads = invite(spark, dict(email="ü@x.org"), dict(email="a@x.org"), dict(email="b@x.org"))
    payloads = payloads.where("email <> 'b@x.org'")
    assert rows(pending(spark, (schedulings, payloads), sent(spark)), "email") == [("a@x.org",)]


def test_error_makes_pending_again(spark):
    tables = invite(spark, dict(cons_id=1), dict(cons_id=2, email="b@x.org"))
    placed = sending.placeholder_sends(pending(spark, tables, sent(spark)), "M", DS, RUN_TS)
    log = placed.withColumn("seq", F.lit(sequence_number(RUN_TS)).cast("long"))
    assert pending(spark, tables, current_sends(log)).count() == 0
    outcomes = sending.classify_send_responses(table(
        spark, "RESPONSES", dict(KEY, cons_id=1, email="a@x.org", status=503, body=""),
        dict(KEY, cons_id=2, email="b@x.org", status=202, body='{"deferred_task_id":"t"}')))
    log = sending.apply_outcomes(log, outcomes, schemas.PLACE, LATER)
    current = current_sends(log)
    assert rows(current, "email", *IDS) == [("b@x.org", "DEFER", "DEFER", "t")]
    again = pending(spark, tables, current)
    assert rows(again, "email") == [("a@x.org",)]
    # An outcome only meets a send that waits for it.
    assert sending.resolved_sends(current, outcomes, schemas.PLACE, LATER).count() == 0


def numbered(spark, n):
    frame = spark.range(n).selectExpr(
        "DATE'2020-02-12' ds", "id cons_id", "concat('p', lpad(id, 6, '0')) email",
        "CAST(NULL AS BIGINT) secondary_id", "TIMESTAMP_NTZ'2020-02-12 00:00:00' scheduled_at")
    return frame.orderBy(F.rand(1))


def test_positions_are_global_and_whole(spark):
    frame = numbered(spark, 5000)
    got = with_position(frame, sending.send_order(), 7)
    assert [r[1] for r in sorted(rows(got, "email", "position"))] == list(range(5000))
    one_address = frame.withColumn("email", F.lit("a"))
    got = with_position(one_address, sending.send_order(), 7)
    assert sorted(r[0] for r in rows(got, "position")) == list(range(5000))
    assert with_position(frame.where("false"), sending.send_order()).count() == 0


def ranges_of(monkeypatch, frame, order):
    """What ``with_position`` returns, and the rows of each range that it sorted."""
    stored = []
    keep = position.cut
    monkeypatch.setattr(position, "cut", lambda df: stored.append(keep(df)) or stored[-1])
    result = position.with_position(frame, order)
    (ordered,) = stored
    sizes = ordered.groupBy(F.shiftright("_slot", 33)).count().collect()
    return result, [r["count"] for r in sizes]


@pytest.mark.parametrize("parts", ["3", "64"])
def test_ranges_follow_the_data(spark, monkeypatch, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        _, few = ranges_of(monkeypatch, numbered(spark, 10), sending.send_order())
        assert few == [10]
        many = spark.range(10_000_000).select(F.xxhash64("id").alias("key"), "id")
        result, sizes = ranges_of(monkeypatch, many, [F.asc("key")])
        # About 8 bytes a key and 4 an id, at 16 MB a range.
        assert 5 <= len(sizes) <= 12 and sum(sizes) == 10_000_000
        assert max(sizes) < 1.5 * min(sizes)
        assert result.agg(F.min("position"), F.max("position")).first()[:] == (0, 9_999_999)
        wrong = result.select("position", "key", F.lead("key").over(Window.partitionBy(F.expr("position div 100000")).orderBy("position")).alias("next"))
        assert wrong.where("next < key").isEmpty()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_crowded_address_is_split(spark, monkeypatch):
    monkeypatch.setattr(position, "TASK_BYTES", 20_000)
    crowded = numbered(spark, 30_000).withColumns({"email": F.lit("a"), "cons_id": F.lit(1).cast("long")})
    result, sizes = ranges_of(monkeypatch, crowded, sending.send_order())
    assert len(sizes) > 4 and max(sizes) < 15_000
    assert sorted(r[0] for r in rows(result, "position")) == list(range(30_000))


def test_positions_put_nulls_last(spark):
    frame = table(spark, "SCHEDULINGS", dict(KEY, email="a", secondary_id=None),
                  dict(KEY, email="a", secondary_id=5))
    assert rows(with_position(frame, sending.send_order()), "position", "secondary_id") == [(0, 5), (1, None)]


@pytest.mark.parametrize("limit, size, exact, kept",
                         [(150, 100, False, 200), (150, 200, False, 150), (150, 100, True, 150), (None, 100, False, 450)])
def test_limit_is_met_by_whole_batches(spark, limit, size, exact, kept):
    got = sending.send_batches(numbered(spark, 450), size, limit, exact)
    assert got.count() == kept
    assert got.agg(F.max("batch_index")).first()[0] == min(size, limit or size) - 1


def test_whitelist_comes_before_the_limit(spark):
    listed = spark.createDataFrame([("p000440",), ("p000440",), ("nobody",)], "email string")
    assert rows(sending.send_batches(numbered(spark, 450), 10, 10, whitelist=listed), "email") == [("p000440",)]


def test_override_addresses_take_turns(spark):
    batch = sending.send_batches(numbered(spark, 5), 3)
    got = sending.overridden(batch, ["a+{{n}}@x", "second"])
    assert [r[1] for r in sorted(rows(got, "position", "destination"))] == [
        "a+0@x", "second", "a+2@x", "a+0@x", "second"]


def request_batch(spark):
    frame = table(spark, "INVITE_PAYLOAD", dict(KEY, cons_id=0, email="a@x.org", firstname="ANNE-MARIE",
                                              lastname="O'BRIEN", event_title="50% & more/less ~ *"))
    return sending.send_batches(frame.withColumn("scheduled_at", F.lit(None).cast("timestamp_ntz")), 10)


def test_requests_and_copies(spark):
    made = sending.outbound_requests(request_batch(spark), "M", ["t+{{n}}@x"], ["cc@x"]).collect()
    found = {r.kind: r for r in made}
    assert (found["to"].email, found["cc"].email) == ("t+0@x", "cc@x")
    payload = json.loads(urllib.parse.unquote(found["to"].trigger_values))
    assert payload["subject_prefix"] == "[orig a@x.org] " and payload["email"] == "t+0@x"
    assert (payload["firstname"], payload["lastname"]) == ("Anne-Marie", "O'Brien")
    assert payload["cons_id"] == "" and payload["event_city"] == ""
    assert set(payload) == {*schemas.INVITE_PAYLOAD.fieldNames(), "scheduled_at", "subject_prefix"}
    copy = json.loads(urllib.parse.unquote(found["cc"].trigger_values))
    assert copy["subject_prefix"] == "[orig a@x.org]"
    plain = sending.outbound_requests(request_batch(spark), "M").first()
    assert "subject_prefix" not in urllib.parse.unquote(plain.trigger_values) and plain.email == "a@x.org"


def test_payload_values_keep_their_types(spark):
    frame = table(spark, "INVITE_PAYLOAD", dict(KEY, cons_id=12, email="a@x.org", distance_to_event=Decimal("2.50"),
                                              event_title='say "é"\n'))
    frame = frame.withColumns({"t": F.lit(True), "f": F.lit(False), "n": F.lit(float("nan")),
                               "scheduled_at": F.lit(None).cast("timestamp_ntz")})
    made = sending.outbound_requests(sending.send_batches(frame, 10), "M").first()
    payload = json.loads(urllib.parse.unquote(made.trigger_values))
    assert (payload["cons_id"], payload["distance_to_event"], payload["t"]) == (12, 2.5, True)
    assert (payload["f"], payload["n"], payload["event_title"]) == ("", "", 'say "é"\n')


@pytest.mark.parametrize("body, recipient, send", [
    ('{"mailing_recipient_id":"r"}', "PLACE", "PLACE"),
    ('{"mailing_recipient_id":null,"mailing_send_id":null}', "PLACE", "PLACE"),
    ('{"x":1}', "PLACE", "PLACE"), ("[1]", "PLACE", "PLACE"),
    ("{}", "ERROR", "ERROR"), ("[]", "ERROR", "ERROR"), ("null", "ERROR", "ERROR"), ("", "ERROR", "ERROR"),
    (BOTH + " trailing", "ERROR", "ERROR"), (BOTH + BOTH, "ERROR", "ERROR"), (BOTH[:-1], "ERROR", "ERROR"),
    (" " + BOTH + "\n", "r1", "s1"), (None, "ERROR", "ERROR"),
])
def test_unclear_answers_never_send_twice(spark, body, recipient, send):
    log = table(spark, "RESPONSES", dict(KEY, email="a@x.org", status=200, body=body))
    assert rows(sending.classify_send_responses(log), *IDS[:2]) == [(recipient, send)]


def test_templated_requests(spark):
    row = sending.template_requests(request_batch(spark), "f@x", "r@x", "set", ["o@x"]).first()
    assert json.loads(row.template_data)["subject_prefix"] == "[ override o@x orig a@x.org ]"
    assert (row.to_addresses, row.bcc_addresses, row.template) == (["o@x"], [], "event_invite")


def test_falsy_values_become_blank(spark):
    frame = spark.createDataFrame(
        [(None, 0, 0.0, "", False), (None, 7, float("nan"), "0", True)],
        "n string, i int, d double, s string, b boolean")
    assert rows(sending.massage(frame)) == [("", "", "", "", ""), ("", "7", "", "0", "true")]


def test_url_quoting_is_percent_encoding(spark):
    value = "".join(map(chr, range(32, 127))) + "é😀\n"
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(text.url_quote(F.col("v"))).first()[0] == urllib.parse.quote(value)


@pytest.mark.parametrize("name, repaired", [
    ("anne-marie o'brien", "Anne-Marie O'Brien"), ("JOHN MCDONALD", "John McDonald"),
    ("Mixed case", "Mixed case"), ("MARIA DE", "Maria de"), ("élise über", "Élise Über"),
    ("J. SMITH-JONES", "J. Smith-Jones"), ("JOHN iii", "JOHN iii"), ("HENRY III", "Henry III"),
    ("BOB ", "BOB "), ("JO MACK", "Jo Mack"),
])
def test_name_repair(spark, name, repaired):
    first, _, last = name.partition(" ")
    frame = spark.createDataFrame([(first, last)], "f string, l string")
    fixed = text.repair_names(F.col("f"), F.col("l"))
    assert " ".join(frame.select(*fixed).first()) == repaired


def test_ascii_folding(spark):
    golden = {
        "café ß Øre “hi” 😀": 'cafe ss Ore "hi" ', "plain": "plain", None: None, "": "",
        "Иван Щукин": "Ivan Shchukin", "Павел Жёлтый": "Pavel Zhioltyi", "Παῦλος Θωμᾶς": "Paulos Thomas",
        "€5 £3 ¥2": "EUR5 GBP3 JPY2", "北京": "??", "かたカナばぱ": "katakanabapa", "ｶﾀｶﾅ ﾊﾟ": "katakana ha",
        "½ ﬁ … Ǆ": "1/2 fi ... DZ", "x\u0301\u200by\ue000z": "xyz", "naïve—ŁÓDŹ": "naive--LODZ",
        # Hangul, by arithmetic.
        "한글": "hangeul", "김민수 씨": "gimminsu ssi", "안녕하세요": "annyeonghaseyo", "힣": "hih", "값": "gabs",
        "원의 😀 최": "weonyi  coe",
        # By Unicode names.
        "Հայաստան": "Hayastan", "Երևան": "Erewan", "Գոհար": "Gohar", "Ձյուն": "Dzyown",
        "საქართველო": "sakhartvelo", "ნინო": "nino", "ᲗᲑᲘᲚᲘᲡᲘ": "TBILISI",
        "שלום": "shlvm", "יעקב כהן": "yaqb khn", "צבי־ים": "tsby-ym",
        "محمد": "mhmd", "فاطمة": "fatmt", "شيخ، غزال؟": "shykh, ghzal?", "پاکستان": "pakstan", "مُحَمَّد ـ": "mhmd ",
        "نجيب ١٢٣ ۴۵": "njyb 123 45", "ﻼ": "la",
        "नमस्ते": "nmste", "हिन्दी ॐ।": "hindii om.", "\u095bाकिर": "zaakir", "\u091c\u093cाकिर": "jaakir", "संजय": "snjy", "१२३": "123",
        "বাংলা": "baanlaa", "ਪੰਜਾਬੀ": "pnjaabii", "ગુજરાતી": "gujraatii", "ଓଡ଼ିଆ": "oddiaa", "தமிழ் ௰": "tmilll 10",
        "తెలుగు": "telugu", "ಕನ್ನಡ": "knndd", "മലയാളം": "mlyaalln", "සිංහල": "snhl", "ৰo": "ro",
    }
    frame = spark.createDataFrame(list(enumerate(golden)), "i int, v string")
    got = {r.v: r.folded for r in frame.select("v", text.fold_ascii(F.col("v")).alias("folded")).collect()}
    assert got == golden
    assert "Python" not in plan_of(frame.select(text.fold_ascii(F.col("v"))))


def test_no_letter_of_a_spelled_script_is_lost():
    scripts = r"(ARMENIAN|GEORGIAN|HEBREW|ARABIC|DEVANAGARI|BENGALI|GURMUKHI|GUJARATI|ORIYA|TAMIL|TELUGU|KANNADA|MALAYALAM|SINHALA) "
    spelled = {c: s for c, s in text.ascii_spellings().items() if re.match(scripts + ".*LETTER", unicodedata.name(c, ""))}
    assert len(spelled) > 1000
    assert not [c for c, s in spelled.items() if "?" in s or not s.isascii()]
    # Only what modifies another letter has no spelling of its own.
    assert {unicodedata.category(c) for c, s in spelled.items() if not s} <= {"Lm", "Mn", "Mc", "Cf"}


def test_every_hangul_syllable_is_spelled_as_it_is_named(spark):
    syllables = [chr(c) for c in range(0xAC00, 0xD7A4)]
    frame = spark.createDataFrame([(c,) for c in syllables], "v string")
    got = {r.v: r.s for r in frame.select("v", text.fold_ascii(F.col("v")).alias("s")).collect()}
    assert got == {c: unicodedata.name(c).rsplit(" ", 1)[1].lower() for c in syllables}


def test_status_summary(spark):
    schedulings = table(spark, "SCHEDULINGS", *[dict(KEY, email=e) for e in "abc"])
    sends = table(spark, "SENDS", dict(KEY, email="a", mailing_recipient_id="DEFER"),
                  dict(KEY, email="b", mailing_recipient_id="r1"))
    got = sending.send_status_summary(schedulings, sends, "event_invite", DS)
    assert rows(got, "status", "n") == [("DEFER", 1), ("PENDING", 1), ("SENT", 1)]


def test_sending_through_the_ledger(spark, tmp_path):
    """A day from scheduling to the last answer; no key is both pending and sent."""
    ledger = Ledger(spark, str(tmp_path)).init("event_invite")
    schedulings, payloads = invite(spark, *[dict(cons_id=i, email=f"p{i}@x.org") for i in range(6)])
    ledger.replace_payloads("event_invite", DS, payloads)
    ledger.replace_schedulings("event_invite", DS, ledger.schedulings(), schedulings)

    def run(hour, **options):
        return jobs.prepare_send(ledger, DS, "event_invite", "M", DS,
                                 RUN_TS + dt.timedelta(hours=hour), batch_size=2, **options)

    batch = run(0, limit=3)
    assert rows(batch, "cons_id", "batch", "batch_index") == [(0, 0, 0), (1, 0, 1), (2, 1, 0), (3, 1, 1)]
    log = table(spark, "RESPONSES", *[
        dict(KEY, cons_id=i, email=f"p{i}@x.org", status=s, body=b) for i, (s, b) in enumerate(
            [(202, '{"deferred_task_id":"t0"}'), (503, ""), (200, BOTH)])])
    jobs.record_send_responses(ledger, log, "event_invite", DS, RUN_TS + dt.timedelta(hours=1))
    codes = {r.cons_id: r.mailing_recipient_id for r in ledger.sends().collect()}
    assert codes == {0: "DEFER", 2: "r1", 3: "PLACE"}

    waiting = sending.pending_deferrals(ledger.sends(), "event_invite", DS)
    assert rows(waiting, "cons_id", "deferred_task_id") == [(0, "t0")]
    late = table(spark, "RESPONSES", dict(KEY, cons_id=0, email="p0@x.org", deferred_task_id="t0",
                                         status=200, body="oops"))
    jobs.record_deferred_responses(ledger, late, "event_invite", DS, RUN_TS + dt.timedelta(hours=2))
    assert rows(run(3), "cons_id") == [(0,), (1,), (4,), (5,)]
    assert run(4).count() == 0
    assert rows(ledger.sends(), "cons_id", "mailing_id") == [(i, "M") for i in range(6)]

    before = rows(ledger.sends())
    ledger.compact_sends("event_invite", DS)
    ledger.compact_sends("event_invite", DS + dt.timedelta(days=1))
    assert rows(ledger.sends()) == before
    assert ledger.send_log().count() == len(before)


def test_answers_of_a_day_read_one_folder(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path)).init("event_invite")
    placed = sending.placeholder_sends(invite(spark, dict(cons_id=1))[0], "M", DS, RUN_TS)
    ledger.append_sends(placed, RUN_TS)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = plan_of(sending.of_mailing(ledger.sends(), "event_invite", DS))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    filters = filters.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "= event_invite)" in filters and re.search(r"\(ds#\d+ = 2020-02-12\)", filters)
