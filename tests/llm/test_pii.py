import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from muster.llm import pii
from tests.helpers import plan_of


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    )
    found = [
        (m.start(), place, name, m.end())
        for place, (name, pattern, good) in enumerate(kinds)
        for m in re.finditer(pattern, text)
        if good(m[0])
    ]
    return [(name, start, end) for start, _, name, end in sorted(found)]


TEXTS = [
    None, "", "a@b.c", "x a.b+c@d-e.f.gh, _@é.de a@b c@d.e", "a@b.c_d@e.f.g@h.i", "@@a@b.c@d.e",
    "1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 01.002.3.0255 1..2.3.4.5", "1.2.3", "4111 1111 1111 1111",
    "4111-1111-1111-1111 4111 1111 1111 1112 12", "4111  1111 1111 1111 1", "call +1 (212) 555-0100. +44 20 7946 0958 (x)",
    "+1 +123456789012345 +12345678901234567 +1((((((", "ü日本 a@b.de \U0001f600 +49 30 1234567 8", "\n\na@b.c\n",
    "IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432", "GB82WEST12345698765433", "ssn 123-45-6789 or 123-45-6789",
    "number 123-45-6789", "10.0.0.1@x.org 4111111111111111@y.org",
]


def random_texts(count):
    rng = random.Random(5)
    parts = ["a", "@", ".", "b.c", "1", "23", " ", "-", "+", "(", ")", "é", "4111111111111111", "1.2.3.4", "\n"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(count)]


def digests(frame):
    return {
        r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256)
        for r in pii.digest(pii.find_pii(frame)).collect()
    }


def test_base_spans_equal_the_plain_patterns(spark, small_docs):
    texts = [*TEXTS, *random_texts(1500)]
    made = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, spans STRING")
    for frame in (made, small_docs):
        got = digests(frame)
        for row in frame.collect():
            spans = base_spans(row.text or "")
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            counts = [sum(k == n for k, _, _ in spans) for n in ("email", "ip", "card", "phone")]
            assert got[row.doc_id] == (*counts, hashlib.sha256(joined.encode()).hexdigest()), row.text


def test_added_kinds(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id BIGINT, text STRING")
    spans = {TEXTS[r.doc_id]: r.spans for r in pii.digest(pii.find_pii(frame)).collect()}
    assert spans["IBAN DE89 3704 0044 0532 0130 00, GB82WEST12345698765432"] == "iban:5:32,iban:34:56"
    assert spans["GB82WEST12345698765433"] == ""
    assert spans["ssn 123-45-6789 or 123-45-6789"] == "ssn:4:15,ssn:19:30"
    assert spans["number 123-45-6789"] == ""


def test_long_texts_take_linear_time(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a." * 150_000 + "@", "+1 " + "(" * 300_000,
             "a@b" + ".c" * 150_000, "1 " * 150_000, "AB12" * 75_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    got = digests(frame)
    assert [got[i][0] for i in range(8)] == [0, 0, 0, 0, 0, 1, 0, 0]


def test_redact_keeps_columns_and_covers_spans(spark, no_docs):
    rows = [(1, "mail a@b.c or 1.2.3.4!", 7), (2, "10.0.0.1@x.org", 8), (3, None, 9), (4, "", 1), (None, "é +49 30 1234567 8é", 2)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, pii_spans INT")
    got = {r.doc_id: (r.text, r.pii_spans) for r in pii.redact(frame).collect()}
    assert got == {
        1: ("mail [EMAIL] or [IP]!", 7), 2: ("[EMAIL]", 8), 3: (None, 9), 4: ("", 1), None: ("é [PHONE]é", 2),
    }
    assert pii.redact(frame).columns == frame.columns
    assert pii.redact(no_docs).count() == 0


def test_no_python_in_the_plan(small_docs):
    for frame in (pii.digest(pii.find_pii(small_docs)), pii.redact(small_docs)):
        plan = plan_of(frame)
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))


def test_iban_before_a_word(spark):
    ibans = ["ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "DE89 3704 0044 0532 0130 00"]
    after = ("", " Please", " PLEASE", " A", " IN", " 12", ", ok")
    want = {f"to {i}{a}": f"iban:3:{3 + len(i)}" for i in ibans for a in after}
    frame = spark.createDataFrame(list(enumerate(want)), "doc_id BIGINT, text STRING")
    found = pii.find_pii(frame).join(frame, "doc_id").selectExpr("text", "get(spans, 0) AS s", "size(spans) AS n")
    assert {r.text: f"{r.s.kind}:{r.s.start}:{r.s.end}" for r in found.collect() if r.n == 1} == want
