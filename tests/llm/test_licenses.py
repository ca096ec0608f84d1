import re

from hypothesis import given
from hypothesis import strategies as st

from muster.llm import licenses
from muster.llm.automaton import SuffixAutomaton

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    places = [
        (i, label)
        for phrase, label in licenses.BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(places), min(starts, default=None), max(starts, default=None), labels


@given(st.text("ab", max_size=12), st.text("ab", max_size=12), st.text("abc", max_size=14))
def test_matching_statistics(one, two, text):
    automaton = SuffixAutomaton([one, two])
    known = set(one + two)
    got = dict((p, n) for p, _, n in automaton.statistics(text, [i for i, c in enumerate(text) if c in known]))
    for i in range(len(text)):
        longest = max((n for n in range(i + 2) if text[i + 1 - n : i + 1] in one or text[i + 1 - n : i + 1] in two))
        assert got.get(i, 0) == longest


def test_base_columns(edge_docs, small_docs, no_docs, spark):
    more = spark.createDataFrame(
        [
            (100, "CC by, cc BY! general public general public license all rights reserved cc by", "x"),
            (101, "creative all rights; this work is licensed under the gnu General Public License, version 3", "y"),
            (102, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", None),
            (103, "ALL RIGHTS RESERVED" * 1000, None),
        ],
        "doc_id BIGINT, text STRING, spans STRING",
    )
    for docs in (edge_docs, small_docs, more):
        want = sorted(((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
        rows = licenses.scan_licenses(docs).collect()
        got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows]
        assert sorted(got, key=repr) == want
        assert all(0 <= r.score <= 1 for r in rows)
        assert all(set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} for r in rows)
    labels = {r.doc_id: r.labels for r in licenses.scan_licenses(more).collect()}
    assert labels[101] == "gpl,gpl-3.0"
    assert labels[102] == "cc-by,cc-by-nc-4.0,mit"
    assert licenses.scan_licenses(no_docs).count() == 0


def test_spans_cover_templates_with_gaps(spark):
    text = "intro " + licenses.TEMPLATES["bsd"][0].replace("provided that", "provided xx that") + " outro"
    row = licenses.scan_licenses(spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")).first()
    span = row.spans[0]
    assert (row.labels, span.start, span.end) == ("bsd", 1, len(licenses.words_of(text.encode())) - 1)
    assert span.coverage > 0.8


def test_each_notice_is_a_span():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.BASE_PHRASES, licenses.MIN_COVERAGE)
    notice = licenses.TEMPLATES["mit"][1]
    size = len(notice.split())
    for between in (0, 5, 200):
        text = " ".join([notice, *["filler"] * between] * 3)
        spans = [(s["start"], s["end"], s["coverage"]) for s in scanner.row(text.encode())[-1] if s["label"] == "mit"]
        assert spans == [(n * (size + between), n * (size + between) + size, 1.0) for n in range(3)]
