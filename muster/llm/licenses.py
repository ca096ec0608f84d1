"""Licence scan: matching statistics of texts against licence templates.

A generalised suffix automaton holds the words of all templates.  Each text is
streamed through it once; the longest template factor ending at each word is
its matching statistic.  Factors of ``MIN_MATCH`` words or more that cannot be
extended are chained, in template order, into spans, and a span that covers
enough of a template gives its label; a notice that stands twice is two spans.  Places of the base phrases are read off
the same statistics: a phrase stands where its state is a suffix of the match.

The automaton has a few hundred states whatever the data; each task streams its
own texts, so nothing is shuffled and memory is one batch.  A null text counts
as empty; an empty text has no words, no labels and score 0.  Repeated rows and
null ids each give their own row.  Columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.automaton import SuffixAutomaton
from muster.llm.frames import id_and_text, utf8

# Phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Statements and openings of public licence notices, as words.
TEMPLATES = {
    "apache-2.0": (
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in "
        "compliance with the license you may obtain a copy of the license at",
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met",
    ),
    "cc-by-4.0": ("this work is licensed under a creative commons attribution 4 0 international license",),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0",),
    "gpl-3.0": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation either version 3",
    ),
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction",
    ),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "no-warranty": ("the software is provided as is without warranty of any kind express or implied",),
}

MIN_MATCH = 4  # words of a factor that counts for a chain
MAX_GAP = 32  # words of text between two factors of one chain
MIN_COVERAGE = 0.5  # of a template's words, for its label

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_TO_WORDS = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)

SCHEMA = """doc_id BIGINT, n_words BIGINT, n_base BIGINT, first_word BIGINT, last_word BIGINT,
    base_labels STRING, labels STRING, score DOUBLE,
    spans ARRAY<STRUCT<label: STRING, start: BIGINT, end: BIGINT, coverage: DOUBLE>>"""


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters and digits, and of any character outside ASCII, A-Z in lower case."""
    return text.translate(_TO_WORDS).split()


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]], phrases: dict[str, str], min_coverage: float):
        self.names = [label for label, texts in templates.items() for _ in texts]
        bodies = [words_of(t.encode()) for texts in templates.values() for t in texts]
        parts = [words_of(p.encode()) for p in phrases]
        self.sizes = [len(b) for b in bodies]
        self.automaton = SuffixAutomaton(bodies + parts)
        self.known = {w for b in bodies + parts for w in b}
        self.min_coverage = min_coverage
        states = {self.automaton.state_of(p): (len(p), label) for p, label in zip(parts, phrases.values())}
        # For each state, the phrases that are a suffix of its factors.
        self.phrases_at = [
            [states[s] for s in self.automaton.suffix_states(v) if s in states]
            for v in range(len(self.automaton.link))
        ]

    def scan(self, text: bytes):
        """(words, base places as (start, label), spans as (label, start, end, coverage))."""
        words = words_of(text)
        places = [i for i, w in enumerate(words) if w in self.known]
        base: list[tuple[int, str]] = []
        chains: dict[int, list] = {}
        best: dict[int, tuple] = {}
        closed: set[tuple] = set()
        held = None  # the longest factor so far of which the next may be an extension
        for place, state, length in self.automaton.statistics(words, places):
            for size, label in self.phrases_at[state]:
                if length >= size:
                    base.append((place + 1 - size, label))
            if held and not (place == held[0] + 1 and length == held[2] + 1):
                self._chain(chains, best, closed, *held)
            held = (place, state, length)
        if held:
            self._chain(chains, best, closed, *held)
        for number, chain in chains.items():
            self._close(closed, number, chain)
        closed |= {(t, *b) for t, b in best.items()}
        spans = sorted((self.names[t], s, e, c / self.sizes[t]) for t, c, s, e in closed)
        return words, base, spans

    def _close(self, closed, number, chain):
        """Keeps a chain that goes on no longer, if it covers enough of its template."""
        if chain[0] >= self.min_coverage * self.sizes[number]:
            closed.add((number, chain[0], chain[1], chain[4]))

    def _chain(self, chains, best, closed, place, state, length):
        if length < MIN_MATCH:
            return
        start, end = place + 1 - length, place + 1
        for number, at in self.automaton.ends[state].items():
            if number >= len(self.sizes):
                continue
            # [covered words, first word, last word's end, template place reached, end of what is covered]
            chain = chains.get(number)
            if chain and at > chain[3] and start - chain[2] <= MAX_GAP:
                new = max(0, min(length, at - chain[3], end - chain[2]))
                chains[number] = chain = [chain[0] + new, chain[1], end, at, end if new else chain[4]]
            else:
                if chain:
                    self._close(closed, number, chain)
                chains[number] = chain = [length, start, end, at, end]
            if chain[0] > best.get(number, (0,))[0]:
                best[number] = (chain[0], chain[1], chain[4])

    def row(self, text: bytes):
        words, base, spans = self.scan(text)
        found = [s for s in spans if s[3] >= self.min_coverage]
        starts = [start for start, _ in base]
        base_labels = {label for _, label in base}
        labels = base_labels | {s[0] for s in found}
        return (
            len(words),
            len(base),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels)),
            1.0 if base else min(1.0, max((s[3] for s in spans), default=0.0)),
            [dict(zip(("label", "start", "end", "coverage"), s)) for s in found],
        )


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, tuple[str, ...]] | None = None,
    phrases: dict[str, str] | None = None,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """One row per document: words, base phrase places, labels, score and template spans.

    ``score`` is the largest share of a template that a chain covers, and 1
    where a base phrase stands.  Nulls, empty texts and repeated rows: see the
    module.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = BASE_PHRASES if phrases is None else phrases

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, phrases, min_coverage)
        for batch in batches:
            rows = [scanner.row(text) for text in utf8(batch.column("text"))]
            columns = list(zip(*rows)) if rows else [[]] * 8
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPANS]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=NAMES)

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, SCHEMA)


NAMES = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
SPANS = pa.list_(
    pa.struct(
        [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]
    )
)


def digest(scanned: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    return scanned.select(*NAMES[:-1], F.size("spans").cast("bigint").alias("n_spans"))
