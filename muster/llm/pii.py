"""Personal data by patterns, checksums and context, in Spark's own functions.

A regular expression proposes the spans of each kind, leftmost and not
overlapping; a validator confirms them (Luhn for cards, mod 97 for IBANs, ranges
and digit counts for the rest); words shortly before a span raise its score.
The four base kinds are kept whatever their score; the added ones need
``MIN_SCORE``.

Positions come from extracting the text before each match along with the match:
a span starts after all texts and matches before it.  ``\\G`` keeps the engine
from starting anew behind an unfinished search, and the patterns are written
without backtracking, so that very long texts and words take linear time; each
finds what its plain form finds.

Everything is a projection: no shuffle, no Python.  Positions count code points,
ends are exclusive.  A null text counts as empty and has no spans.  Repeated
rows and null ids each give their own row; other columns are not read by
``find_pii`` and are kept by ``redact``.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.frames import free_name, id_and_text

MIN_SCORE = 0.6
CONTEXT_CHARS = 40


class Kind(NamedTuple):
    name: str
    pattern: str
    hint: str  # a string without which there is no match
    score: float
    context: str  # words that raise the score
    confirm: Callable[[Column], Column]


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(found: Column) -> Column:
    """Whether the digits pass Luhn's check."""
    digits = _digits(found)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = 2 * digit
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return total % 10 == 0


def mod97(found: Column) -> Column:
    """Whether an IBAN's check digits are right."""
    compact = F.replace(found, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))

    def shift(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), shift) == 1


def _card(found: Column) -> Column:
    return F.length(_digits(found)).between(14, 19) & luhn(found)


def _phone(found: Column) -> Column:
    return F.length(_digits(found)).between(10, 15)


def _ip(found: Column) -> Column:
    byte = "^0*([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"
    return F.forall(F.split(found, "[.]"), lambda part: part.rlike(byte))


BASE = (
    # A match starts where a run of local characters does, or where the last match ended.
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@", 0.9, "mail|contact|write to", lambda found: F.lit(True),
    ),
    Kind(
        "ip", r"(?=[0-9])(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".", 0.6, "ip|address|server|host", _ip,
    ),
    # Whole runs of 14 to 19 digits: longer and shorter ones fail anyway.
    Kind(
        "card", r"(?=[0-9])(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
        "", 0.8, "card|visa|credit|payment", _card,
    ),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", 0.7, "phone|call|tel|mobile|fax", _phone),
)
# Characters of an IBAN by country.
IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC",
    33: "RU",
}


def _iban() -> str:
    """By the country's size, which takes nothing from the next word; for other
    countries and sizes, whole words only."""
    known = []
    for size, countries in IBAN_SIZES.items():
        groups, rest = divmod(size - 4, 4)
        tail = rf" ?[A-Z0-9]{{{rest}}}" if rest else ""
        known.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    other = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3}(?![A-Za-z0-9]))?"
    return rf"(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(known)}|{other})"


ADDED = (
    Kind(
        "iban", _iban(),
        "", 0.8, "iban|bank|account", mod97,
    ),
    Kind(
        "ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
        "-", 0.4, "ssn|social security", lambda found: F.lit(True),
    ),
)
KINDS = (*BASE, *ADDED)
CONTEXT_SCORE = 0.3

SPAN = "STRUCT<start: INT, place: INT, end: INT, kind: STRING, score: DOUBLE>"


def _matches(text: Column, kind: Kind) -> tuple[Column, Column]:
    """Texts before the matches, and the matches."""
    pattern = F.lit(rf"(?s)\G(.*?)({kind.pattern})")
    return F.regexp_extract_all(text, pattern, 1), F.regexp_extract_all(text, pattern, 2)


def _spans(text: Column, kind: Kind, place: int) -> Column:
    """Confirmed spans of one kind, in order."""
    before, found = _matches(text, kind)

    def step(state: Column, one: Column) -> Column:
        start = state["at"] + F.char_length(one["before"])
        end = start + F.char_length(one["found"])
        span = F.struct(start.alias("start"), end.alias("end"), one["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    nothing = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, found: STRING>>)")
    pairs = F.zip_with(before, found, lambda b, f: F.struct(b.alias("before"), f.alias("found")))
    placed = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), nothing.alias("spans")),
        step,
        lambda state: state["spans"],
    )

    def scored(span: Column) -> Column:
        first = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
        context = F.lower(F.substring(text, first + 1, span["start"] - first))
        score = kind.score + F.when(context.rlike(kind.context), CONTEXT_SCORE).otherwise(0.0)
        return F.struct(
            span["start"].alias("start"),
            F.lit(place).alias("place"),
            span["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    spans = F.transform(F.filter(placed, lambda span: kind.confirm(span["found"])), scored)
    if kind in ADDED:
        spans = F.filter(spans, lambda span: span["score"] >= MIN_SCORE)
    none = F.expr(f"CAST(array() AS ARRAY<{SPAN}>)")
    may_match = text.contains(kind.hint) if kind.hint else text.rlike("[0-9]{2}")
    if kind.name == "card":
        may_match = text.rlike("[0-9](?:[ -]?[0-9]){13}")
    elif kind.name == "iban":
        may_match = text.rlike("[A-Z]{2}[0-9]{2}")
    elif kind.name == "ip":
        may_match = text.rlike(r"[0-9]\.[0-9]")
    return F.when(may_match, spans).otherwise(none)


def spans_of(text: Column) -> Column:
    """All spans of a text, by start and then in the order of the kinds."""
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*(_spans(text, kind, place) for place, kind in enumerate(KINDS))))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) for each document; a null text has no spans."""
    return id_and_text(docs, id_col, text_col).select("doc_id", spans_of(F.col("text")).alias("spans"))


def _joined(spans: Column) -> Column:
    one = F.transform(
        spans,
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.concat_ws(",", one)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    spans = F.col("spans")
    names = [k.name for k in BASE]
    base = F.filter(spans, lambda s: s["kind"].isin(names))

    def count(name: str) -> Column:
        own = F.filter(spans, lambda s: s["kind"] == name)
        return F.size(own).cast("bigint").alias(f"n_{name}")

    return found.select(
        "doc_id", *map(count, names), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans")
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; of overlapping spans the
    first gives the name and all are covered."""

    def step(state: Column, span: Column) -> Column:
        overlaps = span["start"] < state["at"]
        between = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        mark = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(overlaps, state["done"]).otherwise(F.concat(state["done"], between, mark)).alias("done"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    rest = F.aggregate(
        spans,
        start,
        step,
        lambda state: F.concat(
            state["done"], F.substring(text, state["at"] + 1, F.char_length(text) - state["at"])
        ),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, the text without personal data.  A null text stays null."""
    found = free_name(docs, "pii_spans")
    marked = docs.withColumn(found, spans_of(F.col(text_col)))
    return marked.withColumn(text_col, redacted(F.col(text_col), F.col(found))).drop(found)
