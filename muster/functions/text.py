"""Text expressions for addresses, payload values and names."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that stay lower case inside a name.
SURNAME_PARTICLES = (
    "abu", "al", "bin", "bon", "da", "dal", "de", "degli", "dei", "del", "dela",
    "della", "delle", "delli", "dello", "der", "di", "dí", "do", "dos", "du",
    "ibn", "la", "le", "mac", "mc", "san", "santa", "st", "ste", "van",
    "vander", "vel", "von", "vom",
)
CONJUNCTIONS = ("and", "et", "e", "of", "the", "und", "y")
# Words with a spelling of their own.
SPECIAL_WORDS = {"ii": "II", "iii": "III", "iv": "IV", "md": "M.D.", "phd": "Ph.D."}

# ASCII spellings of letters and marks that do not decompose into ASCII.
LATIN_SPELLINGS = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O",
    "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L",
    "ħ": "h", "Ħ": "H", "ŋ": "ng", "Ŋ": "NG", "ı": "i", "ĸ": "k", "ŧ": "t", "Ŧ": "T",
}
MARK_SPELLINGS = {
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "–": "-", "—": "--", "−": "-",
    "‐": "-", "‑": "-", "«": "<<", "»": ">>", "‹": "<", "›": ">", "¿": "?", "¡": "!", "•": "*",
    "·": "*", "×": "x", "÷": "/", "⁄": "/", "°": "deg", "§": "SS", "©": "(c)", "®": "(r)",
    "€": "EUR", "£": "GBP", "¥": "JPY", "¢": "c", "₽": "RUB", "₹": "INR", "₩": "KRW", "₪": "ILS",
}
CYRILLIC_SPELLINGS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "io", "ж": "zh", "з": "z",
    "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh",
    "щ": "shch", "ъ": "'", "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "є": "ie",
    "і": "i", "ї": "yi", "ґ": "g", "ў": "u", "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh",
    "џ": "dzh",
}
GREEK_SPELLINGS = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s",
    "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}
# Syllables whose spelling follows from their Unicode name, as "HIRAGANA LETTER KA".
_SYLLABLE = re.compile(r"(?:HIRAGANA|KATAKANA) LETTER (?:SMALL )?([A-Z]+)$")
# Letters whose Unicode name begins with their sound, as "ARMENIAN SMALL LETTER GIM",
# after words that tell forms of one letter apart.
_ALPHABET = re.compile(
    r"(?:ARMENIAN|GEORGIAN|HEBREW|ARABIC) (?:MTAVRULI )?(CAPITAL )?(?:SMALL )?(?:LETTER|LIGATURE(?= YIDDISH)) "
    r"(?:(?:FINAL|WIDE|HIGH|HAMZA|FARSI|SWASH|DOTLESS|KIRGHIZ|YIDDISH|DOUBLE|AFRICAN|TURNED|SMALL) (?!WITH))*([A-Z]+)"
)
# Letters and vowel signs of Indian scripts, where a consonant's name ends in "A".
_INDIC = re.compile(
    r"(?:DEVANAGARI|BENGALI|GURMUKHI|GUJARATI|ORIYA|TAMIL|TELUGU|KANNADA|MALAYALAM|SINHALA) "
    r"(?:[A-Z -]+ )?([A-Z]+)$"
)
_SOUND = re.compile(r"[^AEIOU]+|[AEIOU]")
# Names of letters that do not begin with the sound, and signs with one.
NAMED_SOUNDS = {
    "VO": "o", "CA": "ts", "CO": "ts", "JA": "dz", "TSADI": "ts", "HAMZA": "'", "TCHEH": "ch", "JEH": "zh",
    "TEHEH": "t", "TCHEHEH": "ch", "YIWN": "w",
}
INDIC_SIGNS = {
    "ANUSVARA": "n", "CANDRABINDU": "n", "BINDI": "n", "TIPPI": "n", "VISARGA": "h", "AVAGRAHA": "'",
    "ANUSVARAYA": "n", "VISARGAYA": "h", "OM": "om", "ONKAR": "om", "IRI": "", "URA": "",
}
SCRIPT_MARKS = {"ـ": "", "،": ",", "؛": ";", "؟": "?", "۔": ".", "।": ".", "॥": ".", "՝": ",", "։": ":", "־": "-", "׳": "'", "״": '"'}
# Blocks with spellings: Latin, Greek, Cyrillic, Armenian, Hebrew, Arabic, Indian scripts,
# Georgian, punctuation, currencies, fractions, kana, forms of letters.
_BLOCKS = ((0x80, 0x250), (0x370, 0x460), (0x530, 0x700), (0x750, 0x780), (0x900, 0xE00), (0x10A0, 0x1100),
           (0x1C90, 0x1CC0), (0x1E00, 0x2000), (0x2000, 0x2070), (0x20A0, 0x20C0),
           (0x2100, 0x2190), (0x3040, 0x3100), (0xFB00, 0xFB07), (0xFB13, 0xFE00), (0xFE70, 0xFFA0), (0xFFE0, 0xFFF0))
# What stands for a letter or digit that none of this spells.
UNSPELLED = "?"
# The first marker for spellings of several characters, in the area for private use.
_MARKERS = 0xE000


def _by_name(char: str) -> str | None:
    """Spelling of a letter, sign or digit whose Unicode name tells its sound or value."""
    value = unicodedata.numeric(char, 0.5)
    if value == int(value) and unicodedata.normalize("NFKD", char) == char:
        return str(int(value))
    name = unicodedata.name(char, "")
    syllable = _SYLLABLE.match(name)
    if syllable:
        return syllable[1].lower()
    letter = _ALPHABET.match(name)
    if letter and unicodedata.category(char)[0] == "L":
        sound = NAMED_SOUNDS.get(letter[2]) or _SOUND.match(letter[2])[0].lower()
        sound = re.sub(r"(.)\1+", r"\1", sound)
        return sound.capitalize() if letter[1] else sound
    letter = _INDIC.match(name.partition(" WITH ")[0])
    if not letter:
        return None
    sound = letter[1].removesuffix("YANNA")  # as consonants are called in Sinhala
    if sound in INDIC_SIGNS:
        return INDIC_SIGNS[sound]
    if " LETTER " not in name and " VOWEL " not in name:
        return None
    consonant = sound[0] not in "AEIOU" and " LETTER " in name
    return (sound.removesuffix("A") if consonant and len(sound) > 1 else sound).lower()


def _spelling(char: str, fixed: dict[str, str]) -> str:
    if char not in fixed and (named := _by_name(char)) is not None:
        return named
    parts = []
    for part in unicodedata.normalize("NFKD", fixed.get(char, char)):
        kind = unicodedata.category(part)[0]
        if part.isascii():
            parts.append(part)
        elif part in fixed:
            parts.append(fixed[part])
        elif (named := _by_name(part)) is not None:
            parts.append(named)
        elif kind in "LN" and unicodedata.category(part) != "Lm":
            parts.append(UNSPELLED)
        elif kind == "Z":
            parts.append(" ")
    return "".join(parts)


@cache
def ascii_spellings() -> dict[str, str]:
    """Spelling of each character of the blocks; marks on letters have none."""
    fixed = dict(LATIN_SPELLINGS | MARK_SPELLINGS | SCRIPT_MARKS)
    for letter, spelling in (CYRILLIC_SPELLINGS | GREEK_SPELLINGS).items():
        fixed |= {letter.upper(): spelling.capitalize(), letter: spelling}
    return {c: _spelling(c, fixed) for first, end in _BLOCKS for c in map(chr, range(first, end))}


def is_plain_address(email: Column) -> Column:
    """Holds only printable and control ASCII characters."""
    return F.regexp_instr(email, F.lit(r"[^\p{Print}\p{Cntrl}]")) == 0


def url_quote(text: Column) -> Column:
    """Percent-encoding that keeps ``/`` and ``~`` and writes a blank as ``%20``."""
    quoted = F.url_encode(text)
    for form, percent in (("+", "%20"), ("*", "%2A"), ("%2F", "/"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(form), F.lit(percent))
    return quoted


def blank_if_falsy(value: Column, kind: T.DataType) -> Column:
    """Value as text, with null, NaN, zero and false turned into ``''``."""
    text = value.cast("string")
    if isinstance(kind, T.BooleanType):
        empty = ~value
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        empty = (value == 0) | F.isnan(value)
    elif isinstance(kind, T.NumericType):
        empty = value == 0
    else:
        empty = F.lit(False)
    return F.when(value.isNull() | empty, F.lit("")).otherwise(text)


# First syllable of Hangul, and the numbers of its vowels and of its endings.
_HANGUL, _VOWELS, _ENDINGS = 0xAC00, 21, 28


def _texts_array(texts: Iterable[str]) -> Column:
    return F.array(*map(F.lit, texts))


def _hangul(number: Column) -> Column:
    """Spelling of a syllable by its initial, vowel and ending, which its number is made of."""

    def sounds(step: int, n: int, start: int, end: int | None) -> Column:
        # Of syllables that differ from the first in one of the three alone, the names tell it.
        names = [unicodedata.name(chr(_HANGUL + step * i)).rsplit(" ", 1)[1].lower() for i in range(n)]
        return _texts_array(name[start:end] for name in names)

    initials = sounds(_VOWELS * _ENDINGS, 19, 0, -1)
    vowels = sounds(_ENDINGS, _VOWELS, 1, None)
    endings = sounds(1, _ENDINGS, 2, None)

    def part(of: Column, step: int, n: int) -> Column:
        at = F.call_function("div", number, F.lit(step)) % n
        return F.get(of, at.cast("int"))

    return F.concat(part(initials, _VOWELS * _ENDINGS, 19), part(vowels, _ENDINGS, _VOWELS), part(endings, 1, _ENDINGS))


def fold_ascii(text: Column) -> Column:
    """ASCII spelling of a text.

    Accents go, currencies and marks are spelled out.  Letters are romanised one
    by one: Cyrillic and Greek by a table, kana and Hangul by syllable, and
    Armenian, Georgian, Hebrew, Arabic and the Indian scripts by their Unicode
    names.  A letter or digit without a spelling (Han above all) becomes ``?``,
    so no text of letters becomes empty; other symbols, control characters and
    marks are dropped.  The table is made when the plan is, and applied by
    ``translate``; a spelling of several characters goes through a marker, whose
    number is its place in an array.  ASCII texts are left as they are.
    """
    spelled = ascii_spellings()
    marker: dict[str, str] = {}
    for spelling in spelled.values():
        if len(spelling) > 1:
            marker.setdefault(spelling, chr(_MARKERS + len(marker)))
    # Characters that are dropped come last, beyond the targets.
    kept = {c: marker.get(v, v) for c, v in spelled.items() if v}
    source = "".join([*kept, *(c for c, v in spelled.items() if not v)])
    known = "".join(f"\\x{{{first:x}}}-\\x{{{end - 1:x}}}" for first, end in _BLOCKS)
    # Outside the blocks and Hangul: letters and digits are marked, and the rest is dropped.
    folded = F.regexp_replace(text, rf"[^\x00-\x7F{known}\p{{L}}\p{{N}}]", "")
    folded = F.regexp_replace(folded, rf"[^\x00-\x7F{known}\x{{ac00}}-\x{{d7a3}}]", UNSPELLED)
    folded = F.translate(folded, source, "".join(kept.values()))

    spellings = _texts_array(marker)
    last_marker = chr(_MARKERS + len(marker) - 1)

    def spelt(char: Column) -> Column:
        code = F.ascii(char)
        return (
            F.when(char <= "\x7f", char)
            .when(char.between("\uac00", "\ud7a3"), _hangul(code - _HANGUL))
            .otherwise(F.get(spellings, code - _MARKERS))
        )

    def expanded(value: Column) -> Column:
        several = value.rlike(f"[{chr(_MARKERS)}-{last_marker}\uac00-\ud7a3]")
        return F.when(several, F.array_join(F.transform(F.split(value, ""), spelt), "")).otherwise(value)

    return F.when(text.rlike(r"[^\x00-\x7F]"), _let(folded, expanded)).otherwise(text)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def _capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substr(word, F.lit(1), F.lit(1))), F.lower(F.substr(word, F.lit(2))))


def _repaired_word(word: Column, lower_words: tuple[str, ...]) -> Column:
    bare = F.lower(F.replace(word, F.lit("."), F.lit("")))
    initial = word.rlike("^[A-Z]$")
    special = F.lit(None).cast("string")
    for spelled, spelling in SPECIAL_WORDS.items():
        special = F.when(bare == spelled, F.lit(spelling)).otherwise(special)
    clan = F.regexp_extract(word, r"(?iU)^(ma?c)\w{2,}$", 1)
    rest = F.substr(word, F.length(clan) + 1)
    return (
        F.when(bare.isin(*lower_words) & ~initial, F.lower(word))
        .when(special.isNotNull(), special)
        .when(clan != "", F.concat(_capitalised(clan), _capitalised(rest)))
        .otherwise(_capitalised(word))
    )


def _repaired(name: Column, lower_words: tuple[str, ...]) -> Column:
    pieces = F.regexp_extract_all(name, F.lit(r"(?U)([\w.]+|[^\w.]+)"), F.lit(1))
    return F.array_join(F.transform(pieces, lambda w: _repaired_word(w, lower_words)), "")


def repair_names(first: Column, last: Column) -> tuple[Column, Column]:
    """First and last name in mixed case.

    Only a full name written all in capitals or all in small letters is
    touched, and only if both parts are there.
    """
    full = F.concat_ws(" ", first, last)
    present = (F.coalesce(first, F.lit("")) != "") & (F.coalesce(last, F.lit("")) != "")
    one_case = (full == F.upper(full)) | (full == F.lower(full))
    return (
        F.when(present & one_case, _repaired(first, CONJUNCTIONS)).otherwise(first),
        F.when(present & one_case, _repaired(last, CONJUNCTIONS + SURNAME_PARTICLES)).otherwise(last),
    )
