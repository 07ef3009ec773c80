"""Text expressions. All of them are built-in column functions (no UDF)."""

from __future__ import annotations

import re

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: letters and signs whose ASCII spelling is not their Unicode
# decomposition. Spellings that contain no letter or digit are left out because
# the name normaliser turns every other sign into a space anyway.
ASCII_SPELLING = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE",
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D",
    "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H",
    "ı": "i", "ŋ": "ng", "Ŋ": "NG", "ŧ": "t", "Ŧ": "T", "ĸ": "k",
    "©": "(c)", "®": "(r)", "°": "deg", "µ": "u", "×": "x",
    "£": "PS", "§": "SS", "¶": "P", "¢": "C/", "¥": "Y=",
    "¼": " 1/4", "½": " 1/2", "¾": " 3/4",
}

# code point ranges decomposed by rule: Latin-1 signs, Latin letters with marks
# and full-width forms
_DECOMPOSED_RANGES = [(0xAA, 0x24F), (0x2070, 0x209C), (0x1E00, 0x1EFF), (0xFF01, 0xFF5E)]
_DROPPED_RANGES = [(0x300, 0x36F), (0xAD, 0xAD), (0x200B, 0x200F), (0xFEFF, 0xFEFF)]

# FIXED VALUES: Greek letters after ELOT 743 (ISO 843, transcription), Cyrillic ones after the ALA-LC romanisation
# without its marks; where languages differ, as in Russian. Accented letters are spelled as their base letter.
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψωϊϋ", "a v g d e z i th i k l m n x o p r s s t y f ch ps o i y".split(), strict=True))
CYRILLIC = dict(
    zip(
        "абвгґдђеєжзѕиіјклљмнњопрстћуфхцчџшщыэюя",
        "a b v g g d d e ie zh z dz i i j k l lj m n nj o p r s t c u f kh ts ch dz sh shch y e iu ia".split(),
        strict=True,
    )
)
_SILENT = "ъь"
# Greek letters that read differently beside others, in the order in which they are replaced
GREEK_CONTEXT = [
    ("ου", "ou"),
    ("([αεη])υ(?=[αεηιουωϊϋβγδζλμνρ])", "$1v"),
    ("([αεη])υ", "$1f"),
    ("(?<![α-ωϊϋ])μπ|μπ(?![α-ωϊϋ])", "b"),
    ("γγ", "ng"),
    ("γξ", "nx"),
    ("γχ", "nch"),
]
_SCRIPTS = "[\u0370-\u03ff\u1f00-\u1fff\u0400-\u052f]"
_SCRIPT_RANGES = [(0x370, 0x3FF), (0x1F00, 0x1FFF), (0x400, 0x52F)]

# every character that counts as white space
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


@lru_cache(maxsize=1)
def _transliteration() -> tuple[str, str, list[tuple[str, str]]]:
    """(from, to) for ``translate`` plus the one-to-many replacements."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for low, high in _DECOMPOSED_RANGES:
        for ch in map(chr, range(low, high + 1)):
            plain = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
            if plain and ch not in ASCII_SPELLING:
                (single if len(plain) == 1 else several)[ch] = plain
    for ch, plain in ASCII_SPELLING.items():
        (single if len(plain) == 1 else several)[ch] = plain
    dropped = "".join(chr(c) for low, high in _DROPPED_RANGES for c in range(low, high + 1))
    return "".join(single) + dropped, "".join(single.values()), sorted(several.items())


@lru_cache(maxsize=1)
def _base_letters() -> tuple[str, str]:
    """(from, to): Greek and Cyrillic letters to lower case without marks, but for a diaeresis in Greek, which parts vowels."""
    pairs = {}
    for low, high in _SCRIPT_RANGES:
        for ch in map(chr, range(low, high + 1)):
            marks = unicodedata.normalize("NFD", ch.lower())
            parted = {"ι": "ϊ", "υ": "ϋ"}.get(marks[0]) if "\u0308" in marks else None
            base = parted or marks[0]
            if base != ch and (base in GREEK or base in CYRILLIC or base in _SILENT):
                pairs[ch] = base
    return "".join(pairs), "".join(pairs.values())


def romanize(c: Column) -> Column:
    """Greek and Cyrillic in lower-case Latin letters (STR-01): first letters that read differently beside others, then each by itself."""
    marks = "".join(chr(x) for x in range(0x300, 0x370))
    text = F.replace(F.replace(c, F.lit("υ\u0308"), F.lit("ϋ")), F.lit("Υ\u0308"), F.lit("ϋ"))
    text = F.translate(text, marks, "")
    text = F.translate(text, *_base_letters())
    for pattern, spelling in GREEK_CONTEXT:
        text = F.regexp_replace(text, pattern, spelling)
    letters = {**GREEK, **CYRILLIC}
    for letter, spelling in letters.items():
        if len(spelling) > 1:
            text = F.replace(text, F.lit(letter), F.lit(spelling))
    single = {k: v for k, v in letters.items() if len(v) == 1}
    return F.translate(text, "".join(single) + _SILENT, "".join(single.values()))


def to_ascii(c: Column) -> Column:
    """Latin letters without accents, ligatures and signs spelled out; Greek and Cyrillic romanised in lower case (STR-01).

    Other scripts are left as they are.
    """
    source, target, several = _transliteration()
    # one cheap test keeps plain ASCII text, the usual case, off the long chain
    spelled = F.translate(F.when(c.rlike(_SCRIPTS), romanize(c)).otherwise(c), source, target)
    for ch, plain in several:
        spelled = F.replace(spelled, F.lit(ch), F.lit(plain))
    return F.when(c.rlike(r"[^\x00-\x7f]"), spelled).otherwise(c)


def normalize_name(c: Column) -> Column:
    """Lower-case ASCII words split by single spaces; null gives '' (STR-01)."""
    words = F.regexp_replace(F.lower(to_ascii(c)), r"[^a-z0-9]+", " ")
    return F.coalesce(F.trim(words), F.lit(""))


def strip(c: Column) -> Column:
    """Remove every kind of white space from both ends (STR-04)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """Null, empty or white space only. Always true or false."""
    return F.coalesce(strip(c.cast("string")) == "", F.lit(True))


def blank_to_null(c: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return F.nullif(strip(c.cast("string")), F.lit(""))


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` to the bare width would cut it)."""
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), F.lit("0"))


def canonical_key(c: Column, width: int = 9) -> Column:
    """Trim, cut at the first '.', zero-pad (STR-02, STR-03)."""
    return zero_pad(F.substring_index(strip(c.cast("string")), ".", 1), width)


def is_digits(c: Column, width: int) -> Column:
    """Exactly ``width`` digits; null gives null (STR-05)."""
    return c.rlike(f"^[0-9]{{{width}}}$")


def sort_tokens(c: Column) -> Column:
    """Words in alphabetical order (STR-11)."""
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def list_to_line(c: Column) -> Column:
    """Multi-line lists on one line: ';' + line feed becomes ' / ' (STR-07)."""
    return F.regexp_replace(c, ";\n", " / ")


def full_name(name: Column, last: Column, first: Column) -> Column:
    """Company name, else 'last first' of a sole trader (STR-10)."""
    person = F.trim(F.concat_ws(" ", last, first))
    return F.coalesce(name, F.nullif(person, F.lit("")))


def contains_any(c: Column, words: list[str]) -> Column:
    """Any of the words inside the upper-cased text; null gives false (FLT-08)."""
    pattern = "|".join(re.escape(w) for w in words)
    return F.coalesce(F.upper(c).rlike(pattern), F.lit(False))


def contains_ignore_case(c: Column, word: str) -> Column:
    """Case-insensitive contains; null gives false (FLT-07)."""
    return F.coalesce(F.lower(c).contains(word.lower()), F.lit(False))


def domain(url: Column) -> Column:
    """Authority part of a URL with every 'www.' removed; bad input gives '' (URL-01)."""
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)
    return F.replace(authority, F.lit("www."), F.lit(""))


def union_sets(*parts: Column, sep: str = "|") -> Column:
    """Sorted distinct elements of several array columns, joined (ARR-01, STR-06)."""
    merged = F.array_sort(F.array_distinct(F.flatten(F.array(*parts))))
    return F.array_join(merged, sep)


def list_size(c: Column, sep: str = "|") -> Column:
    """Number of elements of a joined list (STR-06)."""
    return F.size(F.split(c, f"[{sep}]"))
