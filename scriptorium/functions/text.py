"""Column expressions on text: normalising, keys, lists, counting, segmenting.

Everything here is built from native functions, so it stays inside the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.split() and str.strip() see it: as a pattern, and as characters.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
_BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# Characters a title loses, and the numerals it gets, in order of replacement.
TITLE_PUNCTUATION = ",:;'.!?"
ROMAN_NUMERALS = (
    ("IX", "9"),
    ("VIII", "8"),
    ("VII", "7"),
    ("VI", "6"),
    ("IV", "4"),
    ("III", "3"),
    ("II", "2"),
)

# Screenplay scene headers.
SCENE_HEADERS = (
    r"\bINT\.\s",
    r"\bEXT\.\s",
    r"\bFADE IN:",
    r"\bFADE OUT\.",
    r"\bCUT TO:",
    r"\bSCÈNE",
)

# A cut, and what stands for its first letter where a text has that letter itself.
_LETTER, _CUT, _ESCAPED = "\ufdd0", "\ufdd0\ufdd1", "\ufdd0\ufdd2"


def strip(c: Column) -> Column:
    """Remove all Unicode whitespace at both ends (Spark's ``trim`` removes blanks only)."""
    return F.trim(c, F.lit(_BLANKS))


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, WHITESPACE, -1), "")


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words; 0 for null."""
    return F.coalesce(F.array_size(words(c)), F.lit(0)).cast("bigint")


def normalize_title(c: Column) -> Column:
    """Common spelling of a title: no punctuation, digits for numerals, capitalised words.

    The numerals are replaced as plain substrings and case-sensitively, so "MATRIX" becomes
    "Matr9"; catalogues are only comparable when all of them are treated alike.
    """
    out = F.regexp_replace(c, f"[{TITLE_PUNCTUATION}]", "")
    for numeral, digit in ROMAN_NUMERALS:
        out = F.replace(out, F.lit(numeral), F.lit(digit))
    return F.initcap(F.regexp_replace(out, r"(?U)[\s\x1c-\x1f_-]+", " "))


def file_name(title: Column, extension: Column) -> Column:
    return F.concat(F.replace(F.lower(title), F.lit(" "), F.lit("_")), F.lit("."), extension)


def wiki_key(title: Column) -> Column:
    return F.translate(F.replace(strip(title), F.lit(" "), F.lit("_")), ":", "")


def wiki_url(title: Column, base: str) -> Column:
    return F.concat(F.lit(base), wiki_key(title))


def script_url(title: Column, prefix: str, suffix: str = ".html") -> Column:
    """Address of a script page: ``": "`` and blanks become dashes, percent signs are escaped."""
    path = F.replace(title, F.lit(": "), F.lit("-"))
    path = F.replace(path, F.lit("%"), F.lit("%2526"))
    path = F.replace(path, F.lit(" "), F.lit("-"))
    return F.concat(F.lit(prefix), path, F.lit(suffix))


def base_name(path: Column) -> Column:
    """Last path component without its last extension (also for a leading-dot name)."""
    name = F.regexp_replace(path, r"^.*/", "")
    return F.regexp_replace(name, r"(?s)(?<=[^.])\.[^.]*$", "")


def absolute_url(href: Column, base: str) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(base), href))


def after_marker(c: Column, marker: str) -> Column:
    """Text behind the first occurrence of ``marker``; the whole text when there is none."""
    return F.element_at(F.split(c, rf"\Q{marker}\E", 2), -1)


def preview(c: Column, length: int = 2000) -> Column:
    return F.substring(c, 1, length)


def parse_items(c: Column, separator: str = ",") -> Column:
    """A separated list as a clean array: trimmed, without empty entries, empty for null."""
    return clean_items(F.split(c, rf"\Q{separator}\E", -1))


def clean_items(items: Column) -> Column:
    """The same for a value that is an array already."""
    kept = F.array_remove(F.transform(items, strip), "")
    return F.coalesce(kept, F.array().cast("array<string>"))


def sort_items_ci(items: Column) -> Column:
    """Array sorted by lower case; entries that differ only in case keep a fixed order."""
    keyed = F.transform(items, lambda x: F.struct(F.lower(x).alias("k"), x.alias("v")))
    return F.transform(F.array_sort(keyed), lambda s: s["v"])


def mention_count(text: Column, items: Column) -> Column:
    """How many of ``items`` occur in ``text``; 0 when there is no text."""
    found = F.filter(items, lambda x: F.contains(text, x))
    return F.coalesce(F.when(text.isNotNull(), F.array_size(found)), F.lit(0)).cast("double")


def segments(c: Column, headers: Sequence[str] = SCENE_HEADERS) -> Column:
    """Split a text at its header lines.

    Entry 0 is what stands before the first header (possibly empty); each further entry starts
    with its header. A header runs to the end of its line, so two markers on one line are one
    header. ``headers`` are regular expressions for the beginning of a header.
    """
    pattern = f"(?imudU)(?:{'|'.join(headers)}).*"
    safe = F.replace(c, F.lit(_LETTER), F.lit(_ESCAPED))
    parts = F.split(F.regexp_replace(safe, pattern, f"{_CUT}$0"), _CUT, -1)
    return F.transform(parts, lambda part: strip(F.replace(part, F.lit(_ESCAPED), F.lit(_LETTER))))
