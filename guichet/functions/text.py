"""Text expressions: strip, words, accent folding, tokens, n-grams and templates."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# The characters Python's str.strip and str.split treat as whitespace, as
# code points, and the same set for use inside a regular expression's brackets.
WHITESPACE_POINTS = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
WHITESPACE_SET = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

def _ranges(points: Iterable[int]) -> str:
    """Sorted code points as the inside of a regular expression's brackets."""
    spans: list[list[int]] = []
    for point in points:
        if spans and spans[-1][1] == point - 1:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in spans)


# Everything else. Java asks the ranges of a class one after another for each character, so printable ASCII comes first and the
# others are a class inside: a negated list of the white space takes nine times as long.
NOT_WHITESPACE = rf"[\x21-\x7e[{_ranges(sorted({*range(0x21), *range(0x7F, sys.maxunicode + 1)} - {*WHITESPACE_POINTS}))}]]"
# A word of two or more letters, digits or underscores.
WORD = r"[\p{L}\p{N}_]{2,}"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body uses it.

    Array lambdas that mention an outer expression have it copied into them by the
    optimizer and evaluated per element; a lambda variable is a plain value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace of every kind, not only spaces."""
    return F.btrim(as_col(c), F.lit("".join(map(chr, WHITESPACE_POINTS))))


def full_text(titre: Column | str, texte: Column | str) -> Column:
    return strip(F.concat(text_or_empty(titre), F.lit(" "), text_or_empty(texte)))


def word_count(c: Column | str) -> Column:
    """Whitespace-separated words; 0 for an empty or blank text."""
    return F.regexp_count(text_or_empty(c), F.lit(f"{NOT_WHITESPACE}++"))


@functools.lru_cache(maxsize=1)
def _combining_marks() -> re.Pattern:
    """One or more characters that combine with the one before them."""
    ranges: list[list[int]] = []
    for point in range(0x80, sys.maxunicode + 1):
        if unicodedata.combining(chr(point)):
            if ranges and ranges[-1][1] == point - 1:
                ranges[-1][1] = point
            else:
                ranges.append([point, point])
    return re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]+")


def _folded(text: str | None) -> str | None:
    return None if text is None else _combining_marks().sub("", unicodedata.normalize("NFKD", text))


@F.arrow_udf(StringType())
def _fold(texts: pa.Array) -> pa.Array:
    return pa.array([_folded(t) for t in texts.to_pylist()], pa.string())


def fold_accents(c: Column | str) -> Column:
    """Decompose all compatibility characters (accents, ligatures, fractions, syllables) and drop the combining marks.

    Only texts with a character beyond ASCII travel to an Arrow batch, the others as nulls.
    """
    text = as_col(c)
    return F.coalesce(_fold(F.when(F.octet_length(text) != F.length(text), text)), text)


def tokens(c: Column | str, fold: bool = True) -> Column:
    text = F.lower(text_or_empty(c))
    if fold:
        text = fold_accents(text)
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))


def ngrams(words: Column | str, low: int = 1, high: int = 2) -> Column:
    """All ``low``..``high``-grams of a word array, words joined by one space."""

    def grams(t: Column) -> Column:
        parts = []
        for n in range(low, high + 1):
            count = F.greatest(F.size(t) - (n - 1), F.lit(0))
            shifted = [F.slice(t, F.lit(i + 1), count) for i in range(n)]
            gram = shifted[0]
            for nxt in shifted[1:]:
                gram = F.zip_with(gram, nxt, lambda a, b: F.concat(a, F.lit(" "), b))
            parts.append(gram)
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    return let(as_col(words), grams)


def preview(c: Column | str, chars: int = 200) -> Column:
    return F.substring(as_col(c), 1, chars)


def first_lines(c: Column | str, n: int = 4) -> Column:
    return F.array_join(F.slice(F.split(as_col(c), "\n"), 1, n), "\n")


def contains_any(c: Column | str, phrases: Iterable[str]) -> Column:
    """Case-insensitive substring test against any of the phrases."""
    hay = F.lower(text_or_empty(c))
    return functools.reduce(lambda a, b: a | b, [F.contains(hay, F.lit(p)) for p in phrases])


def percent_bar(pct: Column | str) -> Column:
    """One block per two percent."""
    return F.repeat(F.lit("█"), (as_col(pct) / 2).cast("int"))


def metadata_get(metadata: Column | str, key: str, default: str = "N/A") -> Column:
    return F.coalesce(F.try_element_at(as_col(metadata), F.lit(key)), F.lit(default))


def now_text(pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> Column:
    """The time the query started, ISO 8601 unless another pattern is given."""
    return F.date_format(F.current_timestamp(), pattern)
