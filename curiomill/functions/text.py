"""String helpers shared by the other function modules."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_any(column: Column, words: Iterable[str]) -> Column:
    """True when the text holds one of the words; plain substring search, so it can reach the scan."""
    return reduce(or_, [column.contains(w) for w in words])


def once(column: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named (an expression named twice is worked out
    twice)."""
    return F.get(F.transform(F.array(column), use), F.lit(0))


def strip(column: Column) -> Column:
    """Trim white space of any kind at both ends."""
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")


def blank_to_null(column: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(strip(column), F.lit(""))


def found(column: Column, pattern: str, group: int = 0) -> Column:
    """First match of the pattern, null when there is none."""
    return once(F.regexp_extract(column, pattern, group), lambda hit: F.when(hit != "", hit))


def alternation(terms: Iterable[str]) -> str:
    """Regex body that prefers the longest of terms starting at one place."""
    return "|".join(re.escape(t) for t in sorted(terms, key=lambda t: (-len(t), t)))


def words(terms: Iterable[str]) -> str:
    """Whole-word, case-insensitive pattern over a small fixed lexicon."""
    return r"(?i)\b(" + alternation(terms) + r")\b"


def decode_entities(column: Column) -> Column:
    """Decode the entities that occur in shop mark-up; the ampersand goes last."""
    pairs = [
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
        ("&nbsp;", " "), ("&euro;", "€"), ("&pound;", "£"), ("&amp;", "&"),
    ]
    decoded = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, column)
    return F.when(column.contains("&"), decoded).otherwise(column)
