"""Lexicon rules that read record fields from listing text.

The lexicons are small fixed lists, so each rule is one alternation pattern, not a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions.text import alternation, contains_any, found, once, words

_GOLD = (
    r"(?:" + "|".join(K.KARATS) + r")(?:\s(?:" + "|".join(K.GOLD_COLOURS) + r"))?\sgold"
    r"|(?:" + "|".join(K.GOLD_COLOURS) + r")\sgold"
)
MATERIAL = r"(?i)\b(" + _GOLD + "|" + alternation(K.MATERIALS) + r")\b"
PRECIOUS = r"(?i)\b(" + _GOLD + "|" + alternation(K.PRECIOUS) + r")\b"
GEM = words(K.GEMS)
YEAR = r"(?:1[6-9][0-9][0-9]|20[0-9][0-9])"


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))


def _longest(hits: Column) -> Column:
    """Longest hit, the leftmost of equals; null when there is none."""
    best = F.aggregate(
        hits, F.lit(""), lambda acc, hit: F.when(F.length(hit) > F.length(acc), hit).otherwise(acc)
    )
    return F.nullif(best, F.lit(""))


def _joined(hits: Column) -> Column:
    """Distinct hits in order of appearance; null when there is none."""
    return F.nullif(F.array_join(F.array_distinct(hits), ", "), F.lit(""))


def _mapped(key: Column, pairs: list[tuple[str, str]]) -> Column:
    def chosen(low: Column) -> Column:
        return reduce(lambda acc, p: F.when(low == p[0].lower(), p[1]).otherwise(acc), pairs, F.lit(None).cast("string"))

    return once(F.lower(key), chosen)


def labelled(text: Column, label: str) -> Column:
    """Value of a labelled evidence line."""
    return found(text, rf"(?m)^{label}: ([^\n]+)", 1)


def free_text(text: Column) -> Column:
    """Evidence without the URL and price lines, whose digits and words would mislead the rules."""
    return F.regexp_replace(text, r"(?m)^(?:SOURCE URL|PRICE): [^\n]*\n?", "")


def material_used(text: Column) -> Column:
    return _longest(_all(text, MATERIAL))


def valuable_gem(text: Column) -> Column:
    return _joined(_all(text, GEM))


def expensive_material(text: Column) -> Column:
    return _longest(_all(text, PRECIOUS))


def house(text: Column) -> Column:
    """First house brand named in the text, as written in the lexicon."""
    return _mapped(found(text, words([h for h, _ in K.HOUSES]), 1), [(h, h) for h, _ in K.HOUSES])


def origin(text: Column) -> Column:
    """Stated country, nationality word, country of the house, craft region, or a bare country name."""
    made_in = F.regexp_extract(text, r"(?i)\bmade in ([a-z]+)", 1)
    return F.coalesce(
        labelled(text, "ORIGIN"),
        F.when(made_in != "", F.when(F.length(made_in) <= 3, F.upper(made_in)).otherwise(F.initcap(made_in))),
        _mapped(found(text, words([n for n, _ in K.NATIONALITIES]), 1), K.NATIONALITIES),
        _mapped(house(text), K.HOUSES),
        found(text, words(K.CRAFT_REGIONS), 1),
        found(text, r"\b(" + alternation(K.COUNTRIES) + r")\b", 1),
    )


def date_of_manufacture(text: Column) -> Column:
    """Circa date, vintage decade, decade, year, or the pre-owned mark, in this order."""
    return F.coalesce(
        found(text, rf"(?i)\bcirca {YEAR}\b"),
        found(text, r"(?i)\bvintage [0-9]{4}s\b"),
        found(text, r"\b[0-9]{4}s\b"),
        found(text, rf"\b{YEAR}\b"),
        found(text, r"(?i)\bpre-owned\b"),
    )


def defects(text: Column) -> Column:
    return _joined(_all(text, words(K.DEFECT_TERMS)))


def scratches(text: Column) -> Column:
    return text.rlike(words(K.SCRATCH_TERMS))


def colour(text: Column) -> Column:
    return F.lower(found(text, words(K.COLOURS), 1))


def seller_reputation(url: Column, text: Column) -> Column:
    """Fixed seller of the site, else the seller shown."""
    low = F.lower(url)
    fixed = [F.when(low.contains(needle), seller) for needle, seller in K.SITE_SELLERS]
    unnamed = [F.when(low.contains(needle), seller) for needle, seller in K.UNNAMED_SELLERS]
    return F.coalesce(*fixed, labelled(text, "SELLER"), *unnamed)


def brand(text: Column) -> Column:
    return F.coalesce(labelled(text, "BRAND"), house(text), F.lit("N/A"))


def dimensions(text: Column) -> Column:
    number = r"[0-9]+(?:\.[0-9]+)?"
    return F.coalesce(
        found(text, rf"(?i)\b{number}\s?x\s?{number}(?:\s?x\s?{number})?(?:\s?(?:inches|inch|in|cm|mm)\b)?"),
        found(text, rf"(?i)\b{number}\s?(?:inches|inch|in|cm|mm) diameter\b"),
        found(text, r"\bSize (?:(?:EU|US) )?[0-9A-Z]+(?: EU| US)?\b"),
        found(text, r"\b(?:EU|US) [0-9]+\b"),
    )


def weight(text: Column) -> Column:
    number = r"[0-9]+(?:\.[0-9]+)?"
    return F.coalesce(
        found(text, rf"(?i)\b{number}\s?(?:kg|g|lbs|lb|oz)\b"),
        found(text, rf"(?i)\b{number}\s?ct(?: (?:total|{alternation(K.GEMS)}))?\b"),
    )


def work_type(text: Column) -> Column:
    return (
        F.when(text.rlike(words(K.HANDWORK_TERMS)), "Handwork")
        .when(text.rlike(words(K.MACHINE_TERMS)), "Machine work")
        .when(house(text).isNotNull(), "Machine work")
        .otherwise("Unknown")
    )


def limited_edition(text: Column) -> Column:
    return text.rlike(words(K.RARITY_TERMS))


def price_line_mark(line: Column) -> Column:
    return contains_any(line, K.PRICE_LINE_MARKS)
