"""Site rules and lexicon hits attached to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions import urls as U
from curiomill.functions.text import contains_any
from curiomill.operators.phrases import phrase_hits

# lexicon terms by record field
LEXICON: dict[str, list[str]] = {
    "material_used": K.MATERIALS,
    "valuable_gem": K.GEMS,
    "expensive_material": K.PRECIOUS,
    "colour": K.COLOURS,
    "defects": K.DEFECT_TERMS,
    "limited_edition": K.RARITY_TERMS,
    "work_type": K.HANDWORK_TERMS + K.MACHINE_TERMS,
}


def _site_seller(url: Column) -> Column:
    low = F.lower(url)
    return reduce(
        lambda acc, rule: F.when(low.contains(rule[0]), rule[1]).otherwise(acc),
        reversed(K.SITE_SELLERS),
        F.lit(None).cast("string"),
    )


def site_rules(urls: DataFrame, url: str = "url") -> DataFrame:
    """URLs with the first rule of each kind that their text contains. The rules are a short fixed list."""
    column = F.col(url)
    return urls.select(
        url,
        U.site_currency(column).alias("currency"),
        U.is_auction(column).alias("is_auction"),
        U.is_blocked_class(column).alias("is_blocked"),
        _site_seller(column).alias("seller"),
        contains_any(column, K.DIRTY_SITES).alias("is_dirty"),
    )


def lexicon_hits(texts: DataFrame, key: str, text: str, lexicon: dict[str, list[str]] = LEXICON) -> DataFrame:
    """(key, field, term, hits): lexicon terms per text, all fields in one scan."""
    return phrase_hits(texts, key, text, lexicon)
