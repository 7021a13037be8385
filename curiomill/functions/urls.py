"""URL expressions: resolving, domains, canonical forms and filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions.text import contains_any


def netloc(url: Column) -> Column:
    """Authority part of a URL (port kept); empty when the URL has none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def site(url: Column) -> Column:
    """Authority with every ``www.`` removed."""
    return F.replace(netloc(url), F.lit("www."), F.lit(""))


def _remove_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments of an absolute path, at any depth."""
    parts = F.split(path, "/")
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, part: F.when(part == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(part == ".", acc)
        .otherwise(F.array_append(acc, part)),
    )
    joined = F.concat(F.array_join(folded, "/"), F.when(path.rlike(r"/\.{1,2}$"), "/").otherwise(""))
    return F.concat(F.lit("/"), F.regexp_replace(joined, r"^/", ""))


def resolve(base: Column, href: Column) -> Column:
    """Absolute form of ``href`` found on page ``base``."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    root = F.concat(scheme, F.lit("//"), netloc(base))
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path, r"^/(.*/)", 1))
    before_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    before_fragment = F.regexp_extract(base, r"^([^#]*)", 1)

    target_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    target_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    joined = F.when(target_path.startswith("/"), target_path).otherwise(
        F.regexp_replace(F.concat(folder, target_path), r"(?<=.)/{2,}", "/")
    )
    clean = F.when(joined.contains("/."), _remove_dots(joined)).otherwise(joined)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("?"), F.concat(before_query, href))
        .when(href.startswith("#"), F.concat(before_fragment, href))
        .otherwise(F.concat(root, clean, target_rest))
    )


def looks_like_product(url: Column) -> Column:
    """Keep unless the lower-cased URL has an excluded part."""
    return ~contains_any(F.lower(url), K.LINK_EXCLUDES)


def has_product_hint(url: Column) -> Column:
    return contains_any(url, K.PRODUCT_HINTS)


def is_junk(url: Column, match: str = "substring") -> Column:
    """Junk path test. ``segment`` compares the unanchored words with whole path segments only."""
    low = F.lower(url)
    if match == "substring":
        return contains_any(low, K.JUNK_PATHS)
    anchored = [w for w in K.JUNK_PATHS if w.startswith("/")]
    loose = [w for w in K.JUNK_PATHS if not w.startswith("/")]
    return contains_any(low, anchored) | low.rlike("/(?:" + "|".join(loose) + ")(?:[/?#]|$)")


def same_site(left: Column, right: Column) -> Column:
    """False only when both sites are known and differ."""
    return (site(left) == "") | (site(right) == "") | (site(left) == site(right))


def canonical_item(url: Column) -> Column:
    """Strip the slug after the item number on the one auction site that has slug variants."""
    return F.when(
        url.contains("liveauctioneers.com/item/"), F.regexp_replace(url, r"(/item/\d+)[^?/]*", "$1")
    ).otherwise(url)


def tag_category(url: Column, category: Column) -> Column:
    """Append ``src_cat`` when a category is known."""
    mark = F.when(url.contains("?"), "&").otherwise("?")
    return F.when(
        F.coalesce(category, F.lit("")) != "", F.concat(url, mark, F.lit("src_cat="), category)
    ).otherwise(url)


def dedup_key(url: Column) -> Column:
    """Item path without host where there is one, else the URL itself."""
    item = F.regexp_extract(url, r"/item/\d+", 0)
    return F.when(item != "", item).otherwise(url)


def is_auction(url: Column) -> Column:
    return contains_any(F.lower(url), K.AUCTION_SITES)


def is_blocked_class(url: Column) -> Column:
    return contains_any(F.lower(url), K.BLOCKED_SITES)


def site_currency(url: Column) -> Column:
    """Known currency of the site, first rule wins, null when no rule fits."""
    low = F.lower(url)
    return reduce(
        lambda acc, rule: F.when(contains_any(low, rule[1]), rule[0]).otherwise(acc),
        reversed(K.CURRENCY_SITES),
        F.lit(None).cast("string"),
    )


def path_part(url: Column, index: int) -> Column:
    """Part of the URL split at ``/``; negative counts from the end; null when absent."""
    return F.try_element_at(F.split(url, "/"), F.lit(index))


def has_rarity_word(url: Column) -> Column:
    return contains_any(F.lower(url), K.RARITY_URL_WORDS)
