"""Link extraction.

All per-page work (selector choice, order, de-duplication, quota, next page) runs on the array of the page's own
anchors, so it needs no shuffle. Rows are exploded only where links of different pages meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions import urls as U
from curiomill.functions.html import anchors
from curiomill.functions.text import contains_any, once
from curiomill.session import computed_once


def with_anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    return computed_once(pages.withColumn("anchors", anchors(F.col(html))))


def _has_class(classes: Column, name: Column) -> Column:
    return F.concat(F.lit(" "), classes, F.lit(" ")).contains(F.concat(F.lit(" "), name, F.lit(" ")))


def selector_rule(selector: Column) -> Column:
    """Struct of the parts of a selector that ``matches_rule`` compares. Worked out once a page, not for each anchor."""
    return F.struct(
        selector.alias("selector"),
        F.regexp_extract(selector, r"""^a\[href\*=["']?([^"'\]]*)["']?\]$""", 1).alias("part"),
        F.regexp_extract(selector, r"""^a\[rel=["']?([^"'\]]*)["']?\]$""", 1).alias("rel"),
        F.regexp_extract(selector, r"""^a\[data-tn=["']?([^"'\]]*)["']?\]$""", 1).alias("tn"),
        F.regexp_extract(selector, r"^a\.([\w-]+)$", 1).alias("cls"),
    )


def matches_rule(a: Column, rule: Column) -> Column:
    """Does the anchor match the rule of a selector? Covers the families that sources use; others are an error."""
    selector = rule["selector"]
    return (
        F.when(selector == "a", F.lit(True))
        .when(rule["part"] != "", a["href"].contains(rule["part"]))
        .when(rule["rel"] != "", a["rel"] == rule["rel"])
        .when(rule["tn"] != "", a["data_tn"] == rule["tn"])
        .when(rule["cls"] != "", _has_class(a["class"], rule["cls"]))
        .when(selector == "a[data-page-number]", a["numbered"])
        .when(selector.isNotNull(), F.raise_error(F.concat(F.lit("unsupported selector: "), selector)).cast("boolean"))
        .otherwise(F.lit(False))
    )


def matching(anchors_of: Column, selector: Column) -> Column:
    """Anchors that match the selector held in a column."""
    return once(selector_rule(selector), lambda rule: F.filter(anchors_of, lambda a: matches_rule(a, rule)))


def _href_contains(needle: str):
    return lambda a: a["href"].contains(needle)


def selected_anchors(selector: Column, wide: bool = False) -> Column:
    """Anchors of the page's own selector, else of the first fallback that matches any anchor."""
    every = F.col("anchors")
    choices = [matching(every, F.coalesce(selector, F.lit("a")))]
    for needle in K.FALLBACK_HREFS_WIDE if wide else K.FALLBACK_HREFS:
        choices.append(F.filter(every, _href_contains(needle)))
    return F.coalesce(*[once(c, lambda hits: F.when(F.size(hits) > 0, hits)) for c in choices[:-1]], choices[-1])


def select_links(pages: DataFrame, selector: str = "product_selector") -> DataFrame:
    """One row per anchor that the page's selector matches (page columns ``url``, ``html``)."""
    own = matching(F.col("anchors"), F.coalesce(selector, F.lit("a")))
    return (
        with_anchors(pages)
        .select(F.col("url").alias("page_url"), F.explode(own).alias("a"))
        .select("page_url", "a.pos", "a.href", "a.text")
    )


def product_links(
    pages: DataFrame, selector: str = "product_selector", wide: bool = False, quota: int | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Resolved product links of listing pages, selector fallbacks applied, at most ``quota`` per page.

    ``keep`` names columns of the page that its links carry on.
    """
    hrefs = F.filter(
        F.transform(selected_anchors(F.col(selector), wide), lambda a: F.struct(a["pos"], a["href"])),
        lambda a: a["href"] != "",
    )
    chosen = F.slice(hrefs, 1, quota) if quota is not None else hrefs
    return (
        with_anchors(pages)
        .select(F.col("url").alias("page_url"), *keep, F.explode(chosen).alias("a"))
        .select("page_url", "a.pos", U.resolve(F.col("page_url"), F.col("a.href")).alias("url"), *keep)
    )


def page_quota(target_rows: int, rows_so_far: int = 0) -> int:
    """Links queued per listing page."""
    return max(0, min(100, (target_rows - rows_so_far) * 3))


def page_links(pages: DataFrame) -> DataFrame:
    """Distinct links per page in first-seen order, without a selector: those that may be products."""
    resolved = F.transform(
        F.filter("anchors", lambda a: a["href"] != ""), lambda a: U.resolve(F.col("url"), a["href"])
    )
    kept = F.array_distinct(F.filter(resolved, U.looks_like_product))
    return (
        with_anchors(pages)
        .select(F.col("url").alias("page_url"), F.posexplode(kept).alias("pos", "url"))
        .withColumn("pos", F.col("pos").cast("bigint"))
    )


def distinct_links(links: DataFrame) -> DataFrame:
    """First position of every link of a page, for links that are rows already."""
    return links.groupBy("page_url", "url").agg(F.min("pos").alias("pos"))


def unvisited(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Links that are not in the visited table (column ``url``)."""
    return links.join(visited.select("url"), "url", "left_anti")


def link_counters(pages: DataFrame, visited: DataFrame) -> DataFrame:
    """Per page: links in all, new ones, already visited ones. Pages without links count 0."""
    links = page_links(pages)
    marked = links.join(visited.select("url").distinct().withColumn("seen", F.lit(True)), "url", "left")
    counts = marked.groupBy("page_url").agg(
        F.count("*").alias("total"), F.count_if(F.col("seen").isNotNull()).alias("already_visited")
    )
    counted = pages.select(F.col("url").alias("page_url")).join(counts, "page_url", "left")
    total, seen = F.coalesce("total", F.lit(0)), F.coalesce("already_visited", F.lit(0))
    return counted.select(
        "page_url", total.alias("total"), (total - seen).alias("new_links"), seen.alias("already_visited")
    )


def first_seen(links: DataFrame, key: str = "url", order: str = "pos") -> DataFrame:
    """One row per key, the earliest by order; partial minimum before the shuffle."""
    rest = [c for c in links.columns if c != key]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("first")
    return links.groupBy(key).agg(first).select(key, *[F.col("first")[c].alias(c) for c in rest])


def queue_products(links: DataFrame) -> DataFrame:
    """Candidate URLs for the product queue.

    ``links`` has page_url, pos, url, category, base_url. Item URLs are made canonical, tagged with the category,
    de-duplicated, and those of another site dropped afterwards.
    """
    tagged = links.withColumn("url", U.tag_category(U.canonical_item(F.col("url")), F.col("category")))
    once = first_seen(tagged)
    return once.filter(U.same_site(F.col("url"), F.coalesce("base_url", "page_url")))


def gate_products(candidates: DataFrame, junk_match: str = "substring") -> DataFrame:
    """Keep URLs with a product hint and without a junk part."""
    url = F.col("url")
    return candidates.filter(U.has_product_hint(url) & ~U.is_junk(url, junk_match))


# -- next page ------------------------------------------------------------------


def next_page(selector: Column, short: bool = False) -> Column:
    """Href of the next page from the ``anchors`` column: own selector, known patterns, then link text."""
    every = F.col("anchors")

    def href(hits: Column) -> Column:
        return F.nullif(F.get(hits, F.lit(0))["href"], F.lit(""))

    def first(rule) -> Column:
        return href(F.filter(every, rule))

    own = F.when(selector.isNotNull(), href(matching(every, selector)))
    if short:
        return own
    rules = [
        lambda a: _has_class(a["class"], F.lit("next")),
        lambda a: _has_class(a["class"], F.lit("pagination-next")),
        lambda a: a["aria_label"] == "Next",
        lambda a: a["rel"] == "next",
        lambda a: _has_class(a["item_class"], F.lit("next")),
        lambda a: F.lower(a["text"]).isin(K.NEXT_TEXTS) & (a["href"] != ""),
    ]
    return F.coalesce(own, *[first(r) for r in rules])


def next_page_links(pages: DataFrame, selector: str = "next_page_selector", short: bool = False) -> DataFrame:
    """(page_url, next_url) for every page; null when the page has no next link."""
    found = with_anchors(pages).select(F.col("url").alias("page_url"), next_page(F.col(selector), short).alias("href"))
    return computed_once(found).select("page_url", U.resolve(F.col("page_url"), F.col("href")).alias("next_url"))


# -- probes ------------------------------------------------------------------


def classify_links(pages: DataFrame) -> DataFrame:
    """Every link with product and next-page flags."""
    href, text = F.lower("a.href"), F.lower("a.text")
    marks = F.lower(F.col("a.class")).contains("page") | F.lower(F.col("a.class")).contains("pagination")
    return (
        with_anchors(pages)
        .select(F.col("url").alias("page_url"), F.explode("anchors").alias("a"))
        .select(
            "page_url",
            "a.pos",
            "a.href",
            contains_any(F.col("a.href"), ["/item/", "/lot/"]).alias("is_product"),
            (
                contains_any(href, ["page=", "next"])
                | text.contains("next")
                | marks
                | F.lower("a.data_tn").contains("pagination")
            ).alias("is_next"),
        )
    )


def site_classes(urls: DataFrame, url: str = "url") -> DataFrame:
    """URLs with their site class flags."""
    return urls.select(
        url,
        U.is_blocked_class(F.col(url)).alias("is_blocked_class"),
        U.is_auction(F.col(url)).alias("is_auction"),
    )
