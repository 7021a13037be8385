"""Queries for URLs and links (L1-L24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.registry import query
from curiomill.functions import urls as U
from curiomill.operators import frontier, links, matching, sources_config
from curiomill.sources.store import append_sources

_LISTING_ANCHORS = ", " + Q.anchors("listing_pages", "product_selector", "next_page_selector", "category")
_PAGE_ANCHORS = Q.anchors("pages")
_SELECTED = Q.matches_selector("coalesce(product_selector, 'a')")
_HREF = Q.resolve("page_url", "href")


@query("L1_select_links", ("listing_pages",), f"{_LISTING_ANCHORS} SELECT page_url, pos, href, text FROM anchors WHERE {_SELECTED}")
def l1(spark, sf):
    return links.select_links(table(spark, sf, "listing_pages"))


def _cascade_sql(needles) -> str:
    cases = " ".join(f"WHEN contains(href, {Q.quote(n)}) THEN {i + 1}" for i, n in enumerate(needles))
    return f"""{_LISTING_ANCHORS},
ranked AS (SELECT *, CASE WHEN {_SELECTED} THEN 0 {cases} END AS rnk FROM anchors),
chosen AS (SELECT * FROM (SELECT *, min(rnk) OVER (PARTITION BY page_url) AS best FROM ranked) WHERE rnk = best AND href <> '')"""


@query("L2_selector_fallback", ("listing_pages",), f"{_cascade_sql(K.FALLBACK_HREFS)} SELECT page_url, pos, {_HREF} AS url FROM chosen")
def l2(spark, sf):
    return links.product_links(table(spark, sf, "listing_pages"))


@query("L2_selector_fallback_wide", ("listing_pages",), f"{_cascade_sql(K.FALLBACK_HREFS_WIDE)} SELECT page_url, pos, {_HREF} AS url FROM chosen")
def l2_wide(spark, sf):
    return links.product_links(table(spark, sf, "listing_pages"), wide=True)


_EXCLUDED = Q.any_of("lower(u)", K.LINK_EXCLUDES)
_PAGE_LINKS = f""", kept AS (SELECT page_url, pos, u FROM (SELECT page_url, pos, {_HREF} AS u FROM anchors WHERE href <> '') WHERE NOT {_EXCLUDED}),
page_links AS (SELECT page_url, u AS url, row_number() OVER (PARTITION BY page_url ORDER BY min(pos)) - 1 AS pos FROM kept GROUP BY page_url, u)"""


@query("L3_page_links", (), f"WITH {_PAGE_ANCHORS} {_PAGE_LINKS} SELECT page_url, pos, url FROM page_links")
def l3(spark, sf):
    return links.page_links(table(spark, sf, "pages"))


@query("L4_resolve_href", ("listing_pages",), f"{_LISTING_ANCHORS} SELECT page_url, pos, href, {_HREF} AS url FROM anchors")
def l4(spark, sf):
    every = links.with_anchors(table(spark, sf, "listing_pages")).select(
        F.col("url").alias("page_url"), F.explode("anchors").alias("a")
    )
    return every.select("page_url", "a.pos", "a.href", U.resolve(F.col("page_url"), F.col("a.href")).alias("url"))


@query(
    "L5_distinct_links",
    ("listing_pages",),
    f"{_LISTING_ANCHORS} SELECT page_url, {_HREF} AS url, min(pos) AS pos FROM anchors WHERE {_SELECTED} AND href <> '' GROUP BY ALL",
)
def l5(spark, sf):
    picked = links.select_links(table(spark, sf, "listing_pages")).filter("href <> ''")
    return links.distinct_links(
        picked.select("page_url", "pos", U.resolve(F.col("page_url"), F.col("href")).alias("url"))
    )


@query(
    "L6_drop_visited",
    ("listing_pages", "visited"),
    f"{_cascade_sql(K.FALLBACK_HREFS)} SELECT page_url, pos, url FROM (SELECT page_url, pos, {_HREF} AS url FROM chosen) WHERE url NOT IN (SELECT url FROM visited)",
)
def l6(spark, sf):
    return links.unvisited(links.product_links(table(spark, sf, "listing_pages")), table(spark, sf, "visited"))


@query("L6_visited_count", ("visited",), "SELECT count(DISTINCT url) AS visited FROM visited")
def l6_count(spark, sf):
    return table(spark, sf, "visited").agg(F.count_distinct("url").alias("visited"))


@query(
    "L7_link_counters",
    ("listing_pages", "visited"),
    f"""{_LISTING_ANCHORS} {_PAGE_LINKS}
SELECT p.url AS page_url, count(l.url) AS total, count(l.url) FILTER (WHERE l.url NOT IN (SELECT url FROM visited)) AS new_links,
 count(l.url) FILTER (WHERE l.url IN (SELECT url FROM visited)) AS already_visited
FROM listing_pages p LEFT JOIN page_links l ON l.page_url = p.url GROUP BY p.url""",
)
def l7(spark, sf):
    return links.link_counters(table(spark, sf, "listing_pages"), table(spark, sf, "visited"))


@query("L8_extract_domain", (), f"SELECT url, {Q.netloc('url')} AS netloc, {Q.site('url')} AS site FROM pages")
def l8(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select("url", U.netloc(url).alias("netloc"), U.site(url).alias("site"))


@query("L9_looks_like_product", (), f"SELECT url, NOT {Q.any_of('lower(url)', K.LINK_EXCLUDES)} AS kept FROM pages")
def l9(spark, sf):
    return table(spark, sf, "pages").select("url", U.looks_like_product(F.col("url")).alias("kept"))


_ALL_URLS = ", urls AS (SELECT url FROM product_pages UNION ALL SELECT url FROM listing_pages)"


def _all_urls(spark, sf):
    return table(spark, sf, "product_pages").select("url").unionByName(table(spark, sf, "listing_pages").select("url"))


@query("L10_product_hint", ("product_pages", "listing_pages"), f"{_ALL_URLS} SELECT url FROM urls WHERE {Q.any_of('url', K.PRODUCT_HINTS)}")
def l10(spark, sf):
    return _all_urls(spark, sf).filter(U.has_product_hint(F.col("url")))


_SEGMENT = r"(contains(lower(url), '/pages/') OR contains(lower(url), '/policy') OR contains(lower(url), '/terms') OR contains(lower(url), '/contact') OR contains(lower(url), '/about') OR contains(lower(url), '/privacy') OR contains(lower(url), '/similar/') OR regexp_matches(lower(url), '/(login|register|cart|checkout|buyer-protection|partnership|faq)([/?#]|$)'))"


@query("L11_junk_path", ("product_pages",), f"SELECT url, {Q.any_of('lower(url)', K.JUNK_PATHS)} AS junk, {_SEGMENT} AS junk_segment FROM product_pages")
def l11(spark, sf):
    url = F.col("url")
    return table(spark, sf, "product_pages").select(
        "url", U.is_junk(url).alias("junk"), U.is_junk(url, "segment").alias("junk_segment")
    )


@query(
    "L12_same_site",
    ("listing_pages",),
    f"""{_cascade_sql(K.FALLBACK_HREFS)}, hrefs AS (SELECT page_url, pos, {_HREF} AS url FROM chosen)
SELECT page_url, pos, url FROM hrefs WHERE {Q.site('page_url')} = '' OR {Q.site('url')} = '' OR {Q.site('page_url')} = {Q.site('url')}""",
)
def l12(spark, sf):
    found = links.product_links(table(spark, sf, "listing_pages"))
    return found.filter(U.same_site(F.col("page_url"), F.col("url")))


CANON = r"CASE WHEN contains({u}, 'liveauctioneers.com/item/') THEN regexp_replace({u}, '(/item/[0-9]+)[^?/]*', '\1') ELSE {u} END"
TAG = "CASE WHEN coalesce(category, '') <> '' THEN {u} || CASE WHEN contains({u}, '?') THEN '&' ELSE '?' END || 'src_cat=' || category ELSE {u} END"


@query(
    "L13_canonical_item",
    ("product_pages",),
    f"SELECT url, {CANON.format(u='url')} AS canonical FROM product_pages",
)
def l13(spark, sf):
    return table(spark, sf, "product_pages").select("url", U.canonical_item(F.col("url")).alias("canonical"))


@query("L14_tag_category", ("listing_pages",), f"SELECT url, {TAG.format(u='url')} AS tagged FROM listing_pages")
def l14(spark, sf):
    return table(spark, sf, "listing_pages").select(
        "url", U.tag_category(F.col("url"), F.col("category")).alias("tagged")
    )


QUEUE = f"""{_cascade_sql(K.FALLBACK_HREFS)},
canon AS (SELECT page_url, pos, category, {CANON.format(u='u')} AS u FROM (SELECT page_url, pos, category, {_HREF} AS u FROM chosen)),
tagged AS (SELECT page_url, pos, {TAG.format(u='u')} AS url FROM canon),
once AS (SELECT url, page_url FROM (SELECT url, page_url, row_number() OVER (PARTITION BY url ORDER BY page_url, pos) AS rn FROM tagged) WHERE rn = 1)"""


def _queue(spark, sf):
    found = links.product_links(table(spark, sf, "listing_pages"), keep=("category",))
    return found.select(
        F.struct("page_url", "pos").alias("pos"), "page_url", "url", "category", F.lit(None).cast("string").alias("base_url")
    )


@query("L15_queue_products", ("listing_pages",), f"{QUEUE} SELECT url, page_url FROM once WHERE {Q.site('url')} = '' OR {Q.site('page_url')} = {Q.site('url')}")
def l15(spark, sf):
    return links.queue_products(_queue(spark, sf)).select("url", "page_url")


_MATCH = f""", targets AS (SELECT url FROM listing_pages UNION ALL SELECT url FROM product_pages UNION ALL SELECT page_url FROM (SELECT 'https://www.unknown.org/x/' || k AS page_url FROM listings)
 UNION ALL SELECT root FROM listings),
cand AS (SELECT t.url, s.pos, CASE WHEN t.url = s.base_url THEN 1 WHEN starts_with(t.url, s.base_url) OR starts_with(s.base_url, t.url) THEN 2
  WHEN {Q.site('t.url')} = {Q.site('s.base_url')} THEN 3 END AS c FROM (SELECT DISTINCT url FROM targets) t, sources s WHERE coalesce(s.enabled, true)),
best AS (SELECT url, c, pos FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY c, pos) AS rn FROM cand WHERE c IS NOT NULL) WHERE rn = 1)
SELECT t.url, CAST(b.c AS BIGINT) AS match_class, b.pos AS source_pos FROM targets t LEFT JOIN best b ON b.url = t.url"""


def _targets(spark, sf):
    listings = table(spark, sf, "listings")
    return (
        _all_urls(spark, sf)
        .unionByName(listings.select(F.concat(F.lit("https://www.unknown.org/x/"), F.col("k").cast("string")).alias("url")))
        .unionByName(listings.select(F.col("root").alias("url")))
    )


@query("L16_match_source", ("product_pages", "listing_pages", "sources"), _MATCH)
def l16(spark, sf):
    sources = sources_config.enabled_sources(table(spark, sf, "sources"))
    return matching.match_sources(_targets(spark, sf), sources)


def _next_sql(pages_rule: str = "") -> str:
    texts = ", ".join(Q.quote(t) for t in K.NEXT_TEXTS)
    sel = Q.matches_selector("next_page_selector")
    rules = [
        f"next_page_selector IS NOT NULL AND {sel}", Q.has_class("class", "next"), Q.has_class("class", "pagination-next"),
        "aria_label = 'Next'", "rel = 'next'", Q.has_class("item_class", "next"),
        f"lower(text) IN ({texts}) AND href <> ''",
    ]
    firsts = ", ".join(
        f"nullif(first(href ORDER BY pos) FILTER (WHERE {r}), '') AS r{i}" for i, r in enumerate(rules)
    )
    return f"""{_LISTING_ANCHORS}, firsts AS (SELECT page_url, {firsts} FROM anchors GROUP BY page_url),
nexts AS (SELECT p.url AS page_url, coalesce(r0, r1, r2, r3, r4, r5, r6) AS href, r0 AS own FROM listing_pages p LEFT JOIN firsts f ON f.page_url = p.url),
next_pages AS (SELECT page_url, CASE WHEN href IS NULL THEN NULL ELSE {_HREF} END AS next_url FROM nexts)"""


@query("L17_next_page", ("listing_pages",), f"{_next_sql()} SELECT page_url, next_url FROM next_pages")
def l17(spark, sf):
    return links.next_page_links(table(spark, sf, "listing_pages"))


@query(
    "L17_next_page_short",
    ("listing_pages",),
    f"{_next_sql()} SELECT page_url, CASE WHEN own IS NULL THEN NULL ELSE {Q.resolve('page_url', 'own')} END AS next_url FROM nexts",
)
def l17_short(spark, sf):
    return links.next_page_links(table(spark, sf, "listing_pages"), short=True)


@query(
    "L18_page_quota",
    ("listing_pages",),
    f"{_cascade_sql(K.FALLBACK_HREFS_WIDE)}, n AS (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY pos) AS rn FROM chosen) SELECT page_url, pos, {_HREF} AS url FROM n WHERE rn <= 3",
)
def l18(spark, sf):
    return links.product_links(table(spark, sf, "listing_pages"), wide=True, quota=links.page_quota(1))


@query(
    "L19_follow_pagination",
    ("listing_pages", "sources"),
    f"""{_next_sql()}, walk AS (
 SELECT s.pos AS owner, p.page_url, CAST(1 AS BIGINT) AS page_no FROM sources s JOIN next_pages p ON p.page_url = s.base_url
 UNION SELECT w.owner, n.next_url, w.page_no + 1 FROM walk w JOIN next_pages n ON n.page_url = w.page_url JOIN next_pages k ON k.page_url = n.next_url
 WHERE n.next_url IS NOT NULL)
SELECT page_url, owner, page_no FROM (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY owner, page_no) AS rn FROM walk) WHERE rn = 1""",
)
def l19(spark, sf):
    nexts = links.next_page_links(table(spark, sf, "listing_pages"))
    return frontier.follow_pagination(nexts, table(spark, sf, "sources"))


@query(
    "L20_discover_auctions",
    ("calendar_pages",),
    f""", {Q.anchors('calendar_pages')}, hrefs AS (SELECT DISTINCT href FROM anchors WHERE starts_with(href, '/auction/') AND NOT contains(href, '/lot/'))
SELECT CAST(NULL AS BIGINT) AS pos, 'bonhams_auto_' || a AS name, 'https://www.bonhams.com' || href AS base_url, 'auction_auto_discovered' AS category,
 'a[href*=''/lot/'']' AS product_selector, 'a[rel=''next'']' AS next_page_selector, CAST(6 AS BIGINT) AS priority, true AS enabled
FROM (SELECT href, string_split(trim(href, '/'), '/')[2] AS a FROM hrefs) WHERE a IS NOT NULL""",
)
def l20(spark, sf):
    return sources_config.discover_auctions(table(spark, sf, "calendar_pages"))


@query(
    "L20_append_discovered",
    ("sources", "calendar_pages"),
    f""", {Q.anchors('calendar_pages')}, hrefs AS (SELECT DISTINCT href FROM anchors WHERE starts_with(href, '/auction/') AND NOT contains(href, '/lot/')),
found AS (SELECT 'https://www.bonhams.com' || href AS base_url FROM hrefs WHERE string_split(trim(href, '/'), '/')[2] IS NOT NULL)
SELECT pos, base_url FROM sources UNION ALL SELECT (SELECT max(pos) FROM sources) + row_number() OVER (ORDER BY base_url), base_url FROM found""",
)
def l20_append(spark, sf):
    found = sources_config.discover_auctions(table(spark, sf, "calendar_pages"))
    return append_sources(table(spark, sf, "sources"), found).select("pos", "base_url")


@query(
    "L21_classify_links",
    ("listing_pages",),
    f"""{_LISTING_ANCHORS} SELECT page_url, pos, href, contains(href, '/item/') OR contains(href, '/lot/') AS is_product,
 contains(lower(href), 'page=') OR contains(lower(href), 'next') OR contains(lower(text), 'next') OR contains(lower(class), 'page')
 OR contains(lower(class), 'pagination') OR contains(lower(data_tn), 'pagination') AS is_next FROM anchors""",
)
def l21(spark, sf):
    return links.classify_links(table(spark, sf, "listing_pages"))


@query(
    "L22_site_classes",
    ("product_pages",),
    f"SELECT url, {Q.any_of('lower(url)', K.BLOCKED_SITES)} AS is_blocked_class, {Q.any_of('lower(url)', K.AUCTION_SITES)} AS is_auction FROM product_pages",
)
def l22(spark, sf):
    return links.site_classes(table(spark, sf, "product_pages"))


_NEW = """SELECT k + 1000000000 AS pos, 'https://www.liveauctioneers.com/c/' || type || '/' || CAST(k AS VARCHAR) || '/' AS url, type, k FROM listings"""


def _new_urls(spark, sf):
    url = F.concat(F.lit("https://www.liveauctioneers.com/c/"), "type", F.lit("/"), F.col("k").cast("string"), F.lit("/"))
    return table(spark, sf, "listings").select((F.col("k") + 1_000_000_000).alias("pos"), url.alias("url"))


def _rewrite_sql(category: str, old: str) -> str:
    return f""", fresh AS ({_NEW}) {old}
UNION ALL SELECT pos, 'liveauctioneers_' || {category}, url, {category}, 'a[href*="/item/"]', 'a[rel="next"]', CAST(1 AS BIGINT), true FROM fresh"""


_SOURCE_COLS = "pos, name, base_url, category, product_selector, next_page_selector, priority"


@query(
    "L23_disable_and_append",
    ("listings", "sources"),
    _rewrite_sql("CAST(k AS VARCHAR)", f"SELECT {_SOURCE_COLS}, false AS enabled FROM sources"),
)
def l23(spark, sf):
    return sources_config.disable_and_append(table(spark, sf, "sources"), _new_urls(spark, sf))


@query(
    "L24_replace_by_prefix",
    ("listings", "sources"),
    _rewrite_sql("type", f"SELECT {_SOURCE_COLS}, enabled FROM sources WHERE NOT starts_with(name, 'src_1')"),
)
def l24(spark, sf):
    return sources_config.replace_by_prefix(table(spark, sf, "sources"), _new_urls(spark, sf), "src_1")
