"""Queries for page content (P1-P18)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.registry import query
from curiomill.functions import html as H
from curiomill.functions import urls as U
from curiomill.functions.selectors import split_selector
from curiomill.operators import elements, evidence

# -- SQL twins of the selector cascades ------------------------------------------


def _open_tag(selector: str) -> str:
    """Pattern of an opening tag for a selector with one condition."""
    tag, parts = split_selector(selector)
    name = tag or "[A-Za-z][^\\s>/]*"
    if not parts:
        return rf"<(?i:{name})(?:\s[^>]*)?>"
    kind, attr, value = parts[0]
    v = re.escape(value).replace("'", "''")
    if kind == "has":
        return rf"<{name}(?:\s[^>]*)?\s{attr}(?:[\s=][^>]*)?>"
    if kind == "equals":
        cond = rf'(?:"{v}"|{v})'
    elif kind == "contains":
        cond = rf'"[^">]*{v}[^">]*"'
    else:
        cond = rf'(?:"(?:[^">]*\s)?{v}(?:\s[^">]*)?"|{v})'
    return rf"<{name}(?:\s[^>]*)?\s{attr}={cond}(?:\s[^>]*)?>"


def _texts(selector: str) -> str:
    raw = rf"regexp_extract_all(d, '{_open_tag(selector)}([^<]*)', 1)"
    return f"list_transform({raw}, lambda t: {Q.strip(Q.decode('t'))})"


def _first(selectors, size: int = 0, longer: int | None = None) -> str:
    options = []
    for s in selectors:
        text = f"{_texts(s)}[1]"
        if size:
            text = f"substring({text}, 1, {size})"
        options.append(text if longer is None else f"CASE WHEN length({text}) > {longer} THEN {text} END")
    return "coalesce(" + ", ".join(options) + ")"


def _joined(selectors, take: int, sep: str = " ", size: int = 0, longer: int = 0, drop: bool = True) -> str:
    options = []
    for s in selectors:
        texts = f"{_texts(s)}[1:{take}]"
        if drop:
            texts = f"list_filter({texts}, lambda t: t <> '')"
        text = f"array_to_string({texts}, '{sep}')"
        if size:
            text = f"substring({text}, 1, {size})"
        options.append(f"CASE WHEN length({text}) > {longer} THEN {text} END")
    return "coalesce(" + ", ".join(options) + ")"


TITLE = _first(K.TITLE_SELECTORS)
PRICE = _joined(K.PRICE_SELECTORS, 3)
DESCRIPTION = _first(K.DESCRIPTION_SELECTORS, 800, 30)
SPECS = _joined(K.SPECS_SELECTORS, 3, size=800, longer=20, drop=False)
BRAND = _first(K.BRAND_SELECTORS, 100, 2)
WIDE_SPECS = f"substring({_joined(K.WIDE_SPECS_SELECTORS, 8, ' | ')}, 1, 400)"
SELLER = _first(K.SELLER_SELECTORS)
ORIGIN = _first(K.ORIGIN_SELECTORS)
DOMS = f", doms AS (SELECT pos, url, html, status, {Q.dom('html')} AS d FROM product_pages)"

AUCTION = Q.any_of("lower(url)", K.AUCTION_SITES)

# JSON-LD offers of a page: price, currency, line
LD = """, blocks AS (SELECT url, unnest(l) AS b, generate_subscripts(l, 1) AS i
 FROM (SELECT url, regexp_extract_all(html, '(?is)<script[^>]+type=["'']application/ld\\+json["''][^>]*>(.*?)</script>', 1) AS l FROM product_pages)),
offers AS (SELECT url, i, CASE WHEN json_type(o) = 'ARRAY' THEN json_extract(o, '$[0]') ELSE o END AS o
 FROM (SELECT url, i, json_extract(b, '$.offers') AS o FROM blocks WHERE json_valid(b) AND json_type(CASE WHEN json_valid(b) THEN b ELSE '0' END) = 'OBJECT')),
priced AS (SELECT url, i, CASE WHEN json_type(o, '$.price') = 'NULL' THEN 'None' ELSE json_extract_string(o, '$.price') END AS price,
  CASE WHEN json_type(o, '$.priceCurrency') IS NULL THEN 'USD' WHEN json_type(o, '$.priceCurrency') = 'VARCHAR' THEN upper(json_extract_string(o, '$.priceCurrency')) END AS currency
 FROM offers WHERE json_type(o) = 'OBJECT' AND json_type(o, '$.price') IS NOT NULL),
ld_all AS (SELECT url, first(price ORDER BY i) FILTER (WHERE currency IS NOT NULL) AS gp, first(currency ORDER BY i) FILTER (WHERE currency IS NOT NULL) AS gc,
  last(price ORDER BY i) AS lp FROM priced GROUP BY url),
ld AS (SELECT url, coalesce(gp, lp) AS ld_price, coalesce(gc, 'USD') AS ld_currency, 'PRICE: ' || gp || ' ' || gc AS ld_line FROM ld_all)"""

EVIDENCE = f"""{DOMS}{LD}, texts AS (SELECT *, {Q.raw_text('html')} AS raw_text FROM doms),
reads AS (SELECT t.pos, t.url, t.raw_text, t.status, l.ld_price, l.ld_line, CASE WHEN NOT {AUCTION.replace('url', 't.url')} THEN coalesce(l.ld_currency, 'USD') END AS ld_currency,
  {TITLE} AS title, CASE WHEN coalesce(l.ld_price, '') = '' THEN {PRICE} END AS price_text,
  {DESCRIPTION} AS description, {SPECS} AS specs, {BRAND} AS brand_text
 FROM texts t LEFT JOIN ld l ON l.url = t.url AND NOT {AUCTION.replace('url', 't.url')}
 WHERE coalesce(t.status, 0) <> 403 AND NOT (contains(raw_text, 'Cloudflare') OR contains(raw_text, 'Just a moment...') OR contains(lower(raw_text), 'attention required'))),
parts AS (SELECT *, list_filter([ld_line, 'TITLE: ' || title, 'PRICE: ' || price_text, 'DESCRIPTION: ' || description, 'SPECS/DETAILS: ' || specs,
  'BRAND: ' || brand_text], lambda x: x IS NOT NULL) AS p FROM reads),
evidence AS (SELECT *, 'SOURCE URL: ' || url || chr(10) || chr(10) || CASE WHEN len(p) < 2 THEN 'PAGE TEXT:' || chr(10) || substring(raw_text, 1, 5000)
  ELSE array_to_string(p, chr(10)) END AS content FROM parts)"""

GATE = f"(NOT {AUCTION} OR {Q.any_of('lower(content)', K.AUCTION_MARKERS)})"


def product_pages(spark, sf):
    return table(spark, sf, "product_pages")


def clean_evidence(spark, sf):
    read = evidence.readable_pages(product_pages(spark, sf)).filter("skip_reason IS NULL")
    return evidence.evidence(read)


def _nodes(spark, sf, selectors):
    return evidence.with_nodes(product_pages(spark, sf), selectors)


# every body carries two bytes that are no UTF-8
@query("P1_decode_body", (), "SELECT page_id, html FROM pages")
def p1(spark, sf):
    body = F.concat(F.lit(bytearray(b"\xff")), F.col("html").cast("binary"), F.lit(bytearray(b"\xc3")))
    pages = table(spark, sf, "pages").select("page_id", body.alias("body"))
    none = F.lit(None).cast("string")
    return pages.select("page_id", H.page_html(F.col("body"), none, none).alias("html"))


@query("P2_strip_html", (), f"SELECT page_id, {Q.raw_text('html')} AS raw_text FROM pages")
def p2(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.raw_text(F.col("html")).alias("raw_text"))


@query(
    "P3_drop_challenges",
    ("product_pages",),
    f"""SELECT url FROM (SELECT url, {Q.raw_text('html')} AS t FROM product_pages)
 WHERE NOT (contains(t, 'Cloudflare') OR contains(t, 'Just a moment...') OR contains(lower(t), 'attention required'))""",
)
def p3(spark, sf):
    return product_pages(spark, sf).filter(~H.is_challenge(H.raw_text(F.col("html")))).select("url")


@query("P4_drop_forbidden", ("product_pages",), "SELECT url, CAST(status AS BIGINT) AS status FROM product_pages WHERE status IS NULL OR status <> 403")
def p4(spark, sf):
    kept = product_pages(spark, sf).filter(~H.is_forbidden(F.col("status")))
    return kept.select("url", F.col("status").cast("bigint").alias("status"))


@query(
    "P5_json_ld_offer",
    ("product_pages",),
    f"""{LD} SELECT p.url, l.ld_price, CASE WHEN NOT {AUCTION.replace('url', 'p.url')} THEN coalesce(l.ld_currency, 'USD') END AS ld_currency, l.ld_line
 FROM product_pages p LEFT JOIN ld l ON l.url = p.url AND NOT {AUCTION.replace('url', 'p.url')}""",
)
def p5(spark, sf):
    offer = F.when(~U.is_auction(F.col("url")), H.ld_offer(F.col("html")))
    return (
        product_pages(spark, sf)
        .select("url", offer.alias("ld"))
        .select("url", F.col("ld.price").alias("ld_price"), F.col("ld.currency").alias("ld_currency"), F.col("ld.line").alias("ld_line"))
    )


@query("P6_title", ("product_pages",), f"{DOMS} SELECT url, {TITLE} AS title FROM doms")
def p6(spark, sf):
    return _nodes(spark, sf, K.TITLE_SELECTORS).select("url", evidence.title(F.col("nodes")).alias("title"))


@query("P6_title_wide", (), f"SELECT url, {_first(['h1', 'title'])} AS title FROM (SELECT url, {Q.dom('html')} AS d FROM pages)")
def p6_wide(spark, sf):
    nodes = evidence.with_nodes(table(spark, sf, "pages"), K.WIDE_TITLE_SELECTORS)
    return nodes.select("url", evidence.title(F.col("nodes"), K.WIDE_TITLE_SELECTORS).alias("title"))


@query("P7_price_text", ("product_pages",), f"{DOMS} SELECT url, {PRICE} AS price_text FROM doms")
def p7(spark, sf):
    return _nodes(spark, sf, K.PRICE_SELECTORS).select("url", evidence.price_text(F.col("nodes")).alias("price_text"))


@query("P8_description", ("product_pages",), f"{DOMS} SELECT url, {DESCRIPTION} AS description FROM doms")
def p8(spark, sf):
    return _nodes(spark, sf, K.DESCRIPTION_SELECTORS).select(
        "url", evidence.description(F.col("nodes")).alias("description")
    )


@query("P9_specs", ("product_pages",), f"{DOMS} SELECT url, {SPECS} AS specs FROM doms")
def p9(spark, sf):
    return _nodes(spark, sf, K.SPECS_SELECTORS).select("url", evidence.specs(F.col("nodes")).alias("specs"))


@query("P10_specs_wide", ("product_pages",), f"{DOMS} SELECT url, {WIDE_SPECS} AS specs FROM doms")
def p10(spark, sf):
    return _nodes(spark, sf, K.WIDE_SPECS_SELECTORS).select("url", evidence.wide_specs(F.col("nodes")).alias("specs"))


@query("P11_brand", ("product_pages",), f"{DOMS} SELECT url, {BRAND} AS brand FROM doms")
def p11(spark, sf):
    return _nodes(spark, sf, K.BRAND_SELECTORS).select("url", evidence.brand(F.col("nodes")).alias("brand"))


@query("P12_seller", ("product_pages",), f"{DOMS} SELECT url, {SELLER} AS seller FROM doms")
def p12(spark, sf):
    return _nodes(spark, sf, K.SELLER_SELECTORS).select("url", evidence.seller(F.col("nodes")).alias("seller"))


@query("P13_origin", ("product_pages",), f"{DOMS} SELECT url, {ORIGIN} AS origin FROM doms")
def p13(spark, sf):
    return _nodes(spark, sf, K.ORIGIN_SELECTORS).select("url", evidence.origin(F.col("nodes")).alias("origin"))


@query("P14_evidence", ("product_pages",), f"{EVIDENCE} SELECT url, content FROM evidence")
def p14(spark, sf):
    return clean_evidence(spark, sf).select("url", "content")


_WIDE_PRICE = _joined([s for s in K.WIDE_PRICE_SELECTORS], 3)
_WIDE_DESC = _first(K.WIDE_DESCRIPTION_SELECTORS, 800, 30)
_WIDE_TITLE = _first([s for s in K.WIDE_TITLE_SELECTORS if s != "h1.product-title"])


@query(
    "P14_evidence_wide",
    ("product_pages",),
    f"""{DOMS}, parts AS (SELECT url, html, list_filter(['TITLE: ' || {_WIDE_TITLE}, 'PRICE: ' || {_WIDE_PRICE}, 'DESCRIPTION: ' || {_WIDE_DESC},
 'SPECS: ' || {WIDE_SPECS}, 'SELLER: ' || {SELLER}, 'ORIGIN: ' || {ORIGIN}], lambda x: x IS NOT NULL) AS p FROM doms)
SELECT url, 'SOURCE URL: ' || url || chr(10) || chr(10) || CASE WHEN len(p) < 2 THEN 'PAGE TEXT:' || chr(10) || substring({Q.visible_text('html')}, 1, 3000)
 ELSE array_to_string(p, chr(10)) END AS content FROM parts""",
)
def p14_wide(spark, sf):
    return evidence.wide_evidence(product_pages(spark, sf)).select("url", "content")


@query(
    "P14_evidence_page_text",
    (),
    f"""SELECT url, 'SOURCE URL: ' || url || chr(10) || chr(10) || 'PAGE TEXT:' || chr(10) || substring({Q.raw_text('html')}, 1, 5000) AS content FROM pages""",
)
def p14_text(spark, sf):
    status = F.lit(200).alias("status")
    read = evidence.readable_pages(table(spark, sf, "pages").select("url", "html", status))
    return evidence.evidence(read.filter("skip_reason IS NULL")).select("url", "content")


@query("P15_auction_gate", ("product_pages",), f"{EVIDENCE} SELECT url, {GATE} AS gate_open FROM evidence")
def p15(spark, sf):
    gate = evidence.passes_auction_gate(F.col("url"), F.col("content"))
    return clean_evidence(spark, sf).select("url", gate.alias("gate_open"))


@query(
    "P16_content_budget",
    (),
    """SELECT doc_id, p AS provider, substring(text, 1, CASE p WHEN 'ollama' THEN 5000 WHEN 'openai' THEN 8000 ELSE 10000 END) AS content
 FROM (SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN 'ollama' WHEN 1 THEN 'openai' ELSE 'groq' END AS p FROM documents)""",
)
def p16(spark, sf):
    provider = F.when(F.col("doc_id") % 3 == 0, "ollama").when(F.col("doc_id") % 3 == 1, "openai").otherwise("groq")
    docs = table(spark, sf, "documents").withColumn("provider", provider)
    return docs.select("doc_id", "provider", evidence.content_budget(F.col("text"), F.col("provider")).alias("content"))


@query(
    "P17_price_lines",
    ("product_pages",),
    f"""{DOMS}, pieces AS (SELECT url, list_filter(flatten(list_transform(regexp_extract_all(d, '>([^<]+)', 1),
  lambda t: string_split({Q.strip(Q.decode('t'))}, chr(10)))), lambda t: t <> '') AS l FROM doms),
lines AS (SELECT url, unnest(l) AS line, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS line_no FROM pieces)
SELECT url, line_no, line FROM lines WHERE {Q.any_of('line', K.PRICE_LINE_MARKS)}""",
)
def p17(spark, sf):
    return evidence.price_lines(product_pages(spark, sf))


_PROBES = [".price", "h1", ".product-price", "[itemprop=\"price\"]", "td"]


@query(
    "P18_selector_coverage",
    ("product_pages",),
    DOMS
    + ", hits AS ("
    + " UNION ALL ".join(f"SELECT url, {Q.quote(s)} AS selector, {_texts(s)} AS t FROM doms" for s in _PROBES)
    + ") SELECT url, selector, len(t) AS nodes, array_to_string(t[1:10], '|') AS samples FROM hits",
)
def p18(spark, sf):
    found = evidence.selector_coverage(product_pages(spark, sf), _PROBES)
    return found.withColumn("samples", F.array_join("samples", "|"))


def _joined(pattern: str, column: str = "d") -> str:
    """Joined texts of what the pattern gives, without tags."""
    plain = Q.strip(Q.decode("regexp_replace(regexp_replace(t, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')"))
    return f"array_to_string(list_transform(regexp_extract_all({column}, {Q.quote(pattern)}, 1), lambda t: {plain}), '|')"


def _select(pages, selectors: dict[str, str]):
    found = elements.select_texts(pages.select("url", "html"), selectors)
    return found.select("url", *[F.array_join(name, "|").alias(name) for name in selectors])


@query(
    "P18_nested_selectors",
    ("product_pages",),
    f"""{DOMS} SELECT url, {_joined('<h1[^>]*>(.*?)</h1>')} AS titles, {_joined('<td>(.*?)</td>')} AS cells, {_joined('<li>(.*?)</li>')} AS items,
 {_joined('<(?:div class="product-description"|p id="description")>(.*?)</(?:div|p)>')} AS about,
 {_joined('<(?:span|b) class="price(?: old)?">(.*?)</(?:span|b)>')} AS prices, '' AS none,
 {_joined('<body>(.*)</body>')} AS whole FROM doms""",
)
def p18_nested(spark, sf):
    """Descendants, children, lists and whole texts."""
    return _select(product_pages(spark, sf), {
        "titles": "body > h1.product-title", "cells": "table td, tr > th", "items": "ul > li", "about": "div.product-description, body > p#description",
        "prices": "html body > .price", "none": "table > td, .price .price", "whole": "body",
    })


@query(
    "L17_nested_selectors",
    ("listing_pages",),
    f"""SELECT url, {_joined('<a[^>]*>(.*?)</a>', "regexp_extract(d, '<nav>(.*?)</nav>', 1)")} AS menu,
 {_joined('<li class="next"><a[^>]*>(.*?)</a>')} AS next, {_joined('<a[^>]*class="card"[^>]*>(.*?)</a>')} AS cards, {_joined('<b>(.*?)</b>')} AS marked
 FROM (SELECT url, {Q.dom('html')} AS d FROM listing_pages)""",
)
def l17_nested(spark, sf):
    return _select(table(spark, sf, "listing_pages"), {"menu": "nav > a", "next": "li.next > a", "cards": "body > a.card", "marked": "body a > b"})


@query(
    "P6_nested_pages",
    (),
    f"SELECT url, {_joined('<h1[^>]*>(.*?)</h1>')} AS title FROM (SELECT url, {Q.dom('html')} AS d FROM pages)",
)
def p6_nested(spark, sf):
    return _select(table(spark, sf, "pages"), {"title": "html h1"})
