"""SQL fragments for the comparison texts (DuckDB dialect)."""

from __future__ import annotations


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_of(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {quote(w)})" for w in words) + ")"


def netloc(url: str) -> str:
    return rf"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"


def site(url: str) -> str:
    return f"replace({netloc(url)}, 'www.', '')"


def strip(column: str) -> str:
    return rf"regexp_replace({column}, '^\s+|\s+$', '', 'g')"


def decode(column: str) -> str:
    out = column
    for entity, char in [
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "),
        ("&euro;", "€"), ("&pound;", "£"), ("&amp;", "&"),
    ]:
        out = f"replace({out}, {quote(entity)}, {quote(char)})"
    return out


def dom(html: str) -> str:
    return (
        rf"regexp_replace({html}, '(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g')"
    )


def raw_text(html: str) -> str:
    blocks = rf"regexp_replace({html}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g')"
    return strip(rf"regexp_replace(regexp_replace({blocks}, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')")


def visible_text(html: str) -> str:
    return strip(decode(rf"regexp_replace(regexp_replace({dom(html)}, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')"))


def resolve(base: str, href: str) -> str:
    """Covers the forms in the derived pages: at most one leading ``..``."""
    scheme = rf"regexp_extract({base}, '^([A-Za-z]+:)', 1)"
    root = rf"regexp_extract({base}, '^([A-Za-z]+://[^/?#]*)', 1)"
    folder = rf"regexp_extract({base}, '^[A-Za-z]+://[^/?#]*(/(?:[^?#]*/)?)', 1)"
    parent = rf"regexp_replace({folder}, '[^/]*/$', '')"
    return f"""CASE WHEN {href} = '' THEN {base}
 WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {href}
 WHEN starts_with({href}, '//') THEN {scheme} || {href}
 WHEN starts_with({href}, '/') THEN {root} || {href}
 WHEN starts_with({href}, '?') THEN regexp_extract({base}, '^([^?#]*)', 1) || {href}
 WHEN starts_with({href}, '#') THEN regexp_extract({base}, '^([^#]*)', 1) || {href}
 WHEN starts_with({href}, '../') THEN {root} || coalesce(nullif({parent}, ''), '/') || {href}[4:]
 ELSE {root} || coalesce(nullif({folder}, ''), '/') || {href} END"""


def attribute(tag: str, name: str) -> str:
    got = rf"""regexp_extract({tag}, '(?i)\s{name}\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1)"""
    return decode(rf"""regexp_replace({got}, '^["'']|["'']$', '', 'g')""")


def anchors(pages: str, *keep: str) -> str:
    """CTE ``anchors`` over a page table: one row per anchor with its attributes."""
    cols = "".join(f", {c}" for c in keep)
    return rf"""tokens AS (
 SELECT url AS page_url{cols}, unnest(l) AS tok, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos
 FROM (SELECT url{cols}, regexp_extract_all({dom('html')}, '(?i)(?:<li(?:\s[^>]*)?>[^<]*)?<a(?:\s[^>]*)?>[^<]*') AS l FROM {pages})),
tags AS (SELECT *, regexp_extract(tok, '(?is)(<a(?:\s[^>]*)?>)[^<]*$', 1) AS tag,
 regexp_extract(tok, '(?is)^(<li(?:\s[^>]*)?>)', 1) AS item FROM tokens),
anchors AS (SELECT page_url{cols}, pos, {strip(attribute('tag', 'href'))} AS href,
 {strip(decode(r"regexp_extract(tok, '(?s)>([^<>]*)$', 1)"))} AS text, {attribute('tag', 'class')} AS class, {attribute('tag', 'rel')} AS rel,
 {attribute('tag', 'data-tn')} AS data_tn, {attribute('tag', 'aria-label')} AS aria_label,
 regexp_matches(tag, '(?i)\sdata-page-number[\s=>/]') AS numbered, {attribute('item', 'class')} AS item_class FROM tags)"""


def has_class(column: str, name: str) -> str:
    return f"contains(' ' || {column} || ' ', ' {name} ')"


def matches_selector(selector: str) -> str:
    """Does the anchor row match the selector column?"""
    return rf"""CASE {selector} WHEN 'a' THEN true WHEN 'a.next' THEN {has_class('class', 'next')}
 WHEN 'a[rel=''next'']' THEN rel = 'next' WHEN 'a[data-tn=''page-forward'']' THEN data_tn = 'page-forward'
 WHEN 'a[data-page-number]' THEN numbered
 WHEN 'a[href*=''/p/'']' THEN contains(href, '/p/') WHEN 'a[href*=''/lot/'']' THEN contains(href, '/lot/')
 WHEN 'a[href*="/item/"]' THEN contains(href, '/item/') WHEN 'a[href*=''/products/'']' THEN contains(href, '/products/')
 ELSE false END"""


def site_currency(url: str, rules) -> str:
    cases = " ".join(f"WHEN {any_of(f'lower({url})', sites)} THEN '{code}'" for code, sites in rules)
    return f"CASE {cases} ELSE NULL END"


def to_inr(price: str, currency: str) -> str:
    return (
        f"CASE {currency} WHEN 'USD' THEN round({price} * 83.0::DOUBLE, 2) WHEN 'EUR' THEN round({price} * 90.0::DOUBLE, 2)"
        f" WHEN 'GBP' THEN round({price} * 107.0::DOUBLE, 2) ELSE {price} END"
    )


def parse_price(text: str) -> str:
    return f"TRY_CAST(regexp_replace({text}, '[^0-9.]', '', 'g') AS DOUBLE)"


def score(p: str = "current_market_price") -> str:
    req = " + ".join(
        f"CASE WHEN {strip(c)} <> '' THEN 5.0 ELSE 0.0 END" for c in ["material_used", "origin", "date_of_manufacture", "colour"]
    )
    opt = " + ".join(
        f"CASE WHEN {c} <> '' THEN 2.5 ELSE 0.0 END"
        for c in ["valuable_gem", "expensive_material", "brand", "dimensions", "weight", "seller_reputation"]
    )
    return f"""CAST((CASE WHEN {p} > 0 THEN 30.0 ELSE 0.0 END + {req} + {opt}
 + CASE WHEN {strip('brand')} <> '' THEN 10.0 ELSE 0.0 END
 + CASE WHEN coalesce(defects, '') <> '' OR coalesce(expensive_material, '') <> '' OR coalesce(valuable_gem, '') <> '' THEN 5.0 ELSE 0.0 END
 + CASE WHEN length(material_used) > 10 THEN 5.0 ELSE 0.0 END + CASE WHEN work_type <> 'Unknown' THEN 5.0 ELSE 0.0 END
 + CASE WHEN {p} BETWEEN 8300 AND 83000000 THEN 10.0 WHEN {p} >= 10 AND {p} < 8300 THEN 5.0 ELSE 0.0 END) AS DOUBLE)"""


def rounded(score_sql: str) -> str:
    return f"""CASE WHEN {score_sql} % 1 = 0 THEN {score_sql} / 100
 WHEN {score_sql} IN (32.5, 37.5, 52.5, 67.5, 77.5, 87.5, 92.5) THEN ({score_sql} + 0.5) / 100 ELSE ({score_sql} - 0.5) / 100 END"""


def polluted(url: str, price: str, dirty) -> str:
    return f"({any_of(url, dirty)} OR (contains({url}, 'itokri.com') AND coalesce({price} = 10000, false)))"
