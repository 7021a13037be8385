"""Queries for the joins on their own, over the large tables (J1-J8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.records import X3_SQL, X11_SQL, x3, x11
from curiomill.catalog.registry import query
from curiomill.functions.text import words
from curiomill.operators import dedup, links, matching, rules

_LINE_URL = """concat(CASE l_suppkey % 6 WHEN 0 THEN 'https://www.novica.com' WHEN 1 THEN 'https://www.catawiki.com' WHEN 2 THEN 'https://www.bonhams.com'
 WHEN 3 THEN 'https://www.liveauctioneers.com' WHEN 4 THEN 'https://itokri.com' ELSE 'https://www.unknown.org' END, '/c/', CAST(l_suppkey AS STRING), '/',
 CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END)"""


@query(
    "J1_url_to_source",
    ("sources",),
    f""", targets AS (SELECT DISTINCT {_LINE_URL} AS url FROM lineitem),
cand AS (SELECT t.url, s.pos, CASE WHEN t.url = s.base_url THEN 1 WHEN starts_with(t.url, s.base_url) OR starts_with(s.base_url, t.url) THEN 2
  WHEN {Q.site('t.url')} = {Q.site('s.base_url')} THEN 3 END AS c FROM targets t, sources s),
best AS (SELECT url, c, pos FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY c, pos) AS rn FROM cand WHERE c IS NOT NULL) WHERE rn = 1)
SELECT t.url, CAST(b.c AS BIGINT) AS match_class, b.pos AS source_pos FROM targets t LEFT JOIN best b ON b.url = t.url""",
)
def j1(spark, sf):
    urls = table(spark, sf, "lineitem").select(F.expr(_LINE_URL).alias("url")).distinct()
    return matching.match_sources(urls, table(spark, sf, "sources"))


@query(
    "J2_anti_stored",
    (),
    f"""SELECT source_url, min(pos) AS pos FROM (SELECT {_LINE_URL} AS source_url, l_orderkey * 8 + l_linenumber AS pos FROM lineitem)
 WHERE source_url NOT IN (SELECT {_LINE_URL} FROM lineitem WHERE l_orderkey % 3 = 0) GROUP BY source_url""",
)
def j2(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.expr(_LINE_URL).alias("source_url"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"), "l_orderkey")
    return dedup.new_rows(lines.select("source_url", "pos"), lines.filter("l_orderkey % 3 = 0"), "pos")


@query("J3_anti_visited", (), f"SELECT l_orderkey, l_linenumber, {_LINE_URL} AS url FROM lineitem WHERE {_LINE_URL} NOT IN (SELECT {_LINE_URL} FROM lineitem WHERE l_linenumber = 1)")
def j3(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_LINE_URL).alias("url"))
    return links.unvisited(lines, lines.filter("l_linenumber = 1"))


@query("J4_anti_purge_list", (), """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 200000)""")
def j4(spark, sf):
    doomed = table(spark, sf, "orders").filter("o_totalprice > 200000").select(F.col("o_orderkey").alias("l_orderkey"))
    return dedup.delete_keys(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), doomed, "l_orderkey")


@query("J5_rate_join", (), X11_SQL)
def j5(spark, sf):
    return x11(spark, sf)


def _first(column: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({column}), {Q.quote(needle)}) THEN {Q.quote(value)}" for needle, value in pairs) + " END"


@query(
    "J6_site_rules",
    (),
    f"""SELECT url, {Q.site_currency('url', K.CURRENCY_SITES)} AS currency, {_first('url', K.SITE_SELLERS)} AS seller, {Q.any_of('url', K.DIRTY_SITES)} AS is_dirty
 FROM (SELECT DISTINCT {_LINE_URL} AS url FROM lineitem)""",
)
def j6(spark, sf):
    urls = table(spark, sf, "lineitem").select(F.expr(_LINE_URL).alias("url")).distinct()
    return rules.site_rules(urls).select("url", "currency", "seller", "is_dirty")


@query("J7_fallback_join", ("responses",), X3_SQL)
def j7(spark, sf):
    return x3(spark, sf)


# letters and digits beyond ASCII are one word letter, other characters beyond it a blank: RE2 knows ASCII word edges only
_PLAIN = r"regexp_replace(regexp_replace(lower(text), '[^\x00-\x7F\pL\pN]', ' ', 'g'), '[^\x00-\x7F]', 'x', 'g')"
_FIELD_HITS = " UNION ALL ".join(
    f"SELECT key, {Q.quote(field)} AS field, unnest(regexp_extract_all(plain, {Q.quote(words(terms))}, 1)) AS term FROM plain" for field, terms in rules.LEXICON.items()
)


@query(
    "J8_lexicon_hits",
    (),
    f"""WITH texts AS (SELECT doc_id AS key, text FROM documents UNION ALL SELECT -p_partkey, concat_ws(' ', p_name, 'gold ring, silver, diamond', p_type) FROM part),
plain AS (SELECT key, {_PLAIN} AS plain FROM texts WHERE text IS NOT NULL), hits AS ({_FIELD_HITS})
SELECT key, field, term, count(*) AS hits FROM hits GROUP BY key, field, term""",
)
def j8(spark, sf):
    """Lexicon terms in all documents and product texts."""
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text").unionByName(
        table(spark, sf, "part").select((-F.col("p_partkey")).alias("key"), F.concat_ws(" ", "p_name", F.lit("gold ring, silver, diamond"), "p_type").alias("text"))
    )
    return rules.lexicon_hits(texts, "key", "text")
