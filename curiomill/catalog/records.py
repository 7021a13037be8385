"""Queries for record extraction (X1-X25)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import content as C
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.registry import query
from curiomill.functions import lexicon as L
from curiomill.functions import money as M
from curiomill.functions.text import blank_to_null
from curiomill.operators import extraction, quality, responses
from curiomill.operators.currency import normalise_to_inr
from curiomill.schemas import BLANKABLE_FIELDS, RECORD_FIELDS, STRING_FIELDS

# -- responses ------------------------------------------------------------------

_JSON = f"""CASE WHEN contains(response_text, '```json') THEN {Q.strip("regexp_extract(response_text, '(?s)```json(.*)```', 1)")}
 WHEN contains(response_text, '{{') THEN regexp_extract(response_text, '(?s)\\{{.*\\}}') ELSE response_text END"""
_PARSED = f""", iso AS (SELECT pos, url, provider, {_JSON} AS j FROM responses),
parsed AS (SELECT pos, url, provider, j, CASE WHEN json_valid(j) AND json_type(CASE WHEN json_valid(j) THEN j ELSE '0' END) = 'OBJECT' THEN j END AS o FROM iso)"""


@query("X1_isolate_json", ("responses",), f"{_PARSED} SELECT url, provider, j AS json FROM iso")
def x1(spark, sf):
    rows = table(spark, sf, "responses")
    return rows.select("url", "provider", responses.isolate_json(F.col("response_text")).alias("json"))


@query("X2_parse_json", ("responses",), f"{_PARSED} SELECT url, provider, o IS NOT NULL AS parsed FROM parsed")
def x2(spark, sf):
    rows = table(spark, sf, "responses")
    value = responses.parse(responses.isolate_json(F.col("response_text")))
    return rows.select("url", "provider", value.isNotNull().alias("parsed"))


_PRICE_RAW = """, keyed AS (SELECT *, CASE WHEN json_type(o, '$.current_market_price') IS NOT NULL THEN 'current_market_price'
  WHEN json_type(o, '$.raw_price') IS NOT NULL THEN 'raw_price' END AS price_key FROM parsed),
raws AS (SELECT *, CASE WHEN kind = 'NULL' OR txt IN ('N/A', '', '0') OR (kind <> 'VARCHAR' AND TRY_CAST(txt AS DOUBLE) = 0) THEN NULL ELSE txt END AS price_raw
 FROM (SELECT *, json_type(o, '$.' || price_key) AS kind, json_extract_string(o, '$.' || price_key) AS txt FROM keyed))"""


@query("X7_price_key", ("responses",), f"{_PARSED}{_PRICE_RAW} SELECT url, provider, price_key, price_raw FROM raws WHERE o IS NOT NULL")
def x7(spark, sf):
    rows = table(spark, sf, "responses")
    flat = responses.flat_fields(rows).filter("_is_object")
    return flat.select("url", "provider", responses.price_key().alias("price_key"), responses.price_raw().alias("price_raw"))


CURRENCY_SITE = Q.site_currency("url", K.CURRENCY_SITES)
_OTHER_FIELDS = ", ".join(
    f"CASE WHEN reject_reason IS NULL THEN {f'nullif({Q.strip(t)}, {chr(39) * 2})' if f in BLANKABLE_FIELDS else t} END AS {f}"
    for f in STRING_FIELDS if f not in ("brand", "material_used", "weight") for t in [f"json_extract_string(o, '$.{f}')"]
)
_COERCED = f"""{_PARSED}{_PRICE_RAW}, conv AS (SELECT *, coalesce({CURRENCY_SITE}, CASE json_type(o, '$.detected_currency') WHEN 'NULL' THEN 'NONE'
  ELSE upper(json_extract_string(o, '$.detected_currency')) END, 'INR') AS cur, {Q.parse_price('price_raw')} AS num FROM raws),
typed AS (SELECT *, coalesce({Q.to_inr('num', 'cur')}, CASE WHEN json_type(o, '$.current_market_price') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'DECIMAL', 'HUGEINT')
   OR regexp_matches(trim(json_extract_string(o, '$.current_market_price')), '^[+-]?[0-9.]+$') THEN TRY_CAST(trim(json_extract_string(o, '$.current_market_price')) AS DOUBLE) END) AS p,
  json_type(o, '$.scratches') AS sk, lower(json_extract_string(o, '$.scratches')) AS st,
  json_type(o, '$.brand') AS bk, json_type(o, '$.work_type') AS wk, json_extract_string(o, '$.work_type') AS wt FROM conv),
flags AS (SELECT *, CASE WHEN sk = 'BOOLEAN' THEN st = 'true' WHEN st IN ('1', 'on', 't', 'true', 'y', 'yes') THEN true
   WHEN st IN ('0', 'off', 'f', 'false', 'n', 'no') THEN false END AS scratch FROM typed),
reasons AS (SELECT *, CASE WHEN o IS NULL THEN 'bad_json'
  WHEN sk <> 'NULL' AND scratch IS NULL THEN 'bad_field:scratches'
  WHEN json_type(o, '$.current_market_price') <> 'NULL' AND p IS NULL THEN 'bad_field:current_market_price'
  WHEN wk IS NOT NULL AND NOT (wk = 'VARCHAR' AND wt IN ('Handwork', 'Machine work', 'Unknown')) THEN 'bad_field:work_type'
  WHEN bk NOT IN ('NULL', 'VARCHAR') THEN 'bad_field:brand' END AS reject_reason FROM flags),
coerced AS (SELECT url, provider, reject_reason, CASE WHEN reject_reason IS NULL AND p > 0 AND p <= 830000000 THEN round(p, 2) END AS price,
  CASE WHEN reject_reason IS NULL THEN nullif({Q.strip("json_extract_string(o, '$.brand')")}, '') END AS brand,
  CASE WHEN reject_reason IS NULL THEN nullif({Q.strip("json_extract_string(o, '$.material_used')")}, '') END AS material_used,
  CASE WHEN reject_reason IS NULL THEN json_extract_string(o, '$.weight') END AS weight,
  {_OTHER_FIELDS}, CAST(NULL AS BOOLEAN) AS limited_edition,
  CASE WHEN reject_reason IS NULL THEN scratch END AS scratches, CASE WHEN reject_reason IS NULL THEN coalesce(wt, 'Unknown') END AS work_type FROM reasons)"""


@query("X4_coerce_record", ("responses",), f"{_COERCED} SELECT * FROM coerced")
def x4(spark, sf):
    parsed = responses.parse_responses(table(spark, sf, "responses"))
    rest = [f for f in RECORD_FIELDS if f != "current_market_price"]
    return parsed.select(
        "url", "provider", "reject_reason", F.col("record.current_market_price").alias("price"), *[F.col("record")[c].alias(c) for c in rest]
    )


X3_SQL = f"""{_COERCED}, a AS (SELECT * FROM coerced WHERE provider = 'primary'), b AS (SELECT * FROM coerced WHERE provider = 'fallback' AND reject_reason IS NULL)
SELECT a.url, CASE WHEN a.reject_reason IS NULL THEN 'primary' WHEN b.url IS NOT NULL THEN 'fallback' END AS used,
 CASE WHEN a.reject_reason IS NULL THEN a.brand ELSE b.brand END AS brand, CASE WHEN a.reject_reason IS NULL THEN a.price ELSE b.price END AS price,
 CASE WHEN a.reject_reason IS NOT NULL AND b.url IS NULL THEN 'both_failed' END AS reject_reason FROM a LEFT JOIN b ON a.url = b.url"""


@query("X3_primary_or_fallback", ("responses",), X3_SQL)
def x3(spark, sf):
    parsed = responses.parse_responses(table(spark, sf, "responses"))
    best = responses.with_fallback(parsed)
    return best.select(
        "url", "used", F.col("record.brand").alias("brand"), F.col("record.current_market_price").alias("price"), "reject_reason"
    )


# -- fields and prices ------------------------------------------------------------


@query(
    "X5_blank_to_null",
    ("products",),
    f"SELECT id, nullif({Q.strip('material_used')}, '') AS material_used, nullif({Q.strip('valuable_gem')}, '') AS valuable_gem, nullif({Q.strip('brand')}, '') AS brand, weight FROM products",
)
def x5(spark, sf):
    rows = table(spark, sf, "products")
    return rows.select("id", *[blank_to_null(F.col(c)).alias(c) for c in ("material_used", "valuable_gem", "brand")], "weight")


_LINE = "SELECT l_orderkey, l_linenumber, (l_extendedprice - 20000) * l_quantity * 1000 AS given FROM lineitem"


@query(
    "X6_price_bound",
    (),
    f"SELECT l_orderkey, l_linenumber, CASE WHEN given > 0 AND given <= 830000000 THEN round(given, 2) END AS price FROM ({_LINE})",
)
def x6(spark, sf):
    given = (F.col("l_extendedprice") - 20000) * F.col("l_quantity") * 1000
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", M.bound_price(given).alias("price"))


_TEXT = """CASE k % 8 WHEN 0 THEN '$1,200.50' WHEN 1 THEN '12,500 - 15,000' WHEN 2 THEN 'Rs. 3,390' WHEN 3 THEN '-5' WHEN 4 THEN '1.234.56'
 WHEN 5 THEN '.' WHEN 6 THEN concat('€ ', price) ELSE 'on request' END"""


@query("X8_parse_price", ("listings",), f"SELECT k, t AS text, {Q.parse_price('t')} AS price FROM (SELECT k, {_TEXT} AS t FROM listings)")
def x8(spark, sf):
    rows = table(spark, sf, "listings").select("k", F.expr(_TEXT).alias("text"))
    return rows.withColumn("price", M.parse_price(F.col("text")))


_DETECTED = "CASE k % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR' WHEN 2 THEN NULL WHEN 3 THEN 'JPY' ELSE 'GBP' END"


@query(
    "X9_settle_currency",
    ("listings",),
    f"SELECT url, coalesce({CURRENCY_SITE}, upper(d), 'INR') AS currency FROM (SELECT root || path AS url, {_DETECTED} AS d FROM listings)",
)
def x9(spark, sf):
    rows = table(spark, sf, "listings").select(F.concat("root", "path").alias("url"), F.expr(_DETECTED).alias("d"))
    return rows.select("url", M.settle_currency(F.col("url"), F.col("d")).alias("currency"))


_CODE = "CASE l_linenumber % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'INR' END"


@query(
    "X10_extraction_to_inr",
    (),
    f"SELECT l_orderkey, l_linenumber, {Q.to_inr('l_extendedprice', 'c')} AS price_inr FROM (SELECT *, {_CODE} AS c FROM lineitem)",
)
def x10(spark, sf):
    price = M.extraction_to_inr(F.col("l_extendedprice"), F.expr(_CODE))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", price.alias("price_inr"))


_CODE12 = """CASE l_partkey % 15 WHEN 0 THEN 'INR' WHEN 1 THEN 'usd' WHEN 2 THEN 'EUR' WHEN 3 THEN 'GBP' WHEN 4 THEN 'JPY' WHEN 5 THEN 'CHF'
 WHEN 6 THEN 'CAD' WHEN 7 THEN 'AUD' WHEN 8 THEN 'cny' WHEN 9 THEN 'SGD' WHEN 10 THEN 'AED' WHEN 11 THEN 'HKD' WHEN 12 THEN 'XXX' WHEN 13 THEN NULL ELSE '' END"""
_RATE12 = "CASE upper(c) " + " ".join(f"WHEN '{c}' THEN CAST({r} AS DECIMAL(10,4))" for c, r in K.RATES_TO_INR.items()) + " END"
X11_SQL = f"""SELECT l_orderkey, l_linenumber, c AS currency, coalesce(CAST(round(CAST(price AS DECIMAL(14,4)) * {_RATE12}, 2) AS DOUBLE), price) AS price_inr
 FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS price, {_CODE12} AS c FROM lineitem)"""


@query("X11_rate_table", (), X11_SQL)
def x11(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.expr(_CODE12).alias("currency")
    )
    return normalise_to_inr(rows).drop("price")


_LD_INR = Q.to_inr(Q.parse_price("ld_price"), f"coalesce({CURRENCY_SITE}, ld_currency)")


@query(
    "X12_offer_override",
    ("product_pages",),
    f"{C.EVIDENCE} SELECT url, coalesce({_LD_INR}, 100.0::DOUBLE + pos) AS price FROM evidence",
)
def x12(spark, sf):
    base = (F.lit(100.0) + F.col("pos")).alias("base")
    rows = C.clean_evidence(spark, sf).select("url", base, "ld_price", "ld_currency")
    price = M.override_price(F.col("url"), F.col("base"), F.col("ld_price"), F.col("ld_currency"))
    return rows.select("url", price.alias("price"))


@query(
    "X13_limited_edition",
    ("products",),
    f"SELECT id, CASE WHEN current_market_price >= 9000000 THEN true WHEN {Q.any_of('lower(source_url)', K.RARITY_URL_WORDS)} THEN true ELSE limited_edition END AS limited_edition FROM products",
)
def x13(spark, sf):
    rows = table(spark, sf, "products")
    limited = M.override_limited_edition(F.col("source_url"), F.col("current_market_price"), F.col("limited_edition"))
    return rows.select("id", limited.alias("limited_edition"))


# -- lexicon rules ------------------------------------------------------------------

_N = M.NUMBER
QUOTED = f""", clean AS (SELECT *, regexp_replace(content, '(?i)shipping\\s+(?:on\\s+orders\\s+)?(?:over|above)\\s+[^0-9\\n]*{_N}', ' ', 'g') AS cl FROM evidence),
segs AS (SELECT *, nullif(regexp_extract(cl, '(?i)(?:winning bid|hammer price)[^0-9\\n]*{_N}'), '') AS bid,
  nullif(regexp_extract(cl, '(?i)estimate[^0-9\\n]*{_N}(?:\\s*[-–]\\s*[^0-9\\n]*{_N})?'), '') AS est,
  nullif(regexp_extract(cl, '(?m)^PRICE: [^0-9\\n]*{_N}[^\\n]*'), '') AS ln,
  nullif(regexp_extract(cl, '(?i)(?:[$€£₹]|\\brs\\b\\.?|\\binr\\b)\\s*{_N}'), '') AS sy FROM clean),
amts AS (SELECT *, list_transform(regexp_extract_all(seg, '{_N}'), lambda n: CAST(replace(n, ',', '') AS DOUBLE)) AS a,
  lower(regexp_extract(seg, '(?i)([$€£₹]|\\b(?:rs|inr|usd|eur|gbp)\\b)', 1)) AS mk FROM (SELECT *, coalesce(bid, est, ln, sy) AS seg FROM segs)),
quoted AS (SELECT *, coalesce(CASE WHEN bid IS NULL AND est IS NOT NULL THEN list_max(a[1:2]) ELSE a[1] END, 0.0::DOUBLE) AS q_price,
  CASE mk WHEN '$' THEN 'USD' WHEN '€' THEN 'EUR' WHEN '£' THEN 'GBP' WHEN 'usd' THEN 'USD' WHEN 'eur' THEN 'EUR' WHEN 'gbp' THEN 'GBP' ELSE 'INR' END AS q_currency FROM amts)"""


@query("X14_quoted_price", ("product_pages",), f"{C.EVIDENCE}{QUOTED} SELECT url, q_price AS price, q_currency AS currency FROM quoted")
def x14(spark, sf):
    quoted = C.clean_evidence(spark, sf).select("url", M.quoted_price(F.col("content")).alias("q"))
    return quoted.select("url", "q.price", "q.currency")


_FREE = r", free AS (SELECT url, regexp_replace(content, '(?m)^(?:SOURCE URL|PRICE): [^\n]*\n?', '', 'g') AS t FROM evidence)"


def _sq(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _longest(pattern: str) -> str:
    hits = f"regexp_extract_all(lower(t), {_sq(pattern)}, 1)"
    return f"nullif(list_reduce(list_prepend('', {hits}), lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END), '')"


def _joined(pattern: str) -> str:
    hits = f"regexp_extract_all(lower(t), {_sq(pattern)}, 1)"
    return f"nullif(array_to_string(list_filter({hits}, lambda x, i: list_position({hits}, x) = i), ', '), '')"


def _found(pattern: str, group: int = 0, col: str = "t") -> str:
    return f"nullif(regexp_extract({col}, {_sq(pattern)}, {group}), '')"


def _words(terms) -> str:
    from curiomill.functions.text import words

    return words(terms)


def _case(key: str, pairs) -> str:
    return f"CASE lower({key}) " + " ".join(f"WHEN '{a.lower()}' THEN '{b}'" for a, b in pairs) + " END"


_HOUSE = _case(_found(_words([h for h, _ in K.HOUSES]), 1), [(h, h) for h, _ in K.HOUSES])
_MADE = "regexp_extract(t, '(?i)\\bmade in ([a-z]+)', 1)"
from curiomill.functions.text import alternation as _alt  # noqa: E402

_RULES = {
    "material_used": _longest(L.MATERIAL),
    "valuable_gem": _joined(L.GEM),
    "expensive_material": _longest(L.PRECIOUS),
    "origin": f"""coalesce({_found('(?m)^ORIGIN: ([^\n]+)', 1)}, CASE WHEN {_MADE} <> '' THEN CASE WHEN length({_MADE}) <= 3 THEN upper({_MADE})
 ELSE upper({_MADE}[1]) || lower({_MADE}[2:]) END END, {_case(_found(_words([n for n, _ in K.NATIONALITIES]), 1), K.NATIONALITIES)}, {_case(_HOUSE, K.HOUSES)},
 {_found(_words(K.CRAFT_REGIONS))}, {_found(r'\b(' + _alt(K.COUNTRIES) + r')\b', 1)})""",
    "date_of_manufacture": f"coalesce({_found(rf'(?i)\bcirca {L.YEAR}\b')}, {_found(r'(?i)\bvintage [0-9]{4}s\b')}, {_found(r'\b[0-9]{4}s\b')}, {_found(rf'\b{L.YEAR}\b')}, {_found(r'(?i)\bpre-owned\b')})",
    "defects": _joined(_words(K.DEFECT_TERMS)),
    "scratches": f"regexp_matches(t, {_sq(_words(K.SCRATCH_TERMS))})",
    "colour": f"lower({_found(_words(K.COLOURS), 1)})",
    "work_type": f"CASE WHEN regexp_matches(t, {_sq(_words(K.HANDWORK_TERMS))}) THEN 'Handwork' WHEN regexp_matches(t, {_sq(_words(K.MACHINE_TERMS))}) THEN 'Machine work' WHEN {_HOUSE} IS NOT NULL THEN 'Machine work' ELSE 'Unknown' END",
    "limited_edition": f"regexp_matches(t, {_sq(_words(K.RARITY_TERMS))})",
    "brand": f"coalesce({_found('(?m)^BRAND: ([^\n]+)', 1)}, {_HOUSE}, 'N/A')",
    "seller_reputation": f"""CASE WHEN contains(lower(url), 'therealreal.com') THEN 'TheRealReal' WHEN contains(lower(url), 'novica.com') THEN 'Novica'
 WHEN contains(lower(url), 'itokri.com') THEN 'iTokri' WHEN contains(lower(url), 'theindiacrafthouse.com') THEN 'The India Craft House'
 ELSE coalesce({_found('(?m)^SELLER: ([^\n]+)', 1)}, CASE WHEN contains(lower(url), '1stdibs.com') THEN '1stDibs Verified Seller' END) END""",
    "dimensions": r"""coalesce(nullif(regexp_extract(t, '(?i)\b[0-9]+(?:\.[0-9]+)?\s?x\s?[0-9]+(?:\.[0-9]+)?(?:\s?x\s?[0-9]+(?:\.[0-9]+)?)?(?:\s?(?:inches|inch|in|cm|mm)\b)?'), ''),
 nullif(regexp_extract(t, '(?i)\b[0-9]+(?:\.[0-9]+)?\s?(?:inches|inch|in|cm|mm) diameter\b'), ''), nullif(regexp_extract(t, '\bSize (?:(?:EU|US) )?[0-9A-Z]+(?: EU| US)?\b'), ''),
 nullif(regexp_extract(t, '\b(?:EU|US) [0-9]+\b'), ''))""",
    "weight": rf"""coalesce(nullif(regexp_extract(t, '(?i)\b[0-9]+(?:\.[0-9]+)?\s?(?:kg|g|lbs|lb|oz)\b'), ''),
 nullif(regexp_extract(t, '(?i)\b[0-9]+(?:\.[0-9]+)?\s?ct(?: (?:total|{_alt(K.GEMS)}))?\b'), ''))""",
}


def _free(spark, sf):
    return C.clean_evidence(spark, sf).select("url", L.free_text(F.col("content")).alias("t"))


def _rule_query(name: str, fields: list[str], columns) -> None:
    sql = ", ".join(f"{_RULES[f]} AS {f}" for f in fields)

    @query(name, ("product_pages",), f"{C.EVIDENCE}{_FREE} SELECT url, {sql} FROM free")
    def run(spark, sf):
        made = columns(F.col("url"), F.col("t"))
        return _free(spark, sf).select("url", *[c.alias(f) for c, f in zip(made, fields, strict=True)])


_rule_query("X15_material_used", ["material_used"], lambda u, t: [L.material_used(t)])
_rule_query("X16_valuable_gem", ["valuable_gem"], lambda u, t: [L.valuable_gem(t)])
_rule_query("X17_expensive_material", ["expensive_material"], lambda u, t: [L.expensive_material(t)])
_rule_query("X18_origin", ["origin"], lambda u, t: [L.origin(t)])
_rule_query("X19_date_of_manufacture", ["date_of_manufacture"], lambda u, t: [L.date_of_manufacture(t)])
_rule_query("X20_defects_scratches", ["defects", "scratches"], lambda u, t: [L.defects(t), L.scratches(t)])
_rule_query("X21_colour", ["colour"], lambda u, t: [L.colour(t)])
_rule_query("X22_seller_brand", ["seller_reputation", "brand"], lambda u, t: [L.seller_reputation(u, t), L.brand(t)])
_rule_query(
    "X23_size_and_make",
    ["dimensions", "weight", "work_type", "limited_edition"],
    lambda u, t: [L.dimensions(t), L.weight(t), L.work_type(t), L.limited_edition(t)],
)


_DOC_FIELDS = ["date_of_manufacture", "dimensions", "weight", "scratches", "limited_edition"]


@query(
    "X23_rules_on_documents",
    (),
    "SELECT doc_id, " + ", ".join(f"{_RULES[f]} AS {f}" for f in _DOC_FIELDS) + " FROM (SELECT doc_id, text AS t FROM documents)",
)
def x23_documents(spark, sf):
    t = F.col("text")
    made = [L.date_of_manufacture(t), L.dimensions(t), L.weight(t), L.scratches(t), L.limited_edition(t)]
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", *[c.alias(f) for c, f in zip(made, _DOC_FIELDS, strict=True)])


# -- extractors and envelopes ---------------------------------------------------------


def price_line_extractor(batch: pd.DataFrame) -> pd.DataFrame:
    """Example of a caller's extractor: the number after the PRICE label, in US dollars, and the title as brand."""
    price = batch["content"].str.extract(r"(?m)^PRICE: [^0-9\n]*([0-9.,]+)", expand=False)
    return pd.DataFrame(
        {
            "detected_currency": "USD",
            "current_market_price": pd.to_numeric(price.str.replace(",", ""), errors="coerce"),
            "brand": batch["content"].str.extract(r"(?m)^TITLE: ([^\n]+)", expand=False),
            "work_type": "Unknown",
        }
    )


@query(
    "X24_custom_extractor",
    ("product_pages",),
    f"""{C.EVIDENCE}, got AS (SELECT url, TRY_CAST(replace(regexp_extract(content, '(?m)^PRICE: [^0-9\\n]*([0-9.,]+)', 1), ',', '') AS DOUBLE) AS p,
  {_found('(?m)^TITLE: ([^\n]+)', 1, 'content')} AS brand FROM evidence)
SELECT url, CASE WHEN v > 0 AND v <= 830000000 THEN round(v, 2) END AS price, nullif({Q.strip('brand')}, '') AS brand
FROM (SELECT url, brand, {Q.to_inr('p', f"coalesce({CURRENCY_SITE}, 'USD')")} AS v FROM got)""",
)
def x24(spark, sf):
    rows = C.clean_evidence(spark, sf).select("url", "content")
    made = extraction.extract_records(rows, price_line_extractor)
    return made.select("url", F.col("current_market_price").alias("price"), "brand")


_ERROR = """CASE WHEN current_market_price IS NULL OR current_market_price <= 0 THEN 'Missing or invalid price'
 WHEN current_market_price > 830000000 THEN 'Price too high (likely hallucination): ₹' || format('{:,.2f}', current_market_price)
 WHEN current_market_price < 10 THEN 'Price too low for luxury item: ₹' || format('{:,.2f}', current_market_price) END"""
VALIDATED = f""", scored AS (SELECT *, {Q.score()} AS sc, {_ERROR} AS error FROM products),
validated AS (SELECT *, error IS NULL AS is_valid, CASE WHEN error IS NULL THEN {Q.rounded('sc')} ELSE 0.0::DOUBLE END AS confidence FROM scored)"""


@query(
    "X25_result_envelope",
    ("products",),
    f"""{VALIDATED} SELECT source_url AS url, is_valid AS success, confidence, 'Validation failed: ' || error AS error,
 source_url IN (SELECT source_url FROM products WHERE id % 3 = 0) AS stored, brand, current_market_price AS price FROM validated""",
)
def x25(spark, sf):
    products = table(spark, sf, "products")
    stored = products.filter("id % 3 = 0").select(F.col("source_url").alias("url"))
    rows = quality.validated(products.withColumnRenamed("source_url", "url"))
    made = extraction.envelopes(rows, stored)
    return made.select(
        "url", "success", "confidence", "error", "stored", F.col("data.brand").alias("brand"),
        F.col("data.current_market_price").alias("price"),
    )
