"""Queries for validation, clean-up and de-duplication (V1-V6, C1-C4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.records import VALIDATED
from curiomill.catalog.registry import query
from curiomill.operators import dedup, quality
from curiomill.session import new_folder
from curiomill.sources import store

_FAILURE = "CASE WHEN contains(lower(error), 'price') THEN 'no_price' WHEN error IS NOT NULL THEN 'validation' END"
_DIRTY = Q.polluted("source_url", "current_market_price", K.DIRTY_SITES)


def _validated(spark, sf):
    return quality.validated(table(spark, sf, "products"))


@query("V1_validate_price", ("products",), f"{VALIDATED} SELECT id, is_valid, error FROM validated")
def v1(spark, sf):
    return _validated(spark, sf).select("id", "is_valid", "error")


@query("V2_confidence", ("products",), f"{VALIDATED} SELECT id, confidence FROM validated")
def v2(spark, sf):
    return _validated(spark, sf).select("id", "confidence")


@query("V3_failure_class", ("products",), f"{VALIDATED} SELECT id, {_FAILURE} AS failure_type FROM validated WHERE NOT is_valid")
def v3(spark, sf):
    return quality.split_valid(_validated(spark, sf))[1].select("id", "failure_type")


@query("V4_split_valid", ("products",), f"{VALIDATED} SELECT id, CASE WHEN is_valid THEN 'valid' ELSE 'reject' END AS part FROM validated")
def v4(spark, sf):
    valid, rejects = quality.split_valid(_validated(spark, sf))
    return valid.select("id", F.lit("valid").alias("part")).unionByName(rejects.select("id", F.lit("reject").alias("part")))


def _na(column: str) -> str:
    return f"coalesce(nullif({column}, ''), 'N/A')"


@query(
    "V5_display_lines",
    ("products",),
    f"""SELECT id, 'ProductData(material=' || {_na('material_used')} || ', origin=' || {_na('origin')} || ', price=' ||
 CASE WHEN coalesce(current_market_price, 0) <> 0 THEN 'INR ' || format('{{:,.0f}}', current_market_price) ELSE 'N/A' END || ', brand=' || {_na('brand')} || ')' AS line,
 '<Product(id=' || id || ', brand=' || coalesce(brand, 'None') || ', price=' || CASE WHEN coalesce(current_market_price, 0) <> 0
 THEN '₹' || format('{{:,.2f}}', current_market_price) ELSE 'N/A' END || ', origin=' || coalesce(origin, 'None') || ')>' AS stored_line FROM products""",
)
def v5(spark, sf):
    rows = table(spark, sf, "products")
    return rows.select("id", quality.display_line().alias("line"), quality.stored_line().alias("stored_line"))


@query("V6_currency_pollution", ("products",), f"SELECT id, {_DIRTY} AS polluted FROM products")
def v6(spark, sf):
    flag = quality.is_polluted(F.col("source_url"), F.col("current_market_price"))
    return table(spark, sf, "products").select("id", flag.alias("polluted"))


_KEY = "CASE WHEN regexp_matches(source_url, '/item/[0-9]+') THEN regexp_extract(source_url, '/item/[0-9]+') ELSE source_url END"


@query("C1_dedup_rows", ("products",), f"SELECT id, source_url FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY id) AS rn FROM products) WHERE rn = 1")
def c1(spark, sf):
    return dedup.dedup_rows(table(spark, sf, "products").select("id", "source_url"), "id")


@query("C2_removed_rows", ("products",), f"SELECT count(*) - count(DISTINCT {_KEY}) AS removed_rows FROM products")
def c2(spark, sf):
    return dedup.removed_rows(table(spark, sf, "products"))


@query(
    "C3_purge_polluted",
    ("products",),
    f"""SELECT id, source_url FROM products WHERE source_url NOT IN (SELECT source_url FROM products WHERE {_DIRTY})""",
)
def c3(spark, sf):
    path, out = new_folder(spark, "store"), new_folder(spark, "store")
    products = table(spark, sf, "products")
    products.write.parquet(f"{path}/batch=0")
    doomed = dedup.purge_list(store.stored_products(spark, path), price="current_market_price")
    return store.delete_products(spark, path, doomed, out).select("id", "source_url")


@query("C3_keep_clean", ("products",), f"SELECT id, source_url FROM products WHERE NOT {_DIRTY}")
def c3_keep(spark, sf):
    return dedup.keep_clean(table(spark, sf, "products"), price="current_market_price").select("id", "source_url")


@query(
    "C4_insert_ignoring_duplicates",
    ("products",),
    """, a AS (SELECT min(id) AS pos, source_url FROM products WHERE id < 10000000 AND id % 2 = 0 GROUP BY source_url),
b AS (SELECT min(id) AS pos, source_url FROM products WHERE source_url NOT IN (SELECT source_url FROM a) GROUP BY source_url)
SELECT source_url, row_number() OVER (ORDER BY scrape_timestamp, source_url) AS id FROM (SELECT p.source_url, p.scrape_timestamp FROM a JOIN products p ON p.id = a.pos)
UNION ALL SELECT source_url, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY scrape_timestamp, source_url) FROM
 (SELECT p.source_url, p.scrape_timestamp FROM b JOIN products p ON p.id = b.pos)""",
)
def c4(spark, sf):
    path = new_folder(spark, "store")
    products = table(spark, sf, "products").withColumn("pos", F.col("id"))
    store.insert_products(products.filter("id < 10000000 AND id % 2 = 0"), path, 0)
    store.insert_products(products, path, 1)
    # a repeated batch changes nothing
    store.insert_products(products, path, 1)
    return store.stored_products(spark, path).select("id", "source_url")
