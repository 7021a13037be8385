"""Queries for sources and sinks (S1-S21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.registry import query
from curiomill.catalog.reports import REPORT
from curiomill.operators import dedup, evidence, reports, sources_config
from curiomill.schemas import BOOL_FIELDS, RECORD_FIELDS
from curiomill.session import new_folder
from curiomill.sources import bucketed, store, tables


@query("S1_load_sources", ("sources",), "SELECT * FROM sources")
def s1(spark, sf):
    path = new_folder(spark, "sources") + ".json"
    table(spark, sf, "sources").write.json(path)
    return sources_config.load_sources(spark, path)


@query("S2_enabled_sources", ("sources",), "SELECT pos, name FROM sources WHERE coalesce(enabled, true)")
def s2(spark, sf):
    return sources_config.enabled_sources(table(spark, sf, "sources")).select("pos", "name")


@query(
    "S3_choose_seeds",
    ("sources",),
    "SELECT pos, name, base_url FROM sources WHERE coalesce(enabled, true) ORDER BY coalesce(priority, 50), pos LIMIT 14",
)
def s3(spark, sf):
    return sources_config.choose_seeds(table(spark, sf, "sources"), 100).select("pos", "name", "base_url")


@query("S4_read_pages", (), "SELECT page_id, url, html FROM pages")
def s4(spark, sf):
    return tables.read_pages(spark, f"{sf}/pages.parquet")


@query(
    "S5_fetch_results",
    ("product_pages",),
    f"""SELECT url, html IS NOT NULL AS success, html AS raw_html, {Q.visible_text('html')} AS raw_text,
 CAST(NULL AS VARCHAR) AS error FROM product_pages""",
)
def s5(spark, sf):
    pages = table(spark, sf, "product_pages")
    return tables.fetch_results(pages.unionByName(pages.withColumn("pos", F.col("pos") + 10_000_000)), "pos")


@query(
    "S6_page_metrics",
    (),
    f"SELECT url, length({Q.visible_text('html')}) AS text_length, length(html) AS html_length FROM pages",
)
def s6(spark, sf):
    return evidence.page_metrics(table(spark, sf, "pages"))


@query(
    "S7_read_product_csv",
    ("products",),
    """SELECT source_url, brand, CASE WHEN current_market_price <> 0 THEN round(current_market_price, 2) END AS current_market_price_inr
 FROM products""",
)
def s7(spark, sf):
    path = new_folder(spark, "csv")
    store.append_csv(table(spark, sf, "products"), path)
    return tables.read_products_csv(spark, path).select("source_url", "brand", "current_market_price_inr")


@query(
    "S8_append_csv",
    ("products",),
    "SELECT CAST(id AS VARCHAR) AS id, source_url FROM products UNION ALL SELECT CAST(id AS VARCHAR), source_url FROM products WHERE id % 2 = 0",
)
def s8(spark, sf):
    products, path = table(spark, sf, "products"), new_folder(spark, "csv")
    store.append_csv(products, path)
    store.append_csv(products.filter("id % 2 = 0"), path)
    return tables.read_products_csv(spark, path).select("id", "source_url")


_INSERT = """, stored AS (SELECT source_url FROM products WHERE id % 3 = 0)
SELECT min(id) AS id, source_url FROM products WHERE source_url NOT IN (SELECT source_url FROM stored) GROUP BY source_url"""


@query("S9_insert_new", ("products",), _INSERT)
def s9(spark, sf):
    products = table(spark, sf, "products").select("id", "source_url")
    return dedup.new_rows(products, products.filter("id % 3 = 0"), "id")


@query(
    "S9_bucketed_store",
    ("products",),
    """, one AS (SELECT source_url, min(id) AS pos FROM products WHERE id % 3 = 0 GROUP BY source_url),
two AS (SELECT source_url, min(id) AS pos FROM products WHERE source_url NOT IN (SELECT source_url FROM one) GROUP BY source_url)
SELECT row_number() OVER (ORDER BY pos) AS id, source_url FROM one
UNION ALL SELECT row_number() OVER (ORDER BY pos) + (SELECT count(*) FROM one), source_url FROM two""",
)
def s9_bucketed(spark, sf):
    """A third of the products, then all of them, one batch again; the rows of the store."""
    path = new_folder(spark, "store")
    rows = table(spark, sf, "products").withColumn("pos", F.col("id"))
    bucketed.insert(rows.filter("id % 3 = 0"), path, "first")
    bucketed.insert(rows, path, "second")
    bucketed.insert(rows, path, "second")
    return bucketed.products(spark, path).select("id", "source_url")


def _csv_sql() -> str:
    cols = ["CAST(id AS VARCHAR) AS id", "strftime(scrape_timestamp, '%Y-%m-%d %H:%M:%S') AS scrape_timestamp", "source_url"]
    cols.append("CASE WHEN extraction_confidence <> 0 THEN printf('%.3f', extraction_confidence) ELSE '' END AS extraction_confidence")
    for f in RECORD_FIELDS:
        if f == "current_market_price":
            cols.append("CASE WHEN current_market_price <> 0 THEN printf('%.2f', current_market_price) ELSE '' END AS current_market_price_inr")
        elif f in BOOL_FIELDS:
            cols.append(f"CASE {f} WHEN true THEN 'True' WHEN false THEN 'False' ELSE '' END AS {f}")
        else:
            cols.append(f"coalesce({f}, '') AS {f}")
    return "SELECT " + ", ".join(cols) + " FROM products"


@query("S10_csv_formatting", ("products",), _csv_sql())
def s10(spark, sf):
    return tables.csv_rows(table(spark, sf, "products"))


@query("S11_count_rows", ("products",), "SELECT count(*) AS row_count FROM products")
def s11(spark, sf):
    return table(spark, sf, "products").agg(F.count("*").alias("row_count"))


@query(
    "S12_url_exists",
    ("listings", "products"),
    "SELECT root || path AS url FROM listings WHERE root || path IN (SELECT source_url FROM products WHERE id % 3 = 0)",
)
def s12(spark, sf):
    stored = table(spark, sf, "products").filter("id % 3 = 0").select(F.col("source_url").alias("url"))
    urls = table(spark, sf, "listings").select(F.concat("root", "path").alias("url"))
    return urls.join(stored, "url", "left_semi")


@query("S13_ordered_page", ("products",), "SELECT id, source_url FROM products ORDER BY id LIMIT 100 OFFSET 50")
def s13(spark, sf):
    return tables.ordered_page(table(spark, sf, "products"), 100, 50).select("id", "source_url")


def _export_sql() -> str:
    cols = ["CAST(id AS VARCHAR) AS id", "strftime(scrape_timestamp, '%Y-%m-%dT%H:%M:%S') AS scrape_timestamp", "source_url"]
    cols.append("coalesce(CAST(extraction_confidence AS VARCHAR), '') AS extraction_confidence")
    for f in RECORD_FIELDS:
        if f == "current_market_price":
            cols.append("coalesce(CAST(current_market_price AS VARCHAR), '') AS current_market_price_inr")
        elif f in BOOL_FIELDS:
            cols.append(f"CASE {f} WHEN true THEN 'True' WHEN false THEN 'False' ELSE '' END AS {f}")
        else:
            cols.append(f"coalesce({f}, '') AS {f}")
    return "SELECT " + ", ".join(cols) + " FROM products"


@query("S14_export_rows", ("products",), _export_sql())
def s14(spark, sf):
    return tables.export_rows(table(spark, sf, "products"))


_DICT = ["id", "source_url", "scrape_timestamp", "extraction_confidence", *RECORD_FIELDS]
_DICT_SQL = ", ".join(
    f"'{c}', " + ("strftime(scrape_timestamp, '%Y-%m-%dT%H:%M:%S')" if c == "scrape_timestamp" else c) for c in _DICT
)


# numbers with exponents are written differently by the engines, so those rows are compared by their other fields
@query(
    "S15_product_dicts",
    ("products",),
    f"SELECT id, CAST(json_object({_DICT_SQL.replace(', current_market_price,', ', CAST(CAST(current_market_price AS DECIMAL(18,2)) AS VARCHAR),')}) AS VARCHAR) AS json FROM products",
)
def s15(spark, sf):
    rows = table(spark, sf, "products")
    shown = rows.withColumn("current_market_price", F.col("current_market_price").cast("decimal(18,2)").cast("string"))
    return tables.product_dicts(shown)


_ITEMS = """SELECT source_url AS url, current_market_price AS price_inr, brand, material_used AS material, origin,
 extraction_confidence AS confidence FROM products"""


@query("S16_crawl_items", ("products",), _ITEMS)
def s16(spark, sf):
    products, path = table(spark, sf, "products"), new_folder(spark, "items")
    store.write_items(products, path)
    return spark.read.schema(tables.crawl_items(products).schema).json(path)


@query("S17_price_extract", ("products",), "SELECT source_url, current_market_price AS current_market_price_inr FROM products")
def s17(spark, sf):
    return tables.price_extract(table(spark, sf, "products"))


@query(
    "S18_delete_keys",
    ("products",),
    "SELECT id, source_url FROM products WHERE source_url NOT IN (SELECT source_url FROM products WHERE id % 5 = 0)",
)
def s18(spark, sf):
    products = table(spark, sf, "products").select("id", "source_url")
    return dedup.delete_keys(products, products.filter("id % 5 = 0"))


@query("S19_read_responses", ("responses",), "SELECT url, provider, response_text FROM responses")
def s19(spark, sf):
    path = new_folder(spark, "responses")
    table(spark, sf, "responses").select("url", "provider", "response_text").write.json(path)
    return tables.read_responses(spark, path)


@query(
    "S20_surrogate_ids",
    ("products",),
    """SELECT 500 + row_number() OVER (ORDER BY scrape_timestamp, source_url, old_id) AS id, old_id, source_url
 FROM (SELECT scrape_timestamp, source_url, id AS old_id FROM products)""",
)
def s20(spark, sf):
    rows = table(spark, sf, "products").select("scrape_timestamp", "source_url", F.col("id").alias("old_id"))
    return store.assign_ids(rows, 500, ("scrape_timestamp", "source_url", "old_id")).drop("scrape_timestamp")


@query(
    "S21_run_report",
    ("products", "attempts"),
    f"""SELECT true AS success, total_rows AS rows_collected, CAST(NULL AS VARCHAR) AS error, completion_percent, successes, success_rate, urls_failed,
 runtime, price_median, price_count FROM ({REPORT})""",
)
def s21(spark, sf):
    report = reports.final_report(table(spark, sf, "products"), table(spark, sf, "attempts"), K.TARGET_ROWS)
    fields = "completion_percent double, successes bigint, success_rate double, urls_failed bigint, runtime string, price_median double, price_count bigint"
    return reports.run_report(report).withColumn("r", F.from_json("report", fields)).select("success", "rows_collected", "error", "r.*")
