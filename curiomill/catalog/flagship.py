"""The flagship query: product pages to price statistics per site."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiomill.catalog import content as C
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.outcomes import OUTCOMES
from curiomill.catalog.records import CURRENCY_SITE
from curiomill.catalog.registry import query
from curiomill.functions import urls as U
from curiomill.functions.money import offer_to_inr
from curiomill.operators.dedup import dedup_rows
from curiomill.operators.reports import price_statistics
from curiomill.operators.responses import fixed
from curiomill.plans.batch import process_pages, run_batch
from curiomill.session import cut_lineage, new_folder

_OFFER = Q.to_inr(Q.parse_price("ld_price"), f"coalesce({CURRENCY_SITE}, ld_currency)")
_DEDUP = "CASE WHEN regexp_matches(url, '/item/[0-9]+') THEN regexp_extract(url, '/item/[0-9]+') ELSE url END"


@query(
    "F1_offer_prices_by_site",
    ("product_pages",),
    f"""{C.EVIDENCE}, site_offers AS (SELECT pos, url, {Q.site('url')} AS site, {_OFFER} AS p FROM evidence),
good AS (SELECT *, row_number() OVER (PARTITION BY {_DEDUP} ORDER BY pos) AS rn FROM site_offers WHERE p >= 10 AND p <= 830000000),
ranked AS (SELECT site, p, row_number() OVER (PARTITION BY site ORDER BY p) AS r, count(*) OVER (PARTITION BY site) AS n FROM good WHERE rn = 1)
SELECT site, min(p) AS min, max(p) AS max, CAST(sum(CAST(p AS DECIMAL(30,4))) AS DOUBLE) / count(*) AS avg,
 max(CASE WHEN r = n // 2 + 1 THEN p END) AS median, count(*) AS count FROM ranked GROUP BY site""",
)
def price_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers of readable pages in INR, valid prices only, one row per item, and their statistics per site.

    The offers, a few numbers per page, are written once; statistics and ranks read that table, not the pages.
    """
    rows = C.clean_evidence(spark, sf_dir).select("pos", "url", "ld_price", "ld_currency")
    price = offer_to_inr(F.col("url"), F.col("ld_price"), F.col("ld_currency"))
    offers = cut_lineage(fixed(rows, site=U.site(F.col("url")), price=price).select("pos", "url", "site", "price"), "offers")
    valid = offers.filter("price >= 10 AND price <= 830000000")
    return price_statistics(dedup_rows(valid, "pos", "url"), ["site"], "price")


@query(
    "F2_run_batch",
    ("product_pages",),
    f"{OUTCOMES} SELECT url, CASE WHEN skip_reason IS NOT NULL THEN 'skipped' WHEN failure_type IS NOT NULL THEN 'rejected' ELSE 'product' END AS part FROM ends",
)
def run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job end to end: every page ends as product, reject or skip."""
    out = run_batch(table(spark, sf_dir, "product_pages"), new_folder(spark, "batch"))
    made = out.products.select(F.col("source_url").alias("url"), F.lit("product").alias("part"))
    made = made.unionByName(out.rejects.select("url", F.lit("rejected").alias("part")))
    return made.unionByName(out.skipped.select("url", F.lit("skipped").alias("part")))


@query("F3_batch_skips", ("product_pages",), f"{OUTCOMES} SELECT skip_reason, failure_type, count(*) AS pages FROM ends GROUP BY skip_reason, failure_type")
def skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the batch job by the reason for which they gave no product."""
    made = process_pages(table(spark, sf_dir, "product_pages"))
    return made.groupBy("skip_reason", "failure_type").agg(F.count("*").alias("pages"))
