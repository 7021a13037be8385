"""Queries for reports and statistics (A1-A12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.registry import query
from curiomill.operators import reports, sources_config


def _statistics(price: str, rows: str) -> str:
    return f"""(SELECT coalesce(min(p), 0.0::DOUBLE) AS min, coalesce(max(p), 0.0::DOUBLE) AS max,
 coalesce(CAST(sum(CAST(p AS DECIMAL(30,4))) AS DOUBLE) / count(*), 0.0::DOUBLE) AS avg,
 coalesce(max(CASE WHEN r = n // 2 + 1 THEN p END), 0.0::DOUBLE) AS median, count(*) AS count
 FROM (SELECT p, row_number() OVER (ORDER BY p) AS r, count(*) OVER () AS n FROM (SELECT {price} AS p FROM {rows}) WHERE p <> 0))"""


_MEANS = """coalesce(round(CAST(sum(CAST(nullif({c}, 0) AS DECIMAL(20,4))) FILTER (WHERE success) AS DOUBLE) / nullif(count(nullif({c}, 0)) FILTER (WHERE success), 0), 2), 0.0::DOUBLE)"""
_SECONDS = "(epoch_us(max(CAST(ts AS TIMESTAMP))) - epoch_us(min(CAST(ts AS TIMESTAMP)))) / 1000000.0::DOUBLE"
_WHOLE = f"CAST(floor({_SECONDS}) AS BIGINT)"
_TEXT = f"({_WHOLE} // 3600) || ':' || lpad(CAST(({_WHOLE} // 60) % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({_WHOLE} % 60 AS VARCHAR), 2, '0')"


@query("A1_price_statistics", ("products",), f"SELECT * FROM {_statistics('current_market_price', 'products')}")
def a1(spark, sf):
    return reports.price_statistics(table(spark, sf, "products"))


@query(
    "A1_statistics_by_work_type",
    ("products",),
    """SELECT work_type, min(p) AS min, max(p) AS max, CAST(sum(CAST(p AS DECIMAL(30,4))) AS DOUBLE) / count(*) AS avg,
 max(CASE WHEN r = n // 2 + 1 THEN p END) AS median, count(*) AS count
 FROM (SELECT work_type, current_market_price AS p, row_number() OVER (PARTITION BY work_type ORDER BY current_market_price) AS r,
  count(*) OVER (PARTITION BY work_type) AS n FROM products WHERE current_market_price <> 0) GROUP BY work_type""",
)
def a1_by(spark, sf):
    return reports.price_statistics(table(spark, sf, "products"), ["work_type"])


@query("A1_lineitem_prices", (), f"SELECT * FROM {_statistics('l_extendedprice', 'lineitem')}")
def a1_large(spark, sf):
    return reports.price_statistics(table(spark, sf, "lineitem"), price="l_extendedprice")


@query("A2_failures_by_type", ("attempts",), "SELECT failure_type, count(*) AS failures FROM attempts WHERE failure_type IS NOT NULL GROUP BY failure_type")
def a2(spark, sf):
    return reports.failures_by_type(table(spark, sf, "attempts"))


@query("A3_run_success_rate", ("attempts",), """SELECT count(*) FILTER (WHERE success) AS successes, count(*) FILTER (WHERE NOT success) AS failures,
 coalesce(count(*) FILTER (WHERE success) / nullif(count(success), 0)::DOUBLE, 0.0::DOUBLE) AS success_rate FROM attempts""")
def a3(spark, sf):
    return reports.run_success_rate(table(spark, sf, "attempts"))


@query("A4_state_success_rate", ("attempts",), """SELECT count(*) FILTER (WHERE success AND kind = 'product') AS successes, count(DISTINCT url) AS urls_processed,
 coalesce(count(*) FILTER (WHERE success AND kind = 'product') / nullif(count(DISTINCT url), 0)::DOUBLE, 0.0::DOUBLE) AS success_rate FROM attempts""")
def a4(spark, sf):
    return reports.state_success_rate(table(spark, sf, "attempts"))


@query("A5_url_outcomes", ("attempts",), """SELECT url, max(failure_type) FILTER (WHERE rn = 1) AS last_failure FROM (SELECT url, failure_type,
 row_number() OVER (PARTITION BY url, failure_type IS NULL ORDER BY ts DESC, attempt_id DESC) AS rn FROM attempts) GROUP BY url""")
def a5(spark, sf):
    return reports.url_outcomes(table(spark, sf, "attempts"))


@query("A5_outcome_counts", ("attempts",), """SELECT count(DISTINCT url) AS urls_processed, count(DISTINCT url) FILTER (WHERE failure_type IS NOT NULL) AS urls_failed FROM attempts""")
def a5_counts(spark, sf):
    return reports.url_outcome_counts(table(spark, sf, "attempts"))


@query("A6_mean_times", ("attempts",), f"SELECT {_MEANS.format(c='scrape_time')} AS avg_scrape_time, {_MEANS.format(c='extraction_time')} AS avg_extraction_time FROM attempts")
def a6(spark, sf):
    return reports.mean_times(table(spark, sf, "attempts"))


@query("A7_attempt_totals", ("attempts",), """SELECT count(*) AS total_attempts, count(*) FILTER (WHERE success) AS successes,
 count(*) FILTER (WHERE success AND kind = 'product') AS row_count FROM attempts""")
def a7(spark, sf):
    return reports.attempt_totals(table(spark, sf, "attempts"))


@query("A8_runtime", ("attempts",), f"SELECT {_SECONDS} AS runtime_seconds, {_TEXT} AS runtime FROM attempts")
def a8(spark, sf):
    return reports.runtime(table(spark, sf, "attempts"))


@query("A9_completion", ("products",), f"SELECT count(*) AS total_rows, 100.0::DOUBLE * count(*) / {K.TARGET_ROWS} AS completion_percent FROM products")
def a9(spark, sf):
    return reports.completion(table(spark, sf, "products"), K.TARGET_ROWS)


REPORT = f"""SELECT p.total_rows, p.completion_percent, r.successes, r.failures, r.success_rate, r.urls_processed, r.urls_failed,
 r.avg_scrape_time, r.avg_extraction_time, r.runtime, s.min AS price_min, s.max AS price_max, s.avg AS price_avg, s.median AS price_median, s.count AS price_count,
 (SELECT string_agg(failure_type || '=' || n, ',' ORDER BY failure_type) FROM (SELECT failure_type, count(*) AS n FROM attempts WHERE failure_type IS NOT NULL GROUP BY 1)) AS kinds
 FROM (SELECT count(*) AS total_rows, 100.0::DOUBLE * count(*) / {K.TARGET_ROWS} AS completion_percent FROM products) p,
 (SELECT count(*) FILTER (WHERE success) AS successes, count(*) FILTER (WHERE NOT success) AS failures,
  coalesce(count(*) FILTER (WHERE success) / nullif(count(success), 0)::DOUBLE, 0.0::DOUBLE) AS success_rate, count(DISTINCT url) AS urls_processed,
  count(DISTINCT url) FILTER (WHERE failure_type IS NOT NULL) AS urls_failed, {_MEANS.format(c='scrape_time')} AS avg_scrape_time,
  {_MEANS.format(c='extraction_time')} AS avg_extraction_time, {_TEXT} AS runtime FROM attempts) r,
 {_statistics('current_market_price', 'products')} s"""


@query("A10_final_report", ("products", "attempts"), REPORT)
def a10(spark, sf):
    report = reports.final_report(table(spark, sf, "products"), table(spark, sf, "attempts"), K.TARGET_ROWS)
    kinds = F.array_join(F.transform(F.map_entries("failures_by_type"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return report.withColumn("kinds", kinds).drop("failures_by_type", "runtime_seconds")


@query("A11_dirty_rows", ("products",), f"SELECT count(*) FILTER (WHERE {Q.polluted('source_url', 'current_market_price', K.DIRTY_SITES)}) AS dirty_rows FROM products")
def a11(spark, sf):
    return reports.dirty_rows(table(spark, sf, "products"), price="current_market_price")


@query("A12_source_inventory", ("sources",), "SELECT count(*) FILTER (WHERE coalesce(enabled, true)) AS enabled_sources, count(*) AS total_sources FROM sources")
def a12(spark, sf):
    return sources_config.source_inventory(table(spark, sf, "sources"))
