"""The batch job: product pages in, products, rejects, skips and a report out."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.functions import money as M
from curiomill.functions import urls as U
from curiomill.operators import evidence as E
from curiomill.operators.dedup import new_rows
from curiomill.operators.extraction import Extractor, extract_records
from curiomill.operators.quality import failure_type
from curiomill.operators.reports import price_statistics
from curiomill.schemas import RECORD_FIELDS

OUTCOME_COLUMNS = [
    "pos", "url", "skip_reason", "failure_type", "error", *RECORD_FIELDS, "confidence",
]


class BatchResult(NamedTuple):
    products: DataFrame
    rejects: DataFrame
    skipped: DataFrame
    report: DataFrame


def process_pages(
    pages: DataFrame, stored: DataFrame | None = None, extractor: Extractor | None = None
) -> DataFrame:
    """One pass over (pos, url, html, status): every page with its record, or the reason why there is none.

    URL tests come first; pages that fail one keep no mark-up, so the later expressions cost nothing for them.
    """
    url = F.col("url")
    if stored is not None:
        pages = pages.join(stored.select(F.col("source_url").alias("url")), "url", "left_anti")
    reason = F.when(~U.has_product_hint(url), "no_product_hint").when(U.is_junk(url), "junk_url")
    gated = pages.withColumn("_gate", reason).withColumn("html", F.when(F.col("_gate").isNull(), F.col("html")))
    read = E.readable_pages(gated).withColumn("skip_reason", F.coalesce("_gate", "skip_reason"))
    read = read.withColumn("html", F.when(F.col("skip_reason").isNull(), F.col("html")))
    found = E.evidence(read.select("pos", "url", "html", "raw_text", "skip_reason"))
    found = found.withColumn("content", F.when(F.col("skip_reason").isNull(), F.col("content")))
    found = found.withColumn("gate_open", E.passes_auction_gate(url, F.col("content")))
    slim = found.select("pos", "url", "skip_reason", "ld_price", "ld_currency", "content", "gate_open")
    if extractor is None:
        records = extract_records(slim)
    else:  # a caller's extractor sees open pages only
        opened = slim.filter("skip_reason IS NULL AND gate_open")
        records = extract_records(opened, extractor).unionByName(
            slim.filter("skip_reason IS NOT NULL OR NOT gate_open"), allowMissingColumns=True
        )

    price = M.override_price(url, F.col("current_market_price"), F.col("ld_price"), F.col("ld_currency"))
    failure = F.when(F.col("skip_reason").isNotNull(), F.lit(None)).when(~F.col("gate_open"), "no_price").otherwise(
        failure_type(F.col("error"))
    )
    settled = records.withColumn("failure_type", failure).withColumn("final_price", price)
    limited = M.override_limited_edition(url, F.col("final_price"), F.col("limited_edition"))
    return (
        settled.withColumn("limited_edition", limited)
        .withColumn("current_market_price", F.col("final_price"))
        .select(*OUTCOME_COLUMNS)
    )


def run_batch(
    pages: DataFrame,
    work_path: str,
    stored: DataFrame | None = None,
    target_rows: int | None = None,
    extractor: Extractor | None = None,
) -> BatchResult:
    """Split the outcomes. They are written to ``work_path`` once, and all results read from there."""
    outcomes = process_pages(pages, stored, extractor)
    outcomes.write.mode("overwrite").parquet(work_path)
    outcomes = pages.sparkSession.read.schema(outcomes.schema).parquet(work_path)
    made = outcomes.filter("skip_reason IS NULL AND failure_type IS NULL").select(
        "pos", F.col("url").alias("source_url"), F.col("confidence").alias("extraction_confidence"), *RECORD_FIELDS
    )
    none = stored if stored is not None else made.select("source_url").limit(0)
    products = new_rows(made, none, "pos")
    if target_rows is not None:
        products = products.orderBy("pos").limit(target_rows)
    rejects = outcomes.filter("failure_type IS NOT NULL").select("pos", "url", "failure_type", "error")
    skipped = outcomes.filter("skip_reason IS NOT NULL").select("pos", "url", "skip_reason")
    return BatchResult(products, rejects, skipped, _report(products, outcomes))


def _report(products: DataFrame, outcomes: DataFrame) -> DataFrame:
    counts = outcomes.agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("skip_reason").isNotNull()).alias("skipped"),
        F.count_if(F.col("failure_type") == "no_price").alias("no_price"),
        F.count_if(F.col("failure_type") == "validation").alias("validation"),
    )
    prices = price_statistics(products)
    return counts.withColumn("_one", F.lit(1)).join(prices.withColumn("_one", F.lit(1)), "_one").drop("_one")
