"""Streaming forms: seen-URL de-duplication, continuous product flow, target stop and resume."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from curiomill.functions import urls as U
from curiomill.operators.extraction import Extractor
from curiomill.operators.links import gate_products, product_links
from curiomill.plans.batch import process_pages
from curiomill.schemas import RECORD_FIELDS
from curiomill.session import cut_lineage, run_settings, state_partitions
from curiomill.sources.store import insert_products, stored_products
from curiomill.streaming.breaker import ROCKSDB

# State with mark-up lies on disk, not on the heap, within a bound of memory for each executor. A batch without rows would
# only take out of the state what the next one with rows takes out too. Mark-up is read in small tasks: 128 MB of a file
# are many GB of pages.
FLOW = ROCKSDB | {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "1000",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def seen_once(urls: DataFrame, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Each URL once per run. With an event time, keys are forgotten after the delay."""
    if event_time is None:
        return urls.dropDuplicates(["url"])
    return urls.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["url"])


def product_rows(outcomes: DataFrame) -> DataFrame:
    """Product rows of the pages that gave a valid record, from outcomes of ``process_pages``."""
    good = outcomes.filter("skip_reason IS NULL AND failure_type IS NULL")
    return good.select(
        "pos", F.col("url").alias("source_url"), F.col("confidence").alias("extraction_confidence"), *RECORD_FIELDS
    )


def run_flow(
    pages: DataFrame,
    store_path: str,
    checkpoint: str,
    target_rows: int | None = None,
    extractor: Extractor | None = None,
) -> int:
    """Run the flow over all pages available now, append each batch to the store, and return the stored rows.

    The batch number names the folder a batch is written to, so a restarted run continues without duplicates. Rows are
    stamped with a moment that follows from the batch number, so a batch that is replayed gives the same table. Once
    the target is reached the query is stopped, and what is left is not extracted.
    """
    reached = threading.Event()

    def save(batch: DataFrame, batch_id: int) -> None:
        if reached.is_set():
            return
        # pages are worked on once a batch; the insert looks at the rows several times
        outcomes = cut_lineage(process_pages(batch, None, extractor), "batch")
        stamped = product_rows(outcomes).withColumn("scrape_timestamp", F.timestamp_seconds(F.lit(batch_id)))
        insert_products(stamped, store_path, batch_id, "pos", target_rows)
        if target_rows is not None and stored_products(batch.sparkSession, store_path).count() >= target_rows:
            reached.set()

    running = pages.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    while not running.awaitTermination(1):
        if reached.is_set():
            running.stop()
    return stored_products(pages.sparkSession, store_path).count()


def queued_links(listings: DataFrame, delay: str) -> DataFrame:
    """Product links of a stream of listing pages (url, html, category, product_selector, fetched_at): item, url,
    queued_at.

    ``item`` is the canonical link, ``url`` the same with its category; each url is queued once while its time is within
    ``delay`` of the newest, links of other sites are dropped after that. The first arrival of a url decides from which
    page it comes. Links that are no products, which only the url tells, are dropped before they get to the state.
    """
    found = product_links(listings.withWatermark("fetched_at", delay), keep=("category", "fetched_at"))
    item = U.canonical_item(F.col("url"))
    named = found.select("page_url", "fetched_at", item.alias("item"), U.tag_category(item, F.col("category")).alias("url"))
    once = gate_products(named).dropDuplicatesWithinWatermark(["url"])
    kept = once.filter(U.same_site(F.col("url"), F.col("page_url")))
    return kept.select("item", "url", F.col("fetched_at").alias("queued_at"))


def pages_of_links(queue: DataFrame, pages: DataFrame, delay: str, wait: str) -> DataFrame:
    """Queued links with the page that was fetched for them within ``wait``: pos, url, html, status.

    ``pages`` is a stream (pos, url, html, status, fetched_at). Links wait no longer than ``wait`` and ``delay``, pages
    no longer than ``delay``: then the watermark takes them out of the state.
    """
    seen = pages.withWatermark("fetched_at", delay).select(
        "pos", U.canonical_item(F.col("url")).alias("page_item"), "html", "status", F.col("fetched_at").alias("seen_at")
    )
    met = F.expr(f"item = page_item AND seen_at >= queued_at AND seen_at <= queued_at + INTERVAL {wait}")
    return queue.join(seen, met).select("pos", "url", "html", "status")


def run_listing_flow(
    listings: DataFrame, pages: DataFrame, store_path: str, checkpoint: str, delay: str = "1 hour", wait: str = "2 hours",
    target_rows: int | None = None, extractor: Extractor | None = None,
) -> int:
    """The whole flow: links of listing pages, the pages fetched for them, records, store. Returns the stored rows."""
    met = pages_of_links(queued_links(listings, delay), pages, delay, wait)
    spark = listings.sparkSession
    with run_settings(spark, FLOW | {"spark.sql.shuffle.partitions": str(state_partitions(spark))}):
        return run_flow(met, store_path, checkpoint, target_rows, extractor)


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder until the available input is used up."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
