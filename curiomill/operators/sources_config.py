"""Operators on the table of source configurations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions.urls import path_part
from curiomill.operators.links import with_anchors

COLUMNS = [
    "pos", "name", "base_url", "category", "product_selector", "next_page_selector", "priority", "enabled",
]


def enabled_sources(sources: DataFrame) -> DataFrame:
    """Sources whose flag is true or missing."""
    return sources.filter(F.coalesce("enabled", F.lit(True)))


def seeds_needed(target_rows: int) -> int:
    """Seeds that give twice the target at the usual number of links per seed, at least three."""
    return max(3, target_rows * 2 // K.LINKS_PER_SEED + 1)


def choose_seeds(sources: DataFrame, target_rows: int = K.TARGET_ROWS) -> DataFrame:
    """First seeds by priority; a missing priority is middling, ties keep configuration order."""
    order = F.coalesce("priority", F.lit(K.DEFAULT_PRIORITY))
    return enabled_sources(sources).orderBy(order, "pos").limit(seeds_needed(target_rows))


def source_inventory(sources: DataFrame) -> DataFrame:
    """One row: enabled sources of all."""
    return sources.agg(
        F.count_if(F.coalesce("enabled", F.lit(True))).alias("enabled_sources"),
        F.count("*").alias("total_sources"),
    )


def _source_rows(df: DataFrame, **values: Column) -> DataFrame:
    return df.select(*[values[c].alias(c) for c in COLUMNS])


def discover_auctions(pages: DataFrame, root: str = "https://www.bonhams.com") -> DataFrame:
    """New source rows for the auctions that a calendar page links to."""
    href = F.col("a.href")
    hrefs = (
        with_anchors(pages)
        .select(F.explode("anchors").alias("a"))
        .filter(href.startswith("/auction/") & ~href.contains("/lot/"))
        .select(href.alias("href"))
        .distinct()
    )
    parts = F.split(F.regexp_replace("href", "^/+|/+$", ""), "/")
    found = hrefs.select("href", F.try_element_at(parts, F.lit(2)).alias("auction")).filter("auction IS NOT NULL")
    return _source_rows(
        found,
        pos=F.lit(None).cast("bigint"),
        name=F.concat(F.lit("bonhams_auto_"), "auction"),
        base_url=F.concat(F.lit(root), "href"),
        category=F.lit("auction_auto_discovered"),
        product_selector=F.lit("a[href*='/lot/']"),
        next_page_selector=F.lit("a[rel='next']"),
        priority=F.lit(6).cast("bigint"),
        enabled=F.lit(True),
    )


def category_sources(urls: DataFrame, segment: int) -> DataFrame:
    """Source rows for category pages (column ``url``, order ``pos``); the category is a part of the URL."""
    category = path_part(F.col("url"), segment)
    return _source_rows(
        urls,
        pos=F.col("pos").cast("bigint"),
        name=F.concat(F.lit("liveauctioneers_"), category),
        base_url=F.col("url"),
        category=category,
        product_selector=F.lit('a[href*="/item/"]'),
        next_page_selector=F.lit('a[rel="next"]'),
        priority=F.lit(1).cast("bigint"),
        enabled=F.lit(True),
    )


def disable_and_append(sources: DataFrame, urls: DataFrame) -> DataFrame:
    """Switch every source off and append category pages, named by the part before the last slash."""
    return sources.withColumn("enabled", F.lit(False)).unionByName(category_sources(urls, -2))


def replace_by_prefix(sources: DataFrame, urls: DataFrame, prefix: str = "liveauctioneers_") -> DataFrame:
    """Drop the sources with this name prefix and append category pages, named by the second last part."""
    return sources.filter(~F.col("name").startswith(prefix)).unionByName(category_sources(urls, -3))


def load_sources(spark: SparkSession, path: str) -> DataFrame:
    """Source table from a Parquet or JSON lines folder, with the declared schema."""
    from curiomill.schemas import SOURCES

    if path.endswith((".json", ".jsonl")):
        return spark.read.schema(SOURCES).json(path)
    return spark.read.schema(SOURCES).parquet(path)
