"""Readers with declared schemas, and text forms of stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curiomill import constants as K
from curiomill.functions.html import visible_text
from curiomill.operators.links import first_seen
from curiomill.schemas import BOOL_FIELDS, PAGES, PRODUCTS, RECORD_FIELDS, RESPONSES

CSV_SCHEMA = T.StructType(
    [
        T.StructField(c, T.DoubleType() if c in ("current_market_price_inr", "extraction_confidence") else T.StringType())
        for c in K.CSV_COLUMNS
    ]
)


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PAGES) -> DataFrame:
    """Snapshot of fetched pages."""
    return spark.read.schema(schema).parquet(path)


def stream_pages(spark: SparkSession, path: str, schema: T.StructType = PAGES, files_per_batch: int = 64) -> DataFrame:
    """The same snapshot as a stream of files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Collected model responses as JSON lines."""
    return spark.read.schema(RESPONSES).json(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PRODUCTS).parquet(path)


def read_products_csv(spark: SparkSession, path: str) -> DataFrame:
    """Product CSV with header; quoted text may span lines."""
    return (
        spark.read.schema(CSV_SCHEMA)
        .options(header=True, quote='"', escape='"', multiLine=True)
        .csv(path)
    )


def _text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _truth(column: Column) -> Column:
    return F.coalesce(F.initcap(column.cast("string")), F.lit(""))


def float_text(column: Column) -> Column:
    """Shortest text of a number with up to six decimals: at least one decimal, no exponent."""
    trimmed = F.regexp_replace(F.format_string("%.6f", column), r"0+$", "")
    return F.when(column.isNotNull(), F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed))


def csv_rows(products: DataFrame) -> DataFrame:
    """The 19 CSV columns as written row by row: fixed decimals, empty text for missing and zero values."""
    price, score = F.col("current_market_price"), F.col("extraction_confidence")
    values = {
        "id": F.col("id").cast("string"),
        "scrape_timestamp": F.date_format("scrape_timestamp", "yyyy-MM-dd HH:mm:ss"),
        "source_url": F.col("source_url"),
        "extraction_confidence": F.when(score != 0, F.format_string("%.3f", score)).otherwise(""),
        "current_market_price_inr": F.when(price != 0, F.format_string("%.2f", price)).otherwise(""),
    }
    return products.select(*[_csv_value(c, values).alias(c) for c in K.CSV_COLUMNS])


def _csv_value(column: str, values: dict[str, Column]) -> Column:
    if column in values:
        return values[column]
    return _truth(F.col(column)) if column in BOOL_FIELDS else _text(F.col(column))


def _iso(column: str) -> Column:
    """ISO text; microseconds only where there are any."""
    stamp = F.col(column)
    whole = F.unix_micros(stamp.cast("timestamp")) % 1_000_000 == 0
    return F.when(whole, F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )


def export_rows(products: DataFrame) -> DataFrame:
    """The 19 CSV columns as exported at once: plain numbers, ISO time, empty text for null."""
    values = {
        "id": F.col("id").cast("string"),
        "scrape_timestamp": _text(_iso("scrape_timestamp")),
        "source_url": F.col("source_url"),
        "extraction_confidence": _text(float_text(F.col("extraction_confidence"))),
        "current_market_price_inr": _text(float_text(F.col("current_market_price"))),
    }
    return products.select(*[_csv_value(c, values).alias(c) for c in K.CSV_COLUMNS])


def product_dicts(products: DataFrame) -> DataFrame:
    """(id, json) with every column of a row, ISO time, nulls kept."""
    fields = [
        F.col("id"), F.col("source_url"), _iso("scrape_timestamp").alias("scrape_timestamp"),
        F.col("extraction_confidence"), *[F.col(f) for f in RECORD_FIELDS],
    ]
    return products.select("id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))


def crawl_items(products: DataFrame) -> DataFrame:
    """The six columns of a crawl item."""
    return products.select(
        F.col("source_url").alias("url"),
        F.col("current_market_price").alias("price_inr"),
        "brand",
        F.col("material_used").alias("material"),
        "origin",
        F.col("extraction_confidence").alias("confidence"),
    )


def price_extract(products: DataFrame) -> DataFrame:
    return products.select("source_url", F.col("current_market_price").alias("current_market_price_inr"))


def ordered_page(products: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """Rows by id with offset and limit; 0 or None means none."""
    rows = products.orderBy("id")
    if offset:
        rows = rows.offset(offset)
    return rows.limit(limit) if limit else rows


def fetch_results(pages: DataFrame, order: str) -> DataFrame:
    """One fetch result per URL, the earliest by order."""
    once = first_seen(pages.select("url", "html", order), "url", order)
    return once.select(
        "url",
        F.col("html").isNotNull().alias("success"),
        F.col("html").alias("raw_html"),
        visible_text(F.col("html")).alias("raw_text"),
        F.when(F.col("html").isNull(), F.lit("no content")).alias("error"),
    )
