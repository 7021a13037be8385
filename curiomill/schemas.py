"""Explicit table schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

STRING_FIELDS = [
    "material_used", "valuable_gem", "expensive_material", "origin", "date_of_manufacture", "defects",
    "colour", "seller_reputation", "dimensions", "weight", "brand",
]
# text fields whose blank values become null (the other three text fields keep them)
BLANKABLE_FIELDS = [
    "material_used", "valuable_gem", "expensive_material", "origin", "date_of_manufacture", "defects",
    "colour", "brand",
]
BOOL_FIELDS = ["scratches", "limited_edition"]

RECORD_FIELDS = [
    "material_used", "valuable_gem", "expensive_material", "origin", "date_of_manufacture", "defects",
    "scratches", "colour", "current_market_price", "seller_reputation", "dimensions", "weight", "work_type",
    "brand", "limited_edition",
]


def _field_type(name: str) -> T.DataType:
    if name in BOOL_FIELDS:
        return T.BooleanType()
    if name == "current_market_price":
        return T.DoubleType()
    return T.StringType()


RECORD = T.StructType([T.StructField(n, _field_type(n)) for n in RECORD_FIELDS])

PRODUCTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("scrape_timestamp", T.TimestampType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("extraction_confidence", T.DoubleType()),
    ]
    + RECORD.fields
)

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

SOURCES = T.StructType(
    [
        T.StructField("pos", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("base_url", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("product_selector", T.StringType()),
        T.StructField("next_page_selector", T.StringType()),
        T.StructField("priority", T.LongType()),
        T.StructField("enabled", T.BooleanType()),
    ]
)

RESPONSES = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("response_text", T.StringType()),
    ]
)
