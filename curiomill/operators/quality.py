"""Validation, confidence, failure classes and the split into valid rows and rejects."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.functions.text import contains_any, once, strip

# fixed values: half scores that round up (the others round down), as binary floating point does
ROUND_UP = [32.5, 37.5, 52.5, 67.5, 77.5, 87.5, 92.5]


def price_error(price: Column) -> Column:
    """First failing price rule as a message, null when the price is fine."""
    shown = F.concat(F.lit("₹"), F.format_number(price, 2))
    return (
        F.when(price.isNull() | (price <= 0), "Missing or invalid price")
        .when(price > K.PRICE_CEILING, F.concat(F.lit("Price too high (likely hallucination): "), shown))
        .when(price < K.PRICE_FLOOR, F.concat(F.lit("Price too low for luxury item: "), shown))
    )


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(float(points))).otherwise(F.lit(0.0))


def _has_text(name: str) -> Column:
    return strip(F.col(name)) != ""


def confidence_score() -> Column:
    """Score out of 100 of a record with its price column ``current_market_price``."""
    price = F.col("current_market_price")
    required = ["material_used", "origin", "date_of_manufacture", "colour"]
    optional = ["valuable_gem", "expensive_material", "brand", "dimensions", "weight", "seller_reputation"]
    detail = reduce(
        lambda a, b: a | b, [F.coalesce(F.col(f) != "", F.lit(False)) for f in optional[:2] + ["defects"]]
    )
    parts = (
        [_points(price > 0, 30)]
        + [_points(_has_text(f), 5) for f in required]
        + [_points(F.col(f) != "", 2.5) for f in optional]
        + [
            _points(_has_text("brand"), 10),
            _points(detail, 5),
            _points(F.length("material_used") > 10, 5),
            _points(F.col("work_type") != "Unknown", 5),
            F.when(price.between(K.CONFIDENCE_PRICE_LOW, K.CONFIDENCE_PRICE_HIGH), 10.0)
            .when((price >= K.PRICE_FLOOR) & (price < K.CONFIDENCE_PRICE_LOW), 5.0)
            .otherwise(0.0),
        ]
    )
    return reduce(add, parts)


def round_score(score: Column) -> Column:
    """Share of 100 with two decimals; ties go the way binary rounding takes them."""
    return (
        F.when(score % 1 == 0, score / 100)
        .when(score.isin(ROUND_UP), (score + 0.5) / 100)
        .otherwise((score - 0.5) / 100)
    )


def validated(records: DataFrame) -> DataFrame:
    """Add ``is_valid``, ``error`` and ``confidence`` (0 for failing rows)."""
    checked = records.withColumn("error", price_error(F.col("current_market_price")))
    return checked.withColumn("is_valid", F.col("error").isNull()).withColumn(
        "confidence", F.when(F.col("error").isNull(), once(confidence_score(), round_score)).otherwise(F.lit(0.0))
    )


def failure_type(error: Column) -> Column:
    """Failure class of a validation message."""
    return F.when(F.lower(error).contains("price"), "no_price").when(error.isNotNull(), "validation")


def split_valid(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejects with their failure class) of validated records."""
    valid = records.filter("is_valid")
    rejects = records.filter("NOT is_valid").withColumn("failure_type", failure_type(F.col("error")))
    return valid, rejects


def display_line() -> Column:
    """One-line description of a record."""
    price = F.col("current_market_price")
    shown = F.when(price != 0, F.concat(F.lit("INR "), F.format_number(price, 0)))

    def named(column: Column) -> Column:
        return F.coalesce(F.nullif(column, F.lit("")), F.lit("N/A"))

    return F.concat(
        F.lit("ProductData(material="), named(F.col("material_used")),
        F.lit(", origin="), named(F.col("origin")),
        F.lit(", price="), named(shown),
        F.lit(", brand="), named(F.col("brand")), F.lit(")"),
    )


def stored_line() -> Column:
    """One-line description of a stored product."""
    price = F.col("current_market_price")
    shown = F.when(price != 0, F.concat(F.lit("₹"), F.format_number(price, 2)))
    none = F.lit("None")
    return F.concat(
        F.lit("<Product(id="), F.col("id").cast("string"),
        F.lit(", brand="), F.coalesce("brand", none),
        F.lit(", price="), F.coalesce(shown, F.lit("N/A")),
        F.lit(", origin="), F.coalesce("origin", none), F.lit(")>"),
    )


def is_polluted(url: Column, price: Column) -> Column:
    """Rows with a currency mix-up: foreign-currency sites, and the stub price of one site."""
    stub = contains_any(url, K.STUB_PRICE_SITES) & (price == K.STUB_PRICE)
    return contains_any(url, K.DIRTY_SITES) | F.coalesce(stub, F.lit(False))
