"""Conversion with the rate table."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiomill import constants as K


def rate_table(spark: SparkSession) -> DataFrame:
    """(currency, rate) of the fixed rates; twelve rows."""
    rows = [(code, Decimal(str(rate))) for code, rate in K.RATES_TO_INR.items()]
    return spark.createDataFrame(rows, "currency string, rate decimal(10,4)")


def normalise_to_inr(df: DataFrame, price: str = "price", currency: str = "currency", out: str = "price_inr") -> DataFrame:
    """Price times rate with two decimals; a currency without a rate leaves the price as it is."""
    rates = F.broadcast(rate_table(df.sparkSession).withColumnRenamed("currency", "_code"))
    converted = F.round(F.col(price).cast("decimal(20,4)") * F.col("rate"), 2).cast("double")
    return (
        df.join(rates, F.upper(F.col(currency)) == F.col("_code"), "left")
        .withColumn(out, F.coalesce(converted, F.col(price)))
        .drop("_code", "rate")
    )
