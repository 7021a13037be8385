"""De-duplication and clean-up of stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.functions.urls import dedup_key
from curiomill.operators.links import first_seen
from curiomill.operators.quality import is_polluted


def dedup_rows(rows: DataFrame, order: str, url: str = "source_url") -> DataFrame:
    """First row per item path, else per URL. Partial minimum per task, so a hot key never gathers its rows."""
    return first_seen(rows.withColumn("dedup_key", dedup_key(F.col(url))), "dedup_key", order).drop("dedup_key")


def removed_rows(rows: DataFrame, url: str = "source_url") -> DataFrame:
    """One row: rows that ``dedup_rows`` takes away."""
    return rows.agg(
        (F.count("*") - F.count_distinct(dedup_key(F.coalesce(url, F.lit(""))))).alias("removed_rows")
    )


def purge_list(rows: DataFrame, url: str = "source_url", price: str = "current_market_price_inr") -> DataFrame:
    """Distinct URLs of polluted rows."""
    return rows.filter(is_polluted(F.col(url), F.col(price))).select(url).distinct()


def keep_clean(rows: DataFrame, url: str = "source_url", price: str = "current_market_price_inr") -> DataFrame:
    return rows.filter(~F.coalesce(is_polluted(F.col(url), F.col(price)), F.lit(False)))


def delete_keys(rows: DataFrame, keys: DataFrame, key: str = "source_url") -> DataFrame:
    """Rows whose key is not in the list."""
    return rows.join(keys.select(key), key, "left_anti")


def new_rows(batch: DataFrame, stored: DataFrame, order: str, key: str = "source_url") -> DataFrame:
    """Rows to insert: the first of each key in the batch, unless the key is stored already."""
    return first_seen(batch, key, order).join(stored.select(key), key, "left_anti")
