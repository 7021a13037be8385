"""Exact upper median without gathering a group.

The rank is narrowed down in three steps (blocks of 65,536, then whole units, then values) over distinct
(key, value) counts. Every step orders at most one small histogram per key, so neither a hot key nor a table with
many distinct values lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = 65536


def _pick(histogram: DataFrame, keys: list[str], step: str) -> DataFrame:
    """Bucket of the histogram that holds the wanted rank, with the rank inside of it."""
    w = Window.partitionBy(*keys).orderBy(step)
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        histogram.withColumn("upto", upto)
        .filter((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        .withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n")))
        .select(*keys, step, "rank")
    )


def upper_median(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key the value at position n // 2 of the sorted non-null values, as ``median``."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("block", F.floor(F.col("v") / _BLOCK)).withColumn("unit", F.floor("v"))
    ranks = counts.groupBy(*keys).agg(F.floor(F.sum("n") / 2).alias("rank"))

    blocks = counts.groupBy(*keys, "block").agg(F.sum("n").alias("n")).join(ranks, keys)
    block = _pick(blocks, keys, "block")
    units = counts.join(block, [*keys, "block"]).groupBy(*keys, "unit", "rank").agg(F.sum("n").alias("n"))
    unit = _pick(units, keys, "unit")
    values = counts.join(unit, [*keys, "unit"]).select(*keys, "v", "n", "rank")
    return _pick(values, keys, "v").select(*keys, F.col("v").alias("median"))
