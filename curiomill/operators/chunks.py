"""Ordered computations over long logs, split by time or position.

A key may hold a third of the log, so its rows are never sorted in one task: each (key, chunk) is worked on alone,
and only one summary row per chunk goes through the per-key pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def time_chunk(ts: Column, seconds: int = DAY_SECONDS) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("bigint")


def running_total(
    df: DataFrame, key: str, order: str, value: str, out: str, chunk_rows: int = 1 << 16
) -> DataFrame:
    """Inclusive running sum of ``value`` per key in the order of an integer position column."""
    chunked = df.withColumn("_chunk", F.floor(F.col(order) / chunk_rows).cast("bigint"))
    totals = chunked.groupBy(key, "_chunk").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        chunked.withColumn(out, F.sum(value).over(inside))
        .join(offsets, [key, "_chunk"])
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_chunk", "_offset")
    )


def halt_points(
    log: DataFrame, run: str, order: Column, ok: str, limit: int, chunk_seconds: int = DAY_SECONDS
) -> DataFrame:
    """Per run the order key (``halt_at``) of the row that completes the first ``limit`` failures in a row.

    Each chunk is reduced to its leading failures (the first ``limit`` keys of them), trailing failures and the first
    halt inside; the failures carried into a chunk come from the chunk summaries.
    """
    inside = Window.partitionBy(run, "_chunk").orderBy("_key")
    rows = (
        log.select(run, F.col(ok).alias("_ok"), order.alias("_key"), time_chunk(F.col("ts"), chunk_seconds).alias("_chunk"))
        .withColumn("_rn", F.row_number().over(inside))
        .withColumn("_last_ok", F.max(F.when(F.col("_ok"), F.col("_rn"))).over(inside))
        .withColumn("_streak", F.col("_rn") - F.coalesce("_last_ok", F.lit(0)))
    )
    leading = F.col("_last_ok").isNull()
    summary = rows.groupBy(run, "_chunk").agg(
        F.count("*").alias("_n"),
        F.max("_last_ok").alias("_last_ok"),
        F.count_if(leading).alias("_lead"),
        F.sort_array(F.collect_list(F.when(leading & (F.col("_rn") <= limit), F.col("_key")))).alias("_lead_keys"),
        F.min(F.when(~leading & (F.col("_streak") >= limit), F.col("_key"))).alias("_inner"),
    )
    upto = Window.partitionBy(run).orderBy("_chunk")
    has_ok = F.col("_last_ok").isNotNull()
    carried = (
        summary.withColumn("_island", F.count_if(has_ok).over(upto))
        .withColumn("_tail", F.when(has_ok, F.col("_n") - F.col("_last_ok")).otherwise(F.col("_n")))
        .withColumn(
            "_out", F.sum("_tail").over(Window.partitionBy(run, "_island").orderBy("_chunk"))
        )
        .withColumn("_carry", F.coalesce(F.lag("_out").over(upto), F.lit(0)))
    )
    reached = (F.col("_carry") < limit) & (F.col("_carry") + F.col("_lead") >= limit)
    own = F.when(reached, F.get("_lead_keys", (F.lit(limit) - F.col("_carry") - 1).cast("int")))
    return carried.groupBy(run).agg(F.min(F.coalesce(own, F.col("_inner"))).alias("halt_at"))


def mark_halted(
    log: DataFrame, run: str, order: Column, ok: str, limit: int, chunk_seconds: int = DAY_SECONDS
) -> DataFrame:
    """Add ``processed``: false for rows after the run's halt."""
    halts = halt_points(log, run, order, ok, limit, chunk_seconds)
    return (
        log.withColumn("_key", order)
        .join(halts, run, "left")
        .withColumn("processed", F.coalesce(F.col("_key") <= F.col("halt_at"), F.lit(True)))
        .drop("_key", "halt_at")
    )
