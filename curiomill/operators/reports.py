"""Run reports and price statistics. All are partial + final aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curiomill.operators.order_stats import upper_median
from curiomill.operators.quality import is_polluted


def _mean(total: Column, n: Column) -> Column:
    """Mean from an exact decimal total, 0 when there is nothing to average."""
    return F.coalesce(F.try_divide(total.cast("double"), n), F.lit(0.0))


def price_statistics(products: DataFrame, keys: list[str] | None = None, price: str = "current_market_price") -> DataFrame:
    """Minimum, maximum, mean, upper median and count over non-zero prices; one row of zeros when there are none."""
    group = keys or ["_all"]
    rows = products if keys else products.withColumn("_all", F.lit(0))
    rows = rows.filter(F.col(price).isNotNull() & (F.col(price) != 0)).select(*group, F.col(price).alias("p"))
    stats = rows.groupBy(*group).agg(
        F.min("p").alias("min"),
        F.max("p").alias("max"),
        _mean(F.sum(F.col("p").cast("decimal(30,4)")), F.count("*")).alias("avg"),
        F.count("*").alias("count"),
    )
    full = stats.join(upper_median(rows, group, "p"), group)
    if keys:
        return full.select(*keys, "min", "max", "avg", "median", "count")
    zero = products.sparkSession.range(1).select(F.lit(0).alias("_all"))
    filled = zero.join(full, "_all", "left")
    return filled.select(
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("min", "max", "avg", "median")],
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
    )


def failures_by_type(attempts: DataFrame) -> DataFrame:
    """Failed attempts per failure type."""
    return attempts.filter("failure_type IS NOT NULL").groupBy("failure_type").agg(F.count("*").alias("failures"))


def _rate(good: Column, of: Column) -> Column:
    return F.coalesce(F.try_divide(good, of), F.lit(0.0))


def _good() -> Column:
    return F.count_if(F.col("success"))


def _bad() -> Column:
    return F.count_if(~F.col("success"))


def _stored() -> Column:
    return F.count_if(F.col("success") & (F.col("kind") == "product"))


def run_success_rate(attempts: DataFrame) -> DataFrame:
    """One row: successes over all finished attempts of the run form."""
    return attempts.agg(_good().alias("successes"), _bad().alias("failures"), _rate(_good(), _good() + _bad()).alias("success_rate"))


def state_success_rate(attempts: DataFrame) -> DataFrame:
    """One row: stored products over distinct processed URLs, listing pages included."""
    processed = F.count_distinct("url")
    return attempts.agg(
        _stored().alias("successes"), processed.alias("urls_processed"), _rate(_stored(), processed).alias("success_rate")
    )


def url_outcomes(attempts: DataFrame) -> DataFrame:
    """Processed URLs with their last failure reason (null for URLs that never failed)."""
    reason = F.max_by("failure_type", F.when(F.col("failure_type").isNotNull(), F.struct("ts", "attempt_id")))
    return attempts.groupBy("url").agg(reason.alias("last_failure"))


def _failed_urls() -> Column:
    return F.count_distinct(F.when(F.col("failure_type").isNotNull(), F.col("url")))


def url_outcome_counts(attempts: DataFrame) -> DataFrame:
    """One row: distinct processed and distinct failed URLs."""
    return attempts.agg(F.count_distinct("url").alias("urls_processed"), _failed_urls().alias("urls_failed"))


def _mean_time(name: str) -> Column:
    seconds = F.when(F.col("success"), F.nullif(F.col(name), F.lit(0.0)))
    return F.round(_mean(F.sum(seconds.cast("decimal(20,4)")), F.count(seconds)), 2)


def mean_times(attempts: DataFrame) -> DataFrame:
    """One row: mean scrape and extraction seconds of successes; zero samples do not count."""
    return attempts.agg(
        _mean_time("scrape_time").alias("avg_scrape_time"), _mean_time("extraction_time").alias("avg_extraction_time")
    )


def attempt_totals(attempts: DataFrame) -> DataFrame:
    """One row: attempts, successes and stored rows."""
    return attempts.agg(F.count("*").alias("total_attempts"), _good().alias("successes"), _stored().alias("row_count"))


def _seconds() -> Column:
    return (F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))) / F.lit(1_000_000.0)


def _runtime_text() -> Column:
    seconds = F.floor(_seconds()).cast("bigint")
    return F.concat_ws(
        ":",
        F.floor(seconds / 3600).cast("string"),
        F.lpad((F.floor(seconds / 60) % 60).cast("string"), 2, "0"),
        F.lpad((seconds % 60).cast("string"), 2, "0"),
    )


def runtime(attempts: DataFrame) -> DataFrame:
    """One row: run time in seconds and as text."""
    return attempts.agg(_seconds().alias("runtime_seconds"), _runtime_text().alias("runtime"))


def completion(products: DataFrame, target_rows: int) -> DataFrame:
    """One row: rows collected and their percentage of the target."""
    rows = F.count("*")
    return products.agg(
        rows.alias("total_rows"), (F.lit(100.0) * rows / F.lit(target_rows)).alias("completion_percent")
    )


def final_report(products: DataFrame, attempts: DataFrame, target_rows: int) -> DataFrame:
    """One row with all of the above, failure types as a map over the types that occurred."""
    one = "_one"

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn(one, F.lit(1))

    # failure types are a small closed set, so the map stays small
    kinds = failures_by_type(attempts).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("failure_type", "failures")))).alias("failures_by_type")
    )
    prices = price_statistics(products).select(
        F.col("min").alias("price_min"), F.col("max").alias("price_max"), F.col("avg").alias("price_avg"),
        F.col("median").alias("price_median"), F.col("count").alias("price_count"),
    )
    run = attempts.agg(  # all measures of the log in one scan
        _good().alias("successes"), _bad().alias("failures"), _rate(_good(), _good() + _bad()).alias("success_rate"),
        F.count_distinct("url").alias("urls_processed"), _failed_urls().alias("urls_failed"),
        _mean_time("scrape_time").alias("avg_scrape_time"), _mean_time("extraction_time").alias("avg_extraction_time"),
        _seconds().alias("runtime_seconds"), _runtime_text().alias("runtime"),
    )
    parts = [run, kinds, prices]
    report = keyed(completion(products, target_rows))
    for part in parts:
        report = report.join(keyed(part), one)
    return report.drop(one)


def run_report(report: DataFrame) -> DataFrame:
    """Envelope row of a run: success flag, rows, report as JSON, error."""
    return report.select(
        F.lit(True).alias("success"),
        F.col("total_rows").alias("rows_collected"),
        F.to_json(F.struct("*")).alias("report"),
        F.lit(None).cast("string").alias("error"),
    )


def dirty_rows(rows: DataFrame, url: str = "source_url", price: str = "current_market_price_inr") -> DataFrame:
    """One row: polluted rows."""
    return rows.agg(F.count_if(is_polluted(F.col(url), F.col(price))).alias("dirty_rows"))
