"""Tables that several steps of a job read again, kept in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``. Only a session with threads for executors may make its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="curiomill-llm-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once and read them back: later steps start from files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(df: DataFrame, columns: list[str], rows: int) -> list:
    """At most ``rows`` rows, those with the smallest hashes of ``columns``, for fitting on the driver.

    Rows above a hash that a quarter more rows than asked for are expected to stay below are left out first, so what
    partitions send does not grow with their number.
    """
    span = 1 << 31
    limit = min(span, 5 * rows * span // (4 * max(df.count(), 1)) + 1)
    drawn = F.pmod(F.xxhash64(*columns), F.lit(span))
    return df.filter(drawn < limit).orderBy(drawn, *columns).limit(rows).collect()
