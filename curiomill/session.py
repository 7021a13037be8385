"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, named by the session. Only a session whose executors are threads of one
    process (tests) may make its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="curiomill-")
        context.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, name: str) -> str:
    """Unused folder path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows to the shared folder once and read them back.

    Ends the plan of iterative jobs and survives the loss of executors; unlike a checkpoint the rows are computed
    only once.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows, with costly columns worked out here only.

    Spark moves later filters down to the source and works out there, once more, each column that they name. It moves
    none below columns of which one is not deterministic and in use; this one keeps all rows.
    """
    return df.withColumn("_task", F.spark_partition_id()).filter("_task >= 0").drop("_task")


def state_partitions(spark: SparkSession) -> int:
    """Partitions of the state of a stream: as many as there are cores, if that is fewer than shuffles have."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


@contextmanager
def run_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for what runs inside."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
