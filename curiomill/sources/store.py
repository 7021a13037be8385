"""Product store on Parquet: insert unless the URL is there, delete by keys, text sinks.

The table has one folder per write (``batch=<n>``). A repeated write replaces its own folder and leaves it out of the
duplicate check, so a retried batch gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curiomill.operators.dedup import delete_keys, new_rows
from curiomill.schemas import PRODUCTS
from curiomill.session import cut_lineage
from curiomill.sources.tables import crawl_items, csv_rows, export_rows

_ROW_BITS = 33  # a generated row number keeps the partition above this bit


def assign_ids(rows: DataFrame, start: int = 0, order: tuple[str, ...] = ("scrape_timestamp", "source_url")) -> DataFrame:
    """Consecutive ids after ``start`` in the given order, without a single-task sort.

    Rows are range-partitioned, sorted and written once with the number of their partition and their number in it;
    the id is the number of rows in the partitions before plus the latter.
    """
    ranged = rows.drop("id").repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = cut_lineage(
        ranged.withColumn("_mark", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_mark", _ROW_BITS))
    )
    # one row per partition
    sizes = sorted((r["_part"], r["n"]) for r in numbered.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], start
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    spark = rows.sparkSession
    before = spark.createDataFrame(offsets, "_part bigint, _before bigint")
    row_no = F.col("_mark").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        numbered.join(F.broadcast(before), "_part")
        .withColumn("id", F.col("_before") + row_no + 1)
        .select("id", *[c for c in rows.columns if c != "id"])
    )


def append_sources(sources: DataFrame, found: DataFrame) -> DataFrame:
    """Sources with new ones at the end: their positions go on after the largest, by base URL."""
    top = sources.agg(F.coalesce(F.max("pos"), F.lit(0))).first()[0]
    placed = assign_ids(found.drop("pos"), top, ("base_url",)).withColumnRenamed("id", "pos")
    return sources.unionByName(placed.select(*sources.columns))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def stored_products(spark: SparkSession, path: str) -> DataFrame:
    """The store; empty when nothing was written yet. Only the asked columns are read."""
    if not _exists(spark, path):
        return spark.createDataFrame([], PRODUCTS)
    return spark.read.schema(PRODUCTS).parquet(path)


def _stored_with_batch(spark: SparkSession, path: str) -> DataFrame:
    if not _exists(spark, path):
        return spark.createDataFrame([], PRODUCTS).withColumn("batch", F.lit(0).cast("bigint"))
    return spark.read.schema(T.StructType([*PRODUCTS.fields, T.StructField("batch", T.LongType())])).parquet(path)


def insert_products(
    batch: DataFrame, path: str, batch_id: int, order: str = "pos", target_rows: int | None = None
) -> DataFrame:
    """Insert the first row of every new URL; returns the rows inserted.

    ``target_rows`` bounds the table: of a batch that would go past it the first rows in order are kept.
    """
    spark = batch.sparkSession
    others = _stored_with_batch(spark, path).filter(F.col("batch") != batch_id)
    fresh = new_rows(batch, others, order)
    known = others.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"), F.count("*").alias("n")).first()
    if target_rows is not None:
        fresh = fresh.orderBy(order).limit(max(0, target_rows - known["n"]))
    numbered = assign_ids(fresh, known["top"]).select(*PRODUCTS.names)
    folder = f"{path}/batch={batch_id}"
    numbered.write.mode("overwrite").parquet(folder)
    return spark.read.schema(PRODUCTS).parquet(folder)


def delete_products(spark: SparkSession, path: str, keys: DataFrame, out_path: str) -> DataFrame:
    """Store without the listed URLs, written to a new folder (a table that is being read is never replaced). With no
    URL listed nothing is written."""
    if keys.isEmpty():
        return stored_products(spark, path)
    kept = delete_keys(stored_products(spark, path).select(*PRODUCTS.names), keys)
    kept.write.mode("overwrite").parquet(f"{out_path}/batch=0")
    return stored_products(spark, out_path)


def append_csv(products: DataFrame, path: str) -> None:
    """Append rows to a CSV folder; every part has the header."""
    csv_rows(products).write.mode("append").options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def export_csv(products: DataFrame, path: str) -> bool:
    """Full export ordered by id; nothing is written when there are no rows."""
    if products.isEmpty():
        return False
    rows = products.orderBy("id")
    export_rows(rows).write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue="").csv(path)
    return True


def write_items(products: DataFrame, path: str) -> None:
    """Crawl items as JSON lines."""
    crawl_items(products).write.mode("overwrite").json(path)
