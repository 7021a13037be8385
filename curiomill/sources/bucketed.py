"""Product store for many rows and several writers: a bucketed table and versioned commits.

Rows lie in a table clustered by URL into a fixed number of buckets, one partition for each write. An insert shuffles its
own rows into the buckets once; stored rows are read where they lie, so the duplicate check has no shuffle of the store.

What a write left in its folder counts only when a commit file names it. Commit files are numbered; a writer makes the
file after the one that it has read, and the first to do so wins. The other takes its rows up against the new version and
tries again. A commit file holds the whole state, so a reader needs the last one only: which writes count, how many rows
there are, and which batch made which write, so a repeated batch changes nothing. Folders of writes that never got a
commit file are not read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiomill.schemas import PRODUCTS
from curiomill.sources.store import assign_ids

BUCKETS = 64


class State(NamedTuple):
    """What a commit file says: its number, rows stored, and the write of each batch."""

    version: int
    rows: int
    writes: dict[str, str]


class Write(NamedTuple):
    """Rows in the folder of a write, not yet committed: the state they were checked against, and their number."""

    seen: State
    batch: str
    name: str
    rows: int


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def state(spark: SparkSession, path: str) -> State:
    """The last commit; version 0 when there is none."""
    folder = _path(spark, f"{path}/commits")
    files = _files(spark, path)
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    last = max((int(n) for n in names if n.isdigit()), default=0)
    if not last:
        return State(0, 0, {})
    held = json.loads(spark.read.text(f"{path}/commits/{last:012d}", wholetext=True).first().value)
    return State(last, held["rows"], held["writes"])


def _claim(spark: SparkSession, path: str, after: State) -> bool:
    """Make the next commit file, whole or not at all; false when it is there already."""
    jvm, files = spark._jvm, _files(spark, path)
    draft = _path(spark, f"{path}/drafts/{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(json.dumps({"rows": after.rows, "writes": after.writes}).encode())
    out.close()
    files.mkdirs(_path(spark, f"{path}/commits"))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    target = _path(spark, f"{path}/commits/{after.version:012d}")
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(target), options)
    except Exception as error:  # noqa: BLE001
        if "FileAlreadyExistsException" in str(error):
            return False
        if "UnsupportedFileSystemException" not in str(error):
            raise
        # a file system of the older interface only: its rename does not replace files
        return not files.exists(target) and files.rename(draft, target)
    return True


def _table(spark: SparkSession, path: str, buckets: int) -> str:
    """Name of the table over the store's folder in this session's catalog."""
    name = "store_" + hashlib.sha256(path.encode()).hexdigest()[:16]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in PRODUCTS.fields)
        place = f"{path}/rows".replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({columns}, write_name string) USING parquet PARTITIONED BY (write_name) "
            f"CLUSTERED BY (source_url) SORTED BY (source_url) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return name


def products(spark: SparkSession, path: str, at: State | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The committed rows of a state, the last one by default, bucketed by URL."""
    at = at or state(spark, path)
    name = _table(spark, path, buckets)
    for write in at.writes.values():
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (write_name = '{write}')")
    return spark.table(name).filter(F.col("write_name").isin(list(at.writes.values()))).drop("write_name")


def fresh_rows(batch: DataFrame, stored: DataFrame, order: str, buckets: int = BUCKETS) -> DataFrame:
    """The first row of each URL that is not stored; rows without a URL go.

    A URL with many rows is combined before it moves; the store, which has a URL once, is not shuffled. (An anti join would
    be moved below the repartitioning by the optimizer, an outer join stays above it.)
    """
    pick = F.min_by(F.struct(*batch.columns), F.struct(order, F.xxhash64(*batch.columns)))
    first = batch.filter("source_url IS NOT NULL").groupBy("source_url").agg(pick.alias("row"))
    known = stored.select("source_url", F.lit(True).alias("_known")).hint("merge")
    return first.repartition(buckets, "source_url").join(known, "source_url", "left").filter("_known IS NULL").select("row.*")


def stage(batch: DataFrame, path: str, batch_id: str, order: str = "pos", buckets: int = BUCKETS) -> Write:
    """Write the new rows of a batch against the last state, with ids that follow it; nothing counts yet."""
    spark = batch.sparkSession
    seen = state(spark, path)
    rows = fresh_rows(batch, products(spark, path, seen, buckets), order, buckets)
    name = uuid.uuid4().hex
    numbered = assign_ids(rows, seen.rows, (order, "source_url")).select(*PRODUCTS.names).repartition(buckets, "source_url")
    table = _table(spark, path, buckets)
    numbered.withColumn("write_name", F.lit(name)).write.insertInto(table)
    made = spark.table(table).filter(F.col("write_name") == name).count()
    return Write(seen, batch_id, name, made)


def commit(spark: SparkSession, path: str, write: Write) -> bool:
    """Let a write count, unless another one was committed since it was staged."""
    seen = write.seen
    return _claim(spark, path, State(seen.version + 1, seen.rows + write.rows, {**seen.writes, write.batch: write.name}))


def insert(batch: DataFrame, path: str, batch_id: str, order: str = "pos", buckets: int = BUCKETS) -> State:
    """Insert the first row of every new URL; the state that holds them. A batch that is there already changes nothing.

    Each lost race means that another writer's rows were committed, so writers together always go on. A batch without
    new URLs is recorded too. ``buckets`` belongs to the store and must be the same for all its writers.
    """
    spark = batch.sparkSession
    while True:
        now = state(spark, path)
        if batch_id in now.writes:
            return now
        write = stage(batch, path, batch_id, order, buckets)
        if batch_id not in write.seen.writes and commit(spark, path, write):
            return state(spark, path)
