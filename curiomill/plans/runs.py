"""A run over product pages that can be stopped at any moment and taken up again.

Pages are worked on in steps. A step writes its outcomes and its products to folders of its own and then one commit
record; only what has a record counts. Opening a run takes away what a stopped step left, pages with an outcome are
skipped, and the step is done anew.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curiomill import constants as K
from curiomill.operators.extraction import Extractor
from curiomill.plans.batch import process_pages
from curiomill.schemas import RECORD
from curiomill.session import cut_lineage
from curiomill.sources.store import assign_ids, insert_products, stored_products

PAGES_A_FILE = 2_000

OUTCOMES = T.StructType([
    T.StructField("pos", T.LongType()), T.StructField("url", T.StringType()), T.StructField("skip_reason", T.StringType()),
    T.StructField("failure_type", T.StringType()), T.StructField("error", T.StringType()), *RECORD.fields,
    T.StructField("confidence", T.DoubleType()), T.StructField("step", T.LongType()),
])


class Run:
    """State of a run in a shared folder: outcomes, store and commit records."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.store = f"{self.path}/store"
        made = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = made.getFileSystem(spark._jsc.hadoopConfiguration())
        self._roll_back()

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _numbers(self, folder: str) -> list[int]:
        """Numbers of the steps that a folder has an entry of; one entry a step."""
        at = self._at(folder)
        if not self._fs.exists(at):
            return []
        names = [s.getPath().getName().removesuffix(".json").rpartition("=")[2] for s in self._fs.listStatus(at)]
        return sorted(int(n) for n in names if n.isdigit())

    def committed(self) -> list[int]:
        return self._numbers("commits")

    def _roll_back(self) -> None:
        done = set(self.committed())
        for folder, name in (("outcomes", "step"), ("store", "batch")):
            for step in self._numbers(folder):
                if step not in done:
                    self._fs.delete(self._at(f"{folder}/{name}={step}"), True)

    def clear(self) -> None:
        """Forget the run: the next one begins anew."""
        for folder in ("commits", "outcomes", "store"):  # without records nothing else counts
            self._fs.delete(self._at(folder), True)

    def outcomes(self) -> DataFrame:
        """All pages that have been worked on, with what became of them."""
        if not self.committed():
            return self.spark.createDataFrame([], OUTCOMES)
        return self.spark.read.schema(OUTCOMES).parquet(f"{self.path}/outcomes")

    def unprocessed(self, pages: DataFrame) -> DataFrame:
        """Pages whose URL has no outcome."""
        return pages.join(self.outcomes().select("url"), "url", "left_anti").select(*pages.columns)

    def rows(self) -> int:
        return stored_products(self.spark, self.store).count()

    def report(self) -> DataFrame:
        """(outcome, urls): stored products, failures by class and skips by reason."""
        failed = self.outcomes().filter("skip_reason IS NOT NULL OR failure_type IS NOT NULL")
        counts = failed.groupBy(F.coalesce("skip_reason", "failure_type").alias("outcome")).agg(F.count("*").alias("urls"))
        stored = stored_products(self.spark, self.store).agg(F.count("*").alias("urls")).select(F.lit("stored").alias("outcome"), "urls")
        return counts.unionByName(stored)

    def do_step(self, step: int, pages: DataFrame, target_rows: int | None, extractor: Extractor | None) -> None:
        """Outcomes and products of a step, each in a folder that a repetition replaces."""
        folder = f"{self.path}/outcomes/step={step}"
        process_pages(pages, None, extractor).write.mode("overwrite").parquet(folder)
        made = self.spark.read.schema(T.StructType(OUTCOMES.fields[:-1])).parquet(folder)
        good = made.filter("skip_reason IS NULL AND failure_type IS NULL").select(
            "pos", F.col("url").alias("source_url"), F.col("confidence").alias("extraction_confidence"), *RECORD.names,
            F.timestamp_seconds(F.lit(step)).alias("scrape_timestamp"),
        )
        insert_products(good, self.store, step, "pos", target_rows)

    def commit(self, step: int, pages: int) -> None:
        """The record that makes a step count: written under another name and renamed, so it is there or not."""
        self._fs.mkdirs(self._at("commits"))
        draft, record = self._at(f"draft-{step}.json"), self._at(f"commits/step={step}.json")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps({"step": step, "pages": pages, "at": time.time()}).encode()))
        out.close()
        if not self._fs.rename(draft, record):
            raise RuntimeError(f"step {step} was committed by another run")


def run_in_steps(
    run: Run, pages: DataFrame, every: int = K.CHECKPOINT_ROWS, target_rows: int | None = None, most_steps: int | None = None, extractor: Extractor | None = None,
) -> int:
    """Work on all pages (pos, url, html, status) without an outcome, ``every`` pages a step in the order of ``pos``,
    until the store has ``target_rows`` rows or ``most_steps`` steps were done. Returns the rows in the store.

    Rows that share a URL are one page: that of the smallest ``pos``. Pages are numbered without a sort in one task and
    written once by step, so each step reads its own pages only; a long step has many files, so as many tasks work on it.
    """
    spark = run.spark
    left = run.unprocessed(pages).select("pos", "url", "html", "status")
    first = left.groupBy("url").agg(F.min("pos").alias("pos"))
    once = left.join(first, ["url", "pos"]).dropDuplicates(["url"])
    start = max(run.committed(), default=-1) + 1
    numbered = assign_ids(once, 0, ("pos", "url")).withColumn("step", F.floor((F.col("id") - 1) / F.lit(every)) + start)
    staged = f"{run.path}/staged-{start}-{time.time_ns()}"
    most = numbered.agg(F.max("id")).first()[0] or 0
    files = max(1, -(-most // PAGES_A_FILE))
    numbered.repartitionByRange(files, "id").write.partitionBy("step").parquet(staged)
    by_step = spark.read.schema(numbered.schema).parquet(staged)
    sizes = sorted((r.step, r.n) for r in by_step.groupBy("step").agg(F.count("*").alias("n")).collect())  # one row a step
    for step, n in sizes[:most_steps]:
        if target_rows is not None and run.rows() >= target_rows:
            break
        run.do_step(step, by_step.filter(F.col("step") == step).select("pos", "url", "html", "status"), target_rows, extractor)
        run.commit(step, n)
    run._fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staged), True)
    return run.rows()
