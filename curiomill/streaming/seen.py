"""URLs seen in any run, kept beside the store instead of in the state of a query.

Every batch writes its new URLs by hash bucket and, of the same URLs, a Bloom filter in words of 64 bits: a URL belongs
to one word and sets up to four of its bits, so a probe is one equi-join with a table of about a fortieth of the size.
What the filters do not know is new; only what they may know is looked for among the URLs, and only in its buckets. A
batch counts once its commit record is there. When the words fill up, all filters are made anew with more of them; each
time the table has grown several times, so this costs a constant share of the writing.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curiomill.session import cut_lineage

BUCKETS = 256  # folders of a batch at most; a probe reads those in which a filter hit
URLS_A_WORD = 4  # 16 bits a URL: about one new URL of a hundred is looked for in vain
FULL = 2  # times URLS_A_WORD on average, then the words become GROWTH times as many
GROWTH = 16
FIRST_LEVEL = 10  # binary logarithm of the number of words at first

URLS = "url string, bucket int, batch string"
WORDS = "word long, bits long, batch string"


class SeenUrls:
    """The URLs of all runs under a shared folder. One run writes at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _committed(self) -> dict[str, tuple[int, int]]:
        """Level of the words and number of new URLs at the commit of each batch."""
        records = [name.rsplit("~", 2) for name in self._names("commits")]
        return {batch: (int(level), int(n)) for batch, level, n in records}

    def _read(self, folder: str, schema: str, leave_out: set[str]) -> DataFrame:
        """Rows of the batches in a folder but for those to leave out: the batch at work, and what was never committed."""
        if not self._fs.exists(self._at(folder)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        return rows.filter(~F.col("batch").isin(sorted(leave_out))) if leave_out else rows

    def _not_committed(self, folder: str, committed) -> set[str]:
        return {n.removeprefix("batch=") for n in self._names(folder) if n.startswith("batch=")} - set(committed)

    def urls(self) -> DataFrame:
        """(url, batch): every URL once, with the batch that brought it."""
        return self._read("urls", URLS, self._not_committed("urls", self._committed())).select("url", "batch")

    def add(self, urls: DataFrame, batch: str) -> DataFrame:
        """Take in the URLs of a batch and return the new ones (url), each once; nulls are no URLs.

        A batch that is repeated under its name is judged against all others and replaces what it wrote, so it gives
        the same rows. Batch names hold letters, digits and dashes.
        """
        committed = self._committed()
        others = {name: at for name, at in committed.items() if name != batch}
        level = max((level for level, _ in committed.values()), default=0)
        known = sum(n for _, n in others.values())
        bucket = F.pmod(F.xxhash64("url"), F.lit(BUCKETS)).cast("int")
        asked = cut_lineage(urls.filter("url IS NOT NULL").select("url").distinct().withColumn("bucket", bucket), "asked")
        fresh = asked
        if others:
            words = self._words(level, {batch} | self._not_committed(f"words/level={level}", others))
            probe = _with_mask(asked, level)
            hit = (probe["word"] == words["word"]) & (words["bits"].bitwiseAND(probe["mask"]) == probe["mask"])
            maybe = cut_lineage(probe.join(words, hit, "left_semi").select("url", "bucket"), "maybe")
            buckets = [r.bucket for r in maybe.select("bucket").distinct().collect()]  # at most BUCKETS
            if buckets:
                stored = self._read("urls", URLS, {batch} | self._not_committed("urls", others)).filter(F.col("bucket").isin(buckets))
                seen = maybe.join(stored.select("url", "bucket"), ["bucket", "url"], "left_semi").select("url")
                fresh = asked.join(seen, "url", "left_anti")
        folder = f"{self.path}/urls/batch={batch}"
        fresh.select("url", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        new = self.spark.read.schema("url string, bucket int").parquet(folder)
        self._write_words(new, batch, level, known, others)
        return new.select("url")

    def _words(self, level: int, leave_out: set[str]) -> DataFrame:
        return self._read(f"words/level={level}", WORDS, leave_out)

    def _write_words(self, new: DataFrame, batch: str, level: int, known: int, others: dict) -> None:
        """Write the filter of a batch, or of all batches with more words, and then the commit record."""
        count = new.count()
        total = known + count
        if level and total <= FULL * URLS_A_WORD * 2**level:
            _filter(new, level).write.mode("overwrite").parquet(f"{self.path}/words/level={level}/batch={batch}")
        else:
            level = max(FIRST_LEVEL, level, ceil(log2(max(GROWTH * total / URLS_A_WORD, 1))))
            before = self._read("urls", URLS, {batch} | self._not_committed("urls", others)).select("url", "batch")
            everything = before.unionByName(new.select("url", F.lit(batch).alias("batch")))
            _filter(everything, level, "batch").write.mode("overwrite").partitionBy("batch").parquet(f"{self.path}/words/level={level}")
        for name in self._names("commits"):
            if name.rsplit("~", 2)[0] == batch:
                self._fs.delete(self._at(f"commits/{name}"), False)
        self._fs.mkdirs(self._at("commits"))
        self._fs.create(self._at(f"commits/{batch}~{level}~{count}"), True).close()


def _with_mask(urls: DataFrame, level: int) -> DataFrame:
    """Add word and mask: four bits of the word, two of which may be the same."""
    drawn = urls.withColumn("word", F.shiftrightunsigned(F.xxhash64("url"), 64 - level)).withColumn("drawn", F.xxhash64("url", F.lit("bits")))
    bits = " | ".join(f"shiftleft(1L, cast(shiftrightunsigned(drawn, {6 * i}) & 63 as int))" for i in range(4))
    return drawn.withColumn("mask", F.expr(bits)).drop("drawn")


def _filter(urls: DataFrame, level: int, *by: str) -> DataFrame:
    return _with_mask(urls, level).groupBy(*by, "word").agg(F.bit_or("mask").alias("bits")).select("word", "bits", *by)


def seen_in_any_run(urls: DataFrame, path: str, checkpoint: str, run: str) -> SeenUrls:
    """Take in a stream of URLs, all that are there now; a run that is started again goes on under its name."""
    seen = SeenUrls(urls.sparkSession, path)

    def save(batch: DataFrame, batch_id: int) -> None:
        seen.add(batch, f"{run}-{batch_id}")

    urls.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return seen
