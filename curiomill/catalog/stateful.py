"""Queries for stateful and streaming operators (T1-T4, T6, T8-T10), each run over all input that is there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill import constants as K
from curiomill.catalog import sqlparts as Q
from curiomill.catalog.derive import table
from curiomill.catalog.links import CANON, QUEUE, TAG
from curiomill.catalog.outcomes import OUTCOMES
from curiomill.catalog.registry import query
from curiomill.operators.breaker import breaker_status
from curiomill.operators.chunks import mark_halted
from curiomill.plans.runs import Run, run_in_steps
from curiomill.session import new_folder
from curiomill.sources.store import stored_products
from curiomill.streaming import flow
from curiomill.streaming.breaker import as_events, closing_row, requests_and_results, run_breaker, stream_breaker
from curiomill.streaming.seen import seen_in_any_run

_LIMIT, _WAIT = 3, 20_000  # failures in a row, seconds blocked: in the derived log failures are rarer than on a bad site
_DELAY = 86_400  # seconds that a row of the log may come late
FILE_ROWS = 100_000


def _stream(spark, df: DataFrame, name: str, files: int = 4, files_a_trigger: int | None = None) -> DataFrame:
    """The rows as a stream of several files."""
    path = new_folder(spark, name)
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_a_trigger or files).parquet(path)


def _results(spark, df: DataFrame, name: str) -> DataFrame:
    path, marks = new_folder(spark, name), new_folder(spark, "checkpoint")
    flow.write_stream(df, path, marks).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _in_time(spark, events: DataFrame, name: str, files_a_trigger: int) -> DataFrame:
    """Events as a stream of files that arrive roughly in order: the rows of a day are mixed, and a row that only moves
    the watermark comes last. The log is cut by time into files of at most about FILE_ROWS rows, 8 at least."""
    roughly = F.unix_seconds("ts") + F.pmod(F.xxhash64("attempt_id", "kind"), F.lit(_DELAY - 3600))
    files = max(8, -(-events.count() // FILE_ROWS))
    return _one_after_another(spark, events.withColumn("rough", roughly), name, files, files_a_trigger, closing_row(events, _DELAY))


def _one_after_another(spark, rows: DataFrame, name: str, files: int, files_a_trigger: int, closing: DataFrame | None = None) -> DataFrame:
    """Rows as a stream of files that arrive in the order of the column ``rough``."""
    path = new_folder(spark, name)
    plain = rows.drop("rough")
    parts = new_folder(spark, "log")  # a folder for each part, so that a part is read without a look at the others
    rows.repartitionByRange(files, "rough").withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(parts)
    cut = spark.read.schema(rows.withColumn("part", F.lit(0)).schema).parquet(parts)
    for part in range(files):  # one write each: files are read in order of their time
        cut.filter(F.col("part") == part).select(*plain.columns).repartition(1).write.mode("append").parquet(path)
    if closing is not None:
        closing.select(*plain.columns).write.mode("append").parquet(path)
    return spark.readStream.schema(plain.schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def _decided(spark, events: DataFrame, name: str, files_a_trigger: int) -> DataFrame:
    stream = stream_breaker(_in_time(spark, events, name, files_a_trigger), _LIMIT, _WAIT, _DELAY)
    return run_breaker(stream, new_folder(spark, "decisions"), new_folder(spark, "checkpoint"))


def _decisions(spark, sf, files_a_trigger: int) -> DataFrame:
    log = table(spark, sf, "attempts").select("attempt_id", "domain", "ts", "success")
    return _decided(spark, as_events(log), "attempts", files_a_trigger)


# the fold as a recursive query: one row per attempt, in order of each domain
_BREAKER = f""", log AS (SELECT attempt_id, domain, epoch_us(CAST(ts AS TIMESTAMP)) AS us, success, row_number() OVER (PARTITION BY domain ORDER BY ts, attempt_id) AS rn FROM attempts),
fold AS (SELECT attempt_id, domain, us, rn, success, true AS allowed, CAST(CASE WHEN success THEN 0 ELSE 1 END AS BIGINT) AS failures,
  CAST(CASE WHEN NOT success AND {_LIMIT} <= 1 THEN us + {_WAIT}000000 END AS BIGINT) AS until FROM log WHERE rn = 1
 UNION ALL
 SELECT attempt_id, domain, us, rn, success, allowed, CAST(CASE WHEN NOT allowed THEN before WHEN success THEN 0 ELSE started + 1 END AS BIGINT),
  CAST(CASE WHEN NOT allowed THEN blocked WHEN NOT success AND started + 1 >= {_LIMIT} THEN us + {_WAIT}000000 END AS BIGINT)
 FROM (SELECT l.attempt_id, l.domain, l.us, l.rn, l.success, NOT coalesce(l.us < f.until, false) AS allowed, f.failures AS before,
   CASE WHEN f.until IS NOT NULL THEN 0 ELSE f.failures END AS started, f.until AS blocked FROM fold f JOIN log l ON l.domain = f.domain AND l.rn = f.rn + 1))"""


@query("T1_breaker", ("attempts",), f"{_BREAKER} SELECT attempt_id, allowed, failures AS failure_count, until AS blocked_until_us FROM fold")
def t1(spark, sf):
    made = _decisions(spark, sf, 2)
    return made.select("attempt_id", "allowed", "failure_count", F.unix_micros("blocked_until").alias("blocked_until_us"))


@query(
    "T2_breaker_status",
    ("attempts",),
    f"""{_BREAKER}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY rn DESC) AS k FROM fold) WHERE k = 1), moment AS (SELECT max(us) AS now FROM log)
SELECT domain, coalesce(until > now, false) AS is_blocked, failures AS failure_count, CASE WHEN until > now THEN (until - now) / 1000000.0::DOUBLE END AS remaining_seconds FROM last, moment""",
)
def t2(spark, sf):
    made = _decisions(spark, sf, 1)
    now = made.agg(F.max("ts")).first()[0]
    return breaker_status(made, now).select("domain", "is_blocked", "failure_count", "remaining_seconds")


@query("T3_allowed_per_domain", ("attempts",), f"{_BREAKER} SELECT domain, count(*) FILTER (WHERE allowed) AS allowed, count(*) FILTER (WHERE NOT allowed) AS refused FROM fold GROUP BY domain")
def t3(spark, sf):
    return _decisions(spark, sf, 7).groupBy("domain").agg(F.count_if("allowed").alias("allowed"), F.count_if(~F.col("allowed")).alias("refused"))


# requests and results as rows of their own: a result comes some seconds after its request
_RECORDED = f""", log AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY us, kind, attempt_id) AS rn FROM (
  SELECT attempt_id, domain, epoch_us(CAST(ts AS TIMESTAMP)) AS us, 1 AS kind, true AS success FROM attempts
  UNION ALL SELECT attempt_id, domain, epoch_us(CAST(ts AS TIMESTAMP)) + attempt * 1700000000, 2, success FROM attempts)),
fold AS (SELECT attempt_id, domain, us, kind, rn, true AS allowed, CAST(CASE WHEN kind = 1 OR success THEN 0 ELSE 1 END AS BIGINT) AS failures, CAST(NULL AS BIGINT) AS until FROM log WHERE rn = 1
 UNION ALL
 SELECT attempt_id, domain, us, kind, rn, allowed, CASE WHEN kind = 1 THEN started WHEN success THEN 0 ELSE started + 1 END,
  CASE WHEN kind = 2 AND NOT success AND started + 1 >= {_LIMIT} THEN us + {_WAIT}000000 ELSE held END
 FROM (SELECT l.*, NOT (l.kind = 1 AND coalesce(l.us < f.until, false)) AS allowed, CASE WHEN l.kind = 1 AND l.us >= f.until THEN 0 ELSE f.failures END AS started,
   CASE WHEN l.kind = 1 AND l.us >= f.until THEN NULL ELSE f.until END AS held FROM fold f JOIN log l ON l.domain = f.domain AND l.rn = f.rn + 1))"""


@query("T3_requests_and_results", ("attempts",), f"{_RECORDED} SELECT attempt_id, allowed, failures AS failure_count, until AS blocked_until_us FROM fold WHERE kind = 1")
def t3_recorded(spark, sf):
    """Decisions where results are recorded apart from the requests, some seconds later."""
    log = table(spark, sf, "attempts")
    later = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("attempt") * 1_700_000_000)
    events = requests_and_results(log, log.withColumn("ts", later))
    made = _decided(spark, events, "requests", 3).filter(F.col("kind") == 1)
    return made.select("attempt_id", "allowed", "failure_count", F.unix_micros("blocked_until").alias("blocked_until_us"))


@query(
    "T4_run_wide_halt",
    ("attempts",),
    f""", log AS (SELECT domain, attempt_id, ts, success, sum(CAST(success AS INT)) OVER (PARTITION BY domain ORDER BY ts, attempt_id) AS island FROM attempts),
streak AS (SELECT *, sum(CAST(NOT success AS INT)) OVER (PARTITION BY domain, island ORDER BY ts, attempt_id) AS run FROM log),
halts AS (SELECT domain, ts AS halt_ts, attempt_id AS halt_id FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ts, attempt_id) AS k FROM streak WHERE run >= {_LIMIT} AND NOT success) WHERE k = 1)
SELECT attempt_id, coalesce((ts, attempt_id) <= (halt_ts, halt_id), true) AS processed FROM attempts LEFT JOIN halts USING (domain)""",
)
def t4(spark, sf):
    log = table(spark, sf, "attempts").select("attempt_id", "domain", "ts", "success")
    return mark_halted(log, "domain", F.struct("ts", "attempt_id"), "success", _LIMIT).select("attempt_id", "processed")


@query("T6_seen_once", ("attempts",), "SELECT DISTINCT url FROM attempts")
def t6(spark, sf):
    urls = _stream(spark, table(spark, sf, "attempts").select("url"), "urls")
    return _results(spark, flow.seen_once(urls), "seen")


@query("T6_seen_across_runs", ("attempts",), "SELECT url, min(attempt_id % 2) + 1 AS run FROM attempts GROUP BY url")
def t6_runs(spark, sf):
    """Two runs over one folder, each in several batches: a URL belongs to the first run that meets it."""
    attempts = table(spark, sf, "attempts").select("url", "attempt_id")
    path = new_folder(spark, "seen")
    for run in (1, 2):
        urls = _stream(spark, attempts.filter(F.col("attempt_id") % 2 == run - 1).select("url"), f"urls-{run}", 4, 2)
        seen = seen_in_any_run(urls, path, new_folder(spark, "checkpoint"), str(run))
    return seen.urls().select("url", F.substring_index("batch", "-", 1).cast("long").alias("run"))


def _pages(spark, sf) -> DataFrame:
    return table(spark, sf, "product_pages")


# the tests of the URL are made on the queued one, those of the page on the page
_STORED = f"""{QUEUE}{OUTCOMES}, items AS (SELECT DISTINCT u AS item, {TAG.format(u='u')} AS url FROM canon)
SELECT o.url AS source_url FROM once o JOIN items i ON i.url = o.url JOIN judged e ON {CANON.format(u='e.url')} = i.item
WHERE ({Q.site('o.url')} = '' OR {Q.site('o.page_url')} = {Q.site('o.url')}) AND {Q.any_of('o.url', K.PRODUCT_HINTS)} AND NOT {Q.any_of('lower(o.url)', K.JUNK_PATHS)}
 AND e.page_reason IS NULL AND e.fault IS NULL"""
_BEGIN = 1_700_000_000


def _fetched(pages: DataFrame, minutes) -> DataFrame:
    """Pages fetched one a minute, some later; they come mixed within half an hour."""
    second = F.lit(_BEGIN) + 60 * (F.col("pos") + minutes)
    return pages.withColumn("fetched_at", F.timestamp_seconds(second)).withColumn("rough", second + F.pmod(F.xxhash64("url"), F.lit(1800)))


def _all_in_one(spark, rows: DataFrame, name: str, files: int) -> DataFrame:
    """Rows as a stream whose files, ``files`` or as many as hold FILE_ROWS rows each, come in one trigger. Their order does
    not count then, so tasks write them side by side."""
    path, plain = new_folder(spark, name), rows.drop("rough")
    files = max(files, -(-rows.count() // FILE_ROWS))
    plain.repartition(files, "pos", "url").write.parquet(path)
    return spark.readStream.schema(plain.schema).parquet(path)


def _listing_flow(spark, sf, listing_files: int, page_files: int, a_trigger: int) -> DataFrame:
    store = new_folder(spark, "store")
    listings = _fetched(table(spark, sf, "listing_pages"), F.lit(0))
    pages = _fetched(_pages(spark, sf), F.col("pos") % 20)
    def stream(rows: DataFrame, name: str, files: int) -> DataFrame:
        return _all_in_one(spark, rows, name, files) if files <= a_trigger else _one_after_another(spark, rows, name, files, a_trigger)

    flow.run_listing_flow(stream(listings, "listings", listing_files), stream(pages, "pages", page_files), store, new_folder(spark, "checkpoint"))
    return stored_products(spark, store).select("source_url")


@query("T10_product_flow", ("product_pages", "listing_pages"), _STORED)
def t10(spark, sf):
    """From listing pages to the store, in three triggers."""
    return _listing_flow(spark, sf, 6, 6, 2)


@query("T10_product_flow_at_once", ("product_pages", "listing_pages"), _STORED)
def t10_once(spark, sf):
    """The same with all files in one trigger."""
    return _listing_flow(spark, sf, 3, 2, 3)


@query(
    "T9_resume",
    ("product_pages",),
    f"{OUTCOMES} SELECT coalesce(skip_reason, failure_type, 'stored') AS outcome, count(*) AS urls FROM ends GROUP BY outcome",
)
def t9(spark, sf):
    """A run in four steps that is stopped after the first, taken up by another one, and offered all pages again."""
    pages = _pages(spark, sf)
    every = -(-pages.count() // 4)
    path = new_folder(spark, "run")
    run_in_steps(Run(spark, path), pages, every, most_steps=1)
    for _ in range(2):
        run = Run(spark, path)
        run_in_steps(run, pages, every)
    return run.report()


@query(
    "T8_stop_at_target",
    ("product_pages",),
    f"{OUTCOMES} SELECT url AS source_url FROM (SELECT url, row_number() OVER (ORDER BY pos) AS rn FROM ends WHERE skip_reason IS NULL AND failure_type IS NULL) WHERE rn <= 50",
)
def t8(spark, sf):
    """Pages come in order; the flow ends when the store has 50 rows."""
    pages = _pages(spark, sf)
    store, marks = new_folder(spark, "store"), new_folder(spark, "checkpoint")
    flow.run_flow(_one_after_another(spark, pages.withColumn("rough", F.col("pos")), "pages", 4, 1), store, marks, 50)
    return stored_products(spark, store).select("source_url")
