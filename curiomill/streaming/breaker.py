"""Streaming circuit breaker in the order of time.

Rows of a domain wait in buckets of time until the watermark has passed the bucket; then a timer runs the breaker over
the bucket in order. So the decisions do not depend on how rows fall into micro-batches, as long as none comes later
than the allowed delay. The state of a domain is its waiting buckets and two numbers. One bucket is held at a time,
so a domain with most of the log takes no more memory than its rows of one bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from curiomill import constants as K
from curiomill.operators.breaker import ATTEMPT, OPEN, REQUEST, RESULT, fold, fold_events
from curiomill.session import run_settings, state_partitions

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
CLOSING = 9  # kind of a row that only moves the watermark
WAITING = np.dtype([("us", "<i8"), ("kind", "u1"), ("id", "<i8"), ("ok", "u1")])
DECISION = (
    "attempt_id bigint, domain string, us bigint, kind int, success boolean, allowed boolean, failure_count bigint, until bigint"
)


class Breaker(StatefulProcessor):
    """Waiting rows by bucket, and the failure count and end of the block of one domain."""

    def __init__(self, threshold: int, cooldown: int, bucket_ms: int) -> None:
        self.threshold, self.cooldown, self.bucket_ms = threshold, cooldown, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "count bigint, until bigint")
        self.waiting = handle.getMapState("waiting", "bucket bigint", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            batch = batch[batch["kind"] != CLOSING]
            packed = np.zeros(len(batch), WAITING)
            packed["us"], packed["kind"], packed["id"], packed["ok"] = (batch[c].to_numpy() for c in ("us", "kind", "attempt_id", "success"))
            bucket = packed["us"] // (1000 * self.bucket_ms)
            for b in np.unique(bucket).tolist():
                held = bytes(self.waiting.getValue((b,))[0]) if self.waiting.containsKey((b,)) else b""
                self.waiting.updateValue((b,), (held + packed[bucket == b].tobytes(),))
                if not held:
                    self.handle.registerTimer(max((b + 1) * self.bucket_ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() // self.bucket_ms
        ready = sorted(b for (b,) in self.waiting.keys() if b < passed)
        if not ready:
            return
        count, until = self.state.get() if self.state.exists() else (0, OPEN)
        for b in ready:
            rows = np.frombuffer(bytes(self.waiting.getValue((b,))[0]), WAITING)
            rows = rows[np.lexsort((rows["id"], rows["kind"], rows["us"]))]
            self.waiting.removeKey((b,))
            ok = rows["ok"].astype(bool)
            if (rows["kind"] == ATTEMPT).all():
                allowed, counts, untils, count, until = fold(rows["us"], ok, count, until, self.threshold, self.cooldown)
            else:
                allowed, counts, untils, count, until = fold_events(rows["us"], rows["kind"], ok, count, until, self.threshold, self.cooldown)
            yield pd.DataFrame({
                "attempt_id": rows["id"], "domain": key[0], "us": rows["us"], "kind": rows["kind"].astype(np.int32), "success": ok,
                "allowed": allowed, "failure_count": counts, "until": untils,
            })
        self.state.update((int(count), int(until)))

    def close(self) -> None:
        pass


def closing_row(log: DataFrame, delay_seconds: int) -> DataFrame:
    """A row to be sent after a log that has ended, so that its last rows are decided too."""
    last = log.agg((F.unix_seconds(F.max(F.col("ts").cast("timestamp"))) + 3 * delay_seconds + 1).alias("s"))
    made = last.filter("s IS NOT NULL").select(
        F.timestamp_seconds("s").alias("ts"), F.lit("").alias("domain"), F.lit(0).cast("bigint").alias("attempt_id"),
        F.lit(True).alias("success"), F.lit(CLOSING).alias("kind"),
    )
    return made


def as_events(attempts: DataFrame) -> DataFrame:
    """Attempts (attempt_id, domain, ts, success) as events of one kind."""
    return attempts.select("attempt_id", "domain", F.col("ts").cast("timestamp").alias("ts"), "success", F.lit(ATTEMPT).alias("kind"))


def requests_and_results(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Requests (attempt_id, domain, ts) and results (attempt_id, domain, ts, success) as events of two kinds."""
    asked = requests.select("attempt_id", "domain", F.col("ts").cast("timestamp").alias("ts"), F.lit(True).alias("success"), F.lit(REQUEST).alias("kind"))
    got = results.select("attempt_id", "domain", F.col("ts").cast("timestamp").alias("ts"), "success", F.lit(RESULT).alias("kind"))
    return asked.unionByName(got)


def stream_breaker(
    events: DataFrame,
    threshold: int = K.BREAKER_THRESHOLD,
    cooldown_seconds: int = K.BREAKER_COOLDOWN_SECONDS,
    delay_seconds: int = 600,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Allowed-or-blocked decision for each event of ``as_events`` or ``requests_and_results``, in order of (ts, kind,
    attempt_id) within its domain.

    Rows may come out of order by up to ``delay_seconds``; Spark drops later ones, which get no decision. A decision is
    given when the watermark has passed the row's bucket. Null success is a failure, a null domain is one of its own,
    rows without a moment are left out. The query needs the settings ``ROCKSDB`` (see ``run_breaker``).
    """
    bucket_ms = 1000 * (bucket_seconds or max(1, delay_seconds // 4))
    log = events.filter("ts IS NOT NULL").withWatermark("ts", f"{delay_seconds} seconds").select(
        "attempt_id", "domain", "ts", F.unix_micros("ts").alias("us"), F.coalesce("success", F.lit(False)).alias("success"), F.col("kind").cast("int").alias("kind")
    )
    stepped = log.groupBy("domain").transformWithStateInPandas(
        Breaker(threshold, cooldown_seconds * 1_000_000, bucket_ms), DECISION, "Append", "EventTime"
    )
    return stepped.select(
        "attempt_id", "domain", F.timestamp_micros("us").alias("ts"), "kind", "success", "allowed", "failure_count",
        F.when(F.col("until") != OPEN, F.timestamp_micros("until")).alias("blocked_until"),
    )


def run_breaker(decisions: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Write the decisions of all events that are there, and read them.

    The state has as many partitions as there are cores, if that is fewer than shuffles have: each costs every trigger a
    store, a Python worker and a checkpoint, however few domains it has.
    """
    spark = decisions.sparkSession
    with run_settings(spark, ROCKSDB | {"spark.sql.shuffle.partitions": str(state_partitions(spark))}):
        query = decisions.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(decisions.schema).parquet(path)
