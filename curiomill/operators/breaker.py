"""The rule of the per-domain circuit breaker, and the status it leaves."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN = -1  # marks "no block"; times are microseconds since the epoch
ATTEMPT, REQUEST, RESULT = 0, 1, 2  # kinds of events; an attempt is a request and its result at one moment


def fold(ts: np.ndarray, ok: np.ndarray, count: int, until: int, threshold: int, cooldown: int):
    """Run the breaker over attempts in order of time from one state; returns per-row columns and the final state.

    Steps go from one opening to the next, not from row to row: refused rows end where the block ends, and the next
    opening is the first row whose run of failures is long enough.
    """
    n = len(ts)
    allowed = np.ones(n, dtype=bool)
    counts = np.zeros(n, dtype=np.int64)
    untils = np.full(n, OPEN, dtype=np.int64)
    place = np.arange(n)
    good = np.flatnonzero(ok)
    run = place - np.maximum.accumulate(np.where(ok, place, -1)) if n else place  # failures in a row up to each row
    long = np.flatnonzero(run >= threshold)
    i = 0
    while i < n:
        if until != OPEN:
            end = int(np.searchsorted(ts, until))
            allowed[i:end], counts[i:end], untils[i:end] = False, count, until
            i = max(i, end)
            if i == n:
                break
            count, until = 0, OPEN
        k = int(np.searchsorted(good, i))
        reset = int(good[k]) if k < len(good) else n  # up to here the rows carry the count on
        opens = i + max(threshold - count, 1) - 1
        if opens >= reset:
            k = int(np.searchsorted(long, reset))
            opens = int(long[k]) if k < len(long) else n
        end = min(opens + 1, n)
        counts[i:end] = np.where(place[i:end] < reset, count + place[i:end] - i + 1, run[i:end])
        count = int(counts[end - 1])
        if opens < n:
            until = int(ts[opens]) + cooldown
            untils[opens] = until
        i = end
    return allowed, counts, untils, count, until


def fold_events(ts: np.ndarray, kind: np.ndarray, ok: np.ndarray, count: int, until: int, threshold: int, cooldown: int):
    """The same where requests and results are events of their own.

    A request is refused while a block lasts; the first one after it begins anew with no failures. A result counts
    whenever it comes: a success clears the count but lifts no block, and a failure at or over the threshold sets the
    block's end from its own moment. The result of a refused attempt is no result.
    """
    n = len(ts)
    allowed = np.ones(n, dtype=bool)
    counts, untils = np.zeros(n, dtype=np.int64), np.full(n, OPEN, dtype=np.int64)
    for i, (t, k, good) in enumerate(zip(ts.tolist(), kind.tolist(), ok.tolist(), strict=True)):
        refused = False
        if k != RESULT and until != OPEN:
            refused = t < until
            if not refused:
                count, until = 0, OPEN
        if k != REQUEST and not refused:
            count = 0 if good else count + 1
            if count >= threshold:
                until = t + cooldown
        allowed[i], counts[i], untils[i] = not refused, count, until
    return allowed, counts, untils, count, until


def breaker_status(log: DataFrame, at) -> DataFrame:
    """Status of every domain at a moment, from the decisions of ``stream_breaker``."""
    moment = F.lit(at).cast("timestamp")
    state = F.struct("ts", "attempt_id", "failure_count", "blocked_until")
    last = log.filter(F.col("ts") <= moment).groupBy("domain").agg(F.max(state).alias("s"))
    until = F.col("s.blocked_until")
    blocked = F.coalesce(until > moment, F.lit(False))
    left = (F.unix_micros(until) - F.unix_micros(moment)) / F.lit(1_000_000.0)
    return last.select(
        "domain",
        blocked.alias("is_blocked"),
        F.col("s.failure_count").alias("failure_count"),
        until.alias("blocked_until"),
        F.when(blocked, left).alias("remaining_seconds"),
    )
