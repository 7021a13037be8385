"""Pagination as reachability over the next-page table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.session import cut_lineage


def follow_pagination(next_pages: DataFrame, seeds: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Pages that the seeds reach: page_url, owner (first seed in order that reaches it) and page_no from 1.

    ``next_pages`` has page_url and next_url, at most one per page; ``seeds`` has pos and base_url. Only pages that
    are in the snapshot count. The hop is doubled every round, so a chain of n pages takes about log2(n) rounds.
    """
    nexts = cut_lineage(next_pages.select("page_url", "next_url"))
    known = nexts.select("page_url").distinct()
    starts = seeds.groupBy(F.col("base_url").alias("page_url")).agg(F.min("pos").alias("owner"))
    reached = cut_lineage(
        starts.join(known, "page_url", "left_semi").select(
            "page_url", F.struct("owner", F.lit(1).cast("bigint").alias("page_no")).alias("at")
        )
    )
    jump = cut_lineage(
        nexts.filter("next_url IS NOT NULL")
        .join(known.withColumnRenamed("page_url", "next_url"), "next_url", "left_semi")
        .select("page_url", "next_url")
    )
    size, done = 1, False
    for _ in range(max_rounds):
        moved = reached.join(jump, "page_url").select(
            F.col("next_url").alias("page_url"),
            F.struct(F.col("at.owner").alias("owner"), (F.col("at.page_no") + size).alias("page_no")).alias("at"),
        )
        merged = cut_lineage(reached.unionByName(moved).groupBy("page_url").agg(F.min("at").alias("at")))
        changed = merged.join(reached, ["page_url", "at"], "left_anti")
        done = changed.isEmpty()
        reached = merged
        if done:
            break
        hop = jump.select(F.col("page_url").alias("next_url"), F.col("next_url").alias("far"))
        jump = cut_lineage(jump.join(hop, "next_url").select("page_url", F.col("far").alias("next_url")))
        size *= 2
    if not done:
        raise RuntimeError("pagination chains are longer than the rounds allow")
    return reached.select("page_url", F.col("at.owner").alias("owner"), F.col("at.page_no").alias("page_no"))
