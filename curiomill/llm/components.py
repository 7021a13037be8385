"""Connected components of an edge table, as rounds of joins.

Every node points to a smaller node of its component. A round replaces pointers by pointers of pointers and hooks the
target of a node to the smallest target among its neighbours, so chains halve and the number of rounds grows with the
logarithm of the longest path. Minima are combined before each shuffle; hot nodes only meet in joins, which adaptive
execution splits. The state of each round is a table in the shared folder; only one sum goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curiomill.llm.tables import kept


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): component is the smallest node reachable."""
    both = kept(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .filter("a <> b").distinct(), "edges",
    )
    state = kept(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("to")), "components")
    before = None
    while True:
        after = state.agg(F.sum(F.col("to").cast("decimal(38,0)"))).first()[0]
        if after is None or after == before:
            return state.select("node", F.col("to").alias("component"))
        before = after
        target = state.select(F.col("node").alias("to"), F.col("to").alias("far"))
        two = state.join(target, "to").select("node", "to", "far")
        near = both.join(two.select(F.col("node").alias("b"), "far"), "b").groupBy("a").agg(F.min("far").alias("best"))
        hooked = two.join(near.withColumnRenamed("a", "node"), "node")
        new = hooked.select(
            F.explode(F.array(
                F.struct("node", F.least("far", "best").alias("to")),
                F.struct(F.col("to").alias("node"), F.col("best").alias("to")),
            )).alias("x")
        )
        state = kept(new.groupBy(F.col("x.node").alias("node")).agg(F.min("x.to").alias("to")), "components")
