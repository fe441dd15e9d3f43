"""Connected components of a graph whose links are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, settle

#: Rounds after which components() gives up; their number grows with the logarithm of the longest path.
MAX_ROUNDS = 60


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), two long columns; root is the smallest node reachable.

    Alternates two steps until nothing changes: each node links its larger neighbours to the
    smallest node around it, then itself and its smaller neighbours to the smallest. Both steps are
    a grouping and an equality join; no neighbourhood is ever gathered in a task or on the driver.
    Nodes without a link, and links of a node to itself, give no row. Repeated links do no harm.
    """
    ordered = links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a <> b")
    now = settle(ordered.distinct(), "links")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # settled, so that a join of a node with very many links can be split
        least = settle(both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "links")
        large = both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large, "links")
        low = settle(large.groupBy("a").agg(F.min("b").alias("m")), "links")
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
        after = settle(small.select("x.a", "x.b").filter("a <> b").distinct(), "links")
        for done in (now, least, large, low):
            forget(done)
        now, before, state = after, state, _state(after)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
    raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
