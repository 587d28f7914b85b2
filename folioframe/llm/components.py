"""Connected components of an edge table, with neither edges nor labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, stored

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) for every node of an edge, from ``edges`` of longs.

    Alternates large-star and small-star steps until the edges are stars: a number of rounds that
    grows with the logarithm of the longest path.  Each round is stored, so a lost executor costs a
    round at most.  A hub's edges meet one row of their minimum.  The minima are dealt anew before
    that, so that both sides of the join are plain exchanges, whose skewed partitions Spark splits.
    """
    spread = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    now = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        # Large star: every larger neighbour of u points at the smallest node around u.
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).repartition(spread)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: u and its smaller neighbours point at the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m")).repartition(spread)
        linked = large.join(least, "u")
        step = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(linked.select("u", F.col("m").alias("v")))
        new = stored(step.where("u <> v").distinct(), "edges")
        drop_path(now.sparkSession, now._scratch)
        now = new
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark:
            break
        mark = found
    else:
        raise RuntimeError("the components did not settle")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
