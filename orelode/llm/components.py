"""Connected components over DataFrames, with lineage cut in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orelode.plans.runtime import cut


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 50) -> DataFrame:
    """``node`` and ``component`` (its least member) for every node of an undirected edge.

    Alternating large-star and small-star steps: every step only groups edges by one end with
    partial aggregation, so no neighbourhood is collected; the number of steps grows with the
    logarithm of the longest chain.  Nulls and self-loops are ignored.  Raises if ``most_rounds``
    do not reach a fixpoint, instead of returning split components.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut(small.unionByName(least.withColumnRenamed("m", "v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        mark = now
    raise RuntimeError(f"no fixpoint in {most_rounds} rounds")
