"""Connected components of links, without the driver: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.batches import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour (or itself)."""
    both = links.union(links.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.where(F.col("b") > F.col("a")).join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node with a link, roots left out.

    ``links`` has columns a and b of one orderable type. Hot nodes are aggregated before they are shuffled, and
    joined with one row each. Every round ends the lineage in the shared folder; their number grows with the
    logarithm of the longest chain.
    """
    now = stored(spark, links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    before = None
    while True:
        # The marks of a round are taken while it is written.
        watch = Observation()
        step = _small_star(_large_star(now)).observe(watch, F.count(F.lit(1)).alias("n"), mark.alias("mark"))
        now = stored(spark, step, "links")
        after = (watch.get["n"], watch.get["mark"])
        if after == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after
