"""Connected components of a graph by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqflow.session import scratch_path


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the links (a, b); ``root`` is the smallest node reached.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs
    one round.  The smallest neighbour of each node comes from a partial aggregate; the join that
    carries it back may split a hub over tasks (AQE skew join).  Rounds grow with the logarithm of
    the largest component.
    """
    spark = edges.sparkSession
    now = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while (mark := _mark(now)) != seen:
        seen = mark
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        now = _written(_star(both, larger=True))
        now = _written(_star(now, larger=False))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links of each node's neighbours (the larger ones, or all of the smaller) to its smallest neighbour."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = links.join(least, "a")
    if larger:
        return near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    to_least = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return to_least.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "links")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]
