"""Reading tables, storing intermediate ones, and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from solvind.workspace import fresh_path

#: Words of the contracts: runs of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """`frame` written as Parquet into the shared folder and read again.

    Cuts the lineage: a lost executor costs a reread, not a recomputation. It also gives Spark the true
    size, so that a join broadcasts the table only below `spark.sql.autoBroadcastJoinThreshold`.
    """
    path = fresh_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus`: the folds of the contracts."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


def partitions_for(rows: int, per_task: int, least: int = 1) -> int:
    return max(least, -(-rows // per_task))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b long): component is the smallest node reachable.

    Alternating large-star and small-star steps. Each round is a grouped minimum and a join, written to the
    shared folder; the number of rounds grows with the logarithm of the longest path. A star's centre may
    have any number of neighbours: only minima are gathered, never lists.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if _settled(edges):
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # Large star: neighbours above a node move to the smallest node near it.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b")))
        # Small star: neighbours below a node, and the node, move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Every node has one edge and leads to a node that has none: the edges are stars around the components' smallest nodes."""
    below = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    ends = edges.select(F.col("b").alias("a")).distinct().withColumn("end", F.lit(True))
    return below.join(ends, "a", "left").where("n > 1 or end").isEmpty()
