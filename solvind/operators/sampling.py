"""Repeatable sample of an exact size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Four hex digits: at most 65,536 counted prefixes, whatever the table size.
PREFIX = 4


def hash_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 1) -> DataFrame:
    """The `n` rows (or all, if fewer) whose seeded key digest comes first; the same on every engine.

    A histogram of digest prefixes finds the shortest range that covers n rows, so the final top-n merges
    about n rows instead of n per partition. The range always covers n rows: the result is exact.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(key).cast("string") for key in keys)))
    hashed = df.withColumn("_digest", digest)
    prefix = F.substring("_digest", 1, PREFIX)
    histogram = hashed.groupBy(prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("_rows"))
    running = F.sum("_rows").over(Window.orderBy("_prefix"))
    covering = histogram.withColumn("_seen", running).filter(F.col("_seen") >= n)
    last_prefix = covering.agg(F.min("_prefix")).scalar()
    candidates = hashed.filter(prefix <= F.coalesce(last_prefix, F.lit("g")))
    return candidates.orderBy("_digest", *keys).limit(n).drop("_digest")
