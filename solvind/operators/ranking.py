"""Best and worst rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
BEST_LABEL = "Top 10 Mejores"
WORST_LABEL = "Top 10 Peores"
LABELLED_DAYS = 10


def best_first(score: str, tie: str) -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col(tie).asc_nulls_last()]


def worst_first(score: str, tie: str) -> list[Column]:
    """The exact reverse of `best_first`, so the two ranks of a row add up to group size + 1."""
    return [F.col(score).asc_nulls_first(), F.col(tie).desc_nulls_first()]


def rank_both_ways(df: DataFrame, keys: Sequence[str], score: str, tie: str) -> DataFrame:
    """Add rank_mejor and rank_peor with one shuffle. Sorts a whole group in one task: for groups with a
    natural bound only (days of one site); `top_bottom_n` handles unbounded groups."""
    group = Window.partitionBy(*keys)
    return df.withColumns(
        {
            "rank_mejor": F.row_number().over(group.orderBy(*best_first(score, tie))),
            "rank_peor": F.row_number().over(group.orderBy(*worst_first(score, tie))),
        }
    )


def day_label(n: int = LABELLED_DAYS) -> Column:
    """The best label wins for rows in both lists."""
    return F.when(F.col("rank_mejor") <= n, F.lit(BEST_LABEL)).when(F.col("rank_peor") <= n, F.lit(WORST_LABEL))


def top_bottom_n(df: DataFrame, keys: Sequence[str], score: str, tie: str, n: int) -> DataFrame:
    """The n best and n worst rows per group with both ranks, for groups of any size.

    `tie` must be unique within a group. Each one-sided rank filter becomes a group limit below the
    shuffle, so a hot group leaves each map task as n rows; the opposite rank follows from the group
    size, which is a partial aggregate.
    """
    keys = list(keys)
    group = Window.partitionBy(*keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))

    def one_side(rank: str, opposite: str, order: list[Column]) -> DataFrame:
        ranked = df.withColumn(rank, F.row_number().over(group.orderBy(*order))).filter(F.col(rank) <= n)
        same_group = [F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}")) for key in keys]
        joined = ranked.alias("r").join(sizes.alias("s"), same_group, "inner")
        return joined.select("r.*", F.col("_size")).withColumn(
            opposite, (F.col("_size") + 1 - F.col(rank)).cast("int")
        )

    best = one_side("rank_mejor", "rank_peor", best_first(score, tie))
    worst = one_side("rank_peor", "rank_mejor", worst_first(score, tie)).filter(F.col("rank_mejor") > n)
    return best.unionByName(worst).drop("_size")
