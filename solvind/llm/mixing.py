"""Mixing sources to target weights: entropy balancing in its dual, then rounding into whole copies. No Python code runs on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from solvind.llm.common import WORD, stored

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5  # of all sizes
MOST = 2.0  # times that a document, and so a source, can be taken
NEWTON_STEPS, TOLERANCE = 60, 1e-9
CLOSING_STEPS = 4  # the same at every size


def mixture_targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST
) -> DataFrame:
    """`sources` (source, source_size) with `target`: by weight, but at most `most` times the source's size.

    Weights go round the sources in code point order, null last. What a source cannot take is shared again by
    weight: with the sources in the order of size per weight, those up to some place are full and all others get
    the same amount per weight. Works on one row per source.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    full = sources.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("full"))
    by_ratio = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, here = by_ratio.rowsBetween(W.unboundedPreceding, -1), by_ratio.rowsBetween(0, W.unboundedFollowing)
    rest = F.sum("source_size").over(W.partitionBy()) * budget - F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    per_weight = full.withColumn("level", rest / F.sum("weight").over(here))
    level = F.max(F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("level"))).over(W.partitionBy())
    share = F.least("full", level * F.col("weight"))
    return per_weight.withColumn("target", F.coalesce(share, "full")).select("source", "source_size", "target")


def balanced_rates(sizes: DataFrame, targets: DataFrame, most: float = MOST) -> DataFrame:
    """(source, scale, tilt): a document of `size` words is taken `most / (1 + exp(-tilt * size / scale))` times on average.

    Of all rates that meet a source's target these have the largest entropy relative to taking everything once: an
    exponential tilt of the odds, by the dual's one multiplier per source. The dual is convex; each Newton step is
    one distributed sum over `sizes` (source, size, n: how many documents have that size), which Spark keeps
    grouped, so a step does not depend on the number of documents. A bracket keeps the steps safe.
    """
    inner = (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))
    scale = sizes.groupBy("source").agg((F.sum(F.col("size") * F.col("size") * F.col("n")) / F.sum(F.col("size") * F.col("n"))).alias("scale"))
    state = targets.where(inner).join(scale, [targets.source.eqNullSafe(scale.source)]).select(
        targets.source, "target", "scale", F.lit(0.0).alias("tilt"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"), F.lit(1.0).alias("miss")
    )
    state = stored(state, "dual")
    for _ in range(NEWTON_STEPS):
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst < TOLERANCE:
            break
        x = F.col("size") / F.col("scale")
        odds = F.exp(-F.col("tilt") * x)
        rate = F.lit(most) / (odds + 1)
        joined = sizes.join(state, sizes.source.eqNullSafe(state.source)).select(
            state.source, "target", "scale", "tilt", "low", "high",
            (F.col("n") * F.col("size") * rate).alias("taken"),
            (F.col("n") * F.col("size") * x * rate * (F.lit(1.0) - rate / most)).alias("slope"),
        )
        summed = joined.groupBy("source", "target", "scale", "tilt", "low", "high").agg(
            F.sum("taken").alias("taken"), F.sum("slope").alias("slope")
        )
        over = F.col("taken") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.try_divide(F.col("taken") - F.col("target"), F.col("slope"))
        inside = summed.select("source", "target", "scale", step.alias("step"), low.alias("low"), high.alias("high"),
                               (F.abs(F.col("taken") - F.col("target")) / F.col("target")).alias("miss"), F.col("tilt").alias("was"))
        good = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
        # Once a source has met its target its tilt stays.
        tilt = F.when(F.col("miss") < TOLERANCE, F.col("was")).when(good, F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
        state = stored(inside.select("source", "target", "scale", tilt.alias("tilt"), "low", "high", "miss"), "dual")
    return state.select("source", "scale", "tilt")


class Mix:
    """What the mix takes of each source: tilt, target and the last moves, one row per source, and how to apply them."""

    def __init__(self, measured: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, most: float = MOST):
        """`measured` (doc_id, size, source) is read several times and should be a stored table."""
        self.most = most
        sizes = stored(measured.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
        sums = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
        targets = stored(mixture_targets(sums, weights, budget, most), "targets")
        tilts = balanced_rates(sizes, targets, most).withColumnRenamed("source", "s")
        plan = targets.join(tilts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
        self.plan = stored(plan, "plan")
        self.moves = self._closed_in(stored(self._rounded(measured), "copies"))

    def _rounded(self, frame: DataFrame) -> DataFrame:
        """`frame` with rate, draw and copies; doc_id, size and source are read."""
        tilted = F.lit(self.most) / (F.exp(-F.col("tilt") * F.col("size") / F.col("scale")) + 1)
        edge = F.when(F.col("target") >= self.most * F.col("source_size"), F.lit(self.most)).otherwise(F.lit(0.0))
        rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.coalesce(tilted, edge))
        # 0 to 1, the same in every run: no rand().
        draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("copies")), 11) / F.lit(float(1 << 53))
        rated = frame.join(self.plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", rate).drop("s", "scale", "tilt")
        return rated.withColumn("draw", draw).withColumn("copies", F.floor(F.col("rate") + F.col("draw")).cast("long"))

    def _closed_in(self, copies: DataFrame) -> DataFrame:
        """(s, gap, moves): of all documents that could take one copy more or less, the one that leaves the smallest gap, a few times."""
        kind = dict(copies.dtypes)["doc_id"]
        none = F.lit(None).cast(f"array<struct<doc_id:{kind},change:int>>")
        gaps = copies.groupBy("source", "target").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
        gaps = stored(gaps.select(F.col("source").alias("s"), (F.col("target") - F.col("taken")).alias("gap"), F.coalesce(none, F.array()).alias("moves")), "gaps")
        for _ in range(CLOSING_STEPS):
            up = (F.col("gap") > 0) & (F.col("copies") < F.floor(F.lit(self.most)))
            change = F.when(up, 1).when((F.col("gap") < 0) & (F.col("copies") > 0), -1)
            near = copies.where("size > 0").join(gaps, F.col("source").eqNullSafe(F.col("s"))).withColumn("change", change)
            left = F.abs(F.col("gap") - F.col("change") * F.col("size"))
            better = near.where((left < F.abs("gap")) & ~F.array_contains(_moved(), F.col("doc_id")))
            best = better.groupBy("source").agg(F.min(F.struct(left.alias("left"), "draw", "doc_id", "size", "change")).alias("b"))
            joined = gaps.join(best, F.col("s").eqNullSafe(F.col("source")), "left")
            gap = F.col("gap") - F.coalesce(F.col("b.change") * F.col("b.size"), F.lit(0))
            more = F.when(F.col("b").isNull(), F.col("moves")).otherwise(F.array_append("moves", F.struct("b.doc_id", "b.change")))
            gaps = stored(joined.select("s", gap.alias("gap"), more.alias("moves")), "gaps")
        return gaps

    def copies(self, frame: DataFrame) -> DataFrame:
        """`frame`, which has doc_id, size and source, with source_size, target, rate and copies."""
        change = F.element_at(F.filter("moves", lambda move: move["doc_id"] == F.col("doc_id")), 1)["change"]
        moved = self._rounded(frame).join(self.moves, F.col("source").eqNullSafe(F.col("s")))
        changed = F.col("copies") + F.when(F.array_contains(_moved(), F.col("doc_id")), change).otherwise(0)
        return moved.withColumn("copies", changed).drop("s", "gap", "moves", "draw")


def _moved() -> Column:
    return F.transform("moves", lambda move: move["doc_id"])


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measured_documents(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    kept = docs.select(F.col(id_column).alias("doc_id"), words_in(F.col(text_column)).alias("size"), F.col(source_column).alias("source"))
    return stored(kept, "measured")


def mix_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, rate, copies): words that the mix takes of every document.

    Size: words of the text, none for null. Copies are the rate rounded up or down by a hash of the id, so reruns
    agree; then, a few times, the document that brings its source's sum nearest its target takes one copy more or
    less. Repeated rows are documents of their own and are rounded alike, also in that last step. Null sources are
    one source. A source without words has target 0; documents without words are taken once and count for nothing.
    """
    measured = measured_documents(docs, id_column, text_column, source_column)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return Mix(measured, **options).copies(measured).select("doc_id", "size", "source_size", "target", taken, "rate", "copies")


def mixed_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", **options) -> DataFrame:
    """The rows of `docs`, all columns, each as often as the mix takes it. The texts are not shuffled."""
    mix = Mix(measured_documents(docs, id_column, text_column, source_column), **options)
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_column).alias("doc_id"), words_in(F.col(text_column)).alias("size"), F.col(source_column).alias("source"))
    repeated = mix.copies(whole).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
