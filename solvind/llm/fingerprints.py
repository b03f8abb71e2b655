"""Fingerprints by consistent weighted sampling, and how they change with an edit. No Python code runs on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from solvind.llm.common import SPACES, ascii_lower, stored

PLACES = 64
ROWS_PER_RANGE = 500_000
_BOTH, _NEITHER = 2, 3  # units of both sides, and of none: a text without words; 0 and 1 are units of one side


def _samples(terms: DataFrame, keys: list[str]) -> DataFrame:
    """`keys`, codes, edited: the samples of both sides at every place, from rows (keys, term, weight_0, weight_1).

    Consistent weighted sampling of whole weights: a term of weight s stands for the units (term, 1) to (term, s), and
    each place of the signature ranks all units by a hash of its own and takes the least. Every unit is as likely to be
    it, so two texts have the same sample at a place with the probability of the generalised Jaccard similarity: the
    sum of the smaller weights over the sum of the larger ones. The first s units of a term are the same in all texts,
    so a change of weight touches only the units it adds or takes. Both sides share the ranks.
    """
    units = terms.select(*keys, "term", "weight_0", "weight_1", F.explode(F.expr("sequence(1L, greatest(weight_0, weight_1, 1L))")).alias("unit"))
    inside = [F.col("unit") <= F.col(f"weight_{side}") for side in (0, 1)]
    part = F.when(inside[0] & inside[1], _BOTH).when(inside[0], 0).when(inside[1], 1).otherwise(_NEITHER)
    units = units.select(*keys, part.alias("part"), F.xxhash64("term", "unit").alias("unit"))
    rank = lambda place: F.shiftrightunsigned(F.xxhash64("unit", F.lit(place)), 1)
    # What the sides have in common is ranked once: a unit touches one minimum for each place, and a few rows make the sides' minima.
    parts = units.groupBy(*keys, "part").agg(*[F.min(rank(place)).alias(f"least_{place}") for place in range(PLACES)])
    least = [
        F.min(F.when(F.col("part").isin(_BOTH, side), F.col(f"least_{place}"))).alias(f"least_{side}_{place}") for side in (0, 1) for place in range(PLACES)
    ]
    picked = parts.groupBy(*keys).agg(*least)

    def codes(side: int) -> Column:
        found = [F.lit(place << 16).bitwiseOR(F.col(f"least_{side}_{place}").bitwiseAND(F.lit(0xFFFF)).cast("int")) for place in range(PLACES)]
        return F.when(F.col(f"least_{side}_0").isNull(), F.array().cast("array<int>")).otherwise(F.array(*found))

    return picked.select(*keys, codes(0).alias("codes"), codes(1).alias("edited"))


def likeness(left: Column, right: Column) -> Column:
    """Share of the places with the same sample; 1 for two empty fingerprints, 0 if one is empty."""
    either = F.greatest(F.size(left), F.size(right))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / either)


def fingerprint_text(codes: Column) -> Column:
    """Six hexadecimal digits per place: its number and its sample; none for a text without words."""
    return F.array_join(F.transform(codes, lambda code: F.lpad(F.hex(code.cast("long")), 6, "0")), "")


def document_ring(lengths: DataFrame) -> DataFrame:
    """(doc_id, prev_id, prev_n, next_id) of `lengths` (doc_id, n): neighbours in ascending order, the ends joined.

    The order is found in ranges of ids, each in its own task; only the ranges' ends meet in one place.
    """
    parts = max(1, -(-lengths.count() // ROWS_PER_RANGE))
    ranged = lengths.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranges")
    ends = ranged.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.struct("doc_id", "n")).alias("last"))
    order, whole = W.orderBy("part"), W.partitionBy()
    ends = ends.select(
        "part",
        F.coalesce(F.lag("last").over(order), F.max("last").over(whole)).alias("before"),
        F.coalesce(F.lead("first").over(order), F.min("first").over(whole)).alias("after"),
    )
    inside = W.partitionBy("part").orderBy("doc_id")
    near = ranged.select(
        "part", "doc_id", F.lag(F.struct("doc_id", "n")).over(inside).alias("lag"), F.lead("doc_id").over(inside).alias("lead")
    )
    joined = near.join(ends, "part").select("doc_id", F.coalesce("lag", "before").alias("prev"), F.coalesce("lead", "after").alias("next_id"))
    return joined.select("doc_id", F.col("prev.doc_id").alias("prev_id"), F.col("prev.n").alias("prev_n"), "next_id")


def fingerprint_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness to each other and to the next one's.

    Terms are words, A-Z as a-z, weighted by their number. Edited: the last quarter of the code points gives way to
    as many first ones of the next document by id (after the last: the first). Null and empty texts have an empty
    fingerprint. One row per id: of rows with the same id the longest text counts, of those the greatest. Rows
    without id have no place in the order and give no row. Other columns are not read.
    """
    texts = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    lengths = texts.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    ring = stored(document_ring(stored(lengths, "lengths")), "ring")
    kept = texts.groupBy("doc_id").agg(F.max(F.struct(F.length("text").alias("n"), "text")).alias("kept"))
    base = kept.select("doc_id", "kept.n", "kept.text").join(ring.hint("shuffle_merge"), "doc_id")
    given = base.select(F.col("prev_id").alias("doc_id"), F.expr("left(text, prev_n div 4)").alias("given"))
    both = base.join(given.hint("shuffle_merge"), "doc_id").withColumn("edited", F.expr("concat(left(text, n - n div 4), given)"))

    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body"))))
    facts = ["doc_id", "n", "prev_id", "next_id", "sha"]
    hashed = both.withColumn("sha", F.sha2("edited", 256)).select(*facts, sides.alias("s"))
    words = hashed.select(*facts, "s.side", F.explode(F.split(ascii_lower(F.col("s.body")), SPACES)).alias("word"))
    # A text's first word is empty when it begins with a space or has no words: kept as a term of no weight.
    term = F.when(F.col("word") == "", F.lit(None).cast("long")).otherwise(F.xxhash64("word"))
    weight = lambda side: F.sum(((F.col("side") == side) & (F.col("word") != "")).cast("long")).alias(f"weight_{side}")
    weighed = words.groupBy(*facts, term.alias("term")).agg(weight(0), weight(1))
    prints = stored(_samples(weighed, facts), "prints")

    following = prints.select(F.col("prev_id").alias("doc_id"), F.col("codes").alias("next"))
    return prints.join(following, "doc_id").select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
        fingerprint_text(F.col("codes")).alias("fingerprint"), fingerprint_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited")).alias("near_edited"), likeness(F.col("codes"), F.col("next")).alias("near_next"),
    )
