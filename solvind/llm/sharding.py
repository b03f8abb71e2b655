"""Shards of near-equal bytes: minimax contiguous partition over ordered atomic groups."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from solvind.llm.common import stored

OVERHEAD = 16  # bytes that a record takes besides its text
FIRST_BITS, MORE_BITS = 12, 8
ROWS_PER_CELL = 50_000


class Segments:
    """A run of groups each: first key, width in bits, bytes, number of groups, largest group. Ordered by first key."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        self.rows = sorted(row for row in rows if row[3])
        self.ends = [0]
        for row in self.rows:
            self.ends.append(self.ends[-1] + row[2])

    def cuts(self, capacity: int, shards: int, fluid: bool) -> list[tuple[int, int]] | None:
        """Where each shard filled to `capacity` ends, as (segment, bytes): a greedy pass; None if groups are left over.

        `fluid` lets a shard end inside a segment of several groups, so the answer bounds the true one from one
        side; without it a segment counts as one group, which bounds it from the other.
        """
        at, found, total = 0, [], self.ends[-1]
        for _ in range(shards):
            reach = min(total, at + capacity)
            segment = bisect_right(self.ends, reach) - 1
            end = reach if fluid and segment < len(self.rows) and self.rows[segment][3] > 1 else self.ends[segment]
            found.append((segment, end))
            at = end
        return found if at >= total else None

    def least_capacity(self, shards: int, fluid: bool) -> int:
        """Binary search for the smallest capacity with which the greedy pass places everything."""
        low, high = -(-self.ends[-1] // shards), self.ends[-1]
        low = max(low, max((row[4] for row in self.rows), default=0))
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.cuts(middle, shards, fluid) else (middle + 1, high)
        return low


def shard_bounds(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """(first key of shards 1, 2, ..., the smallest feasible capacity) of groups (key long >= 0 below 2^60, bytes).

    The driver holds segments of the key range, not groups: 2^12 at first. Where a cut could fall inside a segment
    of several groups, for any capacity between the bounds known so far, Spark sums that segment again in 2^8 parts.
    Segments refined stay few, since the bounds close in as they shrink, and the result is that over single groups.
    """
    bits = 60 - FIRST_BITS
    segments = Segments([(row.p << bits, bits, *row[1:]) for row in _summed(groups, F.shiftright("key", bits))])
    while True:
        low, high = segments.least_capacity(shards, True), segments.least_capacity(shards, False)
        early, late = segments.cuts(low, shards, False), segments.cuts(high, shards, True)
        early = early or Segments.cuts(segments, low, shards, True)
        split = set()
        for k in range(shards):
            first = min(_atomic(segments, low, k + 1), early[k][0])
            split.update(i for i in range(first, min(late[k][0] + 1, len(segments.rows))) if segments.rows[i][3] > 1)
        if not split:
            break
        split_rows = [segments.rows[i] for i in split]
        width = max(row[1] for row in split_rows)
        split_rows = [row for row in split_rows if row[1] == width]
        finer = max(0, width - MORE_BITS)
        wanted = groups.where(F.shiftright("key", width).isin([row[0] >> width for row in split_rows]))
        parts = [(row.p << finer, finer, *row[1:]) for row in _summed(wanted, F.shiftright("key", finer))]
        gone = set(split_rows)
        segments = Segments([row for row in segments.rows if row not in gone] + parts)
    cuts = segments.cuts(high, shards, False)
    keys = [row[0] for row in segments.rows]
    return [keys[i] if i < len(keys) else 1 << 60 for i, _ in cuts[:-1]], high


def _atomic(segments: Segments, capacity: int, shards: int) -> int:
    """Segments that `shards` greedy shards of `capacity` take when no segment is cut."""
    at = 0
    for _ in range(shards):
        at = segments.ends[bisect_right(segments.ends, at + capacity) - 1]
    return bisect_right(segments.ends, at) - 1


def _summed(groups: DataFrame, part: Column) -> list:
    return (
        groups.groupBy(part.alias("p"))
        .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("most"))
        .collect()
    )


def shard_documents(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document with its shard (0 to `shards` - 1) and its place there.

    Law `bytes`: equal texts form one group that is never divided; groups stand in the order of a 60-bit hash of
    their text; the largest shard is as small as contiguous shards allow. Size: UTF-8 bytes plus 16.
    Null text: size 16, crc32 0, one group of its own kind (with the empty text). Repeated rows are rows of their
    own, ties in a shard have no fixed order, an empty table gives no rows. Only `id_column` and `text_column` are
    read, so other columns may have any name.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    sizes = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(text), 4).alias("key"),
        ),
        "sizes",
    )
    groups = stored(sizes.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    bounds, _ = shard_bounds(groups, shards)
    shard = F.lit(0)
    for bound in bounds:
        shard = shard + (F.col("key") >= F.lit(bound)).cast("int")

    # Places: a shard is numbered in cells, which a hash of the id fills evenly whatever texts repeat.
    cells = max(8, sizes.count() // (shards * ROWS_PER_CELL))
    placed = sizes.select("*", shard.alias("shard")).withColumn("cell", F.pmod(F.xxhash64("doc_id", "key"), F.lit(cells)))
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = stored(counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    inside = F.row_number().over(W.partitionBy("shard", "cell").orderBy("doc_id", "key"))
    return (
        placed.withColumn("place", inside)
        .join(starts, ["shard", "cell"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
