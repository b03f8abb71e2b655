"""Near-duplicate documents: bottom-k sketches of word shingles, inverted lists, exact verification, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solvind.llm.common import components, stored
from solvind.llm.textgrid import chunks, distinct, mix, shingles, words

WIDTH = 5
PERCENT = 75  # linked from this Jaccard similarity on
KEPT = 48  # values of a sketch
LONG_LIST = 64  # members from which on a list is compared through leaders
PLAIN_VALUES = 24  # a sketch with fewer values in short lists also needs the long ones
LEADER_ROUNDS = 3
LEADER_GAIN = 0.1  # another round of leaders only if the last one joined as many components for each pair
CHUNK_BYTES = 250_000  # text that a worker turns into shingles at once
BLOCK = 200_000  # hashes that are compared with as many others at once
BITMAP_BITS = 1 << 23
_SIGN = np.uint64(1 << 63)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, shingle hashes, hashes before each text) of runs of texts; ascending and distinct in each text."""
    for row, rows, data, offsets in chunks(texts, CHUNK_BYTES):
        yield row, rows, *distinct(*shingles(*words(data, offsets), width))


def sketches(docs: DataFrame, width: int, kept: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, n, sum, mark, sketch): the size of the shingle set, two checksums of it and its `kept` smallest hashes."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, rows, hashes, before in shingle_sets(batch.column(1), width):
                sizes = np.diff(before)
                total, other = (np.concatenate([[np.uint64(0)], np.cumsum(values)]) for values in (hashes, mix(hashes + np.uint64(1))))
                ranks = np.arange(len(hashes)) - np.repeat(before[:-1], sizes)
                values = (hashes[ranks < kept] ^ _SIGN).view(np.int64)  # signed, in the same order
                places = np.concatenate([[0], np.cumsum(np.minimum(sizes, kept))]).astype(np.int32)
                sums = [np.diff(x.view(np.int64)[before]) for x in (total, other)]
                arrays = [batch.column(0).slice(row, rows), pa.array(sizes), *map(pa.array, sums), pa.ListArray.from_arrays(places, values)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "sum", "mark", "sketch"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(sketch, "doc_id long, n long, sum long, mark long, sketch array<long>")


def union_estimates(a: list, b: list, kept: int, whole: np.ndarray | bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For rows of two sketches (values in both, values) among the smallest `kept` of their union, in `whole` rows among all."""
    pad = np.iinfo(np.int64).max
    table = np.full((len(a), 2 * kept), pad, np.int64)
    for side, column in enumerate((a, b)):
        lengths = np.array([len(x) for x in column], np.int64)
        rows = np.repeat(np.arange(len(column)), lengths)
        places = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        table[rows, side * kept + places] = np.concatenate(column) if len(rows) else []
    table.sort(axis=1)
    real = table != pad
    again = np.zeros_like(real)
    again[:, 1:] = (table[:, 1:] == table[:, :-1]) & real[:, 1:]
    rank = np.cumsum(real & ~again, axis=1)
    limit = np.broadcast_to(np.where(whole, 2 * kept, kept), len(a))
    return (again & (rank <= limit[:, None])).sum(axis=1), np.minimum(rank[:, -1], limit)


def likely(a: list, b: list, n_a: np.ndarray, n_b: np.ndarray, kept: int, percent: int) -> np.ndarray:
    """Pairs whose union sketch does not rule them out by five standard deviations; exact, over the whole union, where both sketches hold whole sets."""
    whole = (n_a <= kept) & (n_b <= kept)
    both, union = union_estimates(a, b, kept, whole)
    share = percent / 100
    slack = np.where(whole, 1e-9, 5 * np.sqrt(share * (1 - share) * union))
    return (both >= share * union - slack) & (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))


class _Finder:
    """The state of one search: representatives with their sketches, the texts, and the components so far."""

    def __init__(self, texts: DataFrame, reps: DataFrame, width: int, percent: int, kept: int):
        self.texts, self.reps, self.width, self.percent, self.kept = texts, reps, width, percent, kept
        #: (rep, c): the component of every representative by the links so far
        self.labels = reps.select("rep", F.col("rep").alias("c"))

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that their union sketches let through."""
        kept, percent = self.kept, self.percent

        def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 2000):
                    some = batch.slice(at, 2000)
                    sides = [[np.asarray(x.values) for x in some.column(name)] for name in ("sketch_a", "sketch_b")]
                    good = likely(*sides, some.column("n_a").to_numpy(), some.column("n_b").to_numpy(), kept, percent)
                    yield some.select(["a", "b"]).filter(pa.array(good))

        near = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        sides = [self.reps.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab"]
        return pairs.join(sides[0], "a").join(sides[1], "b").where(near).mapInArrow(estimate, "a long, b long")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose whole shingle sets, made again from the texts, have the similarity asked for. Rows meet one by one in the JVM."""
        sets = stored(self.whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()), "sets")
        sides = [sets.select(F.col("rep").alias(s), F.col("shingles").alias(f"set_{s}")) for s in "ab"]
        both = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - both
        return pairs.join(sides[0], "a").join(sides[1], "b").where((100 * both >= self.percent * union) & (union > 0)).select("a", "b")

    def wanted(self, ids: DataFrame) -> DataFrame:
        """Texts of the given ids, one each. A bitmap of fixed size keeps nearly all other rows out of the shuffle."""
        words_of = ids.select(F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS)).alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        found = words_of.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect()
        bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
        for row in found:
            bitmap[row.word] = row.bits

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bit = batch.column("bit").to_numpy()
                inside = (bitmap[bit >> 6] >> (bit & 63)) & 1
                yield batch.filter(pa.array(inside == 1)).select(["doc_id", "text"])

        marked = self.texts.withColumn("bit", F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP_BITS)))
        return marked.mapInArrow(keep, "doc_id long, text string").join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"])

    def whole_sets(self, ids: DataFrame) -> DataFrame:
        """(rep, shingles): the whole shingle sets, as hashes, of the representatives in `ids` (rep)."""
        width = self.width

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row, rows, hashes, before in shingle_sets(batch.column("text"), width):
                    values = pa.ListArray.from_arrays(before.astype(np.int32), hashes.view(np.int64))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, rows), values], ["rep", "shingles"])

        return self.wanted(ids.select(F.col("rep").alias("doc_id"))).mapInArrow(sets, "rep long, shingles array<long>")

    def add(self, pairs: DataFrame, label: str) -> float:
        """Check pairs and join the components of those that link; how many components went for each pair that was checked."""
        candidates = stored(self.estimated(pairs), label)
        checked = candidates.count()
        return self.join(self.verified(candidates)) / checked if checked else 0.0

    def join(self, links: DataFrame) -> int:
        """Join the components of pairs that are known to link; how many components went into others."""
        ends = [self.labels.select(F.col("rep").alias(s), F.col("c").alias(f"c_{s}")) for s in "ab"]
        between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
        parts = stored(components(between), "components")
        moved = self.labels.join(parts, F.col("c") == F.col("node"), "left")
        self.labels = stored(moved.select("rep", F.coalesce("component", "c").alias("c")), "labels")
        return parts.where("node <> component").count()


def best_leaders(members: DataFrame) -> DataFrame:
    """(a, b): of the leaders that a representative meets in its lists (rep, leader) the one it meets most often, then the smallest.

    One pair for each representative; what this leaves unconnected is asked for again afterwards.
    """
    met = members.where("rep <> leader").groupBy("rep", "leader").agg(F.count(F.lit(1)).alias("times"))
    best = met.groupBy("rep").agg(F.max(F.struct("times", (-F.col("leader")).alias("less"))).alias("best"))
    return best.select(F.col("rep").alias("a"), (-F.col("best.less")).alias("b"))


def next_leaders(heavy: DataFrame, labels: DataFrame, place: int) -> DataFrame:
    """(a, b): every representative of `heavy` (rep, values) and the leader of its list of the `place`-th smallest value.

    The leader is the smallest of the representatives that this list is the `place`-th of. One list for each
    representative, so a round makes no more rows than there are representatives. Only pairs of different components.
    """
    at = heavy.where(F.size("values") > place).select("rep", F.col("values")[place].alias("value")).join(labels, "rep")
    led = at.groupBy("value").agg(F.min(F.struct("rep", "c")).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = at.join(led, (at.value == led.value) & (at.c != F.col("leader.c")))
    return met.select(F.col("rep").alias("a"), F.col("leader.rep").alias("b"))


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, kept: int = KEPT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document; component_id is the smallest id reachable by links.

    Equal sets are one class. Of each class the `kept` smallest shingle hashes are indexed. Lists of up to `LONG_LIST`
    members: each class is compared with the leader, a list's smallest member, that it meets most often, and then
    members that are not connected yet with each other. For longer lists that would be quadratic: only sketches with
    too few values in short lists to be found there need them. In a few rounds, as long as they join many, each is compared with the leader of one of
    its lists, and what is left in another component than a list's on whole sets, in blocks of similar size. Every
    other candidate passes the union-sketch estimate and is confirmed on its whole sets. Whether to go on is asked of the data; no list is cut.

    Null and empty texts have an empty set and no links. Rows that repeat an id are taken to repeat its text.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    made = stored(sketches(docs, width, kept, id_column, text_column), "sketches")
    classes = stored(made.where("n > 0").groupBy("n", "sum", "mark").agg(F.min("doc_id").alias("rep")), "classes")
    rep_rows = made.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    reps = stored(rep_rows.select(F.col("doc_id").alias("rep"), "n", "sketch"), "reps")

    postings = reps.select("rep", "n", F.explode("sketch").alias("value"))
    lists = stored(postings.groupBy("value").agg(F.count(F.lit(1)).alias("df"), F.min("rep").alias("leader")).where("df > 1"), "lists")
    shared = stored(postings.join(lists, "value"), "shared")
    finder = _Finder(texts, reps, width, percent, kept)

    short = shared.where(F.col("df") <= LONG_LIST)
    finder.add(best_leaders(short), "star")
    members = short.select("value", "rep", "n").join(finder.labels, "rep")
    sides = [members.select("value", *[F.col(c).alias(f"{c}_{s}") for c in ("rep", "n", "c")]) for s in "ab"]
    close = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    pairs = sides[0].join(sides[1], "value").where((F.col("rep_a") < F.col("rep_b")) & (F.col("c_a") != F.col("c_b")) & close)
    finder.add(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), "short")

    long = shared.where(F.col("df") > LONG_LIST).groupBy("rep").agg(F.sort_array(F.collect_list("value")).alias("values"))
    few = F.size("sketch") - F.size("values") < PLAIN_VALUES
    heavy = stored(long.join(reps.select("rep", "sketch"), "rep").where(few).select("rep", "values"), "heavy")
    for place in range(LEADER_ROUNDS):
        if finder.add(next_leaders(heavy, finder.labels, place), "leaders") < LEADER_GAIN:
            break  # what is left does not link to its leaders: the blocks compare it
    rest = stored(_apart(heavy, finder.labels), "apart")
    if not rest.isEmpty():
        finder.join(_blocked(rest, heavy.select("rep"), finder))
    labels = finder.labels

    ids = made.select("doc_id", "n", "sum", "mark").join(classes, ["n", "sum", "mark"], "left").join(labels, "rep", "left")
    component = F.coalesce("c", "doc_id")
    return ids.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without those that are linked, directly or not, to a document of smaller id."""
    found = near_duplicates(docs, id_column=id_column, text_column=text_column)
    gone = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias(id_column)).distinct(), "gone")
    return docs.join(gone, id_column, "left_anti")


def _apart(heavy: DataFrame, labels: DataFrame) -> DataFrame:
    """(rep): members of long lists that are in another component than the smallest component of one of their lists."""
    members = heavy.join(labels, "rep").select("rep", "c", F.explode("values").alias("value"))
    least = members.groupBy("value").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most").withColumnRenamed("value", "split")
    return members.join(least, (F.col("value") == F.col("split")) & (F.col("c") != F.col("least"))).select("rep").distinct()


def _root(above: dict[int, int], part: int) -> int:
    while part in above:
        part = above[part]
    return part


def _blocked(left: DataFrame, right: DataFrame, finder: _Finder) -> DataFrame:
    """Links of `left` and `right` (rep), the first part of the second, that join all components that links of whole sets join.

    Set sizes fall into classes by powers of the size ratio that a link allows, so a link joins equal or adjacent
    classes. Rows of a class are packed into blocks of about `BLOCK` hashes; one block is compared with another
    by counting common hashes, which passes on links only, and of those only one for each two components that no other
    link of the two blocks has joined: no more links than rows. Every pair of blocks has a key of its own.
    """
    ratio, percent = finder.percent / 100, finder.percent
    size_class = F.floor(F.log(F.col("n").cast("double")) / -float(np.log(ratio)) + 1e-9).cast("long")
    sets = stored(finder.whole_sets(right), "sets").withColumn("n", F.size("shingles"))

    def packed(rows: DataFrame, side: str) -> DataFrame:
        blocks = F.greatest(F.lit(1), F.floor(F.sum("n") / BLOCK)).cast("long")
        sizes = rows.withColumn("size", size_class).groupBy("size").agg(blocks.alias("blocks"))
        rows = rows.join(finder.labels, "rep").withColumn("size", size_class).join(sizes, "size")
        rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        return rows.groupBy("size", "block", "blocks").agg(F.collect_list(F.struct("rep", "c", "shingles")).alias(side))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, other in zip(batch.column("one"), batch.column("other")):
                sides = []
                for side in (one, other):
                    rows = side.values
                    lists = rows.field("shingles")
                    sides.append((*(rows.field(name).to_numpy() for name in ("rep", "c")), np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy()))
                (ids, parts, sizes, values), (other_ids, other_parts, other_sizes, other_values) = sides
                owners = np.repeat(np.arange(len(other_ids)), other_sizes)
                order = np.argsort(other_values, kind="stable")
                owners, other_values = owners[order], other_values[order]
                low, high = np.searchsorted(other_values, values, "left"), np.searchsorted(other_values, values, "right")
                edges = np.concatenate([[0], np.cumsum(sizes)])
                above: dict[int, int] = {}  # a component that has joined another in this pair of blocks
                for k in range(len(ids)):
                    begin, count = low[edges[k] : edges[k + 1]], (high - low)[edges[k] : edges[k + 1]]
                    spots = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
                    both = np.bincount(owners[spots], minlength=len(other_ids))
                    linked = np.flatnonzero((100 * both >= percent * (sizes[k] + other_sizes - both)) & (other_parts != parts[k]))
                    joined = []
                    for other_part, place in zip(*np.unique(other_parts[linked], return_index=True)):
                        low_part, high_part = sorted((_root(above, int(parts[k])), _root(above, int(other_part))))
                        if low_part != high_part:
                            above[high_part] = low_part
                            joined.append(linked[place])
                    if joined:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(joined), ids[k])), pa.array(other_ids[joined])], ["a", "b"])

    others = stored(packed(sets, "other"), "others")
    counts = others.select("size", F.col("blocks").alias("of")).distinct()
    near_sizes = F.explode(F.array(F.col("size") - 1, F.col("size"), F.col("size") + 1)).alias("size")
    asked = packed(sets.join(left, "rep", "left_semi"), "one").select("one", near_sizes).join(counts, "size")
    asked = asked.select("one", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("of") - 1)).alias("block"))
    pairs = asked.join(others, ["size", "block"]).select("one", "other").mapInArrow(compare, "a long, b long")
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
