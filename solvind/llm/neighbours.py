"""Near-duplicate vectors by NN-descent: a neighbour graph refined through neighbours of neighbours, then cut at a cosine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from solvind.llm.common import components, stored

THRESHOLD = 0.93
NEIGHBOURS = 12
TREES = 6
LEAF = 128  # vectors aimed at in a leaf
BLOCK = 512  # vectors that are compared with each other at once, at most
HUB = 48  # members of a neighbourhood that are compared with each other at once
ROUNDS = 5
SETTLED = 0.01  # new neighbours per vector at which the rounds end
AUDITED = 256  # vectors, four times as many until there are enough links
MOST_AUDITED = 4096
LEAST_LINKS = 200
REACH = 0.05  # of a cosine below the threshold, from where on a vector is likely to have links
RECALL = 0.98
MORE_TREES = 3


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def unit_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(rep, label, dim, weight, unit) of every distinct vector that can link: the smallest id with it and how many have it."""
    e = F.col(vector_column)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col(label_column).isNotNull() & e.isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0)
    read = vectors.where(usable).select(
        F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), e.cast("array<double>").alias("vector"), F.size(e).alias("dim")
    )
    classes = read.groupBy("label", "dim", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vector in batch.column("vector"):
                x = np.asarray(vector.values, float)
                x = x / np.abs(x).max()
                out.append(x / np.sqrt(x @ x))
            arrays = [batch.column(name) for name in ("rep", "label", "dim", "weight")] + [pa.array(out, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["rep", "label", "dim", "weight", "unit"])

    kind = dict(read.dtypes)["label"]
    return classes.mapInArrow(unit, f"rep long, label {kind}, dim int, weight long, unit array<double>")


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of rows with the same key, from rows sorted by it. A run is as large as its block."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if kept and kept[-1].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(kept)
                kept = []
            kept.append(part)
    if kept:
        yield pa.Table.from_batches(kept)


def _edges(a: np.ndarray, b: np.ndarray, cosine: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(cosine, pa.float64())], ["v", "u", "cosine"])


EDGE = "v long, u long, cosine double"


def leaf_neighbours(units: DataFrame, k: int, seed: int, trees: int) -> DataFrame:
    """First lists: in each of `trees` random partitions of the space, every vector's `k` nearest in its leaf.

    A leaf is a pattern of signs on random hyperplanes, within a label; leaves of more than `BLOCK` vectors, as many
    near copies make them, are divided by a hash.
    """
    spaces = units.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size"))

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = np.zeros((batch.num_rows, trees), np.int64)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = _matrix(batch.column("unit").take(pa.array(rows)))
                for tree in range(trees):
                    planes = np.random.default_rng([seed, tree, int(dim)]).standard_normal((dim, 30))
                    signs[rows, tree] = ((x @ planes) > 0) @ (1 << np.arange(30))
            arrays = [batch.column(name) for name in ("rep", "label", "dim")]
            arrays.append(pa.ListArray.from_arrays(np.arange(0, signs.size + 1, trees, dtype=np.int32), signs.reshape(-1)))
            yield pa.RecordBatch.from_arrays(arrays, ["rep", "label", "dim", "signs"])

    kind = dict(units.dtypes)["label"]
    made = units.mapInArrow(patterns, f"rep long, label {kind}, dim int, signs array<long>")
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("size") / LEAF)), F.lit(0)), F.lit(30)).cast("int")
    leaves = made.join(spaces, ["label", "dim"]).select("rep", "label", "dim", bits.alias("bits"), F.posexplode("signs").alias("tree", "pattern"))
    leaves = stored(leaves.withColumn("leaf", F.col("pattern").bitwiseAND(F.expr("shiftleft(1L, bits) - 1"))).drop("pattern", "bits"), "leaves")
    sizes = leaves.groupBy("label", "dim", "tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("rep", "tree"), F.col("parts"))
    key = F.xxhash64("label", "dim", "tree", "leaf", part)
    placed = leaves.join(sizes, ["label", "dim", "tree", "leaf"]).select("rep", "dim", key.alias("key"))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "key"):
            ids, x = table.column("rep").to_numpy(), _matrix(table.column("unit"))
            cosine = x @ x.T
            np.fill_diagonal(cosine, -2)
            some = min(k, len(ids) - 1)
            if some > 0:
                best = np.argpartition(-cosine, some - 1, axis=1)[:, :some]
                yield _edges(np.repeat(ids, some), ids[best].ravel(), np.take_along_axis(cosine, best, 1).ravel())

    with_units = placed.join(units.select("rep", "unit"), "rep")
    return with_units.repartition("key").sortWithinPartitions("key").mapInArrow(nearest, EDGE)


def best_lists(edges: DataFrame, k: int) -> DataFrame:
    """Each vector's `k` best of `edges` (v, u, cosine), ties to the smaller id."""
    once = edges.groupBy("v", "u").agg(F.max("cosine").alias("cosine"))
    rank = F.row_number().over(W.partitionBy("v").orderBy(F.desc("cosine"), "u"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def descend(graph: DataFrame, units: DataFrame, k: int, threshold: float) -> DataFrame:
    """Edges that would improve a list: for every vector, its neighbours and those it is a neighbour of meet each other.

    A neighbourhood is dealt in parts of about `HUB` members, so that a vector near to very many costs no single task
    too much. Lists that are full of links need no improvement here.
    """
    state = graph.groupBy("v").agg(F.min("cosine").alias("worst"), F.count(F.lit(1)).alias("length"))
    worst = F.when(F.col("length") < k, -2.0).when(F.col("worst") >= threshold, 2.0).otherwise(F.col("worst"))
    vectors = units.select(F.col("rep").alias("member"), "unit").join(state.select(F.col("v").alias("member"), worst.alias("worst")), "member")
    around = graph.select(F.col("v").alias("centre"), F.col("u").alias("member")).unionByName(graph.select(F.col("u").alias("centre"), F.col("v").alias("member")))
    around = around.unionByName(graph.select(F.col("v").alias("centre"), F.col("v").alias("member"))).distinct()
    parts = around.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / HUB).alias("parts"))
    key = F.xxhash64("centre", F.pmod(F.xxhash64("member"), F.col("parts")))
    met = around.join(parts, "centre").select("member", key.alias("key")).join(vectors, "member")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "key"):
            ids, worst_of, x = table.column("member").to_numpy(), table.column("worst").to_numpy(), _matrix(table.column("unit"))
            cosine = x @ x.T
            np.fill_diagonal(cosine, -2)
            one, other = np.nonzero(cosine > worst_of[:, None])
            if len(one):
                yield _edges(ids[one], ids[other], cosine[one, other])

    return met.repartition("key").sortWithinPartitions("key").mapInArrow(meet, EDGE)


def full_links(full: DataFrame, threshold: float) -> DataFrame:
    """(v, u, links) for vectors whose lists are full: how many vectors of other full lists each links to, and one of them.

    The lists of these vectors are enlarged to all others within reach: blocks of at most `BLOCK`, by label and leaf,
    with their mean direction and radius. Two blocks are compared, one task for each pair, only where angles allow a
    link between them. Links are counted there and not written out: of each vector's links in a pair of blocks only
    the smallest remains, which is enough to connect them.
    """
    cosine_of = threshold

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "key"):
            x = _matrix(table.column("unit"))
            middle = x.sum(axis=0)
            middle /= np.sqrt(middle @ middle) or 1.0
            radius = float(np.arccos(np.clip(x @ middle, -1, 1)).max())
            ids, weights = table.column("rep").to_numpy(), table.column("weight").to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "space": pa.array([table.column("space")[0].as_py()], pa.int64()),
                    "key": pa.array([table.column("key")[0].as_py()], pa.int64()),
                    "radius": pa.array([radius]),
                    "middle": pa.array([middle.tolist()], pa.list_(pa.float64())),
                    "ids": pa.array([ids.tobytes()], pa.binary()),
                    "weights": pa.array([weights.tobytes()], pa.binary()),
                    "units": pa.array([x.tobytes()], pa.binary()),
                }
            )

    schema = "space long, key long, radius double, middle array<double>, ids binary, weights binary, units binary"
    keyed = full.groupBy("space", "c").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    placed = full.join(keyed, ["space", "c"]).withColumn("key", F.xxhash64("space", "c", F.pmod(F.xxhash64("rep"), F.col("parts"))))
    packed = stored(placed.repartition("key").sortWithinPartitions("key").mapInArrow(blocks, schema), "blocks")
    sides = [packed.select("space", *[F.col(c).alias(f"{c}_{s}") for c in ("key", "radius", "middle")]) for s in "ab"]
    cosine = F.aggregate(F.zip_with("middle_a", "middle_b", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    gap = F.acos(F.greatest(F.least(cosine, F.lit(1.0)), F.lit(-1.0)))
    reach = float(np.arccos(threshold)) + 1e-6
    pairs = sides[0].join(sides[1], "space").where((F.col("key_a") <= F.col("key_b")) & (gap <= F.col("radius_a") + F.col("radius_b") + reach))
    pairs = stored(pairs.select("key_a", "key_b"), "block_pairs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                side = []
                for s in "ab":
                    ids, weights = (np.frombuffer(batch.column(f"{name}_{s}")[row].as_py(), np.int64) for name in ("ids", "weights"))
                    side.append((ids, weights, np.frombuffer(batch.column(f"units_{s}")[row].as_py()).reshape(len(ids), -1)))
                (ids_a, weights_a, a), (ids_b, weights_b, b) = side
                linked = a @ b.T >= cosine_of
                same = batch.column("key_a")[row].as_py() == batch.column("key_b")[row].as_py()
                if same:
                    np.fill_diagonal(linked, False)
                yield _counted(ids_a, linked, ids_b, weights_b)
                if not same:
                    yield _counted(ids_b, linked.T, ids_a, weights_a)

    halves = [packed.select(*[F.col(c).alias(f"{c}_{s}") for c in ("key", "ids", "weights", "units")]) for s in "ab"]
    met = pairs.join(halves[0], "key_a").join(halves[1], "key_b")
    return met.mapInArrow(compare, "v long, u long, links long")


def _counted(ids: np.ndarray, linked: np.ndarray, others: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(linked.any(axis=1))
    order = np.argsort(others)
    least = others[order][np.argmax(linked[some][:, order], axis=1)]
    return pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(least), pa.array(linked[some].astype(np.int64) @ weights)], ["v", "u", "links"])


def _space() -> Column:
    """One number for the vectors that may link: equal label and length."""
    return F.xxhash64("label", "dim")


def audit(units: DataFrame, links: DataFrame, full: DataFrame, threshold: float, graph: DataFrame | None = None) -> dict[int, tuple[int, int]]:
    """By space (true links, those that the search has) of audited vectors, found by comparing them with all rows.

    Half of the vectors are any, half are such that have a neighbour of `graph` in reach of the threshold. More are taken
    until `LEAST_LINKS` true links are seen or `MOST_AUDITED` vectors compared. Links between two full lists are counted
    by comparison anyway and do not enter.
    """
    near = units if graph is None else units.join(graph.where(F.col("cosine") >= threshold - REACH).select(F.col("v").alias("rep")).distinct(), "rep", "left_semi")
    audited = AUDITED
    while True:
        found = _audited(units, near, links, full, threshold, audited)
        if audited >= MOST_AUDITED or sum(total for total, _ in found.values()) >= LEAST_LINKS:
            return found
        audited *= 4


def _audited(units: DataFrame, near: DataFrame, links: DataFrame, full: DataFrame, threshold: float, audited: int) -> dict[int, tuple[int, int]]:
    order = F.xxhash64("rep", F.lit("audit"))
    queries = {row.rep: row for frame in (units, near) for row in frame.withColumn("space", _space()).orderBy(order, "rep").limit(audited // 2).collect()}
    by_space: dict[int, list] = {}
    for row in queries.values():
        by_space.setdefault(row.space, []).append((row.rep, row.unit))

    def true_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            space_of, ids = batch.column("space").to_numpy(), batch.column("rep").to_numpy()
            for space in np.unique(space_of).tolist():
                if space in by_space:
                    places = np.flatnonzero(space_of == space)
                    asked = np.array([q for q, _ in by_space[space]])
                    x = _matrix(batch.column("unit").take(pa.array(places)))
                    cosine = np.array([u for _, u in by_space[space]]) @ x.T
                    q, p = np.nonzero((cosine >= threshold) & (asked[:, None] != ids[places][None, :]))
                    space_column = pa.array(np.full(len(q), space))
                    yield pa.RecordBatch.from_arrays([space_column, pa.array(asked[q]), pa.array(ids[places][p])], ["space", "v", "u"])

    truth = units.select(_space().alias("space"), "rep", "unit").mapInArrow(true_links, "space long, v long, u long")
    both = truth
    for end in "vu":
        both = both.join(full.select(F.col("rep").alias(end)), end, "left_semi")
    wanted = stored(truth.join(both, ["v", "u"], "left_anti"), "truth")
    seen = wanted.join(links.select("v", "u").withColumn("has", F.lit(1)), ["v", "u"], "left")
    sums = seen.groupBy("space").agg(F.count(F.lit(1)).alias("total"), F.count("has").alias("has")).collect()
    return {row.space: (row.total, row.has) for row in sums}


def audit_recall(units: DataFrame, links: DataFrame, full: DataFrame, threshold: float) -> float:
    """Share of audited true links that the search has; 1.0 where no vector has a link."""
    found = audit(units, links, full, threshold).values()
    return sum(has for _, has in found) / max(1, sum(total for total, _ in found)) if found else 1.0


def search(units: DataFrame, k: int = NEIGHBOURS, threshold: float = THRESHOLD, seed: int = 7) -> tuple[DataFrame, DataFrame, list[int]]:
    """(links, full, open): symmetric links (v, u) from the final lists, the vectors (rep) whose list is full of links,
    and the spaces in which the audit still finds fewer than `RECALL` of the links after all rounds of trees."""
    rows = units.count()
    graph = None
    for attempt in range(MORE_TREES):
        leaves = leaf_neighbours(units, k, seed + attempt, TREES)
        graph = stored(best_lists(leaves if graph is None else graph.unionByName(leaves), k), "graph")
        for _ in range(ROUNDS):
            better = stored(descend(graph, units, k, threshold), "better")
            after = stored(best_lists(graph.unionByName(better), k), "graph")
            fresh = after.join(graph, ["v", "u"], "left_anti").count()
            graph = after
            if fresh <= SETTLED * rows:
                break
        good = graph.where(F.col("cosine") >= threshold)
        links = stored(good.select("v", "u").unionByName(good.select(F.col("u").alias("v"), F.col("v").alias("u"))).distinct(), "links")
        full = stored(good.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select(F.col("v").alias("rep")), "full")
        found = audit(units, links, full, threshold, graph)
        below = [space for space, (total, has) in found.items() if has < RECALL * total]
        if sum(has for _, has in found.values()) >= RECALL * sum(total for total, _ in found.values()):
            return links, full, []
    return links, full, below


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS,
    id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector: links join vectors of one label with a cosine of `threshold` or more.

    Vectors of different length do not link, nor do null or zero vectors, those with null, infinite or NaN components,
    and vectors without a label; they stay alone. Equal vectors are one class and count as so many links. A list that
    is full of links may have lost some: such vectors are compared with all others of their kind in blocks. So are all
    vectors of a label whose audited recall stays below `RECALL`, which makes its links exact. Rows that
    repeat an id are vectors of their own, with the same component. An empty table gives no rows.
    """
    units = stored(unit_vectors(vectors, id_column, vector_column, label_column), "units")
    links, full, below = search(units, k, threshold)
    whole = _space().isin(below) if below else F.lit(False)
    full = stored(full.unionByName(units.where(whole).select("rep")).distinct(), "enlarged") if below else full
    filled = full.withColumn("filled", F.lit(True))
    ends = [filled.select(F.col("rep").alias(s), F.col("filled").alias(f"filled_{s}")) for s in "vu"]
    weights = units.select(F.col("rep").alias("u"), "weight")
    listed = links.join(ends[0], "v", "left").join(ends[1], "u", "left").where("filled_v is null or filled_u is null").join(weights, "u")
    edges, counts = links.select(F.col("v").alias("a"), F.col("u").alias("b")), listed.groupBy("v").agg(F.sum("weight").alias("links"))
    if not full.isEmpty():
        parts = components(edges)
        signs = F.aggregate(F.slice("unit", 1, 30), F.lit(0).cast("long"), lambda bits, x: bits * 2 + (x > 0).cast("long"))
        sizes = units.where(whole).groupBy("label", "dim").agg(F.count(F.lit(1)).alias("size"))
        leaf = F.pmod(signs, F.pow(F.lit(2), F.ceil(F.log2(F.col("size") / BLOCK + 1))).cast("long"))
        ends_of = units.join(full, "rep").join(parts, F.col("rep") == F.col("node"), "left").join(sizes, ["label", "dim"], "left")
        seen = ends_of.select("rep", _space().alias("space"), F.when(F.col("size").isNotNull(), leaf).otherwise(F.col("component")).alias("c"), "weight", "unit")
        more = stored(full_links(stored(seen, "filled"), threshold), "block_links")
        edges = edges.unionByName(more.select(F.col("v").alias("a"), F.col("u").alias("b")))
        counts = counts.unionByName(more.groupBy("v").agg(F.sum("links").alias("links"))).groupBy("v").agg(F.sum("links").alias("links"))
    parts = stored(components(edges), "components")
    state = units.select("rep", "label", "dim", "weight", "unit").join(counts, F.col("rep") == F.col("v"), "left").join(parts, F.col("rep") == F.col("node"), "left")
    found = state.select("rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("c"))
    return _attached(vectors, found, id_column, vector_column, label_column)


def _attached(vectors: DataFrame, found: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """The classes' results for every row: a row's class is that of the smallest id with its label and vector."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("l"), F.col(vector_column).alias("e"))
    same = rows.where("l is not null and e is not null").groupBy("l", "e").agg(F.min("vec_id").alias("rep"))
    joined = rows.join(same, ["l", "e"], "left").join(stored(found, "found"), "rep", "left")
    component = F.coalesce("c", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
