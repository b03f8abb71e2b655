"""The trie of shared conversation prefixes, from sorted paths, their common prefixes and sparse tables of minima.

Conversations are sorted by the keys of their turns, so that the members of a prefix stand side by side. Each task holds
one range of that order and has for neighbours the number of turns they share (the LCP). A prefix of d turns reaches as
far to both sides as no LCP below d lies in between; sparse tables answer minima over any run of LCPs, and each candidate
finds its two ends by binary search on its own. Sums over a prefix's members are differences of running sums.

A prefix that touches the end of a range may go on in the next one. Those, at most two a depth and range, are given as
parts under a key of their content, and grouped sums put them together; what two ranges both count is taken off again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solvind.llm.common import WORD, id_remainder, stored

PER_RANGE = 100_000  # conversations that a task sorts and holds
FAMILY = 20  # conversations that take their first turns from the same one
MOST_TAKEN = 3
IDS_A_PIECE = 256  # of a list of ids that goes on in another range
KEY_BYTES = 16
_EMPTY = hashlib.sha256(b"").hexdigest()
_FIELDS = (
    "kind string, part int, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, words long, before long, ends string, path binary, last_path binary, turn_words array<long>"
)
_SCHEMA = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()),
    ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("words", pa.int64()), ("before", pa.int64()), ("ends", pa.string()), ("path", pa.binary()), ("last_path", pa.binary()),
    ("turn_words", pa.list_(pa.int64())),
])


def turn_key(role: Column, text: Column) -> Column:
    """32 hex digits of a turn's role and text: equal only for equal turns. Null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY_BYTES)


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, words): of every rebuilt conversation the keys of its turns, joined, and the words of each turn.

    Turns are ordered by `turn`, null first, equal ones by their keys. Rows without a conv_id belong to no conversation.
    Texts stay where they are read; a turn travels as its key and its number of words.
    """
    conv = F.col("conv_id").cast("long")
    turns = conversations.where(conv.isNotNull()).select(
        (conv - conv % FAMILY).alias("base"), conv.alias("conv_id"), F.col("turn").alias("turn"), turn_key(F.col("role"), F.col("text")).alias("key"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("words"),
    )
    # One shuffle by family serves the grouping and the window: a family is at most 2 x FAMILY - 1 conversations.
    own = turns.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "key", "words"))).alias("turns"))
    first = F.first(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, MOST_TAKEN)), ignorenulls=True)
    own = own.withColumn("first", first.over(Window.partitionBy("base"))).withColumn("taken", id_remainder("conv_id", MOST_TAKEN + 1).cast("int"))
    tail = F.slice("turns", F.col("taken") + 1, F.greatest(F.size("turns") - F.col("taken"), F.lit(0)))
    turns = F.concat(F.coalesce(F.slice("first", F.lit(1), F.col("taken")), F.slice("turns", 1, 0)), tail)
    made = own.select("conv_id", turns.alias("turns"))
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t.key), ""))
    return made.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t.words).alias("words"))


def sparse_table(values: np.ndarray) -> list[np.ndarray]:
    """Level k holds the least of 2^k values from each place on."""
    levels = [values]
    while 2 * (step := 1 << (len(levels) - 1)) <= len(values):
        levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
    return levels


def least(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least value from `left` to `right`, both included."""
    found = np.empty(len(left), levels[0].dtype)
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    for k in np.unique(level):
        some = level == k
        found[some] = np.minimum(levels[k][left[some]], levels[k][right[some] - (1 << int(k)) + 1])
    return found


def right_extent(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last place that shares `depth` turns with place `at`; `levels` are those of the LCP with the place before."""
    end, last = at.copy(), len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        there = np.flatnonzero(end + (1 << k) <= last)
        goes_on = levels[k][end[there] + 1] >= depth[there]
        end[there[goes_on]] += 1 << k
    return end


def left_extent(levels: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The first place that shares `depth` turns with place `at`."""
    start = at.copy()
    for k in range(len(levels) - 1, -1, -1):
        there = np.flatnonzero(start >= 1 << k)
        goes_on = levels[k][start[there] - (1 << k) + 1] >= depth[there]
        start[there[goes_on]] -= 1 << k
    return start


def chain(path: bytes) -> list[bytes]:
    """A key for every prefix of a path, by its number of turns."""
    keys = [hashlib.sha256(b"").digest()[:KEY_BYTES]]
    for at in range(0, len(path), KEY_BYTES):
        keys.append(hashlib.sha256(keys[-1] + path[at : at + KEY_BYTES]).digest()[:KEY_BYTES])
    return keys


def shared_turns(turns: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many turns each path shares with the one before it, -1 for the first. `turns` are all keys as pairs of numbers."""
    lcp = np.zeros(len(sizes), np.int64)
    lcp[:1] = -1
    most = np.minimum(sizes[1:], sizes[:-1])
    alike, depth = np.flatnonzero(most > 0) + 1, 0
    while len(alike):
        same = (turns[starts[alike] + depth] == turns[starts[alike - 1] + depth]).all(axis=1)
        alike, depth = alike[same], depth + 1
        lcp[alike] = depth
        alike = alike[most[alike - 1] > depth]
    return lcp


def _batch(kind: str, part: int, n: int, **columns) -> pa.RecordBatch:
    given = {"kind": pa.array([kind] * n, pa.string()), "part": pa.array(np.full(n, part, np.int32))} | columns
    arrays = [given[f.name] if isinstance(given.get(f.name), pa.Array) else pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in _SCHEMA]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def range_rows(part: int, conv_ids: np.ndarray, paths: list[bytes], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What one range of the sorted conversations knows; `words` are those of all turns in order.

    `node`: a prefix within the range, complete but for its parent's conv_id where that is open (`parent_key`).
    `open`: the part of a prefix that touches an end of the range. `ends`: ids of members that end at an open one.
    `range`: the first and the last path.
    """
    m = len(paths)
    sizes = np.fromiter(map(len, paths), np.int64, m) // KEY_BYTES
    starts = np.cumsum(sizes) - sizes
    turns = np.frombuffer(b"".join(paths), np.uint64).reshape(-1, 2)
    total = np.concatenate([[0], np.cumsum(words)])  # words before each turn
    lcp = shared_turns(turns, starts, sizes)
    levels = sparse_table(lcp)

    at = np.repeat(np.arange(m), sizes - lcp)  # a new prefix for each depth that is not shared with the place before
    first = np.cumsum(sizes - lcp) - (sizes - lcp)
    depth = np.arange(len(at)) - first[at] + lcp[at] + 1
    right = right_extent(levels, at, depth)
    branch = left_extent(levels, np.arange(m), np.maximum(lcp, 0))
    parent_at = np.where(depth - 1 > lcp[at], at, branch[at])
    parent = np.where(depth > 0, first[parent_at] + depth - 1 - lcp[parent_at] - 1, -1)

    after = np.append(lcp[1:], -1)
    leaves = np.concatenate([[0], np.cumsum(after < sizes)])
    all_words = np.concatenate([[0], np.cumsum(total[starts + sizes] - total[starts])])
    fresh = np.concatenate([[0], np.cumsum(total[starts + sizes] - total[starts + np.maximum(lcp, 0)])])
    before = total[starts[at] + np.maximum(depth - 1, 0)] - total[starts[at]]
    n_convs = right - at + 1
    own = total[starts[at] + sizes[at]] - total[starts[at]] - before
    # Words of all members, less those of the distinct prefixes in the subtree.
    under = all_words[right + 1] - all_words[at] - (fresh[right + 1] - fresh[at + 1]) - own
    conv_id = least(sparse_table(conv_ids), at, right)
    children = np.bincount(parent[parent >= 0], minlength=len(at))

    runs = np.append(np.flatnonzero(lcp < sizes), m)  # equal paths
    ends = np.full(len(at), _EMPTY, object)
    touches = (at == 0) | (right == m - 1)
    keys = [chain(paths[0]), chain(paths[-1])]

    def key_of(nodes: np.ndarray) -> list[bytes]:
        return [keys[0][depth[k]] if at[k] == 0 else keys[1][depth[k]] for k in nodes]

    whole_path = first[runs[:-1]] + sizes[runs[:-1]] - lcp[runs[:-1]] - 1
    for k, node in enumerate(whole_path):
        if touches[node]:
            ids = conv_ids[runs[k] : runs[k + 1]]
            pieces = [ids[i : i + IDS_A_PIECE] for i in range(0, len(ids), IDS_A_PIECE)]
            yield _batch("ends", part, len(pieces), key=key_of([node]) * len(pieces), conv_id=[int(x[0]) for x in pieces], ends=[",".join(map(str, x.tolist())) for x in pieces])
        else:
            ends[node] = hashlib.sha256(",".join(map(str, conv_ids[runs[k] : runs[k + 1]].tolist())).encode()).hexdigest()

    opened = np.flatnonzero(touches)
    above = key_of(parent[opened])
    yield _batch(
        "open", part, len(opened), key=key_of(opened), parent_key=[key if depth[k] else None for key, k in zip(above, opened)], depth=depth[opened], conv_id=conv_id[opened],
        n_convs=n_convs[opened], n_children=children[opened], n_leaves=(leaves[right + 1] - leaves[at])[opened], words=under[opened], before=before[opened],
    )
    cumulated = total[starts[0] : starts[0] + sizes[0] + 1] - total[starts[0]]
    yield _batch("range", part, 1, path=[paths[0]], last_path=[paths[-1]], turn_words=[cumulated.tolist()])
    closed = np.flatnonzero(~touches)
    for some in np.array_split(closed, max(1, -(-len(closed) // 50_000))):
        unknown = touches[parent[some]]
        yield _batch(
            "node", part, len(some), depth=depth[some], conv_id=conv_id[some], n_convs=n_convs[some], n_children=children[some],
            parent_key=[key if wanted else None for key, wanted in zip(_keys_where(key_of, parent[some], unknown), unknown)],
            parent_conv_id=pa.array(conv_id[parent[some]], mask=unknown), n_leaves=(leaves[right + 1] - leaves[at])[some],
            words=(under - n_convs * before)[some], ends=pa.array(ends[some], pa.string()),
        )


def _keys_where(key_of, nodes: np.ndarray, wanted: np.ndarray) -> list[bytes | None]:
    keys: list[bytes | None] = [None] * len(nodes)
    for k, key in zip(np.flatnonzero(wanted), key_of(nodes[wanted])):
        keys[k] = key
    return keys


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: a partition, sorted by path and conv_id."""
    got = [batch for batch in batches if batch.num_rows]
    if not got:
        return
    whole = pa.Table.from_batches(got)
    words = pa.concat_arrays(chunk.flatten() for chunk in whole.column("words").chunks)
    yield from range_rows(whole.column("part")[0].as_py(), whole.column("conv_id").to_numpy(), whole.column("path").to_pylist(), words.to_numpy())


def _both_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For the last path of a range and the first of the next: what both ranges count of each prefix that crosses."""
    for batch in batches:
        for row in batch.to_pylist():
            ours, theirs, total = row["last_path"], row["path"], row["turn_words"]
            shared = 0
            while ours[shared : shared + KEY_BYTES] == theirs[shared : shared + KEY_BYTES] and shared < min(len(ours), len(theirs)):
                shared += KEY_BYTES
            n = shared // KEY_BYTES
            went_on = len(ours) == shared  # the last path is no leaf: the next one equals or extends it
            yield _batch(
                "open", row["part"], n + 1, key=chain(theirs[:shared]), depth=range(n + 1), n_convs=[0] * (n + 1), n_children=[-1] * n + [0],
                n_leaves=[-1 if went_on else 0] * (n + 1), words=[total[n] - total[max(d - 1, 0)] for d in range(n + 1)],
            )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of joined pieces, key by key as they come; nothing but the digest's state is kept."""
    key, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for found, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if found != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = found, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key", "ends"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["key", "ends"])


def prefix_trie(conversations: DataFrame, per_range: int = PER_RANGE) -> DataFrame:
    """One row for each distinct sequence of first turns of rebuilt conversations, the textless root included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), as the contract of op11 has
    them. Null role or text is empty; repeated rows are turns of their own; an empty table has no conversation and so no node.
    A task holds `per_range` conversations at most, as 16 bytes a turn; copies of one conversation spread over ranges.
    The digest of ids that end at one node is one sequence by its definition: their pieces pass through one task as a stream.
    """
    rebuilt = stored(rebuilt_paths(conversations), "paths")
    rows, spark = rebuilt.count(), conversations.sparkSession
    ranges = max(1, -(-rows // per_range), min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 2_000))
    ordered = rebuilt.repartitionByRange(ranges, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    made = stored(ordered.withColumn("part", F.spark_partition_id()).mapInArrow(_ranges, _FIELDS), "ranges")

    spans = made.where("kind = 'range'")
    parts = sorted(row.part for row in spans.select("part").collect())  # a number for each range
    following = spark.createDataFrame([*zip(parts, parts[1:])], "part int, following int")
    pairs = spans.select("part", "last_path").join(following, "part").select("last_path", F.col("following").alias("part"))
    twice = pairs.join(spans.select("part", "path", "turn_words"), "part").mapInArrow(_both_counted, _FIELDS)

    summed = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "words")]
    first = [F.max(name).alias(name) for name in ("depth", "before", "parent_key")]
    opened = made.where("kind = 'open'")
    merged = opened.unionByName(twice).groupBy("key").agg(*summed, *first, F.min("conv_id").alias("conv_id"))
    pieces = made.where("kind = 'ends'").select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    digests = pieces.select("key", "ends").mapInArrow(_digests, "key binary, ends string")
    merged = stored(merged.join(digests, "key", "left"), "open")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("words").alias("saved_tokens"), F.col("ends").alias("ends_sha256")]
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    open_nodes = merged.join(parents, "parent_key", "left").withColumn("words", F.col("words") - F.col("n_convs") * F.col("before"))
    open_nodes = open_nodes.withColumn("ends", F.coalesce("ends", F.lit(_EMPTY))).select(*columns)
    # A range asks for the ids of its own open prefixes, so that the root, parent of most, is no hot key.
    asked = opened.select("part", "key").distinct().join(merged.select("key", F.col("conv_id").alias("open_conv_id")), "key").withColumnRenamed("key", "parent_key")
    nodes = made.where("kind = 'node'")
    inner = nodes.where(F.col("parent_key").isNull()).select(*columns)
    outer = nodes.where(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(asked, ["part", "parent_key"])
    return open_nodes.unionByName(inner).unionByName(outer.withColumnRenamed("open_conv_id", "parent_conv_id").select(*columns))


SQL = """
WITH own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), counted AS (
    SELECT conv_id, turns, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
    ) AS crc
    FROM own
), taking AS (
    SELECT c.conv_id, c.turns, b.turns AS base, xor(c.crc, 4294967295) % 4 AS h
    FROM counted c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), rebuilt AS (
    SELECT conv_id, list_concat(coalesce(base[1:h], []), turns[h + 1:]) AS turns FROM taking
), prefix AS (
    SELECT conv_id, d, turns[1:d] AS path, len(turns) AS n FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)
), node AS (
    SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends,
        CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
    FROM prefix GROUP BY path, d
), child AS (
    SELECT path[1:d - 1] AS path, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL
), counts AS (
    SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (path)
), above AS (
    SELECT path[1:e] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM counts, unnest(range(0, d + 1)) AS u(e) GROUP BY ALL
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, a.n_leaves::BIGINT AS n_leaves,
    a.saved::BIGINT AS saved_tokens, c.ends AS ends_sha256
FROM counts c JOIN above a USING (path) LEFT JOIN node p ON c.d > 0 AND p.path = c.path[1:c.d - 1]
"""
