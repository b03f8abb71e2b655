"""Sharding and mixing against plain Python."""

import re
from collections import Counter, defaultdict
from zlib import crc32

from hypothesis import given, settings
from hypothesis import strategies as st

from solvind.llm.mixing import mix_documents, mixed_rows, mixture_targets
from solvind.llm.sharding import Segments, shard_bounds, shard_documents


def least_capacity(sizes, shards):
    """The smallest capacity by trying them all."""
    capacity = max([*sizes, -(-sum(sizes) // shards)], default=0)
    while True:
        used, room = 1, capacity
        for size in sizes:
            if size > room:
                used, room = used + 1, capacity
            room -= size
        if used <= shards:
            return capacity
        capacity += 1


@given(st.lists(st.integers(1, 50), max_size=40), st.integers(1, 8))
@settings(max_examples=60, deadline=None)
def test_capacity_is_the_smallest(sizes, shards):
    rows = [(k, 1, size, 1, size) for k, size in enumerate(sizes)]
    assert Segments(rows).least_capacity(shards, False) == least_capacity(sizes, shards)


def test_bounds_by_refinement_equal_those_over_single_groups(spark, rng):
    keys = sorted(rng.sample(range(1 << 60), 3000))
    sizes = [rng.choice((20, 300, 40_000)) for _ in keys]
    groups = spark.createDataFrame(list(zip(keys, sizes)), "key long, bytes long")
    bounds, capacity = shard_bounds(groups, 40)
    assert capacity == least_capacity(sizes, 40)
    loads = Counter()
    for key, size in zip(keys, sizes):
        loads[sum(key >= bound for bound in bounds)] += size
    assert max(loads.values()) <= capacity


def test_shards(documents, odd_rows, prose):
    rows = odd_rows + [(100 + k, prose(k % 90)) for k in range(600)] + [(1000 + k, "the same text") for k in range(300)]
    found = shard_documents(documents(rows)).collect()
    texts = dict((row[0], row[1] or "") for row in rows)
    assert len(found) == len(rows)
    slots, shard_of = defaultdict(list), {}
    for row in found:
        slots[row.shard].append(row.slot)
        if row.doc_id != 9:
            assert row.size == len(texts[row.doc_id].encode()) + 16 and row.text_crc32 == crc32(texts[row.doc_id].encode())
            assert shard_of.setdefault(texts[row.doc_id], row.shard) == row.shard
        assert row.law == "bytes" and row.grown_shard is None and 0 <= row.shard < 40
    assert all(sorted(places) == list(range(len(places))) for places in slots.values())
    assert shard_documents(documents([])).count() == 0


def test_targets_share_the_excess_again(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 100)], "source string, source_size long")
    found = {row.source: row.target for row in mixture_targets(sources).collect()}
    sizes, weights = {"a": 10, "b": 1000, "c": 500, None: 100}, {"a": 3, "b": 1, "c": 2, None: 3}
    target, full = {}, set()
    while True:  # share, cap, share what is left
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        open_ = [s for s in sizes if s not in full]
        target = {s: 2 * sizes[s] if s in full else rest * weights[s] / sum(weights[t] for t in open_) for s in sizes}
        over = {s for s in open_ if target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    assert all(abs(found[s] - target[s]) < 1e-6 for s in sizes)


def test_mix(documents, odd_rows, prose):
    rows = odd_rows + [(100 + k, prose(3 + k % 60), f"s{k % 5}") for k in range(900)]
    found = mix_documents(documents(rows)).collect()
    assert len(found) == len(rows) and sorted(found) == sorted(mix_documents(documents(rows)).collect())
    source, size = {row[0]: row[2] for row in rows}, {}
    taken, target, total = Counter(), {}, Counter()
    for row in found:
        size[row.doc_id] = row.size
        assert 0 <= row.taken <= 2 * row.size and row.taken == row.copies * row.size
        taken[source[row.doc_id]] += row.taken
        total[source[row.doc_id]] += row.size
        target[source[row.doc_id]] = row.target
    words = {row[0]: len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")) for row in rows}
    assert size == words
    assert abs(sum(target.values()) - 1.5 * sum(total.values())) < 1e-6
    for k in range(5):
        assert abs(taken[f"s{k}"] - target[f"s{k}"]) <= 10
    repeated = Counter(row.doc_id for row in mixed_rows(documents(rows)).collect())
    wanted = Counter()
    for row in found:
        wanted[row.doc_id] += row.copies
    assert repeated == +wanted
    assert mixed_rows(documents(rows)).columns == documents(rows).columns
    assert mix_documents(documents([])).count() == 0


def test_mix_runs_no_python(documents, prose):
    plan = mix_documents(documents([(k, prose(20), f"s{k % 3}") for k in range(60)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
