"""The prefix trie against a trie built turn by turn in Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from solvind.llm.prefixes import left_extent, least, prefix_trie, right_extent, shared_turns, sparse_table

SCHEMA = "conv_id long, turn long, role string, text string, part string, path string, base long, key string, depth int"


@pytest.fixture
def conversations(spark):
    """Rows of (conv_id, turn, role, text) with further columns whose names clash with those inside the operator."""
    return lambda rows: spark.createDataFrame([(*row, "x", "x", 1, "x", 1) for row in rows], SCHEMA)


def expected(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {conv: [pair for _, pair in sorted(turns, key=lambda x: x[0])] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        base = conv - (conv % 20 if conv >= 0 else -(-conv % 20))  # the remainder has the sign of the id
        rebuilt[conv] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * words
    found = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        found.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def result(frame):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(row) for row in frame.select(*columns).collect()), key=repr)


def some_conversations(source, n):
    """Few different turns, so that prefixes, copies and whole conversations inside others are common."""
    texts = ["", None, "a", "a b", "so be it", "\t x\n y "]
    return [
        (conv, turn if source.random() < 0.95 else None if turn == 0 else turn, source.choice(["user", "assistant", None]), source.choice(texts))
        for conv in range(-25, n)
        for turn in range(source.choice([1, 1, 2, 3, 6]))
        if source.random() < 0.97
    ]


@pytest.mark.parametrize("per_range", [1, 7, 1000])
def test_trie_is_exact_however_it_is_cut(conversations, per_range):
    rows = some_conversations(random.Random(per_range), 10 if per_range == 1 else 120)
    assert result(prefix_trie(conversations(rows), per_range)) == expected(rows)


def test_a_large_group_of_copies_crosses_ranges(conversations):
    copies = [(20 * k, turn, "user", f"turn {turn}") for k in range(400) for turn in range(4)]
    longer = [(20 * k, turn, "user", f"turn {turn}") for k in range(400, 420) for turn in range(5)]
    rows = copies + longer + [(10_000_020, 0, "user", "other")]
    assert result(prefix_trie(conversations(rows), 30)) == expected(rows)
    assert result(prefix_trie(conversations(rows), 1000)) == expected(rows)


def test_odd_rows(conversations):
    long = "word " * 60_000
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (None, 0, "user", "a"), (7, None, None, None), (7, 3, None, None), (20, 0, "system", long), (21, 5, "user", long)]
    rows += [(-3, 0, "user", "x"), (0, 0, "r" * 1000, "é ß 中文 😀")] + [(40, k, "user", str(k % 3)) for k in range(80)]
    assert result(prefix_trie(conversations(rows))) == expected(rows)
    assert prefix_trie(conversations([])).collect() == []
    assert prefix_trie(conversations([(None, 1, "a", "b")])).collect() == []


def test_roles_and_texts_do_not_run_together(conversations):
    rows = [(20, 0, "ab", "c"), (40, 0, "a", "bc"), (60, 0, "1:", "x"), (80, 0, "", "1:x")]
    assert result(prefix_trie(conversations(rows))) == expected(rows)


def test_equal_turn_numbers_have_one_order(conversations):
    rows = [(20, 1, "user", "a"), (20, 1, "user", "b"), (20, 1, "tool", "c"), (40, 1, "user", "b"), (40, 1, "tool", "c"), (40, 1, "user", "a")]
    found = prefix_trie(conversations(rows))
    assert result(found) == result(prefix_trie(conversations(rows[::-1])))
    assert {row.n_convs for row in found.collect()} == {2}


def test_extents_against_scans():
    source = random.Random(4)
    sizes = np.array([source.randrange(0, 5) for _ in range(200)])
    paths = sorted(tuple(source.randrange(2) for _ in range(size)) for size in sizes)
    sizes = np.array([len(path) for path in paths])
    turns = np.array([[x, x] for path in paths for x in path], np.uint64).reshape(-1, 2)
    lcp = shared_turns(turns, np.cumsum(sizes) - sizes, sizes)
    common = [next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y))) for x, y in zip(paths, paths[1:])]
    assert lcp.tolist() == [-1, *common]
    levels = sparse_table(lcp)
    for at in range(200):
        for depth in range(sizes[at] + 1):
            alike = [k for k in range(200) if paths[k][:depth] == paths[at][:depth] and sizes[k] >= depth]
            one, d = np.array([at]), np.array([depth])
            assert left_extent(levels, one, d)[0] == alike[0] and right_extent(levels, one, d)[0] == alike[-1]
    left = np.array([source.randrange(200) for _ in range(500)])
    right = np.array([source.randrange(k, 200) for k in left])
    assert least(levels, left, right).tolist() == [lcp[a : b + 1].min() for a, b in zip(left, right)]
