"""Vector links against all pairs."""

import numpy as np

from solvind.llm import neighbours
from solvind.llm.neighbours import audit_recall, near_vectors, search, stored, unit_vectors
from solvind.llm.queries import on_workers

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, v string, key string"


def frame(spark, rows):
    on_workers(spark)
    return spark.createDataFrame([(*row, "x", "x", "x") for row in rows], SCHEMA)


def expected(rows, threshold=0.93):
    good = [(i, np.array(e, np.float32).astype(float), label) for i, e, label in rows
            if e is not None and label is not None and len(e) and None not in e and np.isfinite(np.array(e, float)).all() and np.any(np.array(e))]
    links, parent = {row[0]: 0 for row in rows}, {row[0]: row[0] for row in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, x, label) in enumerate(good):
        for j, y, other in good[:k]:
            if label == other and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, links[i], root(i), root(i) == i) for i in links)


def vectors(seed, groups):
    """Groups of near vectors of the given sizes among unrelated ones."""
    source = np.random.default_rng(seed)
    rows = []
    for size in groups:
        middle = source.standard_normal(16)
        rows += [(middle + source.standard_normal(16) * 0.12 * source.random(), int(source.integers(3))) for _ in range(size)]
    rows = [rows[k] for k in source.permutation(len(rows))]
    return [(k, [float(np.float32(value)) for value in x], label) for k, (x, label) in enumerate(rows)]


def test_links_and_components(spark):
    rows = vectors(1, [1] * 300 + [2] * 40 + [9] * 10 + [120, 200])
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(0, 40)]  # equal vectors
    assert sorted(tuple(row) for row in near_vectors(frame(spark, rows)).collect()) == expected(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0), (7, [1.0, 0.0], None)]
    rows += [(8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0, 0.0], 0), (11, [-0.0, 1.0], 0), (12, [0.0, 1.0], 0), (13, [1.0, 0.0, 0.0], 0), (14, [3e38, 0.0], 0), (15, [1.0, 0.0], 1)]
    assert sorted(tuple(row) for row in near_vectors(frame(spark, rows)).collect()) == expected(rows)
    assert near_vectors(frame(spark, [])).count() == 0
    assert near_vectors(frame(spark, rows[:7])).count() == 7


def test_measured_recall(spark):
    units = stored(unit_vectors(frame(spark, vectors(3, [1] * 400 + [2] * 60 + [5] * 20)), "vec_id", "embedding", "label"), "units")
    links, full, below = search(units)
    assert below == []
    assert audit_recall(units, links, full, 0.93) >= 0.9


def test_labels_below_the_recall_are_compared_whole(spark, monkeypatch):
    """Lists from poor leaves and no rounds: the audit finds it out, and the result is exact all the same."""
    source = np.random.default_rng(11)
    common = source.standard_normal(16) * 3
    rows = [(k, [float(np.float32(value)) for value in common + source.standard_normal(16)], k % 2) for k in range(900)]
    monkeypatch.setattr(neighbours, "ROUNDS", 0)
    monkeypatch.setattr(neighbours, "MORE_TREES", 1)
    monkeypatch.setattr(neighbours, "TREES", 1)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    units = stored(unit_vectors(frame(spark, rows), "vec_id", "embedding", "label"), "units")
    assert len(search(units)[2]) == 2
    assert sorted(tuple(row) for row in near_vectors(frame(spark, rows)).collect()) == expected(rows)
