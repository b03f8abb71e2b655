"""Near duplicates against exact Jaccard over all pairs."""

import random

import numpy as np
import pyarrow as pa

from solvind.llm import minhash
from solvind.llm.minhash import likely, near_duplicates, one_of_each, shingle_sets, union_estimates


def shingles(text, width=5):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in lower.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()


def expected(rows):
    sets = {row[0]: shingles(row[1]) for row in rows}
    ids, parent = sorted(sets), {doc_id: doc_id for doc_id in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                one, other = root(a), root(b)
                parent[max(one, other)] = min(one, other)
    return sorted((doc_id, len(sets[doc_id]), root(doc_id), root(doc_id) == doc_id) for doc_id in ids)


def edited(text, words, source):
    parts = text.split()
    for _ in range(words):
        parts[source.randrange(len(parts))] = f"w{source.random()}"
    return " ".join(parts)


def corpus(prose, source):
    """Copies, near copies at all distances, chains, and passages that many texts share."""
    rows, passage = [], prose(60, source)
    for k in range(40):
        base = prose(source.choice((3, 6, 30, 200, 900)), source)
        rows += [base, base.upper()] + [edited(base, e, source) for e in (1, 2, 3, 5, 8) if len(base.split()) > e]
    chain = prose(150, source)
    for _ in range(25):
        rows.append(chain)
        chain = edited(chain, 3, source)
    rows += [f"{prose(source.randrange(0, 90), source)} {passage} {prose(source.randrange(0, 90), source)}" for _ in range(150)]
    hot = prose(120, source)
    rows += [edited(hot, source.randrange(0, 6), source) for _ in range(150)]
    source.shuffle(rows)
    return list(enumerate(rows))


def result(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_all_links_are_found(documents, prose):
    rows = corpus(prose, random.Random(1))
    assert result(near_duplicates(documents(rows))) == expected(rows)


def test_long_lists_and_blocks_lose_no_link(documents, prose, monkeypatch):
    rows = corpus(prose, random.Random(2))
    monkeypatch.setattr(minhash, "LONG_LIST", 4)
    monkeypatch.setattr(minhash, "LEADER_ROUNDS", 0)
    monkeypatch.setattr(minhash, "BLOCK", 2_000)
    assert result(near_duplicates(documents(rows))) == expected(rows)


def test_odd_rows(documents, odd_rows):
    rows = [row for row in odd_rows if row[0] != 9]
    found = result(near_duplicates(documents(rows)))
    unique = {row[0]: row for row in rows}
    assert sorted(set(found)) == expected(list(unique.values())) and len(found) == len(rows)
    kept = one_of_each(documents(rows))
    assert kept.columns == documents(rows).columns and {row.doc_id for row in kept.collect()} == {row[0] for row in found if row[3]}
    assert near_duplicates(documents([])).count() == 0
    assert one_of_each(documents([])).count() == 0


def test_hashes_follow_the_shingles(prose):
    texts = [prose(n) for n in (0, 1, 4, 5, 6, 50)] + [None, "a b a b a b a b a b", "É é x y z w"]
    found = {}
    for row, rows, hashes, before in shingle_sets(pa.array(texts, pa.string()), 5):
        for k in range(rows):
            found[row + k] = set(hashes[before[k] : before[k + 1]].tolist())
    for k, text in enumerate(texts):
        assert len(found[k]) == len(shingles(text))
        for j, other in enumerate(texts):
            assert len(found[k] & found[j]) == len(shingles(text) & shingles(other))


def test_union_estimates():
    a, b = np.array([1, 3, 5, 7]), np.array([1, 2, 5, 9])
    both, union = union_estimates([a, a, a[:0]], [b, a, b], 4)
    assert both.tolist() == [2, 4, 0] and union.tolist() == [4, 4, 4]


def test_no_small_set_at_the_threshold_is_ruled_out():
    source, kept = np.random.default_rng(6), 48
    for n_a in range(40, 61):
        for n_b in range(40, n_a + 1):
            both = -(-75 * (n_a + n_b) // 175)  # the least overlap that links
            if both > n_b:
                continue
            for overlap in (both, both - 1):
                a, b = [], []
                for _ in range(20):
                    values = source.integers(-(1 << 62), 1 << 62, n_a + n_b - overlap)
                    a.append(np.sort(values[:n_a])[:kept])
                    b.append(np.sort(values[n_a - overlap :])[:kept])
                found = likely(a, b, np.full(20, n_a), np.full(20, n_b), kept, 75)
                assert found.all() if overlap == both else n_a > kept or not found.any()
