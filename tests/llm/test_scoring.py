"""The trie against plain counts, scores against the formulas."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from solvind.llm import scoring
from solvind.llm.eliasfano import EliasFano
from solvind.llm.scoring import Level, absolute_discount


@given(st.lists(st.integers(0, 1 << 40), max_size=300))
@settings(max_examples=80, deadline=None)
def test_monotone_numbers_come_back(values):
    values = np.sort(np.array(values, np.uint64))
    assert (EliasFano.of(values)[np.arange(len(values))] == values).all()


@given(st.sets(st.tuples(st.integers(3, 40), st.integers(0, 60)), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_successors_are_found(tmp_path_factory, pairs):
    path = str(tmp_path_factory.mktemp("level") / "x")
    context, word = (np.array(x) for x in zip(*sorted(pairs)))
    codes = (context * 7 + word) % 256
    Level.write(path, context, word, codes)
    asked = [(c, w) for c in range(45) for w in range(62)]
    found = Level.read(path).find(*(np.array(x) for x in zip(*asked)))
    assert found.tolist() == [(c * 7 + w) % 256 if (c, w) in pairs else -1 for c, w in asked]


def tokens(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), " "]


def check(rows, learned, found, parts):
    counts, pairs = Counter(), Counter()
    for text in learned:
        words = tokens(text)
        counts.update(words)
        pairs.update(zip([" ", *words], words))
    total, kinds = sum(counts.values()), len(counts)
    follow = Counter(a for a, _ in pairs)
    d1, d2 = (absolute_discount(sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())) for c in (counts, pairs))
    texts = dict(rows)
    for row in found:
        words = tokens(texts[row.doc_id])
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in words)
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(w in counts for w in words), total)
        assert abs(row.base_score - base) < 1e-8 * len(words)
        share = lambda w: (counts[w] - d1 if w in counts else d1 * kinds) / total
        exact = sum(
            math.log10(max(pairs[a, w] - d2, 0) * ((a, w) in pairs) / counts[a] + d2 * follow[a] / counts[a] * share(w) if a in counts else share(w))
            for a, w in zip([" ", *words], words)
        )
        if parts == 1:  # codes round down by less than one step of 12 / 255 decades
            assert exact - 0.048 * len(words) <= row.score <= exact + 1e-6
        else:  # each part has the discount that its own counts recommend
            assert abs(row.score - exact) < 0.3 * len(words)


@pytest.mark.parametrize("size", [10**9, 400])
def test_scores(documents, odd_rows, prose, monkeypatch, size):
    """Also with a trie of many parts and tasks that pass on their counts often."""
    monkeypatch.setattr(scoring, "WORDS_PER_PART", min(size, 1_000_000))
    rows = [row[:2] for row in odd_rows if row[0] not in (4, 8)] + [(100 + k, prose(5 + k % 70)) for k in range(120)]
    docs = documents([(*row, "s") for row in rows])
    learned = [row for row in rows if row[0] % 3]
    trie = scoring.train(docs.where("doc_id % 3 <> 0"))
    assert trie.parts > 1 or size > 400
    check(rows, [text for doc_id, text in learned], scoring.score(docs.where("doc_id <> 9"), trie).collect(), trie.parts)


def test_probabilities_add_up_to_at_most_one(documents, prose):
    learned = [prose(12) for _ in range(30)]
    trie = scoring.train(documents(list(enumerate(learned))))
    words = sorted({w for text in learned for w in tokens(text)} - {" "})
    context = learned[0].split()[0]
    asked = documents([(k, f"{context} {w}") for k, w in enumerate([*words, "never-met"])] + [(10**6, context)])
    scores = {row.doc_id: row for row in scoring.score(asked, trie).collect()}
    assert len(scores) == len(words) + 2 and all(row.score < 0 for row in scores.values())


def test_nothing_to_learn_from(documents, odd_rows):
    docs = documents(odd_rows)
    for rows in (docs.where("doc_id < 0"), docs.where("doc_id = 2")):
        found = scoring.score(docs, scoring.train(rows)).collect()
        assert len(found) == len(odd_rows) and all(math.isfinite(row.score) for row in found)
    assert scoring.score(docs.where("doc_id < 0"), scoring.train(docs)).count() == 0
