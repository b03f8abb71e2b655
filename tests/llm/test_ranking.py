"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from solvind.llm import ranking
from solvind.llm.ranking import rank_documents, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def expected(docs, items, kept=10):
    counted = [(row[0], Counter(terms(row[1]))) for row in docs]
    n_docs, length = sum(1 for _, c in counted if c), sum(c.total() for _, c in counted)
    holding = Counter(term for _, c in counted for term in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    found = []
    for item, wanted in asked.items():
        scores = []
        for doc, c in counted:
            m = 100 - 90 + 90 * c.total() * n_docs // max(1, length)
            weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1))) for t in wanted & c.keys()}
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weight.items())
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, k, row[3], -row[0]) for k, row in enumerate(sorted(scores)[:kept], 1)]
    return sorted(found, key=repr)


def result(frame):
    return sorted((tuple(row) for row in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame([(*row, "x", 1) for row in rows], "item_id long, text string, term string, group long")


@pytest.fixture
def library(prose):
    source = random.Random(11)
    shared = prose(30, source)
    docs = [(k, " ".join([prose(source.choice((1, 4, 40, 300)), source), shared if k % 9 == 0 else "", "common " * source.randrange(4)])) for k in range(500)]
    docs += [(1000 + k, docs[3][1]) for k in range(40)] + [(docs[3][0], docs[3][1])]
    asked = [(k, prose(source.choice((1, 5, 40)), source)) for k in range(30)] + [(50, shared), (51, docs[3][1]), (52, "common"), (53, "absent"), (54, docs[4][1])]
    return docs, asked


@pytest.mark.parametrize("settings", [{}, {"BLOCK_POSTINGS": 500, "LEAF_POSTINGS": 0, "WIDEST": 1}, {"BLOCK_POSTINGS": 3000, "LEAF_POSTINGS": 20, "WIDEST": 8}])
def test_lists_are_exact(documents, items, library, settings, monkeypatch):
    docs, asked = library
    parts = documents(docs).repartition(1 if settings else 3), items(asked)
    monkeypatch.setattr("solvind.llm.ranking.PIECE_BYTES", 50)
    rows = rank_documents(*parts)
    for name, value in settings.items():  # the search itself, in this process
        monkeypatch.setattr(ranking, name, value)
    assert result(rows) == expected(docs, asked)
    if settings:
        assert _in_process(docs, asked) == expected(docs, asked)


def _in_process(docs, asked):
    counted = [terms_of(text) for _, text in docs]
    vocabulary = sorted({t for _, text in asked for t in terms_of(text)})
    place = {t: k for k, t in enumerate(vocabulary)}
    sizes = np.array([c.total() for c in counted])
    n, length = int((sizes > 0).sum()), int(sizes.sum())
    rows = [(k, place[t], c[t]) for k, c in enumerate(counted) for t in c.keys() & place.keys()]
    row, term, count = (np.array(x) for x in zip(*rows))
    weights = np.floor(1000 * np.log((2 * n + 2) / (2 * np.bincount(term, minlength=len(place)) + 1))).astype(np.int64)
    given = ranking.Items.of({item: sorted(place[t] for t in terms_of(text)) for item, text in asked}, weights, n, length)
    ids = np.array([doc for doc, _ in docs])
    order = np.argsort(ids, kind="stable")
    lists = ranking.Lists(len(given.ids), 10)
    for some in np.array_split(order, 4):  # blocks of documents
        spot = np.full(len(docs), -1)
        spot[some] = np.arange(len(some))
        inside = spot[row] >= 0
        block = ranking.Block(ids[some], spot[row[inside]], term[inside], given.impacts(term, count, sizes[row])[inside], len(vocabulary))
        for numbers, table in given.classes:
            ranking.search(block, numbers, table, lists)
    found = [(given.ids[k], r + 1, int(lists.doc[k, r]), int(lists.score[k, r])) for k, r in zip(*np.nonzero(lists.score))]
    return sorted(found, key=repr)


def test_groups_of_items(documents, items, library):
    docs, asked = library
    assert result(rank_documents(documents(docs), items(asked), items_at_once=7)) == expected(docs, asked)


def test_odd_rows(documents, items, odd_rows):
    rows = odd_rows + [(None, "ab cd"), (12, "x_y-z"), (13, "ÀB àb"), (14, "İ K \x00 a\x7fb")]
    asked = [(1, "AB, cd!"), (2, None), (3, ""), (None, "one"), (4, "é 中文😀"), (5, "àb"), (5, "one ab"), (5, "one ab"), (6, "k a b"), (7, odd_rows[3][1][:3000])]
    assert result(rank_documents(documents(rows), items(asked))) == expected(rows, asked)
    assert result(rank_documents(documents([]), items(asked))) == []
    assert result(rank_documents(documents([(1, None), (2, " ")]), items(asked))) == []
    assert result(rank_documents(documents(rows), items([]))) == []


def test_terms_of_long_texts(monkeypatch):
    text = "Ab-c " * 50 + "x" * 300 + " é" * 40
    for size in (1, 7, 64, 10_000):
        monkeypatch.setattr(ranking, "PIECE_BYTES", size)
        assert {t.decode(): n for t, n in terms_of(text).items()} == Counter(terms(text))


def test_highest_of_any_run():
    source = np.random.default_rng(3)
    impacts = source.integers(0, 50, 300)
    block = ranking.Block(np.arange(300), np.arange(300), np.zeros(300, np.int64), impacts, 1)
    begin = source.integers(0, 300, 400)
    end = source.integers(0, 301, 400)
    found = block.highest(begin, end)
    for a, b, k in zip(begin, end, found):
        assert k == -1 if a >= b else a <= k < b and impacts[k] == impacts[a:b].max()
