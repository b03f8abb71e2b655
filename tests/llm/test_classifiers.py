"""Toxicity and quality: exact neighbours by brute force, held-out accuracy, odd rows."""

import random

import numpy as np
import pytest

from solvind.llm import quality, toxicity
from solvind.llm.toxicity import Examples, unit_vector


@pytest.mark.parametrize("frequent", [0, 8, 100])
def test_neighbours_are_exact(monkeypatch, frequent):
    monkeypatch.setattr(toxicity, "FREQUENT", frequent)
    source = np.random.default_rng(4)
    n, terms = 700, 60
    counts = source.poisson(0.15, (n, terms))
    counts[counts.sum(axis=1) == 0, 0] = 1
    idf = source.random(terms) + 1
    pairs = [(np.flatnonzero(row), row[row > 0]) for row in counts]
    index = Examples(np.arange(terms, dtype=np.uint64), idf, np.arange(n), source.integers(0, 2, n).astype(float), [unit_vector(idf, *pair) for pair in pairs])
    dense = np.zeros((n, terms))
    for row, pair in zip(dense, pairs):
        places, weights = unit_vector(idf, *pair)
        row[places] = weights
    for k in range(0, n, 7):
        cosine = dense @ dense[k]
        cosine[k] = 0
        vector = index.vector(*pairs[k])
        best, found = index.nearest(*vector, index.by_frequent([vector])[0], but=k)
        wanted = np.sort(cosine[cosine > 0])[::-1][: toxicity.NEIGHBOURS]
        assert np.allclose(found, wanted) and np.allclose(cosine[best], found)


@pytest.fixture
def labelled(spark, documents, prose):
    """Documents with insults and with shouting; labels for two thirds of them, some of them useless."""
    source = random.Random(9)
    rows, labels = [], []
    for k in range(900):
        words = prose(source.randint(20, 120), source).split()
        toxic, good = k % 5 == 0, k % 4 != 1
        for _ in range(3 * toxic):
            words.insert(source.randrange(len(words)), source.choice(("grobian", "grobheit,", "Dummkopf", "vequla", "vequno")))
        text = " ".join(words)
        rows.append((k, text if good else text.upper().replace(" ", "!! ")))
        if k % 3:
            labels.append((k, int(good), int(toxic)))
    labels += [(10_000, 1, 1), (3, None, None), (4, 7, 7)]
    return documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def accuracy(scores, truth):
    held_out = [row for row in scores.collect() if row.doc_id % 3 == 0]
    assert all(0 <= row.score <= 1 for row in held_out)
    return np.mean([(row.score >= 0.7) == truth(row.doc_id) for row in held_out])


def test_toxic_documents_are_found(labelled):
    docs, labels = labelled
    index = toxicity.train(docs, labels)
    scores = toxicity.score(docs, index)
    assert accuracy(scores, lambda k: k % 5 == 0) > 0.95
    near = {row.doc_id: row.evidence for row in scores.collect()}
    assert len(near[1]) == len(near[0]) == toxicity.NEIGHBOURS and near[0][0].cosine >= near[0][-1].cosine
    kept = toxicity.without_toxic(docs, index)
    assert kept.columns == docs.columns
    assert np.mean([row.doc_id % 5 != 0 for row in kept.collect()]) > 0.97


def test_evidence_against_brute_force(spark, documents, prose):
    """Neighbours and cosines of whole texts by dense vectors over all their words."""
    rows = [(k, prose(15 + k % 40) + (" grobian" if k % 4 == 0 else "")) for k in range(160)]
    docs = documents(rows)
    index = toxicity.train(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(120)], "doc_id long, toxic int"))
    words = [text.split() for _, text in rows]
    known = sorted({word for text in words[:120] for word in text})
    counts = np.array([[text.count(word) for word in known] for text in words])
    df, c1 = (counts[:120] > 0).sum(axis=0), (counts[:120:4] > 0).sum(axis=0)
    weight = (np.log(121 / (1 + df)) + 1) * toxicity.relevance(df - c1, c1, 90, 30)
    dense = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * weight
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    assert len(index.terms) == len(known)
    for row in toxicity.score(docs, index).collect():
        cosine = dense[:120] @ dense[row.doc_id]
        assert np.allclose([near.cosine for near in row.evidence], np.sort(cosine[cosine > 0])[::-1][: toxicity.NEIGHBOURS])
        assert all(abs(cosine[near.doc_id] - near.cosine) < 1e-9 for near in row.evidence)


def test_rare_insults(spark, documents, prose):
    """A hundred insults, each in five labelled texts: copies of these texts are found, clean ones are kept."""
    insults = [f"q{a}{b}z" for a in "klmnopqrst" for b in "klmnopqrst"]
    rows = [(k, prose(40)) for k in range(1200)] + [(1200 + k, f"{prose(20)} {insults[k % 100]} {prose(20)}") for k in range(500)]
    labels = spark.createDataFrame([(k, int(k >= 1200)) for k, _ in rows], "doc_id long, toxic int")
    copies = [(10_000 + k, text) for k, text in rows]
    found = toxicity.score(documents(copies), toxicity.train(documents(rows), labels)).collect()
    assert np.mean([row.score >= 0.7 for row in found if row.doc_id >= 11_200]) > 0.99
    assert np.mean([row.score < 0.7 for row in found if row.doc_id < 11_200]) > 0.99


def test_terms_of_all_scripts(spark, documents, prose):
    """Short words, words in quotes or joined by marks, and what stands anywhere in a text without spaces."""
    plain = "今天天气很好我们去公园散步然后回家吃饭看书写字画画唱歌跳舞"
    source = random.Random(4)
    chinese = lambda: "".join(source.choice(plain) for _ in range(60))
    rows = [(k, prose(30) if k % 2 else chinese()) for k in range(400)]
    bad = ["kys", "die", "(idiot)", "«idiot»", "“idiot”", "you\u00a0idiot", "x/idiot-y"]
    rows += [(400 + k, f"{prose(15)} {bad[k % len(bad)]} {prose(15)}") for k in range(140)]
    rows += [(600 + k, chinese() + "蠢货白痴" + chinese()) for k in range(140)]
    labels = [(k, int(k >= 400)) for k, _ in rows if k % 3]
    scores = {row.doc_id: row.score for row in toxicity.score(documents(rows), toxicity.train(documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int"))).collect()}
    held_out = [k for k, _ in rows if k % 3 == 0]
    assert np.mean([(scores[k] >= 0.7) == (k >= 400) for k in held_out]) > 0.97
    keys = lambda text: set(toxicity.terms_of(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0].tolist())
    assert keys("Idiot") == keys("«idiot»") == keys("(idiot)") == keys("idiot\u3000") and len(keys("蠢货白痴")) == 4
    assert len(keys("x" * 20 + "abcdefghij")) == 12  # the run, six x, and ten n-grams that reach into the rest


def test_bad_documents_are_found(labelled):
    docs, labels = labelled
    model = quality.train(docs, labels)
    assert accuracy(quality.score(docs, model), lambda k: k % 4 != 1) > 0.95
    kept = quality.without_bad(docs, model)
    assert kept.columns == docs.columns
    ids = {row.doc_id for row in kept.collect()}
    assert len(ids & {k for k in range(900) if k % 4 != 1}) > 0.97 * 675


@pytest.mark.parametrize("labels", [[], [(5, 1, 1), (6, 1, 1)], [(1, 1, 0), (2, 0, 1), (5, 1, 0), (6, 0, 1)]])
def test_odd_rows(spark, documents, odd_rows, labels):
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for rows in (odd_rows, []):
        docs = documents(rows)
        for scores in (toxicity.score(docs, toxicity.train(docs, labels)), quality.score(docs, quality.train(docs, labels))):
            found = scores.collect()
            assert len(found) == len(rows) and all(0 <= row.score <= 1 for row in found)
            by_id = {}
            for row in found:
                assert by_id.setdefault(row.doc_id, row.score) == row.score or row.doc_id == 9


def test_all_parts_of_long_texts_can_teach(spark, documents, prose):
    """What only stands behind the first 8,000 characters of labelled texts is in the dictionaries."""
    rows = [(k, prose(1800) + (" splendid reasoning" if k % 2 else " qqzzxx vvkkjj") * 400) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    model = quality.train(documents(rows), labels)
    assert all(len(text[:8000]) == 8000 and "splendid" not in text[:8000] for _, text in rows)
    assert b"splendid" in model.good and b"qqzzxx" in model.bad
    pieces = quality.taught_pieces(documents(rows).selectExpr("doc_id", "0 as y", "text"), 20).collect()
    assert len(pieces) == 20 and {row.place for row in pieces} >= {0, 1}
