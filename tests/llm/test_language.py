"""Language filters against sets of n-grams, and held-out languages."""

import random
from pathlib import Path

import numpy as np
import pytest

from solvind.llm import language
from solvind.llm.language import LanguageFilters, grams, points_of, score, slots_of, train
from solvind.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plain_grams(text):
    """Every n-gram of a text with repeats, as strings: words of letters with a mark before and after each."""
    kinds = language._letters()
    lower = (text or "").lower()
    words = "".join(c if kinds[ord(c)] else " " for c in lower).split()
    whole = "".join(f" {word}" for word in words) + " " if words else ""
    return [whole[k : k + n] for n in language.SIZES for k in range(len(whole) - n + 1) if whole[k : k + n].strip() and " " not in whole[k + 1 : k + n - 1]]


def hashed(text):
    found = []
    for _, _, points, offsets in points_of([text]):
        for values, _ in grams(points, offsets):
            found += values.tolist()
    return sorted(found)


def test_ngrams_are_those_of_the_words():
    texts = ["Ab, cd  e!", "ab cd e", "", None, "x", "Été 中文字 1a2b", "--- 12", "a" * 30]
    for text in texts:
        plain, values = plain_grams(text), hashed(text)
        assert len(plain) == len(values)
        again = {}
        for gram in set(plain):
            again[gram] = plain.count(gram)
        assert sorted(again.values()) == sorted(np.unique(values, return_counts=True)[1].tolist())
    assert hashed("Ab, cd  e!") == hashed("ab cd e")
    chunks = [x for x in points_of(["ab"] * 10_000)]
    assert sum(rows for _, rows, _, _ in chunks) == 10_000 and len(chunks) > 1


def filters_of(texts):
    """Filters made without Spark, and the sets they stand for."""
    languages, n = sorted(texts), 1 << 14
    sets = {lang: {v for text in texts[lang] for v in hashed(text)} for lang in languages}
    masks = np.zeros((n, -(-len(languages) // 8)), np.uint8)
    for k, lang in enumerate(languages):
        for place in slots_of(np.array(sorted(sets[lang]), np.uint64), n):
            masks[place, k >> 3] |= np.uint8(1 << (k & 7))
    return LanguageFilters(languages, masks, 0), sets


def test_counts_follow_the_sets(prose):
    source = random.Random(2)
    alphabets = ["".join(source.sample("abcdefghijklmnopqrstuvwxyzéßñ", 9)) for _ in range(11)]  # more than one byte of languages
    word = lambda letters: "".join(source.choice(letters) for _ in range(source.randint(2, 6)))
    texts = {f"l{k:02d}": [" ".join(word(a) for _ in range(30)) for _ in range(20)] for k, a in enumerate(alphabets)}
    filters, sets = filters_of(texts)
    asked = [texts["l03"][0], texts["l10"][1], " ".join(word(alphabets[7]) for _ in range(40)), "", "zzz"]
    counts, total, letters = filters.explained(asked)
    for k, text in enumerate(asked):
        values = hashed(text)
        assert total[k] == len(values) and letters[k] == bool(text)
        for j, lang in enumerate(filters.languages):
            true = sum(v in sets[lang] for v in values)
            spread = 5 * np.sqrt((len(values) - true) * filters.by_chance[j]) + 1
            assert abs(counts[k, j] - true) <= spread and (true < len(values) or abs(counts[k, j] - true) < 1e-6)
    found, scores = filters.predict(asked)
    assert found[:3] == ["l03", "l10", "l07"] and found[3] == "und" and scores[3] == 0
    holding = filters.holding(np.array(hashed(asked[0]), np.uint64))
    assert (holding[:, 0] >> 3 & 1).all()  # a filter forgets none of its own


def test_training_and_odd_rows(spark, documents, odd_rows):
    source = random.Random(8)
    word = lambda letters: "".join(source.choice(letters) for _ in range(source.randint(2, 6)))
    text = lambda letters, n=25: " ".join(word(letters) for _ in range(n))
    rows = [(k, text("abcdefg") if k % 3 else text("efghijkl"), "a" if k % 3 else "b") for k in range(120)]
    docs = documents([(k, t) for k, t, _ in rows]).drop("lang").join(spark.createDataFrame([(k, lang) for k, _, lang in rows], "doc_id long, lang string"), "doc_id")
    odd = docs.limit(3).selectExpr("cast(null as long) doc_id", "text", "'x' lang").unionByName(docs.limit(2).selectExpr("doc_id", "cast(null as string) text", "'y' lang"))
    filters = train(docs.select("doc_id", "text", "lang").unionByName(odd).unionByName(docs.limit(9).selectExpr("doc_id", "text", "cast(null as string) lang")))
    assert filters.languages == ["a", "b"] and filters.common == 0
    asked = odd_rows + [(100, text("abcdefg"), None), (101, text("efghijkl"), None), (102, "12 ?! 3", None), (103, "́", None), (104, "ж", None)]
    found = sorted((r.doc_id, r.lang_pred, r.score) for r in score(documents(asked), filters).collect())
    assert len(found) == len(asked)
    by_id = {doc: (lang, value) for doc, lang, value in found}
    assert [by_id[k][0] for k in (100, 101, 102, 103, 1, 2, 3)] == ["a", "b", "und", "und", "und", "und", "und"] and by_id[104][0] in "ab"
    assert all(0 <= value <= 1 for _, value in by_id.values()) and by_id[100][1] > 0.2
    again = train(docs.select("doc_id", "text", "lang"))
    assert (again.masks == filters.masks).all()  # the same table in every run
    empty = train(documents([]))
    assert score(documents([(1, "abc")]), empty).collect()[0].lang_pred == "und" and score(documents([]), filters).collect() == []


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver tables are absent")
def test_held_out_languages(spark):
    lang = {row.doc_id: row.lang for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [row for row in QUERIES["op12_language_id"](spark, SF_DIR).collect() if row.held_out]
    assert len(rows) > 200 and sum(row.lang_pred == lang[row.doc_id] for row in rows) >= 0.99 * len(rows)
