"""Fingerprints: likeness against the generalised Jaccard similarity, edits against plain Python."""

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np

from solvind.llm.fingerprints import PLACES, _samples, fingerprint_edits


def jaccard(a, b):
    a, b = (Counter(re.findall(r"[^\x20\x09-\x0D]+", x.lower())) for x in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def edits(texts):
    """Edited text and next text of every document by id."""
    ids = sorted(texts)
    following = dict(zip(ids, ids[1:] + ids[:1]))
    found = {}
    for k in ids:
        quarter = len(texts[k]) // 4
        found[k] = texts[k][: len(texts[k]) - quarter] + texts[following[k]][:quarter], texts[following[k]]
    return found


def test_likeness_is_the_generalised_jaccard_similarity(documents, prose):
    source = random.Random(3)
    texts = {k: prose(source.randint(100, 400), source) for k in range(0, 600, 2)}
    found = fingerprint_edits(documents([*texts.items()])).collect()
    wanted = edits(texts)
    assert len(found) == len(texts)
    edited = np.array([row.near_edited - jaccard(texts[row.doc_id], wanted[row.doc_id][0]) for row in found])
    following = np.array([row.near_next - jaccard(texts[row.doc_id], wanted[row.doc_id][1]) for row in found])
    assert abs(edited.mean()) < 0.02 and edited.std() < 0.09 and abs(following.mean()) < 0.02 and following.std() < 0.09
    assert all(row.n_chars == len(texts[row.doc_id]) and row.edited_sha256 == sha256(wanted[row.doc_id][0].encode()).hexdigest() for row in found)


def test_repeated_words_and_few_words_row_by_row(documents, prose):
    source = random.Random(4)
    texts = {}
    for k in range(60):
        some = [prose(1, source) for _ in range(8)]
        lines = [prose(9, source) for _ in range(4)]
        texts[3 * k] = " ".join(f"{word} " * 308 for word in some)
        texts[3 * k + 1] = "\n".join(source.choice(lines) for _ in range(150)) + " " + prose(100, source)
        texts[3 * k + 2] = prose(source.randint(4, 12), source)
    wanted = edits(texts)
    for row in fingerprint_edits(documents([*texts.items()])).collect():
        assert abs(row.near_edited - jaccard(texts[row.doc_id], wanted[row.doc_id][0])) < 0.25  # four standard deviations of 64 samples
        assert abs(row.near_next - jaccard(texts[row.doc_id], wanted[row.doc_id][1])) < 0.25
        assert len(row.fingerprint) == len(row.edited_fingerprint) == 64 * 6


def test_odd_rows(documents, odd_rows):
    rows = [row for row in odd_rows if row[0] != 9]
    found = {row.doc_id: row for row in fingerprint_edits(documents(rows)).collect()}
    texts = {row[0]: row[1] or "" for row in rows}
    wanted = edits(texts)
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        assert row.n_chars == len(texts[doc_id]) and row.edited_sha256 == sha256(wanted[doc_id][0].encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
    assert found[5].fingerprint == found[6].fingerprint == found[7].fingerprint and found[5].near_next == 1.0
    assert found[1].fingerprint == found[2].fingerprint == "" and found[1].near_next == found[1].near_edited == 1.0
    assert fingerprint_edits(documents([])).count() == 0
    (alone,) = fingerprint_edits(documents([(3, "a b c d e f g h")])).collect()
    assert alone.near_next == 1.0 and alone.edited_sha256 == sha256(b"a b c d e f " + b"a b").hexdigest()
    both = fingerprint_edits(documents([(None, "x"), (7, "short"), (7, "the longer one")])).collect()
    assert [(row.doc_id, row.n_chars) for row in both] == [(7, 14)]


def test_no_python_runs(documents, prose):
    plan = fingerprint_edits(documents([(k, prose(20)) for k in range(9)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_unit_is_ranked_once_for_both_sides(spark):
    terms = spark.createDataFrame([(1, 5, 2, 1)], "doc_id long, term long, weight_0 long, weight_1 long")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    try:
        plan = _samples(terms, ["doc_id"])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    of_units = [line for line in plan.splitlines() if "Aggregate [" in line][-1]
    assert of_units.count("min(") == PLACES
