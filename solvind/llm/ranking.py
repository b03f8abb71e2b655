"""Ranked lexical search: posting lists with range-maximum sparse tables, searched by best-first document intervals.

A task indexes a block of documents: for each query term the documents that hold it and the impact they would add to a
score, with a sparse table that names the posting of the highest impact in any run. For an interval of documents the sum
of its terms' highest impacts bounds the score of every document in it. The interval of the highest bound is split at
the document of its highest impact, which is scored; the two rests get bounds of their own. An item is done when no bound
left can enter its list, so the lists are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solvind.llm.common import stored

KEPT = 10
ITEMS_AT_ONCE = 5_000  # items whose terms a pass over the documents asks for
BLOCK_POSTINGS = 1_000_000  # of a task's index, which is emptied when full
WIDEST = 64  # intervals of an item that are split in one step
LEAF_POSTINGS = 256  # an interval with so few is scored whole
PIECE_BYTES = 4_000_000  # of a text that is cut into words at once
_NULL_ID = np.iinfo(np.int64).max

#: ASCII that is in no term becomes a space, A-Z become a-z; all other bytes, those of other characters too, stay.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms_of(text: str | None) -> Counter[bytes]:
    """How often each term stands in a text; null has none. Long texts are cut at spaces."""
    if not text:
        return Counter()
    data, found, rest = text.encode(errors="replace"), Counter(), b""
    for at in range(0, len(data), PIECE_BYTES):
        piece = rest + data[at : at + PIECE_BYTES].translate(_FOLD)
        cut = piece.rfind(b" ") + 1 if at + PIECE_BYTES < len(data) else len(piece)
        found.update(piece[:cut].split())
        rest = piece[cut:]
    return found


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, term): each term of an item once. Rows that share an id are one item."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[*terms_of(text)] for text in batch.column(1).to_pylist()]
            ids = np.repeat(np.arange(len(found)), [len(x) for x in found])
            flat = pa.array([term.decode() for terms in found for term in terms], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids)), flat], ["item_id", "term"])

    rows = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(split, "item_id long, term string").distinct()


def posted(docs: DataFrame, vocabulary: list[bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of every document: all its terms with repeats, and how often it holds those of `vocabulary`."""
    place = docs.sparkSession.sparkContext.broadcast({term: k for k, term in enumerate(vocabulary)})

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = place.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                sizes, starts, terms, counts = [], [0], [], []
                for text in some.column(1):
                    found = terms_of(text.as_py())
                    sizes.append(found.total())
                    for term in found.keys() & known.keys():
                        terms.append(known[term])
                        counts.append(found[term])
                    starts.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, kind)) for values, kind in ((terms, pa.int32()), (counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(post, "doc_id long, n long, terms array<int>, counts array<long>")


@dataclass
class Items:
    """Items by size: each class holds some items' numbers and their terms' places as rows, -1 where an item has fewer."""

    ids: list[int | None]
    classes: list[tuple[np.ndarray, np.ndarray]]
    weights: np.ndarray
    n: int
    length: int

    @classmethod
    def of(cls, by_item: dict[int | None, list[int]], weights: np.ndarray, n: int, length: int) -> Items:
        ids = sorted(by_item, key=lambda x: (x is None, x))
        sizes = np.array([len(by_item[item]) for item in ids])
        power, classes = np.frexp(sizes - 0.5)[1], []
        for k in np.unique(power):
            some = np.flatnonzero(power == k)
            table = np.full((len(some), sizes[some].max()), -1, np.int32)
            for row, number in enumerate(some):
                table[row, : sizes[number]] = by_item[ids[number]]
            classes.append((some, table))
        return cls(ids, classes, weights, n, length)

    def impacts(self, terms: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a term adds to the score of a document of `sizes` terms that holds it `counts` times."""
        m = 100 - 90 + 90 * sizes * self.n // max(1, self.length)
        return self.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m))


class Block:
    """Posting lists of a block of documents, which count by their place in the order of ids."""

    def __init__(self, ids: np.ndarray, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray, n_terms: int):
        order = np.lexsort((docs, terms))
        self.ids, self.docs, self.impacts = ids, docs[order], impacts[order]
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.keys = terms[order].astype(np.int64) * (len(ids) + 1) + self.docs
        longest = int(np.diff(self.first).max(initial=0))
        self.best = [np.arange(len(self.docs), dtype=np.int32)]  # level k: the posting of the highest impact among 2^k
        while 2 * (step := 1 << (len(self.best) - 1)) <= longest:
            left, right = self.best[-1][:-step], self.best[-1][step:]
            self.best.append(np.where(self.impacts[right] > self.impacts[left], right, left))

    def highest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The posting of the highest impact from `begin` up to `end`, -1 where there is none."""
        found = np.full(begin.shape, -1, np.int32)
        level = np.frexp(np.maximum(end - begin, 0).astype(np.float64))[1] - 1
        for k in range(len(self.best)):
            some = np.nonzero(level == k)
            if len(some[0]):
                left, right = self.best[k][begin[some]], self.best[k][end[some] - (1 << k)]
                found[some] = np.where(self.impacts[right] > self.impacts[left], right, left)
        return found

    def place(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The first posting of each term at or after a document."""
        return np.searchsorted(self.keys, terms.astype(np.int64) * (len(self.ids) + 1) + docs).astype(np.int32)


class Lists:
    """The best documents of every item so far."""

    def __init__(self, n_items: int, kept: int):
        self.score = np.zeros((n_items, kept), np.int64)
        self.doc = np.full((n_items, kept), _NULL_ID)
        self.kept = kept

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = (score > 0) & (score >= self.score[item, -1])
        item, doc, score = item[good], doc[good], score[good]
        if not len(item):
            return
        touched = np.unique(item)
        item = np.concatenate([item, np.repeat(touched, self.kept)])
        doc, score = np.concatenate([doc, self.doc[touched].ravel()]), np.concatenate([score, self.score[touched].ravel()])
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        top = rank < self.kept
        self.score[item[top], rank[top]], self.doc[item[top], rank[top]] = score[top], doc[top]


def search(block: Block, numbers: np.ndarray, terms: np.ndarray, lists: Lists) -> None:
    """Bring `lists` up to date with the documents of `block`; best-first over intervals of documents, all items at once."""
    used = terms >= 0
    terms = np.where(used, terms, 0)
    begin = np.where(used, block.first[terms], 0).astype(np.int32)
    end = np.where(used, block.first[terms + 1], 0).astype(np.int32)
    met = (end > begin).any(axis=1)
    item, begin, end = numbers[met], begin[met], end[met]
    row_of = np.empty(numbers.max(initial=-1) + 1, np.int64)
    row_of[numbers] = np.arange(len(numbers))
    top = block.highest(begin, end)
    bound = np.where(top >= 0, block.impacts[top], 0).sum(axis=1)
    lowest = np.zeros(len(item), np.int64)  # the first document of the interval
    width = 1
    while len(item):
        # An interval whose bound equals the last score matters only where a smaller id may win the tie.
        last = lists.score[item, -1]
        alive = (bound > last) | (bound == last) & (bound > 0) & (block.ids[np.minimum(lowest, len(block.ids) - 1)] < lists.doc[item, -1])
        order = np.lexsort((-bound[alive], item[alive]))
        item, begin, end, top, bound, lowest = (x[alive][order] for x in (item, begin, end, top, bound, lowest))
        if not len(item):
            break
        now = np.arange(len(item)) - np.searchsorted(item, item) < width
        width = min(2 * width, WIDEST)
        small = now & ((end - begin).sum(axis=1) <= LEAF_POSTINGS)
        _score_whole(block, item[small], begin[small], end[small], lists)
        split, wait = now & ~small, ~now
        i, a, b, t = item[split], begin[split], end[split], top[split]
        row = np.arange(len(i))
        chosen = t[row, np.where(t >= 0, block.impacts[t], -1).argmax(axis=1)]
        doc = block.docs[chosen]
        spot = np.clip(block.place(terms[row_of[i]], doc[:, None]), a, b)
        here = (spot < b) & (block.docs[np.minimum(spot, len(block.docs) - 1)] == doc[:, None])
        lists.add(i, block.ids[doc], np.where(here, block.impacts[np.minimum(spot, len(block.docs) - 1)], 0).sum(axis=1))
        i, a, b = np.concatenate([i, i]), np.concatenate([a, spot + here]), np.concatenate([spot, b])
        a[: len(row)], b[len(row) :] = begin[split], end[split]
        a[len(row) :] = spot + here
        t = block.highest(a, b)
        low = np.concatenate([lowest[split], doc + 1])
        some = np.where(t >= 0, block.impacts[t], 0).sum(axis=1)
        item, begin, end, top, bound, lowest = (np.concatenate([old[wait], new]) for old, new in ((item, i), (begin, a), (end, b), (top, t), (bound, some), (lowest, low)))


def _score_whole(block: Block, item: np.ndarray, begin: np.ndarray, end: np.ndarray, lists: Lists) -> None:
    """Score every document of short intervals."""
    sizes = (end - begin).ravel()
    total = int(sizes.sum())
    if not total:
        return
    at = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begin.ravel(), sizes)
    owner = np.repeat(np.repeat(np.arange(len(item)), begin.shape[1]), sizes)
    key = owner * np.int64(len(block.ids) + 1) + block.docs[at]
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.diff(key[order], prepend=-1))
    some = order[first]
    lists.add(item[owner[some]], block.ids[block.docs[at[some]]], np.add.reduceat(block.impacts[at][order], first))


def _read(items: Items, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, row of each posting, its term, its impact) of stored rows."""
    ids = batch.column("doc_id").fill_null(_NULL_ID).to_numpy()
    terms, counts = (batch.column(name).flatten().to_numpy() for name in ("terms", "counts"))
    sizes = np.diff(batch.column("terms").offsets.to_numpy())
    return ids, np.repeat(np.arange(len(ids)), sizes), terms, items.impacts(terms, counts, np.repeat(batch.column("n").to_numpy(), sizes))


def best_of(rows: DataFrame, items: Items, kept: int = KEPT) -> DataFrame:
    """(item_id, doc_id, score): of every task the `kept` best documents of each item."""
    shared = rows.sparkSession.sparkContext.broadcast(items)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        lists = Lists(len(asked.ids), kept)
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def index() -> None:
            if not waiting:
                return
            ids = np.concatenate([x[0] for x in waiting])
            offsets = np.cumsum([0, *(len(x[0]) for x in waiting)])
            docs = np.concatenate([x[1] + shift for x, shift in zip(waiting, offsets)])
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            block = Block(ids[order], place[docs], np.concatenate([x[2] for x in waiting]), np.concatenate([x[3] for x in waiting]), len(asked.weights))
            waiting.clear()
            if len(block.docs):
                for numbers, terms in asked.classes:
                    search(block, numbers, terms, lists)

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                waiting.append(_read(asked, batch.slice(at, 1000)))
                held += len(waiting[-1][1])
                if held >= BLOCK_POSTINGS:
                    index()
                    held = 0
        index()
        row, rank = np.nonzero(lists.score > 0)
        doc = lists.doc[row, rank]
        found = [pa.array([asked.ids[k] for k in row], pa.int64()), pa.array(doc, mask=doc == _NULL_ID), pa.array(lists.score[row, rank])]
        yield pa.RecordBatch.from_arrays(found, ["item_id", "doc_id", "score"])

    return rows.mapInArrow(find, "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, kept: int = KEPT, items_at_once: int = ITEMS_AT_ONCE) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `kept` best documents of each item, as the contract of op13 scores them.

    Documents are read twice at most for each group of `items_at_once` items, whose terms are all that tasks are sent;
    a document's postings, stored, are what the index of a task is made of. Items without terms and items that
    no document answers give no rows. A null doc_id comes after all others of its score; rows that repeat an id each count.
    """
    spark = docs.sparkSession
    wanted = stored(item_terms(items), "items")
    group = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(0))), F.lit(max(1, -(-wanted.select("item_id").distinct().count() // items_at_once))))
    wanted = wanted.withColumn("group", group)
    found = None
    for number in sorted(row.group for row in wanted.select("group").distinct().collect()):
        by_item: dict[int | None, list[bytes]] = {}
        for row in wanted.where(F.col("group") == number).collect():
            by_item.setdefault(row.item_id, []).append(row.term.encode())
        vocabulary = sorted({term for terms in by_item.values() for term in terms})
        place = {term: k for k, term in enumerate(vocabulary)}
        rows = stored(posted(docs, vocabulary), "postings")
        n, length = rows.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = np.zeros(len(vocabulary))
        for row in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            holding[row.term] = row["count"]
        weights = np.floor(1000 * np.log((2 * n + 2) / (2 * holding + 1))).astype(np.int64)
        placed = {item: sorted(place[term] for term in terms) for item, terms in by_item.items()}
        part = best_of(rows, Items.of(placed, weights, n, length), kept)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= kept)
    return ranked.select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH document AS (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') AS terms
    FROM documents
), item AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term
    FROM benchmark
), posting AS (
    SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(terms) AS term FROM document) GROUP BY ALL
), total AS (
    SELECT count(*) AS n, sum(len(terms))::BIGINT AS l FROM document WHERE len(terms) > 0
), term AS (
    SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting, total GROUP BY term, n
), weighed AS (
    SELECT d.k, d.doc_id, 100 - 90 + ((90 * len(d.terms) * t.n) // t.l) AS m FROM document d, total t
), scored AS (
    SELECT i.item_id, d.k, d.doc_id, sum(t.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * d.m)))::BIGINT AS score
    FROM item i JOIN posting p USING (term) JOIN term t USING (term) JOIN weighed d USING (k) GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""
