"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solvind.llm.learning import Logistic, labelled_sample
from solvind.llm.textgrid import _LOWER, chunks, hash_runs

SAMPLED = 1_500  # examples of each label at most
GRAM = 6  # bytes of an n-gram: two characters of Chinese or Japanese
LONG_RUN = 16  # bytes above which a run of letters has n-grams too
EVIDENCE = 20.0  # likelihood ratio against chance at which a term counts half of a sure one
LEAST_RELEVANCE = 0.001  # of any term
NEIGHBOURS = 15
NEAREST = 0.01  # distance below which votes hardly grow
BLOCK = 64
FREQUENT = 512  # terms kept as rows over all examples
FIRST_OPENED = 4
TOGETHER = 128  # texts whose frequent terms are read together
THRESHOLD = 0.7
CHUNK_BYTES = 500_000  # text whose terms a worker counts at once
_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[97:123] = _LETTER[128:] = True


def terms_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term keys, keys before each text): every run of letters and digits, A-Z as a-z, and the n-grams of some.

    Runs end at ASCII marks and white space, at the marks of Latin-1 (no-break space among them), general punctuation
    and the CJK marks. Runs above `LONG_RUN` bytes or with characters of three bytes and more also give the `GRAM`
    bytes from each of their characters on, so that texts without spaces are read to their end.
    """
    data = _LOWER[data]
    letter = _LETTER[data]
    if len(data) > 2:
        one, two = data[:-1], data[1:]
        pair = np.flatnonzero((one == 0xC2) & (two >= 0xA0))
        letter[pair] = letter[pair + 1] = False
        wide = np.flatnonzero(((one == 0xE2) & (two <= 0x81)) | ((one == 0xE3) & (two == 0x80)) | ((one == 0xEF) & (two == 0xBC)))
        wide = wide[wide < len(data) - 2]
        wide = wide[(data[wide] != 0xEF) | (data[wide + 2] < 0x90)]
        letter[wide] = letter[wide + 1] = letter[wide + 2] = False
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    edges = offsets[1:-1]
    edges = edges[(edges < len(data)) & (edges > 0)]
    first[edges] = letter[edges]
    last[edges - 1] = letter[edges - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    keys = hash_runs(data, starts, letter)
    if not len(starts):
        return keys, np.zeros(len(offsets), np.int64)
    broad = np.add.reduceat(letter & (data >= 0xE0), starts) > 0
    cut = np.flatnonzero((ends - starts > GRAM) & (broad | (ends - starts > LONG_RUN)))
    if len(cut):
        lengths = ends[cut] - starts[cut] - GRAM + 1
        heads = np.repeat(starts[cut] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        heads = heads[data[heads] & 0xC0 != 0x80]
        windows = data[heads[:, None] + np.arange(GRAM)]
        grams = hash_runs(windows.ravel(), np.arange(0, windows.size, GRAM), np.ones(windows.size, bool))
        order = np.argsort(np.concatenate([starts, heads]), kind="stable")
        keys, starts = np.concatenate([keys, grams])[order], np.concatenate([starts, heads])[order]
    return keys, np.searchsorted(starts, offsets)


def unit_vector(weight: np.ndarray, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    weights = (1 + np.log(counts)) * weight[places]
    return places, weights / np.sqrt(weights @ weights)


def relevance(c0: np.ndarray, c1: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """How far a term in c0 of n0 clean and c1 of n1 toxic examples leans to toxic, from `LEAST_RELEVANCE` to 1."""
    c0, c1, n0, n1 = c0 + 0.5, c1 + 0.5, n0 + 1.0, n1 + 1.0
    share = (c0 + c1) / (n0 + n1)
    ratio = 2 * (c1 * np.log(c1 / (share * n1)) + c0 * np.log(c0 / (share * n0)))
    ratio = np.where(c1 / n1 > c0 / n0, np.maximum(ratio, 0), 0)
    return LEAST_RELEVANCE + (1 - LEAST_RELEVANCE) * ratio**2 / (ratio**2 + EVIDENCE**2)


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers from each start up to its end, one span after the other."""
    lengths = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())


class Examples:
    """Labelled examples as unit TF-IDF vectors in an inverted index whose postings are summed up by block.

    `terms` are sorted keys, `idf` their weights. The `FREQUENT` terms of most examples are kept as rows over all examples,
    which one product reads for many queries. The postings of all others lie by block of `BLOCK` examples, and only blocks
    that have the term are listed, each with the largest weight in it. A block's bound is the best that frequent terms
    give in it plus these weights; a query opens blocks by falling bound, reading the postings of opened blocks only, and
    stops when no bound beats the k-th best cosine, so the neighbours are exact. Examples of the same heaviest term share blocks.
    """

    def __init__(self, terms: np.ndarray, idf: np.ndarray, ids: np.ndarray, y: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]]):
        self.terms, self.idf, self.ids, self.y = terms, idf, ids, y
        self.empty_rate = 0.0
        self.calibration: Logistic | None = None
        owner = np.repeat(np.arange(len(ids)), [len(places) for places, _ in vectors])
        place = np.concatenate([places for places, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([weights for _, weights in vectors]) if vectors else np.zeros(0)
        self.example = np.argsort([places[np.argmax(weights)] for places, weights in vectors], kind="stable").astype(np.int64)
        slot = np.empty(len(ids), np.int64)
        slot[self.example] = np.arange(len(ids))
        slots = slot[owner]
        often = np.argsort(-np.bincount(place, minlength=len(terms)), kind="stable")[:FREQUENT]
        self.row = np.full(len(terms), -1)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), len(ids)))
        frequent = self.row[place] >= 0
        self.rows[self.row[place[frequent]], slots[frequent]] = weight[frequent]
        place, slots, weight = place[~frequent], slots[~frequent], weight[~frequent]
        order = np.lexsort((slots, place))
        self.slot, self.weight, place = slots[order], weight[order], place[order]
        block = self.slot // BLOCK
        heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (block[1:] != block[:-1])])) if len(place) else np.zeros(0, np.int64)
        self.firsts = np.arange(0, len(ids), BLOCK)
        self.block, self.head = block[heads], np.append(heads, len(place))
        self.bound = np.maximum.reduceat(self.weight, heads) * (1 + 1e-9) if len(heads) else np.zeros(0)
        self.start = np.searchsorted(place[heads], np.arange(len(terms) + 1))

    def vector(self, places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit_vector(self.idf, places, counts)

    def by_frequent(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent terms add to the cosine of each vector (row) with each example (column, by block)."""
        queries = np.zeros((len(vectors), len(self.rows)))
        for query, (places, weights) in zip(queries, vectors):
            rows = self.row[places]
            query[rows[rows >= 0]] = weights[rows >= 0]
        return queries @ self.rows

    def nearest(self, places: np.ndarray, weights: np.ndarray, total: np.ndarray, k: int = NEIGHBOURS, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the `k` nearest with a cosine above 0, ties to the smaller example; `but` is left out.

        `total` is the vector's row of `by_frequent`; it is added to in place.
        """
        rare = self.row[places] < 0
        places, weights = places[rare], weights[rare]
        starts, ends = self.start[places], self.start[places + 1]
        listed = _spans(starts, ends)
        weights = np.repeat(weights, ends - starts)
        block = self.block[listed]
        bounds = np.maximum.reduceat(total, self.firsts) + np.bincount(block, weights * self.bound[listed], len(self.firsts))
        left_out = np.flatnonzero(self.example == but) if but >= 0 else np.zeros(0, np.int64)
        order = np.argsort(-bounds, kind="stable")
        opened, some = 0, FIRST_OPENED
        while opened < len(order):
            total[left_out] = 0
            least = np.partition(total, len(total) - k)[len(total) - k] if len(total) > k else 0.0
            if bounds[order[opened]] < least - 1e-9:
                break
            wanted = np.zeros(len(bounds), bool)
            wanted[order[opened : opened + some]] = True
            wanted &= bounds >= least - 1e-9
            opened, some = opened + some, len(order)
            inside = np.flatnonzero(wanted[block])
            heads, tails = self.head[listed[inside]], self.head[listed[inside] + 1]
            postings = _spans(heads, tails)
            total += np.bincount(self.slot[postings], self.weight[postings] * np.repeat(weights[inside], tails - heads), len(total))
        total[left_out] = 0
        least = np.partition(total, len(total) - k)[len(total) - k] if len(total) > k else 0.0
        found = np.flatnonzero((total >= least) & (total > 0))
        best, cosine = self.example[found], total[found]
        keep = np.lexsort((best, -cosine))[:k]
        return best[keep], cosine[keep]

    def features(self, best: np.ndarray, cosine: np.ndarray, size: int) -> list[float]:
        """The vote, each neighbour counting by its nearness, the nearest toxic and clean cosines, and the text's terms."""
        near = 1 / (np.maximum(1 - cosine, 0) + NEAREST)
        y = self.y[best]
        sides = [cosine[y == side].max(initial=0.0) for side in (0, 1)]
        return [near @ y / near.sum() if len(best) else 0.0, *sides, np.log1p(size)]

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """(score, neighbours, cosines) of texts given as (places of their terms, counts)."""
        found = [(self.empty_rate, np.zeros(0, np.int64), np.zeros(0))] * len(texts)
        full = [k for k, (places, _) in enumerate(texts) if len(places)]
        for at in range(0, len(full), TOGETHER):
            some = full[at : at + TOGETHER]
            vectors = [self.vector(*texts[k]) for k in some]
            near = [self.nearest(*vector, total) for vector, total in zip(vectors, self.by_frequent(vectors))]
            rates = np.full(len(some), self.empty_rate)
            if self.calibration is not None:
                rates = self.calibration(np.array([self.features(*pair, texts[k][1].sum()) for k, pair in zip(some, near)]))
            for k, rate, (best, cosine) in zip(some, rates, near):
                found[k] = (float(rate) if len(best) else self.empty_rate), best, cosine
        return found


def _counted(terms: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text (places of the known terms in it, how often)."""
    keys, before = terms_of(data, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(before))
    spot = np.minimum(np.searchsorted(terms, keys), max(0, len(terms) - 1))
    hit = np.flatnonzero(terms[spot] == keys) if len(terms) else np.zeros(0, np.int64)
    both, counts = np.unique(rows[hit] * max(1, len(terms)) + spot[hit], return_counts=True)
    bounds = np.searchsorted(both, np.arange(len(offsets)) * max(1, len(terms)))
    for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        yield both[a:b] - row * len(terms), counts[a:b]


def train(docs: DataFrame, labels: DataFrame, sampled: int = SAMPLED, id_column: str = "doc_id", text_column: str = "text") -> Examples:
    """Examples from `labels` (doc_id, toxic), of which `sampled` rows of each label at most are read.

    All terms of the sampled texts are indexed. A term's weight is its idf, times how far it leans to toxic, so that long
    texts are compared by what may make them toxic rather than by their subject. Only the examples' sparse vectors come to the driver.
    """
    sample = labelled_sample(docs, labels, "toxic", sampled, id_column, text_column)
    known = {row.y: row.n for row in labels.where(F.col("toxic").isin(0, 1)).groupBy(F.col("toxic").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, data, offsets in chunks(batch.column("text"), CHUNK_BYTES):
                keys, before = terms_of(data, offsets)
                found += [np.unique(keys[a:b], return_counts=True) for a, b in zip(before[:-1], before[1:])]
            terms = pa.array([keys.view(np.int64) for keys, _ in found], pa.list_(pa.int64()))
            counts = pa.array([counts for _, counts in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), terms, counts], ["doc_id", "y", "terms", "counts"])

    typed = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
    rows = typed.mapInArrow(counted, "doc_id long, y int, terms array<long>, counts array<long>").toArrow()
    listed = [rows.column(name).combine_chunks() for name in ("terms", "counts")]
    pairs = [(listed[0][k].values.to_numpy().view(_U), listed[1][k].values.to_numpy()) for k in range(len(rows))]
    ids, y = rows.column("doc_id").to_numpy(), rows.column("y").to_numpy().astype(float)
    order = sorted(range(len(ids)), key=lambda k: (ids[k], pairs[k][0].tobytes(), pairs[k][1].tobytes()))
    n1 = int(y.sum())
    n0 = len(y) - n1
    scale = [known.get(0, 0) / max(1, n0), known.get(1, 0) / max(1, n1)]  # rows that one sampled row stands for
    empty = [sum(1 for k in order if not len(pairs[k][0]) and y[k] == side) * scale[side] for side in (0, 1)]
    order = [k for k in order if len(pairs[k][0])]
    pairs, ids, y = [pairs[k] for k in order], ids[order], y[order]
    terms, place, df = np.unique(np.concatenate([keys for keys, _ in pairs]) if pairs else np.zeros(0, _U), return_inverse=True, return_counts=True)
    ends = np.cumsum([0, *(len(keys) for keys, _ in pairs)])
    arrays = [(place[a:b], counts) for a, b, (_, counts) in zip(ends[:-1], ends[1:], pairs)]
    c1 = np.bincount(place, np.repeat(y, np.diff(ends)), len(terms))
    idf = (np.log((1 + n0 + n1) / (1 + df)) + 1) * relevance(df - c1, c1, n0, n1)
    index = Examples(terms, idf, ids, y, [unit_vector(idf, *pair) for pair in arrays])
    index.empty_rate = empty[1] / sum(empty) if sum(empty) else 0.0
    if pairs:  # each example against all others
        made = []
        for at in range(0, len(arrays), TOGETHER):
            vectors = [index.vector(*pair) for pair in arrays[at : at + TOGETHER]]
            for k, (vector, total) in enumerate(zip(vectors, index.by_frequent(vectors)), at):
                made.append(index.features(*index.nearest(*vector, total, but=k), arrays[k][1].sum()))
        weights = np.where(y == 1, scale[1], scale[0])
        index.calibration = Logistic(np.array(made), y, weights / weights.mean(), ridge=1.0)
    return index


def score(docs: DataFrame, index: Examples, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score, evidence) of every row: the chance of toxic 1 from the whole text, and the nearest examples.

    `evidence` lists the neighbours' ids and cosines, nearest first. A text without any term of an example, so
    also a null or empty one, gets the share of toxic ones among such examples. Equal term counts are scored once a batch.
    The index is broadcast, so that a worker holds it once, not also as the bytes of each task's function.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_scores(shared.value, batch.column("text")))
            kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64())]))
            columns = [batch.column("doc_id"), pa.array([value for value, _ in found], pa.float64()), pa.array([near for _, near in found], kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "evidence"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(scored, "doc_id long, score double, evidence array<struct<doc_id: long, cosine: double>>")


def without_toxic(docs: DataFrame, index: Examples, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose score is below `threshold`. Only texts leave the JVM."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        return pa.array([value for value, _ in _scores(shared.value, texts)], pa.float64())

    return docs.where(toxicity(F.col(text_column)) < threshold)


def _scores(index: Examples, texts: pa.Array) -> Iterator[tuple[float, list[dict]]]:
    """(score, evidence) of each text; equal term counts are scored once a batch."""
    seen: dict[bytes, tuple[float, list[dict]]] = {}
    for _, _, data, offsets in chunks(texts, CHUNK_BYTES):
        keyed = [(places.tobytes() + counts.tobytes(), (places, counts)) for places, counts in _counted(index.terms, data, offsets)]
        fresh = {key: pair for key, pair in keyed if key not in seen}
        for key, (value, best, cosine) in zip(fresh, index.scores(list(fresh.values()))):
            seen[key] = value, [{"doc_id": int(index.ids[b]), "cosine": float(c)} for b, c in zip(best, cosine)]
        yield from (seen[key] for key, _ in keyed)
