"""Language identification: bit-sliced Bloom filters of character n-grams, a bit for each language.

A slot of the table is a mask of languages, in bytes. An n-gram sets its language's bit in `HASHES` slots; the masks of a
query n-gram's slots, and-ed, name all languages that hold it, at once. A text's n-grams are counted for each language,
what a filter of that fill lets through by chance is taken off, and the language that explains most of them is predicted.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solvind.llm.common import stored
from solvind.llm.textgrid import distinct

SAMPLED = 1_500  # texts of each language, or nearly, that are learned from
GRAMS = 60_000  # n-grams of a language at most, those in most of its texts
LEAST_SHARE = 0.02  # of a language's sampled texts that must hold an n-gram
SIZES = (1, 2, 3, 4)
HASHES = 2
FILL = 0.2  # of the fullest language's filter at most
UNKNOWN = "und"
CHUNK_CHARS = 1_000_000
CHUNK_TEXTS = 4_000
_U = np.uint64


def _mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> _U(33))
    values = values * _U(0xFF51AFD7ED558CCD)
    values ^= values >> _U(33)
    values *= _U(0xC4CEB9FE1A85EC53)
    values ^= values >> _U(33)
    return values


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters or marks on them: 2 for letters, 1 for marks."""
    kinds = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))
        kinds[point] = 2 if kind[0] == "L" else 1 if kind[0] == "M" else 0
    return kinds


def points_of(texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, code points, offsets) of runs of texts: lower case, each run of other characters as one 0.

    Every text begins and ends with a 0. A text longer than a chunk comes by itself.
    """
    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < min(len(texts), row + CHUNK_TEXTS) and (end == row or size + len(texts[end] or "") <= CHUNK_CHARS):
            size += len(texts[end] or "")
            end += 1
        parts = [f"\0{(text or '').lower()}\0" for text in texts[row:end]]
        offsets = np.cumsum([0, *map(len, parts)])
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.where(_letters()[points] > 0, points, 0)
        kept = np.ones(len(points), bool)
        kept[1:] = (points[1:] > 0) | (points[:-1] > 0)
        kept[offsets[:-1]] = True
        yield row, end - row, points[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]
        row = end


def grams(points: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size (hash of every n-gram, its text). N-grams lie within a word and the marks around it."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    breaks = np.cumsum(points == 0)
    value = np.zeros(len(points), _U)
    for size in range(1, max(SIZES) + 1):
        n = len(points) - size + 1
        if n <= 0:
            return
        value = _mix((value[:n] ^ points[size - 1 :].astype(_U)) * _U(0x9E3779B97F4A7C15) + _U(size))
        if size in SIZES:
            # A mark may stand at the ends only, and not alone.
            inner = breaks[size - 2 : size - 2 + n] - breaks[:n] if size > 2 else np.zeros(n, np.int64)
            whole = (inner == 0) & (text[:n] == text[size - 1 :])
            if size < 3:
                whole &= (points[:n] > 0) | (points[size - 1 :] > 0)
            yield value[whole], text[:n][whole]


def slots_of(hashes: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The places of each n-gram, by double hashing; `n` is a power of two."""
    step = (hashes >> _U(32)) | _U(1)
    for k in range(HASHES):
        yield ((hashes + _U(k) * step) & _U(n - 1)).astype(np.int32)


class LanguageFilters:
    """`masks` has a row of bytes for each slot, `languages[k]` being bit k % 8 of byte k // 8."""

    def __init__(self, languages: list[str], masks: np.ndarray, common: int):
        self.languages, self.masks, self.common = languages, masks, common
        fill = [((masks[:, k >> 3] >> (k & 7)) & 1).mean() for k in range(len(languages))]
        self.by_chance = np.array(fill) ** HASHES
        self._bits = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(float)

    def holding(self, hashes: np.ndarray) -> np.ndarray:
        """The masks of all languages that hold each n-gram, false positives included."""
        places = [*slots_of(hashes, len(self.masks))]
        found = self.masks[places[0]]
        for place in places[1:]:
            found &= self.masks[place]
        return found

    def explained(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the n-grams that each language explains, false positives taken off; all n-grams; whether it has a letter."""
        counts = np.zeros((len(texts), 8 * self.masks.shape[1]))
        total, letters = np.zeros(len(texts)), np.zeros(len(texts), bool)
        for row, rows, points, offsets in points_of(texts):
            spelled = np.concatenate([[0], np.cumsum(_letters()[points] == 2)])
            letters[row : row + rows] = np.diff(spelled[offsets]) > 0
            for hashes, text in grams(points, offsets):
                total[row : row + rows] += np.bincount(text, minlength=rows)
                for byte, mask in enumerate(self.holding(hashes).T):
                    kinds = np.bincount(text * 256 + mask, minlength=256 * rows).reshape(rows, 256)
                    counts[row : row + rows, 8 * byte : 8 * byte + 8] += kinds @ self._bits
        counts = counts[:, : len(self.languages)]
        return np.maximum(0, (counts - total[:, None] * self.by_chance) / np.maximum(1e-9, 1 - self.by_chance)), total, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of each text, and of the n-grams that the second best does not explain the share that the best does."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        counts, total, letters = self.explained(texts)
        # What several languages explain as well, or none does, counts for the one that is most common among those learned from.
        top = -np.sort(-counts, axis=1)
        best = np.where(counts[:, self.common] >= top[:, 0] - 0.5, self.common, counts.argmax(axis=1))
        second = top[:, 1] if top.shape[1] > 1 else np.zeros(len(texts))
        score = np.divide(top[:, 0] - second, total - second, out=np.zeros(len(texts)), where=total > second)
        return [self.languages[k] if has else UNKNOWN for k, has in zip(best, letters)], np.where(letters, np.clip(score, 0, 1), 0)


def train(docs: DataFrame, sampled: int = SAMPLED, most_grams: int = GRAMS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> LanguageFilters:
    """Filters of all languages of `docs`, whose rows may all be learned from; rows without a lang, id or text teach nothing.

    Of each language about `sampled` texts are read, in whole: the share of all its texts that gives so many, by id hash.
    The driver gets a row for each language and the finished table, which `most_grams` and the number of languages bound.
    """
    spark = docs.sparkSession
    rows = docs.select(F.xxhash64(id_column).alias("spot"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text"), F.col(id_column).alias("id"))
    rows = rows.where("lang is not null and text is not null and id is not null").drop("id")
    size_of = {row.lang: row.n for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(size_of)
    if not languages:
        return LanguageFilters([], np.zeros((1, 1), np.uint8), 0)
    common = max(range(len(languages)), key=lambda k: (size_of[languages[k]], -k))
    limits = [(lang, int(min(1.0, sampled / size_of[lang]) * (2**64 - 2**11)) - 2**63) for lang in languages]
    limits = stored(spark.createDataFrame(limits, "of string, limit long"), "languages")

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {lang: k for k, lang in enumerate(languages)}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                langs = np.array([number[lang] for lang in some.column("lang").to_pylist()], np.int64)
                found = []
                for row, rows, points, offsets in points_of(some.column("text").to_pylist()):
                    for hashes, text in grams(points, offsets):
                        values, before = distinct(hashes, np.searchsorted(text, np.arange(rows + 1)))
                        found.append((np.repeat(langs[row : row + rows], np.diff(before)), values))
                for lang in np.unique(langs):
                    values, n = np.unique(np.concatenate([v[of == lang] for of, v in found] or [np.zeros(0, _U)]), return_counts=True)
                    columns = [pa.array(np.full(len(n), lang, np.int32)), pa.array(values.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    sample = rows.join(limits, F.col("lang") == F.col("of")).where("spot <= limit").select("lang", "text")
    counted = sample.mapInArrow(document_counts, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    least = spark.createDataFrame([(k, max(1.0, LEAST_SHARE * min(sampled, size_of[lang]))) for k, lang in enumerate(languages)], "lang int, least double")
    common_first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = counted.join(F.broadcast(least), "lang").where("n >= least").withColumn("rank", F.row_number().over(common_first)).where(F.col("rank") <= most_grams)
    kept = stored(kept.select("lang", "gram"), "grams")
    fullest = max([1, *(row["count"] for row in kept.groupBy("lang").count().collect())])
    n = 1 << max(8, int(np.ceil(np.log2(HASHES * fullest / FILL))))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_numpy()
            for place in slots_of(batch.column("gram").to_numpy().view(_U), n):
                yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(lang >> 3), pa.array((1 << (lang & 7)).astype(np.int32))], ["slot", "byte", "mask"])

    table = kept.mapInArrow(places, "slot int, byte int, mask int").groupBy("slot", "byte").agg(F.bit_or("mask").alias("mask")).toArrow()
    masks = np.zeros((n, -(-len(languages) // 8)), np.uint8)
    masks[table["slot"].to_numpy(), table["byte"].to_numpy()] = table["mask"].to_numpy()
    return LanguageFilters(languages, masks, common)


def score(docs: DataFrame, filters: LanguageFilters, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from its whole text; `und` and 0 where the text is null or has no letter."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                langs, scores = shared.value.predict(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(scored, "doc_id long, lang_pred string, score double")
