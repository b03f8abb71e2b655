"""Quality by compression: how much better a text compresses with a dictionary of good texts than with one of bad texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solvind.llm.learning import Logistic, labelled_sample

SAMPLED = 5_000  # rows of each label at most: two fifths teach the dictionaries, the rest the calibration
DICTIONARY_BYTES = 131_072
TAUGHT_CHARS = 8_000  # of a sampled text that the dictionaries are made of
LEVEL = 3
THRESHOLD = 0.7
REJECTED_BELOW = 0.5  # a filter drops what is likelier bad than good


class CompressionClassifier:
    """Two zstandard dictionaries and the calibration of what they save. `prior` stands in when a label is unknown."""

    def __init__(self, good: bytes, bad: bytes, prior: float):
        self.good, self.bad, self.prior, self.calibration = good, bad, prior, None

    def compressors(self):
        made = []
        for data in (self.good, self.bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, level=LEVEL, write_content_size=False, write_dict_id=False))
        return made

    def sizes(self, texts: list[bytes]) -> np.ndarray:
        """Bytes of each text: with the good dictionary, with the bad one, and as it is."""
        good, bad = self.compressors()
        return np.array([(len(good.compress(text)), len(bad.compress(text)), len(text)) for text in texts], float).reshape(-1, 3)

    @staticmethod
    def features(sizes: np.ndarray) -> np.ndarray:
        """The size difference per byte, plain and flattened, and what it has to be read against: redundancy and length."""
        good, bad, length = (sizes + [1, 1, 1]).T
        saved, redundancy, long = (bad - good) / length, np.log(good / length), np.log(length)
        return np.column_stack([np.tanh(saved * 30), saved, redundancy, long, redundancy * long, redundancy**2, long**2])

    def scores(self, sizes: np.ndarray) -> np.ndarray:
        return self.calibration(self.features(sizes)) if self.calibration else np.full(len(sizes), self.prior)


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their bytes themselves
        return b"".join(samples)[-DICTIONARY_BYTES:] or b"\n" * 8


def taught_pieces(texts: DataFrame, per_label: int) -> DataFrame:
    """(doc_id, y, place, text) of at most `per_label` pieces of each label, by hash from all pieces of whole texts."""
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{TAUGHT_CHARS}}}"), F.lit(0))
    pieces = texts.select("doc_id", "y", F.posexplode(cut).alias("place", "text"))
    order = [F.xxhash64("doc_id", "place"), "doc_id", "place", "text"]
    parts = [pieces.where(F.col("y") == y).orderBy(*order).limit(per_label) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(docs: DataFrame, labels: DataFrame, sampled: int = SAMPLED, id_column: str = "doc_id", text_column: str = "text") -> CompressionClassifier:
    """Learn from `labels` (doc_id, quality), of which `sampled` rows of each label at most are read.

    Two fifths of the sample, cut into pieces of `TAUGHT_CHARS` over their whole length, of which as many of each label
    are drawn as two fifths of `sampled`, make the dictionaries on the driver. The others, whole, are
    compressed in Spark's tasks and calibrate the score; only their sizes come back.
    """
    sample = labelled_sample(docs, labels, "quality", sampled, id_column, text_column)
    teaches = F.pmod(F.xxhash64("doc_id", F.lit("teach")), F.lit(5)) < 2
    pieces = taught_pieces(sample.where(teaches), max(1, 2 * sampled // 5))
    taught = pieces.select("doc_id", "y", "place", F.encode("text", "UTF-8").alias("text")).orderBy("doc_id", "place", "text").collect()
    good, bad = ([bytes(row.text) for row in taught if row.y == y and row.text] for y in (1, 0))
    model = CompressionClassifier(_dictionary(good), _dictionary(bad), len(good) / max(1, len(good) + len(bad)))
    if not good or not bad:
        return model

    known = {row.y: row.n for row in labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("quality").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = sample.where(~teaches).select("doc_id", F.col("y").cast("double").alias("y"), "text")
    sizes = rest.mapInArrow(_measured(model, ["y"]), "y double, good double, bad double, length double").collect()
    table = np.array(sizes, float).reshape(-1, 4)
    y = table[:, 0]
    if 0 < y.sum() < len(y):
        share = np.where(y == 1, known.get(1, 0) / y.sum(), known.get(0, 0) / (len(y) - y.sum()))  # rows that one sampled row stands for
        model.calibration = Logistic(model.features(table[:, 1:]), y, share / share.mean(), ridge=1e-3)
    return model


def _measured(model: CompressionClassifier, kept: list[str]):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                sizes = model.sizes([(text or "").encode() for text in some.column("text").to_pylist()])
                columns = [some.column(name) for name in kept] + [pa.array(column) for column in sizes.T.copy()]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "good", "bad", "length"])

    return measure


def score(docs: DataFrame, model: CompressionClassifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the chance of quality 1, from the whole text. Null counts as the empty text."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _measured(model, ["doc_id"])(batches):
            sizes = np.column_stack([batch.column(k).to_numpy() for k in (1, 2, 3)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(sizes))], ["doc_id", "score"])

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(scored, "doc_id long, score double")


def without_bad(docs: DataFrame, model: CompressionClassifier, threshold: float = REJECTED_BELOW, text_column: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose score is at least `threshold`. Only texts leave the JVM."""

    @F.arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        parts = [model.sizes([(text or "").encode() for text in texts.slice(at, 500).to_pylist()]) for at in range(0, len(texts), 500)]
        return pa.array(np.concatenate([model.scores(sizes) for sizes in parts]) if parts else np.zeros(0))

    return docs.where(quality(F.col(text_column)) >= threshold)
