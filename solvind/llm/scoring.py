"""Language-model scores: an n-gram trie of two levels in Elias-Fano form, memory-mapped by every worker.

Level 1, the vocabulary: 64-bit word hashes in ascending order; a word's id is its place. Level 2: for every context
the ids that follow it, ascending, with a quantised smoothed probability each; the contexts' ranges are monotone
pointers. A context also has its quantised backoff. Both levels are cut into parts of bounded size, one
file each in the shared folder.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solvind.llm.common import stored
from solvind.llm.eliasfano import EliasFano
from solvind.llm.textgrid import chunks, words
from solvind.workspace import fresh_path

END = np.uint64(0x5EED0FDA7A5E7EED)  # the token after each text, and the context of the first word
WORDS_PER_PART = 1_000_000  # training tokens: a bound for what a part's task holds
FLUSHED = 2_000_000  # n-grams that a task counts before it passes them on
SCORED_TOGETHER = 1_000_000  # tokens
CODES = 255  # quantised values, 8 bits each
LOWEST, HIGHEST = -12.0, 0.0  # log10 that codes span


# --- files ----------------------------------------------------------------------------------------------------------


def _plain(path: str) -> str | None:
    return path.removeprefix("file://").removeprefix("file:") if path.startswith(("file:", "/")) else None


def write_file(path: str, header: dict, arrays: list[np.ndarray]) -> None:
    """A header line of JSON, then the arrays, each on a multiple of 8 bytes. Appears whole or not at all."""
    header = header | {"arrays": [(str(a.dtype), len(a)) for a in arrays]}
    line = json.dumps(header).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    parts = [line] + [data + b"\0" * (-len(data) % 8) for data in (a.tobytes() for a in arrays)]
    local = _plain(path)
    if local:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{local}.{uuid.uuid4().hex}"
        with open(draft, "wb") as file:
            file.writelines(parts)
        os.replace(draft, local)  # a task that runs twice writes the same bytes
        return
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(place), recursive=True)
    draft = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as file:
        for part in parts:
            file.write(part)
    system.move(draft, place)


def exists(path: str) -> bool:
    if path in _mapped:
        return True
    local = _plain(path)
    if local:
        return os.path.exists(local)
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    return system.get_file_info(place).type == fs.FileType.File


_mapped: dict[str, tuple[dict, list[np.ndarray]]] = {}


def read_file(path: str) -> tuple[dict, list[np.ndarray]]:
    """The header and the memory-mapped arrays; once per worker. A store without files is copied to an unnamed one."""
    if path not in _mapped:
        local = _plain(path)
        if local:
            data = np.memmap(local, np.uint8, "r")
        else:
            from pyarrow import fs

            system, place = fs.FileSystem.from_uri(path)
            copy = tempfile.TemporaryFile()
            with system.open_input_stream(place) as file:
                while block := file.read(1 << 22):
                    copy.write(block)
            copy.flush()
            data = np.memmap(copy, np.uint8, "r")
        start = bytes(data[: 1 << 16]).index(b"\n") + 1
        header, arrays = json.loads(bytes(data[:start])), []
        for kind, length in header["arrays"]:
            size = np.dtype(kind).itemsize * length
            arrays.append(data[start : start + size].view(kind))
            start += size + -size % 8
        _mapped[path] = header, arrays
    return _mapped[path]


# --- counting -------------------------------------------------------------------------------------------------------


def tokens_of(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, token hashes, tokens before each text); each text's words and then the end."""
    for row, rows, data, offsets in chunks(texts):
        hashes, before = words(data, offsets)
        yield row, rows, np.insert(hashes, before[1:], END), before + np.arange(rows + 1)


BLOB = "part int, keys binary, counts binary"


def _blobs(part: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Ascending keys of each part as compressed differences."""
    press = zstandard.ZstdCompressor(level=1)
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1), len(part)]
    rows = [(int(part[a]), _differences(press, keys[a:b]), press.compress(counts[a:b].astype("<u4").tobytes())) for a, b in zip(edges[:-1], edges[1:]) if b > a]
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, (pa.int32(), pa.binary(), pa.binary()))], ["part", "keys", "counts"])


def _differences(press: zstandard.ZstdCompressor, keys: np.ndarray) -> bytes:
    planes = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return press.compress(np.ascontiguousarray(planes).tobytes())


def _merged(rows: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a part, ascending and once each, with the sums of their counts."""
    open_ = zstandard.ZstdDecompressor()
    planes = [np.frombuffer(open_.decompress(keys), np.uint8).reshape(8, -1) for keys, _ in rows]
    keys = np.concatenate([np.cumsum(np.ascontiguousarray(p.T).view("<u8").ravel(), dtype=np.uint64) for p in planes])
    counts = np.concatenate([np.frombuffer(open_.decompress(counts), "<u4") for _, counts in rows]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _each_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of rows sorted by part, merged."""
    part, rows = None, []
    for batch in batches:
        for number, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if number != part and rows:
                yield part, *_merged(rows)
                rows = []
            part = number
            rows.append((keys, counts))
    if rows:
        yield part, *_merged(rows)


def _counted(stream: Iterator[np.ndarray], part_of) -> Iterator[pa.RecordBatch]:
    """Counts of keys, passed on about every `FLUSHED` keys. `part_of` gives the part of ascending keys, ascending too."""
    kept, size = [], 0
    for keys in stream:
        kept.append(keys)
        size += len(keys)
        if size >= FLUSHED:
            unique, counts = np.unique(np.concatenate(kept), return_counts=True)
            yield _blobs(part_of(unique), unique, counts)
            kept, size = [], 0
    if size:
        unique, counts = np.unique(np.concatenate(kept), return_counts=True)
        yield _blobs(part_of(unique), unique, counts)


# --- the trie -------------------------------------------------------------------------------------------------------


@dataclass
class Trie:
    """What a task needs besides the files: sizes by part and the constants of smoothing."""

    path: str
    parts: int
    sizes: np.ndarray  # words in each part of level 1
    totals: np.ndarray  # tokens in each part of level 1
    tokens: int
    discounted: float  # what is taken off every count of level 1

    def __post_init__(self):
        self.first = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.mass = np.concatenate([[0], np.cumsum(self.totals)]).astype(np.int64)

    @property
    def words(self) -> int:
        return int(self.first[-1])

    def hash_part(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.parts) >> np.uint64(32)).astype(np.int64)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, count, tokens of all words before it) of ascending hashes; id -1 and count 0 for unknown ones."""
        ids, counts, before = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        edges = np.searchsorted(self.hash_part(hashes), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            if not self.sizes[part]:
                continue
            _, (known, sums) = read_file(f"{self.path}/words-{part}")
            asked = hashes[edges[part] : edges[part + 1]]
            spot = np.minimum(np.searchsorted(known, asked), len(known) - 1)
            hit = known[spot] == asked
            place, spot = np.arange(edges[part], edges[part + 1])[hit], spot[hit]
            ids[place], counts[place] = self.first[part] + spot, sums[spot + 1] - sums[spot]
            before[place] = self.mass[part] + sums[spot]
        return ids, counts, before

    def pair_part(self, before: np.ndarray, counts: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The part of level 2 of (context, word): ascending with the pair, and even, as ids are in the order of hashes.

        A context takes a stretch as long as its count, its words share it evenly, so a hot context has many parts.
        """
        place = before + np.floor(counts * (word / max(1, self.words))).astype(np.int64)
        return np.minimum(place * self.parts // max(1, self.tokens), self.parts - 1)

    def pairs(self, context: np.ndarray, before: np.ndarray, counts: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of the discounted probability of each of ascending pairs of ids, -1 for pairs not met."""
        code = np.full(len(context), -1, np.int64)
        edges = np.searchsorted(self.pair_part(before, counts, word), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            here = slice(edges[part], edges[part + 1])
            if exists(f"{self.path}/pairs-{part}"):
                code[here] = Level.read(f"{self.path}/pairs-{part}").find(context[here], word[here])
        return code


class Level:
    """A part of level 2: contexts from `first` on; pointers, monotone, to where each one's words begin; words; codes.

    A context's words stand relative to its pointer: the number of a word is pointer + id, and the next context's
    pointer is one above the last number. So all numbers ascend, and a word follows a context if its number is there
    and below the next pointer.
    """

    def __init__(self, first: int, pointers: EliasFano, followers: EliasFano, codes: np.ndarray):
        self.first, self.pointers, self.followers, self.codes = first, pointers, followers, codes

    @classmethod
    def read(cls, path: str) -> Level:
        if path not in _levels:
            header, arrays = read_file(path)
            sequences = [EliasFano(*header["shapes"][k], *arrays[3 * k : 3 * k + 3]) for k in range(2)]
            _levels[path] = cls(header["first"], *sequences, arrays[6])
        return _levels[path]

    @staticmethod
    def write(path: str, context: np.ndarray, word: np.ndarray, codes: np.ndarray) -> None:
        first, last = int(context[0]), int(context[-1])
        starts = np.searchsorted(context, np.arange(first, last + 2))
        ends = word[np.maximum(starts[1:] - 1, 0)] + 1
        ends[np.diff(starts) == 0] = 1  # a context without words
        pointers = np.concatenate([[0], np.cumsum(ends)])
        sequences = [EliasFano.of(pointers), EliasFano.of(pointers[context - first] + word)]
        header = {"first": first, "shapes": [(s.length, s.width) for s in sequences]}
        write_file(path, header, [a for s in sequences for a in s.arrays()] + [codes.astype(np.uint8)])

    def find(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each (context, word) or -1."""
        found = np.full(len(context), -1, np.int64)
        place = context - self.first
        inside = np.flatnonzero((place >= 0) & (place + 1 < self.pointers.length))
        unique, inverse = np.unique(place[inside], return_inverse=True)
        if len(unique):
            begin, end = (self.pointers[unique + k].astype(np.int64)[inverse] for k in (0, 1))
            number = begin + word[inside]
            spot = self.followers.find(number)
            hit = np.flatnonzero((spot >= 0) & (number < end))
            found[inside[hit]] = self.codes[spot[hit]]
        return found


_levels: dict[str, Level] = {}


def encoded(log10: np.ndarray) -> np.ndarray:
    """Codes of logarithms, rounded down so that probabilities never add up to more than 1."""
    return np.clip(np.floor((log10 - LOWEST) / (HIGHEST - LOWEST) * CODES), 0, CODES).astype(np.int64)


def decoded(codes: np.ndarray) -> np.ndarray:
    return LOWEST + codes * ((HIGHEST - LOWEST) / CODES)


def train(docs: DataFrame, text_column: str = "text") -> Trie:
    """Count words and pairs of all `docs` and write the trie. Every n-gram is kept; nothing grows in one task but its part."""
    spark = docs.sparkSession
    path = fresh_path(spark, "trie")
    texts = docs.select(F.col(text_column).alias("text"))
    counted = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, int(counted // 6 // WORDS_PER_PART))
    trie = Trie(path, parts, np.zeros(parts, int), np.zeros(parts, int), 0, 0.5)

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (tokens for batch in batches for _, _, tokens, _ in tokens_of(batch.column(0)))
        yield from _counted(stream, trie.hash_part)

    def write_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, hashes, counts in _each_part(batches):
            write_file(f"{path}/words-{part}", {}, [hashes, np.concatenate([[0], np.cumsum(counts)])])
            yield _row(part=part, size=len(hashes), total=counts.sum(), ones=(counts == 1).sum(), twos=(counts == 2).sum())

    stats = "part long, size long, total long, ones long, twos long"
    dealt = lambda frame: frame.repartition(parts, "part").sortWithinPartitions("part")
    rows = dealt(texts.mapInArrow(count_words, BLOB)).mapInArrow(write_words, stats).collect()
    sizes, totals = np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    for row in rows:
        sizes[row.part], totals[row.part] = row.size, row.total
    discount = absolute_discount(sum(row.ones for row in rows), sum(row.twos for row in rows))
    words_seen = Trie(path, parts, sizes, totals, int(totals.sum()), discount)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kept in _gathered(tokens for batch in batches for _, _, tokens, _ in tokens_of(batch.column(0))):
            unique, inverse = np.unique(kept, return_inverse=True)
            ids, counts, before = words_seen.look_up(unique)
            keys, n = np.unique((ids[inverse[:-1]] * words_seen.words + ids[inverse[1:]]).astype(np.uint64), return_counts=True)
            context, word = (x.astype(np.int64) for x in np.divmod(keys, np.uint64(words_seen.words)))
            spot = np.argsort(ids)  # from ids back to the words looked up
            spot = spot[np.searchsorted(ids[spot], context)]
            yield _blobs(words_seen.pair_part(before[spot], counts[spot], word), keys, n)

    def write_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, keys, counts in _each_part(batches):
            context, word = (x.astype(np.int64) for x in np.divmod(keys, np.uint64(words_seen.words)))
            discount = absolute_discount((counts == 1).sum(), (counts == 2).sum())
            own, n = np.unique(context, return_counts=True)
            share = (counts - discount) / np.repeat(_of_ids(words_seen, own), n)
            Level.write(f"{path}/pairs-{part}", context, word, encoded(np.log10(share)))
            holder = np.searchsorted(words_seen.first, own, "right") - 1
            edges = np.flatnonzero(np.append(True, holder[1:] != holder[:-1]))
            rows = [(int(holder[a]), own[a:b].tobytes(), (discount * n[a:b]).tobytes()) for a, b in zip(edges, [*edges[1:], len(own)])]
            arrays = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "context", "taken"])

    def write_backoffs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _runs(batches, ("context", "taken")):
            taken = np.zeros(sizes[part])
            for context, some in rows:
                taken[np.frombuffer(context, np.int64) - words_seen.first[part]] += np.frombuffer(some)
            _, (_, sums) = read_file(f"{path}/words-{part}")
            share = np.maximum(taken / np.diff(sums), 10**LOWEST)
            write_file(f"{path}/backoffs-{part}", {}, [encoded(np.log10(share)).astype(np.uint8)])
            yield _row(part=part)

    pairs = stored(dealt(texts.mapInArrow(count_pairs, BLOB)).mapInArrow(write_pairs, "part int, context binary, taken binary"), "taken")
    dealt(pairs).mapInArrow(write_backoffs, "part long").collect()
    return words_seen


def absolute_discount(ones: int, twos: int) -> float:
    """What leaving one out recommends to take off every count: n1 / (n1 + 2 n2)."""
    return float(ones / (ones + 2 * twos)) if ones and twos else 0.5


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({name: pa.array([int(value)], pa.int64()) for name, value in values.items()})


def _runs(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int, list[tuple]]]:
    part, rows = None, []
    for batch in batches:
        for number, *values in zip(batch.column("part").to_pylist(), *(batch.column(name).to_pylist() for name in names)):
            if number != part and rows:
                yield part, rows
                rows = []
            part = number
            rows.append(tuple(values))
    if rows:
        yield part, rows


def _gathered(stream: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Runs of texts of about `FLUSHED` tokens, each run behind an end."""
    kept, size = [np.array([END])], 0
    for tokens in stream:
        kept.append(tokens)
        size += len(tokens)
        if size >= FLUSHED:
            yield np.concatenate(kept)
            kept, size = [np.array([END])], 0
    if size:
        yield np.concatenate(kept)


def _of_ids(trie: Trie, ids: np.ndarray) -> np.ndarray:
    """Counts of ascending ids."""
    counts = np.zeros(len(ids), np.int64)
    edges = np.searchsorted(ids, trie.first)
    for part in np.flatnonzero(np.diff(edges)):
        _, (_, sums) = read_file(f"{trie.path}/words-{part}")
        place = ids[edges[part] : edges[part + 1]] - trie.first[part]
        counts[edges[part] : edges[part + 1]] = sums[place + 1] - sums[place]
    return counts


def _backoffs(trie: Trie, ids: np.ndarray) -> np.ndarray:
    codes = np.zeros(len(ids), np.int64)
    edges = np.searchsorted(ids, trie.first)
    for part in np.flatnonzero(np.diff(edges)):
        _, (kept,) = read_file(f"{trie.path}/backoffs-{part}")
        codes[edges[part] : edges[part + 1]] = kept[ids[edges[part] : edges[part + 1]] - trie.first[part]]
    return codes


def unigram(trie: Trie, counts: np.ndarray) -> np.ndarray:
    """log10 of the words' discounted shares; what is taken off is the probability of an unknown word."""
    return np.log10(np.where(counts > 0, counts - trie.discounted, trie.discounted * trie.words) / max(1, trie.tokens))


# --- scoring --------------------------------------------------------------------------------------------------------


def _together(runs: Iterator[tuple[int, int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts joined to about `SCORED_TOGETHER` tokens: each part of the trie is then asked less often for more."""
    kept: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    for run in runs:
        kept.append(run)
        if sum(len(tokens) for _, _, tokens, _ in kept) >= SCORED_TOGETHER:
            yield _one_run(kept)
            kept = []
    if kept:
        yield _one_run(kept)


def _one_run(runs: list[tuple[int, int, np.ndarray, np.ndarray]]) -> tuple[int, int, np.ndarray, np.ndarray]:
    sizes = np.cumsum([0, *(len(tokens) for _, _, tokens, _ in runs)])
    edges = np.concatenate([[0], *(run[3][1:] + size for run, size in zip(runs, sizes))])
    return runs[0][0], sum(run[1] for run in runs), np.concatenate([run[2] for run in runs]), edges


def score(docs: DataFrame, trie: Trie, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    A token after a known context has the pair's discounted probability plus the context's backoff times the word's
    share; after an unknown one the word's share. Null and empty texts are the end alone. Without training texts every
    token is unknown and `score` equals `base_score`.
    """
    kinds = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [kind.split()[0] for kind in kinds.split(", ")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm = trie.tokens + 0.5 * (trie.words + 1)
        for batch in batches:
            for row, rows, tokens, edges in _together(tokens_of(batch.column(1))):
                unique, inverse = np.unique(tokens, return_inverse=True)
                ids, counts, before = trie.look_up(unique)
                base = np.log10((counts + 0.5) / norm)[inverse]
                if trie.tokens:
                    simple = unigram(trie, counts)
                    word, context = inverse, np.concatenate([[np.searchsorted(unique, END)], inverse[:-1]])
                    full = simple[word].copy()
                    known = np.flatnonzero(ids[context] >= 0)
                    pair, back = np.unique(context[known] * len(unique) + word[known], return_inverse=True)
                    c, w = np.divmod(pair, len(unique))
                    # Known ids ascend with the hashes; a context's unknown words keep its backoff.
                    kept = np.flatnonzero(ids[w] >= 0)
                    code = np.full(len(pair), -1, np.int64)
                    code[kept] = trie.pairs(ids[c[kept]], before[c[kept]], counts[c[kept]], ids[w[kept]])
                    own = np.unique(c)
                    backoff = np.zeros(len(unique), np.int64)
                    backoff[own] = _backoffs(trie, ids[own])
                    value = np.where(code >= 0, 10 ** decoded(code), 0.0) + 10 ** (decoded(backoff[c]) + simple[w])
                    full[known] = np.log10(value)[back]
                else:
                    full = base
                sums = lambda values, edges=edges: np.add.reduceat(values, edges[:-1])
                columns = [batch.column(0).slice(row, rows), np.diff(edges), sums((counts > 0).astype(np.int64)[inverse]), np.full(rows, trie.tokens), sums(base), sums(full)]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names)

    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(scored, kinds)
