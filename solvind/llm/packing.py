"""Token sequences: tokenize whole documents, cut long ones, pack the pieces by bounded-space online best fit."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solvind.llm.common import partitions_for, stored
from solvind.llm.textgrid import chunks, hash_runs

SEQUENCE = 2048
OPEN_BINS = 1024
PIECES_PER_TASK = 200_000
SORTED_TOGETHER = 2_000
CACHED_UNITS = 3_000_000
CHUNK_BYTES = 500_000  # text that a worker turns into ids at once
PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_TYPES = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())

# Classes of bytes: white space, letters whose case and normal form map one to one, ASCII marks, digits, all others.
SPACE, LETTER, MARK, DIGIT, OTHER = range(5)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[9, 10, 13, 32]] = SPACE
_CLASS[33:127] = MARK
_CLASS[48:58] = DIGIT
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[[39, 60]] = OTHER  # ' starts contractions, < may start a special token
_LEAD = 0xC3  # of the two-byte letters from U+00C0 to U+00FF


class UnitTokens:
    """Token ids of units: a run of letters, a run of marks, a digit, or any other word between spaces as a whole.

    The tokenizer splits a text at the same places, so a text's ids are those of its units. The ids of units met
    are kept in sorted arrays, `CACHED_UNITS` at most in a worker, about 20 bytes each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.letters = Tokenizer(self.full.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for word, number in vocabulary.items() if word.endswith("</w>")]] = True
        # The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from 256 on.
        self.alphabet = np.arange(256, dtype="<u4")
        others = [byte for byte in range(256) if not (33 <= byte < 127 or 161 <= byte < 173 or 174 <= byte)]
        self.alphabet[others] = 256 + np.arange(len(others))
        self.alphabet[32] = 32
        self.forget()

    def forget(self) -> None:
        self.ids = [np.zeros(0, "<u4")]
        self.size = 0
        nothing = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))
        self.known, self.fresh = nothing, nothing  # sorted hashes, where the ids begin, how many; few fresh, many known

    def chunk(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids before each text) of the texts that lie in `data` at `offsets`."""
        kinds = _CLASS[data]
        lead = np.flatnonzero(data[:-1] == _LEAD)
        tail = data[lead + 1]
        lead = lead[(tail >= 0x80) & (tail < 0xC0) & (tail != 0x97) & (tail != 0xB7)]
        kinds[lead] = kinds[lead + 1] = LETTER
        capital = lead[data[lead + 1] < 0x9F] + 1
        edge = np.zeros(len(data), bool)
        edge[offsets[:-1][offsets[:-1] < len(data)]] = True

        spaces = kinds == SPACE
        if (kinds == OTHER).any():  # a word with such a byte is one unit, as it is
            first = ~spaces
            first[1:] &= spaces[:-1] | edge[1:]
            starts = np.flatnonzero(first)
            odd = np.bitwise_or.reduceat((kinds == OTHER).view(np.uint8), starts) > 0
            lengths = np.diff(np.append(starts, len(data)))
            odd = np.concatenate([np.zeros(starts[0], bool), np.repeat(odd, lengths)]) & ~spaces
            kinds[odd] = OTHER
            capital = capital[kinds[capital] == LETTER]
        data = np.where((data >= 65) & (data <= 90) & (kinds == LETTER), data + np.uint8(32), data)
        data[capital] += np.uint8(32)
        first = ~spaces
        first[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT) | edge[1:]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        hashes = hash_runs(data, starts, ~spaces) ^ kinds[starts]
        unique, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        begins, counts = self.find(unique, data, spaces, kinds, starts, where)
        counts, begins = counts[inverse], begins[inverse]
        ends = np.cumsum(counts)
        flat = self.all_ids()[np.repeat(begins - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        return flat, np.concatenate([[0], ends])[np.searchsorted(starts, offsets)]

    def all_ids(self) -> np.ndarray:
        if len(self.ids) > 1:
            self.ids = [np.concatenate(self.ids)]
        return self.ids[0]

    def find(self, unique, data, spaces, kinds, starts, where) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each unit begin, and how many there are; unknown units are tokenized first."""
        if len(self.known[0]) + len(self.fresh[0]) + len(unique) > CACHED_UNITS:
            self.forget()
        begins, counts = np.full(len(unique), -1, np.int64), np.zeros(len(unique), np.int32)
        for hashes, at, n in (self.known, self.fresh):
            if len(hashes):
                spot = np.minimum(np.searchsorted(hashes, unique), len(hashes) - 1)
                same = hashes[spot] == unique
                begins[same], counts[same] = at[spot[same]], n[spot[same]]
        new = np.flatnonzero(begins < 0)
        if len(new):
            starts_of = starts[where[new]]
            ends_of = np.append(starts, len(data))[where[new] + 1]
            plain = kinds[starts_of] == LETTER
            self._letters(data, spaces, starts_of[plain], ends_of[plain], new[plain], begins, counts)
            rest = [bytes(data[a:b][~spaces[a:b]]).decode() for a, b in zip(starts_of[~plain], ends_of[~plain])]
            found = [e.ids for e in self.full.encode_batch_fast(rest, add_special_tokens=False)]
            self._keep(np.array([i for ids in found for i in ids], "<u4"), [len(ids) for ids in found], new[~plain], begins, counts)
            self._remember(unique[new], begins[new], counts[new])
        return begins, counts

    def _letters(self, data, spaces, begin, end, new, begins, counts, together: int = 500) -> None:
        """Many runs of letters in one call: each ends with the one id that marks a word's end."""
        if not len(begin):
            return
        lengths = end - begin
        ends = np.cumsum(lengths)
        spots = np.repeat(begin - (ends - lengths), lengths) + np.arange(ends[-1])
        line = np.where(spaces[spots], np.uint8(32), data[spots])
        keep = ~spaces[spots]
        keep[ends - 1] = True  # a space after each run, unless a mark or the text's end stands there
        owner = np.repeat(np.arange(len(begin)), lengths)
        line, owner = line[keep], owner[keep]
        closed = np.zeros(len(begin), bool)
        closed[owner[line == 32]] = True
        gaps = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)) + 1
        line = np.insert(line, gaps[~closed], 32)
        text = self.alphabet[line].tobytes().decode("utf-32-le")
        breaks = np.flatnonzero(line == 32)[together - 1 :: together] + 1
        lines = [text[a:b] for a, b in zip([0, *breaks], [*breaks, len(text)]) if a < b]
        ids = [np.array(e.ids, "<u4") for e in self.letters.encode_batch_fast(lines, add_special_tokens=False)]
        ids = np.concatenate(ids)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(begin):
            raise ValueError("the vocabulary has no single word end per word")
        self._keep(ids, np.diff(np.concatenate([[0], stops])), new, begins, counts)

    def _keep(self, ids, lengths, new, begins, counts) -> None:
        lengths = np.asarray(lengths, np.int64)
        begins[new] = self.size + np.cumsum(lengths) - lengths
        counts[new] = lengths
        self.ids.append(ids)
        self.size += len(ids)

    def _remember(self, *more: np.ndarray) -> None:
        if len(self.fresh[0]) > CACHED_UNITS // 16:
            self.known, self.fresh = _merged(self.known, self.fresh), tuple(x[:0] for x in self.fresh)
        self.fresh = _merged(self.fresh, more)


def _merged(a: tuple, b: tuple) -> tuple:
    both = [np.concatenate(pair) for pair in zip(a, b)]
    order = np.argsort(both[0], kind="stable")
    return tuple(x[order] for x in both)


_tokens: dict[str, UnitTokens] = {}


def unit_tokens(path: str) -> UnitTokens:
    """One per worker process, which tokenizes in one thread: a task has one core, and each thread would keep memory of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _tokens:
        _tokens[path] = UnitTokens(path)
    return _tokens[path]


def token_pieces(
    docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document: its ids, then id 0, cut every `sequence` ids.

    `tokenizer` is the path of a tokenizers file that every executor can read. A null text counts as empty: one
    piece of the single id 0.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = unit_tokens(tokenizer)
        for batch in batches:
            numbers = batch.column(0)
            for row, rows, data, offsets in chunks(batch.column(1), CHUNK_BYTES):
                ids, before = tokens.chunk(data, offsets)
                ids = np.insert(ids, before[1:], 0)  # the separator
                before = before + np.arange(rows + 1)
                lengths = np.diff(before)
                pieces = -(-lengths // sequence)
                owner = np.repeat(np.arange(rows), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * sequence
                length = np.minimum(lengths[owner] - start, sequence)
                data, at = ids.astype("<u4").tobytes(), (before[:-1][owner] + start) * 4
                sums = [zlib.crc32(data[a : a + n]) for a, n in zip(at.tolist(), (length * 4).tolist())]
                columns = [numbers.slice(row, rows).take(pa.array(owner)), piece.astype(np.int32), start, length, sums]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, PIECE_TYPES)]
                yield pa.RecordBatch.from_arrays(arrays, PIECE_NAMES)

    texts = docs.select(F.col(id_column).cast("long"), F.col(text_column))
    return texts.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


class OpenBins:
    """At most `most` open bins. A bit per amount of free space tells which amounts some open bin has."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.count, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of an item: in the open bin that it fills best, or else in a new one."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.count += 1
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        self.count -= 1
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        return number


def pack(pieces: DataFrame, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """`pieces` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Pieces are dealt to tasks by a hash of doc_id and piece, about `per_task` each. They arrive in batches of about
    `SORTED_TOGETHER`, the longest of a batch first, and go online into at most `open_bins` bins a task.
    Repeated rows are packed as often as they occur; an empty table gives no rows.
    """
    count = pieces.count()
    tasks = partitions_for(count, per_task)
    batches_per_task = partitions_for(-(-count // tasks), SORTED_TOGETHER)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, task = OpenBins(sequence, open_bins), None
        for batch in batches:
            spots = []
            for bucket, length in zip(batch.column("task").to_pylist(), batch.column("length").to_pylist()):
                if bucket != task:
                    bins, task = OpenBins(sequence, open_bins), bucket
                number, offset = bins.place(length)
                spots.append(((task << 32) + number, offset))
            ids, offsets = zip(*spots) if spots else ((), ())
            kept = [batch.column(name) for name in PIECE_NAMES]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.int64()), pa.array(offsets, pa.int64())],
                [*PIECE_NAMES, "sequence_id", "offset"],
            )

    deal = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(tasks * batches_per_task))
    dealt = pieces.withColumn("part", deal).withColumn("task", F.col("part") % tasks)
    return (
        dealt.repartition(tasks, "task")
        .sortWithinPartitions("task", "part", F.desc("length"), "doc_id", "piece", "ids_crc32")
        .mapInArrow(
            place,
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, **columns: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there; sequences have no gaps.

    Null and empty texts are one piece of length 1. Only the id and text columns are read.
    """
    return pack(stored(token_pieces(docs, tokenizer, sequence, **columns), "pieces"), sequence)
