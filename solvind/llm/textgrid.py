"""Words and shingles of Arrow text columns as numpy arrays of 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000
_U = np.uint64
_SPREAD = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, _U))  # odd multiplier's powers, modulo 2^64
_PLACES = _SPREAD ^ (_SPREAD >> np.uint64(29))  # a number for each place in a word
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits look independent (the splitmix finaliser)."""
    values = values ^ (values >> _U(30))
    values = values * _U(0xBF58476D1CE4E5B9)
    values ^= values >> _U(27)
    values *= _U(0x94D049BB133111EB)
    values ^= values >> _U(31)
    return values


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows of about `limit` bytes; null texts are empty.

    A text longer than `limit` is a chunk of its own.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, places, data = texts.buffers()
    places = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(places, places[row] + limit, "right")) - 1)
        end = min(end, len(texts))
        yield row, end - row, data[places[row] : places[end]], places[row : end + 1] - places[row]
        row = end


def hash_runs(data: np.ndarray, starts: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the counted bytes from each start up to the next one; they stand at the beginning.

    Blocks of eight bytes are mixed with their place before they are summed up, and the length is mixed in, so that no
    change of bytes or of their order is a sum that another change undoes.
    """
    if not len(starts):
        return np.zeros(0, _U)
    lengths = np.diff(np.append(starts, len(data)))
    places = np.arange(starts[0], len(data), dtype=np.int64)
    places -= np.repeat(starts, lengths)
    inside = counted[starts[0] :]
    values = np.where(inside, data[starts[0] :], 0).astype(_U) << ((places & 7) << 3).astype(_U)
    heads = np.flatnonzero((places & 7 == 0) & inside)
    blocks = np.add.reduceat(values, heads)
    blocks = mix(blocks ^ _PLACES[places[heads] >> 3 & 0xFFFF] ^ mix((places[heads] >> 19).astype(_U)))
    sums = np.add.reduceat(blocks, np.searchsorted(heads, starts - starts[0]))
    sizes = np.add.reduceat(inside, starts - starts[0], dtype=np.int64).astype(_U)
    return mix(sums + mix(sizes * _U(0xD1342543DE82EF95)))


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each word starts, its bytes): words are runs of non-space bytes within a text."""
    inside = ~_SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges < len(data)) & (edges > 0)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, words before each text), A-Z counting as a-z.

    `offsets` are the texts' places in `data`; the second array has one entry more than there are texts.
    """
    data = _LOWER[data]
    starts, _ = word_starts(data, offsets)
    return hash_runs(data, starts, ~_SPACE[data]), np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, shingles before each text): `width` words each; a text with fewer words has one of all of them."""
    counts = np.diff(before)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    after = np.concatenate([[0], np.cumsum(sizes)])
    heads = np.arange(after[-1]) - np.repeat(after[:-1], sizes) + np.repeat(before[:-1], sizes)
    left = np.repeat(before[1:], sizes) - heads  # words from the head to the text's end
    total = np.zeros(len(heads), _U)
    for k in range(width):
        there = left > k
        part = mix(hashes[np.minimum(heads + k, len(hashes) - 1)] + _SPREAD[k]) if len(heads) else total
        total = total * _U(0xD1342543DE82EF95) + np.where(there, part, _U(0))
    return mix(total), after


def distinct(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text in ascending order, and how many stand before each text."""
    rows = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    counts = np.bincount(rows[fresh], minlength=len(before) - 1)
    return values[fresh], np.concatenate([[0], np.cumsum(counts)])
