"""Monotone integers in Elias-Fano form: low bits packed, high bits in unary, found again through sampled ranks."""

from __future__ import annotations

import numpy as np

_BLOCK = 8  # words of 64 bits between samples
_SELECT = np.full((256, 8), 8, np.uint8)  # place of the k-th one in a byte
for _byte in range(256):
    _ones = [_bit for _bit in range(8) if _byte >> _bit & 1]
    _SELECT[_byte, : len(_ones)] = _ones


def _packed(bits: np.ndarray) -> np.ndarray:
    data = np.packbits(bits, bitorder="little")
    return np.pad(data, (0, -len(data) % 8 + 8)).view(np.uint64)  # a spare word, so that reads may run over


class EliasFano:
    """`low`, `high` and `ranks` may be memory-mapped. `length` values, each with `width` low bits."""

    def __init__(self, length: int, width: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.length, self.width, self.low, self.high, self.ranks = length, width, low, high, ranks
        self._zeros: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        last = int(values[-1]) if len(values) else 0
        width = max(0, (last // max(1, len(values))).bit_length() - 1)
        low = np.zeros(1, np.uint64)
        if width:
            parts = [((values[at : at + 100_000, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel() for at in range(0, len(values), 100_000)]
            low = _packed(np.concatenate(parts)) if parts else low
        unary = np.zeros(len(values) + (last >> width) + 1, np.uint8)
        unary[(values >> np.uint64(width)).astype(np.int64) + np.arange(len(values))] = 1
        high = _packed(unary)
        high = np.pad(high, (0, -len(high) % _BLOCK))
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(high).reshape(-1, _BLOCK).sum(axis=1, dtype=np.int64))]).astype(np.uint32)
        return cls(len(values), width, low, high, ranks)

    def arrays(self) -> list[np.ndarray]:
        return [self.low, self.high, self.ranks]

    def __getitem__(self, places: np.ndarray) -> np.ndarray:
        """Values at `places`, each from 0 to `length` - 1."""
        places = np.asarray(places, np.int64)
        block = np.searchsorted(self.ranks, places, "right") - 1
        rest = places - self.ranks[block]
        words = self.high[block[:, None] * _BLOCK + np.arange(_BLOCK)]
        word, rest = self._step(np.bitwise_count(words), rest)
        chosen = words[np.arange(len(words)), word]
        octets = (chosen[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8))).astype(np.uint8)
        octet, rest = self._step(np.bitwise_count(octets), rest)
        spot = (block * _BLOCK + word) * 64 + octet * 8 + _SELECT[octets[np.arange(len(octets)), octet], rest]
        value = (spot - places).astype(np.uint64) << np.uint64(self.width)
        value |= self._low(places)
        return value

    def _zero(self, which: np.ndarray) -> np.ndarray:
        """Where the `which`-th zero of the high bits stands."""
        if self._zeros is None:
            self._zeros = np.arange(len(self.ranks), dtype=np.int64) * (64 * _BLOCK) - self.ranks
        block = np.searchsorted(self._zeros, which, "right") - 1
        rest = which - self._zeros[block]
        words = ~self.high[block[:, None] * _BLOCK + np.arange(_BLOCK)]
        word, rest = self._step(np.bitwise_count(words), rest)
        chosen = words[np.arange(len(words)), word]
        octets = (chosen[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8))).astype(np.uint8)
        octet, rest = self._step(np.bitwise_count(octets), rest)
        return (block * _BLOCK + word) * 64 + octet * 8 + _SELECT[octets[np.arange(len(octets)), octet], rest]

    def _low(self, places: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(places), np.uint64)
        bit = places * self.width
        at, shift = bit >> 6, (bit & 63).astype(np.uint64)
        return ((self.low[at] >> shift) | (self.low[at + 1] << np.uint64(1) << (np.uint64(63) - shift))) & np.uint64((1 << self.width) - 1)

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it is not there. Values that share their high bits stand together: two
        zeros enclose them, and a binary search looks at low bits only."""
        found = np.full(len(values), -1, np.int64)
        if not self.length:
            return found
        values = np.asarray(values, np.uint64)
        asked = np.flatnonzero(values <= self[np.array([self.length - 1])][0])
        top = (values[asked] >> np.uint64(self.width)).astype(np.int64)
        low = np.where(top > 0, self._zero(np.maximum(top - 1, 0)) + 1, 0) - top
        high = self._zero(top) - top
        end, wanted = high.copy(), values[asked] & np.uint64((1 << self.width) - 1)
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            under = self._low(middle) < wanted[active]
            low[active] = np.where(under, middle + 1, low[active])
            high[active] = np.where(under, high[active], middle)
            active = active[low[active] < high[active]]
        some = np.flatnonzero(low < end)
        some = some[self._low(low[some]) == wanted[some]]
        found[asked[some]] = low[some]
        return found

    @staticmethod
    def _step(counts: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = np.cumsum(counts, axis=1, dtype=np.int64)
        which = (sums <= rest[:, None]).sum(axis=1)
        before = sums[np.arange(len(sums)), which] - counts[np.arange(len(sums)), which]
        return which, rest - before
