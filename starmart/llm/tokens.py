"""Words of whole Arrow text columns as hash arrays, without a Python object per word.

Bytes of many texts lie in one buffer; a word's hash is a difference of two prefix sums of
a polynomial modulo 2**64, so splitting and hashing are a few numpy passes over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from starmart.llm.common import by_value

by_value(__name__)

SLICE_BYTES = 1 << 20
CHUNK_BYTES = 1 << 18
FULL = 1 << 64
BASE, WINDOW_BASES = 0x9E3779B97F4A7C15, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: int, n: int, kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    if base not in kept or len(kept[base][0]) < n:
        size = max(n, 1 << 16)
        kept[base] = tuple(
            np.cumprod(np.array([1] + [b] * size, np.uint64)) for b in (base, pow(base, -1, FULL))
        )
    return kept[base]


def byte_class(characters: bytes) -> np.ndarray:
    """True for the bytes that are not among the given ones."""
    table = np.ones(256, bool)
    table[list(characters)] = False
    return table


WORD_BYTES = byte_class(b" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    """hashes: of all words in order; first: where each text's words begin, and the end."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """For every word, its text and how many words of that text follow it, itself included."""
        counts = self.counts
        text = np.repeat(np.arange(len(counts)), counts)
        return text, np.repeat(self.first[1:], counts) - np.arange(self.first[-1])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about limit bytes each; a longer text is a range of its own."""
    sizes = np.nan_to_num(np.asarray(pa.compute.binary_length(column).fill_null(0)))
    total = np.cumsum(sizes)
    row = 0
    while row < len(total):
        before = total[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield row, end
        row = end


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64))
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        at = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, at + CHUNK_BYTES, side="right")))
        size = int(ends[high - 1] - at)
        power, inverse = powers(BASE, size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(table[data[at : at + size]] * power[:size], out=sums[1:])
        begin, end = starts[low:high] - at, ends[low:high] - at
        length = (end - begin).astype(np.uint64)
        out[low:high] = mix((sums[end] - sums[begin]) * inverse[begin] + mix(length))
        low = high
    return out


def words(column: pa.Array, inside: np.ndarray = WORD_BYTES, lower: bool = False) -> Words:
    """Split every text into runs of the inside bytes; NULL has none. lower: fold A-Z first."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    word = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    after = np.concatenate((word[1:], [False])) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    hashes = _word_hashes(LOWER[data] if lower else data, starts, ends)
    return Words(hashes, np.searchsorted(starts, offsets))


def window_hashes(hashes: np.ndarray, length: int, base: int = WINDOW_BASES[0]) -> np.ndarray:
    """The hash of every run of length words; the last length - 1 places hold nothing useful."""
    n = len(hashes)
    out = np.zeros(n, np.uint64)
    if n >= length:
        power, inverse = powers(base, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * power[:n], out=sums[1:])
        out[: n - length + 1] = mix((sums[length:] - sums[:-length]) * inverse[: n - length + 1])
    return out


def text_hashes(found: Words, base: int) -> np.ndarray:
    """One hash for each text's whole word sequence."""
    n = len(found.hashes)
    power, inverse = powers(base, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(found.hashes * power[:n], out=sums[1:])
    first = found.first
    whole = (sums[first[1:]] - sums[first[:-1]]) * inverse[first[:-1]]
    return mix(whole + mix(found.counts.astype(np.uint64)))


def signed(values: np.ndarray) -> pa.Array:
    """Hashes as the 64-bit integers Spark has."""
    return pa.array(values.view(np.int64))


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of 64-bit integers, counts of them each."""
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))
