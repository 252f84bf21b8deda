"""Words of many texts at once, as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D. Arrow keeps the texts of
a batch as one run of UTF-8 bytes, so words are found and hashed for the whole
batch without one Python object per text. Hashes are 64-bit sums of byte values
times powers, mixed at the end; ``salt`` gives independent ones.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
GAP = np.zeros(256, dtype=bool)
GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes hashed at once.
BLOCK = 1 << 18


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    doc: np.ndarray  # row of each word
    counts: np.ndarray  # words of each row

    @property
    def first(self) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column and where each row begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.fill_null("").cast(pa.large_string())
    _, at, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1]
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column, most: int = 1 << 20):
    """Parts of a column with up to ``most`` bytes of text each, one row at least, and where they begin."""
    offsets = utf8(column)[1]
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, column.slice(i, j - i)
        i = j


def find(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = GAP) -> Words:
    inside = ~gap[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = inside[edges]
    end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Words(data, starts, ends, doc, np.bincount(doc, minlength=len(offsets) - 1))


def words_of(column) -> Words:
    return find(*utf8(column))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all of its bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _random(salt: int, n: int) -> np.ndarray:
    return np.random.default_rng([20, salt]).integers(1, 2**64, n, dtype=np.uint64)


_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}


def _powers(salt: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse."""
    n = max(n, 2 * BLOCK)
    kept = _POWERS.get((salt, n))
    if kept is None:
        base = int(_random(salt, 257)[256]) | 5
        both = [np.full(n, b, np.uint64) for b in (base, pow(base, -1, 2**64))]
        for x in both:
            x[0] = 1
            np.cumprod(x, out=x)
        kept = tuple(both)
        if n == 2 * BLOCK:
            _POWERS[salt, n] = kept
    return kept


def word_hashes(w: Words, salt: int = 0, fold: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each word. ``fold`` maps bytes first, such as to lower case."""
    values = _random(salt, 257)[:256]
    if fold is not None:
        values = values[fold]
    out = np.zeros(len(w.starts), np.uint64)
    i = 0
    while i < len(w.starts):
        j = max(i + 1, int(np.searchsorted(w.ends, w.starts[i] + BLOCK, "right")))
        lo, hi = int(w.starts[i]), int(w.ends[j - 1])
        up, down = _powers(salt, hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(values[w.data[lo:hi]] * up[: hi - lo], out=sums[1:])
        a, b = w.starts[i:j] - lo, w.ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    return mix(out + (w.ends - w.starts).astype(np.uint64))


LOWER = np.arange(256)
LOWER[65:91] += 32


def grams(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on, and which of them stay in one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h *= U(0x9E3779B97F4A7C15)
        h += hashes[j : j + n]
    return mix(h), doc[:n] == doc[k - 1 :]


def first_of_runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    if len(sorted_values) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))
