"""Texts of an Arrow batch as one row of bytes, and hashes of any stretches of it."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task works on at a time (one text may be longer).
BLOCK_BYTES = 3_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A random 64-bit number for each byte.
_OF_BYTE = np.random.default_rng(20).integers(0, (1 << 64) - 1, 256, "uint64")


def blocks(batch: pa.RecordBatch, column: int, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batch with the bytes of their texts and the texts' bounds; NULL is empty."""
    texts = pc.fill_null(batch.column(column), "")
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype="int64")
    start = 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        data = np.frombuffer(b"".join(pc.cast(texts[start:stop], pa.binary()).to_pylist()), "uint8")
        yield batch.slice(start, stop - start), data, np.append(0, ends[start:stop] - before)
        start = stop
    give_back()


def give_back() -> None:
    """Freed memory back to the system: workers stay for later stages, and so would their heaps."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, "uint64")
    if n:
        out[0] = 1
    return np.cumprod(out, dtype="uint64")


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which :func:`stretch_hashes` takes the hash of any stretch."""
    out = np.zeros(len(data) + 1, "uint64")
    np.cumsum(_OF_BYTE[data] * powers(len(data)), out=out[1:])
    return out


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all of them."""
    hashes = hashes ^ (hashes >> np.uint64(32))
    hashes = hashes * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(29))


def stretch_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, inverse: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes give equal hashes wherever they stand."""
    inverse = powers(len(prefix), _INVERSE) if inverse is None else inverse
    return (prefix[ends] - prefix[starts]) * inverse[starts]


def inverse_powers(n: int) -> np.ndarray:
    return powers(n, _INVERSE)


def planes(values: np.ndarray, width: int) -> bytes:
    """Numbers byte by byte of rank, the lowest first: equal high bytes lie together and pack well."""
    return values.astype("<u8").view("uint8").reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(blob: bytes, width: int) -> np.ndarray:
    flat = np.frombuffer(blob, "uint8").reshape(width, -1)
    out = np.zeros((flat.shape[1], 8), "uint8")
    out[:, :width] = flat.T
    return out.view("<u8").ravel()


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case."""
    return _LOWER[data]


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the index of the first word of each text (and the last's end)."""
    inside = ~_IS_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = bounds[:-1][bounds[:-1] < len(data)]
    opens[firsts] |= inside[firsts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    closes[lasts] |= inside[lasts]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, bounds)


_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True


def unit_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a text begins, and at each space that follows no white space.

    No match of a pattern whose white space is ``\\s`` and whose words may begin with one space
    crosses such a place. After a character that may be a wide space nothing is cut.
    """
    if not len(data):
        return np.zeros(0, "int64")
    back = lambda n: np.append(np.zeros(n, "uint8"), data[:-n])[: len(data)]
    one, two, three = back(1), back(2), back(3)
    wide = (one >= 128) & (((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3)))
    cut = (data == 32) & ~_ASCII_SPACE[one] & ~wide
    cut[bounds[:-1][bounds[:-1] < len(data)]] = True
    return np.flatnonzero(cut)


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[start : start + size] one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)]


class UnitIds:
    """Ids of texts, where each distinct unit of them is encoded once and remembered.

    A subclass gives ``sizes``, the bytes that each id stands for, and ``encode``. Units are
    told apart by 64-bit hashes of their bytes.
    """

    #: Units remembered by one task; beyond it the memory starts anew, with the same results.
    MEMORY = 300_000
    #: Units that are encoded as one text.
    JOINED = 20_000

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self._forget()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many are each text's."""
        raise NotImplementedError

    def _forget(self) -> None:
        self.known = np.zeros(0, "uint64")
        self.start, self.count, self.ids = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, "int32")

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        joins = (data[starts] == 32) & ~_ASCII_SPACE[data[ends - 1]] & (data[ends - 1] < 128)
        order = np.argsort(~joins, kind="stable")
        hashes, starts, sizes, n = hashes[order], starts[order], (ends - starts)[order], int(joins.sum())
        cuts = [*range(0, n, self.JOINED), n] if n else [0]
        texts = [gathered(data, starts[a:b], sizes[a:b]).tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        joined = len(texts)
        texts += [data[a : a + b].tobytes().decode() for a, b in zip(starts[n:], sizes[n:], strict=True)]
        ids, counts = self.encode(texts)
        if n:
            first = ids[: counts[:joined].sum()]
            ends_in = np.searchsorted(np.cumsum(self.sizes[first]), np.cumsum(sizes[:n]), "right")
            ends_in[-1] = len(first)
            counts = np.concatenate([np.diff(ends_in, prepend=0), counts[joined:]])
        begin = len(self.ids) + np.cumsum(counts) - counts
        known, start, count = np.append(self.known, hashes), np.append(self.start, begin), np.append(self.count, counts)
        order = np.argsort(known)
        self.known, self.start, self.count = known[order], start[order], count[order]
        self.ids = np.append(self.ids, ids.astype("int32"))

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin (and the last's end)."""
        starts = unit_starts(data, bounds)
        if not len(starts):
            return np.zeros(0, "int32"), np.zeros(len(bounds), "int64")
        ends = np.append(starts[1:], len(data))
        hashes = stretch_hashes(prefix_hashes(data), starts, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > self.MEMORY:
            self._forget()
        at = np.searchsorted(self.known, distinct)
        fresh = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        fresh[inside] = self.known[at[inside]] != distinct[inside]
        if fresh.any():
            self._learn(distinct[fresh], data, starts[first[fresh]], ends[first[fresh]])
            at = np.searchsorted(self.known, distinct)
        counts = self.count[at][which]
        ids = gathered(self.ids, self.start[at][which], counts)
        return ids, np.append(0, np.cumsum(counts))[np.searchsorted(starts, bounds)]
