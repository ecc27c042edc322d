"""Words and rolling hashes of a batch of texts, computed on whole byte arrays with numpy.

A batch is handled in slices of whole texts, about `SLICE` bytes each, so memory is bounded
by the slice or by the longest single text. Hashes are polynomials modulo 2**64 over random
byte values, mixed at the end; equal byte strings have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[65:91] = _BYTE[97:123]
_WORD_BYTE = np.ones(256, bool)
_WORD_BYTE[[32, *range(9, 14)]] = False
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0 to n of the base or of its inverse."""
    if len(_powers[kind]) <= n:
        step = np.uint64(_BASE if kind == "up" else pow(_BASE, -1, 2**64))
        row = np.full(max(n + 1, SLICE + SLICE // 2), step, np.uint64)
        row[0] = 1
        _powers[kind] = np.multiply.accumulate(row)
    return _powers[kind]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finishing step that spreads all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def as_binary(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a text column, null as empty."""
    if not pa.types.is_binary(column.type):
        column = column.cast(pa.binary())
    return column.fill_null(b"") if column.null_count else column


class Texts:
    """One slice: `data` holds the bytes of texts `first` to `first + n` of the batch."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first, self.n = data, offsets, first, len(offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def prefix(self, lower: bool = False) -> np.ndarray:
        """Running sums from which `gram` takes the hash of any span."""
        out = np.empty(len(self.data) + 1, np.uint64)
        out[0] = 0
        table = _LOWER_BYTE if lower else _BYTE
        np.cumsum(table[self.data] * _power("up", len(self.data))[: len(self.data)], out=out[1:])
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of each word."""
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = _WORD_BYTE[self.data]
        edge = np.zeros(len(self.data) + 1, bool)
        edge[self.offsets] = True
        here, before = inside[1:-1], inside[:-2]
        starts = np.flatnonzero(here & (~before | edge[:-1]))
        ends = np.flatnonzero(here & (~inside[2:] | edge[1:])) + 1
        owner = np.searchsorted(self.offsets, starts, "right") - 1
        return starts, ends, owner


def gram(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans [starts, ends)."""
    down = _power("down", len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[Texts]:
    """The texts of an Arrow string or binary column, in slices."""
    column = as_binary(column)
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        own = offsets[at : to + 1].astype(np.int64)
        yield Texts(data[own[0] : own[-1]], own - own[0], at)
        at = to


def word_hashes(part: Texts, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word."""
    starts, ends, owner = part.words()
    return gram(part.prefix(lower), starts, ends), owner


_WINDOW = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(part: Texts, size: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its `size`-word runs, A-Z in lower case.

    A text with fewer words has one element, its whole word sequence; one without words none.
    """
    hashes, owner = word_hashes(part)
    first = np.searchsorted(owner, np.arange(part.n + 1))
    full = max(0, len(hashes) - size + 1)
    runs = np.zeros(full, np.uint64)
    for j in range(size):
        runs += mixed(hashes[j : j + full] * _WINDOW[j])
    runs = mixed(runs)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(runs[a : b - size + 1])
        elif b > a:
            # the shift keeps short sequences apart from each other and from full runs
            yield mixed(mixed(hashes[a:b] * _WINDOW[: b - a]).sum(keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
