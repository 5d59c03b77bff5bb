"""Words of Arrow text columns as numpy arrays, many texts at a time and without Python strings."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at once, unless one text alone is longer.
BLOCK = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    values = values.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = (values ^ (values >> np.uint64(shift))) * np.uint64(factor)
    return values ^ (values >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257))
_BYTE[BLANK] = 0


@dataclass
class Texts:
    """Some successive texts: their bytes, and where each begins (one entry more than texts)."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def number(self) -> int:
        return len(self.offsets) - 1


def blocks(column: pa.Array, limit: int = BLOCK, most: int = 1 << 20) -> Iterator[Texts]:
    """The texts of ``column`` in blocks of about ``limit`` bytes and at most ``most`` texts.

    Missing texts are empty.
    """
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        past = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        past = min(max(past, first + 1), first + most, len(column))
        low, high = offsets[first], offsets[past]
        yield Texts(first, data[low:high], offsets[first : past + 1] - low)
        first = past


@dataclass
class Words:
    """The words of a block: first and past-the-end byte, hash, and the text that holds each."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    texts: np.ndarray


def words(block: Texts, fold: bool = False) -> Words:
    """Maximal runs of bytes other than blanks; ``fold`` lower-cases A-Z first.

    Equal words have equal hashes and words that differ in one byte never do.
    """
    data, size = block.data, len(block.data)
    if not size:
        none = np.zeros(0, np.int64)
        return Words(none, none, none.astype(np.uint64), none)
    if fold:
        data = LOWER[data]
    solid = ~BLANK[data]
    opens = solid.copy()
    opens[1:] &= ~solid[:-1]
    closes = solid.copy()
    closes[:-1] &= ~solid[1:]
    edges = block.offsets[:-1][np.diff(block.offsets) > 0]
    opens[edges] = solid[edges]
    closes[edges[1:] - 1] = solid[edges[1:] - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(starts):
        return Words(starts, ends, starts.astype(np.uint64), starts)
    longest = int((ends - starts).max())
    weights = mixed(np.arange(longest) + 1000) | np.uint64(1)
    place = np.arange(starts[0], size)
    place -= np.repeat(starts, np.diff(np.append(starts, size)))
    np.minimum(place, longest - 1, out=place)
    summed = np.add.reduceat(_BYTE[data[starts[0] :]] * weights[place], starts - starts[0])
    hashes = mixed(summed + (ends - starts).astype(np.uint64))
    texts = np.searchsorted(block.offsets, starts, "right") - 1
    return Words(starts, ends, hashes, texts)
