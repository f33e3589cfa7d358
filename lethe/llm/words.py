"""Words of many texts at once, as numpy arrays: used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from lethe.llm.frames import ship

#: Bytes handled at once in a task.
SLICE = 4 << 20
_POSITIONS = 1 << 16
_HASHED = 1 << 20
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, _POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separators(more: bytes = b"") -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(SPACES + more)] = True
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sliced(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, bytes) of consecutive rows of about ``most`` bytes; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, offsets[row : end + 1] - offsets[row], data[offsets[row] : offsets[end]]
        row = end


@dataclass
class Words:
    """``hash`` of each word, its byte range, and for each text where its words begin."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more than texts


def words_of(offsets: np.ndarray, data: np.ndarray, table: np.ndarray, lower: bool = False) -> Words:
    inside = ~table[data]
    before = np.empty(len(data) + 1, dtype=bool)  # whether a word may not reach over this place
    before[1:] = ~np.append(inside, False)[:-1] if len(data) else False
    before[offsets] = True
    before[0] = True
    start = np.flatnonzero(inside & before[: len(data)])
    after = np.append(inside[1:], False) & ~before[1:] if len(data) else inside
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(np.zeros(0, np.uint64), start, end, first)
    size = end - start
    held = data[inside]
    if lower:
        held = _LOWER[held]
    begin = np.cumsum(size) - size
    sums = np.empty(len(size), np.uint64)
    # the numbers of a byte take eight times its room or more, so only some words have them at once
    cuts = np.unique(np.append(np.searchsorted(begin, np.arange(0, len(held), _HASHED)), len(size)))
    for a, b in zip(cuts, cuts[1:]):
        own = slice(begin[a], begin[b] if b < len(begin) else len(held))
        place = np.arange(own.start, own.stop) - np.repeat(begin[a:b], size[a:b])
        sums[a:b] = np.add.reduceat(_BYTE[held[own]] * _PLACE[place & (_POSITIONS - 1)], begin[a:b] - begin[a])
    return Words(mix(sums + size.astype(np.uint64)), start, end, first)


ship(__name__)
