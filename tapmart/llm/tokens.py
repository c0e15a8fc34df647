"""Words and word shingles of many texts at a time, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken in pieces of about this many bytes, so that arrays stay small.
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(611953)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def pieces(texts: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """``texts`` in runs of about ``most`` bytes, with the place of their first text. A text is
    never parted."""
    lengths = np.asarray(pc.binary_length(texts).fill_null(0))
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


class Words:
    """The lower-cased words of some texts; null counts as empty.

    ``data`` holds the texts' bytes one after the other, with A-Z lower-cased; word ``i`` is
    ``data[start[i]:end[i]]`` of text ``text[i]``. A word never goes over the end of a text.
    ``bounds[t]:bounds[t + 1]`` are the words of text ``t``.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("").cast(pa.large_string())
        texts = pa.concat_arrays([texts])
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
        self.data = _LOWER[raw[offsets[0] : offsets[-1]]]
        offsets = offsets - offsets[0]
        self.offsets = offsets
        full = ~_SPACE[self.data]
        first, last = full.copy(), full.copy()
        first[1:] &= ~full[:-1]
        last[:-1] &= ~full[1:]
        size = len(full)
        opens = offsets[:-1][offsets[:-1] < size]
        closes = offsets[1:][offsets[1:] > 0] - 1
        first[opens] = full[opens]
        last[closes] = full[closes]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.text = np.searchsorted(offsets[1:], self.start, "right")
        self.bounds = np.searchsorted(self.text, np.arange(len(texts) + 1))

    def hashes(self) -> np.ndarray:
        """A 64-bit number per word. Words are taken in runs of about ``PIECE_BYTES`` bytes."""
        found = np.zeros(len(self.start), dtype=np.uint64)
        longest = int((self.end - self.start).max()) if len(found) else 0
        powers = np.full(longest + 1, _BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        first = 0
        while first < len(found):
            head = self.start[first]
            stop = max(first + 1, int(np.searchsorted(self.start, head + PIECE_BYTES)))
            start = self.start[first:stop] - head
            data = self.data[head : self.end[stop - 1]]
            place = np.arange(len(data)) - np.repeat(start, np.diff(np.append(start, len(data))))
            np.minimum(place, longest, out=place)
            found[first:stop] = mix(np.add.reduceat(_BYTE[data] * powers[place], start))
            first = stop
        return found

    def shingles(self, width: int) -> list[np.ndarray]:
        """Per text the sorted distinct numbers of its shingles of ``width`` words. A text of
        fewer words has one, of all its words; a text without words has none."""
        h = self.hashes()
        rows = max(len(h) - width + 1, 0)
        sums = np.zeros(rows, dtype=np.uint64)
        for j in range(width):
            sums += h[j : j + rows] * _STEP[j]
        sums = mix(sums)
        found = []
        for begin, stop in zip(self.bounds[:-1], self.bounds[1:]):
            count = stop - begin
            if count >= width:
                found.append(np.unique(sums[begin : stop - width + 1]))
            elif count:
                part = (h[begin:stop] * _STEP[:count]).sum(dtype=np.uint64)
                found.append(mix(np.array([part + np.uint64(count)], dtype=np.uint64)))
            else:
                found.append(np.zeros(0, dtype=np.uint64))
        return found
