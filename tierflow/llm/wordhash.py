"""Word and word-window hashes of many texts at a time, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time; a longer text is a piece by itself.
PIECE_BYTES = 1 << 18
#: Odd multipliers of the byte and of the word polynomials, modulo 2 ** 64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BYTE_BASE))


class Powers:
    """Powers of an odd base and of its inverse, as far as they have been needed."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 1 << 64)
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def upto(self, count: int) -> list[np.ndarray]:
        for k, base in enumerate(self.bases):
            table = self.tables[k]
            while len(table) < count:
                step = np.uint64(pow(base, len(table), 1 << 64))
                table = np.concatenate([table, table * step])
            self.tables[k] = table
        return self.tables


_BYTE_POWERS, _WORD_POWERS = Powers(BYTE_BASE), Powers(WORD_BASE)


def _sums(values: np.ndarray, powers: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return sums


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` word hashes; it depends on the words alone."""
    if len(words) < width:
        return np.empty(0, np.uint64)
    up, down = _WORD_POWERS.upto(len(words) + 1)
    sums = _sums(words, up)
    return mixed((sums[width:] - sums[:-width]) * down[: len(words) - width + 1])


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Runs of neighbouring texts of about `limit` bytes, each with the place of its first."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield start, texts.slice(start, stop - start)
        start = stop


class Words:
    """The words of some texts: where they lie in `data`, their hashes, and the words of each text.

    Words are runs of bytes other than 0x20 and 0x09 to 0x0D, unchanged, or with A-Z
    lower-cased. Null texts have none.
    The words of text `k` are numbers `bounds[k]` to `bounds[k + 1]`.
    """

    def __init__(self, texts: pa.Array, fold: bool = False):
        whole = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
        base = int(offsets[0]) if len(offsets) else 0
        raw = whole.buffers()[2]
        end = int(offsets[-1]) if len(offsets) else 0
        self.data = np.frombuffer(raw, np.uint8)[base:end] if raw else np.empty(0, np.uint8)
        if fold:
            self.data = LOWER[self.data]
        edges = offsets - base
        inside = ~SPACE[self.data]
        before = np.zeros(len(inside), bool)
        before[1:] = inside[:-1]
        first = edges[:-1]
        before[first[first < len(inside)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(inside), bool)
        after[:-1] = inside[1:]
        last = edges[1:] - 1
        after[last[last >= 0]] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.starts, edges)
        self.hashes = self._hashes()

    def _hashes(self) -> np.ndarray:
        made = [np.empty(0, np.uint64)]
        at = 0
        while at < len(self.starts):
            origin = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, origin + PIECE_BYTES, "right")))
            part = self.data[origin : self.ends[to - 1]]
            up, down = _BYTE_POWERS.upto(len(part) + 1)
            sums = _sums(BYTE_VALUES[part], up)
            starts, ends = self.starts[at:to] - origin, self.ends[at:to] - origin
            made.append(mixed((sums[ends] - sums[starts]) * down[starts]))
            at = to
        return np.concatenate(made)

    @cached_property
    def _joined(self) -> tuple[memoryview, np.ndarray]:
        """All words with one space after each, and where each begins."""
        lengths = self.ends - self.starts + 1
        to = np.cumsum(lengths)
        shift = np.repeat(self.starts - (to - lengths), lengths)
        out = self.data[np.minimum(np.arange(len(shift)) + shift, len(self.data) - 1)]
        out[to - 1] = 0x20
        return memoryview(out.tobytes()), np.concatenate([[0], to])

    def text(self, first: int, last: int) -> memoryview:
        """Words `first` to `last` (exclusive), joined by one space."""
        joined, at = self._joined
        return joined[at[first] : max(at[last] - 1, at[first])]

    def kept(self, first: int, left: np.ndarray) -> bytes:
        """The words from `first` on that are marked, joined by one space."""
        joined, at = self._joined
        whole = np.frombuffer(joined, np.uint8)[at[first] : at[first + len(left)]]
        return whole[np.repeat(left, np.diff(at[first : first + len(left) + 1]))][:-1].tobytes()
