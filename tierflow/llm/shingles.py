"""Word shingles of one text as 64-bit hashes, and compact runs of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

from tierflow.llm.wordhash import Words, pieces, window_hashes


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text, many texts at a time.

    Words lie between white space (0x20, 0x09 to 0x0D), with A-Z lower-cased. A text of
    fewer than `width` words is one shingle; a text without words, or null, has none.
    """
    for _, some in pieces(texts):
        words = Words(some, fold=True)
        runs = window_hashes(words.hashes, width)
        for first, last in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
            if last - first >= width:
                yield np.unique(runs[first : last - width + 1])
            elif last > first:
                whole = xxhash.xxh64_intdigest(words.text(first, last), seed=last - first)
                yield np.array([whole], np.uint64)
            else:
                yield np.empty(0, np.uint64)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The shingles of one text."""
    return next(shingle_sets(pa.array([text], pa.string()), width))


def set_digest(shingles: np.ndarray) -> bytes:
    """128-bit digest of a whole set."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def overlap(short: np.ndarray, long: np.ndarray) -> int:
    """Common members of two sorted sets, by binary probes into the longer one."""
    if len(short) > len(long):
        short, long = long, short
    if not len(short):
        return 0
    at = np.searchsorted(long, short)
    at[at == len(long)] = 0
    return int((long[at] == short).sum())


def packed(sorted_keys: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed byte planes of their differences."""
    steps = np.diff(sorted_keys.astype("<u4"), prepend=np.uint32(0)).astype("<u4")
    planes = steps.view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)
