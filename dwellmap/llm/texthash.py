"""Hashes of words and word sequences of UTF-8 texts, as NumPy arrays.

The functions run inside Spark tasks on Arrow batches. They work on a few megabytes of text at a time,
whole documents always, so memory follows the longest document, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

_CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values, so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte; A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64))
    values[65:91] = values[97:123]
    return values


@lru_cache(maxsize=1)
def _separators() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base, or of its inverse modulo 2**64."""
    known = _powers.get(kind)
    if known is None or len(known) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        known = np.full(max(n, 2 * _CHUNK_BYTES), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 8 * _CHUNK_BYTES:
            _powers[kind] = known
    return known[:n]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    wide = texts.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) for runs of whole texts of about a megabyte."""
    data, bounds = utf8(texts)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + _CHUNK_BYTES, "right")) - 1)
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


def words(
    data: np.ndarray, bounds: np.ndarray, separators: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each text the number of words before it (one more at the end).

    A word is a run of bytes other than separators (a table of 256 flags; ASCII white space unless
    given), after A-Z became a-z.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    solid = ~(_separators() if separators is None else separators)[data]
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    # A text starts and ends words, whatever its neighbours are.
    inner = bounds[(bounds > 0) & (bounds < n)]
    opens[inner] |= solid[inner]
    closes[inner - 1] |= solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_byte_values()[data] * _power("up", n), out=total[1:])
    hashes = mix((total[ends] - total[starts]) * _power("down", n)[starts])
    return hashes, np.searchsorted(starts, bounds)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words.

    A text with fewer words has its whole sequence as its one element, a text without words none.
    """
    with np.errstate(over="ignore"):
        scale = mix(np.arange(1001, 1001 + size, dtype=np.uint64)) | np.uint64(1)
        for first, last, data, bounds in chunks(texts):
            hashes, at = words(data, bounds)
            count = len(hashes) - size + 1
            runs = np.zeros(max(count, 0), np.uint64)
            for i in range(size if count > 0 else 0):
                runs += hashes[i : i + count] * scale[i]
            runs = mix(runs)
            for row in range(last - first):
                lo, hi = at[row], at[row + 1]
                if hi - lo >= size:
                    yield np.unique(runs[lo : hi - size + 1])
                elif hi > lo:
                    short = (hashes[lo:hi] * scale[: hi - lo]).sum(dtype=np.uint64)
                    yield mix(np.array([short], np.uint64) + np.uint64(hi - lo))
                else:
                    yield np.zeros(0, np.uint64)
