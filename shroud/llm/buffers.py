"""UTF-8 text columns as numpy buffers, and vectorised hashes of their substrings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# An odd base: multiplication by its powers is invertible modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; row i is bytes[offsets[i]:offsets[i + 1]], NULL empty."""
    flat = pc.fill_null(column, "").cast(pa.large_binary())
    if not len(flat):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = flat.buffers()
    at = np.frombuffer(offsets, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(part: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with about ``max_bytes`` of text each (a longer text alone)."""
    if not part.num_rows:
        return
    size = pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size, dtype=np.int64) // max_bytes
    cuts = np.r_[0, np.flatnonzero(np.diff(group)) + 1, part.num_rows]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        yield part.slice(a, b - a)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done, step = 1, base
    while done < n:
        more = min(done, n - done)
        with np.errstate(over="ignore"):
            out[done:done + more] = out[:more] * np.uint64(step)
        done, step = done + more, step * step % (1 << 64)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class Substrings:
    """Hashes of any substrings of one byte buffer from its prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            terms = (data.astype(np.uint64) + np.uint64(1)) * powers(n)[:n]
            self.prefix = np.r_[np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)]
        self.back = powers(n + 1, inverse)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.prefix[ends] - self.prefix[starts]) * self.back[starts]
                       + (ends - starts).astype(np.uint64))


def word_spans(is_word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal runs of word bytes; runs don't cross row borders."""
    n = len(is_word)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    before = np.r_[False, is_word[:-1]] if n else is_word
    starts = np.flatnonzero(is_word & (~before | border[:n]))
    after = np.r_[is_word[1:], False] if n else is_word
    ends = np.flatnonzero(is_word & (~after | border[1:])) + 1
    return starts, ends
