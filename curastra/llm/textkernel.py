"""Byte-level text kernels shared by the corpus operators.

Every kernel works on the UTF-8 buffer of a whole Arrow batch at once, so that splitting words and hashing
them costs a few numpy passes over the bytes instead of a Python call per word. White space is the ASCII set
``\\x20 \\x09-\\x0D``; in UTF-8 those bytes never occur inside another character, so words are byte runs.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit values in which every output bit depends on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives freed memory back: workers outlive their tasks, and what they hold counts against their executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, by doubling; kept per process."""
    have = _powers.get(name)
    if have is None or len(have) <= n:
        out = np.ones(max(n + 1, BLOCK_BYTES + 1), dtype=np.uint64)
        done = 1
        while done < len(out):
            step = min(done, len(out) - done)
            out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        _powers[name] = have = out
    return have


@dataclass
class Words:
    """Words of some texts: byte places in ``data``, and for each text the range of its words."""

    data: np.ndarray  # uint8, of all texts
    text_at: np.ndarray  # int64, n + 1 byte offsets of texts
    start: np.ndarray  # int64 byte place of each word
    end: np.ndarray
    first: np.ndarray  # int64, n + 1: words first[i]:first[i + 1] belong to text i

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span: a polynomial over per-byte random codes, by differences of prefix sums."""
    n = len(data)
    up, down = _power("up", _BASE, n), _power("down", _BASE_INV, n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * up[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs (first text, last text + 1, bytes, offsets) of about ``limit`` bytes; one longer text makes a run of its own.

    A null text is an empty one.
    """
    for chunk in texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts]:
        if len(chunk):
            yield from _blocks(chunk, limit)
    release()


def _blocks(arr: pa.Array, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    _, at, data = arr.buffers()
    at = np.frombuffer(at, dtype=np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        j = min(j, len(arr))
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def split_words(data: np.ndarray, at: np.ndarray, breaks: np.ndarray = SPACE) -> Words:
    """Maximal runs of bytes that are not in ``breaks``; a word never spans two texts."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = ~breaks[data]
    # a boundary between texts ends a word even without white space
    edge = np.diff(inside)
    start = np.flatnonzero(edge == 1)
    end = np.flatnonzero(edge == -1)
    cut = at[1:-1]
    if len(cut):
        cut = np.unique(cut[(cut > 0) & (cut < n)])
        cut = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
        if len(cut):
            start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    first = np.searchsorted(start, at)
    return Words(data, at, start, end, first)


def sequence_hashes(h: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hash of the word hashes h[first:last] of each span, by differences of prefix sums."""
    up, down = _power("up", _BASE, len(h)), _power("down", _BASE_INV, len(h))
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(mix(h + np.uint64(1)) * up[: len(h)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
