"""Numpy kernels over Arrow string columns, shared by the text operators.

A batch's texts are one UTF-8 byte buffer with row offsets, so words are found
and hashed with array operations instead of a Python call per word.  Working
memory follows the chunk size (about 1 MB of text) or the one longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15          # odd, hence invertible modulo 2^64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """256 flags, true for the byte ranges given (ends included)."""
    flags = np.zeros(256, bool)
    for lo, hi in ranges:
        flags[lo:hi + 1] = True
    return flags


# ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
# Everything but space, tab, line feed, vertical tab, form feed, carriage return.
NON_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
UPPER = byte_class((0x41, 0x5A))
DIGIT = byte_class((0x30, 0x39))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return _LOWER[buf]


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of about
    ``limit`` bytes; a null text has no bytes, a longer text is a run alone."""
    if len(texts) == 0:
        return
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offs, offs[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(texts))
        yield first, end, raw[offs[first]:offs[end]], offs[first:end + 1] - offs[first]
        first = end


def word_spans(buf: np.ndarray, offs: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of ``member`` bytes inside each
    text, and for each text the index of its first word (one more entry at the end)."""
    inside = member[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span's bytes, equal for equal bytes wherever they
    stand: polynomial prefix sums modulo 2^64, a block of bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        lo = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, "right")))
        n = int(ends[b - 1]) - lo
        size = max(CHUNK_BYTES, 1 << (n - 1).bit_length())
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((buf[lo:lo + n].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, size)[:n], out=total[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        h = (total[e] - total[s]) * _powers(_BASE_INVERSE, size)[s]
        out[a:b] = mix(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        a = b
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (no check of text
    borders): entry i covers words i to i + n - 1."""
    count = max(0, len(words) - n + 1)
    h = np.zeros(count, np.uint64)
    for j in range(n):
        h = h * np.uint64(0xC2B2AE3D27D4EB4F) + words[j:j + count]
        h ^= h >> np.uint64(29)
    return mix(h)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """Text number of every word, from the bounds of ``word_spans``."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def class_runs(buf: np.ndarray, offs: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like ``word_spans`` for the maximal runs of bytes of one class (0: none);
    also gives the class of every run."""
    kind = classes[buf]
    border = np.zeros(len(buf) + 1, bool)
    border[offs] = True
    border[1:-1] |= kind[1:] != kind[:-1]
    border[-1:] = True
    at = np.flatnonzero(border)
    at = at[at < len(buf)]
    ends = np.append(at[1:], len(buf))
    used = kind[at] > 0
    starts, ends = at[used], ends[used]
    return starts, ends, np.searchsorted(starts, offs), kind[starts] if len(starts) else kind[:0]


def counts_within(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many flags are set in each span."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]
