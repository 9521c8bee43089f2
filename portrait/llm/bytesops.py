"""Vectorised numpy helpers over the raw UTF-8 bytes of an Arrow text column.

A batch is processed in slices of half a megabyte (or one longer text), so the temporary arrays stay
small whatever the batch holds.  Words are runs of "word" bytes; all word
classes used here are unions of ASCII characters and of all non-ASCII ones, so
byte runs in UTF-8 and character runs in the text are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 512 << 10          # arrays of a slice stay within a processor's cache
_U = np.uint64

# Odd multipliers (fixed values): the golden-ratio constant and the finaliser
# constants published for 64-bit avalanche mixing.
GOLDEN = 0x9E3779B97F4A7C15
MIX1 = 0xFF51AFD7ED558CCD
MIX2 = 0xC4CEB9FE1A85EC53

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_WHITE = ~WHITE
ALNUM = np.zeros(256, bool)          # digits, letters and every non-ASCII byte
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit values."""
    h = h ^ (h >> _U(33))
    h = h * _U(MIX1)
    h = h ^ (h >> _U(33))
    h = h * _U(MIX2)
    return h ^ (h >> _U(33))


class Roller:
    """Hashes of arbitrary subranges of a sequence from one running sum:
    sum(T[x_i] * B^i) over the range, times B^-start (B odd, modulo 2^64)."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, seed: int):
        self.base = (GOLDEN * (2 * seed + 1) + 4 * seed) | 1
        self.base &= (1 << 64) - 1
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(0, 1 << 64, 256, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = self._powers.get(self.base)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            up = np.full(size, self.base, np.uint64)
            down = np.full(size, pow(self.base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            have = np.cumprod(up), np.cumprod(down)
            if size <= 16 * SLICE_BYTES:
                self._powers[self.base] = have
        return have

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Running sums of 64-bit values, with a leading zero."""
        up, _ = self.powers(len(values) + 1)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:len(values)], out=out[1:])
        return out

    def byte_sums(self, buf: np.ndarray) -> np.ndarray:
        return self.sums(self.table[buf])

    def ranges(self, sums: np.ndarray, start, stop) -> np.ndarray:
        _, down = self.powers(len(sums))
        return mix((sums[stop] - sums[start]) * down[start] + (stop - start).astype(np.uint64) * _U(GOLDEN))


    def windows(self, sums: np.ndarray, size: int) -> np.ndarray:
        """``ranges`` of every run of ``size`` elements."""
        _, down = self.powers(len(sums))
        out = sums[size:] - sums[:len(sums) - size]
        out *= down[:len(out)]
        out += _U(size * GOLDEN & (1 << 64) - 1)
        x = out >> _U(33)                        # mix(), in place
        for factor in (MIX1, MIX2):
            out ^= x
            out *= _U(factor)
            np.right_shift(out, _U(33), out=x)
        out ^= x
        return out


WORD = Roller(1)
GRAM = Roller(2)


def text_slices(col: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row count, bytes, offsets) for consecutive rows of a string
    column; a slice holds ``limit`` bytes or one longer row.  Null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    col = col.cast(pa.large_binary()).fill_null(b"")
    n = len(col)
    if n == 0:
        return
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64, n + 1 + col.offset)[col.offset:]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(off, off[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last - first, raw[off[first]:off[last]], off[first:last + 1] - off[first]
        first = last


def words_of(buf: np.ndarray, off: np.ndarray, kind: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and row of every word; words never cross rows.  The last
    array counts, for each row, the words before it (length rows + 1)."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    isw = np.zeros(n + 1, bool)
    isw[:n] = kind[buf]
    head = isw[:n].copy()
    head[1:] &= ~isw[:n - 1]
    cut = off[1:-1]
    cut = cut[cut < n]
    head[cut] = isw[cut]                       # a row's first byte starts a word
    start = np.flatnonzero(head)
    tail = isw[:n] & ~isw[1:]
    cut = cut[cut > 0] - 1
    tail[cut] = isw[cut]                       # and its last byte ends one
    stop = np.flatnonzero(tail) + 1
    return start, stop, np.searchsorted(start, off)


def word_hashes(buf: np.ndarray, start: np.ndarray, stop: np.ndarray, lower: bool = True) -> np.ndarray:
    sums = WORD.byte_sums(LOWER[buf] if lower else buf)
    return WORD.ranges(sums, start, stop)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (by first word), also of
    those crossing rows; the caller masks them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = GRAM.sums(words)
    at = np.arange(n)
    return GRAM.ranges(sums, at, at + size)


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts [2, 0, 3]: owner [0, 0, 2, 2, 2] and rank [0, 1, 0, 1, 2]."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner]
