"""Hashed terms of token lists as sparse vectors, a batch at a time (runs in the
tasks: numpy and Arrow only)."""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LONG = 64        # words of four bytes hashed for all terms at once; longer terms go on alone
SLICE = 50000    # tokens hashed at a time, whole rows


def murmur3(buf: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int = 42) -> np.ndarray:
    """Murmur3 (x86, 32 bits, as ``HashingTF`` takes it) of the bytes start..stop of
    every range of a buffer, four bytes of all ranges at a time."""
    def mixed(k):
        k = k * np.uint32(0xCC9E2D51)
        return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)

    def rounds(h, k):
        h = h ^ k
        return (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)

    size = stop - start
    order = np.argsort(-size, kind="stable")
    at, size = start[order], size[order]
    b = np.concatenate([buf, np.zeros(3, np.uint8)]).astype(np.uint32)
    words = mixed(b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24))
    h = np.full(len(at), seed, np.uint32)
    blocks = size >> 2
    many = np.cumsum(np.bincount(np.minimum(blocks, LONG))[::-1])[::-1] if len(at) else []
    for i, n in enumerate(many[1:]):                  # the longest ranges come first
        h[:n] = rounds(h[:n], words[at[:n] + 4 * i])
    for j in np.flatnonzero(blocks > LONG).tolist():  # few and long: one by one
        x = int(h[j])
        for k in words[at[j] + 4 * LONG:at[j] + 4 * int(blocks[j]):4].tolist():
            x ^= k
            x = ((x << 13 | x >> 19) * 5 + 0xE6546B64) & 0xFFFFFFFF
        h[j] = x
    rest, end = size & 3, at + (blocks << 2)
    tail = np.zeros(len(at), np.uint32)
    for i in range(3):
        more = rest > i
        tail[more] |= b[end[more] + i] << np.uint32(8 * i)
    h = h ^ mixed(tail) ^ size.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    out = np.empty_like(h)
    out[order] = h ^ h >> np.uint32(16)
    return out


def _vectors(tokens: pa.ListArray, bits: int) -> pa.Array:
    """Sparse vectors of hashed unigrams and bigrams of each row's tokens.  A blank
    is set after every token, so that a bigram is a range of bytes like a token."""
    text = lambda x: pa.scalar(x, pa.large_string())
    words = pc.binary_join_element_wise(tokens.flatten().cast(pa.large_string()), text(""), text(" "))
    count = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(count)), count)
    stop = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    start = np.append(0, stop[:-1])[:len(stop)]
    stop = stop - 1
    pair = np.flatnonzero(row[1:] == row[:-1])
    buf = np.frombuffer(words.buffers()[2], np.uint8) if len(words) else np.zeros(0, np.uint8)
    hashes = murmur3(buf, np.append(start, start[pair]), np.append(stop, stop[pair + 1]))
    key = np.append(row, row[pair]) << bits | (hashes & np.uint32((1 << bits) - 1)).astype(np.int64)
    key, n = np.unique(key, return_counts=True)
    edges = np.searchsorted(key >> bits, np.arange(len(count) + 1)).astype(np.int32)
    indices = pa.ListArray.from_arrays(edges, (key & ((1 << bits) - 1)).astype(np.int32))
    values = pa.ListArray.from_arrays(edges, n.astype(np.float64))
    return pa.StructArray.from_arrays(
        [pa.array(np.zeros(len(count), np.int8)), pa.array(np.full(len(count), 1 << bits, np.int32)), indices, values],
        names=["type", "size", "indices", "values"])


def hashed_terms(tokens: pa.ListArray, bits: int) -> pa.Array:
    """Vectors of a batch, some SLICE tokens at a time."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    if not len(ends):
        return _vectors(tokens, bits)
    cuts = np.unique([0, *np.searchsorted(ends, np.arange(SLICE, ends[-1], SLICE), "right").tolist(), len(ends)])
    return pa.concat_arrays([_vectors(tokens.slice(a, b - a), bits) for a, b in pairwise(cuts.tolist())])
