"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has 64 bits; a bit is set when it is set in over half of
the XXH64 hashes (seed 42) of its shingles of ``WORDS`` words, repeats included.
Texts link when their fingerprints differ in at most ``RADIUS`` (r) bits.

Covering masks.  Every bit position gets a non-zero vector of r + 1 bits, dealt
in turn (as powers of a primitive element, so that any r + 1 neighbours are
independent and every mask holds a fair share); the mask of a non-zero vector v holds the positions whose vector has an
odd inner product with v.  For any r positions there is a v orthogonal to all of
their vectors, so its mask holds none of them: a pair within the radius agrees
under one of the 2^(r+1) - 1 masks at least, whatever the bits.  A mask holds
about half of the positions.

1.  Equal fingerprints are one node.
2.  Each node is dealt into one bucket per mask (the mask, the bits under it);
    counts of buckets are partial aggregates.  Buckets of two are compared at
    once, those of up to ``BUCKET`` nodes by one array pass, which returns a
    forest of links (no more than nodes), never their pairs.
3.  A larger bucket is dealt again by covering masks of the positions that its
    mask leaves out, about half as many each time: at the third level 10 are
    left at most, and a bucket has 2^10 nodes or fewer, whatever the data.
4.  Components of the links by star contractions (``components``); every
    document takes the component of its fingerprint.  Fingerprints of more than
    a ``HOT``-th of all rows (fewer than HOT of them) are joined by broadcast,
    so copies of one text do not meet in one task.

Defined cases: texts of fewer words are one shingle; null and white texts have
fingerprint zero and link like any other; a null id takes part, is never a
component's number, and a component without any id has number null; repeated
rows and ids are judged row by row; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.llm import components as C
from portrait.session import scratch_path

WORDS = 4
RADIUS = 4
SEED = 42
BUCKET = 2048                  # nodes compared in one array pass
HOT = 1000
GROUP = 1 << 16                # shingle hashes counted at once

_U = np.uint64
# Primitive polynomials over two elements by degree (fixed values)
PRIMITIVE = {2: 0b111, 3: 0b1011, 4: 0b10011, 5: 0b100101, 6: 0b1000011, 7: 0b10000011, 8: 0b100011101}
_LANES = _U(0x0001000100010001)          # one counter in each 16 bits
_LANE = (1 << 16) - 1


# ------------------------------------------------------------------ fingerprints
def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    found = text.lower().split()                   # of bytes: A-Z, and the six white bytes
    if not found:
        return np.zeros(0, _U)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) < words:
        return np.array([digest(joined, SEED)], _U)
    size = np.fromiter(map(len, found), np.int64, len(found))
    stop = np.cumsum(size + 1) - 1
    start, stop = (stop - size).tolist(), stop[words - 1:].tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(start, stop, strict=False)], _U)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """The fingerprint of each list of hashes (zero for an empty one)."""
    out = np.zeros(len(hashes), _U)
    size = np.array([len(h) for h in hashes], np.int64)
    some = np.flatnonzero(size)
    if not len(some):
        return out
    x = np.concatenate([hashes[i] for i in some])
    n = size[some]
    # a lane counts up to 2^16 - 1, so longer lists come in pieces
    pieces = -(-n // _LANE)
    owner = np.repeat(np.arange(len(some)), pieces)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (np.cumsum(n) - n)[owner] + rank * _LANE
    of = np.flatnonzero(rank == 0)
    for k in range(16):
        lanes = np.add.reduceat((x >> _U(k)) & _LANES, first)
        for j in range(4):
            count = np.add.reduceat((lanes >> _U(16 * j) & _U(_LANE)).astype(np.int64), of)
            out[some] |= (2 * count > n).astype(_U) << _U(k + 16 * j)
    return out


def _fingerprints(words: int):
    def run(batches):
        for batch in batches:
            texts, out, group, size = batch.column(1), [np.zeros(0, _U)], [], 0
            for i in range(len(texts)):
                group.append(shingle_hashes((texts[i].as_py() or "").encode(), words))
                size += len(group[-1])
                if size >= GROUP:
                    out.append(majority(group))
                    group, size = [], 0
            out.append(majority(group))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out).view(np.int64))],
                                             names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed number) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(words), "doc_id long, fp long")


# ------------------------------------------------------------------------- links
@cache
def covering(outside: int = 0, radius: int = RADIUS) -> tuple[int, ...]:
    """Masks (each with all bits of ``outside``) such that any two fingerprints
    that agree on ``outside`` and differ in ``radius`` bits or fewer agree on one."""
    power, dealt = 1, []
    for i in range(64):
        if not outside >> i & 1:
            dealt.append((i, power))
            power <<= 1
            if power >> (radius + 1):
                power ^= PRIMITIVE[radius + 1]
    masks = (sum(1 << i for i, m in dealt if (m & v).bit_count() & 1) for v in range(1, 1 << (radius + 1)))
    return tuple(sorted({outside | m for m in masks}))


def _dealt(radius: int):
    """Rows (mask, fp) to one row for every finer mask."""
    def run(batches):
        for batch in batches:
            mask, fp = (batch.column(i).to_numpy(zero_copy_only=False).view(_U) for i in range(2))
            for outside in np.unique(mask).tolist():
                mine = fp[mask == _U(outside)]
                for m in covering(outside, radius):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x.view(np.int64)) for x in (np.full(len(mine), m, _U), mine & _U(m), mine)],
                        names=["mask", "bits", "fp"])
    return run


def forest(fp: np.ndarray, radius: int = RADIUS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that join all linked nodes of a bucket: each node is reached once."""
    out, left, front = [], fp, fp[:0]
    while len(left):
        if not len(front):
            front, left = left[:1], left[1:]
        reached = []
        for node in front:                               # every node is in the front once
            near = np.bitwise_count(left ^ node) <= radius
            if near.any():
                reached.append(left[near])
                out.append((np.full(int(near.sum()), node), reached[-1]))
                left = left[~near]
        front = np.concatenate(reached) if reached else front[:0]
    return out


def _compared(radius: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten().to_numpy(zero_copy_only=False).view(_U)
            edges = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            found = [(np.zeros(0, _U), np.zeros(0, _U))]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                found += forest(values[a:b], radius)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64))
                                              for x in zip(*found, strict=True)], names=["a", "b"])
    return run


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect what
    pairs within the radius connect."""
    if bucket < 1 << radius:
        raise ValueError(f"bucket must be {1 << radius} or more")
    key, found = ["mask", "bits"], None
    rows = nodes.select(F.lit(0).cast("long").alias("mask"), "fp").mapInArrow(_dealt(radius), "mask long, bits long, fp long")
    while True:
        groups = _stored(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                         .filter("n > 1"), "buckets")
        pairs = groups.filter("n = 2").select("a", "b").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
        several = _stored(rows.join(groups.filter("n > 2").select(*key, "n"), key).select(*key, "fp", "n"), "bucket-nodes")
        listed = several.filter(F.col("n") <= bucket).groupBy(*key).agg(F.collect_list("fp").alias("fps")).select("fps")
        now = pairs.union(listed.mapInArrow(_compared(radius), "a long, b long"))
        found = now if found is None else found.union(now)
        large = several.filter(F.col("n") > bucket)
        if large.isEmpty():
            return found
        rows = (large.select("mask", "fp").distinct().mapInArrow(_dealt(radius), "mask long, bits long, fp long").distinct())


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS,
         bucket: int = BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits)
    and component_id (smallest id reachable by links)."""
    rows = _stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = _stored(rows.groupBy("fp").agg(F.min("doc_id").alias("root"), F.count(F.lit(1)).alias("n")), "fingerprint-nodes")
    comp = C.components(links(nodes, radius, bucket)).withColumnRenamed("node", "fp")
    least = comp.join(nodes, "fp").groupBy("component").agg(F.min("root").alias("component_id"))
    known = comp.join(least, "component").select("fp", "component_id", F.lit(True).alias("linked"))
    named = _stored(nodes.join(known, "fp", "left").select(
        "fp", "n", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("root")).alias("component_id")), "named-nodes")
    total = rows.count()
    # a fingerprint of over a HOT-th of all rows: there are fewer than HOT of them
    hot = F.broadcast(named.filter(F.col("n") * HOT > total).select("fp", "component_id"))
    out = rows.join(hot, "fp").unionByName(
        rows.join(hot, "fp", "left_anti").join(named.select("fp", "component_id"), "fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
