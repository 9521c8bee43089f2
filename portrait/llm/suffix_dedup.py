"""Removal of repeated passages by distributed prefix doubling on sampled suffixes.

Every byte covered by a string of ``length`` bytes (``THRESHOLD``, 400, if not
given) that also starts anywhere else is removed; strings never cross documents,
overlaps count, and all strings are judged on the input.  Lengths from 150 to
1000 are possible.

A suffix array of all positions would hold a row per byte.  Here each start is
tied to one sampled position: the place, within its bytes, of the 50-byte
string with the least hash (the last one at a tie).  Equal strings have their
sampled position at the same distance, so ranks need be compared only between
starts with equal (sampled 50-byte string, distance).  Ranks are compared at
growing lengths, each round sorting and counting (rank, distance) pairs:

*   length 50: the sampled strings themselves; starts of a sampled position
    that stands alone are unique and leave.
*   63 and 7 bytes below the length: the starts of a sampled position are cut into
    cells of 64, then 8 distances; a cell whose common bytes are unique leaves.
*   the whole length: every start that is left, by its own string.

In every round, cells whose whole context (all bytes of all their starts) is
found twice are repeated as a whole and are settled at once, so that large
groups of copies never come down to single starts; a repeated context is
followed further by one owner only.  Equality is that of 128 bits of hash.
Texts are joined with a document's own runs only, after a filter of fixed size
(a bit map of hashed keys) has left out most texts without any.  Equal rows have
counted each other by then (all they hold is repeated), so one text stands for
them from there on.

Defined cases: null and short texts have nothing removed (null counts as
empty); rows are separate documents even if all their columns are equal (such
rows remove each other's long passages); null ids stay; ids need not be unique;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.llm import bytesops as B
from portrait.session import scratch_path

THRESHOLD = 400
LENGTHS = (150, 1000)          # lengths that the packed runs can hold
SAMPLE = 50                    # length of sampled strings
CELLS = (64, 8)                # distances to a cell in the rounds between
FILTER_BITS = 1 << 26          # size of the key filter: 8 MB
SLICE = 48 << 10              # its arrays stay within a core's cache

R1, R2 = B.Roller(11), B.Roller(12)
_LOW = np.uint64((1 << 32) - 1)

PIECE = 8 << 20                # longer texts are ranked in pieces of so many bytes


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling runs."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < width:
        x = np.minimum(x[:len(x) - (width - span)], x[width - span:])
    return x


class Ranks:
    """Ranks of substrings of a buffer, by two independent hashes of 64 bits."""

    def __init__(self, buf: np.ndarray):
        self.buf, self.s1 = buf, R1.byte_sums(buf)

    @cached_property
    def s2(self) -> np.ndarray:
        return R2.byte_sums(self.buf)

    def one(self, start: np.ndarray, stop: np.ndarray, salt=0) -> np.ndarray:
        return B.mix(R1.ranges(self.s1, start, stop) + np.asarray(salt).astype(np.uint64))

    def two(self, start: np.ndarray, stop: np.ndarray, salt=0) -> np.ndarray:
        return B.mix(R2.ranges(self.s2, start, stop) ^ B.mix(np.asarray(salt).astype(np.uint64)))


def sampled(buf: np.ndarray, off: np.ndarray, t: int, k: int = SAMPLE):
    """Runs of starts with one sampled position, of all texts of a slice:
    row, first start, last start, position (all in the slice), and the rank of
    the sampled string."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < t:
        return none, none, none, none, np.zeros(0, np.uint64), None
    ranks = Ranks(buf)
    gram = R1.windows(ranks.s1, k)
    least = _least((gram & ~_LOW) | (_LOW - np.arange(n - k + 1, dtype=np.uint64)), t - k + 1)
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    cut = off[1:-1]
    new[cut[cut < len(least)]] = True
    first = np.flatnonzero(new)
    row = np.searchsorted(off, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(least)) - 1, off[row + 1] - t)
    ok = last >= first
    first, last, row = first[ok], last[ok], row[ok]
    pos = (_LOW - (least[first] & _LOW)).astype(np.int64)
    return row, first, last, pos, gram[pos], ranks


def _slices(texts, t: int):
    """Slices of rows; a row beyond PIECE bytes comes in pieces that overlap, so
    that every start is in exactly one: (row, rows, bytes, offsets, offset of
    the piece in its row)."""
    for row, rows, buf, off in B.text_slices(texts, SLICE):
        if rows > 1 or len(buf) <= PIECE:
            yield row, rows, buf, off, 0
            continue
        for a in range(0, len(buf) - t + 1, PIECE):
            part = buf[a:a + PIECE + t - 1]
            yield row, 1, part, np.array([0, len(part)]), a


SEGMENTS = "doc_id long, key long, n_bytes long, sha256 string, runs binary"
RUNS = "key long, at long, core long, rim long"
STARTS = "key long, at long, rank1 long, rank2 long"


WHOLE, OPEN, FLAGS = 1, 2, 4   # a judged run: its place times FLAGS, with these bits


def _packed(first: np.ndarray, last: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A run of starts in one number (last and pos are less than 1024 beyond first)."""
    return first << 20 | (last - first) << 10 | (pos - first)


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    first = at >> 20
    return first, first + (at >> 10 & 1023), first + (at & 1023)


def _segments(t: int):
    """Per document: its size and digest, and its runs (place, rank of the
    sampled string, rank of the context) as 64-bit numbers."""
    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            runs: list[list[bytes]] = [[] for _ in range(len(texts))]
            for row, rows, buf, off, base in _slices(texts, t):
                r, a, z, p, gram, ranks = sampled(buf, off, t)
                if not len(r):
                    continue
                rim = ranks.one(a, z + t, (p - a) * 4096 + (p - z))
                begin = off[r] - base
                packed = np.column_stack([_packed(a - begin, z - begin, p - begin).astype(np.uint64), gram, rim])
                edges = np.searchsorted(r, np.arange(rows + 1))
                for i in np.flatnonzero(np.diff(edges)).tolist():
                    runs[row + i].append(packed[edges[i]:edges[i + 1]].tobytes())
            whole = [x.as_py() for x in texts.cast(pa.large_binary()).fill_null(b"")]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(x) for x in whole], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in whole], pa.string()),
                pa.array([b"".join(x) for x in runs], pa.binary())], names=["doc_id", "key", "n_bytes", "sha256", "runs"])
    return run


def _run_rows(batches):
    for batch in batches:
        packed = [x.as_py() for x in batch.column(1)]
        keys = np.repeat(batch.column(0).to_numpy(), [len(x) // 24 for x in packed])
        x = np.frombuffer(b"".join(packed), np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays([pa.array(keys), *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(3))],
                                         names=["key", "at", "core", "rim"])


def judge(runs: DataFrame) -> DataFrame:
    """Reranks runs of starts by (core, context).  Returned (key, run; see FLAGS)
    are those that are whole (their context stands elsewhere too, so all starts
    are repeated) or open (their core stands in another context too; of equal
    contexts the owner only); all others are unique and leave."""
    contexts = runs.groupBy("core", "rim").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("owner"))
    several = runs.groupBy("core").agg(F.min("rim").alias("low"), F.max("rim").alias("high")).filter("low < high")
    wanted = contexts.join(several.select("core", "low"), "core", "left").filter("n > 1 or low is not null")
    whole = F.col("n") > 1
    opened = F.col("low").isNotNull() & (~whole | (F.col("key") == F.col("owner")))
    flags = whole.cast("int") * WHOLE + opened.cast("int") * OPEN
    return runs.join(wanted, ["core", "rim"]).select("key", (F.col("at") * FLAGS + flags).alias("run"))


def _has(run, flag: int):
    return run.bitwiseAND(F.lit(flag).cast("long")) != 0


def _at(runs: DataFrame) -> DataFrame:
    """The places of whole runs."""
    return runs.filter(_has(F.col("run"), WHOLE)).select("key", F.shiftright("run", FLAGS.bit_length() - 1).alias("at"))


def _looks(batch, t: int):
    """The open runs of a batch of texts, slice by slice: keys, first, last and
    position in the slice, what is to be added to get places in the text, ranks
    over the slice.  A long text comes in pieces that hold their runs' bytes."""
    keys, texts, lists = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
    edge = lists.offsets.to_numpy()
    run = lists.values.to_numpy(zero_copy_only=False)[edge[0]:edge[-1]]
    row = np.repeat(np.arange(len(keys)), np.diff(edge))
    mine = run & OPEN != 0
    row, (first, last, pos) = row[mine], _unpacked(run[mine] // FLAGS)
    edge = np.searchsorted(row, np.arange(len(keys) + 1))
    for top, rows, buf, off in B.text_slices(texts, SLICE):
        a, z = edge[top], edge[top + rows]
        if a == z:
            continue
        if rows > 1 or len(buf) <= PIECE:
            begin = off[row[a:z] - top]
            yield keys[row[a:z]], first[a:z] + begin, last[a:z] + begin, pos[a:z] + begin, -begin, Ranks(buf)
            continue
        for c in range(0, len(buf), PIECE):
            x = a + np.flatnonzero((first[a:z] >= c) & (first[a:z] < c + PIECE))
            if len(x):
                yield keys[row[x]], first[x] - c, last[x] - c, pos[x] - c, np.full(len(x), c), Ranks(buf[c:c + PIECE + 2 * t])


def _batches(parts, names: list[str]):
    """Columns of many slices as batches of about a million rows."""
    out: list[tuple[np.ndarray, ...]] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in zip(*out, strict=True)],
                                          names=names)
    for part in parts:
        out.append(part)
        if sum(len(x[0]) for x in out) > 1_000_000:
            yield batch()
            out = []
    if out:
        yield batch()


def _cells(width: int, t: int):
    """Cells of the open runs of each text."""
    def parts(batches):
        for batch in batches:
            for key, a, z, p, add, ranks in _looks(batch, t):
                near, far = p - z, p - a                               # distances of the last and first start
                i, rank = B.expand(far // width - near // width + 1)
                cell = (near // width)[i] + rank
                low, high = np.maximum(cell * width, near[i]), np.minimum(cell * width + width - 1, far[i])
                pos = p[i]
                first, last = pos - high, pos - low
                core = ranks.one(pos - cell * width, pos - (cell * width + width - 1) + t, cell)
                rim = ranks.two(first, last + t, low * 4096 + high)
                yield key[i], _packed(first + add[i], last + add[i], pos + add[i]), core, rim
    return lambda batches: _batches(parts(batches), ["key", "at", "core", "rim"])


def _starts(t: int):
    """Every start of the open cells of each text, with the rank of its string."""
    def parts(batches):
        for batch in batches:
            for key, a, z, _, add, ranks in _looks(batch, t):
                i, rank = B.expand(z - a + 1)
                at = a[i] + rank
                place = at + add[i]
                yield key[i], _packed(place, place, place), ranks.one(at, at + t), ranks.two(at, at + t)
    return lambda batches: _batches(parts(batches), ["key", "at", "rank1", "rank2"])


def spans_of(first: np.ndarray, last: np.ndarray, t: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by strings with starts first..last."""
    order = np.argsort(first, kind="stable")
    a, b = first[order], np.maximum.accumulate(last[order] + t)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    i = np.flatnonzero(new)
    return list(zip(a[i].tolist(), b[np.append(i[1:], len(a)) - 1].tolist(), strict=True))


CUT = "key long, n_removed long, n_spans long, kept_sha256 string"


def _cut(t: int, texts: bool):
    """Figures of the texts without their repeated runs, and if wanted these texts."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            edge = lists.offsets.to_numpy()
            row = np.repeat(np.arange(len(lists)), np.diff(edge))
            size = np.array([0, *(len(x.as_buffer()) for x in batch.column(1))], np.int64)
            base = np.cumsum(size + 1)[:-1]                    # one place between texts, so that no span crosses them
            first, last, _ = _unpacked(lists.values.to_numpy(zero_copy_only=False)[edge[0]:edge[-1]])
            spans = spans_of(first + base[row], last + base[row], t)
            mine = np.searchsorted([a for a, _ in spans], np.append(base, np.iinfo(np.int64).max))
            out = []
            for i, text in enumerate(batch.column(1)):
                raw, at, keep = text.as_buffer(), 0, []
                for a, b in spans[mine[i]:mine[i + 1]]:
                    keep.append(raw[at:a - base[i]])
                    at = b - base[i]
                keep = b"".join([*keep, raw[at:]])
                out.append((raw.size - len(keep), mine[i + 1] - mine[i], hashlib.sha256(keep).hexdigest(), keep))
            n_removed, n_spans, digest, kept = zip(*out, strict=True) if out else ((),) * 4
            columns = {"key": batch.column(0), "n_removed": pa.array(n_removed, pa.int64()),
                       "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
            if texts:
                columns["kept"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)
    return run


def _list(df: DataFrame, col: str, collect=F.collect_list) -> DataFrame:
    """A document's own runs as one list (it has no more than bytes)."""
    return df.groupBy("key").agg(collect(col).alias("runs"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def key_filter(keys: DataFrame, bits: int = FILTER_BITS):
    """A test for rows whose key may be among ``keys``: all that are, and of the
    others the share of bits that are set.  The bit map has a fixed size; it is
    put together on the executors and fetched once."""
    at = F.pmod(F.xxhash64(F.lit(17), "key"), F.lit(bits))
    rows = (keys.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")).collect())
    size = 4096                                             # bytes of a bucket's map
    whole = np.zeros((bits // (8 * size) + 2, size), np.uint8)
    for bucket, data in rows:
        whole[bucket] = np.frombuffer(data, np.uint8)
    flat = whole.reshape(-1)

    @F.pandas_udf("boolean")
    def may(bucket: pd.Series, bit: pd.Series) -> pd.Series:
        place = bucket.to_numpy() * (8 * size) + bit.to_numpy()
        return pd.Series(flat[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1)
    return may(F.bitmap_bucket_number(at), F.bitmap_bit_position(at))


def repeated(rows: DataFrame, length: int = THRESHOLD, kept: bool = False) -> tuple[DataFrame, DataFrame]:
    """For rows (doc_id, key, text): the figures of every row, and those of the
    texts with anything removed (key, n_removed, n_spans, kept_sha256; if wanted,
    kept: the bytes left), one row a key."""
    if not LENGTHS[0] <= length <= LENGTHS[1]:
        raise ValueError(f"length must be from {LENGTHS[0]} to {LENGTHS[1]} bytes")
    segments = _stored(rows.mapInArrow(_segments(length), SEGMENTS), "segments")
    runs = segments.filter("length(runs) > 0").select("key", "runs").mapInArrow(_run_rows, RUNS)
    judged = _stored(_list(judge(runs), "run", F.collect_set), "judged-runs")
    texts = _stored(rows.select("key", "text").filter(key_filter(judged)).dropDuplicates(["key"]).join(judged, "key")
                    .select("key", "text", "runs"), "texts")
    settled = [_at(texts.select("key", F.explode("runs").alias("run")))]
    closer = followed = texts.filter(F.exists("runs", lambda r: _has(r, OPEN)))
    for width in CELLS:
        cells = _stored(closer.mapInArrow(_cells(width, length), RUNS), "cells")
        judged = _stored(judge(cells), "judged-cells")
        settled.append(_at(judged))
        opened = _list(judged.filter(_has(F.col("run"), OPEN)), "run")
        closer = followed.select("key", "text").join(opened, "key").select("key", "text", "runs")
    starts = _stored(closer.mapInArrow(_starts(length), STARTS), "starts")
    rank = ["rank1", "rank2"]
    twice = starts.groupBy(*rank).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*rank)
    settled.append(starts.join(twice, rank).select("key", "at"))
    found = _list(reduce(DataFrame.unionAll, settled), "at")
    cut = texts.select("key", "text").join(found, "key").select("key", "text", "runs").mapInArrow(
        _cut(length, kept), CUT + ", kept binary" * kept)
    return segments.select("doc_id", "key", "n_bytes", "sha256"), cut


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return d.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    figures, cut = repeated(_keyed(docs, id_col, text_col), length)
    return figures.join(cut, "key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "sha256").alias("kept_sha256"))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = THRESHOLD) -> DataFrame:
    """The documents with all their columns, repeated bytes removed from the
    text.  A cut inside a character leaves bytes that are no text; these are
    dropped from what is returned."""
    _, cut = repeated(_keyed(docs, id_col, text_col), length, kept=True)
    cut = _stored(cut.select("key", "kept").mapInArrow(_as_text, "key long, __kept string"), "cut-texts")
    key = F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("key"))
    may = key_filter(cut)
    out = rows.filter(may).join(cut, "key", "left").unionByName(rows.filter(~may).withColumn("__kept", F.lit(None).cast("string")))
    return out.select(*[(F.coalesce("__kept", F.col("row")[c]) if c == text_col else F.col("row")[c]).alias(c)
                        for c in docs.columns])


def _as_text(batches):
    for batch in batches:
        kept = [x.as_py().decode("utf-8", "ignore") for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["key", "__kept"])
