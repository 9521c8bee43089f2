"""Periodic runs of words, by string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least ``MIN_WORDS`` and two periods long, that no
neighbouring word extends.  Texts are narrow rows: each task packs its texts
into slices of word hashes, longest first, with a word of its own after every
text, so that one set of array operations serves many texts and no run crosses
two of them.

1.  Short periods (below 3 * ``FIRST_SCALE``): words are compared with those q
    later, for every q.
2.  Longer ones, at scales t = 4, 8, 16, ..., each for periods 3t <= q < 6t.
    A position i is synchronising when the least hash of the t-word windows that
    start in [i, i + t] is that of i or of i + t; windows with a period of t/3
    or less do not count.  Membership depends on the 2t words from i only, so a
    run of period q that is not highly periodic at its start has such a position
    i in its first t words, and i + q is another with the same 2t words.  Pairs
    of positions with equal contexts, 3t to 6t apart, propose their distance as a
    period; equal contexts are more than t/3 apart, so a position has fewer than
    18 partners.
3.  Windows left out in 2 lie in runs of period p <= t/3, which earlier scales
    have found.  If the first period of a run lies in such a region, the run
    either holds the region's end well inside it (then 2 finds it there) or
    consists of two regions of period p that touch.  Touching regions propose
    every period q that fits their phases.
4.  Each proposal is extended to both sides by binary search on the hashes of
    ranges; of proposals with the same stretch the smallest period is its own.

Texts whose number is dealt a planted repetition (see ``planted``) are judged
with it; ``plant=False`` leaves texts as they are.

Defined cases: null and white texts have no words and no runs; a null id gets
no planted repetition; repeated rows and ids are judged row by row; an empty
table gives an empty result; other columns are not read.  Words are compared by
64-bit hashes, ranges of them by polynomial hashes of 64 bits.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.llm import bytesops as B

MIN_WORDS = 12                 # shortest run reported
FIRST_SCALE = 4                # periods below three times this are compared directly
SLICE_WORDS = 1 << 16          # words of a slice (or one longer text)

_HASH = B.Roller(21)
_NONE = np.uint64((1 << 64) - 1)
_Z = np.zeros(0, np.int64)

REPORT = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")
SPANS = "doc_id long, start long, length long, period long"


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) when word i >= a of the text's n words is to be word a + (i - a) % p."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last position of every maximal stretch of True."""
    edge = np.diff(np.concatenate(([0], same.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones, by doubling widths."""
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < width:
        x = np.minimum(x[:len(x) - (width - span)], x[width - span:])
    return x


class _Words:
    """Word hashes with sums that give the hash of any range."""

    def __init__(self, words: np.ndarray):
        self.words, self.sums = words, _HASH.sums(words)

    def windows(self, n: int, width: int) -> np.ndarray:
        at = np.arange(n - width + 1)
        return _HASH.ranges(self.sums, at, at + width)

    def same(self, a: np.ndarray, b: np.ndarray, width) -> np.ndarray:
        return _HASH.ranges(self.sums, a, a + width) == _HASH.ranges(self.sums, b, b + width)

    def stretch(self, i: np.ndarray, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretch [start, stop) around i and i + q with period q."""
        right, left = np.zeros_like(i), np.zeros_like(i)
        step = 1 << max(0, int(n).bit_length() - 1)
        while step:
            w = right + step
            ok = np.flatnonzero(i + q + w <= n)
            ok = ok[self.same(i[ok] + right[ok], (i + q + right)[ok], step)]
            right[ok] += step
            w = left + step
            ok = np.flatnonzero(i - w >= 0)
            ok = ok[self.same(i[ok] - w[ok], (i + q - w)[ok], step)]
            left[ok] += step
            step >>= 1
        return i - left, i + q + right


def _direct(words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of periods below 3 * FIRST_SCALE.  Those of one and two words are
    kept from four and eight words on, which the first scales need."""
    out = []
    for q in range(1, 3 * FIRST_SCALE):
        if len(words) <= q:
            break
        a, b = _stretches(words[q:] == words[:-q])
        ok = b - a + q >= (4 * q if q < 3 else max(MIN_WORDS, 2 * q))
        out.append((a[ok], b[ok] + q, np.full(int(ok.sum()), q)))
    return out


def _synchronising(text: _Words, n: int, t: int, runs) -> np.ndarray:
    """Synchronising positions at scale t within the first n words."""
    window = text.windows(n, t)
    start, stop, q = runs
    ok = (3 * q <= t) & (stop - start >= t) & (stop <= n)
    if ok.any():                                        # windows inside a highly periodic region
        edge = np.zeros(len(window) + 1, np.int64)
        np.add.at(edge, start[ok], 1)
        np.add.at(edge, stop[ok] - t + 1, -1)
        window = np.where(np.cumsum(edge[:-1]) > 0, _NONE, window)
    least = _window_min(window, t + 1)
    return np.flatnonzero((least != _NONE) & ((least == window[:len(least)]) | (least == window[t:])))


def _equal_contexts(text: _Words, at: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of pairs of positions with equal 2t words, 3t <= distance < 6t."""
    context = _HASH.ranges(text.sums, at, at + 2 * t)
    order = np.argsort(context, kind="stable")
    context, at = context[order], at[order]
    found = []
    low = np.arange(len(at))                            # those that may still have a partner
    k = 1
    while len(low):
        low = low[low + k < len(at)]
        gap = at[low + k] - at[low]
        near = (context[low + k] == context[low]) & (gap < 6 * t)
        low, gap = low[near], gap[near]
        far = gap >= 3 * t
        found.append((at[low[far]], gap[far]))
        k += 1
    if not found:
        return _Z, _Z
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _touching(text: _Words, runs, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Proposals of pairs of touching regions of one period p <= t/3."""
    start, stop, p = runs
    ok = (3 * p <= t) & (stop - start >= 3 * t)
    start, stop, p = start[ok], stop[ok], p[ok]
    if len(p) < 2:
        return _Z, _Z
    order = np.lexsort((start, p))
    start, stop, p = start[order], stop[order], p[order]
    end, nxt = stop[:-1], start[1:]
    ok = (p[1:] == p[:-1]) & (nxt > end - p[:-1]) & (nxt <= end)
    first, end, last, p = start[:-1][ok], end[ok], stop[1:][ok], p[:-1][ok]
    # the phase: the q in [p, 2p) whose word before ``end`` begins like ``end`` does
    i, rank = B.expand(p)
    good = text.same(end[i] - p[i] - rank, end[i], p[i])
    i, rank = i[good], rank[good]
    q0, step = p[i] + rank, p[i]
    low = np.maximum(0, -(-(3 * t - q0) // step))       # first q of this scale
    high = np.minimum(6 * t - 1, np.minimum(end[i] - first[i], (last[i] - first[i]) // 2))
    j, k = B.expand(np.maximum(0, (high - q0) // step - low + 1))
    q = q0[j] + (low[j] + k) * step[j]
    return end[i][j] - q, q


def runs_of(words: np.ndarray, longest: int, fitting=None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, period) of all runs in a sequence of word hashes.  No run is
    longer than ``longest``; ``fitting(m)`` is the length of a prefix that holds
    every text of m words or more (the whole sequence if not given)."""
    text = _Words(words)
    runs = tuple(np.concatenate(x) for x in zip(*_direct(words), strict=True)) if len(words) > 1 else (_Z,) * 3
    runs = _primitive(runs)
    t = FIRST_SCALE
    while 6 * t <= longest:
        n = fitting(6 * t) if fitting else len(words)
        at = _synchronising(text, n, t, runs)
        i, q = (np.concatenate(x) for x in zip(_equal_contexts(text, at, t), _touching(text, runs, t), strict=True))
        if len(i):
            start, stop = text.stretch(i, q, n)
            ok = stop - start >= np.maximum(MIN_WORDS, 2 * q)
            runs = _primitive(tuple(np.concatenate(x) for x in zip(runs, (start[ok], stop[ok], q[ok]), strict=True)))
        t *= 2
    start, stop, q = runs
    ok = stop - start >= np.maximum(MIN_WORDS, 2 * q)
    return start[ok], stop[ok], q[ok]


def _primitive(runs):
    """Of runs with the same stretch the one with the smallest period, by start, then period."""
    start, stop, q = runs
    order = np.lexsort((q, stop, start))
    start, stop, q = start[order], stop[order], q[order]
    new = np.ones(len(q), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, q = start[new], stop[new], q[new]
    order = np.lexsort((q, start))
    return start[order], stop[order], q[order]


def _texts(batch, plant: bool):
    """Per text of a batch: row, word order (None: as written), word hashes."""
    ids = batch.column(0).to_pylist()
    for row, rows, buf, off in B.text_slices(batch.column(1)):
        start, stop, first = B.words_of(buf, off, B.NOT_WHITE)
        hashes = B.word_hashes(buf, start, stop, lower=False)
        for r in range(rows):
            mine, order = hashes[first[r]:first[r + 1]], None
            found = planted(ids[row + r], len(mine)) if plant else None
            if found:
                a, p = found
                i = np.arange(len(mine))
                order = np.where(i < a, i, a + (i - a) % p)
                mine = mine[order]
            yield row + r, order, mine


def _packed(texts):
    """Groups of texts of SLICE_WORDS words, or one longer text."""
    group, size = [], 0
    for item in texts:
        group.append(item)
        size += len(item[2]) + 1
        if size >= SLICE_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def _judged(batch, plant: bool):
    """(row, word order, number of words, runs (start, length, period)) of every text of a batch."""
    for group in _packed(_texts(batch, plant)):
        group.sort(key=lambda x: -len(x[2]))
        size = np.array([len(x[2]) for x in group])
        begin = np.concatenate(([0], np.cumsum(size + 1)))
        words = np.empty(begin[-1], np.uint64)
        for (_, _, mine), a in zip(group, begin, strict=False):
            words[a:a + len(mine)] = mine
        words[begin[1:] - 1] = B.mix(np.arange(len(group), dtype=np.uint64) ^ np.uint64(B.GOLDEN))
        fitting = lambda m, size=size, begin=begin: int(begin[np.searchsorted(-size, -m, "right")])
        start, stop, q = runs_of(words, int(size[0]), fitting)
        edges = np.searchsorted(start, begin)
        for k, (row, order, mine) in enumerate(group):
            mark = slice(edges[k], edges[k + 1])
            yield row, order, len(mine), np.column_stack((start[mark] - begin[k], stop[mark] - start[mark], q[mark]))


def _kept(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that no run contains after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:n]) == 0


def _collapsed(raw: bytes, order, runs: np.ndarray) -> bytes:
    words = raw.split()                                  # at the same six bytes as the words above
    if order is not None:
        words = [words[i] for i in order.tolist()]
    if len(runs):
        words = [words[i] for i in np.flatnonzero(_kept(runs, len(words))).tolist()]
    return b" ".join(words)


def _raw(batch):
    texts = batch.column(1)
    return lambda row: (texts[row].as_py() or "").encode()


def _report(plant: bool):
    def run(batches):
        for batch in batches:
            raw, out = _raw(batch), [None] * batch.num_rows
            for row, order, n, runs in _judged(batch, plant):
                best = (None,) * 4
                if len(runs):
                    s, length, q = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
                    best = s, length, q, 1000 * length // q
                lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs.tolist())
                out[row] = (n, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(),
                            hashlib.sha256(_collapsed(raw(row), order, runs)).hexdigest())
            cols = list(zip(*out, strict=True)) if out else [()] * 8
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                       "collapsed_sha256"])
    return run


def _spans(plant: bool):
    def run(batches):
        for batch in batches:
            ids, rows, found = batch.column(0), [_Z], [np.zeros((0, 3), np.int64)]
            for row, _, _, runs in _judged(batch, plant):
                rows.append(np.full(len(runs), row))
                found.append(runs)
            x = np.concatenate(found)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.concatenate(rows))),
                                              *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(3))],
                                             names=["doc_id", "start", "length", "period"])
    return run


def _rewrite(batches):
    for batch in batches:
        raw, out = _raw(batch), batch.column(1).to_pylist()
        for row, order, _, runs in _judged(batch, False):
            if len(runs):
                out[row] = _collapsed(raw(row), order, runs).decode()
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column(2)], names=["text", "row"])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per document: its number of words and runs, its longest run (ties:
    smallest start, then period; nulls without one), the digest of all runs and of
    the text without the words after each run's first period."""
    return _rows(docs, id_col, text_col).mapInArrow(_report(plant), REPORT)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """One row per run: doc_id, start and length in words, period."""
    return _rows(docs, id_col, text_col).mapInArrow(_spans(plant), SPANS)


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with all their columns; of every run only the first period
    stays.  Texts without a run are unchanged, others become words joined by one space."""
    wide = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.struct(*docs.columns).alias("row"))
    out = wide.mapInArrow(_rewrite, StructType(wide.schema.fields[1:]))
    return out.select(*[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
