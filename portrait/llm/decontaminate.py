"""Benchmark decontamination by a broadcast hash set of test n-grams.

Texts are normalised to lower-case (A-Z) words of digits, letters and non-ASCII
characters.  Every run of ``size`` words of a benchmark item (the whole item if
it is shorter) is a window; document words inside any occurrence of a window
are hit.  The scan looks hashes of document windows up in a sorted array, and
each match is verified against the window's own words before it counts.

The hash set travels with the tasks, so it is bounded: the windows are dealt
out in blocks of at most ``block_windows`` and the documents are scanned once
for every block (one for ordinary benchmarks), results being merged per
document by summing word bit maps.

Defined cases: null or empty text has no words, is never hit and keeps its
row; an item without words has no window; windows of items with a null id hit
like all others, these items count as one in n_items, stand as one null (first)
in ``items`` and are left out of the digest; repeated rows give repeated
results; null ids stay null; an empty benchmark hits nothing.  Other columns, whatever
their names, pass through ``remove`` unread.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.llm import bytesops as B
from portrait.session import scratch_path

WORDS = 13
SHARE = 20                     # contaminated when hit words are 1/20 of all
BLOCK_WINDOWS = 500_000        # bound of the hash set in a task (some 50 MB)

SCAN_SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
               "contaminated boolean, items array<string>, spans array<struct<start: long, stop: long>>")


class WindowSet:
    """Windows of benchmark items: sorted hashes by length, with the words and items of each."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int = WORDS):
        by: dict[int, dict[bytes, set[str | None]]] = {}
        for item, text in items:
            words = normal_words(text)
            n = min(size, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                by.setdefault(n, {}).setdefault(b" ".join(words[i:i + n]), set()).add(item)
        self.lengths = {}
        for n, windows in sorted(by.items()):
            keys = sorted(windows)
            buf = np.frombuffer(b" ".join(keys), np.uint8)
            start, stop, _ = B.words_of(buf, np.array([0, len(buf)]), B.ALNUM)
            hashes = B.window_hashes(B.word_hashes(buf, start, stop), n)[::n]
            order = np.argsort(hashes, kind="stable")
            self.lengths[n] = hashes[order], [(keys[i], in_order(windows[keys[i]])) for i in order]

    def __len__(self) -> int:
        return sum(len(h) for h, _ in self.lengths.values())


def in_order(items) -> list[str | None]:
    return sorted(items, key=lambda x: (x is not None, x or ""))


def digest(items: list[str | None]) -> str:
    return hashlib.sha256(",".join(x for x in items if x is not None).encode()).hexdigest()


def normal_words(text: bytes) -> list[bytes]:
    buf = np.frombuffer(text, np.uint8)
    start, stop, _ = B.words_of(buf, np.array([0, len(buf)]), B.ALNUM)
    low = B.LOWER[buf].tobytes()
    return [low[a:b] for a, b in zip(start.tolist(), stop.tolist(), strict=True)]


def _scan_slice(windows: WindowSet, buf: np.ndarray, off: np.ndarray):
    """Per row: word count, hit word mask (over all words), item sets, hit word spans in bytes."""
    start, stop, first = B.words_of(buf, off, B.ALNUM)
    n_words = np.diff(first)
    hit = np.zeros(len(start) + 1, np.int64)
    items: dict[int, set[str | None]] = {}
    hashes = B.word_hashes(buf, start, stop) if len(start) else np.zeros(0, np.uint64)
    last = np.repeat(first[1:], n_words)       # where each word's row ends
    low = None
    for n, (known, what) in windows.lengths.items():
        grams = B.window_hashes(hashes, n)
        if not len(grams):
            continue
        place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        found = np.flatnonzero((known[place] == grams) & (np.arange(len(grams)) + n <= last[:len(grams)]))
        if len(found) and low is None:
            low = B.LOWER[buf].tobytes()
        for i in found.tolist():
            text = b" ".join([low[a:b] for a, b in zip(start[i:i + n].tolist(), stop[i:i + n].tolist(), strict=True)])
            j = int(place[i])
            while j < len(known) and known[j] == grams[i]:   # equal hashes: all of them are looked at
                if what[j][0] == text:
                    hit[i] += 1
                    hit[i + n] -= 1
                    items.setdefault(int(np.searchsorted(first, i, "right")) - 1, set()).update(what[j][1])
                j += 1
    return start, stop, first, n_words, np.cumsum(hit)[:-1] > 0, items


def _spans(mask: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return [(int(start[a]), int(stop[b - 1])) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _scanner(windows: WindowSet, share: int):
    def run(batches):
        for batch in batches:
            for row, rows, buf, off in B.text_slices(batch.column(1)):
                start, stop, first, n_words, hit, items = _scan_slice(windows, buf, off)
                sums = np.concatenate(([0], np.cumsum(hit)))
                n_hit = sums[first[1:]] - sums[first[:-1]]
                names = [in_order(items.get(i, ())) for i in range(rows)]
                spans = [[{"start": a - int(off[i]), "stop": b - int(off[i])} for a, b in
                          _spans(hit[first[i]:first[i + 1]], start[first[i]:first[i + 1]], stop[first[i]:first[i + 1]])]
                         if n_hit[i] else [] for i in range(rows)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, rows), pa.array(n_words.astype(np.int64)), pa.array(n_hit),
                    pa.array([len(x) for x in names], pa.int64()),
                    pa.array([digest(x) for x in names], pa.string()),
                    pa.array((n_hit > 0) & (share * n_hit >= n_words)),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"])
    return run


def benchmark_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
                     size: int = WORDS, block_windows: int = BLOCK_WINDOWS):
    """Window sets of at most about ``block_windows`` windows: items come to the
    driver one partition at a time and a block is closed when it is full."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("binary"))
    part: list[tuple[str | None, bytes]] = []
    held, made = 0, False
    for item, text in rows.toLocalIterator():
        if text is None:
            continue
        part.append((item, bytes(text)))
        held += max(1, len(text) // 4)           # no item has more windows than this
        if held >= block_windows:
            yield WindowSet(part, size)
            part, held, made = [], 0, True
    if part or not made:
        yield WindowSet(part, size)


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", size: int = WORDS, share: int = SHARE,
         block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: word, hit and item counts, digest of the items
    whose windows occur, the verdict, the items and the hit spans (byte
    offsets of the text, end exclusive)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first, rest = _first(benchmark_blocks(benchmark, item_col, item_text_col, size, block_windows))
    return rows.mapInArrow(_scanner(first, share), SCAN_SCHEMA) if rest is None else _scan_blocks(rows, chain([first], rest), share)


def _first(blocks) -> tuple[WindowSet, object]:
    """The first block, and the others where there are any (None: there are not)."""
    first, second = next(blocks), next(blocks, None)
    return first, None if second is None else chain([second], blocks)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _scan_blocks(rows: DataFrame, blocks, share: int) -> DataFrame:
    """More than one block: the documents are scanned block after block, the hit
    words and items of earlier blocks travelling with the row.  Each pass is
    written before the next begins, so a task, and the driver, holds one block."""
    state = rows.select("doc_id", "text", F.expr("cast(array() as array<string>)").alias("items"),
                        F.lit(b"").alias("hit"))
    for b in blocks:
        state = _stored(state.mapInArrow(_block_step(b), "doc_id long, text string, items array<string>, hit binary"), "scan-pass")
    return state.mapInArrow(_block_end(share), SCAN_SCHEMA)


def _block_step(windows: WindowSet):
    def run(batches):
        for batch in batches:
            for row, rows, buf, off in B.text_slices(batch.column(1)):
                _, _, first, _, hit, items = _scan_slice(windows, buf, off)
                old = batch.column(3).slice(row, rows).to_pylist()
                names = batch.column(2).slice(row, rows).to_pylist()
                bits = []
                for i in range(rows):
                    now = np.packbits(hit[first[i]:first[i + 1]])
                    bits.append((now | np.frombuffer(old[i], np.uint8)).tobytes() if old[i] else now.tobytes())
                    names[i] = in_order({*names[i], *items.get(i, ())})
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, rows), batch.column(1).slice(row, rows),
                    pa.array(names, pa.list_(pa.string())), pa.array(bits, pa.binary())],
                    names=["doc_id", "text", "items", "hit"])
    return run


def _block_end(share: int):
    def run(batches):
        for batch in batches:
            for row, rows, buf, off in B.text_slices(batch.column(1)):
                start, stop, first = B.words_of(buf, off, B.ALNUM)
                out = []
                for i in range(rows):
                    names, bits = batch.column(2)[row + i].as_py(), batch.column(3)[row + i].as_py()
                    a, b = int(first[i]), int(first[i + 1])
                    hit = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
                    n_hit = int(hit.sum())
                    out.append({"doc_id": batch.column(0)[row + i].as_py(), "n_words": b - a, "n_hit": n_hit,
                                "n_items": len(names),
                                "items_sha256": digest(names),
                                "contaminated": n_hit > 0 and share * n_hit >= b - a, "items": names,
                                "spans": [{"start": x - int(off[i]), "stop": y - int(off[i])}
                                          for x, y in _spans(hit, start[a:b], stop[a:b])]})
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]))
    return run


def _or(hit: np.ndarray, first: np.ndarray, old: list[bytes]) -> np.ndarray:
    """Hit words together with those of earlier passes (packed, one list a row)."""
    hit = hit.copy()
    for i, bits in enumerate(old):
        if bits:
            a, b = int(first[i]), int(first[i + 1])
            hit[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
    return hit


def _marker(windows: WindowSet, text_at: int, hit_at: int):
    """Rows with the hit words of this pass and of those before in their last column."""
    def run(batches):
        for batch in batches:
            for row, rows, buf, off in B.text_slices(batch.column(text_at)):
                _, _, first, _, hit, _ = _scan_slice(windows, buf, off)
                part = batch.slice(row, rows)
                hit = _or(hit, first, part.column(hit_at).to_pylist())
                bits = [np.packbits(hit[first[i]:first[i + 1]]).tobytes() for i in range(rows)]
                yield part.set_column(hit_at, part.schema.field(hit_at), pa.array(bits, pa.binary()))
    return run


def _remover(windows: WindowSet, share: int, text_at: int, whole: bool, hit_at: int | None = None):
    """The last pass: ``hit_at`` is the column with the hit words of earlier ones."""
    def run(batches):
        for batch in batches:
            for row, rows, buf, off in B.text_slices(batch.column(text_at)):
                start, stop, first, n_words, hit, _ = _scan_slice(windows, buf, off)
                part = batch.slice(row, rows)
                if hit_at is not None:
                    hit = _or(hit, first, part.column(hit_at).to_pylist())
                    part = part.select(range(hit_at))
                sums = np.concatenate(([0], np.cumsum(hit)))
                n_hit = sums[first[1:]] - sums[first[:-1]]
                if whole:
                    yield part.filter(pa.array(~((n_hit > 0) & (share * n_hit >= n_words))))
                    continue
                old = part.column(text_at)
                parts = old.to_pylist() if n_hit.any() else None
                for i in np.flatnonzero(n_hit).tolist():
                    a, b = int(first[i]), int(first[i + 1])
                    raw, at, keep = buf[off[i]:off[i + 1]].tobytes(), 0, []
                    for x, y in _spans(hit[a:b], start[a:b], stop[a:b]):
                        keep.append(raw[at:x - int(off[i])])
                        at = y - int(off[i])
                    parts[i] = b"".join([*keep, raw[at:]]).decode()
                if parts is not None:
                    part = part.set_column(text_at, part.schema.field(text_at), pa.array(parts, old.type))
                yield part
    return run


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "documents", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", size: int = WORDS, share: int = SHARE,
           block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The documents with all their columns, without the contaminated ones
    (``what="documents"``) or without the hit spans (``what="spans"``)."""
    first, rest = _first(benchmark_blocks(benchmark, item_col, item_text_col, size, block_windows))
    names = [f"c{i}" for i in range(len(docs.columns))]     # clashing names are no matter inside
    at, whole = docs.columns.index(text_col), what == "documents"
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema.fields, strict=True))
    rows = docs.toDF(*names)
    if rest is None:
        return rows.mapInArrow(_remover(first, share, at, whole), kinds).toDF(*docs.columns)
    rows, end = rows.withColumn("hit", F.lit(b"")), len(names)
    for after in rest:                                      # one block a pass; the last one removes
        rows = _stored(rows.mapInArrow(_marker(first, at, end), f"{kinds}, hit binary"), "hit-pass")
        first = after
    return rows.mapInArrow(_remover(first, share, at, whole, end), kinds).toDF(*docs.columns)
