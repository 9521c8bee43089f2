"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from the bytes of whole texts in Arrow batches, by the
same function for training and scoring.  Trees are fitted on a bounded sample
of labelled rows (``sample_rows``, the rows of smallest id hash), which the
driver holds as one small matrix: values are binned at quantiles, and every
level of a tree is grown from gradient histograms of all its nodes.  The fitted
trees are flattened into arrays (feature, threshold, value by node in heap
order) and traversed for a whole batch at once, one level at a time.

Defined cases: null and empty texts have all statistics zero and are scored;
null labels are not used; an id labelled twice counts once, good if any label
is; labels without a document are ignored; without labels, or with one class
only, every score is the (smoothed) share of good labels, 1/2 without any;
null ids are scored and never held out; repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.llm import bytesops as B

SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 60, 4, 0.2, 64
MIN_LEAF, L2 = 20, 1.0

FEATURES = ["log_words", "word_bytes", "upper", "digits", "symbols", "bars", "bangs", "punctuation", "non_ascii",
            "blanks", "log_lines", "line_bytes", "distinct_words", "repeats_previous", "distinct_lines", "short_words",
            "longest_word"]


def _mask(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars.encode())] = True
    return m


_CLASSES = {"upper": _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digits": _mask("0123456789"), "symbols": _mask("#*$%&<>"),
            "bars": _mask("|"), "bangs": _mask("!"), "punctuation": _mask(".,;:?'\"()-"),
            "non_ascii": np.arange(256) >= 0x80, "blanks": B.WHITE}


def _distinct(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Distinct keys by row."""
    mine = B.mix(keys + row.astype(np.uint64) * np.uint64(B.GOLDEN))
    _, first = np.unique(mine, return_index=True)
    return np.bincount(row[first], minlength=rows)


def statistics(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows x FEATURES of a slice of texts."""
    rows = len(off) - 1
    size = np.diff(off)
    per_byte = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask[buf])))[off]) / np.maximum(size, 1)
    start, stop, first = B.words_of(buf, off, B.NOT_WHITE)
    n = np.diff(first)
    row = np.repeat(np.arange(rows), n)
    length = stop - start
    by_row = lambda x: np.bincount(row, x, rows) / np.maximum(n, 1)
    words = B.word_hashes(buf, start, stop, lower=False) if len(start) else np.zeros(0, np.uint64)
    again = np.zeros(len(start))
    again[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    longest = np.zeros(rows)
    np.maximum.at(longest, row, length)
    no_end = np.ones(256, bool)
    no_end[0x0A] = False
    l0, l1, lf = B.words_of(buf, off, no_end)              # lines are runs of bytes other than \n
    lines = np.diff(lf)
    lrow = np.repeat(np.arange(rows), lines)
    lhash = B.word_hashes(buf, l0, l1, lower=False) if len(l0) else np.zeros(0, np.uint64)
    some = np.maximum(lines, 1)
    f = {k: per_byte(m) for k, m in _CLASSES.items()}
    f |= {"log_words": np.log1p(n), "word_bytes": by_row(length), "log_lines": np.log1p(lines),
          "line_bytes": np.log1p(size / some), "distinct_words": _distinct(words, row, rows) / np.maximum(n, 1),
          "repeats_previous": by_row(again), "distinct_lines": _distinct(lhash, lrow, rows) / some,
          "short_words": by_row(length <= 2), "longest_word": np.log1p(longest)}
    return np.column_stack([f[k] for k in FEATURES])


class Trees:
    """Flattened trees: node k of a tree has the children 2k+1 and 2k+2."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(np.log2(self.feature.shape[1] + 1)) if self.feature.size else 0
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += v[node - len(f)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE,
        bins: int = BINS) -> Trees:
    inner, leaves = 2 ** depth - 1, 2 ** depth
    good = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(good / (1 - good)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)])
    k, margin = x.shape[1], np.full(len(y), base)
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)             # a node without a split sends all rows left
    value = np.zeros((trees, leaves))
    flat = binned + np.arange(k) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)                   # place within the level
        for level in range(depth):
            width = 2 ** level
            at = (node[:, None] * (k * bins) + flat).ravel()
            hist = [np.bincount(at, np.repeat(w, k), width * k * bins).reshape(width, k, bins)
                    for w in (g, h, np.ones(len(y)))]
            left = [np.cumsum(a, 2)[:, :, :-1] for a in hist]
            total = [a.sum(2, keepdims=True) for a in hist]
            gl, hl, nl = left
            gr, hr, nr = (a - b for a, b in zip(total, left, strict=True))
            gain = gl ** 2 / (hl + L2) + gr ** 2 / (hr + L2) - total[0] ** 2 / (total[1] + L2)
            gain = np.where((nl >= MIN_LEAF) & (nr >= MIN_LEAF), gain, -1).reshape(width, -1)
            best = gain.argmax(1)
            for w in range(width):
                f, b = divmod(int(best[w]), bins - 1)
                if gain[w, best[w]] > 1e-9 and b < len(edges[f]):
                    feature[t, width - 1 + w], threshold[t, width - 1 + w] = f, edges[f][b]
            f = feature[t, width - 1 + node]
            node = 2 * node + (x[np.arange(len(y)), f] > threshold[t, width - 1 + node])
        value[t] = rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + L2)
        margin += value[t][node]
    return Trees(base, feature, threshold, value)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def held_out(id_col: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_matrix(rows: DataFrame, labels: DataFrame, label_col: str, sample_rows: int, folds: int, fold: int):
    sample = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    found = rows.join(F.broadcast(sample), "doc_id")         # sample_rows pairs of numbers
    # rows that share an id: the one with the least digest, so that the bound holds for rows too
    chosen = (found.groupBy("doc_id").agg(F.min(F.struct(F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"), "text", "y")).alias("r"))
              .select("r.y", "doc_id", "r.text"))

    def run(batches):
        for batch in batches:
            for row, n, buf, off in B.text_slices(batch.column(2)):
                x = statistics(buf, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n)] + [pa.array(c) for c in x.T],
                    names=["y", "doc_id", *FEATURES])
    kinds = "y int, doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    got = chosen.mapInArrow(run, kinds).toPandas().sort_values(["doc_id", *FEATURES], kind="stable")
    return got[FEATURES].to_numpy(float), got["y"].to_numpy(float)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample_rows: int = SAMPLE_ROWS, folds: int = 3, fold: int = 1) -> Trees:
    return fit(*training_matrix(_rows(docs, id_col, text_col), labels, label_col, sample_rows, folds, fold))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", folds: int = 3,
          fold: int = 1) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    def run(batches):
        for batch in batches:
            for row, n, buf, off in B.text_slices(batch.column(1)):
                s = trees.score(statistics(buf, off))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])
    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, predicted int").select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", "predicted")
