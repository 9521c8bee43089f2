"""Blocks of documents, and the corpus totals of their keys.

Some operators need, for every text, figures about its tokens that come from
the whole corpus.  Instead of a row per token they exchange packed rows: a block
of documents sends its distinct sorted keys with their counts, cut into ranges,
and gets the totals of these keys back, in their order.  A key is sent once per
block however often it occurs there, so a hot key costs one entry per block.

An ``Exchange`` of n blocks has n receiving parts and at most ``FAN`` messages
from and to anybody.  Up to FAN blocks send to all parts at once.  More do so in
levels, like a radix sort: f blocks that lie together send each of f ranges to a
node of its own, which adds up what it got and sends on, f nodes with one range
each to f finer ranges, until a part has one range of all blocks; totals go back
the same way.  Messages are n times f at each of log(n) / log(f) levels, and as
f is bounded their bytes stay in proportion to a block's.

Rows that are equal would all fall in one block.  ``copies`` takes those that
fill a block by themselves out, so that one row with a count stands for them, and
gives all of them the result of that row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20
FAN = 128                      # messages a block or node sends at a time
HOT = 100_000                  # copies are taken out when they are a HOT-th of all bytes too


def text_bytes(docs: DataFrame, text: Column) -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def block_count(total: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, -(-total // block_bytes))


def with_block(docs: DataFrame, blocks: int, *key: str) -> DataFrame:
    return docs.withColumn("block", F.pmod(F.xxhash64(*key), F.lit(blocks)).cast("int"))


def pack(values: np.ndarray) -> bytes:
    """Small or repetitive numbers, compressed."""
    return zlib.compress(np.ascontiguousarray(values).tobytes(), 1)


def unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def raw(data: bytes, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(data, kind)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences of 6 bytes (8 where one needs more),
    after the first key."""
    step = np.diff(keys)
    width = 6 if not len(step) or int(step.max()) < 1 << 48 else 8
    return keys[:1].tobytes() + np.ascontiguousarray(step.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_sorted(data: bytes, n: int) -> np.ndarray:
    """The inverse, for n keys."""
    if n < 2:
        return raw(data)
    width = (len(data) - 8) // (n - 1)
    step = np.zeros((n, 8), np.uint8)
    step[0] = raw(data[:8], np.uint8)
    step[1:, :width] = raw(data[8:], np.uint8).reshape(-1, width)
    return np.cumsum(step.reshape(-1).view(np.uint64))


def merge(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys, and for every key its place among them."""
    return np.unique(keys, return_inverse=True)


def copies(rows: DataFrame, total: int, block_bytes: int, hot: int = HOT):
    """``rows`` (doc_id, text, ..) with a column ``m``, equal rows that fill a block
    (and a ``hot``-th of all bytes, so that they are fewer than ``hot``) as one row
    with their number in m, and a function that gives every row of ``rows`` its
    result from that of the rows returned; these carry their key in ``copy``
    (null: a row that stands for itself)."""
    key = F.xxhash64("doc_id", "text")
    limit = max(block_bytes, total // hot)
    many = (rows.groupBy(key.alias("copy")).agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"))
            .filter(F.col("bytes") > limit).select("copy"))
    found = [r["copy"] for r in many.collect()]              # fewer than ``hot`` numbers
    if not found:
        return rows.withColumns({"m": F.lit(1).cast("long"), "copy": F.lit(None).cast("long")}), lambda result: result.drop("copy")
    many = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in found], "copy long"))
    keyed = rows.withColumn("copy", key)
    one = keyed.join(many, "copy").groupBy(*rows.columns, "copy").agg(F.count(F.lit(1)).alias("m"))
    few = keyed.join(many, "copy", "left_anti").withColumns({"m": F.lit(1).cast("long"), "copy": F.lit(None).cast("long")})

    def everyone(result: DataFrame) -> DataFrame:
        own = result.filter("copy is not null").drop("doc_id")
        back = keyed.select("doc_id", "copy").join(F.broadcast(own), "copy").select(result.columns)   # fewer than ``hot`` rows
        return result.filter("copy is null").unionByName(back).drop("copy")
    return few.unionByName(one.select(few.columns)), everyone


SENT = "kind int, g long, r long, child long, n int, keys binary, counts binary"
_SENT = pa.schema([("kind", pa.int32()), ("g", pa.int64()), ("r", pa.int64()), ("child", pa.int64()), ("n", pa.int32()),
                   ("keys", pa.binary()), ("counts", pa.binary())])
ANSWER = "kind int, g long, r long, place int, counts binary"
_ANSWER = pa.schema([("kind", pa.int32()), ("g", pa.int64()), ("r", pa.int64()), ("place", pa.int32()), ("counts", pa.binary())])
SIZE = "kind int, total long, present long"


class Exchange:
    """Totals of 64-bit keys over ``blocks`` blocks.  A node at level l is known
    by its group g of f^l blocks and its range r of f^l; blocks are level 0."""

    def __init__(self, blocks: int, fan: int = FAN):
        self.blocks, self.levels = blocks, 1
        while fan ** self.levels < blocks:
            self.levels += 1
        self.f = max(1, blocks) if self.levels == 1 else next(f for f in range(2, fan + 1) if f ** self.levels >= blocks)

    def messages(self, kind: int, level: int, g: int, r: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        """What node (g, r) of a level sends on: its sorted keys with their counts, by finer range."""
        f, parts = self.f, self.f ** (level + 1)
        edges = np.array([(p << 64) // parts for p in range(r * f + 1, r * f + f)], np.uint64)
        cut = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
        return [{"kind": kind, "g": g // f, "r": r * f + j, "child": g, "n": int(cut[j + 1] - cut[j]),
                 "keys": pack_sorted(keys[cut[j]:cut[j + 1]]), "counts": pack(counts[cut[j]:cut[j + 1]].astype(np.uint64))}
                for j in np.flatnonzero(np.diff(cut)).tolist()]

    def send(self, kind: int, block: int, keys: np.ndarray, counts: np.ndarray) -> list[dict]:
        return self.messages(kind, 0, block, 0, keys, counts)

    def _pass_on(self, level: int):
        def run(key, table):
            kind, g, r = (k.as_py() for k in key)
            keys, _, total = added(table)
            return pa.Table.from_pylist(self.messages(kind, level, g, r, keys, total), schema=_SENT)
        return run

    def _back(self, kind: int, r: int, table: pa.Table, at: np.ndarray, total: np.ndarray, own: np.ndarray) -> pa.Table:
        """Totals for each child that sent to a node, in the order of its keys,
        with the bit that says whether the child is the first to have the key."""
        first = np.zeros(len(at), bool)
        first[np.unique(at, return_index=True)[1]] = True      # children are in order
        value = total[at] << np.uint64(1) | (first & own[at]).astype(np.uint64)
        end, out = 0, []
        for child, n in zip(table["child"].to_pylist(), table["n"].to_pylist(), strict=True):
            begin, end = end, end + n
            out.append({"kind": kind, "g": child, "r": r // self.f, "place": r % self.f, "counts": pack(value[begin:end])})
        return pa.Table.from_pylist(out, schema=_ANSWER)

    def _top(self):
        def run(key, table):
            kind, _, r = (k.as_py() for k in key)
            table = table.sort_by("child")
            _, at, total = added(table)
            return self._back(kind, r, table, at, total, np.ones(len(total), bool))
        return run

    def _down(self):
        def run(key, table, answers):
            if not len(table):
                return _ANSWER.empty_table()
            kind, _, r = (k.as_py() for k in key)
            table = table.sort_by("child")
            keys, at, _ = added(table)
            return self._back(kind, r, table, at, *received(answers, kind, len(keys)))
        return run

    def totals(self, sent: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Answers (kind, block, place, counts) for all blocks of the messages
        ``sent``, and per kind the sum of all totals and the keys with one above zero."""
        at = ["kind", "g", "r"]
        sent_at = [sent]                                        # messages into each level; read again on the way back
        for level in range(1, self.levels):
            sent_at.append(sent_at[-1].groupBy(*at).applyInArrow(self._pass_on(level), SENT))
        top = sent_at[-1].groupBy(*at)
        sizes = top.applyInArrow(_sizes, SIZE).groupBy("kind").agg(F.sum("total").alias("total"), F.sum("present").alias("present"))
        answers = top.applyInArrow(self._top(), ANSWER)
        for messages in reversed(sent_at[:-1]):
            answers = messages.groupBy(*at).cogroup(answers.groupBy(*at)).applyInArrow(self._down(), ANSWER)
        return answers.select("kind", F.col("g").cast("int").alias("block"), "place", "counts"), sizes


def added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Messages merged: distinct keys, each entry's place among them, totals."""
    keys = [unpack_sorted(x.as_py(), n) for x, n in zip(table["keys"], table["n"].to_pylist(), strict=True)]
    distinct, at = merge(np.concatenate(keys))
    counts = np.concatenate([unpack(x.as_py(), np.uint64) for x in table["counts"]])
    return distinct, at, np.bincount(at, counts, len(distinct)).astype(np.uint64)


def _sizes(key, table):
    _, _, total = added(table)
    return pa.table({"kind": [key[0].as_py()], "total": [int(total.sum())], "present": [int((total > 0).sum())]},
                    schema=pa.schema([("kind", pa.int32()), ("total", pa.int64()), ("present", pa.int64())]))


def received(answers: pa.Table, kind: int, expected: int) -> tuple[np.ndarray, np.ndarray]:
    """A block's or node's answers in the order of its distinct keys: totals, and
    whether it is the first of all that have the key."""
    rows = sorted((r["place"], r["counts"]) for r in answers.select(["kind", "place", "counts"]).to_pylist() if r["kind"] == kind)
    out = np.concatenate([np.zeros(0, np.uint64), *(unpack(x, np.uint64) for _, x in rows)])
    if len(out) != expected:
        raise RuntimeError("the answers do not fit the keys that were sent")
    return out >> np.uint64(1), (out & np.uint64(1)).astype(bool)
