"""Language-model scoring with a weighted backoff automaton.

Tokens are the lower-cased (A-Z) words of a text and one end.  Unigrams are
smoothed by adding 1/2, and bigrams fall back to them by Witten and Bell's rule:

    p(v | u) = (c(uv) + d(u) p(v)) / (c(u) + d(u))

where u was seen in training, else p(v); d(u) is the number of different tokens
that follow u there.  A word seen in training is a state; a pair seen is an arc
with weight log10 p(v | u); the failure arc of a state has weight log10 of
d(u) / (c(u) + d(u)), its own mass left for tokens it has no arc for, and leads to
the root, whose arcs are the unigrams and which is also the state of unseen words.
A text is traversed once from left to right, carrying the state and adding up
weights.

Counting and look-up share the exchanges (see ``blocks``): each block of
documents sends its distinct words and pairs with their training counts, and
gets back the corpus totals of exactly these, which make up the part of the
automaton its texts can reach.  With each total comes whether the block is the
first of those that sent the key, so that every pair of the corpus has one block
that counts it for its state; these counts, one number a word, are added up in a
second exchange.  Nothing of the corpus' size is held anywhere.

Defined cases: null and empty texts are the end token alone; rows whose held-out
flag is null (null id) count as training rows; repeated rows count as often as
they stand there; without training rows N and V are 0 and every token has
probability 1 under both models; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.llm import blocks as K
from portrait.llm import bytesops as B

END, BEGIN = np.uint64(0x656E642D6F662D74), np.uint64(0x626567696E2D2D2D)      # two fixed keys
WORDS, PAIRS, NEXT = 1, 2, 3
SCORED = ("copy long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
_SCORED = pa.schema([("copy", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                     ("score", pa.float64())])


def held_out(id_col: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


class Tokens:
    """Tokens of a block's texts: cur and the state before it (hist), token counts by row."""

    def __init__(self, texts):
        cur, hist, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, rows, buf, off in B.text_slices(texts):
            start, stop, first = B.words_of(buf, off, B.NOT_WHITE)
            n = np.diff(first)
            ends = np.cumsum(n + 1)
            c = np.full(ends[-1], END)
            if len(start):
                c[np.arange(len(start)) + np.repeat(np.arange(rows), n)] = B.word_hashes(buf, start, stop)
            h = np.roll(c, 1)
            h[ends - n - 1] = BEGIN
            cur.append(c)
            hist.append(h)
            counts.append(n + 1)
        self.cur, self.hist, self.counts = np.concatenate(cur), np.concatenate(hist), np.concatenate(counts)

    def states(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct states, and the place of each token's state there."""
        return np.unique(self.hist, return_inverse=True)

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct words, and each token's place there."""
        return np.unique(self.cur, return_inverse=True)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of (state, token), and each token's place there."""
        return np.unique(B.mix(B.mix(self.hist + np.uint64(B.GOLDEN)) * np.uint64(B.MIX2) + self.cur),
                         return_inverse=True)


def _send(exchange: K.Exchange):
    """Words and pairs of a block with their training counts."""
    def run(key, table):
        t = Tokens(table["text"])
        train = np.repeat(table["m"].to_numpy() * table["train"].to_numpy(zero_copy_only=False), t.counts)
        out = []
        for kind, (keys, at) in ((WORDS, t.words()), (PAIRS, t.pairs())):
            out += exchange.send(kind, key[0].as_py(), keys, np.bincount(at, train, len(keys)))
        return pa.Table.from_pylist(out, schema=K._SENT)
    return run


def _send_next(exchange: K.Exchange):
    """For each state of a block, how many different pairs of the corpus with
    that state fall to this block to count."""
    def run(key, table, answers):
        if not len(table):
            return K._SENT.empty_table()
        t = Tokens(table["text"])
        pairs, at = t.pairs()
        states, state = t.states()
        total, own = K.received(answers, PAIRS, len(pairs))
        of = np.zeros(len(pairs), np.int64)
        of[at] = state                                       # a pair has one state
        counted = np.bincount(of, own & (total > 0), len(states))
        return pa.Table.from_pylist(exchange.send(NEXT, key[0].as_py(), states, counted), schema=K._SENT)
    return run


class Automaton:
    """States are words by place in a sorted list, and one more for the begin
    of a text; arcs are given by the counts of their pairs."""

    def __init__(self, count: np.ndarray, n_train: int, v_train: int, end: int, followers: np.ndarray):
        count, self.followers = count.astype(float), followers.astype(float)
        self.seen = np.append(count, count[end])            # every training text begins and ends once
        self.unigram = (count + 0.5) / (n_train + 0.5 * (v_train + 1))
        self.root_arc = np.log10(self.unigram)
        left = np.divide(self.followers, self.seen + self.followers, out=np.ones(len(self.seen)), where=self.seen > 0)
        self.fail_arc = np.log10(np.where(left > 0, left, 1.0))

    def traverse(self, state: np.ndarray, word: np.ndarray, pair_count: np.ndarray) -> np.ndarray:
        """Weight of every step: the pair's arc where there is one, else the
        failure arc and the root's.  A state is the word before, so the steps of
        all texts are taken at once."""
        step = self.fail_arc[state] + self.root_arc[word]
        arc = pair_count > 0
        seen, d = self.seen[state[arc]], self.followers[state[arc]]
        step[arc] = np.log10((pair_count[arc] + d * self.unigram[word[arc]]) / (seen + d))
        return step


def _score(key, docs, answers):
    rows = len(docs)
    if not rows:
        return _SCORED.empty_table()
    t = Tokens(docs["text"])
    words, word = t.words()
    keys, pair = t.pairs()
    states, _ = t.states()
    n_train, v_train = answers["n_train"][0].as_py() or 0, answers["v_train"][0].as_py() or 0
    (count, _), (arcs, _) = K.received(answers, WORDS, len(words)), K.received(answers, PAIRS, len(keys))
    follow, _ = K.received(answers, NEXT, len(states))
    followers = np.zeros(len(words) + 1)                    # by word, and the begin; the end is no state
    at = np.minimum(np.searchsorted(words, states), len(words) - 1)
    known = words[at] == states
    followers[at[known]] = follow[known]
    followers[-1] = follow[states == BEGIN].sum()
    model = Automaton(count, n_train, v_train, int(np.searchsorted(words, END)), followers)
    state = np.roll(word, 1)
    state[np.cumsum(t.counts) - t.counts] = len(words)      # the begin of each text
    row = np.repeat(np.arange(rows), t.counts)
    weight = model.traverse(state, word, arcs[pair].astype(float))
    return pa.table({
        "copy": docs["copy"], "doc_id": docs["doc_id"], "held_out": pa.array(~docs["train"].to_numpy(zero_copy_only=False)),
        "n_tokens": pa.array(t.counts), "n_known": pa.array(np.bincount(row, count[word] > 0, rows).astype(np.int64)),
        "train_tokens": pa.array(np.full(rows, n_train)),
        "base_score": pa.array(np.bincount(row, model.root_arc[word], rows)),
        "score": pa.array(np.bincount(row, weight, rows))})


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, fold: int = 1,
          block_bytes: int = K.BLOCK_BYTES, fan: int = K.FAN) -> DataFrame:
    """One row per document, scored by a model of the rows that are not held
    out.  All is one query, in which the blocks are exchanged once."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = K.text_bytes(rows, F.col("text"))
    rows, everyone = K.copies(rows, total, block_bytes)
    exchange = K.Exchange(K.block_count(total, block_bytes), fan)
    rows = K.with_block(rows.withColumn("train", ~held_out(F.col("doc_id"), folds, fold)), exchange.blocks, "doc_id", "text")
    blocks = rows.groupBy("block")
    answers, sizes = exchange.totals(blocks.applyInArrow(_send(exchange), K.SENT))
    size = sizes.filter(F.col("kind") == WORDS).agg(F.sum("total").alias("n_train"), F.sum("present").alias("v_train"))
    # the states come second: they need to know whose each pair is
    after, _ = exchange.totals(blocks.cogroup(answers.groupBy("block")).applyInArrow(_send_next(exchange), K.SENT))
    every = answers.union(after).crossJoin(F.broadcast(size))                          # one row
    scored = blocks.cogroup(every.groupBy("block")).applyInArrow(_score, SCORED)
    return everyone(scored)
