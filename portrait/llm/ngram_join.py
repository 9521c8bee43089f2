"""N-gram Jaccard self-join with token-combination prefixes.

A document's set is its distinct five-word shingles (all its words as one
shingle if there are fewer), words lower-cased (A-Z) and split at white space.
Documents link when 100 * intersection >= 80 * union; the answer is the class
(set of equal sets) and the connected component of every document.

1.  Classes.  Equal sets need no join: they are one class, known by a 128-bit
    sum over the set, and only one document of each takes part below.
2.  Screening.  Tokens are ordered by hash.  A linked pair shares most of the
    first tokens: of two linked sets, the one whose prefix of tau + 1 + tau/2
    tokens ends first shares all but tau of them with the other's prefix (tau:
    tokens that may be missing).  Blocks of documents learn from the corpus
    which of their prefix tokens stand in a second prefix (see ``blocks``), and
    a set with too few of them can have no partner and is put aside.
3.  Refinement.  Over the whole sets that are left, the same exchange tells
    which tokens stand in a second set; a set with less than 80 % of such
    tokens has no partner and is put aside too.
4.  Signatures.  The order of tokens is: those of one set only, rare ones by
    hash, and last the frequent class, all tokens of very many sets.  Prefixes are
    extended in this order until they cannot all be missing from a partner:
    tokens of one set are missing anyway, a rare token is a signature by itself;
    frequent tokens are dealt into buckets, in which every pair of tokens is a
    signature (a bucket with n tokens then accounts for n - 1 missing ones).
    Two linked sets always share a signature.
5.  Verification.  In every signature group each member is compared with one
    leader (the one it shares most signatures with), which joins large groups
    of copies in a few rounds without pairing their members; then every pair of
    members that still lie in different components is compared, unless counts
    of shared tokens by hash (a sketch) already bound their overlap below the
    limit.  All comparisons are exact intersections of whole sets.

Defined cases: null and empty texts (and texts of white space) have an empty
set, n_shingles 0, and are linked with nothing; rows with a null id get a null
component and link nothing; rows that share an id are one node; repeated rows
stay rows; an empty table gives an empty result; other columns are not read.
``keep_one`` leaves one row of a component, whether its others are repeated rows
or have no id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.llm import blocks as K
from portrait.llm import bytesops as B
from portrait.llm.components import extended
from portrait.operators.ordering import global_index
from portrait.session import scratch_path

WORDS = 5
NEED = 80                      # percent of the union
FREQUENT = 64                  # sets a token stands in before it is of the frequent class
BUCKET = 16                    # tokens of a whole set to a frequent bucket
LEADER_ROUNDS = 4
BLOCK_BYTES = 4 << 20          # text of a block; a task holds its shingles too
SKETCH = 32                    # counts of eight bits
WORD = r"[^\x20\x09-\x0D]"      # a text with no such character has an empty set

SETS = "copy long, doc_id long, n long, rep long, h1 long, h2 long, tokens binary"
REFINED = "node long, n int, s int, sketch array<long>, full boolean, sigs array<long>, tokens array<long>"
_REFINED = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("s", pa.int32()), ("sketch", pa.list_(pa.int64())),
                      ("full", pa.bool_()), ("sigs", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))])
_SETS = pa.schema([("copy", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("rep", pa.int64()), ("h1", pa.int64()),
                   ("h2", pa.int64()), ("tokens", pa.binary())])


def missing(n):
    """Tokens of a set of n that a partner may lack."""
    return n - -(-NEED * n // 100)


def screen_prefix(n):
    t = missing(n)
    return np.minimum(n, t + 1 + (t + 1) // 2)


def screen_need(n):
    """Shared prefix tokens below which a set of n has no partner: what is
    certain for the smallest possible partner (the bound grows with n)."""
    m = -(-NEED * n // 100)
    return screen_prefix(m) - missing(m)


class Sets:
    """Shingle sets of the texts of a block: tokens sorted within rows."""

    def __init__(self, texts, words: int = WORDS):
        rows_all, tokens_all = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        total = 0
        for row, rows, buf, off in B.text_slices(texts):
            total = row + rows
            start, stop, first = B.words_of(buf, off, B.NOT_WHITE)
            if not len(start):
                continue
            hashes = B.word_hashes(buf, start, stop)
            n = np.diff(first)
            of = np.repeat(np.arange(rows), n)
            grams = B.window_hashes(hashes, words)
            whole = np.flatnonzero(of[:len(grams)] == of[words - 1:]) if len(grams) else np.zeros(0, np.int64)
            few = np.flatnonzero((n > 0) & (n < words))
            sums = B.GRAM.sums(hashes)
            tokens = np.concatenate((grams[whole], B.GRAM.ranges(sums, first[few], first[few + 1])))
            owner = np.concatenate((of[whole], few))
            order = np.lexsort((tokens, owner))
            tokens, owner = tokens[order], owner[order]
            new = np.ones(len(tokens), bool)
            new[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
            tokens_all.append(tokens[new])
            rows_all.append(owner[new] + row)
        self.tokens, self.row = np.concatenate(tokens_all), np.concatenate(rows_all)
        self.n = np.bincount(self.row, minlength=total)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        zero = np.zeros(1, np.uint64)
        sums = [np.concatenate((zero, np.cumsum(B.mix(self.tokens ^ np.uint64(c))))) for c in (B.GOLDEN, B.MIX1)]
        self.h1, self.h2 = (B.mix(s[self.first[1:]] - s[self.first[:-1]] + self.n.astype(np.uint64)) for s in sums)

    def representatives(self, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
        """For each row the smallest id with an equal set in the block, as a row
        number; -1 for empty sets and null ids."""
        out = np.full(len(self.n), -1)
        some = np.flatnonzero((self.n > 0) & known)
        if len(some):
            order = some[np.lexsort((ids[some], self.h2[some], self.h1[some]))]
            new = np.ones(len(order), bool)
            new[1:] = (self.h1[order[1:]] != self.h1[order[:-1]]) | (self.h2[order[1:]] != self.h2[order[:-1]])
            out[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1]
        return out

    def prefixes(self, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Screening prefixes of the representatives with two tokens or more: tokens and rows."""
        own = np.flatnonzero((rep == np.arange(len(rep))) & (self.n > 1))
        owner, rank = B.expand(screen_prefix(self.n[own]))
        return self.tokens[self.first[own][owner] + rank], own[owner]


def _ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    col = table["doc_id"].combine_chunks()
    return col.fill_null(0).to_numpy(zero_copy_only=False), col.is_valid().to_numpy(zero_copy_only=False)


def _send_prefixes(exchange: K.Exchange):
    def run(key, table):
        sets = Sets(table["text"])
        keys, counts = np.unique(sets.prefixes(sets.representatives(*_ids(table)))[0], return_counts=True)
        return pa.Table.from_pylist(exchange.send(0, key[0].as_py(), keys, counts), schema=K._SENT)
    return run


def _send_sets(exchange: K.Exchange):
    def run(key, table):
        keys, counts = np.unique(K.raw(b"".join(x.as_py() for x in table["tokens"])), return_counts=True)
        return pa.Table.from_pylist(exchange.send(0, key[0].as_py(), keys, counts), schema=K._SENT)
    return run


def _totals(answers: pa.Table, expected: int) -> np.ndarray:
    """In how many sets each of a block's distinct tokens stands."""
    return K.received(answers, 0, expected)[0]


def _screen(key, docs, answers):
    """Every row with its set's size, local representative and hash; the whole
    set too where it may have partners."""
    if not len(docs):
        return _SETS.empty_table()
    ids, known = _ids(docs)
    sets = Sets(docs["text"])
    rep = sets.representatives(ids, known)
    tokens, row = sets.prefixes(rep)
    keys, at = K.merge(tokens)
    shared = np.bincount(row, (_totals(answers, len(keys)) > 1)[at], len(rep))
    keep = (rep == np.arange(len(rep))) & (sets.n > 1) & (shared >= screen_need(sets.n))
    whole = [sets.tokens[sets.first[i]:sets.first[i + 1]].tobytes() if keep[i] else None for i in range(len(rep))]
    has = rep >= 0
    null = pa.array(~has)
    column = lambda x: pc.if_else(null, pa.scalar(None, pa.int64()), pa.array(x.astype(np.int64)))
    return pa.table({"copy": docs["copy"].combine_chunks(), "doc_id": docs["doc_id"].combine_chunks(), "n": pa.array(sets.n.astype(np.int64)),
                     "rep": column(ids[np.maximum(rep, 0)]), "h1": column(sets.h1.view(np.int64)),
                     "h2": column(sets.h2.view(np.int64)), "tokens": pa.array(whole, pa.binary())})


def buckets_of(size: np.ndarray | int):
    """Number of frequent buckets for a pair whose larger set has ``size`` tokens:
    by powers of two, so that both sets of a pair can know it."""
    return np.maximum(1, (1 << np.int64(np.floor(np.log2(size)))) // BUCKET)


def signatures_of(tokens: np.ndarray, often: np.ndarray, size: int) -> np.ndarray:
    """Signatures of a set of ``size`` tokens, two or more, of which ``tokens``
    (sorted) stand in another set too, and those marked ``often`` in very many."""
    n = size
    need = missing(n) + 1 - (n - len(tokens))               # tokens to account for
    if need <= 0:
        return np.zeros(0, np.uint64)
    rare = tokens[~often]
    out = [rare[:need]]
    left = need - len(out[0])
    if left > 0:                                            # the rest from frequent tokens
        mine = tokens[often]
        for m in sorted({int(buckets_of(n)), int(buckets_of(100 * n // NEED))}):
            bucket = (B.mix(mine ^ np.uint64(B.MIX2)) % np.uint64(m)).astype(np.int64)
            first = np.zeros(len(mine), bool)               # first of its bucket: accounts for nothing
            _, at = np.unique(bucket, return_index=True)
            first[at] = True
            used = int(np.searchsorted(np.cumsum(~first), left)) + 1
            take, bucket = mine[:used], bucket[:used]
            order = np.argsort(bucket, kind="stable")
            take, bucket = take[order], bucket[order]
            sizes = np.bincount(bucket, minlength=m)
            begin = np.cumsum(sizes) - sizes
            rank = np.arange(len(take)) - begin[bucket]
            i, j = B.expand(sizes[bucket] - rank - 1)       # each token with the later ones of its bucket
            a, b = take[i], take[i + j + 1]
            out.append(B.mix(B.mix(np.minimum(a, b)) * np.uint64(B.GOLDEN) + np.maximum(a, b) + np.uint64(m)))
    return np.concatenate(out)


def _refine(key, sets, answers):
    if not len(sets):
        return _REFINED.empty_table()
    nodes = sets["node"].to_pylist()
    mine = [K.raw(x.as_py()) for x in sets["tokens"]]
    keys, at = K.merge(np.concatenate(mine))
    total, end, out = _totals(answers, len(keys))[at], 0, []
    for node, tokens in zip(nodes, mine, strict=True):
        n, begin, end = len(tokens), end, end + len(tokens)
        count = total[begin:end]
        shared, often = tokens[count > 1], count[count > 1] > FREQUENT
        if 100 * len(shared) < NEED * n:
            continue
        counts = np.bincount((shared % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        sketch = np.minimum(counts, 255).astype(np.uint8).view(np.int64)
        sigs = np.unique(signatures_of(shared, often, n)).view(np.int64)
        out.append({"node": node, "n": n, "s": len(shared), "sketch": sketch,
                    "full": bool(counts.max() >= 255), "sigs": sigs, "tokens": tokens.view(np.int64)})
    return pa.Table.from_pylist(out, schema=_REFINED)


def _overlap_bound(x: str, y: str) -> str:
    """SQL for an upper bound of the overlap of two sets from their sketches
    (of which one has no count of 255, which stands for more)."""
    count = lambda k, i: f"(shiftrightunsigned({k}{i // 8}, {8 * (i % 8)}) & 255)"
    return " + ".join(f"least({count(x, i)}, {count(y, i)})" for i in range(SKETCH))


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with whether their sets (node, tokens) link."""
    with_b = pairs.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a")
    common = both.select("a", "b", F.size(F.array_intersect("tokens_a", "tokens_b")).alias("k"),
                         (F.size("tokens_a") + F.size("tokens_b")).alias("n"))
    return common.select("a", "b", F.expr(f"100 * k >= {NEED} * (n - k)").alias("linked"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pairs(x, y) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def linked(sets: DataFrame) -> DataFrame:
    """Components (node, component) of all linked pairs, for the nodes that have a link."""
    spark = sets.sparkSession
    able = lambda s1, n1, s2, n2: F.expr(  # noqa: E731  no more than the shared tokens of either set overlap
        f"100 * least({s1}, {s2}) >= {NEED} * ({n1} + {n2} - least({s1}, {s2}))")
    signatures = sets.select("node", "n", "s", F.explode("sigs").alias("sig"))
    tried = spark.createDataFrame([], "a long, b long")
    comp = spark.createDataFrame([], "node long, component long")
    rounds = LEADER_ROUNDS
    while rounds >= 0:
        sig = signatures.join(comp.withColumnRenamed("component", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))
        open_ = (sig.groupBy("sig").agg(F.min("c").alias("low"), F.max("c").alias("high"),
                                        F.min(F.struct(F.expr("n - s"), "node", "c", "n", "s")).alias("l"))
                 .filter("low < high").select("sig", "l"))
        members = sig.join(open_, "sig")
        if rounds:
            best = F.max_by("leader", F.struct("k", -F.col("leader"))).alias("leader")
            pairs = (members.filter("c != l.c").filter(able("s", "n", "l.s", "l.n"))
                     .groupBy("node", F.col("l.node").alias("leader")).agg(F.count(F.lit(1)).alias("k"))
                     .withColumns(dict(zip("ab", _pairs(F.col("node"), F.col("leader")), strict=True)))
                     .join(tried, ["a", "b"], "left_anti")
                     .groupBy("node").agg(best).select(*_pairs(F.col("node"), F.col("leader"))).distinct())
        else:
            # pairs within the leader's component are none: one side is never of it
            side = lambda x: (members.filter("c != l.c") if x == "a" else members).join(sets.select("node", "sketch", "full"), "node").select(
                "sig", F.col("node").alias(x), F.col("c").alias(f"c{x}"), F.col("n").alias(f"n{x}"), F.col("full").alias(f"full{x}"),
                F.col("s").alias(f"s{x}"), *[F.get("sketch", F.lit(i)).alias(f"{x}k{i}") for i in range(SKETCH // 8)])
            left, right = side("a"), side("b")
            pairs = (left.join(right, (left["sig"] == right["sig"]) & F.expr("ca != cb")
                               & able("sa", "na", "sb", "nb")
                               & F.expr(f"(fulla and fullb) or {100 + NEED} * ({_overlap_bound('ak', 'bk')}) >= {NEED} * (na + nb)"))
                     .select(*_pairs(F.col("a"), F.col("b"))).distinct().join(tried, ["a", "b"], "left_anti"))
        now = _stored(verify(pairs, sets), "links")
        tried = tried.union(now.select("a", "b"))
        new = now.filter("linked").select("a", "b")
        none = new.isEmpty()
        if not none:
            comp = extended(comp, new)
        rounds = 0 if rounds and none else rounds - 1
    return comp


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
         fan: int = K.FAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id (smallest id
    with the same set) and component_id (smallest id reachable by links)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = K.text_bytes(rows, F.col("text"))
    rows, everyone = K.copies(rows, total, block_bytes)
    exchange = K.Exchange(K.block_count(total, block_bytes), fan)
    blocks = K.with_block(rows, exchange.blocks, "doc_id", "text").groupBy("block")
    answers, _ = exchange.totals(blocks.applyInArrow(_send_prefixes(exchange), K.SENT))
    members = _stored(blocks.cogroup(answers.groupBy("block")).applyInArrow(_screen, SETS), "shingle-sets")
    classes = members.filter("rep is not null").groupBy("h1", "h2").agg(F.min("rep").alias("root"))
    sets = _stored(members.filter("tokens is not null").join(classes, ["h1", "h2"]).filter("rep = root")
                   .select(F.col("rep").alias("node"), "tokens"), "class-sets")
    sets = refine(sets, block_bytes, fan)
    named = members.select("copy", "doc_id", "n", "h1", "h2").join(classes, ["h1", "h2"], "left")
    # an id with several sets is one node: its classes belong together
    first = named.filter("root is not null").groupBy("doc_id").agg(F.min("root").alias("b"))
    same = named.join(first, "doc_id").filter("root != b").select(F.col("root").alias("a"), "b")
    comp = extended(linked(sets), same)
    return everyone(named.join(comp.withColumnRenamed("node", "root"), "root", "left").select(
        "copy", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "doc_id").alias("class_id"),
        F.coalesce("component", "root", "doc_id").alias("component_id")))


def refine(sets: DataFrame, block_bytes: int = BLOCK_BYTES, fan: int = K.FAN) -> DataFrame:
    """Sets (node, tokens) that may have partners, with their number of shared
    tokens, the sketch of these and their signatures."""
    exchange = K.Exchange(K.block_count(K.text_bytes(sets, F.col("tokens")), block_bytes), fan)
    blocks = K.with_block(sets, exchange.blocks, "node").groupBy("block")
    answers, _ = exchange.totals(blocks.applyInArrow(_send_sets(exchange), K.SENT))
    return _stored(blocks.cogroup(answers.groupBy("block")).applyInArrow(_refine, REFINED), "refined-sets")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _noded(docs: DataFrame, id_col: str, text_col: str, node: str) -> DataFrame:
    """The rows with a ``node`` each: their id; rows with a text but no id get an
    unused number, equal texts the same one, above all ids if there is room."""
    own, digest = F.col(id_col).cast("long"), _free(docs, "digest")
    nameless = F.coalesce(own.isNull() & F.col(text_col).rlike(WORD), F.lit(False))
    known = docs.filter(~nameless).withColumn(node, own)
    low, high, any_ = docs.agg(F.min(own), F.max(own), F.max(nameless)).first()
    if not any_:
        return known
    rows = docs.filter(nameless).withColumn(digest, F.sha2(F.col(text_col), 256))
    numbers = _stored(global_index(rows.select(digest).distinct(), [F.col(digest)], node), "nameless-texts")
    n = numbers.count()
    first = 0 if high is None else high + 1 if high + n < 1 << 63 else low - n
    rows = rows.join(numbers, digest).withColumn(node, F.col(node) + F.lit(first)).drop(digest)
    return known.unionByName(rows.select(known.columns))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row, with all its columns, of every component: of its smallest id,
    and where rows share that id, the one with the least text digest (equal rows:
    any one).  Rows without an id take part by their texts, and stay only if no
    row with an id is in their component.  Rows with an empty set all stay."""
    node, lost, again_ = (_free(docs, c) for c in ("node", "lost", "again"))
    rows = _noded(docs, id_col, text_col, node)
    words = F.coalesce(F.col(text_col).rlike(WORD), F.lit(False))
    nodes = _stored(join(rows, node, text_col).filter("n_shingles > 0").select("doc_id", "component_id"), "kept-components")
    gone = nodes.filter("component_id != doc_id").select(F.col("doc_id").alias(lost)).distinct()
    kept = rows.join(gone, (F.col(node) == F.col(lost)) & words, "left_anti")
    again = (nodes.filter("component_id = doc_id").groupBy(F.col("doc_id").alias(again_))
             .agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(again_))
    if again.isEmpty():
        return kept.select(docs.columns)
    same = (F.col(node) == F.col(again_)) & words
    order = F.struct(F.sha2(F.col(text_col), 256), F.to_json(F.struct(*[c for c in docs.columns if c != text_col])))
    one = (rows.join(again, same, "left_semi").groupBy(node)
           .agg(F.min_by(F.struct(*docs.columns), order).alias("row")).select("row.*"))
    return kept.join(again, same, "left_anti").select(docs.columns).unionByName(one)
