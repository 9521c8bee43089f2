"""Quality rules with cross-document line frequency, in DataFrame functions only.

Base rules look at one text: fewer than 50 words, or over half of the words in
repeated three-word windows, fail it.  The method then looks across documents:
lines are normalised (lower case, white space runs to one blank, digits to 0)
and hashed; a line that more than ``min_docs`` different texts of one host and
more than ``share`` of its texts hold is boilerplate and is removed, and so is one
in more than ``most_docs`` texts, however large the host; a document that
keeps less than half of its words after that is rejected.  Exact copies count
as one text, so that copying a document does not turn its lines into
boilerplate (removing copies is the duplicate operators' task).

Counts are distinct counts over (host, line, text hash), which Spark deals out
by all three, so a hot host or line is spread before it is counted; the join of
lines with frequent lines is a plain shuffle join that can be split when skewed.

Defined cases: null text is empty: no words, base_failed, not kept; null hosts
form one host; null ids stay; equal rows get equal verdicts; empty tables give
empty results.  Only the named columns are read, ``clean`` passes the others on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.session import scratch_path

MIN_WORDS = 50
MIN_DOCS = 20          # a line in this many texts of its host, or fewer, is never boilerplate
SHARE = 0.01           # nor one in this share of the host's texts,
MOST_DOCS = 1000       # up to this many texts: beyond it a line always is
KEEP_SHARE = 0.5       # words a document must keep

WHITE = "\t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _line_key(words: Column) -> Column:
    flat = F.concat_ws(" ", words)
    return F.xxhash64(F.translate(F.lower(flat), "123456789", "000000000"))


def base_stats(rows: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    base_failed to rows with a ``text`` column (replaced by ``""`` where null)."""
    d = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("words", _words(F.col("text")))
    d = d.withColumn("n_words", F.size("words").cast("long"))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: _without(x, " " + WHITE) != ""))
    d = d.withColumn("tri", F.when(F.size("words") > 3, F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(F.col("words"), i + 1), F.get(F.col("words"), i + 2)))))
    d = d.withColumn("ranked", F.when(F.size(F.array_distinct("tri")) < F.size("tri"), F.array_sort(
        F.transform("tri", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("again", F.array_sort(F.filter(
        F.transform("ranked", lambda x, i: F.when(
            (F.get(F.col("ranked"), i - 1)["h"] == x["h"]) | (F.get(F.col("ranked"), i + 1)["h"] == x["h"]), x["i"])),
        lambda p: p.isNotNull())))
    covered = F.aggregate(
        F.transform("again", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("again"), i + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    d = d.select(
        *rows.columns, "n_words",
        F.length(_without(F.col("text"), " " + WHITE)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def _rows(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"))


def line_rows(rows: DataFrame) -> DataFrame:
    """One row per line with a word: doc_id, text hash, host, line hash, words."""
    words = F.filter(F.transform(F.split("text", "\n"), _words), lambda w: F.size(w) > 0)
    at = F.explode(F.transform(words, lambda w: F.struct(_line_key(w).alias("line"), F.size(w).alias("words"))))
    return (rows.select("doc_id", F.xxhash64("text").alias("th"), "host", at.alias("l"))
            .select("doc_id", "th", "host", "l.line", "l.words"))


def frequent_lines(rows: DataFrame, lines: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE,
                   most_docs: int = MOST_DOCS) -> DataFrame:
    """(host, line) pairs that more texts of the host hold than the limits."""
    count = lines.groupBy("host", "line").agg(F.count_distinct("th").alias("n_docs")).filter(F.col("n_docs") > min_docs)
    hosts = (rows.filter(_without(F.col("text"), " " + WHITE) != "").select("host", F.xxhash64("text").alias("th"))
             .groupBy("host").agg(F.count_distinct("th").alias("host_docs")))
    return (count.join(hosts, "host").filter((F.col("n_docs") > share * F.col("host_docs")) | (F.col("n_docs") > most_docs))
            .select("host", "line"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _removed(rows: DataFrame, min_docs: int, share: float, most_docs: int) -> DataFrame:
    """Lines above the limits (with the document they stand in), from a stored
    table of line hashes, which is made in one pass over the texts."""
    lines = _stored(line_rows(rows), "lines")
    return lines.join(frequent_lines(rows, lines, min_docs, share, most_docs), ["host", "line"])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE,
          most_docs: int = MOST_DOCS) -> DataFrame:
    """One row per document: its base figures, words in removed lines
    (n_line_words) and whether it is kept; ``th`` and ``host`` tell equal ids apart."""
    rows = _rows(docs, id_col, text_col, host_col)
    return _judged(rows, _removed(rows, min_docs, share, most_docs), keep_share)


def _judged(rows: DataFrame, removed: DataFrame, keep_share: float) -> DataFrame:
    gone = (removed
            .groupBy(F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_th"), F.col("host").alias("gone_host"))
            .agg(F.sum("words").alias("gone_words"), F.count(F.lit(1)).alias("gone_lines")))
    # equal rows would have their lines counted once for each: back to one row's share
    stats = base_stats(rows.withColumn("th", F.xxhash64("text"))).drop("text")
    same = rows.groupBy(F.col("doc_id").alias("gone_id"), F.xxhash64("text").alias("gone_th"),
                        F.col("host").alias("gone_host")).agg(F.count(F.lit(1)).alias("equal_rows"))
    gone = gone.join(same, [gone[c].eqNullSafe(same[c]) for c in ("gone_id", "gone_th", "gone_host")]).select(
        gone["gone_id"], gone["gone_th"], gone["gone_host"],
        (F.col("gone_words") / F.col("equal_rows")).cast("long").alias("n_line_words"))
    out = stats.join(gone, stats["doc_id"].eqNullSafe(gone["gone_id"]) & (stats["th"] == gone["gone_th"])
                     & (stats["host"] == gone["gone_host"]), "left")
    left = F.col("n_words") - F.col("n_line_words")
    # stored, so that a caller's filter is not pushed into the array functions, which would repeat them
    out = out.select("doc_id", "th", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.coalesce("n_line_words", F.lit(0)).alias("n_line_words")).withColumn(
        "kept", ~F.col("base_failed") & (left >= keep_share * F.col("n_words")))
    return _stored(out, "verdicts")


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_docs: int = MIN_DOCS, share: float = SHARE, keep_share: float = KEEP_SHARE,
          most_docs: int = MOST_DOCS) -> DataFrame:
    """The kept documents with all their columns, boilerplate lines removed
    from the text (a text without such lines is returned unchanged)."""
    rows = _rows(docs, id_col, text_col, host_col)
    same = ["doc_id", "th", "host"]
    # the texts are cut into lines once, for the verdicts and for the removal
    removed = _stored(_removed(rows, min_docs, share, most_docs), "removed-lines")
    verdict = _judged(rows, removed, keep_share).filter("kept").select(*same).distinct()
    gone = (removed.groupBy(*same).agg(F.collect_set("line").alias("lines")))  # of its own lines
    kept = verdict.join(gone, [verdict[c].eqNullSafe(gone[c]) for c in same], "left").select(
        *[verdict[c].alias(f"kept_{c}") for c in same], "lines")
    own = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"),
                      F.xxhash64(F.col(text_col)).alias("th"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"))
    out = own.join(kept, [own[c].eqNullSafe(kept[f"kept_{c}"]) for c in same])
    text = F.col("row")[text_col]
    clean_text = F.when(F.col("lines").isNull(), text).otherwise(F.array_join(F.filter(
        F.split(text, "\n"), lambda x: (_without(x, " " + WHITE) == "")
        | ~F.array_contains(F.col("lines"), _line_key(_words(x)))), "\n"))
    return out.select(*[(clean_text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
