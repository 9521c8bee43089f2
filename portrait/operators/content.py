"""Content-interest steps: pages and articles to labelled rows, category
normalisation and paths, grouping of repeated texts, label reconciliation."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait import config as C
from portrait.functions import text as TX
from portrait.operators.ordering import global_index


def taxonomy(names: DataFrame, name: str = "name", id_col: str = "category_id") -> DataFrame:
    """Category list -> id = position in the sorted list."""
    return global_index(names.select(name).distinct(), [F.col(name).asc()], id_col)


def normalize_categories(df: DataFrame, raw: str, used: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Normalise a raw category, map aliases, and look it up in the used
    taxonomy: ``category`` (',' -> '-' for output), ``category_id`` (-1 when
    unknown) and ``level`` (2 for two comma parts, else 1; -1 when unknown)."""
    cat = TX.normalize_category(F.col(raw))
    out = df.withColumn("_cat", cat)
    if aliases is not None:
        a = aliases.select(F.col("alias").alias("_cat"), F.col("canonical").alias("_canon"))
        out = out.join(a, "_cat", "left").withColumn("_cat", F.coalesce("_canon", "_cat")).drop("_canon")
    u = used.select(F.col("name").alias("_cat"), F.col("category_id").alias("_id"))
    out = out.join(u, "_cat", "left")
    known = F.col("_id").isNotNull()
    return (out.withColumn("category", F.when(known, F.replace(F.col("_cat"), F.lit(","), F.lit("-")))
                           .otherwise(F.lit("UNK")))
               .withColumn("category_id", F.coalesce(F.col("_id"), F.lit(-1)).cast("bigint"))
               .withColumn("level", F.when(known, F.when(F.size(F.split("_cat", ",")) == 2, 2).otherwise(1))
                           .otherwise(-1).cast("bigint"))
               .drop("_cat", "_id"))


def category_levels(df: DataFrame, path: str, sep_regex: str = r"\|") -> DataFrame:
    """Keep rows whose path has exactly three levels; add level prefixes
    ``a``, ``a-b``, ``a-b-c``."""
    parts = F.split(F.trim(F.col(path)), sep_regex)
    return (df.where(F.size(parts) == 3)
              .withColumn("category_1", parts[0])
              .withColumn("category_2", F.array_join(F.slice(parts, 1, 2), "-"))
              .withColumn("category_3", F.array_join(parts, "-")))


def page_domain_labels(pages: DataFrame, url: str, title: str = "title",
                       known: DataFrame | None = None, deny_domains: Sequence[str] = (),
                       deny_titles: Sequence[str] = ()) -> DataFrame:
    """Host of the URL, deny-listed hosts and titles removed, known host ->
    label (default 'unk').  Filters run before any text processing."""
    d = pages.withColumn("domain", TX.url_host(F.col(url)))
    d = d.where(~F.col("domain").isin(list(deny_domains))).where(~F.col(title).isin(list(deny_titles)))
    if known is not None:
        d = d.join(known.select("domain", F.col("label").alias("_kl")), "domain", "left")
        d = d.withColumn("label", F.coalesce(F.col("_kl"), F.lit("unk"))).drop("_kl")
    else:
        d = d.withColumn("label", F.lit("unk"))
    return d


def text_groups(df: DataFrame, key_cols: Sequence[str], id_col: str) -> DataFrame:
    """Invert repeated texts: each row gets its group key (smallest id with the
    same key columns) and the group size.  Membership stays one row per id,
    so a group holding a third of all rows never lands in one list.

    Grouping is exact on the full key columns (partial aggregation collapses
    copies map-side, so the text crosses the network once); rows are matched
    back to their group on two independent hashes of the key (xxhash64 and
    md5, 192 bits), so the join moves ids and hashes, not texts.  Both hashes
    take in which columns are null and how long each is."""
    parts = [x for c in key_cols for x in (F.coalesce(F.length(F.col(c).cast("string")), F.lit(-1)).cast("string"),
                                           F.coalesce(F.col(c).cast("string"), F.lit("")))]
    keyed = df.select(id_col, *key_cols, F.xxhash64(*parts).alias("_h1"),
                      F.md5(F.concat_ws("\u0001", *parts)).alias("_h2"))
    g = (keyed.groupBy(*key_cols, "_h1", "_h2")
         .agg(F.min(id_col).alias("group_id"), F.count(F.lit(1)).alias("group_size"))
         .select("_h1", "_h2", "group_id", "group_size"))
    return keyed.select(id_col, "_h1", "_h2").join(g, ["_h1", "_h2"], "inner").select(id_col, "group_id", "group_size")


def source_name(code) -> "F.Column":
    out = None
    for c, n in C.SOURCE_NAMES:
        out = F.when(code == c, F.lit(n)) if out is None else out.when(code == c, F.lit(n))
    return out.otherwise(F.lit("other"))


def reconcile_levels(df: DataFrame, used_l1: DataFrame, drop_weak: bool = False) -> DataFrame:
    """Make a level-2 prediction agree with the level-1 prediction.

    ``label_1`` is ``name_id``, ``label_2`` is ``parent-child_id``.  When the
    level-2 parent differs from the level-1 name: if p2 > p1 and p2 >= 0.7 the
    level-1 label becomes the level-2 parent (with its taxonomy id) at
    confidence 1.5; otherwise level 2 becomes ``<name>-其它_<id>`` at 1.5.
    With ``drop_weak`` rows where both probabilities are <= 0.5 and the levels
    conflict are dropped.  Rows without predictions pass unchanged; a parent
    without a taxonomy id gives a null label."""
    n1 = F.split_part(F.col("label_1"), F.lit("_"), F.lit(1))
    id1 = F.split_part(F.col("label_1"), F.lit("_"), F.lit(2))
    p2parts = F.split(F.trim(F.col("label_2")), "-")
    parent2 = p2parts[0]
    conflict = (F.size(p2parts) == 2) & (n1 != parent2)
    u = used_l1.select(F.col("name").alias("_pn"), F.col("category_id").alias("_pid"))
    d = df.withColumn("_parent2", parent2).join(u, F.col("_parent2") == F.col("_pn"), "left")
    lift = conflict & (F.col("prob_2") > F.col("prob_1")) & (F.col("prob_2") >= 0.7)
    fall = conflict & ~lift
    if drop_weak:
        d = d.where(~F.coalesce(conflict & (F.col("prob_1") <= 0.5) & (F.col("prob_2") <= 0.5), F.lit(False)))
    rc = F.lit(C.RULE_CONFIDENCE)
    d = d.withColumn("_lift", F.coalesce(lift, F.lit(False))).withColumn("_fall", F.coalesce(fall, F.lit(False)))
    others = [c for c in df.columns if c not in ("label_1", "prob_1", "label_2", "prob_2")]
    return d.select(
        *others,
        F.when(F.col("_lift"), F.concat(F.col("_parent2"), F.lit("_"), F.col("_pid").cast("string")))
        .otherwise(F.col("label_1")).alias("label_1"),
        F.when(F.col("_lift"), rc).otherwise(F.col("prob_1")).alias("prob_1"),
        F.when(F.col("_fall"), F.concat(n1, F.lit("-" + TX.OTHER_SUFFIX + "_"), id1))
        .otherwise(F.col("label_2")).alias("label_2"),
        F.when(F.col("_fall"), rc).otherwise(F.col("prob_2")).alias("prob_2"))


def manual_override(df: DataFrame, manual: str, used: DataFrame) -> DataFrame:
    """A known manual label beats the prediction: label_1 = ``label_id`` at
    1.5, no level 2, source 'Manual'; otherwise source 'Pred'."""
    u = used.select(F.col("name").alias("_mn"), F.col("category_id").alias("_mid"))
    d = df.join(u, F.col(manual) == F.col("_mn"), "left")
    is_manual = F.coalesce(F.col(manual), F.lit("unk")) != "unk"
    others = [c for c in df.columns if c not in ("label_1", "prob_1", "label_2", "prob_2")]
    return d.select(
        *others,
        F.when(is_manual, F.concat(F.col(manual), F.lit("_"), F.col("_mid").cast("string")))
        .otherwise(F.col("label_1")).alias("label_1"),
        F.when(is_manual, F.lit(C.RULE_CONFIDENCE)).otherwise(F.col("prob_1")).alias("prob_1"),
        F.when(is_manual, F.lit("null")).otherwise(F.col("label_2")).alias("label_2"),
        F.when(is_manual, F.lit(-1.0)).otherwise(F.col("prob_2")).alias("prob_2"),
        F.when(is_manual, F.lit("Manual")).otherwise(F.lit("Pred")).alias("label_source"))


def training_lines(rows: DataFrame, levels: Sequence[int] = (1, 2)) -> DataFrame:
    """(field, level, line) of labelled articles (ftitle, fcontent, fcategory,
    fcategory_id, level): ``__label__<category>_<id>, <text>`` for the title and
    for the content.  Rows with a null field are left out."""
    head = F.concat(F.lit("__label__"), F.col("fcategory"), F.lit("_"), F.col("fcategory_id").cast("string"), F.lit(", "))
    texts = F.inline(F.array(F.struct(F.lit("title").alias("field"), F.col("ftitle").alias("text")),
                             F.struct(F.lit("content").alias("field"), F.col("fcontent").alias("text"))))
    clean = rows.dropna(subset=["fid", "ftitle", "fcontent", "fcategory"]).where(F.col("level").isin(list(levels)))
    return clean.select("level", head.alias("head"), texts).select("field", "level", F.concat("head", "text").alias("line"))
