"""Label mapping, distributions, train/predict sets, unions with priority,
rule overrides and cross-label consistency."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portrait import config as C


def map_labels(df: DataFrame, value: str, mapping: DataFrame, key_col: str = "key",
               code_col: str = "code", out: str = "label", case_insensitive: bool = True,
               drop_codes: Sequence[int] = (0,), shift: int = 1) -> DataFrame:
    """Categorical answer -> numeric class via a mapping table (broadcast: its
    size is fixed); unknown / excluded classes dropped, codes shifted to 0-based."""
    v = F.lower(F.trim(F.col(value))) if case_insensitive else F.col(value)
    m = mapping.select((F.lower(F.col(key_col)) if case_insensitive else F.col(key_col)).alias("_k"),
                       F.col(code_col).alias("_code"))
    joined = df.join(m, v == F.col("_k"), "inner")
    if drop_codes:
        joined = joined.where(~F.col("_code").isin(list(drop_codes)))
    return joined.withColumn(out, (F.col("_code") - shift).cast("bigint")).drop("_k", "_code")


def profile_labels(answers: DataFrame, kind: str = "kind", value: str = "value") -> DataFrame:
    """Long table of answers (user_id, kind, value) -> (kind, user_id, label): the
    code and answer tables of all profile labels as one lookup.  Occupations
    compare case-insensitively and are shifted to 0-based; parents, children and
    marriage take single letters of their tables; any consumption answer but A is
    1 and an empty one none; ages up to 35 are 0, above 1; sexes are male 1,
    female 0.  Answers without a label are left out."""
    spark = answers.sparkSession
    tables = ([("occupation", k.lower(), c - 1) for k, c in C.OCCUPATION_CODES]
              + [("marriage", k, c) for k, c in C.MARRIAGE_ANSWERS] + [("parent", k, c) for k, c in C.PARENT_ANSWERS]
              + [("child_stage", k, c) for k, c in C.CHILD_ANSWERS] + [("sex", k, c) for k, c in C.SEXES])
    fixed = F.broadcast(spark.createDataFrame(tables, "_kind string, _key string, _code long"))
    v = F.when(F.col(kind) == "occupation", F.lower(F.trim(value))).otherwise(F.col(value))
    age = F.col(value).try_cast("int")
    by_rule = (F.when((F.col(kind) == "consumption") & (F.col(value) != ""), (F.col(value) != C.CONSUMPTION_LOW).cast("long"))
               .when((F.col(kind) == "marriage_by_age") & age.isNotNull(), (age > C.MARRIAGE_AGE).cast("long")))
    label = F.coalesce(by_rule, F.col("_code"))
    return (answers.join(fixed, (F.col(kind) == F.col("_kind")) & (v == F.col("_key")), "left")
            .select(F.col(kind).alias("kind"), "user_id", label.alias("label")).where(F.col("label").isNotNull()))


def single_choice(c: Column) -> Column:
    """Predicate: answer is exactly one character (multi-choice dropped)."""
    return F.length(c) == 1


def label_distribution(df: DataFrame, label: str = "label", digits: int = 4) -> DataFrame:
    """Count per label with total and share.  The ``over ()`` window runs on
    the already aggregated rows (one per label)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", tot.cast("bigint").alias("total"),
                         F.round(F.col("n") / tot, digits).alias("share"))


def train_predict_split(features: DataFrame, labels: DataFrame, key: str, label: str = "label",
                        missing: int = -1) -> DataFrame:
    """Left join features with labels; unlabelled rows get ``missing`` and
    form the predict set, labelled rows the training set."""
    j = features.join(labels.select(key, label), key, "left")
    lab = F.coalesce(F.col(label), F.lit(missing)).cast("bigint")
    return j.withColumn(label, lab).withColumn(
        "split", F.when(F.col(label) == missing, F.lit("predict")).otherwise(F.lit("train")))


def priority_union(sources: Sequence[DataFrame], key: str, value: str, origin: str = "origin") -> DataFrame:
    """Union sources ordered by priority (first wins) and keep, per key, the
    value from the highest-priority source - an aggregate, so hot keys are
    combined map-side."""
    tagged = None
    for i, s in enumerate(sources):
        t = s.select(key, value, origin).withColumn("_prio", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t)
    best = F.min_by(F.struct(F.col(value), F.col(origin)), F.col("_prio"))
    return tagged.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b." + value).alias(value),
                                                           F.col("_b." + origin).alias(origin))


def anti_keep_duplicates(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of ``a`` whose key never occurs in ``b``; duplicates of ``a`` kept
    (left anti join, not EXCEPT)."""
    return a.join(b.select(key).distinct(), key, "left_anti")


def occupation_flags(rows: DataFrame, key: str, booted: Column, student_apps, it_apps,
                     app: str = "app_id") -> DataFrame:
    """Per user, in one aggregation over the install rows: silent (installed
    but never booted), student app, IT app.  Replaces one scan and one join
    per rule with a single pass."""
    return rows.groupBy(key).agg(
        (F.max(booted.cast("int")) == 0).cast("int").alias("silent"),
        F.max(F.col(app).isin(list(student_apps)).cast("int")).alias("student"),
        F.max(F.col(app).isin(list(it_apps)).cast("int")).alias("it"))


def occupation_overrides_from_flags(pred: DataFrame, flags: DataFrame, age: DataFrame,
                                    key: str = "user_id", label: str = "occupation") -> DataFrame:
    """Rule overlay on predicted occupation classes.

    Order of the rules: silent users (class 10) win over the prediction by
    max; then a student app forces class 0; then an IT app forces class 8;
    users without an age are dropped; age group 0/1 forces 0; class 0 with age
    group 3/4 becomes 10.  Users present only in the flags take part too."""
    p = pred.select(key, F.col(label).cast("bigint").alias("_v"))
    f = flags.select(key, "silent", "student", "it")
    j = p.join(f, key, "full")
    silent_v = F.when(F.col("silent") == 1, F.lit(C.OCCUPATION_SILENT).cast("bigint"))
    base = (F.when(F.col("it") == 1, F.lit(C.OCCUPATION_IT))
            .when(F.col("student") == 1, F.lit(C.OCCUPATION_STUDENT))
            .otherwise(F.greatest(F.col("_v"), silent_v)))
    j = j.select(key, base.alias("_b")).where(F.col("_b").isNotNull())
    j = j.join(age.select(key, "age"), key, "inner").where(F.col("age").isNotNull())
    step = F.when(F.col("age").isin(0, 1), F.lit(C.OCCUPATION_STUDENT)).otherwise(F.col("_b"))
    final = F.when((step == C.OCCUPATION_STUDENT) & F.col("age").isin(3, 4),
                   F.lit(C.OCCUPATION_SILENT)).otherwise(step)
    return j.select(key, final.cast("bigint").alias(label))


def occupation_overrides(pred: DataFrame, silent: DataFrame, student: DataFrame, it: DataFrame,
                         age: DataFrame, key: str = "user_id", label: str = "occupation") -> DataFrame:
    """Same rules when the three user sets come from separate sources."""
    def flag(df, name):
        return df.select(key).distinct().withColumn(name, F.lit(1))
    flags = (flag(silent, "silent").join(flag(student, "student"), key, "full")
             .join(flag(it, "it"), key, "full").fillna(0, ["silent", "student", "it"]))
    return occupation_overrides_from_flags(pred, flags, age, key, label)


def consistency_merge(marriage: DataFrame, parent: DataFrame, child: DataFrame, key: str = "user_id") -> DataFrame:
    """Inner-join three predictions and make them agree: an unmarried parent
    becomes non-parent with no child stage; a non-parent has no child stage
    (tested on the original parent value)."""
    j = marriage.join(parent, key).join(child, key)
    m, p, c = F.col("marriage"), F.col("parent"), F.col("child_stage")
    unmarried_parent = (m == "unmarried") & (p == "parent")
    return j.select(
        key, m.alias("marriage"),
        F.when(unmarried_parent, F.lit("non_parent")).otherwise(p).alias("parent"),
        F.when(unmarried_parent | (p == "non_parent"), F.lit("null")).otherwise(c).alias("child_stage"))


def label_audit(a: DataFrame, b: DataFrame, key: str, label_a: str = "label_a",
                label_b: str = "label_b") -> DataFrame:
    """Keys labelled by both sources, and how many agree / conflict."""
    j = a.select(key, label_a).join(b.select(key, label_b), key)
    return j.agg(F.count(F.lit(1)).alias("matched"),
                 F.count_if(F.col(label_a) == F.col(label_b)).alias("agree"),
                 F.count_if(F.col(label_a) != F.col(label_b)).alias("conflict"))


def dedupe_first(df: DataFrame, key: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """First row per key in an explicit order (a partial min over a struct, so
    no per-key sort of the whole group)."""
    s = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in keep if c not in order]))
    out = df.groupBy(key).agg(s.alias("_f"))
    cols = list(dict.fromkeys(list(order) + list(keep)))
    return out.select(key, *[F.col("_f." + c).alias(c) for c in cols])


def ranked_profile(df: DataFrame, key: str, label: str, score: str, digits: int = 3,
                   sep: str = "###", tie: str | None = None) -> DataFrame:
    """Per key: ``label:score`` items sorted by score desc (ties: label asc,
    then ``tie`` desc), joined with ``sep``.  Bounded by the label vocabulary
    (times the number of ``tie`` values) per key."""
    shown = F.round(F.col(score).cast("decimal(38,10)"), digits).cast(f"decimal(38,{digits})").cast("string")
    order = [F.negative(F.col(score)).alias("_ns"), F.col(label).alias("_l")]
    if tie:
        order.append(F.negative(F.col(tie)).alias("_nt"))
    items = F.collect_list(F.struct(*order, shown.alias("_s")))
    return (df.groupBy(key).agg(F.array_sort(items).alias("_a"))
              .select(key, F.array_join(F.transform("_a", lambda x: F.concat(
                  x["_l"], F.lit(":"), x["_s"])), sep).alias("labels")))


def rows_at_group_max(df: DataFrame, key: str, metric: str) -> DataFrame:
    """Rows whose metric equals their key's maximum (ties all kept): group max
    (partial aggregate) joined back on (key, metric)."""
    best = df.groupBy(key).agg(F.max(metric).alias("_max"))
    return df.join(best.withColumnRenamed(key, "_k"),
                   (df[key] == F.col("_k")) & (df[metric] == F.col("_max"))).drop("_k", "_max")
