"""Model evaluation in Spark SQL: exact AUC (rank-sum with average ranks),
F-measure threshold search, confusion-matrix metrics.

Scores are first aggregated per distinct value (partial aggregation), then
ordered cumulative counts come from the distributed running-totals helper,
so no step needs all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portrait.operators.ordering import running_totals


def _per_score(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("double").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("double").alias("neg"))


def auc(df: DataFrame, score: str = "score", label: str = "label", digits: int = 6,
        threshold: float | None = None) -> DataFrame:
    """Area under ROC = P(score_pos > score_neg) + 0.5 P(tie): one row with
    auc, n_pos, n_neg; with ``threshold`` also the accuracy of predicting
    positive for score >= threshold."""
    g = running_totals(_per_score(df, score, label), [F.col("score").asc()], ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    out = [F.round(F.try_divide(F.sum(F.col("pos") * (below + 0.5 * F.col("neg"))), F.sum("pos") * F.sum("neg")),
                   digits).alias("auc"),
           F.sum("pos").cast("bigint").alias("n_pos"), F.sum("neg").cast("bigint").alias("n_neg")]
    if threshold is not None:
        hits = F.sum(F.when(F.col("score") >= threshold, F.col("pos")).otherwise(F.col("neg")))
        out.append(F.round(F.try_divide(hits, F.sum(F.col("pos") + F.col("neg"))), digits).alias("accuracy"))
    return g.agg(*out)


def f_measure_by_threshold(df: DataFrame, score: str = "score", label: str = "label", beta: float = 1.0) -> DataFrame:
    """Precision, recall and F-beta when predicting positive for score >= t,
    for every distinct score t."""
    c = running_totals(_per_score(df, score, label), [F.col("score").desc()], ["pos", "neg"])
    total_pos = c.agg(F.max("cum_pos")).scalar()          # of the stored totals, not of the input again
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, total_pos)
    b2 = beta * beta
    f = F.when((precision + recall) > 0, (1 + b2) * precision * recall / (b2 * precision + recall)).otherwise(0.0)
    return c.select(F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall"),
                    f.alias("f_measure"))


def best_threshold(df: DataFrame, score: str = "score", label: str = "label", digits: int = 6) -> DataFrame:
    """The threshold with the largest F-measure; ties go to the highest
    threshold (the first one met when scanning scores downwards)."""
    fm = f_measure_by_threshold(df, score, label)
    # equal F values computed along different float paths differ in the last
    # bits; compare at 12 decimals so exact ties go to the higher threshold
    top = fm.orderBy(F.round("f_measure", 12).desc(), F.col("threshold").desc()).limit(1)
    return top.select("threshold", *[F.round(c, digits).alias(c) for c in ("f_measure", "precision", "recall")])


def confusion_metrics(df: DataFrame, label: str = "label", pred: str = "prediction", digits: int = 6) -> DataFrame:
    """Per class: tp, fp, fn, precision, recall, F1, plus overall accuracy.
    Everything after the first aggregate runs on (#classes)^2 rows."""
    cm = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # each matrix cell counts once for its label and once for its prediction:
    # one aggregation yields support, predicted and tp per class
    cell = F.explode(F.array(
        F.struct(F.col("l").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("tp")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp"))))
    j = (cm.select(cell.alias("_c")).select("_c.*").groupBy("cls")
         .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")))
    tp = F.col("tp").cast("double")
    whole = Window.partitionBy()                            # one row for each class
    total, correct = F.sum("support").over(whole), F.sum("tp").over(whole)
    prec = F.when(F.col("predicted") > 0, tp / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, tp / F.col("support")).otherwise(0.0)
    f1 = F.when((prec + rec) > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return j.select(
        F.col("cls").alias("class"), F.col("tp").cast("bigint").alias("tp"),
        (F.col("predicted") - F.col("tp")).cast("bigint").alias("fp"),
        (F.col("support") - F.col("tp")).cast("bigint").alias("fn"),
        F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
        F.round(f1, digits).alias("f1"), F.round(F.try_divide(correct.cast("double"), total), digits).alias("accuracy"))


def threshold_report(scored: DataFrame, thresholds: dict, score: str = "score", label: str = "label",
                     digits: int = 6) -> DataFrame:
    """For each named threshold: AUC of the 0/1 predictions (score >= t) and
    accuracy, the two numbers the training jobs report per threshold.  For
    0/1 predictions the ROC curve has one inner point, so
    AUC = (1 + TPR - FPR) / 2; all thresholds come out of one aggregation."""
    pos = F.col(label) == 1
    aggs = [F.count_if(pos).alias("_p"), F.count_if(~pos).alias("_n")]
    for i, t in enumerate(thresholds.values()):
        hit = F.col(score) >= F.lit(float(t))
        aggs += [F.count_if(hit & pos).alias(f"_tp{i}"), F.count_if(hit & ~pos).alias(f"_fp{i}")]
    c = scored.agg(*aggs)
    rows = []
    for i, (name, t) in enumerate(thresholds.items()):
        tp, fp, p, n = (F.col(f"_tp{i}"), F.col(f"_fp{i}"), F.col("_p"), F.col("_n"))
        rows.append(c.select(F.lit(name).alias("name"), F.lit(float(t)).alias("threshold"),
                             F.round(0.5 * (1 + F.try_divide(tp, p) - F.try_divide(fp, n)), digits).alias("auc"),
                             F.round(F.try_divide(tp + (n - fp), p + n), digits).alias("accuracy")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
