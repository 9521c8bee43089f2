"""Property checks on real outputs and brute-force checks on random data."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tables import SF_CHECK
from portrait.operators import evaluate as EV
from portrait.plans.queries import QUERIES


def test_split_is_a_partition(spark):
    s = QUERIES["hash_split"](spark, SF_CHECK)
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert s.count() == docs.count() == s.select("doc_id").distinct().count()
    frac = s.where(F.col("split") == "train").count() / s.count()
    assert 0.7 < frac < 0.9


def test_priority_union_unique_and_known_first(spark):
    u = QUERIES["priority_union"](spark, SF_CHECK)
    assert u.count() == u.select("doc_id").distinct().count()
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    j = u.join(lab, "doc_id")
    assert j.where((F.col("origin") != "known") | (F.col("label") != F.col("quality"))).count() == 0


def test_shares_sum_to_one(spark):
    d = QUERIES["label_distribution"](spark, SF_CHECK).collect()
    assert abs(sum(r.share for r in d) - 1.0) < 1e-3
    assert len({r.total for r in d}) == 1 and sum(r.n for r in d) == d[0].total


def test_profile_scores_non_increasing(spark):
    for r in QUERIES["label_profile"](spark, SF_CHECK).collect():
        scores = [float(x.rsplit(":", 1)[1]) for x in r.labels.split("###")]
        assert scores == sorted(scores, reverse=True)
        assert all(re.fullmatch(r"\d+\.\d{3}", x.rsplit(":", 1)[1]) for x in r.labels.split("###"))


def test_auc_in_unit_interval(spark):
    r = QUERIES["eval_auc"](spark, SF_CHECK).first()
    assert 0.0 <= r.auc <= 1.0 and r.n_pos > 0 and r.n_neg > 0


scored = st.lists(st.tuples(st.integers(0, 20), st.integers(0, 1)), min_size=2, max_size=60)


@settings(max_examples=15, deadline=None)
@given(scored)
def test_auc_and_threshold_brute_force(spark, rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "score double, label int")
    if pos and neg:
        wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
        assert abs(EV.auc(df).first().auc - round(wins / (len(pos) * len(neg)), 6)) < 1e-9
    if pos:
        best = None
        for t in sorted({s for s, _ in rows}, reverse=True):
            tp = sum(1 for s, y in rows if s >= t and y == 1)
            fp = sum(1 for s, y in rows if s >= t and y == 0)
            p, r = tp / (tp + fp), tp / len(pos)
            f = 2 * p * r / (p + r) if p + r > 0 else 0.0
            if best is None or f > best[1] + 1e-12:
                best = (t, f)
        got = EV.best_threshold(df).first()
        assert got.threshold == best[0] and abs(got.f_measure - round(best[1], 6)) < 1e-9


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("abcd")), min_size=1, max_size=50))
def test_confusion_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "label string, prediction string")
    got = {r["class"]: r for r in EV.confusion_metrics(df).collect()}
    classes = {x for pair in rows for x in pair}
    assert set(got) == classes
    acc = sum(1 for a, b in rows if a == b) / len(rows)
    for c in classes:
        tp = sum(1 for a, b in rows if a == c and b == c)
        fp = sum(1 for a, b in rows if a != c and b == c)
        fn = sum(1 for a, b in rows if a == c and b != c)
        assert (got[c].tp, got[c].fp, got[c].fn) == (tp, fp, fn)
        assert abs(got[c].accuracy - round(acc, 6)) < 1e-9


@settings(max_examples=10, deadline=None)
@given(scored, st.integers(0, 20))
def test_threshold_report_matches_general_auc(spark, rows, t):
    pos = [s for s, y in rows if y == 1]
    if not pos or len(pos) == len(rows):
        return
    df = spark.createDataFrame([(float(s), y) for s, y in rows], "score double, label int")
    rep = EV.threshold_report(df, {"t": float(t)}).first()
    binar = df.select((F.col("score") >= float(t)).cast("double").alias("score"), "label")
    assert abs(rep.auc - EV.auc(binar).first().auc) < 1e-6
    acc = sum(1 for s, y in rows if (s >= t) == (y == 1)) / len(rows)
    assert abs(rep.accuracy - round(acc, 6)) < 1e-9


def test_metrics_one_class_only_no_error(spark):
    """ANSI mode: degenerate inputs give null metrics instead of failing."""
    df = spark.createDataFrame([(0.3, 1), (0.7, 1)], "score double, label int")
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert EV.auc(df).first().auc is None
    assert EV.threshold_report(df, {"t": 0.5}).first().auc is None
    neg = spark.createDataFrame([(0.3, 0), (0.7, 0)], "score double, label int")
    r = EV.f_measure_by_threshold(neg).collect()
    assert all(x.recall is None for x in r)
