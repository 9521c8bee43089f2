"""CTR rows with unit, day and click history, and training on the long form."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from portrait.operators import ads as AD
from portrait.operators import features as FE
from portrait.operators import longform as LF

COLUMNS = ["unit_id", "week", "date", "seg", "history_click_1m"]


def test_rows_hold_unit_day_and_every_unit_of_the_history(spark):
    day = dt.date(2024, 1, 10)
    labels = spark.createDataFrame([("u", "7", 3, "0109", day, 0), ("u", "8", 3, "0109", day, 1), ("v", "7", 3, "0109", day, 0)],
                                   "imei string, unit_id string, week long, date string, job_day date, label long")
    users = spark.createDataFrame([("u", "a_b"), ("v", None)], "imei string, seg string")
    units = spark.createDataFrame([("7",), ("8",)], "unit_id string")
    clicks = spark.createDataFrame([("u", "8", dt.date(2024, 1, 2)), ("u", "12", dt.date(2023, 12, 20)),
                                    ("u", "9", dt.date(2024, 1, 9)), ("u", "5", dt.date(2023, 12, 1))],
                                   "imei string, unit_id string, day date")
    wide = AD.training_wide_by_day(labels, users, units, AD.click_intervals(clicks, "day"))
    got = {tuple(r.features.split(" ")): r.label for r in FE.ctr_feature_rows(wide, COLUMNS).collect()}
    history = ("history_click_1m_12", "history_click_1m_8")
    assert got == {("unit_id_7", "week_3", "date_0109", "seg_ab", *history): 0,
                   ("unit_id_8", "week_3", "date_0109", "seg_ab", *history): 1,
                   ("unit_id_7", "week_3", "date_0109", "history_click_1m_null"): 0}


def test_intervals_merge_clicks_and_leave_gaps_of_short_months(spark):
    march = [("u", "x", dt.date(2019, 3, 2))]                # 31 March looks back to 3 March, 1 April to 1 March
    got = AD.click_intervals(spark.createDataFrame(march, "imei string, unit_id string, day date"), "day").collect()
    assert sorted((r.lo, r.hi) for r in got) == [(dt.date(2019, 3, 4), dt.date(2019, 3, 30)), (dt.date(2019, 4, 1), dt.date(2019, 4, 2))]
    many = [("u", "x", dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(20)] + [("u", "x", dt.date(2024, 6, 1))]
    got = AD.click_intervals(spark.createDataFrame(many, "imei string, unit_id string, day date"), "day").collect()
    assert len(got) == 2 and min(r.lo for r in got) == dt.date(2024, 1, 3)


def rows_of(spark, n=600, seed=4):
    rng = np.random.default_rng(seed)
    out = set()
    while len(out) < n:
        a, b, c = rng.integers(0, 3), rng.integers(0, 40), rng.integers(0, 400)
        out.add((f"a_{a} b_{b} c_{c}", int(rng.random() < (0.9 if a == 0 else 0.1))))
    return sorted({f: y for f, y in out}.items())


def trained(rows, rounds):
    """The same rounds in numpy, on a dense matrix."""
    names = sorted({t for f, _ in rows for t in f.split(" ")})
    x = np.array([[t in f.split(" ") for t in names] for f, _ in rows], float)
    y = np.array([y for _, y in rows], float)
    n, m = x.sum(axis=0), x.sum(axis=1).max()
    w = ahead = np.zeros(len(names))
    for look in LF.momentum(rounds):
        g = x.T @ (1 / (1 + np.exp(-x @ ahead)) - y)
        new = ahead - np.where(n > 0, 4 / (np.maximum(n, 1) * m) * g, 0)
        w, ahead = new, new + look * (new - w)
    loss = np.logaddexp(0, x @ w) - y * (x @ w)
    return dict(zip(names, w, strict=True)), loss.mean()


def test_long_form_weights_equal_dense_training(spark):
    rows = rows_of(spark)
    df = spark.createDataFrame(rows, "features string, label long")
    vocab, long = LF.examples(df)
    weights = LF.train(long, vocab)
    got = {r.feature: r.weight for r in vocab.join(weights, "idx").collect()}
    want, loss = trained(rows, LF.ROUNDS)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert loss < trained(rows, 2)[1] < np.log(2)
    assert got["a_0"] > 0 > got["a_1"]
    m = {r.row: r.margin for r in LF.margins(long, weights).collect()}
    assert len(m) == len(rows)


def test_vocabulary_above_two_million_terms_and_a_feature_of_every_row(spark):
    """No limit by size: a term of its own for each of 2.2 million rows, one in all rows."""
    rows = spark.range(2_200_000).select(F.concat(F.lit("all_1 own_"), F.col("id").cast("string")).alias("features"),
                                         (F.col("id") % 2).alias("label"))
    vocab, long = LF.examples(rows)
    weights = LF.train(long.where("split = 'train'"), vocab, rounds=1)
    assert vocab.count() == 2_200_001 == weights.count()
    lines = LF.weight_lines(weights, vocab, skip_prefix="all")
    assert lines.count() == 2_200_000
    shown = lines.groupBy("weight").count().collect()
    assert {r["weight"] for r in shown} == {-1.0, 0.0, 1.0}      # not in training: zero


def test_training_without_rows(spark):
    df = spark.createDataFrame([], "features string, label long")
    vocab, long = LF.examples(df)
    assert LF.train(long, vocab).count() == 0
