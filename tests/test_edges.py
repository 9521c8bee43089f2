"""Nulls, unknown names and dates in the content, profile and sink operators."""

import datetime as dt

from portrait.operators.ads import click_intervals, history_on_days
from portrait.operators.content import manual_override, reconcile_levels, text_groups
from portrait.operators.features import feature_bag
from portrait.operators.profiles import decayed_profile
from portrait.sources.sinks import overwrite_partition


def test_text_groups_keep_nulls_apart(spark):
    rows = [(1, None, "x"), (2, "x", None), (3, None, "x"), (4, "", "x"), (5, None, None)]
    got = {r.id: (r.group_id, r.group_size) for r in text_groups(
        spark.createDataFrame(rows, "id long, a string, b string"), ["a", "b"], "id").collect()}
    assert got == {1: (1, 2), 2: (2, 1), 3: (1, 2), 4: (4, 1), 5: (5, 1)}


def test_reconcile_keeps_rows_without_prediction_and_nulls_unknown_parents(spark):
    rows = [(1, "a_1", 0.3, None, None), (2, "a_1", 0.2, "zz-c_5", 0.9), (3, "a_1", 0.3, "b-c_5", 0.4)]
    df = spark.createDataFrame(rows, "id long, label_1 string, prob_1 double, label_2 string, prob_2 double")
    used = spark.createDataFrame([("a", 1), ("b", 2)], "name string, category_id long")
    got = {r.id: r.label_1 for r in reconcile_levels(df, used, drop_weak=True).collect()}
    assert got == {1: "a_1", 2: None}
    manual = manual_override(df.selectExpr("*", "if(id = 1, 'nobody', 'a') as m"), "m", used)
    assert {r.id: r.label_1 for r in manual.collect()} == {1: None, 2: "a_1", 3: "a_1"}


def test_partitions_keep_their_dates_and_profiles_end_at_the_as_of_day(spark, tmp_path):
    daily = spark.createDataFrame([("u", "l", 20240101, 1), ("u", "l", 20240102, 1), ("u", "l", 20240301, 5)],
                                  "imei string, labels string, stat_date long, times long")
    path = str(tmp_path / "t")
    overwrite_partition(daily, path, 20240301)
    assert spark.read.parquet(path).select("stat_date").distinct().count() == 3
    one = decayed_profile(daily, dt.date(2024, 1, 2), dt.date(2023, 12, 20)).collect()
    two = decayed_profile(daily.filter("stat_date < 20240201"), dt.date(2024, 1, 2), dt.date(2023, 12, 20)).collect()
    assert one == two


def test_feature_bag_has_one_token_for_each_element(spark):
    rows = [(1, "12 7_", "phone x"), (2, None, " "), (3, "", "a")]
    df = spark.createDataFrame(rows, "id long, history string, model string")
    got = {r.id: r.bag for r in df.select("id", feature_bag(df, ["history", "model"]).alias("bag")).collect()}
    assert got == {1: ["history_12", "history_7", "model_phone", "model_x"], 2: [], 3: ["model_a"]}


def test_click_history_by_day_with_repeated_clicks(spark):
    day = dt.date(2024, 1, 5)
    df = spark.createDataFrame([("u", "a", day)] * 3 + [("u", "b", day), ("u", "b", None), (None, "b", day)],
                               "imei string, unit_id string, day date")
    asked = spark.createDataFrame([("u", dt.date(2024, 1, d)) for d in range(5, 9)] + [("v", day)], "imei string, job_day date")
    assert click_intervals(df, "day").count() == 2
    got = {(r.imei, r.job_day): r.history_click_1m for r in history_on_days(asked, click_intervals(df, "day")).collect()}
    assert got[("u", dt.date(2024, 1, 7))] == "a b" and ("u", dt.date(2024, 1, 6)) not in got
