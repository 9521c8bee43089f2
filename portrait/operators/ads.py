"""Ad click-through data: click labels, click history, wide training rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from portrait.functions import dates as D

IMP, CLK = "all_imp", "all_clk"
SENTINEL_IMEI = "__IMEI__"


def click_labels(log: DataFrame, keys: Sequence[str] = ("imei", "unit_id", "location"),
                 hourly: bool = False, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Monitor-log rows -> one row per (user, unit, location, weekday, hour,
    MMdd) with label 1 if any of its events is a click.  Rows with a bad
    19-char timestamp are dropped; duplicates collapse in the aggregate.
    ``hourly=True`` keys by the hour string ``yyyy-MM-ddTHH`` instead."""
    need = list(keys) + ["posttime", "oper_type"]
    clean = (log.where(F.col("imei") != SENTINEL_IMEI)
             .where(F.col("oper_type").isin(IMP, CLK))
             .dropna(subset=need)
             .where(D.valid_posttime(F.col("posttime"))))
    ts = D.parse_posttime(F.col("posttime"))
    if hourly:
        h = clean.select(*keys, F.substring("posttime", 1, 13).alias("time"),
                         (F.col("oper_type") == CLK).cast("bigint").alias("_clk"))
        return h.groupBy(*keys, "time").agg(F.max("_clk").alias("label"))
    feats = clean.select(*keys, *extra_keys, D.weekday_mon1(ts).alias("week"),
                         F.hour(ts).cast("bigint").alias("hour"), F.date_format(ts, "MMdd").alias("date"),
                         (F.col("oper_type") == CLK).cast("bigint").alias("_clk"))
    return feats.groupBy(*keys, *extra_keys, "week", "hour", "date").agg(F.max("_clk").alias("label"))


def click_history(log: DataFrame, user: str = "imei", unit: str = "unit_id") -> DataFrame:
    """Clicked units per user as a sorted, blank-joined distinct list (bounded
    by the ad catalogue; collect_set combines map-side)."""
    clicks = log.where((F.col("oper_type") == CLK) & (F.col(user) != SENTINEL_IMEI)).dropna(subset=[user, unit])
    return clicks.groupBy(user).agg(
        F.array_join(F.array_sort(F.collect_set(unit)), " ").alias("history_click_1m"))


def training_wide(labels: DataFrame, users: DataFrame, ads: DataFrame, history: DataFrame,
                  user: str = "imei", unit: str = "unit_id") -> DataFrame:
    """Star join: labels x users x ads, left join to click history ('null'
    when absent).  Dimension sides are not force-broadcast: AQE broadcasts
    them only when their measured size is under the threshold."""
    j = (labels.join(users, user, "inner").join(ads, unit, "inner")
         .join(history, user, "left"))
    return j.withColumn("history_click_1m", F.coalesce(F.col("history_click_1m"), F.lit("null")))


def click_intervals(clicks: DataFrame, day: str, user: str = "imei", unit: str = "unit_id") -> DataFrame:
    """Job-day intervals (user, unit, lo, hi) in which a unit is in a user's
    click history: job day D sees clicks of [D - 1 month (lenient calendar), D - 1
    day).  A click's job days are found inside one row (two stretches of days at
    the end of a short month, else one); overlapping and adjoining stretches of a
    (user, unit) are merged, so an interval stands for any number of clicks."""
    c = F.col(day)
    once = clicks.select(user, unit, day).dropna().distinct()
    days = F.filter(F.sequence(F.date_add(c, 2), F.date_add(c, 32)), lambda d: D.offset_date(d, -1, 0) <= c)
    ends = lambda step: F.filter("_days", lambda d: ~F.array_contains("_days", F.date_add(d, step)))
    pieces = once.withColumn("_days", days).select(
        user, unit, F.inline(F.arrays_zip(ends(-1).alias("lo"), ends(1).alias("hi"))))
    w = Window.partitionBy(user, unit).orderBy("lo")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = pieces.withColumn("_new", F.coalesce((F.col("lo") > F.date_add(before, 1)).cast("int"), F.lit(1)))
    return (opened.withColumn("_island", F.sum("_new").over(w)).groupBy(user, unit, "_island")
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island"))


def history_on_days(days: DataFrame, intervals: DataFrame, user: str = "imei", unit: str = "unit_id",
                    day: str = "job_day") -> DataFrame:
    """``history_click_1m`` (sorted, blank-joined units) of the (user, day) rows
    of ``days`` that have one: an equi-join on the user, restricted by day, of the
    days asked for with the merged intervals."""
    asked = days.select(user, day).distinct()
    inside = asked.join(intervals, user).where((F.col("lo") <= F.col(day)) & (F.col(day) <= F.col("hi")))
    return inside.groupBy(user, day).agg(
        F.array_join(F.array_sort(F.collect_set(unit)), " ").alias("history_click_1m"))


def training_wide_by_day(labels: DataFrame, users: DataFrame, ads: DataFrame, intervals: DataFrame,
                         user: str = "imei", unit: str = "unit_id", day: str = "job_day") -> DataFrame:
    """Daily wide rows for many job days at once, each with the history of its day."""
    j = labels.join(users, user, "inner").join(ads, unit, "inner")
    history = history_on_days(j, intervals.withColumnRenamed(unit, "_unit"), user, "_unit", day)
    return (j.join(history, [user, day], "left")
            .withColumn("history_click_1m", F.coalesce(F.col("history_click_1m"), F.lit("null"))))
