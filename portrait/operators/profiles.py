"""Per-user behaviour aggregates: action counts, ratings, daily label counts,
time-decayed interest profiles, event counts."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait import config as C
from portrait.operators.labels import ranked_profile


def score_map(spark) -> DataFrame:
    return spark.createDataFrame(C.EVENT_SCORES, "action string, score double")


def actions_daily(events: DataFrame, scores: DataFrame, keys: Sequence[str] = ("imei", "item_id", "action"),
                  day_col: str = "stat_date") -> DataFrame:
    """Count per (user, item, action, day) for actions in the score map (inner
    join against a fixed-size map, broadcast)."""
    kept = events.join(scores.select("action"), "action", "inner").dropna(subset=list(keys))
    return kept.groupBy(*keys, day_col).agg(F.count(F.lit(1)).cast("double").alias("frequency"))


def actions_range(daily: DataFrame, lo: int, hi: int, keys: Sequence[str] = ("imei", "item_id", "action"),
                  min_user_len: int = 5, day_col: str = "stat_date") -> DataFrame:
    """Sum of daily frequencies over the open range (lo, hi)."""
    r = daily.where((F.col(day_col) > lo) & (F.col(day_col) < hi))
    return (r.groupBy(*keys).agg(F.sum("frequency").alias("frequency"))
            .where(F.length(F.col(keys[0])) > min_user_len))


def item_rating(actions: DataFrame, scores: DataFrame, user: str = "imei", item: str = "item_id") -> DataFrame:
    """rating = sum(score(action) * frequency) per (user, item)."""
    j = actions.join(scores, "action", "inner")
    return j.groupBy(user, item).agg(F.sum(F.col("score") * F.col("frequency")).alias("rating"))


def label_daily(sources: Sequence[DataFrame], user: str = "imei", day_col: str = "stat_date") -> DataFrame:
    """Union of (user, pred, label) rows from several sources, counted per
    (user, 'pred@label', day)."""
    u = None
    for s in sources:
        t = s.select(user, "pred", "label", day_col)
        u = t if u is None else u.unionByName(t)
    return (u.dropna(subset=[user, "pred", "label"]).groupBy(user, "pred", "label", day_col).agg(F.count(F.lit(1)).alias("times"))
            .select(user, F.concat_ws("@", "pred", "label").alias("labels"), "times", day_col))


def decay_factor(days):
    """(30 - d + 1) * 0.03333 as an exact decimal."""
    return (F.lit(C.DECAY_DAYS + 1) - days) * F.lit(Decimal(str(C.DECAY_STEP)))


def decayed_profile(daily: DataFrame, as_of: _dt.date, since: _dt.date, user: str = "imei",
                    day_col: str = "stat_date", per_day: bool = False) -> DataFrame:
    """Decayed sum of daily label counts since ``since`` (exclusive) up to the
    as-of date, ranked into ``label:%.3f###...`` per user.  ``per_day=True``
    keeps one entry per (label, day) as the original job prints them."""
    lo, hi = (int(day.strftime("%Y%m%d")) for day in (since, as_of))
    d = F.datediff(F.lit(as_of), F.to_date(F.col(day_col).cast("string"), "yyyyMMdd"))
    scored = (daily.where((F.col(day_col) > lo) & (F.col(day_col) <= hi))
              .withColumn("_s", F.col("times").cast("decimal(20,0)") * decay_factor(d)))
    if per_day:
        entries = scored.select(user, "labels", day_col, F.round("_s", 3).alias("_s"))
        return ranked_profile(entries, user, "labels", "_s", tie=day_col)
    per = scored.groupBy(user, "labels").agg(F.sum("_s").alias("_s"))
    return ranked_profile(per.withColumn("_s", F.round("_s", 3)), user, "labels", "_s")


def event_count_sets(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by a, by b and by (a, b) in one pass (GROUPING SETS)."""
    return (df.groupingSets([[a], [b], [a, b]], a, b)
            .agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("bigint").alias("gid")))
