"""Answer sheets kept as JSON: distinct sheets and each user's most complete ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.operators.labels import rows_at_group_max

QUESTIONS = [str(i) for i in range(12)]


def answers(content: Column, questions=tuple(QUESTIONS)) -> Column:
    """The answers of a JSON object as an array of (key, value) sorted by key,
    whatever the order in the text.  Only the given questions count; unknown keys
    and JSON nulls are left out, empty answers stay.  Bad JSON is an empty sheet."""
    known = F.map_filter(F.from_json(content, "map<string,string>"),
                         lambda k, v: k.isin(*questions) & v.isNotNull())
    return F.coalesce(F.array_sort(F.map_entries(known)), F.expr("cast(array() as array<struct<key:string,value:string>>)"))


def sheets(df: DataFrame, user: str, content: str) -> DataFrame:
    """Distinct sheets (user, answers, answered): equal answers of one user are
    one sheet; ``answered`` counts the answers that are not empty."""
    distinct = df.select(user, answers(F.col(content)).alias("answers")).distinct()
    return distinct.withColumn("answered", F.size(F.filter("answers", lambda a: a["value"] != "")).cast("bigint"))


def best_sheets(distinct: DataFrame, user: str) -> DataFrame:
    """Each user's sheets with most answers, ties kept."""
    return rows_at_group_max(distinct, user, "answered")


def shown(c: Column) -> Column:
    """Answers as ``key=value`` items joined by ``;``."""
    return F.array_join(F.transform(c, lambda a: F.concat(a["key"], F.lit("="), a["value"])), ";")
