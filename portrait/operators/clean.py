"""Row cleaning: null drops, sentinel values, length filters, distinct."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(cols))


def null_sentinels(c: Column, sentinels: Iterable[str]) -> Column:
    """Map sentinel strings ('null', 'unk', '', ...) to a real null."""
    out = c
    for s in sentinels:
        out = F.nullif(out, F.lit(s))
    return out


def min_trimmed_length(c: Column, n: int) -> Column:
    """Predicate: ``length(trim(c)) > n``."""
    return F.length(F.trim(c)) > n


def clean_rows(df: DataFrame, required: Sequence[str], length_col: str | None = None,
               min_len: int = 0) -> DataFrame:
    """Null drop over ``required``, optional trimmed-length filter, distinct."""
    out = drop_nulls(df, required)
    if length_col:
        out = out.where(min_trimmed_length(F.col(length_col), min_len))
    return out.select(*required).distinct()


def in_lists(c: Column, allowed: Iterable | None = None, denied: Iterable | None = None) -> Column:
    cond = F.lit(True)
    if allowed is not None:
        cond = cond & c.isin(list(allowed))
    if denied is not None:
        cond = cond & ~c.isin(list(denied))
    return cond
