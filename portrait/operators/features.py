"""Install-list features, catalogue top-K, sparse vectors, CTR feature bags."""

from __future__ import annotations

from typing import Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.operators.ordering import global_index, top_k_indexed


def best_listing(listings: DataFrame, key: str = "app_id", metric: str = "install_num") -> DataFrame:
    """The largest metric of each key's listings - a partial aggregate, so a hot
    key never gathers its rows in one task."""
    return listings.groupBy(key).agg(F.max(metric).alias(metric))


def catalog_order(key: str = "app_id", metric: str = "install_num") -> list[Column]:
    """Order of the catalogue: metric desc, then id desc (ids are unique)."""
    return [F.col(metric).desc(), F.col(key).desc()]


def topk_catalog(catalog: DataFrame, k: int, key: str = "app_id", metric: str = "install_num",
                 index: str = "idx") -> DataFrame:
    """Top-K catalogue entries with a dense 0-based index."""
    return top_k_indexed(catalog, catalog_order(key, metric), k, index)


def catalog_index(catalog: DataFrame, key: str = "app_id", metric: str = "install_num",
                  index: str = "idx") -> DataFrame:
    """The whole catalogue in order with its index (distributed, no single task)."""
    return global_index(catalog, catalog_order(key, metric), index)


def parse_install_list(df: DataFrame, user: str, value: str, out_key: str = "app_id") -> DataFrame:
    """``"id:cnt id:cnt"`` -> one (user, app_id) row per token (id part kept)."""
    return (df.where(F.col(user).isNotNull() & F.col(value).isNotNull())
              .select(user, F.explode(packed_ids(F.col(value))).alias(out_key)))


def packed_ids(value: Column) -> Column:
    """``"id:cnt id:cnt"`` -> array of the id parts."""
    return F.transform(F.filter(F.split(value, " "), lambda x: x != ""), lambda x: F.split_part(x, F.lit(":"), F.lit(1)))


def vocabulary_index(ids: Column, keys: Sequence[str]) -> Column:
    """Positions of a row's ids in a list of keys: sorted, distinct, unknown ids
    left out.  The keys (a top-K list) travel with the tasks; a row's own list is
    looked up where it lies, without exploding it."""
    known = pa.array([str(k) for k in keys], pa.string())

    @F.arrow_udf("array<int>")
    def look_up(lists: pa.Array) -> pa.Array:
        flat = pc.index_in(lists.flatten(), value_set=known)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(edges), flat)
    return F.array_sort(F.array_distinct(F.filter(look_up(ids), lambda i: i.isNotNull())))


def install_features(packed: DataFrame, vocab: DataFrame, user: str = "user_id", value: str = "value",
                     key: str = "app_id", index: str = "idx", name: str = "app_name", prefix: str = "") -> DataFrame:
    """Per user with a packed install list: ``feature`` = ``"idx:1 idx:1 ..."`` in
    index order over the installed apps found in the vocabulary (users without
    any are left out), ``apps`` = their names in the same order.  No row leaves
    its place: there is one row per user already.  The vocabulary is the top-K
    list (indexes 0 to K - 1), whose size is K; with ``prefix`` the lists' ids
    carry it before the vocabulary's."""
    entries = vocab.select(index, key, name).orderBy(index).collect()          # K rows
    names = F.lit([e[name] for e in entries]) if entries else F.expr("cast(array() as array<string>)")
    found = (packed.where(F.col(user).isNotNull() & F.col(value).isNotNull())
             .select(user, vocabulary_index(packed_ids(F.col(value)), [f"{prefix}{e[key]}" for e in entries]).alias("_i"))
             .where(F.size("_i") > 0))
    return found.select(
        user,
        F.array_join(F.transform("_i", lambda i: F.concat(i.cast("string"), F.lit(":1"))), " ").alias("feature"),
        F.array_join(F.transform("_i", lambda i: F.get(names, i)), " ").alias("apps"),
        F.size("_i").cast("bigint").alias("n_apps"))


def install_stats(pairs: DataFrame, vocab: DataFrame, user: str = "user_id",
                  key: str = "app_id", index: str = "idx") -> DataFrame:
    """One row: users with a list, users whose list has no vocabulary app,
    users kept, min / max kept list length - in a single aggregation pass."""
    v = vocab.select(key, index)
    # distinct vocabulary apps per user: a set bounded by K, built with one
    # partial + final aggregate (count_distinct would add an aggregation level)
    per_user = (pairs.join(v, key, "left").groupBy(user)
                .agg(F.size(F.collect_set(index)).cast("bigint").alias("n")))
    return per_user.agg(
        F.count(F.lit(1)).alias("users_total"),
        F.count_if(F.col("n") == 0).alias("users_empty"),
        F.count_if(F.col("n") > 0).alias("users_kept"),
        F.min(F.when(F.col("n") > 0, F.col("n"))).cast("bigint").alias("min_len"),
        F.max("n").cast("bigint").alias("max_len"))


def install_flag(pairs: DataFrame, app_ids: Iterable, user: str = "user_id",
                 key: str = "app_id", flag: str = "flag") -> DataFrame:
    """1 when a user's list holds any of ``app_ids`` (exact id match instead
    of a substring test on the packed string)."""
    ids = list(app_ids)
    return pairs.groupBy(user).agg(F.max(F.col(key).isin(ids).cast("bigint")).alias(flag))


def sparse_indices(feature: Column) -> Column:
    """``"i:v i:v"`` -> sorted distinct int indices; malformed tokens dropped."""
    toks = F.filter(F.split(F.trim(feature), " "), lambda t: F.size(F.split(t, ":")) == 2)
    idx = F.transform(toks, lambda t: F.trim(F.split_part(t, F.lit(":"), F.lit(1))).try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(idx, lambda i: i.isNotNull())))


def columns_by_prefix(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    """Feature columns chosen by name prefix, in table order (schema only, no data)."""
    return [c for c in df.columns if any(c.startswith(p) for p in prefixes)]


def feature_bag(df: DataFrame, cols: Sequence[str]) -> Column:
    """Row -> array of ``col_value`` tokens, one for each blank-separated element
    of a value (``_`` removed from elements; null, empty and blank values give
    none), in column order."""
    def tokens(c: str) -> Column:
        value = F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("_"), F.lit(""))
        elements = F.filter(F.split(value, " "), lambda e: e != "")
        return F.transform(elements, lambda e: F.concat(F.lit(c + "_"), e))
    return F.flatten(F.array(*[tokens(c) for c in cols]))


def ctr_feature_rows(wide: DataFrame, feature_cols: Sequence[str], label: str = "label") -> DataFrame:
    """Bag of features per row; identical bags merged, label = any click."""
    bag = F.array_join(feature_bag(wide, feature_cols), " ")
    return (wide.select(bag.alias("features"), F.col(label).cast("bigint").alias(label))
            .groupBy("features").agg(F.max(label).alias(label)))


def feature_vocab(rows: DataFrame, features: str = "features", index: str = "idx") -> DataFrame:
    """Distinct feature tokens, sorted, with a dense 0-based index."""
    toks = (rows.select(F.explode(F.split(F.col(features), " ")).alias("feature"))
            .where(F.col("feature") != "").distinct())
    return global_index(toks, [F.col("feature").asc()], index)
