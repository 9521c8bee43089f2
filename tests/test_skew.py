"""One key holding a third of all rows: results stay exact, reductions are
partial aggregates, and the join-back of hot groups is split by AQE."""

import collections

from pyspark.sql import functions as F

from portrait.operators import content as CT
from portrait.operators import labels as L
from portrait.operators import sampling as SM


def hot_frame(spark, n=30000):
    # key 0 holds n/3 rows, the rest spread over 1000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id"), (F.col("id") * 7 % 101).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), (F.col("id") % 500).cast("string")))
        .alias("text"))


def test_hot_key_reductions_exact(spark):
    df = hot_frame(spark)
    rows = df.collect()
    first = L.dedupe_first(df, "k", ["v", "id"], ["text"])
    ref = {}
    for r in rows:
        if r.k not in ref or (r.v, r.id) < ref[r.k]:
            ref[r.k] = (r.v, r.id)
    assert {r.k: (r.v, r.id) for r in first.collect()} == ref
    s = SM.per_group_sample(df, "k", F.col("id"), 5)
    got = collections.Counter(r.k for r in s.collect())
    assert got[0] == 5 and all(c == 5 for c in got.values())


def test_hot_group_join_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = hot_frame(spark, 60000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), "text")
        g = CT.text_groups(df, ["lang", "text"], "doc_id")
        out = g.collect()
        sizes = collections.Counter(r.group_id for r in out)
        assert len(out) == 60000 and sizes[0] == 20000
        assert all(r.group_size == sizes[r.group_id] for r in out)
        plan = g._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_install_features_and_priority_union(spark):
    from portrait.operators import features as FE
    n = 30000
    # user 0 holds a third of all install rows; apps 0..99, vocabulary = apps 0..49
    pairs = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1).alias("user_id"),
        (F.col("id") % 100).alias("app_id"))
    vocab = spark.range(50).select(F.col("id").alias("app_id"), (49 - F.col("id")).alias("idx"),
                                   F.concat(F.lit("a"), F.col("id").cast("string")).alias("app_name"))
    packed = pairs.groupBy("user_id").agg(F.array_join(F.collect_list(F.concat(F.col("app_id").cast("string"), F.lit(":1"))), " ").alias("value"))
    f = {r.user_id: r for r in FE.install_features(packed, vocab).collect()}
    rows = pairs.collect()
    want = collections.defaultdict(set)
    for r in rows:
        if r.app_id < 50:
            want[r.user_id].add(49 - r.app_id)
    assert set(f) == set(want)
    for u, idx in want.items():
        assert f[u].feature == " ".join(f"{i}:1" for i in sorted(idx)) and f[u].n_apps == len(idx)

    a = pairs.select("user_id", F.lit(1).alias("label"), F.lit("a").alias("origin"))
    b = pairs.select("user_id", F.lit(2).alias("label"), F.lit("b").alias("origin"))
    u = L.priority_union([b.where(F.col("user_id") != 0), a], "user_id", "label")
    got = {r.user_id: (r.label, r.origin) for r in u.collect()}
    assert got[0] == (1, "a") and all(v == (2, "b") for k, v in got.items() if k != 0)
