"""Bucketed orders and lineitem join on the order key without an Exchange."""

import contextlib
import io

from pyspark.sql import functions as F

from tables import SF_SMALL
from portrait.session import scratch_path
from portrait.sources.tables import table, write_bucketed


def test_bucketed_install_join_has_no_shuffle(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        o = write_bucketed(table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey"),
                           "b_orders", "o_orderkey", 8, scratch_path(spark, "b_orders"))
        li = write_bucketed(table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_partkey"),
                            "b_lineitem", "l_orderkey", 8, scratch_path(spark, "b_lineitem"))
        pairs = o.join(li, o["o_orderkey"] == li["l_orderkey"]).select(
            F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("app_id"))
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            pairs.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert pairs.count() == table(spark, SF_SMALL, "lineitem").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS b_orders")
        spark.sql("DROP TABLE IF EXISTS b_lineitem")
