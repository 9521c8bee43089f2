"""Time-dependent queries give the same rows whatever the session time zone."""

import pytest

from tables import SF_CHECK
from portrait.plans.check import compare, duckdb_conn
from portrait.plans.oracle import ORACLE_SQL
from portrait.plans.queries import QUERIES

TIME_KEYS = ["scan_partition", "scan_date_range", "scan_hour_prefix", "ad_click_label", "ad_click_history",
             "label_profile", "event_counts", "user_actions_daily", "latest_partition", "partition_overwrite",
             "ad_training_month", "ctr_month_rows", "label_profile_entries", "ad_click_hourly"]


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "Asia/Kolkata"])
def test_time_queries_zone_independent(spark, tz):
    con = duckdb_conn(SF_CHECK)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for k in TIME_KEYS:
            r = compare(QUERIES[k](spark, SF_CHECK), con, ORACLE_SQL[k])
            assert r["values_match"] and r["rows_match"], (k, tz, r)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
