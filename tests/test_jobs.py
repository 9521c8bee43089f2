"""The daily job runner publishes one dated partition per run."""

from pyspark.sql import functions as F

from tables import SF_SMALL
from portrait.jobs import run_job
from portrait.plans import params
from portrait.plans.queries import QUERIES
from portrait.session import scratch_path


def test_job_publishes_dated_partitions(spark):
    out = scratch_path(spark, "warehouse")
    before = params.AS_OF
    run_job(spark, "scan_partition", "20240110", SF_SMALL, out)
    run_job(spark, "scan_partition", "20240111", SF_SMALL, out)
    run_job(spark, "scan_partition", "20240111", SF_SMALL, out)   # re-run replaces, never appends
    assert params.AS_OF == before
    t = spark.read.parquet(f"{out}/scan_partition")
    days = {r[0] for r in t.select("stat_date").distinct().collect()}
    assert days == {20240110, 20240111}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for d in ("2024-01-10", "2024-01-11"):
        n = ev.where(F.to_date("ts") == F.lit(d)).count()
        assert t.where(F.col("stat_date") == int(d.replace("-", ""))).count() == n


def test_windows_end_at_the_job_date(spark):
    before = params.AS_OF, params.PROFILE_AS_OF
    for job in ("label_profile", "user_actions_range"):
        early, late = (run_job(spark, job, day, SF_SMALL) for day in ("20240110", "20240120"))
        assert set(early.collect()) != set(late.collect())
    assert (params.AS_OF, params.PROFILE_AS_OF) == before


def test_two_jobs_of_one_process_keep_their_dates(spark):
    """Queries built by threads at the same time, read later."""
    import datetime as dt
    import threading
    got, gate = {}, threading.Barrier(2)

    def build(day):
        with params.job_day(day):
            gate.wait(30)
            got[day] = QUERIES["scan_partition"](spark, SF_SMALL)
            gate.wait(30)
    days = [dt.date(2024, 1, 10), dt.date(2024, 1, 12)]
    threads = [threading.Thread(target=build, args=(d,)) for d in days]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for d in days:
        assert {r[0] for r in got[d].select("stat_date").distinct().collect()} == {int(d.strftime("%Y%m%d"))}
    assert params.as_of() == params.AS_OF


def test_label_record_holds_the_job_date_only(spark):
    out = scratch_path(spark, "warehouse")
    for day in ("20240110", "20240111", "20240110"):
        run_job(spark, "label_daily", day, SF_SMALL, out)
    t = spark.read.parquet(f"{out}/label_daily")
    assert {r[0] for r in t.select("stat_date").distinct().collect()} == {20240110, 20240111}
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").where(F.col("event_type") != "error")
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    n = ev.where(F.to_date("ts") == F.lit("2024-01-10")).withColumn("p_partkey", F.get_json_object("props", "$.k").cast("long")) \
        .join(part, "p_partkey").count()
    assert t.where("stat_date = 20240110").agg(F.sum("times")).first()[0] == n


def test_day_windows_reach_the_scan(spark):
    for key in ("scan_hour_prefix", "user_actions_daily", "user_actions_range", "item_rating", "label_profile",
                "label_profile_entries"):
        plan = QUERIES[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan, key


def test_label_record_without_a_job_date_holds_every_day(spark):
    """Events and goods of its own; one event has no time, one no user, one no goods."""
    import datetime as dt
    sf = scratch_path(spark, "tables")
    days = [dt.datetime(2024, 1, 16, 5), dt.datetime(2024, 1, 16, 23), dt.datetime(2023, 12, 31, 1), dt.datetime(2024, 3, 2, 9), None]
    rows = [(i, 7, t, kind, '{"k": 1}') for i, t in enumerate(days) for kind in ("click", "view", "error")]
    rows += [(98, None, days[0], "click", '{"k": 1}'), (99, 7, days[0], "click", '{"k": 2}')]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string, props string") \
        .write.parquet(f"{sf}/events.parquet")
    spark.createDataFrame([(1, "b", "t")], "p_partkey long, p_brand string, p_type string").write.parquet(f"{sf}/part.parquet")
    got = {r.stat_date: (r.labels, r.times) for r in QUERIES["label_daily"](spark, sf).collect()}
    assert got == {20240116: ("b@t", 4), 20231231: ("b@t", 2), 20240302: ("b@t", 2), None: ("b@t", 2)}
    assert [(r.stat_date, r.times) for r in run_job(spark, "label_daily", "20231231", sf).collect()] == [(20231231, 2)]
    assert run_job(spark, "label_daily", "20230101", sf).collect() == []
