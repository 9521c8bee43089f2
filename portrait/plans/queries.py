"""Query bindings on the test tables (one function per SURVEY key)."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait import config as C
from portrait.functions import dates as D
from portrait.functions import text as TX
from portrait.operators import ads as AD
from portrait.operators import clean as CL
from portrait.operators import content as CT
from portrait.operators import evaluate as EV
from portrait.operators import features as feat
from portrait.operators import labels as L
from portrait.operators import longform as LF
from portrait.operators import models as MD
from portrait.operators import profiles as PR
from portrait.operators import questionnaire as QN
from portrait.operators import sampling as SM
from portrait.operators import shopping as SH
from portrait.plans import params as P
from portrait.session import freeze, scratch_path
from portrait.sources import sinks as SK
from portrait.sources import tables as TB
from portrait.sources import textfiles as TF
from portrait.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- installs
def app_listings(spark, sf) -> DataFrame:
    """Catalogue listings: one row per (app, listing) with its install count; an
    app has several listings, the best one is kept by ``best_listing``.  Apps
    without a name are left out (keys only: names join after the cut)."""
    li = table(spark, sf, "lineitem")
    listings = (li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("install_num"))
                .select(F.col("l_partkey").alias("app_id"), "install_num"))
    return listings.join(table(spark, sf, "part").select(F.col("p_partkey").alias("app_id")), "app_id", "left_semi")


def install_pairs(spark, sf) -> DataFrame:
    """(user, app) install rows: orders x lineitem."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey"), F.col("o_custkey").alias("user_id"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                              F.col("l_partkey").alias("app_id"))
    return o.join(li, "o_orderkey").select("user_id", "app_id")


def packed_installs(spark, sf, prefix: str = "") -> DataFrame:
    """The install table: one row per user with the packed list ``id:count ...``,
    stored as the upstream job leaves it."""
    pairs = install_pairs(spark, sf).groupBy("user_id", "app_id").agg(F.count(F.lit(1)).alias("n"))
    item = F.concat(F.lit(prefix), F.col("app_id").cast("string"), F.lit(":"), F.col("n").cast("string"))
    path = scratch_path(spark, "installs")
    pairs.groupBy("user_id").agg(F.array_join(F.collect_list(item), " ").alias("value")).write.parquet(path)
    return spark.read.parquet(path)


def top_apps(spark, sf) -> DataFrame:
    """Top-K vocabulary with names, checkpointed: at most K rows, reused by several joins."""
    top = feat.topk_catalog(feat.best_listing(app_listings(spark, sf)), P.TOP_K)
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("app_id"), F.col("p_name").alias("app_name"))
    return freeze(F.broadcast(top).join(names, "app_id"))


def install_rows(spark, sf) -> DataFrame:
    return feat.install_features(packed_installs(spark, sf), top_apps(spark, sf))


@query("topk_catalog")
def q_topk_catalog(spark, sf):
    return top_apps(spark, sf).select("app_id", "app_name", "install_num", "idx")


@query("catalog_index")
def q_catalog_index(spark, sf):
    return feat.catalog_index(feat.best_listing(app_listings(spark, sf))).select("app_id", "install_num", "idx")


@query("install_features")
def q_install_features(spark, sf):
    return install_rows(spark, sf)


@query("install_features_prefixed")
def q_install_features_prefixed(spark, sf):
    """First population: the ids of its lists carry the '11' prefix."""
    return feat.install_features(packed_installs(spark, sf, "11"), top_apps(spark, sf), prefix="11")


@query("install_stats")
def q_install_stats(spark, sf):
    return feat.install_stats(install_pairs(spark, sf), top_apps(spark, sf))


@query("install_flag")
def q_install_flag(spark, sf):
    return feat.install_flag(install_pairs(spark, sf), P.FLAG_APPS)


# ---------------------------------------------------------------- scans


@query("scan_partition")
def q_scan_partition(spark, sf):
    ev = TB.ts_day_slice(table(spark, sf, "events"), "ts", P.as_of())
    return ev.select("event_id", "user_id", "event_type", "stat_date")


@query("scan_date_range")
def q_scan_date_range(spark, sf):
    """History window [d - 1 month, d - 1 day) with the lenient calendar."""
    lo = D.offset_date_py(P.as_of(), -1, 0)
    hi = D.offset_date_py(P.as_of(), 0, -1)
    ev = TB.ts_range_slice(table(spark, sf, "events"), "ts", lo, hi)
    prev = F.date_format(D.offset_date(F.to_date("ts"), -1, 0), "yyyyMMdd")
    return ev.select("event_id", "user_id", "stat_date", prev.alias("prev_month_day"))


@query("scan_hour_prefix")
def q_scan_hour_prefix(spark, sf):
    day = TB.ts_day_slice(table(spark, sf, "events"), "ts", P.as_of())
    ev = TB.with_partition_cols(day, F.col("ts"))
    return TB.scan_hour_prefix(ev, P.as_of()).select("event_id", "stat_hour")


@query("latest_partition")
def q_latest_partition(spark, sf):
    o = table(spark, sf, "orders").withColumn("stat_date", D.stat_date(F.col("o_orderdate")))
    return TB.latest_partition(o).select("o_orderkey", "o_custkey", "stat_date")


@query("latest_partition_table")
def q_latest_partition_table(spark, sf):
    """The newest partition of a catalogue table, found from its metadata; one
    partition is read."""
    name = f"orders_by_month_{uuid.uuid4().hex[:8]}"
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMM").cast("bigint").alias("stat_date"))
    (o.repartition("stat_date").write.partitionBy("stat_date").option("path", scratch_path(spark, "orders-by-month")).saveAsTable(name))
    return TB.latest_partition_of_table(spark, name).select("o_orderkey", "o_custkey", "stat_date")


# ---------------------------------------------------------------- cleaning
@query("clean_rows")
def q_clean_rows(spark, sf):
    ev = table(spark, sf, "events").select(
        "user_id", CL.null_sentinels(F.col("event_type"), ["error", ""]).alias("event_type"),
        F.get_json_object("props", "$.k").alias("item_id"), "props")
    return CL.clean_rows(ev, ["user_id", "event_type", "item_id"], length_col="props", min_len=5)


@query("source_filter")
def q_source_filter(spark, sf):
    d = table(spark, sf, "documents")
    listed = CL.in_lists(F.col("source"), allowed=["src1", "src3", "src5"], denied=None) & \
        CL.in_lists(F.col("lang"), denied=["de"])
    ors = ((F.col("source") == "src2") | (F.col("source") == "src7")) & \
        ((F.col("lang") == "en") | (F.col("lang") == "fr"))
    return d.where(listed | ors).select("doc_id", "source", "lang")


# ---------------------------------------------------------------- labels
SEGMENT_CODES = [("automobile", 1), ("building", 2), ("furniture", 3), ("machinery", 4), ("household", 0)]
SEGMENT_NAMES = [(0, "automobile"), (1, "building"), (2, "furniture"), (3, "machinery")]


def segment_labels(spark, sf) -> DataFrame:
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    mapping = spark.createDataFrame(SEGMENT_CODES, "key string, code int")
    names = F.broadcast(spark.createDataFrame(SEGMENT_NAMES, "label bigint, label_name string"))
    return L.map_labels(cust, "c_mktsegment", mapping).join(names, "label", "left") \
        .select("user_id", "label", "label_name")


@query("label_map")
def q_label_map(spark, sf):
    return segment_labels(spark, sf)


@query("answer_labels")
def q_answer_labels(spark, sf):
    """Single-choice survey answers (the order priority's rank as a letter
    A-E), first answer per user by order key, mapped with the marriage answer
    table (A -> 0, B -> 1, other answers dropped)."""
    o = table(spark, sf, "orders")
    letter = F.substring(F.lit("ABCDE"), F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).try_cast("int"), 1)
    ans = o.select(F.col("o_custkey").alias("user_id"), "o_orderkey", letter.alias("answer"))
    ans = ans.where(L.single_choice(F.col("answer")))
    first = L.dedupe_first(ans, "user_id", ["o_orderkey"], ["answer"]).select("user_id", "answer")
    m = spark.createDataFrame(C.MARRIAGE_ANSWERS, "key string, code int")
    return L.map_labels(first, "answer", m, case_insensitive=False, drop_codes=(), shift=0) \
        .select("user_id", "answer", "label")


@query("profile_label_maps")
def q_profile_label_maps(spark, sf):
    """Every answer and code table of the profile labels in one long table (kind,
    user_id, label).  Answers are letters A-H made of the customer's figures."""
    c = table(spark, sf, "customer")
    letter = lambda n: F.substring(F.lit("ABCDEFGH"), (F.col("c_custkey") * n % 8 + 1).cast("int"), 1)
    codes = F.array(*[F.lit(k) for k, _ in C.OCCUPATION_CODES], F.lit("it"), F.lit("?"))
    occupation = F.get(codes, (F.col("c_custkey") % (len(C.OCCUPATION_CODES) + 2)).cast("int"))
    age = (F.col("c_custkey") % 60 + 10).cast("int")
    sex = F.when(F.col("c_custkey") % 5 == 4, F.lit(None)).when(F.col("c_custkey") % 2 == 0, "male").otherwise("female")
    rows = c.select(F.col("c_custkey").alias("user_id"), F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in (
            ("occupation", occupation), ("marriage", letter(3)), ("parent", letter(1)), ("child_stage", letter(5)),
            ("consumption", F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(letter(7))),
            ("marriage_by_age", age.cast("string")), ("sex", sex))])))
    return L.profile_labels(rows)


@query("label_distribution")
def q_label_distribution(spark, sf):
    return L.label_distribution(segment_labels(spark, sf))


@query("train_predict_sets")
def q_train_predict_sets(spark, sf):
    users = install_rows(spark, sf).select("user_id")
    return L.train_predict_split(users, segment_labels(spark, sf), "user_id").select("user_id", "label", "split")


def doc_rule_label(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", (F.col("n_chars") > 2000).cast("bigint").alias("label"))


@query("priority_union")
def q_priority_union(spark, sf):
    known = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("label"),
                                              F.lit("known").alias("origin"))
    pred = doc_rule_label(spark, sf).withColumn("origin", F.lit("predicted"))
    third = (table(spark, sf, "documents").where(F.col("lang") == "en")
             .select("doc_id", F.lit(0).cast("bigint").alias("label"), F.lit("third").alias("origin")))
    return L.priority_union([known, pred, third], "doc_id", "label")


@query("silent_users")
def q_silent_users(spark, sf):
    o = table(spark, sf, "orders")
    a = o.where(F.col("o_orderstatus") == "O").select(F.col("o_custkey").alias("user_id"), "o_orderkey")
    b = o.where(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("user_id"))
    return L.anti_keep_duplicates(a, b, "user_id")


def age_groups(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    age = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(
        F.least(F.floor(F.col("c_acctbal") / 2000), F.lit(4))).cast("bigint")
    return c.select(F.col("c_custkey").alias("user_id"), age.alias("age"))


@query("occupation_overrides")
def q_occupation_overrides(spark, sf):
    """Installs = orders x lineitem; a line with status 'F' counts as booted.
    One join and one aggregation give all three rule flags."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                              F.col("l_partkey").alias("app_id"), "l_linestatus")
    rows = o.join(li, "o_orderkey")
    flags = L.occupation_flags(rows, "user_id", F.col("l_linestatus") == "F", P.STUDENT_APPS, P.IT_APPS)
    pred = segment_labels(spark, sf).select("user_id", F.col("label").alias("occupation"))
    return L.occupation_overrides_from_flags(pred, flags, age_groups(spark, sf))


@query("consistency_merge")
def q_consistency_merge(spark, sf):
    c = table(spark, sf, "customer")
    marriage = c.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_acctbal") > 4000, "married").otherwise("unmarried").alias("marriage"))
    parent = c.where(F.col("c_nationkey") != 3).select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_nationkey") < 12, "parent").otherwise("non_parent").alias("parent"))
    child = c.select(F.col("c_custkey").alias("user_id"),
                     F.when(F.col("c_mktsegment") == "AUTOMOBILE", "baby")
                     .when(F.col("c_mktsegment") == "BUILDING", "pregnancy")
                     .otherwise("teen").alias("child_stage"))
    return L.consistency_merge(marriage, parent, child)


@query("label_audit")
def q_label_audit(spark, sf):
    known = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("label_a"))
    rule = doc_rule_label(spark, sf).withColumnRenamed("label", "label_b")
    return L.label_audit(known, rule, "doc_id")


@query("coverage_report")
def q_coverage_report(spark, sf):
    """User-population overlap in one pass over events: a left join to the
    customer keys marks known users, one aggregation counts everything."""
    ev = table(spark, sf, "events").select("user_id")
    cust = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    known = cust.distinct().withColumn("_known", F.lit(True))
    j = ev.join(known, "user_id", "left")
    is_known = F.coalesce(F.col("_known"), F.lit(False))
    return j.agg(F.count_distinct("user_id").alias("event_users"),
                 F.count_distinct(F.when(is_known, F.col("user_id"))).alias("overlap_users"),
                 F.count_if(is_known).alias("events_of_known"),
                 cust.select(F.count(F.lit(1))).scalar().alias("customers"))


@query("dedupe_first")
def q_dedupe_first(spark, sf):
    ev = table(spark, sf, "events")
    return L.dedupe_first(ev, "user_id", ["ts", "event_id"], ["event_type"])


@query("id_translate")
def q_id_translate(spark, sf):
    ev = table(spark, sf, "events")
    cust = table(spark, sf, "customer")
    signups = (ev.where(F.col("event_type") == "signup")
               .groupBy("user_id").agg(F.count(F.lit(1)).alias("n_signups")))
    named = cust.where(F.length("c_name") > 0).select("c_custkey", "c_name")
    j = signups.join(named, signups["user_id"] == named["c_custkey"], "inner")   # keys differ, both kept
    device_map = cust.select(F.upper(F.md5(F.col("c_custkey").cast("string"))).alias("imeimd5"),
                             F.col("c_nationkey").cast("bigint").alias("device"))
    keyed = j.withColumn("user_md5", F.md5(F.col("user_id").cast("string")))
    out = keyed.join(device_map, F.lower(keyed["user_md5"]) == F.lower(device_map["imeimd5"]), "left") \
        .where(F.col("imeimd5").isNotNull())
    return out.select("user_id", "c_custkey", "c_name", "n_signups", "device")


# ---------------------------------------------------------------- ads


def ad_monitor_log(spark, sf, start=None, end=None) -> DataFrame:
    """Events as an ad monitor log: views are impressions, clicks are clicks;
    the unit is the JSON field k, the slot a bucket of the event value.
    ``start``/``end`` bound the raw timestamp so the scan is pushed down."""
    ev = table(spark, sf, "events").where(F.col("event_type").isin("view", "click"))
    if start is not None:
        ev = TB.ts_range_slice(ev, "ts", start, end)
    return ev.select(
        F.md5(F.col("user_id").cast("string")).alias("imei"),
        F.get_json_object("props", "$.k").alias("unit_id"),
        F.concat(F.lit("L"), F.floor(F.col("value") / 25).cast("string")).alias("location"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("posttime"),
        F.when(F.col("event_type") == "click", AD.CLK).otherwise(AD.IMP).alias("oper_type"),
        F.date_format("ts", "yyyyMMddHH").alias("stat_hour"),
        D.stat_date(F.col("ts")).alias("stat_date"))


def _yesterday():
    return P.as_of() - _dt.timedelta(days=1)


def ad_labels(spark, sf) -> DataFrame:
    y = _yesterday()
    log = TB.scan_hour_prefix(ad_monitor_log(spark, sf, y, y + _dt.timedelta(days=1)), y)
    return AD.click_labels(log)


def ad_history(spark, sf) -> DataFrame:
    lo = int(D.offset_date_py(P.as_of(), -1, 0).strftime("%Y%m%d"))
    hi = int(D.offset_date_py(P.as_of(), 0, -1).strftime("%Y%m%d"))
    log = ad_monitor_log(spark, sf, D.offset_date_py(P.as_of(), -1, 0), D.offset_date_py(P.as_of(), 0, -1))
    return AD.click_history(log.where((F.col("stat_date") >= lo) & (F.col("stat_date") < hi)))


def ad_users(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer").dropna(subset=["c_custkey"])
    return c.select(F.md5(F.col("c_custkey").cast("string")).alias("imei"),
                    F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").cast("string").alias("nation"),
                    F.floor(F.col("c_acctbal") / 1000).cast("string").alias("bal"))


def ad_units(spark, sf) -> DataFrame:
    p = table(spark, sf, "part").dropna(subset=["p_partkey", "p_brand", "p_type", "p_size"])
    return p.select(F.col("p_partkey").cast("string").alias("unit_id"), F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("ptype"), F.col("p_size").cast("string").alias("psize"))


def ad_wide(spark, sf) -> DataFrame:
    return AD.training_wide(ad_labels(spark, sf), ad_users(spark, sf), ad_units(spark, sf), ad_history(spark, sf))


# feature columns of the wide row, chosen by name prefix
CTR_FEATURE_PREFIXES = ["unit_id", "location", "week", "hour", "date", "seg", "nation", "bal", "brand", "ptype", "psize",
                        "history_click_1m"]


def ctr_features(wide: DataFrame) -> list[str]:
    return feat.columns_by_prefix(wide, CTR_FEATURE_PREFIXES)


def _ctr_rows(spark, sf) -> DataFrame:
    wide = ad_wide(spark, sf)
    return feat.ctr_feature_rows(wide, ctr_features(wide))


def month_window():
    """Job days of the training window: [d - 1 month, d)."""
    return D.offset_date_py(P.as_of(), -1, 0), P.as_of()


@query("ad_training_month")
def q_ad_training_month(spark, sf):
    """Daily wide rows for every job day of the one-month training window,
    each with its own as-of click history (what the daily job writes, day by
    day, and the model job reads back as a month of partitions)."""
    lo, hi = month_window()
    # job day D labels the actions of day D - 1
    ev_lo, ev_hi = lo - _dt.timedelta(days=1), hi - _dt.timedelta(days=1)
    log = ad_monitor_log(spark, sf, ev_lo, ev_hi).withColumn(
        "job_day", F.date_add(F.to_date(F.col("stat_date").cast("string"), "yyyyMMdd"), 1))
    labels = AD.click_labels(log, extra_keys=["job_day"])
    hist_lo = D.offset_date_py(lo, -1, 0)
    clicks = (ad_monitor_log(spark, sf, hist_lo, ev_hi).where(F.col("oper_type") == AD.CLK)
              .select("imei", "unit_id", F.to_date(F.col("stat_date").cast("string"), "yyyyMMdd").alias("click_day")))
    wide = AD.training_wide_by_day(labels, ad_users(spark, sf), ad_units(spark, sf), AD.click_intervals(clicks, "click_day"))
    return wide.select(D.stat_date(F.col("job_day")).alias("stat_date"), "imei", "unit_id", "location", "week",
                       "hour", "date", "seg", "nation", "bal", "brand", "ptype", "psize", "history_click_1m", "label")


@query("ctr_month_rows")
def q_ctr_month_rows(spark, sf):
    """CTR training rows over the month: feature bags merged across days,
    label = any click."""
    wide = q_ad_training_month(spark, sf)
    return feat.ctr_feature_rows(wide, ctr_features(wide))


@query("ad_click_label")
def q_ad_click_label(spark, sf):
    return ad_labels(spark, sf).select("imei", "unit_id", "location", "week", "hour", "date", "label")


@query("ad_click_hourly")
def q_ad_click_hourly(spark, sf):
    """Standalone daily action table keyed by the hour string yyyy-MM-ddTHH."""
    y = _yesterday()
    log = TB.scan_hour_prefix(ad_monitor_log(spark, sf, y, y + _dt.timedelta(days=1)), y)
    return AD.click_labels(log, hourly=True)


@query("ad_click_history")
def q_ad_click_history(spark, sf):
    return ad_history(spark, sf)


@query("ad_training_wide")
def q_ad_training_wide(spark, sf):
    return ad_wide(spark, sf).select("imei", "unit_id", "location", "week", "hour", "date", "seg", "nation",
                                     "bal", "brand", "ptype", "psize", "history_click_1m", "label")


@query("ctr_feature_rows")
def q_ctr_feature_rows(spark, sf):
    return _ctr_rows(spark, sf)


@query("ctr_feature_lines")
def q_ctr_feature_lines(spark, sf):
    """Labelled feature lines ``features##yf##label`` written and read back."""
    rows = _ctr_rows(spark, sf)
    path = scratch_path(spark, "ctr_lines")
    SK.export_lines(rows, F.concat_ws("##yf##", "features", F.col("label").cast("string")), path)
    return spark.read.text(path)


@query("feature_vocab")
def q_feature_vocab(spark, sf):
    return feat.feature_vocab(_ctr_rows(spark, sf))


# ---------------------------------------------------------------- ratings
ACTION_OF_EVENT = [("click", "content_click"), ("view", "video_play"), ("purchase", "content_share"),
                   ("signup", "content_comment")]


def action_log(spark, sf, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """Actions of the days [lo, hi); the bounds are pushed to the scan."""
    ev = TB.ts_range_slice(table(spark, sf, "events"), "ts", lo, hi)
    m = F.broadcast(spark.createDataFrame(ACTION_OF_EVENT, "event_type string, action string"))
    return ev.join(m, "event_type", "left").select(
        F.md5(F.col("user_id").cast("string")).alias("imei"),
        F.get_json_object("props", "$.k").alias("item_id"), "action",
        D.stat_date(F.col("ts")).alias("stat_date"))


def daily_actions(spark, sf, lo: _dt.date, hi: _dt.date) -> DataFrame:
    return PR.actions_daily(action_log(spark, sf, lo, hi), PR.score_map(spark))


def ranged_actions(spark, sf) -> DataFrame:
    """Actions of the open range (job date - RANGE_DAYS, job date)."""
    lo = P.as_of() - _dt.timedelta(days=P.RANGE_DAYS)
    bounds = (int(d.strftime("%Y%m%d")) for d in (lo, P.as_of()))
    return PR.actions_range(daily_actions(spark, sf, lo, P.as_of()), *bounds)


@query("user_actions_daily")
def q_user_actions_daily(spark, sf):
    return daily_actions(spark, sf, P.as_of(), P.as_of() + _dt.timedelta(days=1)) \
        .select("imei", "item_id", "action", "frequency")


@query("user_actions_range")
def q_user_actions_range(spark, sf):
    return ranged_actions(spark, sf)


@query("item_rating")
def q_item_rating(spark, sf):
    return PR.item_rating(ranged_actions(spark, sf), PR.score_map(spark))


# ---------------------------------------------------------------- daily labels / profile
LABEL_SOURCES = ("click", "view", "purchase", "signup")


def label_rows(spark, sf, lo: _dt.date | None = None, hi: _dt.date | None = None) -> DataFrame:
    """(source, imei, pred, label, stat_date) rows of all days, or of the days [lo, hi)."""
    ev = table(spark, sf, "events")
    ev = ev.withColumn("stat_date", D.stat_date(F.col("ts"))) if lo is None else TB.ts_range_slice(ev, "ts", lo, hi)
    ev = ev.where(F.col("event_type").isin(*LABEL_SOURCES))
    part = table(spark, sf, "part").select(F.col("p_partkey"), F.col("p_brand").alias("pred"),
                                           F.col("p_type").alias("label"))
    return ev.select(F.col("event_type").alias("source"), F.md5(F.col("user_id").cast("string")).alias("imei"),
                     F.get_json_object("props", "$.k").try_cast("bigint").alias("p_partkey"), "stat_date").join(part, "p_partkey") \
        .select("source", "imei", "pred", "label", "stat_date")


def label_sources(spark, sf, day: _dt.date | None = None) -> list[DataFrame]:
    """The result tables of the four sources, all days or one job's date only.
    Here one event type stands for each; they are written first, a folder per
    source and day, as their own jobs leave them."""
    path = scratch_path(spark, "label-results")
    days = () if day is None else (day - _dt.timedelta(days=1), day + _dt.timedelta(days=1))
    label_rows(spark, sf, *days).hint("rebalance", "source", "stat_date") \
        .write.partitionBy("source", "stat_date").parquet(path)
    results = spark.read.schema("imei string, pred string, label string, source string, stat_date long").parquet(path)
    sources = [results.where(F.col("source") == s) for s in LABEL_SOURCES]
    return sources if day is None else [TB.scan_partition(s, day) for s in sources]


def profile(spark, sf, **form) -> DataFrame:
    """Decayed profile as of PROFILE_AS_OF; only its month is scanned."""
    as_of = P.profile_as_of()
    since = D.offset_date_py(as_of, -1, 0)
    daily = PR.label_daily([label_rows(spark, sf, since, as_of + _dt.timedelta(days=1))])
    return PR.decayed_profile(daily, as_of, since, **form)


@query("label_daily")
def q_label_daily(spark, sf):
    """Label counts over all sources: the record of every day, or, in a job for a
    date, that date's partition only."""
    day, path = P.job_date(), scratch_path(spark, "label-record")
    SK.overwrite_partitions(PR.label_daily(label_sources(spark, sf, day)).hint("rebalance", "stat_date"), path)
    record = spark.read.schema("imei string, labels string, times long, stat_date long").parquet(path)
    return record if day is None else TB.scan_partition(record, day)


@query("label_profile")
def q_label_profile(spark, sf):
    return profile(spark, sf)


@query("label_profile_entries")
def q_label_profile_entries(spark, sf):
    """The original output form: one decayed entry per (label, day)."""
    return profile(spark, sf, per_day=True)


@query("event_counts")
def q_event_counts(spark, sf):
    ev = table(spark, sf, "events").where(F.col("event_type").isin("view", "click"))
    return ev.groupBy(D.stat_date(F.col("ts")).alias("stat_date"), "event_type") \
        .agg(F.count(F.lit(1)).alias("n"))


@query("event_counts_sets")
def q_event_counts_sets(spark, sf):
    ev = table(spark, sf, "events").select(
        F.concat(F.lit("b"), F.floor(F.col("user_id") / 25).cast("string")).alias("source"), "event_type")
    return PR.event_count_sets(ev, "source", "event_type")


@query("run_metrics")
def q_run_metrics(spark, sf):
    """Rows, distinct users, items and user-item pairs, each distinct count from
    its own distinct keys (a plain partial aggregate, no expanded copies)."""
    ev = table(spark, sf, "events").select("user_id", F.get_json_object("props", "$.k").alias("item_id"))
    keys = lambda *c: ev.dropna(subset=list(c)).select(*c).distinct().select(F.count(F.lit(1))).scalar()
    return ev.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", keys("user_id").alias("users"), keys("item_id").alias("items"), keys("user_id", "item_id").alias("user_items"))


def answer_sheets(spark, sf) -> DataFrame:
    """Raw sheets (user_id, content): an order is a sheet of three or four answers
    as JSON; some are empty, one may be missing, one key is of no question, and
    the order of the keys differs."""
    o = table(spark, sf, "orders")
    item = lambda k, v: F.concat(F.lit(f'"{k}":"'), v, F.lit('"'))
    first = F.substring("o_orderpriority", 1, 1)
    items = [item("0", F.col("o_orderstatus")),
             item("1", F.when(F.col("o_totalprice") < P.POOR_SHEET, F.lit("")).otherwise(first)),
             F.when(F.col("o_orderkey") % 5 != 0, item("10", (F.year("o_orderdate") % 3).cast("string"))),
             item("17", F.col("o_orderkey").cast("string"))]
    content = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws(",", *items)).otherwise(F.concat_ws(",", *items[::-1]))
    return o.select(F.col("o_custkey").alias("user_id"), F.concat(F.lit("{"), content, F.lit("}")).alias("content"))


@query("questionnaire_best")
def q_questionnaire_best(spark, sf):
    """Distinct answer sheets of each user, the most complete ones (ties kept),
    re-keyed to customers."""
    top = QN.best_sheets(QN.sheets(answer_sheets(spark, sf), "user_id", "content"), "user_id")
    cust = table(spark, sf, "customer").select("c_custkey", "c_name")
    return top.join(cust, top["user_id"] == cust["c_custkey"]).select(
        "user_id", QN.shown(F.col("answers")).alias("answers"), "answered", "c_custkey", "c_name")


# ---------------------------------------------------------------- text / content

LETTERS = r"\p{L}"   # script class for the test data (no CJK in it)


@query("html_to_text")
def q_html_to_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", TX.html_to_text(F.col("html")).alias("text"))


@query("keep_script")
def q_keep_script(spark, sf):
    return table(spark, sf, "documents").select("doc_id", TX.keep_script(F.col("text"), "a-z").alias("kept"))


@query("decode_content")
def q_decode_content(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.base64(F.col("text")).alias("b64"))
    dec = TX.decode_base64(F.col("b64"))
    return d.select("doc_id", F.md5(dec).alias("digest"), F.length(dec).cast("bigint").alias("n"))


@query("tokenize_text")
def q_tokenize_text(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", TX.tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


def used_part_categories(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    l1 = p.select(TX.normalize_category(F.col("p_type")).alias("name"))
    l2 = p.where(F.col("p_size") <= 25).select(
        TX.normalize_category(F.concat_ws("_", "p_type", "p_brand")).alias("name"))
    return CT.taxonomy(l1.unionByName(l2))


@query("category_normalize")
def q_category_normalize(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat_ws("_", "p_type", "p_brand").alias("raw"))
    return CT.normalize_categories(p, "raw", used_part_categories(spark, sf)) \
        .select("p_partkey", "category", "category_id", "level")


def goods(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    path = F.when(F.col("p_size") >= 5, F.concat_ws("|", "p_type", "p_brand", "p_name")) \
        .otherwise(F.concat_ws("|", "p_type", "p_brand"))
    return p.select(F.col("p_partkey").alias("fid"), F.col("p_name").alias("ftitle"), path.alias("fcategory"))


def label_files(spark, sf, rows: DataFrame) -> DataFrame:
    """The dictionary of all levels, written as TSV files (the format the
    labelling side exchanges) and read back with the dictionary loader."""
    d = SH.level_dictionary(rows)
    path = scratch_path(spark, "dictionaries")
    SK.export_lines(d, F.concat_ws("\t", "name", F.col("count").cast("string"), F.col("id").cast("string")), path,
                    partition_by=["level"])
    return TF.load_label_dictionary(spark, path)


def labelled_goods(spark, sf) -> DataFrame:
    """Goods with their three-level paths and ``count-id`` labels, as a stored
    table; the goods are scanned once."""
    rows = freeze(CT.category_levels(goods(spark, sf), "fcategory"))
    path = scratch_path(spark, "labelled-goods")
    SH.attach_labels(rows, label_files(spark, sf, rows)).write.parquet(path)
    return spark.read.parquet(path)


@query("category_path")
def q_category_path(spark, sf):
    return labelled_goods(spark, sf).select("fid", "category_1", "label_1", "category_2", "label_2", "category_3", "label_3")


@query("label_dictionary")
def q_label_dictionary(spark, sf):
    """The dictionaries of the three levels, from the labelled table."""
    return SH.dictionary_of(labelled_goods(spark, sf))


@query("load_alias_map")
def q_load_alias_map(spark, sf):
    p = table(spark, sf, "part")
    path = scratch_path(spark, "alias")
    SK.export_lines(p.orderBy("p_partkey"), F.concat_ws("##", "p_type", "p_brand"), path)
    return TF.load_alias_map(spark, path)


TEST_DENY_DOMAINS = ["spam-farm.example.org", "www.cheap-pills.example.com"]
TEST_KNOWN_DOMAINS = [("thther.example.org", "news"), ("blog.ththan.example.net", "blog")]


def page_rows(spark, sf) -> DataFrame:
    pg = table(spark, sf, "pages")
    title = TX.keep_script(F.regexp_extract("html", "<title>(.*?)</title>", 1), LETTERS)
    return pg.select("page_id", "url", F.trim(title).alias("title"), "html").where(F.length("title") > 1)


def known_domains(spark) -> DataFrame:
    return spark.createDataFrame(C.KNOWN_DOMAIN_LABELS + TEST_KNOWN_DOMAINS, "domain string, label string")


def labelled_pages(spark, sf) -> DataFrame:
    return CT.page_domain_labels(page_rows(spark, sf), "url", "title", known_domains(spark),
                                 C.COMMERCE_DOMAINS + C.USELESS_DOMAINS + TEST_DENY_DOMAINS, C.USELESS_TITLES)


@query("url_domain_label")
def q_url_domain_label(spark, sf):
    d = labelled_pages(spark, sf)
    content = TX.tokens(TX.keep_script(TX.html_to_text(F.col("html")), LETTERS))
    return d.select("page_id", "domain", "label", TX.tokenize(F.col("title")).alias("title_tokens"),
                    F.size(content).cast("bigint").alias("n_content_tokens"))


@query("notice_extract")
def q_notice_extract(spark, sf):
    c = table(spark, sf, "conversations").withColumn(
        "misc_map", F.create_map(F.lit("role"), F.col("role"), F.lit("turn"), F.col("turn").cast("string")))
    return (c.where(F.trim(F.col("misc_map")["role"]).isin("user") & F.col("misc_map")["turn"].isNotNull())
            .where(F.length(F.trim("text")) > 20).select("conv_id", "turn", "text"))


@query("notice_group")
def q_notice_group(spark, sf):
    return CT.text_groups(table(spark, sf, "documents"), ["lang", "text"], "doc_id")


def article_rows(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents")
    title = F.trim(F.split_part(F.col("text"), F.lit("\n"), F.lit(1)))
    return (d.select("doc_id", title.alias("title"), F.trim("text").alias("content"), "source")
            .where((F.length("title") > 1) & (F.length("content") > 1)))


@query("article_labels")
def q_article_labels(spark, sf):
    a = article_rows(spark, sf)
    used = CT.taxonomy(a.select(TX.normalize_category(F.col("source")).alias("name")))
    code = (F.substring("source", 4, 10)).try_cast("int")
    out = CT.normalize_categories(a, "source", used)
    return out.select("doc_id", "category", "category_id", "level", CT.source_name(code).alias("source_name"),
                      TX.tokenize(TX.keep_script(F.col("title"), LETTERS)).alias("title_tokens"),
                      F.size(TX.tokens(F.col("content"))).cast("bigint").alias("n_content_tokens"))


@query("parse_scored_lines")
def q_parse_scored_lines(spark, sf):
    j = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    p1 = F.when(F.col("quality") == 1, F.lit("0.75")).otherwise(F.lit("0.25"))
    p2 = F.when(F.col("toxic") == 1, F.lit("0.8")).otherwise(F.lit("0.4"))
    full = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("|__label__"), F.col("lang"), F.lit(","), p1,
                    F.lit("|__label__"), F.col("lang"), F.lit("-"), F.col("source"), F.lit(","), p2)
    short = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit("|__label__"), F.col("lang"), F.lit(","), p1)
    line = F.when(F.col("n_chars") < 100, short).otherwise(full)
    path = scratch_path(spark, "scored")
    SK.export_lines(j, line, path)
    return TF.parse_scored_lines(spark, path)


def scored_files(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Result lines ``id|text|__label__<number>`` of three levels as the scoring
    side writes them, and the dictionary of their numbers.  Some lines are bad:
    a text with the separator, no prediction, no text, a number nobody knows."""
    dictionary = SH.dictionary_of(labelled_goods(spark, sf))
    p = table(spark, sf, "part")
    number = lambda k: (F.col("p_partkey") * (2 * k + 1)) % (5 * k * k)
    pred = lambda k: F.when((F.col("p_partkey") + k) % 31 == 0, F.lit("")).otherwise(
        F.concat(F.lit(SH.PREFIX), F.when((F.col("p_partkey") + k) % 37 == 0, F.lit("99999")).otherwise(number(k).cast("string"))))
    text = F.when(F.col("p_partkey") % 23 == 0, F.replace("p_name", F.lit(" "), F.lit("|"))).when(
        F.col("p_partkey") % 29 == 0, F.lit("")).otherwise(F.col("p_name"))
    rows = p.select(F.md5(F.col("p_partkey").cast("string")).alias("id"), text.alias("text"),
                    F.inline(F.array(*[F.struct(F.lit(k).alias("level"), pred(k).alias("pred")) for k in SH.LEVELS])))
    path = scratch_path(spark, "scored-files")
    SK.export_lines(rows, F.concat_ws("|", "id", "text", "pred"), path, partition_by=["level"])
    return SH.result_lines(spark.read.text(path)), dictionary


@query("multi_level_results")
def q_multi_level_results(spark, sf):
    parsed, dictionary = scored_files(spark, sf)
    return SH.result_sets(parsed, dictionary)


@query("result_line_counts")
def q_result_line_counts(spark, sf):
    """Lines read and rejected for each level's result file."""
    return SH.line_counts(scored_files(spark, sf)[0])


def _hexfrac(h, start, n):
    return F.round(F.conv(F.substring(h, start, n), 16, 10).cast("double") / 255.0, 4)


def doc_predictions(spark, sf) -> DataFrame:
    """Two-level predictions per document, derived from md5 digits of the id."""
    d = table(spark, sf, "documents").where(F.col("n_chars") > 100)
    h = F.md5(F.col("doc_id").cast("string"))
    n1 = F.concat(F.lit("c"), F.substring(h, 1, 1))
    id1 = F.conv(F.substring(h, 1, 1), 16, 10)
    l2 = F.concat(F.lit("c"), F.substring(h, 3, 1), F.lit("-d"), F.substring(h, 4, 1), F.lit("_"),
                  F.conv(F.substring(h, 4, 1), 16, 10))
    return d.select("doc_id", F.concat_ws("_", n1, id1).alias("label_1"), _hexfrac(h, 2, 2).alias("prob_1"),
                    l2.alias("label_2"), _hexfrac(h, 5, 2).alias("prob_2"))


def hex_taxonomy(spark) -> DataFrame:
    names = spark.range(16).select(F.concat(F.lit("c"), F.lower(F.hex("id"))).alias("name"))
    return CT.taxonomy(names)


@query("hier_reconcile")
def q_hier_reconcile(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("known_label"))
    j = docs.join(doc_predictions(spark, sf), "doc_id", "left")
    return CT.reconcile_levels(j, hex_taxonomy(spark)).select(
        "doc_id", "label_1", "prob_1", "label_2", "prob_2", "known_label")


@query("hier_reconcile_refined")
def q_hier_reconcile_refined(spark, sf):
    """Refined variant applied to the raw result lines: rows whose two levels
    conflict while both probabilities are <= 0.5 are dropped."""
    return CT.reconcile_levels(doc_predictions(spark, sf), hex_taxonomy(spark), drop_weak=True).select(
        "doc_id", "label_1", "prob_1", "label_2", "prob_2")


def page_predictions(spark, sf) -> DataFrame:
    pg = table(spark, sf, "pages").where(F.length("html") > 5000)
    h = F.md5(F.col("page_id").cast("string"))
    return pg.select("page_id",
                     F.concat_ws("_", F.concat(F.lit("c"), F.substring(h, 1, 1)), F.conv(F.substring(h, 1, 1), 16, 10))
                     .alias("label_1"), _hexfrac(h, 2, 2).alias("prob_1"),
                     F.concat(F.lit("c"), F.substring(h, 3, 1), F.lit("-d"), F.substring(h, 4, 1)).alias("label_2"),
                     _hexfrac(h, 5, 2).alias("prob_2"))


@query("manual_override")
def q_manual_override(spark, sf):
    pages = labelled_pages(spark, sf).select("page_id", "label")
    used = CT.taxonomy(known_domains(spark).select(F.col("label").alias("name")))
    j = pages.join(page_predictions(spark, sf), "page_id", "left")
    return CT.manual_override(j, "label", used).select("page_id", "label_1", "prob_1", "label_2", "prob_2",
                                                       "label_source")


@query("url_to_user")
def q_url_to_user(spark, sf):
    ev = table(spark, sf, "events").select("user_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("page_id"))
    pg = table(spark, sf, "pages").select("page_id", F.md5("url").alias("url_md5"), TX.url_host(F.col("url")).alias("domain"))
    url_user = ev.join(pg.select("page_id", "url_md5"), "page_id").select("url_md5", "user_id").distinct()
    return pg.join(url_user, "url_md5").select("user_id", "page_id", "domain")


# ---------------------------------------------------------------- sampling


@query("badcase_sample")
def q_badcase_sample(spark, sf):
    pred = doc_predictions(spark, sf).where(F.col("prob_1") < 0.5)
    s = SM.per_group_sample(pred, "label_1", F.md5(F.col("doc_id").cast("string")), P.BADCASE_PER_LABEL)
    meta = article_rows(spark, sf).select("doc_id", "title")
    return s.join(meta, "doc_id").select("doc_id", "label_1", "prob_1", "title")


@query("hash_split")
def q_hash_split(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return d.select("doc_id", SM.hash_split(F.col("doc_id"), P.SPLIT_HEX).alias("split"))


@query("balance_classes")
def q_balance_classes(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("label"))
    return SM.balance_classes(lab, "doc_id", "label")


@query("downsample_negatives")
def q_downsample_negatives(spark, sf):
    """A fraction of the negatives, all positives."""
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("label"))
    return SM.downsample(lab, "doc_id", "label", {0: P.NEGATIVE_FRACTION, 1: 1.0})


@query("min_support_classes")
def q_min_support_classes(spark, sf):
    d = table(spark, sf, "documents")
    return SM.min_support(d, "lang", P.MIN_SUPPORT)


# ---------------------------------------------------------------- sinks
@query("export_infer_lines")
def q_export_infer_lines(spark, sf):
    a = article_rows(spark, sf)
    line = F.concat_ws("##yf##", F.col("doc_id").cast("string"), TX.tokenize(TX.keep_script(F.col("title"), LETTERS)))
    path = scratch_path(spark, "infer")
    SK.export_lines(a, line, path)
    return spark.read.text(path)


@query("export_train_lines")
def q_export_train_lines(spark, sf):
    path = scratch_path(spark, "train")
    lines = SH.train_lines(labelled_goods(spark, sf), "ftitle", P.TRAIN_MIN_SUPPORT)
    SK.export_lines(lines, F.col("line"), path, partition_by=["level"])
    return spark.read.text(path).select(F.col("level").cast("bigint").alias("level"), "value")


def content_training_rows(spark, sf) -> DataFrame:
    """Labelled articles by day: the language is a level 1 category, language and
    source one of level 2; article n was written n % 900 days before the job date."""
    a = article_rows(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    raw = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(F.concat_ws("_", "lang", "source"))
    a = a.withColumn("raw", raw)
    used = CT.taxonomy(a.select(TX.normalize_category(F.col("raw")).alias("name")))
    day = F.date_sub(F.lit(P.as_of()), (F.col("doc_id") % 900).cast("int"))
    return CT.normalize_categories(a, "raw", used).select(
        F.col("doc_id").alias("fid"), TX.tokenize(F.col("title")).alias("ftitle"), TX.tokenize(F.col("content")).alias("fcontent"),
        F.col("category").alias("fcategory"), F.col("category_id").alias("fcategory_id"), "level", F.col("source").alias("fsource"),
        D.stat_date(day).alias("stat_date"))


@query("content_train_lines")
def q_content_train_lines(spark, sf):
    """``__label__<category>_<id>, <text>`` lines of one source in an 18-month
    window, in one folder for each field (title, content) and level."""
    since = int(D.offset_date_py(P.as_of(), P.TRAIN_MONTHS, 0).strftime("%Y%m%d"))
    rows = content_training_rows(spark, sf).where((F.col("stat_date") >= since) & (F.col("fsource") == P.TRAIN_SOURCE))
    path = scratch_path(spark, "content-train")
    SK.export_lines(CT.training_lines(rows), F.col("line"), path, partition_by=["field", "level"])
    return spark.read.text(path).select("field", F.col("level").cast("bigint").alias("level"), "value")


@query("partition_overwrite")
def q_partition_overwrite(spark, sf):
    ev = table(spark, sf, "events").withColumn("stat_date", D.stat_date(F.col("ts")))
    path = scratch_path(spark, "daily_counts")
    all_days = ev.groupBy("stat_date", "event_type").agg(F.count(F.lit(1)).alias("n"))
    SK.overwrite_partitions(all_days, path)
    day = int(P.as_of().strftime("%Y%m%d"))
    redo = (ev.where((F.col("stat_date") == day) & (F.col("event_type") == "click"))
            .groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))
    SK.overwrite_partition(redo, path, day)
    return spark.read.parquet(path).select(F.col("stat_date").cast("bigint").alias("stat_date"), "event_type", "n")


@query("hive_text_table")
def q_hive_text_table(spark, sf):
    """Predictions as a text table (``\\x01`` between fields, ``\\N`` for null) in
    files of a wanted size, one dated partition and a folder per marriage state,
    read back."""
    merged = q_consistency_merge(spark, sf).withColumn("child_stage", F.expr("nullif(child_stage, 'null')"))
    path = scratch_path(spark, "text-table")
    SK.write_delimited(merged.select("user_id", "parent", "child_stage", "marriage"), path, int(P.as_of().strftime("%Y%m%d")),
                       partition_by=["marriage"], target_bytes=P.FILE_BYTES)
    back = SK.read_delimited(spark, path, ["user_id", "parent", "child_stage"])
    return back.select(F.col("user_id").cast("bigint").alias("user_id"), "parent", "child_stage", "marriage",
                       F.col("stat_date").cast("bigint").alias("stat_date"))


@query("guarded_write")
def q_guarded_write(spark, sf):
    path = scratch_path(spark, "guarded")
    df = segment_labels(spark, sf)
    if SK.guarded_write(df, path, None, P.GUARD_MIN_ROWS):
        return spark.read.parquet(path)
    return spark.createDataFrame([], df.schema)


# ---------------------------------------------------------------- evaluation


def doc_scores(spark, sf) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", (F.col("n_chars").cast("double") / 1000.0).alias("score"))
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id")


@query("eval_auc")
def q_eval_auc(spark, sf):
    return EV.auc(doc_scores(spark, sf), threshold=2.0)


@query("best_threshold")
def q_best_threshold(spark, sf):
    return EV.best_threshold(doc_scores(spark, sf))


def lang_rule(text):
    return (F.when(text.like("% the %"), "en").when(text.like("% le %") | text.like("% la %"), "fr")
            .when(text.like("% der %") | text.like("% die %"), "de").otherwise("es"))


@query("eval_confusion")
def q_eval_confusion(spark, sf):
    """Validation predictions are stored per date (id, prediction, label) and
    the metrics are computed from the stored partition."""
    d = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"),
                                             lang_rule(F.col("text")).alias("prediction"))
    path = scratch_path(spark, "validation")
    day = int(P.as_of().strftime("%Y%m%d"))
    SK.overwrite_partition(d, path, day)
    stored = TB.scan_partition(spark.read.parquet(path), P.as_of())
    return EV.confusion_metrics(stored)


# ---------------------------------------------------------------- vectors and models


@query("sparse_features")
def q_sparse_features(spark, sf):
    f = install_rows(spark, sf).select("user_id", "feature")
    idx = f.withColumn("idx", feat.sparse_indices(F.col("feature")))
    v = MD.sparse_from_indices(idx, "idx", P.TOP_K)
    nnz = F.size(F.filter(MD.vector_to_array(F.col("features")), lambda x: x != 0)).cast("bigint")
    return v.select("user_id", nnz.alias("nnz"), F.array_join("idx", " ").alias("indices"))


def embedding_rows(spark, sf) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", MD.dense_features(F.col("embedding")).alias("features"),
                    F.col("label").cast("double").alias("label"))


@query("lr_binary")
def q_lr_binary(spark, sf):
    rows = embedding_rows(spark, sf).withColumn("label", (F.col("label") < 5).cast("double"))
    train, valid = MD.split(rows, "vec_id")
    model = MD.train_lr(train)
    out = model.transform(valid)
    return out.select("vec_id", "label", "prediction", MD.positive_score(out).alias("score"))


@query("lr_tuned")
def q_lr_tuned(spark, sf):
    """Train, pick the F-measure-best threshold on the validation split, and
    report AUC (on 0/1 predictions) and accuracy at the default and best
    thresholds."""
    rows = embedding_rows(spark, sf).withColumn("label", (F.col("label") < 5).cast("double"))
    train, valid = MD.split(rows, "vec_id")
    model = MD.train_lr(train)
    out = model.transform(valid)
    scored = out.select(MD.positive_score(out).alias("score"), "label")
    best = EV.best_threshold(scored).first()["threshold"]
    return EV.threshold_report(scored, {"default": 0.5, "best": best})


@query("install_model_labels")
def q_install_model_labels(spark, sf):
    """Flagship flow end to end: install features -> sparse vectors, left join
    to known labels (unlabelled = predict set), train on the labelled part,
    tune the threshold on a hash hold-out, predict the rest, and publish known
    labels over predictions (known wins)."""
    f = install_rows(spark, sf).select("user_id", "feature")
    vec = MD.sparse_from_indices(f.withColumn("idx", feat.sparse_indices(F.col("feature"))), "idx", P.TOP_K)
    known = segment_labels(spark, sf).select("user_id", (F.col("label") == 0).cast("bigint").alias("label"))
    # read for training, tuning and prediction: computed once
    sets = freeze(L.train_predict_split(vec.select("user_id", "features"), known, "user_id"))
    labelled = sets.where(F.col("split") == "train").withColumn("label", F.col("label").cast("double"))
    train, valid = MD.split(labelled, "user_id")
    model = MD.train_lr(train)
    v = model.transform(valid)
    best = EV.best_threshold(v.select(MD.positive_score(v).alias("score"), "label")).first()["threshold"]
    todo = model.transform(sets.where(F.col("split") == "predict"))
    predicted = todo.select("user_id", (MD.positive_score(todo) >= best).cast("bigint").alias("label"),
                            F.lit("predicted").alias("origin"))
    return L.priority_union([known.withColumn("origin", F.lit("known")), predicted], "user_id", "label")


@query("lr_multiclass")
def q_lr_multiclass(spark, sf):
    train, valid = MD.split(embedding_rows(spark, sf), "vec_id")
    model = MD.train_lr(train, multinomial=True)
    out = model.transform(valid)
    pred, prob = MD.top1(out)
    return out.select("vec_id", "label", pred.alias("prediction"), prob.alias("prob"))


@query("svm_binary")
def q_svm_binary(spark, sf):
    rows = embedding_rows(spark, sf).withColumn("label", (F.col("label") < 5).cast("double"))
    train, valid = MD.split(rows, "vec_id")
    model = MD.train_svm(train)
    out = model.transform(valid)
    return out.select("vec_id", "label", "prediction", MD.vector_to_array(F.col("rawPrediction"))[1].alias("margin"))


LANGS = ["en", "fr", "de", "es"]
CHILDREN = [f"{lang}-{q}" for lang in LANGS for q in (0, 1)]      # child classes: language and quality


@query("text_classify")
def q_text_classify(spark, sf):
    """Two-level text classifier trained and applied in one job: level 1 = the
    language, level 2 = the quality within that language.  One model over the
    children; level 2 is chosen among the children of level 1 only.  The features
    are written once; texts, which are smaller, are spread by document before, so
    that hashing and training have many tasks."""
    tasks = spark.sparkContext.defaultParallelism
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text").repartition(tasks, "doc_id")
    docs = docs.select("doc_id", "lang", TX.tokens(F.col("text")).alias("tokens"))
    feats = freeze(MD.text_features(docs, "tokens", P.TEXT_BITS).select("doc_id", "lang", "features"))
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    child = F.array_position(F.lit(CHILDREN), F.concat_ws("-", "lang", F.col("quality").cast("string"))) - 1
    train = feats.join(lab, "doc_id").withColumn("label", child.cast("double")).where(F.col("label") >= 0)
    model = MD.train_lr(train, multinomial=True, max_iter=30, reg=0.01, block_mb=16)
    parent, prob_1, own, prob_2 = MD.top_down(F.col("_p"), [i // 2 for i in range(len(CHILDREN))])
    # a class without a training row has no score
    scores = F.slice(F.concat(MD.vector_to_array(F.col("probability")), F.array_repeat(F.lit(0.0), len(CHILDREN))), 1, len(CHILDREN))
    return model.transform(feats).select("doc_id", scores.alias("_p")).select(
        "doc_id", F.get(F.lit(LANGS), parent).alias("pred_1"), prob_1.alias("prob_1"),
        F.get(F.lit(CHILDREN), own).alias("pred_2"), prob_2.alias("prob_2"))


# the tags of the batch scoring: one binary target each
BATCH_TARGETS = [("gender", lambda c: c < 5), ("age", lambda c: c.isin(0, 2, 4, 6, 8)), ("marriage", lambda c: c >= 7),
                 ("parent", lambda c: c < 3), ("child", lambda c: c.isin(1, 4, 7)), ("career", lambda c: c.isin(0, 9)),
                 ("education", lambda c: c.isin(2, 3, 5)), ("estate", lambda c: c >= 4), ("car", lambda c: c.isin(6, 8)),
                 ("income", lambda c: c >= 8), ("consumption", lambda c: c.isin(1, 2, 3, 4, 5))]


def saved_models(spark, sf) -> dict:
    """One model per tag, trained on the same stored rows, saved and loaded."""
    from pyspark.ml.classification import LogisticRegressionModel
    train, _ = MD.split(embedding_rows(spark, sf), "vec_id")
    train = freeze(train)
    base, out = scratch_path(spark, "models"), {}
    for tag, cond in BATCH_TARGETS:
        model = MD.train_lr(train.withColumn("label", cond(F.col("label")).cast("double")), max_iter=20, stored=True)
        MD.save_model(model, f"{base}/{tag}")
        out[tag] = MD.load_model(f"{base}/{tag}", LogisticRegressionModel)
    return out


@query("batch_score")
def q_batch_score(spark, sf):
    """Train one model per tag, save each, load them back and score the feature
    table with all of them in one scan: long output (id, tag, value)."""
    feats = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    if feats.isEmpty():
        return spark.createDataFrame([], "vec_id bigint, tag string, value double")
    return MD.score_all(feats, "vec_id", "v", MD.stacked(spark, saved_models(spark, sf)))


def _wrong(df: DataFrame, name: str, bad) -> DataFrame:
    return df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("scored"),
                  F.coalesce(F.count_if(F.coalesce(bad, F.lit(True))), F.lit(0)).alias("wrong"))


@query("model_score_check")
def q_model_score_check(spark, sf):
    """For each linear model the number of validation rows, and of those whose
    score differs from one recomputed from the model's weights alone; for the
    tags against each saved model's own transform; for the text classifier, whose
    second level is no child of the first or whose scores are out of order."""
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = freeze(embedding_rows(spark, sf))
    binary = rows.withColumn("label", (F.col("label") < 5).cast("double"))
    near = lambda a, b: F.abs(a - b) > 1e-9
    array = lambda m: F.lit([float(x) for x in m])
    out = []
    train, valid = MD.split(binary, "vec_id")
    lr, svm = MD.train_lr(train), MD.train_svm(train)
    scored = lr.transform(valid)
    margin = MD.dot(F.col("v"), array(lr.coefficients.toArray())) + lr.intercept
    out.append(_wrong(scored.select("vec_id", MD.positive_score(scored).alias("s")).join(vectors, "vec_id"), "lr_binary",
                      near(F.col("s"), 1 / (1 + F.exp(-margin)))))
    margin = MD.dot(F.col("v"), array(svm.coefficients.toArray())) + svm.intercept
    out.append(_wrong(svm.transform(valid).select("vec_id", MD.vector_to_array(F.col("rawPrediction"))[1].alias("s"), "prediction")
                      .join(vectors, "vec_id"), "svm_binary",
                      near(F.col("s"), margin) | ((margin > 0) != (F.col("prediction") == 1))))
    train, valid = MD.split(rows, "vec_id")
    many = MD.train_lr(train, multinomial=True)
    matrix = [(array(w), float(b)) for w, b in zip(many.coefficientMatrix.toArray(), many.interceptVector.toArray(), strict=True)]
    raw = F.array(*[MD.dot(F.col("v"), w) + b for w, b in matrix])
    s = many.transform(valid).select("vec_id", "prediction", MD.vector_to_array(F.col("probability")).alias("p")).join(vectors, "vec_id")
    s = s.withColumn("raw", raw).withColumn("e", F.transform("raw", lambda x: F.exp(x - F.array_max("raw"))))
    total = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    off = F.exists(F.zip_with("p", "e", lambda p, e: F.abs(p - e / total) > 1e-9), lambda x: x)
    out.append(_wrong(s, "lr_multiclass", off | (F.array_position("raw", F.array_max("raw")) - 1 != F.col("prediction"))))
    models = saved_models(spark, sf)
    own = None
    for tag, m in models.items():
        t = m.transform(rows)
        t = t.select("vec_id", F.lit(tag).alias("tag"), MD.positive_score(t).alias("s"))
        own = t if own is None else own.unionByName(t)
    tags = MD.score_all(vectors, "vec_id", "v", MD.stacked(spark, models))
    out.append(_wrong(own.join(tags, ["vec_id", "tag"], "left"), "batch_score", near(F.col("s"), F.col("value"))))
    text = q_text_classify(spark, sf)
    out.append(_wrong(text, "text_classify", ~F.startswith("pred_2", F.concat("pred_1", F.lit("-"))) | (F.col("prob_2") > F.col("prob_1") + 1e-9)
                      | (F.col("prob_1") > 1 + 1e-9) | (F.col("prob_1") < 0.25 - 1e-9)))
    result = out[0]
    for df in out[1:]:
        result = result.unionByName(df)
    return result


def ctr_model(spark, sf):
    """Weights over the one-month window of CTR rows (the training window the
    model job reads), learnt on the long form: (weights, vocabulary, long form)."""
    vocab, long = LF.examples(q_ctr_month_rows(spark, sf))
    return LF.train(long.where(F.col("split") == "train"), vocab), vocab, long


def ctr_weight_lines(spark, sf) -> DataFrame:
    """Weights of all features but the day's, which means nothing to a later day."""
    weights, vocab, _ = ctr_model(spark, sf)
    return LF.weight_lines(weights, vocab, skip_prefix="date")


@query("ctr_weights")
def q_ctr_weights(spark, sf):
    return ctr_weight_lines(spark, sf)


@query("ctr_threshold")
def q_ctr_threshold(spark, sf):
    """Best threshold on the validation rows; scores to nine decimals."""
    weights, _, long = ctr_model(spark, sf)
    m = LF.margins(long.where(F.col("split") == "valid"), weights)
    return EV.best_threshold(m.select(F.round(LF.probability(F.col("margin")), 9).alias("score"), "label"))


@query("publish_marker")
def q_publish_marker(spark, sf):
    base = scratch_path(spark, "ctr")
    SK.export_lines(ctr_weight_lines(spark, sf), F.col("line"), f"{base}/weights")
    day = int(P.as_of().strftime("%Y%m%d"))
    SK.write_marker(spark, f"{base}/ready", day)
    marker = spark.read.text(f"{base}/ready").select(F.col("value").alias("marker"))
    n = spark.read.text(f"{base}/weights").select(F.count(F.lit(1)))
    return marker.select("marker", n.scalar().alias("rows"))
