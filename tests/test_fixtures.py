"""Edge cases of the reference behaviour (hand-made rows)."""

import datetime as dt

from pyspark.sql import functions as F

from portrait import config as C
from portrait.functions import dates as D
from portrait.functions import text as TX
from portrait.operators import ads as AD
from portrait.operators import content as CT
from portrait.operators import features as FE
from portrait.operators import labels as L
from portrait.operators import profiles as PR
from portrait.session import scratch_path
from portrait.sources import textfiles as TF


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_lenient_month_offset(spark):
    r = one(spark, F.date_format(D.offset_date(D.parse_yyyymmdd(F.col("s")), -1, 0), "yyyyMMdd"), "20190331")
    assert r == "20190303"
    assert D.offset_date_py(dt.date(2019, 3, 31), -1, 0) == dt.date(2019, 3, 3)
    assert D.offset_date_py(dt.date(2024, 1, 16), 0, -1) == dt.date(2024, 1, 15)


def _log(spark, rows):
    return spark.createDataFrame(rows, "imei string, unit_id string, location string, posttime string, oper_type string")


def test_click_label_weekday_badtime_anyclick(spark):
    log = _log(spark, [
        ("u", "x", "l", "2018-12-02T10:00:00", AD.IMP),
        ("u", "x", "l", "2018-12-02T10:00:00", AD.CLK),
        ("u", "x", "l", "2018-12-02T10:00:00", AD.CLK),   # duplicate
        ("v", "y", "l", "2018-12-02", AD.CLK),             # bad length -> dropped
        ("__IMEI__", "y", "l", "2018-12-02T10:00:00", AD.CLK),
    ])
    out = AD.click_labels(log).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.imei, r.week, r.hour, r.date, r.label) == ("u", 7, 10, "1202", 1)


def test_topk_tie_goes_to_larger_id(spark):
    cat = spark.createDataFrame([("a", "A", 5), ("b", "B", 5), ("c", "C", 1)],
                                "app_id string, app_name string, install_num long")
    r = FE.topk_catalog(cat, 1).collect()
    assert [(x.app_id, x.idx) for x in r] == [("b", 0)]


def test_install_features_duplicates_unknown_and_prefix(spark):
    raw = spark.createDataFrame([("u1", "1:2 1:3 9:1"), ("u2", "7:1"), ("u3", None)], "imei string, value string")
    pairs = FE.parse_install_list(raw, "imei", "value")
    vocab = spark.createDataFrame([("1", "one", 0), ("9", "nine", 1)], "app_id string, app_name string, idx long")
    f = {r.imei: r for r in FE.install_features(raw, vocab, user="imei").collect()}
    assert set(f) == {"u1"}
    assert f["u1"].feature == "0:1 1:1" and f["u1"].apps == "one nine" and f["u1"].n_apps == 2
    st = FE.install_stats(pairs, vocab, user="imei").first()
    assert (st.users_total, st.users_empty, st.users_kept, st.min_len, st.max_len) == (2, 1, 1, 2, 2)
    prefixed = spark.createDataFrame([("u1", "119:2 9:3 111:1"), ("u2", "1:1"), (None, "111:1"), ("u4", "")], "imei string, value string")
    f = FE.install_features(prefixed, vocab, user="imei", prefix="11").collect()
    assert [tuple(r) for r in f] == [("u1", "0:1 1:1", "one nine", 2)]
    assert FE.install_features(raw, vocab.limit(0), user="imei").count() == 0


def test_sparse_indices_drop_malformed(spark):
    assert one(spark, FE.sparse_indices(F.col("s")), "3:1 x 7:1 3:1") == [3, 7]


def test_answers_at_group_max_keep_ties(spark):
    df = spark.createDataFrame([("f", "a", 5), ("f", "b", 5), ("f", "c", 3)], "k string, v string, n long")
    out = sorted(r.v for r in L.rows_at_group_max(df, "k", "n").collect())
    assert out == ["a", "b"]


def test_parent_answers(spark):
    df = spark.createDataFrame([("1", "A"), ("2", "F"), ("3", "G"), ("4", "H"), ("5", "AB")], "id string, q7 string")
    m = spark.createDataFrame(C.PARENT_ANSWERS, "key string, code int")
    single = df.where(L.single_choice(F.col("q7")))
    out = {r.id: r.label for r in L.map_labels(single, "q7", m, drop_codes=(), shift=0).collect()}
    assert out == {"1": 1, "2": 1, "4": 0}


def test_consistency_rules(spark):
    m = spark.createDataFrame([("a", "unmarried"), ("b", "married")], "user_id string, marriage string")
    p = spark.createDataFrame([("a", "parent"), ("b", "non_parent")], "user_id string, parent string")
    c = spark.createDataFrame([("a", "baby"), ("b", "teen")], "user_id string, child_stage string")
    out = {r.user_id: (r.marriage, r.parent, r.child_stage) for r in L.consistency_merge(m, p, c).collect()}
    assert out == {"a": ("unmarried", "non_parent", "null"), "b": ("married", "non_parent", "null")}


def test_occupation_overrides(spark):
    s = "user_id string"
    pred = spark.createDataFrame([("u1", 3), ("u2", 0), ("u3", 5)], "user_id string, occupation long")
    silent = spark.createDataFrame([("u1",)], s)
    student = spark.createDataFrame([], s)
    it = spark.createDataFrame([("u1",)], s)
    age = spark.createDataFrame([("u1", 2), ("u2", 3), ("u3", 1)], "user_id string, age long")
    out = {r.user_id: r.occupation for r in L.occupation_overrides(pred, silent, student, it, age).collect()}
    assert out == {"u1": 8, "u2": 10, "u3": 0}


def _recon(spark, rows, drop=False):
    df = spark.createDataFrame(rows, "id string, label_1 string, prob_1 double, label_2 string, prob_2 double")
    used = spark.createDataFrame([("a", 1), ("c", 7)], "name string, category_id long")
    return {r.id: (r.label_1, r.prob_1, r.label_2, r.prob_2) for r in CT.reconcile_levels(df, used, drop).collect()}


def test_hierarchy_reconciliation(spark):
    out = _recon(spark, [("keep", "a_1", 0.6, "a-b_2", 0.5), ("lift", "a_1", 0.4, "c-d_9", 0.8),
                         ("fall", "a_1", 0.6, "c-d_9", 0.5), ("none", None, None, None, None)])
    assert out["keep"] == ("a_1", 0.6, "a-b_2", 0.5)
    assert out["lift"] == ("c_7", 1.5, "c-d_9", 0.8)
    assert out["fall"] == ("a_1", 0.6, "a-其它_1", 1.5)
    assert out["none"] == (None, None, None, None)
    dropped = _recon(spark, [("weak", "a_1", 0.5, "c-d_9", 0.5), ("ok", "a_1", 0.6, "a-b_2", 0.5)], drop=True)
    assert set(dropped) == {"ok"}


def test_manual_label_wins(spark):
    df = spark.createDataFrame([("p1", "科技", "x_1", 0.3, "x-y", 0.2), ("p2", "unk", "x_1", 0.3, "x-y", 0.2)],
                               "id string, label string, label_1 string, prob_1 double, label_2 string, prob_2 double")
    used = spark.createDataFrame([("科技", 4)], "name string, category_id long")
    out = {r.id: (r.label_1, r.prob_1, r.label_2, r.label_source) for r in CT.manual_override(df, "label", used).collect()}
    assert out == {"p1": ("科技_4", 1.5, "null", "Manual"), "p2": ("x_1", 0.3, "x-y", "Pred")}


def test_cjk_filter_and_category(spark):
    assert one(spark, TX.keep_script(F.col("s")), "ab你好 c12世") == " 你好 世"
    df = spark.createDataFrame([("体育_英超",)], "raw string")
    aliases = spark.createDataFrame([("体育,英超", "体育,国际足球")], "alias string, canonical string")
    used = spark.createDataFrame([("体育,国际足球", 3)], "name string, category_id long")
    r = CT.normalize_categories(df, "raw", used, aliases).first()
    assert (r.category, r.category_id, r.level) == ("体育-国际足球", 3, 2)


def test_url_host(spark):
    assert one(spark, TX.url_host(F.col("s")), "http://m.jd.com/a") == "m.jd.com"
    assert one(spark, TX.url_host(F.col("s")), "http://x") == ""
    assert one(spark, TX.url_host(F.col("s")), "http://m.jd.com/") == ""


def test_decay_and_format(spark):
    daily = spark.createDataFrame([("u", "p@l", 2, 20240131)], "imei string, labels string, times long, stat_date long")
    r = PR.decayed_profile(daily, dt.date(2024, 1, 31), dt.date(2023, 12, 31)).first()
    assert r.labels == "p@l:2.066"


def test_rating(spark):
    acts = spark.createDataFrame([("u", "i", "content_share", 2.0), ("u", "i", "content_like", 1.0)],
                                 "imei string, item_id string, action string, frequency double")
    assert PR.item_rating(acts, PR.score_map(spark)).first().rating == 13.0


def test_anti_join_keeps_duplicates(spark):
    a = spark.createDataFrame([("u",), ("u",), ("v",)], "user_id string")
    b = spark.createDataFrame([("v",)], "user_id string")
    assert sorted(r.user_id for r in L.anti_keep_duplicates(a, b, "user_id").collect()) == ["u", "u"]


def test_alias_file_last_wins(spark):
    path = scratch_path(spark, "alias-test")
    spark.createDataFrame([("k##a",), ("K##b",), ("z##q",), ("junk",)], "value string").coalesce(1).write.text(path)
    out = {r.alias: r.canonical for r in TF.load_alias_map(spark, path).collect()}
    assert out == {"k": "b", "z": "q"}


def test_scored_lines(spark):
    path = scratch_path(spark, "scored-test")
    lines = ["id1|__label__a_1,0.9|__label__a-b_2,0.8", "id2|x", "id3|__label__a_1,-1.0|__label__a-b_2,0.8",
             "id1|__label__a_1,0.9|__label__a-b_2,0.8"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    out = TF.parse_scored_lines(spark, path).collect()
    assert [(r.id, r.label_1, r.prob_1, r.label_2, r.prob_2) for r in out] == [("id1", "a_1", 0.9, "a-b_2", 0.8)]


def test_label_dictionary_three_fields_only(spark):
    path = scratch_path(spark, "dict-test")
    spark.createDataFrame([("a\t10\t0",), ("b\t5",), ("c\tx\t2",)], "value string").write.text(path)
    out = [(r["name"], r["count"], r["id"]) for r in TF.load_label_dictionary(spark, path).collect()]
    assert out == [("a", 10, 0)]


def test_html_to_text(spark):
    html = "<p>Hi<script>x</script> there</p><b>you</b>---  ok"
    assert one(spark, TX.html_to_text(F.col("s")), html) == " Hi there\nyou ok"


def test_downsample_negatives_by_hash(spark):
    from portrait.operators import sampling as SM
    df = spark.range(0, 4000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("label"))
    out = SM.downsample(df, "doc_id", "label", {0: 0.1, 1: 1.0})
    n0 = out.where("label = 0").count()
    assert out.where("label = 1").count() == 1000
    assert 200 < n0 < 400
    # deterministic: same rows on a re-run
    assert out.exceptAll(SM.downsample(df, "doc_id", "label", {0: 0.1, 1: 1.0})).count() == 0


def test_hourly_click_labels(spark):
    log = _log(spark, [("u", "x", "l", "2018-12-02T10:05:00", AD.IMP), ("u", "x", "l", "2018-12-02T10:55:00", AD.CLK)])
    r = AD.click_labels(log, hourly=True).collect()
    assert [(x.time, x.label) for x in r] == [("2018-12-02T10", 1)]


def test_latest_partition_from_metadata(spark):
    import io, contextlib
    from portrait.sources.tables import latest_partition_of_table
    p = scratch_path(spark, "latest-tbl")
    spark.range(30).select((F.lit(20240101) + F.col("id") % 3).cast("bigint").alias("stat_date"), "id") \
        .write.partitionBy("stat_date").parquet(p)
    spark.sql(f"CREATE TABLE latest_t (id bigint, stat_date bigint) USING parquet PARTITIONED BY (stat_date) "
              f"LOCATION '{p}'")
    spark.sql("ALTER TABLE latest_t RECOVER PARTITIONS")
    try:
        df = latest_partition_of_table(spark, "latest_t")
        assert {r.stat_date for r in df.collect()} == {20240103} and df.count() == 10
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "PartitionFilters: [isnotnull(stat_date" in buf.getvalue()
    finally:
        spark.sql("DROP TABLE latest_t")


def test_delimited_text_sink_round_trip(spark):
    from portrait.sources import sinks as SK
    df = spark.createDataFrame([("u1", "married", None), ("u2", "unmarried", "null")],
                               "imei string, marriage string, child_stage string")
    path = scratch_path(spark, "textsink")
    SK.write_delimited(df, path, 20240116)
    back = SK.read_delimited(spark, path, ["imei", "marriage", "child_stage"])
    got = sorted((r.imei, r.marriage, r.child_stage, r.stat_date) for r in back.collect())
    assert got == [("u1", "married", None, 20240116), ("u2", "unmarried", "null", 20240116)]


def test_label_daily_unions_sources(spark):
    schema = "imei string, pred string, label string, stat_date long"
    a = spark.createDataFrame([("u", "p", "x", 1), ("u", "p", "x", 1)], schema)
    b = spark.createDataFrame([("u", "p", "x", 1), ("v", "q", "y", 2)], schema)
    c = spark.createDataFrame([("u", "p", "x", 2), (None, "q", "y", 2)], schema)
    out = {(r.imei, r.labels, r.stat_date): r.times for r in PR.label_daily([a, b, c]).collect()}
    assert out == {("u", "p@x", 1): 3, ("v", "q@y", 2): 1, ("u", "p@x", 2): 1}


def test_java_split_semantics(spark):
    cases = {"a/b//": ["a", "b"], "///": [], "": [""], "a": ["a"], "/a": ["", "a"], "http://x/": ["http:", "", "x"]}
    for s, want in cases.items():
        assert one(spark, TX.java_split(F.col("s"), "/"), s) == want, s


def test_char_ngrams_for_unsegmented_script(spark):
    assert one(spark, TX.char_ngrams(F.col("s"), 2), "你好世界") == ["你好", "好世", "世界"]
    assert one(spark, TX.char_ngrams(F.col("s"), 2), "你") == ["你"]


def test_click_history_by_day_brute_force(spark):
    import datetime as dt
    days = [dt.date(2019, 2, 1) + dt.timedelta(days=i) for i in range(70)]
    clicks = [("u", f"x{i % 7}", d) for i, d in enumerate(days) if i % 3 == 0]
    df = spark.createDataFrame(clicks, "imei string, unit_id string, click_day date")
    jobs = [days[0] + dt.timedelta(days=i) for i in range(100)]
    asked = spark.createDataFrame([("u", j) for j in jobs for _ in range(2)], "imei string, job_day date")
    intervals = AD.click_intervals(df, "click_day")
    got = {(r.imei, r.job_day): r.history_click_1m for r in AD.history_on_days(asked, intervals).collect()}
    want = {}
    for job in jobs:
        lo, hi = D.offset_date_py(job, -1, 0), job - dt.timedelta(days=1)
        units = sorted({u for _, u, c in clicks if lo <= c < hi})
        if units:
            want[("u", job)] = " ".join(units)
    assert got == want
    assert D.offset_date_py(dt.date(2019, 3, 31), -1, 0) == dt.date(2019, 3, 3)
