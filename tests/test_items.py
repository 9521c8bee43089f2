"""Questionnaire sheets, packed lists, label maps, text tables by size, stacked
models and two-level decisions on hand-made rows."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from portrait.operators import labels as L
from portrait.operators import models as MD
from portrait.operators import questionnaire as QN
from portrait.session import scratch_path
from portrait.sources import sinks as SK


def test_sheets_are_distinct_whatever_the_order_of_their_keys(spark):
    rows = [("u", '{"0":"A","1":"B","99":"x"}'), ("u", '{"1":"B","0":"A"}'), ("u", '{"0":"A","1":""}'), ("u", '{"0":"A","2":"C"}'),
            ("v", '{"0":"A"}'), ("v", '{"0":"A","1":null}'), ("v", '{"0":"A","1":""}'), ("w", "no json"), ("w", None),
            (None, '{"0":"A"}'), ("x", '{"0":"A","10":"B","2":"C"}')]
    sheets = QN.sheets(spark.createDataFrame(rows, "user string, content string"), "user", "content")
    got = {(r.user, r.s): r.answered for r in sheets.withColumn("s", QN.shown(F.col("answers"))).collect()}
    assert got == {("u", "0=A;1=B"): 2, ("u", "0=A;1="): 1, ("u", "0=A;2=C"): 2, ("v", "0=A"): 1, ("v", "0=A;1="): 1, ("w", ""): 0,
                   (None, "0=A"): 1, ("x", "0=A;10=B;2=C"): 3}
    best = QN.best_sheets(sheets, "user").withColumn("s", QN.shown(F.col("answers"))).collect()
    assert sorted((r.user, r.s) for r in best) == [("u", "0=A;1=B"), ("u", "0=A;2=C"), ("v", "0=A"), ("v", "0=A;1="), ("w", ""),
                                                   ("x", "0=A;10=B;2=C")]


def test_profile_labels(spark):
    rows = [(1, "occupation", " it "), (1, "occupation", "学生"), (2, "occupation", "x"), (1, "parent", "H"), (2, "parent", "F"),
            (3, "parent", "G"), (1, "child_stage", "D"), (1, "consumption", "A"), (2, "consumption", "AB"), (3, "consumption", ""),
            (4, "consumption", None), (1, "sex", "male"), (2, "sex", None), (1, "marriage_by_age", "35"), (2, "marriage_by_age", "36"),
            (3, "marriage_by_age", "old"), (1, "marriage", "B"), (2, "marriage", "C"), (3, None, "A")]
    got = sorted(map(tuple, L.profile_labels(spark.createDataFrame(rows, "user_id long, kind string, value string")).collect()))
    assert got == [("child_stage", 1, 1), ("consumption", 1, 0), ("consumption", 2, 1), ("marriage", 1, 1), ("marriage_by_age", 1, 0),
                   ("marriage_by_age", 2, 1), ("occupation", 1, 0), ("occupation", 1, 8), ("parent", 1, 0), ("parent", 2, 1),
                   ("sex", 1, 1)]


@pytest.mark.parametrize("tasks", [1, 40])
def test_text_files_have_the_wanted_size_for_skewed_folders(spark, tasks):
    """Nine tenths of the rows in one folder, from one task or from many."""
    n, size = 400_000, 2 << 20
    df = spark.range(0, n, 1, tasks).select(F.when(F.col("id") % 10 == 0, (F.col("id") % 40).cast("string")).otherwise("hot").alias("k"),
                                            F.sha2(F.col("id").cast("string"), 256).alias("a"),
                                            F.when(F.col("id") % 3 != 0, F.col("id")).alias("b"))
    path = scratch_path(spark, "sized")
    SK.write_delimited(df, path, 20240116, partition_by=["k"], target_bytes=size)
    files = {f: os.path.getsize(f) for f in glob.glob(f"{path}/stat_date=20240116/k=*/*.txt")}
    hot = [s for f, s in files.items() if "k=hot" in f]
    assert len(hot) == -(-sum(hot) // size) and all(0.9 * size < s < 1.05 * size for s in hot)
    for k in ("0", "10", "20", "30"):
        assert len([f for f in files if f"k={k}/" in f]) == 1
    back = SK.read_delimited(spark, path, ["a", "b"])
    assert back.count() == n and back.where("b is null").count() == (n + 2) // 3
    with open(next(f for f in files if "k=hot" in f)) as f:
        assert "\x01" in f.readline()


def test_sized_lines_of_null_folders_equal_lines_and_none(spark):
    path = scratch_path(spark, "sized")
    same = spark.range(0, 60_000, 1, 30).select(F.lit("x" * 99).alias("v"), F.when(F.col("id") < 10, "k").alias("k"))
    SK.export_lines(same, F.col("v"), path, ["k"], target_bytes=1 << 20)
    files = glob.glob(f"{path}/k=__HIVE_DEFAULT_PARTITION__/*.txt")
    assert 3 <= len(files) <= 6 and spark.read.text(path).count() == 60_000 and len(glob.glob(f"{path}/k=k/*.txt")) == 1
    SK.export_lines(same, F.col("v"), path, target_bytes=3 << 20)
    assert len(glob.glob(f"{path}/*.txt")) == 2 and spark.read.text(path).count() == 60_000
    SK.export_lines(same.limit(0), F.col("v"), path, target_bytes=1 << 20)
    assert spark.read.text(path).count() == 0


def test_top_down_takes_children_of_the_chosen_parent(spark):
    rows = [(1, [0.1, 0.3, 0.4, 0.0, 0.2]), (2, [0.3, 0.3, 0.4, 0.0, 0.0]), (3, [0.0, 0.0, 0.1, 0.1, 0.8]), (4, [0.2] * 5)]
    df = spark.createDataFrame(rows, "id long, p array<double>")
    cols = [c.alias(n) for c, n in zip(MD.top_down(F.col("p"), [0, 0, 1, 1, 2]), ("parent", "s1", "child", "s2"), strict=True)]
    got = {r.id: (r.parent, round(r.s1, 6), r.child, r.s2) for r in df.select("id", *cols).collect()}
    assert got == {1: (0, 0.4, 1, 0.3), 2: (0, 0.6, 0, 0.3), 3: (2, 0.8, 4, 0.8), 4: (0, 0.4, 0, 0.2)}


def test_stacked_models_score_like_each_alone(spark):
    rng = np.random.default_rng(1)
    x, w, b = rng.standard_normal((50, 7)), rng.standard_normal((11, 7)), rng.standard_normal(11)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "id long, v array<double>")
    stack = spark.createDataFrame([(f"t{k}", [float(c) for c in w[k]], float(b[k])) for k in range(11)],
                                  "tag string, weights array<double>, intercept double")
    got = {(r.id, r.tag): r.value for r in MD.score_all(df, "id", "v", stack).collect()}
    want = 1 / (1 + np.exp(-(x @ w.T + b)))
    assert len(got) == 550 and all(abs(got[i, f"t{k}"] - want[i, k]) < 1e-12 for i in range(50) for k in range(11))
