"""Dictionaries, training lines and result sets on hand-made rows."""

from pyspark.sql import functions as F

from portrait.operators import content as CT
from portrait.operators import shopping as SH
from portrait.operators.ordering import segmented_index


def goods(spark):
    rows = [(1, "t1", "a|x|p"), (2, "t2", "a|x|q"), (3, "t3", "b|x|p"), (4, "t4", "a|y"), (5, "t5", " a|y|p "), (6, None, "b|z|p")]
    return CT.category_levels(spark.createDataFrame(rows, "fid long, ftitle string, fcategory string"), "fcategory")


def test_dictionary_numbers_each_level_on_its_own(spark):
    got = {(r.level, r["name"]): (r["count"], r.id) for r in SH.level_dictionary(goods(spark)).collect()}
    assert got == {(1, "a"): (3, 0), (1, "b"): (2, 1), (2, "a-x"): (2, 0), (2, "a-y"): (1, 1), (2, "b-x"): (1, 2), (2, "b-z"): (1, 3),
                   (3, "a-x-p"): (1, 0), (3, "a-x-q"): (1, 1), (3, "a-y-p"): (1, 2), (3, "b-x-p"): (1, 3), (3, "b-z-p"): (1, 4)}


def test_dictionary_scans_once(spark):
    plan = goods(spark)._jdf.queryExecution().executedPlan().toString()
    counted = goods(spark).groupingSets([["category_1"], ["category_2"]], "category_1", "category_2").agg(F.count(F.lit(1)))
    assert counted._jdf.queryExecution().executedPlan().toString().count("ExistingRDD") == plan.count("ExistingRDD") == 1


def test_labelled_table_gives_its_dictionaries_back(spark):
    g = goods(spark)
    d = SH.level_dictionary(g)
    labelled = SH.attach_labels(g, d)
    assert {r.fid: (r.label_1, r.label_3) for r in labelled.collect()}[5] == ("3-0", "1-2")
    odd = labelled.withColumn("label_1", F.when(F.col("fid") == 3, "7").when(F.col("fid") == 6, None).otherwise(F.col("label_1")))
    same = lambda df: sorted(map(tuple, df.select("level", "name", "count", "id").collect()))
    assert same(SH.dictionary_of(labelled)) == same(d)
    assert same(SH.dictionary_of(odd)) == [r for r in same(d) if r[:2] != (1, "b")]
    lines = sorted(map(tuple, SH.train_lines(labelled, "ftitle", 2).collect()))
    assert lines == [(1, "__label__0, t1"), (1, "__label__0, t2"), (1, "__label__0, t5"), (1, "__label__1, t3"),
                     (2, "__label__0, t1"), (2, "__label__0, t2")]


def test_result_sets(spark):
    lines = [(1, "u1|some text|__label__0"), (1, "u1|some text|__label__0"), (1, "u2|other|__label__9"), (1, "u3|a|__label__0"),
             (1, "u4|bad|line|__label__0"), (2, "u1|some text|__label__1"), (2, "u2|other|odd"), (2, None),
             (3, "u1|some text|__label__0"), (3, "u1|some text|__label__1"), (3, "u2|other|__label__0"), (3, "u5|alone|__label__0")]
    parsed = SH.result_lines(spark.createDataFrame(lines, "level int, value string"))
    d = spark.createDataFrame([(1, "a", 1, 0), (2, "a-x", 1, 1), (3, "p", 1, 0), (3, "q", 1, 1)], "level long, name string, count long, id long")
    got = sorted(tuple(r) for r in SH.result_sets(parsed, d).collect())
    assert got == [("u1", "some text", "__label__0", "a", "__label__1", "a-x", "__label__0", "p"),
                   ("u1", "some text", "__label__0", "a", "__label__1", "a-x", "__label__1", "q"),
                   ("u2", "other", "__label__9", "", "odd", "", "__label__0", "p")]
    assert sorted(map(tuple, SH.line_counts(parsed).collect())) == [(1, 5, 2), (2, 3, 1), (3, 4, 0)]


def test_content_training_lines(spark):
    rows = [(1, "t", "c", "en", 0, 1), (2, "t2", "c2", "en-a", 3, 2), (3, "t3", None, "en", 0, 1), (4, "t4", "c4", "UNK", -1, -1)]
    df = spark.createDataFrame(rows, "fid long, ftitle string, fcontent string, fcategory string, fcategory_id long, level long")
    assert sorted(map(tuple, CT.training_lines(df).collect())) == [
        ("content", 1, "__label__en_0, c"), ("content", 2, "__label__en-a_3, c2"),
        ("title", 1, "__label__en_0, t"), ("title", 2, "__label__en-a_3, t2")]


def test_segmented_index_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") % 3).alias("s"), F.col("id"))
    got = segmented_index(df, "s", [F.col("id").desc()]).collect()
    for s in range(3):
        assert [r.idx for r in sorted((r for r in got if r.s == s), key=lambda r: -r.id)] == list(range(len(range(s, 1000, 3))))
