"""Hashed text features against Spark's own NGram and HashingTF."""

import random

from pyspark.ml.feature import HashingTF, NGram
from pyspark.sql import functions as F

from portrait.operators import models as MD


def test_vectors_are_those_of_spark_ml(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("ab1éß你😀 ") for _ in range(rng.randrange(12)))
    rows = [(i, [word() for _ in range(rng.choice((0, 1, 2, 3, 40, 300)))]) for i in range(120)]
    rows += [(200, ["x" * n for n in range(40)]), (201, ["y" * 255, "z" * 256, "é" * 4001, "y" * 261]), (202, [""]), (203, ["", ""])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>").repartition(3)
    terms = NGram(n=2, inputCol="tokens", outputCol="two").transform(df).withColumn("terms", F.concat("tokens", "two"))
    for bits in (6, 15, 18):
        want = HashingTF(inputCol="terms", outputCol="features", numFeatures=1 << bits).transform(terms)
        want = {r.id: r.features for r in want.select("id", "features").collect()}
        got = {r.id: r.features for r in MD.text_features(df, "tokens", bits).select("id", "features").collect()}
        assert got == want


def test_rows_without_tokens_have_empty_vectors(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ["a"]), (4, None)], "id long, tokens array<string>").coalesce(1)
    got = {r.id: r.features.numNonzeros() for r in MD.text_features(df, "tokens", 10).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 0}
    assert MD.text_features(df.where("id > 9"), "tokens", 10).collect() == []
