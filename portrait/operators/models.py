"""Linear and text classifiers with Spark ML: training on an id-hash split,
threshold tuning, batch scoring of many saved models on one feature table.
Training data is checkpointed before the iterative
optimiser runs, so a lost executor does not replay the feature plan."""

from __future__ import annotations

from typing import Sequence

import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.functions.hashing import hashed_terms
from portrait.operators.sampling import hash_split
from portrait.session import freeze
from portrait.ship import ship


def dense_features(c: Column) -> Column:
    return array_to_vector(c)


def index_vectorizer(dim: int, input_col: str = "idx_tokens", output_col: str = "features") -> CountVectorizerModel:
    """Sparse 0/1 vectors from arrays of index strings '0'..'dim-1' (JVM side,
    no Python UDF).  The vocabulary is the index range, size ``dim``."""
    return CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol=input_col,
                                                outputCol=output_col, binary=True)


def sparse_from_indices(df: DataFrame, idx: str, dim: int, out: str = "features") -> DataFrame:
    toks = df.withColumn("_idx_tokens", F.transform(F.col(idx), lambda i: i.cast("string")))
    return index_vectorizer(dim, "_idx_tokens", out).transform(toks).drop("_idx_tokens")


def split(df: DataFrame, id_col: str, threshold_hex: str = "cccccccc"):
    s = df.withColumn("_split", hash_split(F.col(id_col), threshold_hex))
    return s.where(F.col("_split") == "train").drop("_split"), s.where(F.col("_split") == "valid").drop("_split")


def train_lr(train: DataFrame, features: str = "features", label: str = "label", multinomial: bool = False,
             max_iter: int = 100, reg: float = 0.0, intercept: bool = False, stored: bool = False, block_mb: float = 0.0):
    """Logistic regression; ``stored`` says that the rows are frozen already.  For
    each block of ``block_mb`` (0: Spark's 1 MB) Spark fills a gradient of all
    features and classes, so wide sparse rows want larger blocks."""
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg,
                            fitIntercept=intercept, family="multinomial" if multinomial else "auto",
                            maxBlockSizeInMB=block_mb)
    rows = train.select(features, label)
    return lr.fit(rows if stored else freeze(rows))


def train_svm(train: DataFrame, features: str = "features", label: str = "label", max_iter: int = 100,
              reg: float = 0.01, intercept: bool = False):
    svm = LinearSVC(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg, fitIntercept=intercept)
    return svm.fit(freeze(train.select(features, label)))


def positive_score(model_out: DataFrame, prob: str = "probability") -> Column:
    return vector_to_array(F.col(prob))[1]


def top1(model_out: DataFrame, prob: str = "probability") -> tuple[Column, Column]:
    """(predicted class, its probability)."""
    arr = vector_to_array(F.col(prob))
    return F.col("prediction"), F.array_max(arr)


def top_down(scores: Column, parent_of: Sequence[int]) -> tuple[Column, Column, Column, Column]:
    """Two-level decision from the scores of child classes (``parent_of[i]`` is
    the parent of class i): the parent with the largest sum of its children's
    scores, that sum, the child with the largest score among that parent's own
    children, and its score.  Ties go to the first class."""
    sums = F.array(*[sum(F.get(scores, F.lit(i)) for i, p in enumerate(parent_of) if p == k)
                     for k in range(max(parent_of) + 1)])
    parent = (F.array_position(sums, F.array_max(sums)) - 1).cast("int")
    own = F.transform(scores, lambda x, i: F.when(F.get(F.lit(list(parent_of)), i) == parent, x))
    child = (F.array_position(own, F.array_max(own)) - 1).cast("int")
    return parent, F.array_max(sums), child, F.array_max(own)


def stacked(spark, models: dict) -> DataFrame:
    """Binary linear models as rows (tag, weights, intercept)."""
    rows = [(tag, [float(x) for x in m.coefficients.toArray()], float(m.intercept)) for tag, m in models.items()]
    return spark.createDataFrame(rows, "tag string, weights array<double>, intercept double")


def dot(x: Column, weights: Column) -> Column:
    return F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def score_all(df: DataFrame, id_col: str, vector: str, models: DataFrame) -> DataFrame:
    """(id, tag, value): the positive score of every stacked model for every
    row, in one pass over the rows; the stack (models times dimensions) is a
    literal of the plan."""
    stack = models.select(F.array_sort(F.collect_list(F.struct("tag", "weights", "intercept")))).scalar()
    scored = F.transform(F.col("_stack"), lambda m: F.struct(
        m["tag"].alias("tag"), (1 / (1 + F.exp(-(dot(F.col(vector), m["weights"]) + m["intercept"])))).alias("value")))
    return df.select(id_col, vector, stack.alias("_stack")).select(id_col, F.inline(scored))


def text_features(df: DataFrame, tokens: str, bits: int = 18) -> DataFrame:
    """Unigrams and bigrams hashed into a sparse vector: the vectors of ``NGram``
    and ``HashingTF``, whose time goes into a string object and a map entry for
    every term; here a batch's terms are hashed and counted as arrays.  A row
    without tokens, null ones included, has a vector without entries."""
    @F.arrow_udf(VectorUDT())
    def hashed(rows: pa.Array) -> pa.Array:
        return hashed_terms(rows, bits)
    ship(df.sparkSession)
    return df.withColumn("features", hashed(F.col(tokens)))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind):
    return kind.load(path)
