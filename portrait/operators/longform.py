"""Logistic regression on the long form: one row per (example, feature).

Nothing of the model's size reaches the driver: the vocabulary is a table,
features get their index by a join, margins are sums of joined weights by
example, gradients are sums of joined residuals by feature, and the weights are
a table that every round rewrites.  Sums combine map-side, so a feature that
every example has costs a task one row per example block, not one group.

The optimiser is accelerated gradient descent with one step size per feature: an
example with at most m features and a feature of n examples bound that
feature's curvature by m n / 4, so the step 4 / (m n) never overshoots, whatever
the data.  Each round is stored, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.operators.features import feature_vocab
from portrait.operators.sampling import hash_split
from portrait.session import freeze

ROUNDS = 8


def momentum(rounds: int) -> list[float]:
    """How far each round looks ahead (Nesterov's sequence)."""
    t, out = 1.0, []
    for _ in range(rounds):
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        out.append((t - 1) / after)
        t = after
    return out


def examples(rows: DataFrame, features: str = "features", label: str = "label",
             threshold_hex: str = "cccccccc") -> tuple[DataFrame, DataFrame]:
    """Rows with a string of blank-separated features -> the vocabulary
    (feature, idx), and the long form (row, label, split, idx).  The rows are
    stored with their numbers first, and split by a hash of their features."""
    numbered = freeze(rows.select(F.monotonically_increasing_id().alias("row"), F.col(features).alias("features"),
                                  F.col(label).cast("double").alias("label"),
                                  hash_split(F.col(features), threshold_hex).alias("split")))
    vocab = freeze(feature_vocab(numbered))
    tokens = numbered.select("row", "label", "split", F.explode(F.array_distinct(F.split("features", " "))).alias("feature"))
    return vocab, freeze(tokens.join(vocab, "feature").select("row", "label", "split", "idx"))


def margins(long: DataFrame, weights: DataFrame, weight: str = "weight") -> DataFrame:
    """(row, label, margin): the sum of the weights of a row's features."""
    return (long.join(weights.select("idx", F.col(weight).alias("_w")), "idx")
            .groupBy("row").agg(F.max("label").alias("label"), F.sum("_w").alias("margin")))


def probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def train(long: DataFrame, vocab: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Weights (idx, weight) of every feature of the vocabulary; features that
    no example has stay zero.  Without an example all weights are zero."""
    counts = long.groupBy("idx").agg(F.count(F.lit(1)).alias("n"))
    most = long.groupBy("row").agg(F.count(F.lit(1)).alias("m")).agg(F.max("m")).scalar()
    state = freeze(vocab.select("idx").join(counts, "idx", "left").select(
        "idx", (4.0 / (F.col("n") * most)).alias("step"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("ahead")))
    for look in momentum(rounds):
        residual = margins(long, state, "ahead").select("row", (probability(F.col("margin")) - F.col("label")).alias("r"))
        gradient = long.join(residual, "row").groupBy("idx").agg(F.sum("r").alias("g"))
        moved = F.col("ahead") - F.coalesce(F.col("step") * F.col("g"), F.lit(0.0))
        state = freeze(state.join(gradient, "idx", "left").select("idx", "step", F.col("weight").alias("_old"), moved.alias("weight"))
                       .select("idx", "step", "weight", (F.col("weight") + F.lit(look) * (F.col("weight") - F.col("_old"))).alias("ahead")))
    return state.select("idx", "weight")


def weight_lines(weights: DataFrame, vocab: DataFrame, skip_prefix: str | None = None, digits: int = 5) -> DataFrame:
    """Weights by feature name, and lines ``feature weight`` with the weight
    printed to ``digits`` decimals; features named after ``skip_prefix`` are left out."""
    j = vocab.join(weights, "idx")
    if skip_prefix:
        j = j.where(F.split_part("feature", F.lit("_"), F.lit(1)) != skip_prefix)
    shown = F.round("weight", digits)
    # no minus before a zero
    return j.select("feature", F.when(shown == 0, 0.0).otherwise(shown).alias("weight")).select(
        "feature", "weight", F.format_string(f"%s %.{digits}f", F.col("feature"), F.col("weight")).alias("line"))
