"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.session import scratch_path


def _stored(df: DataFrame) -> DataFrame:
    """A written table: small link tables are read back in a few tasks, not in
    one for each partition that wrote them."""
    path = scratch_path(df.sparkSession, "components")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b) of long ids; the
    component is its smallest node.  Each round links every node's larger, then
    its smaller neighbours to the least one; a node with very many neighbours is
    a partial aggregate and a join that can be split.  Rounds grow with the
    logarithm of the longest chain; each is stored."""
    now = _stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        # large star: larger neighbours of u (and u) to the least neighbour
        both = _both(now)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        # small star: smaller neighbours of u and u itself to the least one
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        now = _stored(small)
        last, state = state, _state(now)
        if state == last:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def extended(known: DataFrame, new: DataFrame) -> DataFrame:
    """Components (node, component) of the links behind ``known``, which has the
    same form, and of ``new`` links (a, b).  Nodes are contracted to their known
    components first, so only links between components take part in the rounds."""
    end = lambda x: known.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    ends = _stored(new.join(end("a"), "a", "left").join(end("b"), "b", "left").select(
        "a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb")))
    moved = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(
        F.col("node").alias("component"), F.col("component").alias("to"))
    nodes = known.select("node", "component").union(ends.select("a", "ca")).union(ends.select("b", "cb")).distinct()
    return _stored(nodes.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component")))
