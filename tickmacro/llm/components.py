"""Connected components by alternating stars, one shuffle-bound round at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmacro.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) to (node, root): the smallest node that can be reached.

    Each round hangs the larger neighbours of a node, then the node and its smaller
    ones, onto the smallest of them; stars remain after about log(nodes) rounds.
    Minima are aggregated before they are shuffled, and the joins have one row per
    node on one side, so a node with very many links is split by adaptive execution.
    A round is a written table: a lost executor never repeats earlier rounds. Nodes
    without a link are not returned; an empty table gives no rows. Self-links and
    nulls are ignored.
    """
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges = staged(edges.distinct(), "links")
    seen = _mark(edges)
    while True:
        edges = staged(_small_star(_large_star(edges)), "links")
        mark = _mark(edges)
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge sets, different for others but by chance."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` run from the larger node a to the smaller b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
