"""Connected components by contraction towards random neighbours.

Each round every node hooks to the node of least priority among itself and its
neighbours (priorities are hashed anew each round, so a chain shrinks by a factor and
a star is gone in two or three rounds), edges are redrawn between the nodes hooked to,
and loops and repeats go. The hooks of all rounds, followed one after another, give
each node's root. A hot node is only ever met by a partial minimum and by joins whose
large side Spark can split; every round is written to shared files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import saved


def _simple(edges: DataFrame) -> DataFrame:
    return (edges.where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` (long) for every node of ``edges`` (``a, b`` long, in any order,
    repeats and loops allowed); a node with no edge to another is not listed. Roots are
    equal exactly within a component, and stand for themselves."""
    left = saved(_simple(edges), "cc-edges")
    hooks = []
    while not left.isEmpty():
        rank = lambda v, r=len(hooks): F.struct(F.xxhash64(v, F.lit(r)).alias("p"), v.alias("v"))
        ends = left.select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.u", "e.v")
        hook = saved(ends.groupBy("u").agg(F.min(rank(F.col("v"))).alias("m"))
                     .select("u", F.least(rank(F.col("u")), F.col("m"))["v"].alias("to")), "cc-hooks")
        hooks.append(hook)
        by = lambda end: hook.select(F.col("u").alias(end), F.col("to").alias(f"to_{end}"))
        left = saved(_simple(left.join(by("a"), "a").join(by("b"), "b")
                             .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), "cc-edges")
    if not hooks:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    at = hooks[0].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for hook in hooks[1:]:
        at = (at.join(hook.withColumnRenamed("u", "root"), "root", "left")
              .select("node", F.coalesce("to", "root").alias("root")))
    return saved(at, "cc-roots")
