"""Mixing sources to target weights.

Sizes are summed per source; the total is shared out by weight, no source beyond
``max_repeats`` times its size (the excess goes to the others by weight, again and
again, until none is above); a source's rate is its target over its size, and each
document is taken floor(rate) times plus once more if a uniform number hashed from
the seed and its key lies below the rate's fraction.

One aggregation with partial sums (a hot source is summed where it is read), a
handful of jobs over the table of sources, and one join back; that table is read
from files, so Spark broadcasts it below its own threshold and otherwise joins by
shuffle, splitting a hot source. Nothing per source is collected but three sums.

Defined cases: a null text has size 0; a null source is a source, ranked last; a
source whose documents are all empty has target 0 and rate 0, so none of its
documents is taken; equal rows draw alike; an empty table gives an empty result;
columns of the input with the names of the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spindle.llm.common import saved, text_of, word_count

OUT = ("size", "source_size", "target", "rate", "copies")


def _ranked(sources: DataFrame) -> DataFrame:
    """0-based rank of ``source`` by code point, nulls last: sorted ranges are counted,
    and each row's place in its range is added to the rows of the ranges before."""
    ranged = saved(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("_part", F.spark_partition_id()), "mix-ranges")
    place = F.row_number().over(W.partitionBy("_part").orderBy(F.col("source").asc_nulls_last()))
    # one row per range, of which there are at most spark.sql.shuffle.partitions
    before = F.sum("n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = (ranged.groupBy("_part").agg(F.count("*").alias("n"))
              .select("_part", F.coalesce(before, F.lit(0)).alias("start")))
    return (ranged.withColumn("place", place).join(starts, "_part")
            .select("source", "source_size", (F.col("start") + F.col("place") - 1).alias("rank")))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int = 3) -> DataFrame:
    """``source, source_size`` and the ``target`` of each from rows ``source, size``.

    ``weights`` repeat over the sources in code-point order. The level (target for one
    unit of weight) rises until no source below its cap is above it; each pass caps at
    least one more distinct cap-to-weight ratio.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = _ranked(sums)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    s = saved(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-sources")
    cap = F.col("source_size") * max_repeats
    total = s.agg(F.sum("source_size")).first()[0] or 0
    rest, share = total, 0
    while True:
        # capped: its weighted share at the present level rest / share reaches its cap
        above = F.lit(False) if not share else F.col("weight") * F.lit(rest) >= cap * F.lit(share)
        row = s.agg(F.sum(F.when(above, cap)).alias("capped"),
                    F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("free")).first()
        now = total - (row.capped or 0), row.free or 0
        if now == (rest, share) or not now[1]:
            if not now[1]:
                above = F.lit(True)
            break
        rest, share = now
    level = F.col("weight") * F.lit(rest) / F.lit(share or 1)
    return s.select("source", "source_size", F.when(above, cap.cast("double")).otherwise(level).alias("target"))


def uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5('seed:key'); null is a key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2 ** 52)


def plan_copies(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, seed: int = 42,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All rows of ``docs`` with ``size, source_size`` (long), ``target, rate`` (double)
    and ``copies`` (long): how often the mix takes the document."""
    size = word_count(text_of(text_col))
    # read twice: once for the sums, once to hand the documents on
    targets = saved(source_targets(docs.select(F.col(source_col).alias("source"), size.alias("size")),
                                   weights, max_repeats), "mix-targets")
    own = [c for c in docs.columns if c.lower() not in OUT]
    t = targets.select(F.col("source").alias("_mx_source"), "source_size", "target")
    joined = (docs.select(*own, size.alias("size"))
              .join(t, F.col(source_col).eqNullSafe(F.col("_mx_source")), "left").drop("_mx_source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor("rate")
    extra = uniform(seed, F.col(id_col)) < F.col("rate") - whole
    return (joined.withColumn("rate", rate)
            .withColumn("copies", (whole + extra.cast("long")).cast("long")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as ``plan_copies`` says; same columns."""
    planned = plan_copies(docs, **options)
    n = F.col("copies").cast("int")
    return (planned.withColumn("_mx_copy", F.explode(F.array_repeat(F.lit(1), n)))
            .select(*[c for c in docs.columns]))
