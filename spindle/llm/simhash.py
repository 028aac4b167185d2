"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has bit k if more than half of its shingles' 64-bit hashes
have it. Documents with equal fingerprints form a class; only classes are compared.
The 64 bits are cut into segments with a radius each, such that radii plus one add up
to the allowed distance plus one: two fingerprints within that distance must then agree
within its radius in at least one segment. Each fingerprint is filed under its value of
every segment, and looks up the small Hamming ball around that value; fetched pairs are
verified on all 64 bits within the join. That is done for half the distance first, and
pairs that are connected already are not emitted for the full one, so a large group of
near copies gives a few links a member. Components follow by contraction.

Classes, buckets and roots are never gathered: a fingerprint's probes are spread by
segment value and merged with the filed rows, whatever size Spark guesses, and joins on a
hot value can be split by Spark. Where a segment value is
shared by more than ``BUCKET`` classes, its filed rows are salted and its probes go to
all salts, which loses nothing.

Defined cases: a null text is empty; no word gives fingerprint 0, linked like any other;
fewer words than a shingle are one shingle; equal rows are one class; a null id never
becomes a component id unless all ids of a component are null; an empty table gives an
empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.arrow_map import with_python_columns
from spindle.llm.common import saved, text_of
from spindle.llm.components import components

#: Rows filed under one segment value before they are salted.
BUCKET = 4096
#: Shingle hashes turned into bits at a time.
BLOCK = 1 << 14


def fingerprint(text: str, shingle: int, seed: int) -> int:
    """The SimHash of a text as a signed 64-bit integer. Only A-Z are lower-cased, and
    words are cut at the six white-space characters of ASCII, as bytes do both."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(line, seed)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        after = np.cumsum(sizes)
        first, last = (after - sizes)[:len(words) - shingle + 1], after[shingle - 1:] - 1
        hashes = [digest(line[i:j], seed) for i, j in zip(first.tolist(), last.tolist(), strict=True)]
    values = np.array(hashes, "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(values), BLOCK):
        ones += np.unpackbits(values[k:k + BLOCK].view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, text_col: str = "text",
                      out_col: str = "fingerprint") -> DataFrame:
    """All rows and columns of ``docs`` plus their SimHash (long)."""
    return with_python_columns(docs, text_col, {out_col: "long"},
                               lambda: lambda texts: [[fingerprint(t, shingle, seed) for t in texts]])


def segment_plan(max_bits: int, segments: int = 3) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of each segment; wider ones have the larger radius."""
    least, more = divmod(max_bits + 1, segments)
    radii = [least - (i >= more) for i in range(segments)]      # radius + 1 add up to max_bits + 1
    radii = [r for r in radii if r >= 0]
    width, wider = divmod(64, len(radii))
    plan, at = [], 0
    for i, r in enumerate(radii):
        bits = width + (i < wider)
        plan.append((at, bits, r))
        at += bits
    return plan


def _segment(fp: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))


def _ball(bits: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def _probes(i: int, value: Column, bits: int, radius: int) -> Column:
    """The ball around a segment's value. Within radius 1 the one of a pair whose bit is 0
    finds the other; ``twice`` marks probes by which both find each other."""
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(bits, radius)])
    if radius <= 1:
        masks = F.filter(masks, lambda m: value.bitwiseAND(m) == 0)
    return F.transform(masks, lambda m: F.struct(
        F.lit(i).alias("seg"), value.bitwiseXOR(m).alias("value"),
        (F.lit(True) if radius > 1 else m == 0).alias("twice")))


def links(classes: DataFrame, max_bits: int) -> DataFrame:
    """``a, b`` (long): fingerprints of ``classes`` (``fp, root``) at most ``max_bits`` apart
    whose roots differ. A pair may come once for each segment that it agrees in."""
    plan = segment_plan(max_bits)
    fp = F.col("fp")
    filed = classes.select("fp", "root", F.explode(F.array(*[
        F.struct(F.lit(i).alias("seg"), _segment(fp, s, n).alias("value"))
        for i, (s, n, _) in enumerate(plan)])).alias("k")).select("fp", "root", "k.*")
    sought = classes.select("fp", "root", F.explode(F.concat(*[
        _probes(i, _segment(fp, s, n), n, r) for i, (s, n, r) in enumerate(plan)])).alias("k")
    ).select("fp", "root", "k.*")
    # values with very many classes: filed rows are dealt to salts, probes go to each
    hot = saved(filed.groupBy("seg", "value").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET)
                .select("seg", "value", F.ceil(F.col("n") / BUCKET).cast("int").alias("salts")), "simhash-hot")
    salts = F.coalesce("salts", F.lit(1))
    filed = (filed.join(hot, ["seg", "value"], "left")
             .select("seg", "value", F.pmod(F.xxhash64("fp"), salts).cast("int").alias("salt"),
                     F.col("fp").alias("b"), F.col("root").alias("root_b")))
    sought = (sought.join(hot, ["seg", "value"], "left")
              .select("seg", "value", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "twice",
                      F.col("fp").alias("a"), F.col("root").alias("root_a")))
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits) & (F.col("root_a") != F.col("root_b"))
    on = [sought[c] == filed[c] for c in ("seg", "value", "salt")]
    # merged: Spark takes an exploded side for as small as its classes, and would send it to the driver
    return (sought.hint("merge").join(filed, [*on, near, ~F.col("twice") | (F.col("a") < F.col("b"))])
            .select("a", "b").distinct())


def near_duplicate_classes(fingerprints: DataFrame, max_bits: int = 4) -> DataFrame:
    """From rows ``id, fp``: one row per distinct ``fp`` with ``root`` (equal within a
    component) and ``component_id``, the smallest id of the component."""
    classes = saved(fingerprints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    rooted = classes.select("fp", F.col("fp").alias("root"))
    edges = None
    for bits in sorted({max_bits // 2, max_bits}):
        found = saved(links(rooted, bits), "simhash-links")
        edges = found if edges is None else edges.union(found)
        roots = components(edges)
        rooted = saved(classes.join(roots, F.col("fp") == F.col("node"), "left")
                       .select("fp", F.coalesce("root", "fp").alias("root"), "least"), "simhash-roots")
    least = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-components")
    return saved(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-labels")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``fp`` (long), ``root`` and ``component_id``."""
    fps = saved(with_fingerprints(docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")),
                                  shingle, seed, "text", "fp").select("id", "fp"), "simhash-fingerprints")
    labels = near_duplicate_classes(fps, max_bits).withColumnRenamed("fp", "label_fp")
    return fps.join(labels, F.col("fp") == F.col("label_fp")).drop("label_fp")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = 4, max_bits: int = 4, seed: int = 42) -> DataFrame:
    """The document with the smallest id of each component; same columns.

    Rows to drop are named by id. Ids that are null or stand on several rows can't name
    a row: those rows are fingerprinted again, and one row of each root stays.
    """
    found = saved(near_duplicates(docs, shingle, max_bits, seed, id_col, text_col), "simhash-found")
    key = F.col(id_col)
    shared = saved(found.groupBy("id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("id").isNull())
                   .select(F.col("id").alias("__shared")), "simhash-shared")
    dropped = saved(found.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("__dropped")),
                    "simhash-dropped")
    single = (docs.where(key.isNotNull()).join(shared, key == F.col("__shared"), "left_anti")
              .join(dropped, key == F.col("__dropped"), "left_anti"))
    roots = saved(found.groupBy("fp").agg(F.first("root").alias("__root"), F.first("component_id").alias("__least"))
                  .withColumnRenamed("fp", "__label"), "simhash-roots")
    several = (with_fingerprints(docs.join(shared, key.eqNullSafe(F.col("__shared")), "left_semi"),
                                 shingle, seed, text_col, "__fp")
               .join(roots, F.col("__fp") == F.col("__label"))
               .where(key.eqNullSafe(F.col("__least"))).dropDuplicates(["__root"]))
    return single.select(docs.columns).unionByName(several.select(docs.columns))
