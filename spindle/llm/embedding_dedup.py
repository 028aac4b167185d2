"""Near-duplicate vectors by an inverted multi-index.

Vectors are halved and each half has a codebook of its own (k-means on a bounded sample);
the pairs of centroids form a grid of cells, and every vector is filed in the cell of its
nearest two. A vector looks for its neighbours by visiting cells in the order of the sum
of the two squared distances (multi-sequence traversal of the two sorted codebooks)
until that sum exceeds the one of its own cell by a margin. The margin is the quantile
for the target recall of what true links needed: a bounded set of query vectors is
compared with all rows by brute force. Every pair that meets in a cell is verified by its
cosine in double precision.

Equal vectors are one class. A cell is cut into blocks by a hash of the class, and every
block of visitors meets every block of residents, so no task gets more than two blocks,
however full a cell is, and all pairs are still compared. A pair of blocks returns a count
a visitor and a spanning forest of its links, not the links. Components by contraction.

Vectors are compared with those of their own length. The most frequent length, and every
other with more than ``SMALL`` classes, has an index of its own; each of the rest is one
cell, cut into blocks like any other, so that all its pairs meet.

Defined cases: vectors that are null, zero, or hold null, NaN or infinite components link
with nothing; vectors of different lengths don't link; repeated rows with equal vectors link with each other; a
null id is a row, and a component's id if all its ids are null; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm import arrow_map  # noqa: F401  (functions travel by value)
from spindle.llm.common import saved
from spindle.llm.components import components

#: Bounds of the samples: vectors that fit the codebooks, queries that fit the margin.
FIT_ROWS, QUERY_ROWS = 16_384, 2048
#: Residents aimed at for a cell, and the centroids of a half at least and at most.
CELL_ROWS, MIN_CENTROIDS, MAX_CENTROIDS = 32, 2, 256
#: Rows of a block.
BLOCK = 512
#: Classes of a length up to which all its pairs are compared without an index.
SMALL = 2048
TARGET_RECALL = 1.0
#: Room left beyond the margin that the queries needed.
SLACK = 1.25


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids by Lloyd's rounds from a seeded choice of distinct rows."""
    x = np.unique(x, axis=0)
    k = min(k, len(x))
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        at = squared(x, c).argmin(axis=1)
        n = np.bincount(at, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, at, x)
        c = np.where(n[:, None] > 0, s / np.maximum(n, 1)[:, None], c)
    return c


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0.0)


def units(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their greatest component first, so that no square is lost."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the halves, and how much farther than its own cell a vector looks."""

    first: np.ndarray
    second: np.ndarray
    margin: float = 0.0

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.first.shape[1]
        return squared(x[:, :h], self.first), squared(x[:, h:], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)

    def visits(self, a: np.ndarray, b: np.ndarray, live: np.ndarray) -> list[int]:
        """Cells with residents, nearest first, up to the margin; ``a`` and ``b`` are the
        distances of a vector's halves to the two codebooks."""
        i_of, j_of = a.argsort(kind="stable"), b.argsort(kind="stable")
        limit = a[i_of[0]] + b[j_of[0]] + self.margin
        out, heap, n = [], [(a[i_of[0]] + b[j_of[0]], 0, 0)], len(self.second)
        while heap:
            d, i, j = heapq.heappop(heap)
            if d > limit:
                break
            cell = int(i_of[i]) * n + int(j_of[j])
            if live[cell]:
                out.append(cell)
            # each place of the two sorted lists is reached once: along j, and along i where j is 0
            if j + 1 < len(j_of):
                heapq.heappush(heap, (a[i_of[i]] + b[j_of[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(i_of):
                heapq.heappush(heap, (a[i_of[i + 1]] + b[j_of[0]], i + 1, 0))
        return out


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def vector_classes(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, list[int]]:
    """``key, dim, vec, n, least`` of the distinct usable vectors, and the lengths to index."""
    v = F.col("vec")
    usable = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
              .where(F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                                                          & (F.abs(x) < float("inf")))
                                & F.exists(v, lambda x: x != 0), F.lit(False))))
    # equal vectors are counted where they are read; the key is fixed by writing it
    grouped = (usable.groupBy("vec").agg(F.count("*").alias("n"), F.min("id").alias("least"))
               .withColumn("key", F.monotonically_increasing_id()))
    classes = saved(grouped.select("key", F.size("vec").alias("dim"), "vec", "n", "least"), "imi-classes")
    lengths = (classes.groupBy("dim").agg(F.count("*").alias("classes"), F.sum("n").alias("rows"))
               .orderBy(F.desc("rows"), "dim"))
    first = lengths.limit(1).collect()
    return classes, [r.dim for r in first] + [r.dim for r in lengths.where(F.col("classes") > SMALL).collect()
                                              if r.dim != first[0].dim]


def fit_index(classes: DataFrame, dim: int, threshold: float) -> MultiIndex:
    """Codebooks and margin from bounded samples, by the order of a hash of the key."""
    total = classes.count()
    order = F.xxhash64("key")
    rows = classes.select("key", "vec").orderBy(order).limit(FIT_ROWS).collect()
    x = units(np.array([r.vec for r in rows], dtype=np.float64).reshape(len(rows), dim))
    half = max(dim // 2, 1)
    k = min(max(math.isqrt(total // CELL_ROWS), MIN_CENTROIDS), MAX_CENTROIDS)
    index = MultiIndex(kmeans(x[:, :half], k), kmeans(x[:, half:], k) if dim > 1 else np.zeros((1, 0)))
    queries, keys = x[:QUERY_ROWS], np.array([r.key for r in rows[:QUERY_ROWS]])

    def run(batches):
        a, b = index.distances(queries)
        own = a.min(axis=1) + b.min(axis=1)
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                y = units(matrix(part.column(1), dim))
                near = queries @ y.T >= threshold
                near &= keys[:, None] != np.asarray(part.column(0))[None, :]
                q, p = near.nonzero()
                cell = index.cells(y)[p]
                need = a[q, cell // len(index.second)] + b[q, cell % len(index.second)] - own[q]
                # a histogram in thousandths, rounded up
                bins, n = np.unique(np.ceil(need * 1000).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n)], ["bin", "n"])

    needs = (classes.select("key", "vec").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
             .orderBy("bin").collect())       # distances of unit vectors: 4000 bins or so at most
    links = sum(r.n for r in needs)
    if links:
        seen, margin = 0, 0.0
        for r in needs:
            seen, margin = seen + r.n, r.bin / 1000
            if seen >= TARGET_RECALL * links:
                break
    else:                                     # no link among the queries: what links at the threshold may need
        residual = np.sqrt(sum(d.min(axis=1) for d in index.distances(x))).mean() if len(x) else 0.0
        margin = 2 - 2 * threshold + 2 * residual * math.sqrt(2 - 2 * threshold)
    return MultiIndex(index.first, index.second, margin * SLACK + 0.001)


def _visited(classes: DataFrame, index: MultiIndex, dim: int) -> DataFrame:
    """``key, cell, resident``: where each class is filed, and the cells it visits."""
    def file(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(index.cells(units(matrix(b.column(1), dim))).astype(np.int64))], ["key", "cell"])

    filed = saved(classes.select("key", "vec").mapInArrow(file, "key long, cell long"), "imi-filed")
    n_cells = len(index.first) * len(index.second)      # at most MAX_CENTROIDS squared
    live = np.zeros(n_cells, bool)
    live[[r.cell for r in filed.select("cell").distinct().collect()]] = True

    def visit(batches):
        for b in batches:
            keys = np.asarray(b.column(0))
            a, c = index.distances(units(matrix(b.column(1), dim)))
            for s in range(0, len(keys), 256):
                cells = [index.visits(a[i], c[i], live) for i in range(s, min(s + 256, len(keys)))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(keys[s:s + 256], [len(x) for x in cells])),
                     pa.array(np.array([v for x in cells for v in x], np.int64))], ["key", "cell"])

    visits = classes.select("key", "vec").mapInArrow(visit, "key long, cell long")
    return saved(filed.withColumn("resident", F.lit(True)).unionByName(visits.withColumn("resident", F.lit(False))),
                 "imi-visits")


def block_links(table: pa.Table, dim: int, threshold: float) -> pa.Table:
    """Counts and a spanning forest of the links between a block's visitors and residents."""
    here = np.asarray(table.column("resident").combine_chunks().to_numpy(zero_copy_only=False))
    keys, n = table.column("key").to_numpy(), table.column("n").to_numpy()
    x = units(matrix(table.column("vec").combine_chunks(), dim))
    vk, rk, rn = keys[~here], keys[here], n[here]
    near = (x[~here] @ x[here].T >= threshold) & (vk[:, None] != rk[None, :])
    counts = near @ rn
    # the least key that links lead to, over and over, names a tree of the forest
    far = np.iinfo(np.int64).max
    v, r = vk.copy(), rk.copy()
    while near.any():
        v2 = np.minimum(v, np.where(near, r[None, :], far).min(axis=1))
        r2 = np.minimum(r, np.where(near, v2[:, None], far).min(axis=0))
        if (v2 == v).all() and (r2 == r).all():
            break
        v, r = v2, r2
    key, to = np.concatenate([vk, rk]), np.concatenate([v, r])
    count = np.concatenate([counts, np.zeros(len(rk), np.int64)])
    told = (key != to) | (count > 0)
    return pa.table({"a": key[told], "b": to[told], "n": count[told].astype(np.int64)})


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                           vector_col: str = "embedding") -> DataFrame:
    """One row per vector: ``id``, ``n_links`` (others linked directly), ``component_id``
    (the smallest id reachable)."""
    classes, dims = vector_classes(vectors, id_col, vector_col)
    spark = vectors.sparkSession
    if dims:
        places = classes.where(~F.col("dim").isin(dims)).select(
            "key", F.lit(0).cast("long").alias("cell"), F.explode(F.array(F.lit(True), F.lit(False))).alias("resident"), "dim")
        for dim in dims:
            own = classes.where(F.col("dim") == dim)
            places = places.unionByName(_visited(own, fit_index(own, dim, threshold), dim).withColumn("dim", F.lit(dim)))
        # blocks of residents and of visitors in each cell
        blocks = saved(places.groupBy("dim", "cell").agg(*[
            F.ceil(F.count(F.when(F.col("resident") == side, True)) / BLOCK).cast("int").alias(name)
            for side, name in ((True, "rs"), (False, "vs"))]), "imi-blocks")
        spread = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), n).cast("int")
        every = lambda n: F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)
        one, rs, vs = F.col("resident"), F.greatest("rs", F.lit(1)), F.greatest("vs", F.lit(1))
        dealt = (places.join(blocks, ["dim", "cell"])
                 .withColumn("r", F.explode(F.when(one, F.array(spread(rs, 1))).otherwise(every(rs))))
                 .withColumn("v", F.explode(F.when(one, every(vs)).otherwise(F.array(spread(vs, 2)))))
                 .join(classes.select("key", "vec", "n"), "key").select("dim", "cell", "r", "v", "resident", "key", "vec", "n"))
        found = saved(dealt.groupBy("dim", "cell", "r", "v")
                      .applyInArrow(lambda t: block_links(t, t.column("dim")[0].as_py(), threshold), "a long, b long, n long"), "imi-links")
        counts = found.groupBy("a").agg(F.sum("n").alias("others"))
        roots = components(found.select("a", "b"))
    else:
        counts = spark.createDataFrame([], "a long, others long")
        roots = spark.createDataFrame([], "node long, root long")
    rooted = saved(classes.join(counts, F.col("key") == F.col("a"), "left")
                   .join(roots, F.col("key") == F.col("node"), "left")
                   .select("key", "vec", "least", F.coalesce("root", "key").alias("root"),
                           (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links")), "imi-rooted")
    least = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "imi-components")
    labels = saved(rooted.join(least, "root").select(F.col("vec").alias("label"), "n_links", "component_id"), "imi-labels")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    return (rows.join(labels, F.col("vec") == F.col("label"), "left")
            .select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    # a vector that links with nothing stands for itself
                    F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")))
