"""Packing token streams into training blocks: P1-P12.

The corpus order is ``doc_id``; documents are concatenated without separators
into one stream addressed by a global position ``gpos``. Blocks are built from
per-document *slices* (never a token-level explode): a document emits one slice
per block it overlaps, and a block is the ordered concatenation of at most
``block`` ids, so every group is bounded.

Scale notes
-----------
* Offsets (P1) are running sums within sorted ranges of the key, taken where the rows
  lie (``mapInArrow`` over a sorted partition passes the id arrays through), plus the
  total of the ranges before, one row per range. No window or task sees more than a
  range, whether keys are dense or hashed.
* The encoded corpus is range-partitioned by ``doc_id`` already if its text was
  (``corpus.by_document``): then no exchange moves the id arrays before the blocks.
* Step caps and full-batch cuts are applied at document level before any
  slice is generated, so a 1000-step epoch slices only the documents that reach
  the first 4,096,000 positions (all documents are encoded before).
* Repetition (wrap, carry, epochs) is a per-row ``sequence`` generator, not a
  join: no pair of tables is multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle import constants as C
from spindle.session import written

# --------------------------------------------------------------------------- P1
def _running(df: DataFrame, key: str, n: str, ordered: bool) -> DataFrame:
    """``df`` plus ``offset``: the sum of ``n`` over all rows before, by ``key``. ``ordered``
    says that ``df`` is range-partitioned by ``key``, which is checked."""
    if not ordered:
        df = df.repartitionByRange(key)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        for b in batches:
            n_of = b.column(b.schema.names.index(n)).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = before + np.cumsum(n_of)
            if len(upto):
                before = int(upto[-1])
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(n_of), part, np.int32)), pa.array(upto - n_of)],
                [*b.schema.names, "_part", "_local"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "_part int", "_local bigint"])
    local = written(df.sortWithinPartitions(key).mapInArrow(run, schema), "offsets")
    # one row per range
    parts = (local.groupBy("_part").agg(F.sum(n).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
             .orderBy("_part").collect())
    start, starts, last = 0, [], None
    for p in parts:
        if ordered and last is not None and p.lo is not None and p.lo < last:
            raise ValueError(f"rows aren't partitioned by ranges of {key}")
        starts.append((p["_part"], start))
        start, last = start + (p.n or 0), p.hi if p.hi is not None else last
    table = df.sparkSession.createDataFrame(starts, "_part int, _start bigint")
    return (local.join(table, "_part").withColumn("offset", F.col("_start") + F.col("_local"))
            .drop("_part", "_local", "_start"))


def token_offsets(lens: DataFrame, order_col: str = "doc_id", len_col: str = "n",
                  ordered: bool = False) -> DataFrame:
    """``offset`` = number of ids in all rows before this one (by ``order_col``).

    ``lens`` must be narrow: ``(order_col, len_col)``.
    """
    return _running(lens.select(order_col, F.col(len_col).cast("bigint").alias(len_col)), order_col, len_col, ordered)


def with_offsets(encoded: DataFrame, ids_col: str = "ids", key: str = "doc_id", ordered: bool = False) -> DataFrame:
    """Encoded rows plus ``n`` (id count) and ``offset`` in the concatenated stream; written
    once. ``ordered``: the rows are range-partitioned by ``key``, as encoding leaves them
    after ``corpus.by_document``, and stay where they are."""
    sized = encoded.withColumn("n", F.size(ids_col).cast("bigint"))
    return _running(sized, key, "n", ordered)


def stream_total(encoded: DataFrame, ids_col: str = "ids") -> Column:
    """Total number of ids in the stream, as a scalar-subquery column."""
    return encoded.select(F.coalesce(F.sum(F.size(ids_col)), F.lit(0)).cast("bigint")).scalar()


# --------------------------------------------------------------------------- P2
def token_stream(with_offs: DataFrame, ids_col: str = "ids", key: str = "doc_id") -> DataFrame:
    """One row per id: key, pos (in document), gpos (in stream), token_id."""
    ex = with_offs.select(key, "offset", F.posexplode(ids_col).alias("pos", "token_id"))
    return ex.select(key, F.col("pos").cast("bigint").alias("pos"),
                     (F.col("offset") + F.col("pos")).alias("gpos"), "token_id")


# --------------------------------------------------------------------------- P4
def reshape(stream: DataFrame, block: int = C.BLOCK_SIZE, batch: int = C.BATCH_SIZE) -> DataFrame:
    """Address every id as (step, row, col) of a ``batch x block`` tensor."""
    per_step = block * batch
    g = F.col("gpos")
    return stream.select("gpos", "token_id",
                         F.floor(g / per_step).alias("step"),
                         F.floor((g % per_step) / block).alias("row"),
                         (g % block).alias("col"))


# --------------------------------------------------------------------------- P3
def _slices(docs: DataFrame, block: int, max_block: Column | None,
            ids_col: str = "ids") -> DataFrame:
    """Per (document, overlapped block): the slice of ids falling in the block.

    ``docs`` has ``offset`` and ``n``; only blocks ``< max_block`` are emitted.
    """
    d = docs.filter(F.col("n") > 0)
    if max_block is not None:
        d = d.filter(F.col("offset") < max_block * block)
    first = F.floor(F.col("offset") / block)
    last = F.floor((F.col("offset") + F.col("n") - 1) / block)
    if max_block is not None:
        last = F.least(last, max_block - 1)
    d = d.select(ids_col, "offset", "n",
                 F.explode(F.sequence(first.cast("bigint"), last.cast("bigint"))).alias("block"))
    start = F.greatest(F.col("block") * block, F.col("offset"))
    end = F.least((F.col("block") + 1) * block, F.col("offset") + F.col("n"))
    return d.select("block", start.alias("start"),
                    F.slice(ids_col, (start - F.col("offset") + 1).cast("int"),
                            (end - start).cast("int")).alias("piece"))


def _assemble(slices: DataFrame, batch: int) -> DataFrame:
    g = slices.groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("_p"))
    x = F.flatten(F.col("_p").getField("piece"))
    return g.select("block", F.floor(F.col("block") / batch).alias("step"),
                    (F.col("block") % batch).alias("row"), x.alias("x"))


def pack_blocks(with_offs: DataFrame, block: int = C.BLOCK_SIZE, batch: int = C.BATCH_SIZE,
                max_block: Column | int | None = None) -> DataFrame:
    """``(block, step, row, x)`` for every block of the stream; the last one
    may be short. ``max_block`` cuts before any slice is built."""
    if isinstance(max_block, int):
        max_block = F.lit(max_block)
    return _assemble(_slices(with_offs, block, max_block), batch)


# --------------------------------------------------------------------------- P5
def n_full_batches(total: Column, block: int = C.BLOCK_SIZE, batch: int = C.BATCH_SIZE) -> Column:
    return F.floor(total / F.lit(block * batch))


def full_batches(with_offs: DataFrame, total: Column, block: int = C.BLOCK_SIZE,
                 batch: int = C.BATCH_SIZE) -> DataFrame:
    """P5: only complete batches; the tail shorter than ``block*batch`` is dropped."""
    return pack_blocks(with_offs, block, batch, n_full_batches(total, block, batch) * batch)


def _require_full(n_full: Column) -> Column:
    return F.when(n_full < 1, F.raise_error(F.lit("corpus shorter than one batch"))) \
            .otherwise(n_full)


# --------------------------------------------------------------------------- P6
def pack_wrap(with_offs: DataFrame, total: Column, steps: int, block: int = C.BLOCK_SIZE,
              batch: int = C.BATCH_SIZE) -> DataFrame:
    """Whole-text repetition. Step k is full batch ``k mod n_full``; the tail
    shorter than one batch is never used. Errors if there is no full batch."""
    n_full = _require_full(n_full_batches(total, block, batch))
    cap = F.least(n_full, F.lit(steps))
    base = pack_blocks(with_offs, block, batch, cap * batch)
    # every base block reappears at steps s, s + n_full, s + 2 n_full, ... < steps
    rep = base.withColumn("_nf", n_full).select(
        "row", "x", F.explode(F.sequence(F.col("step").cast("bigint"), F.lit(steps - 1).cast("bigint"),
                                         F.col("_nf").cast("bigint")))
        .alias("step"))
    return rep.select("step", "row", "x")


# --------------------------------------------------------------------------- P7
def pack_carry(with_offs: DataFrame, total: Column, steps: int, block: int = C.BLOCK_SIZE,
               batch: int = C.BATCH_SIZE) -> DataFrame:
    """Directory repetition. The stream is read over and over with the
    leftover carried into the next pass, so step k covers positions
    ``[k*B, (k+1)*B)`` of the endless stream (B = block*batch)."""
    per_step = block * batch
    need = F.lit(steps * per_step)
    tot = F.when(total < 1, F.raise_error(F.lit("empty corpus"))).otherwise(total)
    passes = F.ceil(need / tot)
    d = (with_offs.withColumn("_tot", tot).withColumn("_passes", passes)
         .select("ids", "n", "offset", "_tot",
                 F.explode(F.sequence(F.lit(0).cast("bigint"),
                                      (F.col("_passes") - 1).cast("bigint"))).alias("_pass"))
         .select("ids", "n", (F.col("offset") + F.col("_pass") * F.col("_tot")).alias("offset")))
    return pack_blocks(d, block, batch, F.lit(steps * batch)).select("step", "row", "x")


# --------------------------------------------------------------------------- P8
def limit_steps(blocks: DataFrame, steps: int = C.STEPS_PER_EPOCH) -> DataFrame:
    """An epoch stops after ``steps`` batches (a filter, not an unordered limit)."""
    return blocks.filter(F.col("step") < steps)


# --------------------------------------------------------------------------- P9
def with_epochs(blocks: DataFrame, epochs: int) -> DataFrame:
    """The same batches replayed for epochs 1..E (per-row generator)."""
    if epochs < 1:
        raise ValueError("epochs must be >= 1; use the streaming trainer for 'inf'")
    return blocks.select(F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"), "*")


# -------------------------------------------------------------------------- P10
def training_pairs(with_offs: DataFrame, total: Column, shift: int = 0,
                   block: int = C.BLOCK_SIZE, batch: int = C.BATCH_SIZE) -> DataFrame:
    """P10: ``(step, row, x, y)`` over full batches.

    ``shift=0`` copies x into y; ``shift=1`` makes y the stream one position
    ahead, so full batches are those of the first ``total - 1`` positions.
    """
    if shift == 0:
        fb = full_batches(with_offs, total, block, batch)
        return fb.select("step", "row", "x", F.col("x").alias("y"))
    if shift != 1:
        raise ValueError("shift must be 0 or 1")
    # windows of block + 1 ids, one block apart: x is all but the last id, y all but the first
    n_blocks = n_full_batches(total - 1, block, batch) * batch
    w = sliding_blocks(with_offs, total, block + 1, block).filter(F.col("window") < n_blocks)
    return w.select(F.floor(F.col("window") / batch).alias("step"), (F.col("window") % batch).alias("row"),
                    F.slice("x", 1, block).alias("x"), F.slice("x", 2, block).alias("y"))


# -------------------------------------------------------------------------- P11
def sliding_blocks(with_offs: DataFrame, total: Column, size: int = C.BLOCK_SIZE,
                   stride: int = C.BLOCK_SIZE) -> DataFrame:
    """Full windows ``[w*stride, w*stride + size)`` of the stream."""
    if size < 1 or stride < 1:
        raise ValueError("size and stride must be positive")
    w_max = F.floor((total - size) / stride)            # last full window
    d = with_offs.filter(F.col("n") > 0).withColumn("_wmax", w_max)
    lo = F.greatest(F.lit(0), F.ceil((F.col("offset") - size + 1) / stride))
    hi = F.least(F.floor((F.col("offset") + F.col("n") - 1) / stride), F.col("_wmax"))
    d = d.filter(lo <= hi).select("ids", "offset", "n",
                                  F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint")))
                                  .alias("window"))
    ws = F.col("window") * stride
    start = F.greatest(ws, F.col("offset"))
    end = F.least(ws + size, F.col("offset") + F.col("n"))
    sl = d.select("window", start.alias("start"),
                  F.slice("ids", (start - F.col("offset") + 1).cast("int"),
                          (end - start).cast("int")).alias("piece"))
    g = sl.groupBy("window").agg(F.sort_array(F.collect_list(F.struct("start", "piece"))).alias("_p"))
    return g.select("window", F.flatten(F.col("_p").getField("piece")).alias("x"))


# -------------------------------------------------------------------------- P12
def tail_ids(ids, n: int = C.BLOCK_SIZE) -> Column:
    """The last ``n`` ids (all of them when shorter)."""
    c = F.col(ids) if isinstance(ids, str) else ids
    k = F.least(F.size(c), F.lit(n))
    return F.when(k == 0, c).otherwise(F.slice(c, -k, k))
