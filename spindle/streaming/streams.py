"""Structured Streaming: S8, P13, G4, training while text arrives.

Streams reuse the batch functions inside ``foreachBatch``. State that must
survive between micro-batches (the packing leftover, the next step number) is
a small table written under the state directory and *versioned by batch id*:
micro-batch ``b`` reads the carry of the latest batch before ``b`` and writes
its own, and every output of ``b`` is written with overwrite semantics to a
``batch=b`` folder. A replayed micro-batch (after a failure) therefore
recomputes the same rows from the same carry: the sink is idempotent.
The carry is bounded by one batch (``block * batch - 1`` ids).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spindle import constants as C
from spindle.operators import codec, ngram, packing
from spindle.operators.codec import Vocab
from spindle.session import scratch_removed
from spindle.sources import corpus, sinks

CARRY_SCHEMA = "batch_id bigint, next_step bigint, leftover array<int>"


# --------------------------------------------------------------------------- S8
def stream_corpus(spark: SparkSession, path: str, schema: StructType | str,
                  fmt: str = "parquet", max_files_per_trigger: int | None = 1,
                  glob: str | None = None) -> DataFrame:
    """Rows of a growing directory as they arrive (one file per trigger by
    default, so arrival order follows file modification time)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def run_to_end(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Drive a streaming query over everything available now, then stop."""
    q = (df.writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def write_stream_parquet(df: DataFrame, out: str, checkpoint: str) -> None:
    """S8 sink: each micro-batch to ``out/batch=<id>`` (overwrite = idempotent)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
    run_to_end(df, sink, checkpoint)


# -------------------------------------------------------------------------- P13
def _latest_carry(spark: SparkSession, state_dir: str, batch_id: int) -> DataFrame:
    """The carry written by the latest micro-batch before ``batch_id``."""
    carry_dir = os.path.join(state_dir, "carry")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(carry_dir)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prev = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("batch_id="):
                b = int(name.split("=", 1)[1])
                if b < batch_id and fs.exists(jvm.org.apache.hadoop.fs.Path(
                        os.path.join(carry_dir, name, "_SUCCESS"))):
                    prev.append(b)
    if not prev:
        return spark.createDataFrame([(-1, 0, [])], CARRY_SCHEMA)
    b = max(prev)
    return spark.read.parquet(os.path.join(carry_dir, f"batch_id={b}")) \
                .select(F.lit(b).cast("bigint").alias("batch_id"), "next_step", "leftover")


def pack_micro_batch(encoded: DataFrame, carry: DataFrame, block: int = C.BLOCK_SIZE,
                     batch: int = C.BATCH_SIZE, ordered: bool = False):
    """Pack ``carry.leftover + encoded (in doc_id order)`` into full batches. The leftover
    comes first whatever the ids are (null, negative, text). ``ordered`` says that ``encoded``
    is range-partitioned by ``doc_id``: its rows stay where they are, after the leftover's.

    Returns ``(blocks(step, row, x), new_carry(next_step, leftover))``.
    """
    per_step = block * batch
    kind = encoded.schema["doc_id"].dataType
    place = (lambda arrived, doc: doc.alias("place")) if ordered else (
        lambda arrived, doc: F.struct(F.lit(arrived).alias("arrived"), doc.alias("doc_id")).alias("place"))
    lead = carry.select(place(0, F.lit(None).cast(kind)), F.col("leftover").alias("ids"))
    docs = lead.unionByName(encoded.select(place(1, F.col("doc_id")), "ids"))
    wo = packing.with_offsets(docs, key="place", ordered=ordered)
    total = wo.select(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).scalar()
    start = carry.select("next_step").scalar()
    n_full = F.floor(total / F.lit(per_step))
    blocks = packing.pack_blocks(wo, block, batch, n_full * batch) \
                    .select((F.col("step") + start).alias("step"), "row", "x")
    # leftover: every id at or after n_full * per_step (fewer than one batch)
    cut = n_full * per_step
    tail = (wo.filter(F.col("offset") + F.col("n") > cut)
              .select(F.greatest(cut - F.col("offset"), F.lit(0)).alias("_skip"), "offset", "ids")
              .select("offset", F.slice("ids", (F.col("_skip") + 1).cast("int"), 1 << 30).alias("ids")))
    new_carry = tail.agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_p")) \
        .select((start + n_full).alias("next_step"),
                F.coalesce(F.flatten(F.col("_p").getField("ids")),
                           F.array().cast("array<int>")).alias("leftover"))
    return blocks, new_carry


def stream_pack(stream: DataFrame, out: str, state_dir: str, checkpoint: str,
                block: int = C.BLOCK_SIZE, batch: int = C.BATCH_SIZE,
                encode_fn: Callable[[DataFrame], DataFrame] | None = None, ordered: bool = False) -> None:
    """Pack while rows arrive; the leftover is carried between micro-batches.

    ``stream`` yields ``(doc_id, ids)``, or raw rows that ``encode_fn`` turns
    into them inside each micro-batch (the encode regroup is a batch
    aggregation there). Within a micro-batch documents are ordered by ``doc_id``; ``ordered``
    says that ``encode_fn`` leaves them range-partitioned by it (see ``corpus.by_document``).
    """
    def sink(mb: DataFrame, batch_id: int) -> None:
        spark = mb.sparkSession
        carry = _latest_carry(spark, state_dir, batch_id)
        enc = encode_fn(mb) if encode_fn is not None else mb
        # the rows with offsets are written once, and both outputs read them
        with scratch_removed(spark):
            blocks, new_carry = pack_micro_batch(enc, carry, block, batch, ordered)
            blocks.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
            new_carry.write.mode("overwrite").parquet(
                os.path.join(state_dir, "carry", f"batch_id={batch_id}"))
    run_to_end(stream, sink, checkpoint)


def read_carry(spark: SparkSession, state_dir: str) -> DataFrame:
    """The latest leftover (what the next arrival will be packed after)."""
    return _latest_carry(spark, state_dir, 1 << 62)


# ------------------------------------------------- training while text arrives
def train_sink(model_path: str, state_dir: str, base: int, vocab: Vocab, block: int = C.BLOCK_SIZE,
               batch: int = C.BATCH_SIZE) -> Callable[[DataFrame, int], None]:
    """Train on the full batches that a micro-batch of ``(doc_id, text)`` completes; ids
    short of a batch wait in the carry. Micro-batch ``b`` adds its counts as version
    ``base + b + 1`` to version ``base + b`` and then writes its carry: a replay reads the
    same carry and writes the same version, so nothing counts twice."""
    digest = vocab.digest()

    def sink(mb: DataFrame, batch_id: int) -> None:
        spark = mb.sparkSession
        with scratch_removed(spark):
            carry = _latest_carry(spark, state_dir, batch_id)
            # the text is put in order, and encoded once: ranges are drawn from what moves
            enc = codec.encode(corpus.by_document(mb, "doc_id"), vocab)
            blocks, new_carry = pack_micro_batch(enc, carry, block, batch, ordered=True)
            delta = ngram.train_ngrams(blocks, vocab.n_ids(), vocab=digest)
            sinks.append_model(delta, model_path, base + batch_id, vocab)
            new_carry.write.mode("overwrite").parquet(os.path.join(state_dir, "carry", f"batch_id={batch_id}"))
    return sink


def train_stream(stream: DataFrame, model_path: str, checkpoint: str, vocab: Vocab | None = None,
                 block: int = C.BLOCK_SIZE, batch: int = C.BATCH_SIZE) -> None:
    """Train on ``stream(doc_id, text)`` as it arrives, until all that is there is read; run
    again with the same ``checkpoint`` it goes on with what came since. The model saved at
    ``model_path`` is resumed with its own vocabulary; a new one needs ``vocab``. Equal to
    training on the full batches of all texts in the order of arrival, by ``doc_id``
    within a micro-batch."""
    spark = stream.sparkSession
    base = run_base(spark, model_path, checkpoint)
    if base:
        vocab = sinks.load_vocab(spark, model_path, version=base)
    elif vocab is None:
        raise ValueError("a new model needs a vocabulary")
    run_to_end(stream, train_sink(model_path, os.path.join(checkpoint, "state"), base, vocab, block, batch),
               os.path.join(checkpoint, "stream"))


# --------------------------------------------------------------------------- G4
def complete_stream(prompt_stream: DataFrame, encode_fn: Callable[[DataFrame], DataFrame],
                    complete_fn: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> None:
    """Answer prompts as they arrive. Each micro-batch is encoded, completed
    with the batch plan, and written to ``out/batch_id=<id>`` (idempotent)."""
    def sink(mb: DataFrame, batch_id: int) -> None:
        done = complete_fn(encode_fn(mb))
        done.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
    run_to_end(prompt_stream, sink, checkpoint)


# ----------------------------------------------------------------- P9 (inf)
def epoch_sink(blocks: DataFrame, n_ids, model_path: str, base: int = 0,
               vocab: Vocab | None = None) -> Callable[[DataFrame, int], None]:
    """One epoch per micro-batch: train on ``blocks`` and add to the model before. Batch
    ``b`` writes version ``base + b + 1``, a delta on version ``base + b``, so a replayed
    batch rewrites the same version and nothing up to ``base`` is ever written. The
    vocabulary of the version before, else ``vocab``, goes on with the model."""
    def sink(_ticks: DataFrame, batch_id: int) -> None:
        spark = blocks.sparkSession
        before = base + batch_id
        saved = sinks.load_model(spark, model_path, required=True, version=before) if before else None
        name = saved.vocab if saved is not None else vocab.digest() if vocab is not None else None
        sinks.append_model(ngram.train_ngrams(blocks, n_ids, vocab=name), model_path, before, vocab)
    return sink


def run_base(spark: SparkSession, model_path: str, checkpoint: str) -> int:
    """The model version that a run started from (0: none), noted once beside its stream
    checkpoint, so that a restarted run goes on from there."""
    note = os.path.join(checkpoint, "base")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(note, "_SUCCESS"))
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        base = sinks.latest_version(spark, model_path) or 0
        spark.range(1).select(F.lit(base).alias("base")).write.mode("overwrite").parquet(note)
    return spark.read.parquet(note).first()["base"]


def train_epochs_forever(blocks: DataFrame, n_ids, model_path: str, checkpoint: str,
                         seconds_per_epoch: int = 1, vocab: Vocab | None = None):
    """P9 with ``epochs='inf'``: a rate source ticks, each micro-batch is one
    epoch over the same batches (see ``epoch_sink``), added to the model saved at
    ``model_path`` if there is one; returns the running query, which the caller stops.
    Every epoch reads ``blocks`` from its source again, as every epoch of the original
    reopens its data."""
    spark = blocks.sparkSession
    base = run_base(spark, model_path, checkpoint)
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (ticks.writeStream.foreachBatch(epoch_sink(blocks, n_ids, model_path, base, vocab))
            .option("checkpointLocation", os.path.join(checkpoint, "stream"))
            .trigger(processingTime=f"{seconds_per_epoch} seconds").start())
