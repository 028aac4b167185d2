"""Sinks: S10-S13.

Model checkpoints are directories of Parquet tables, one per saved version. The
last table of a version is written when all others are there, and the latest
version is the highest one that has it: a reader never sees a half-written
model, and a failed save leaves the previous one as the latest.

A version is whole or a delta: counts to be added to those of the version it names as its
base. Reading adds up the chain, and every ``DELTAS_A_WHOLE`` deltas a version is written
whole, so a long run writes what it learnt, not the model, each time. The vocabulary is
written once, and later versions name the one that has it. Versions are never changed
after later ones are based on them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.operators.codec import Vocab, decode_token
from spindle.operators.ngram import CountModel, merge_models

DELTAS_A_WHOLE = 8        # deltas in a row before a version is written whole


# -------------------------------------------------------------------------- S10
def completion_tokens(state: DataFrame, vocab: Vocab) -> DataFrame:
    """One row per generated id: ``(seq_id, step, token_id, token_text)``."""
    new = F.slice("ids", F.col("prompt_len") + 1, 1 << 30)
    ex = (state.filter(F.col("n_new") > 0)
          .select("seq_id", F.posexplode(new).alias("step", "token_id")))
    return decode_token(ex, vocab, "token_id", "token_text")


def write_completions(state: DataFrame, vocab: Vocab, path: str) -> None:
    completion_tokens(state, vocab).write.mode("overwrite").parquet(path)


# -------------------------------------------------------------------------- S11
def write_metrics(metrics: DataFrame, path: str) -> None:
    """Per-step progress rows, partitioned by run and epoch. An epoch that is written
    again, as after a failure, replaces its rows; other epochs stay."""
    (metrics.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "epoch").parquet(path))


# ------------------------------------------------------------------ S12 / S13
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def _complete(spark: SparkSession, path: str, version: int) -> bool:
    fs, jvm = _fs(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"v={version}", "meta", "_SUCCESS")))


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The highest version that was written to its end."""
    fs, jvm = _fs(spark, path)
    top = jvm.org.apache.hadoop.fs.Path(path)
    if not fs.exists(top):
        return None
    names = [st.getPath().getName() for st in fs.listStatus(top)]
    found = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
    return max((v for v in found if _complete(spark, path, v)), default=None)


def save_model(model: CountModel, path: str, version: int | None = None, vocab: Vocab | None = None) -> int:
    """Write the counts, and the vocabulary if given, as a new version. Returns it.

    ``meta`` is written last and makes the version count; one that is rewritten
    (an explicit ``version``, as in a replay) doesn't count meanwhile.
    """
    if version is None:
        version = (latest_version(model.counts.sparkSession, path) or 0) + 1
    return _write_version(model, path, version, vocab)


def append_model(delta: CountModel, path: str, base: int, vocab: Vocab | None = None) -> int:
    """Write ``delta`` as version ``base + 1``, to be added to version ``base`` (0: none;
    then ``vocab`` is saved with it). Returns the version. Written again from the same
    base, as in a replay, it is the same version."""
    spark = delta.counts.sparkSession
    if not base:
        return _write_version(delta, path, 1, vocab)
    before = _meta(spark, _version(spark, path, True, base))
    if before.vocab != delta.vocab:
        raise ValueError("the models' ids belong to different vocabularies")
    if before.deltas + 1 < DELTAS_A_WHOLE:
        return _write_version(delta, path, base + 1, None, before, before.deltas + 1)
    whole = merge_models(load_model(spark, path, required=True, version=base), delta)
    return _write_version(whole, path, base + 1, None, before)


def _write_version(model: CountModel, path: str, version: int, vocab: Vocab | None, before=None, deltas: int = 0) -> int:
    """``before`` is the base's meta row, whose vocabulary goes on; ``deltas`` counts them
    since the last whole version (0: this one is whole)."""
    spark = model.counts.sparkSession
    vdir = os.path.join(path, f"v={version}")
    fs, jvm = _fs(spark, path)
    fs.delete(jvm.org.apache.hadoop.fs.Path(os.path.join(vdir, "meta")), True)
    model.counts.write.mode("overwrite").parquet(os.path.join(vdir, "counts"))
    name, size, vocab_at = model.vocab, None, None
    if vocab is not None:
        vocab.df.write.mode("overwrite").parquet(os.path.join(vdir, "vocab"))
        name, size, vocab_at = vocab.digest(), vocab.size, version
    elif before is not None:
        size, vocab_at = before["size"], before.vocab_at
    spark.range(1).select(model.n_ids.cast("bigint").alias("n_ids"), F.lit(name).cast("string").alias("vocab"),
                          F.lit(size).cast("int").alias("size"), F.lit(vocab_at).cast("int").alias("vocab_at"),
                          F.lit(version - 1 if deltas else 0).alias("base"), F.lit(deltas).alias("deltas")) \
         .write.mode("overwrite").parquet(os.path.join(vdir, "meta"))
    return version


def _meta(spark: SparkSession, vdir: str):
    return spark.read.parquet(os.path.join(vdir, "meta")).first()


def _version(spark: SparkSession, path: str, required: bool, version: int | None) -> str | None:
    if version is None:
        version = latest_version(spark, path)
    elif not _complete(spark, path, version):
        version = None
    if version is None and required:
        raise FileNotFoundError(f"no saved model at {path}")
    return None if version is None else os.path.join(path, f"v={version}")


def load_model(spark: SparkSession, path: str, required: bool = False,
               version: int | None = None) -> CountModel | None:
    """The latest (or a given) saved model; ``None`` if absent, an error if
    ``required``."""
    vdir = _version(spark, path, required, version)
    if vdir is None:
        return None
    counts = spark.read.parquet(os.path.join(vdir, "counts"))
    head = meta = _meta(spark, vdir)
    while meta.base:                    # at most DELTAS_A_WHOLE
        before = _version(spark, path, True, meta.base)
        counts = counts.unionByName(spark.read.parquet(os.path.join(before, "counts")))
        meta = _meta(spark, before)
    if head.base:
        counts = counts.groupBy("ord", "u", "v", "w").agg(F.sum("cnt").alias("cnt"))
    n_ids = spark.read.parquet(os.path.join(vdir, "meta")).select("n_ids").scalar()
    return CountModel(counts, n_ids, vocab=head.vocab)


def load_vocab(spark: SparkSession, path: str, version: int | None = None) -> Vocab:
    """The vocabulary saved with a model: with it a loaded model encodes and decodes."""
    vdir = _version(spark, path, True, version)
    meta = _meta(spark, vdir)
    if meta["size"] is None:
        raise FileNotFoundError(f"the model at {vdir} was saved without its vocabulary")
    return Vocab(spark.read.parquet(os.path.join(path, f"v={meta.vocab_at}", "vocab")), meta["size"])
