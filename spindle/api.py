"""Train on a corpus, complete prompts: the two modes of use, on any tables.

A model is a folder with its vocabulary beside its counts, so it is resumed and
prompted by itself: ids mean the same as when it was trained.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle import constants as C
from spindle.operators import blocklist, codec, ngram, packing
from spindle.plans import generate
from spindle.session import written
from spindle.sources import corpus, sinks


def model_path(choice: str, base: str = ".") -> str:
    """Where the model of a dataset lives: ``gpt_<tag>``, inside a directory of texts if
    the choice is one, else below ``base``."""
    tag = corpus.corpus_tag(choice.rstrip("/") or choice)
    named = choice in C.NAMED_DATASETS or choice.endswith((".txt", ".parquet"))
    return os.path.join(base if named else choice, f"gpt_{tag}")


def encode_corpus(docs: DataFrame, vocab: codec.Vocab, separator_id: int | None = None) -> tuple[DataFrame, int]:
    """``(doc_id, ids, n, offset)`` of ``docs(doc_id, text)``, written once, and the number
    of ids; ``separator_id`` ends each document if given."""
    ordered = corpus.by_document(docs.select("doc_id", "text"), "doc_id")
    placed = packing.with_offsets(codec.encode(ordered, vocab, separator_id=separator_id), ordered=True)
    return placed, int(placed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n)


def train(docs: DataFrame, path: str, epochs: int = 1, vocab_size: int = C.DEFAULT_VOCAB_SIZE,
          steps: int | None = None, separator_id: int | None = None) -> int:
    """Train on ``docs(doc_id, text)`` and save to ``path``; returns the version written.

    A model that is there is resumed: its vocabulary encodes the corpus, and the new
    counts are added. All full batches are used, or with ``steps`` so many wrapped
    batches; every epoch adds the same batches.
    """
    if epochs < 1:
        raise ValueError("epochs must be >= 1; streaming.streams trains endlessly")
    spark = docs.sparkSession
    before = sinks.load_model(spark, path)
    if before is None:
        v = codec.build_vocab(codec.explode_pretokens(docs), vocab_size)
        vocab = codec.Vocab(written(v.df, "vocab"), v.size)
    else:
        vocab = sinks.load_vocab(spark, path)
    placed, total = encode_corpus(docs, vocab, separator_id)
    total = F.lit(total).cast("bigint")
    blocks = packing.full_batches(placed, total) if steps is None else packing.pack_wrap(placed, total, steps)
    model = ngram.train_ngrams(packing.with_epochs(blocks, epochs), vocab.n_ids(), ("epoch", "step", "row"),
                               vocab=vocab.digest())
    return sinks.save_model(model if before is None else ngram.merge_models(before, model), path, vocab=vocab)


def complete(prompts: DataFrame, path: str, config: generate.GenConfig = generate.GenConfig(),
             blocked_words: DataFrame | None = None, block_bytes: bool = False) -> DataFrame:
    """``seq_id, n_new, reason, text, continuation`` for ``prompts(seq_id, text)`` by the
    model saved at ``path``, without tokens that contain one of ``blocked_words(word)`` (and
    with ``block_bytes`` without single bytes, which could spell one)."""
    spark: SparkSession = prompts.sparkSession
    model, vocab = sinks.load_model(spark, path, required=True), sinks.load_vocab(spark, path)
    blocked = None
    if blocked_words is not None:
        blocked = blocklist.blocked_token_ids(vocab.df, blocked_words, block_bytes).select("token_id")
    encoded = written(codec.encode(prompts, vocab, keys=("seq_id",)), "prompts")
    state = generate.complete(encoded, model, config, blocked)
    return generate.with_text(state, vocab).select("seq_id", "n_new", "reason", "text", "continuation")
