"""Registered queries: one per operator key of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the driver's
tables, always over whole tables. Intermediates that later stages read more
than once (the vocabulary, the encoded corpus, an epoch of blocks, model
tables) are written once per query with ``checkpoint()`` into the shared
checkpoint folder; everything else stays one declarative plan. The matching
DuckDB SQL lives in ``spindle.plans.oracle``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle import constants as C
from spindle.functions.text import dataset_tag, ids_to_string
from spindle.operators import blocklist, bpe, codec, ngram, packing, scoring
from spindle.plans import generate
from spindle.session import scratch_path, written
from spindle.sources import corpus, sinks
from spindle.streaming import streams

# --- fixed values: parameters of the registered queries ----------------------
VOCAB_SIZE = 8192
BLOCKLIST_WORDS = ("thnt", "blees")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def documents(spark, sf_dir, ordered: bool = False) -> DataFrame:
    return corpus.read_corpus(spark, os.path.join(sf_dir, "documents.parquet"), ordered=ordered)


def vocab(spark, sf_dir) -> codec.Vocab:
    """The learned vocabulary, written once per plan (bounded by VOCAB_SIZE)."""
    docs = corpus.dealt_out(documents(spark, sf_dir))
    v = codec.build_vocab(codec.explode_pretokens(docs), VOCAB_SIZE)
    return codec.Vocab(written(v.df, "vocab"), v.size)


def encoded_docs(spark, sf_dir, v: codec.Vocab | None = None) -> DataFrame:
    """The encoded corpus ``(doc_id, ids)``, written once and reused downstream."""
    v = v or vocab(spark, sf_dir)
    return written(codec.encode(documents(spark, sf_dir), v), "encoded")


# ----------------------------------------------------------------- sources
def q_scan_corpus(spark, sf_dir):
    return documents(spark, sf_dir)


def q_scan_text_lines(spark, sf_dir):
    return corpus.text_lines(documents(spark, sf_dir))


def q_join_lines(spark, sf_dir):
    return corpus.with_separator(documents(spark, sf_dir))


def q_scan_prompts(spark, sf_dir):
    return corpus.read_prompts(table(spark, sf_dir, "conversations"))


def q_dataset_tag(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.col("page_id"), F.col("url"), dataset_tag("url").alias("tag"))


# ----------------------------------------------------------------- codec
def q_pretokenize(spark, sf_dir):
    return codec.explode_pretokens(documents(spark, sf_dir)) \
                .withColumn("pos", F.col("pos").cast("bigint"))


def q_build_vocab(spark, sf_dir):
    v = vocab(spark, sf_dir)
    return v.df.select(F.col("token_id").cast("bigint").alias("token_id"), "token", "kind", "freq")


def q_encode(spark, sf_dir):
    e = encoded_docs(spark, sf_dir)
    return e.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"),
                    ids_to_string("ids").alias("ids"))


def q_decode_token(spark, sf_dir):
    v = vocab(spark, sf_dir)
    e = encoded_docs(spark, sf_dir, v)
    used = (e.select(F.explode("ids").alias("token_id"))
            .groupBy("token_id").agg(F.count(F.lit(1)).alias("n_uses")))
    out = codec.decode_token(used, v)
    return out.select(F.col("token_id").cast("bigint").alias("token_id"), "token_text", "n_uses")


def q_decode_seq(spark, sf_dir):
    v = vocab(spark, sf_dir)
    e = encoded_docs(spark, sf_dir, v)
    return codec.decode_seq(e, v).select("doc_id", "text")


def q_token_counts(spark, sf_dir):
    e = codec.encode(documents(spark, sf_dir), vocab(spark, sf_dir), with_pretoken_count=True)
    return e.select("doc_id", "n_pretokens", F.size("ids").cast("bigint").alias("n_ids"))


def q_encode_lines(spark, sf_dir):
    lines = corpus.text_lines(documents(spark, sf_dir))
    e = codec.encode(lines, vocab(spark, sf_dir), keys=("doc_id", "line_no"), text_col="line")
    return e.select("doc_id", "line_no", F.size("ids").cast("bigint").alias("n_ids"),
                    ids_to_string("ids").alias("ids"))


# ----------------------------------------------------------------- packing
STEPS = C.STEPS_PER_EPOCH
EPOCHS = 2
SLIDE_SIZE, SLIDE_STRIDE = C.BLOCK_SIZE, C.BLOCK_SIZE // 2


def stream_parts(spark, sf_dir, v: codec.Vocab | None = None):
    """Encoded corpus with offsets (written once), and its total.

    The total is one number read once, so every cut (full batches, step caps)
    becomes a literal filter instead of a repeated scalar subquery.
    """
    v = v or vocab(spark, sf_dir)
    wo = packing.with_offsets(codec.encode(documents(spark, sf_dir, ordered=True), v), ordered=True)
    total = wo.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first().t
    return wo, F.lit(int(total)).cast("bigint")


def _blocks_out(df, cols=("step", "row")):
    return df.select(*[F.col(c).cast("bigint").alias(c) for c in cols],
                     F.size("x").cast("bigint").alias("n"), ids_to_string("x").alias("x"))


def q_token_offsets(spark, sf_dir):
    e = codec.encode(documents(spark, sf_dir), vocab(spark, sf_dir))
    lens = written(e.select("doc_id", F.size("ids").alias("n")), "lengths")      # only these are put in order
    return packing.token_offsets(lens).select("doc_id", F.col("n").alias("n_ids"), "offset")


def q_concat_stream(spark, sf_dir):
    wo, _ = stream_parts(spark, sf_dir)
    return packing.token_stream(wo).withColumn("token_id", F.col("token_id").cast("bigint"))


def q_pack_blocks(spark, sf_dir):
    wo, _ = stream_parts(spark, sf_dir)
    return _blocks_out(packing.pack_blocks(wo), ("block", "step", "row"))


def q_reshape_rows(spark, sf_dir):
    wo, _ = stream_parts(spark, sf_dir)
    r = packing.reshape(packing.token_stream(wo))
    return r.select("gpos", F.col("token_id").cast("bigint").alias("token_id"),
                    F.col("step").cast("bigint").alias("step"), F.col("row").cast("bigint").alias("row"),
                    F.col("col").cast("bigint").alias("col"))


def q_drop_remainder(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    return _blocks_out(packing.full_batches(wo, tot))


def q_pack_wrap(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    return _blocks_out(packing.pack_wrap(wo, tot, STEPS))


def q_pack_carry(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    return _blocks_out(packing.pack_carry(wo, tot, STEPS))


def q_steps_per_epoch(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    return _blocks_out(packing.limit_steps(packing.full_batches(wo, tot), STEPS))


def q_epochs(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    ep = packing.with_epochs(packing.pack_wrap(wo, tot, STEPS), EPOCHS)
    return _blocks_out(ep, ("epoch", "step", "row"))


def q_training_pairs(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    tp = packing.training_pairs(wo, tot, shift=1)
    return tp.select(F.col("step").cast("bigint").alias("step"), F.col("row").cast("bigint").alias("row"),
                     ids_to_string("x").alias("x"), ids_to_string("y").alias("y"))


def q_training_pairs_same(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    tp = packing.training_pairs(wo, tot, shift=0)
    return tp.select(F.col("step").cast("bigint").alias("step"), F.col("row").cast("bigint").alias("row"),
                     ids_to_string("x").alias("x"), ids_to_string("y").alias("y"))


def q_sliding_blocks(spark, sf_dir):
    wo, tot = stream_parts(spark, sf_dir)
    return _blocks_out(packing.sliding_blocks(wo, tot, SLIDE_SIZE, SLIDE_STRIDE), ("window",))


def encoded_prompts(spark, sf_dir):
    prompts = corpus.read_prompts(table(spark, sf_dir, "conversations"))
    return codec.encode(prompts, vocab(spark, sf_dir), keys=("seq_id",))


def q_truncate_context(spark, sf_dir):
    ep = encoded_prompts(spark, sf_dir)
    ctx = packing.tail_ids("ids", C.BLOCK_SIZE)
    return ep.select("seq_id", F.size("ids").cast("bigint").alias("n_ids"),
                     ids_to_string(ctx).alias("ctx"))


# ----------------------------------------------------------------- blocklist
def blocklist_words(spark) -> DataFrame:
    return spark.createDataFrame([(w,) for w in BLOCKLIST_WORDS], "word string")


def q_blocked_token_ids(spark, sf_dir):
    v = vocab(spark, sf_dir)
    b = blocklist.blocked_token_ids(v.df, blocklist_words(spark))
    return b.select(F.col("token_id").cast("bigint").alias("token_id"), "token")


def q_blocked_rate(spark, sf_dir):
    docs = documents(spark, sf_dir)
    pre = docs.select("doc_id", F.explode_outer(codec.pretokenize("text")).alias("token"))
    r = blocklist.blocked_rate(pre, blocklist_words(spark))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").cast("bigint").alias("toxic"))
    return r.join(labels, "doc_id", "left")


# ----------------------------------------------------------------- score chain
# Scores without a model: ``embeddings`` as (seq_id, token_id, score); history
# ids[i] = (vec_id + i % 3) % 64 for i = 0..7.
FIXTURE_BLOCKED = (5, 21, 37, 53)
TOP_P_FIXTURE = 0.9
SEED = 42
FIXTURE_EOS = 0


def fixture_scores(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return (e.select(F.col("vec_id").cast("bigint").alias("seq_id"),
                     F.posexplode("embedding").alias("token_id", "v"))
             .select("seq_id", F.col("token_id").cast("int").alias("token_id"),
                     (F.col("v").cast("double") * 10).alias("score")))


def fixture_seqs(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    ids = F.transform(F.sequence(F.lit(0), F.lit(7)),
                      lambda i: ((F.col("vec_id") + i % 3) % 64).cast("int"))
    return e.select(F.col("vec_id").cast("bigint").alias("seq_id"), ids.alias("ids"))


def fixture_blocked(spark) -> DataFrame:
    return spark.createDataFrame([(i,) for i in FIXTURE_BLOCKED], "token_id int")


def _chain(spark, sf_dir, upto: str) -> DataFrame:
    seqs = fixture_seqs(spark, sf_dir)
    s = scoring.temperature(fixture_scores(spark, sf_dir), C.TEMPERATURE)
    if upto == "temperature":
        return s
    s = blocklist.mask_blocked(s, fixture_blocked(spark))
    if upto == "mask_blocked":
        return s
    s = scoring.no_repeat_ngram(s, seqs, C.NO_REPEAT_NGRAM)
    if upto == "no_repeat_ngram":
        return s
    s = scoring.repetition_penalty(s, seqs, C.REPETITION_PENALTY)
    if upto == "repetition_penalty":
        return s
    s = scoring.softmax(s)
    if upto == "softmax":
        return s
    return scoring.suppress_last(s, seqs)


def _score_out(df):
    return df.select("seq_id", F.col("token_id").cast("bigint").alias("token_id"),
                     F.round("score", 6).alias("score"))


def _prob_out(df, rank=False):
    cols = ["seq_id", F.col("token_id").cast("bigint").alias("token_id")]
    if rank:
        cols.append(F.col("rank").cast("bigint").alias("rank"))
    return df.select(*cols, F.round("p", 6).alias("p"))


def q_temperature(spark, sf_dir):
    return _score_out(_chain(spark, sf_dir, "temperature"))


def q_mask_blocked(spark, sf_dir):
    return _score_out(_chain(spark, sf_dir, "mask_blocked"))


def q_no_repeat_ngram(spark, sf_dir):
    return _score_out(_chain(spark, sf_dir, "no_repeat_ngram"))


def q_repetition_penalty(spark, sf_dir):
    return _score_out(_chain(spark, sf_dir, "repetition_penalty"))


def q_softmax(spark, sf_dir):
    return _prob_out(_chain(spark, sf_dir, "softmax"))


def q_suppress_last(spark, sf_dir):
    return _prob_out(_chain(spark, sf_dir, "suppress_last"))


def q_top_k(spark, sf_dir):
    return _prob_out(scoring.top_k(_chain(spark, sf_dir, "suppress_last"), C.TOP_K), rank=True)


def q_top_p(spark, sf_dir):
    return _prob_out(scoring.top_p(_chain(spark, sf_dir, "suppress_last"), TOP_P_FIXTURE), rank=True)


def q_greedy(spark, sf_dir):
    g = scoring.greedy(_chain(spark, sf_dir, "suppress_last"))
    return g.select("seq_id", F.col("token_id").cast("bigint").alias("token_id"))


def _drawn(spark, sf_dir):
    kept = scoring.top_k(_chain(spark, sf_dir, "suppress_last"), C.TOP_K)
    return scoring.sample(kept, SEED, 0)


def q_sample_token(spark, sf_dir):
    d = _drawn(spark, sf_dir)
    return d.select("seq_id", F.col("token_id").cast("bigint").alias("token_id"),
                    F.round("u", 12).alias("u"))


def q_append_token(spark, sf_dir):
    a = scoring.append_token(fixture_seqs(spark, sf_dir), _drawn(spark, sf_dir))
    return a.select("seq_id", F.size("ids").cast("bigint").alias("n_ids"), ids_to_string("ids").alias("ids"))


def q_stop_rule(spark, sf_dir):
    d = _drawn(spark, sf_dir)
    reason = scoring.stop_flags(F.col("token_id"), F.lit(1), FIXTURE_EOS, C.MAX_NEW_TOKENS)
    return d.select("seq_id", F.col("token_id").cast("bigint").alias("token_id"), reason.alias("reason"))


def q_processor_chain(spark, sf_dir):
    seqs = fixture_seqs(spark, sf_dir)
    procs = [lambda d: scoring.no_repeat_ngram(d, seqs, C.NO_REPEAT_NGRAM),
             lambda d: scoring.repetition_penalty(d, seqs, C.REPETITION_PENALTY)]
    kept = scoring.processor_chain(fixture_scores(spark, sf_dir), seqs, fixture_blocked(spark),
                                   t=C.TEMPERATURE, k=C.TOP_K, p=None, processors=procs)
    return _prob_out(kept, rank=True)


# ----------------------------------------------------------------- count model
def corpus_blocks(spark, sf_dir, v: codec.Vocab):
    """All full batches of the encoded documents, and how many there are."""
    wo, tot = stream_parts(spark, sf_dir, v)
    return packing.full_batches(wo, tot), tot


def train(v: codec.Vocab, blocks: DataFrame) -> ngram.CountModel:
    return ngram.train_ngrams(blocks, v.n_ids(), max_ids=v.size + C.FIRST_WORD_ID, vocab=v.digest())


def written_model(v: codec.Vocab, blocks: DataFrame) -> ngram.CountModel:
    """The trained counts written once: the loss reads them five times."""
    m = train(v, blocks)
    return ngram.CountModel(written(m.counts, "counts"), m.n_ids, m.max_ids, m.vocab)


def _model_out(m: ngram.CountModel) -> DataFrame:
    return m.counts.select(*[F.col(c).cast("bigint").alias(c) for c in ("ord", "u", "v", "w", "cnt")])


def q_train_ngrams(spark, sf_dir):
    v = vocab(spark, sf_dir)
    return _model_out(train(v, corpus_blocks(spark, sf_dir, v)[0]))


def q_resume_train(spark, sf_dir):
    """Two halves of the corpus trained apart and added up."""
    v = vocab(spark, sf_dir)
    blocks = written(corpus_blocks(spark, sf_dir, v)[0], "blocks")
    half = blocks.agg(F.floor((F.max("step") + 1) / 2)).first()[0] or 0
    a = train(v, blocks.filter(F.col("step") < half))
    b = train(v, blocks.filter(F.col("step") >= half))
    return _model_out(ngram.merge_models(a, b))


def q_cross_entropy(spark, sf_dir):
    v = vocab(spark, sf_dir)
    blocks = written(corpus_blocks(spark, sf_dir, v)[0], "blocks")
    ce = ngram.cross_entropy(blocks, written_model(v, blocks))
    return ce.select(F.col("step").cast("bigint").alias("step"), F.round("loss", 6).alias("loss"))


def loss_series(spark, sf_dir) -> DataFrame:
    """``events.value`` as a loss series: one run per event type, ordered by id."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_type", "event_id", F.col("value").alias("loss"))


def q_running_mean_loss(spark, sf_dir):
    r = ngram.running_mean(loss_series(spark, sf_dir), "loss", "event_id", ("event_type",))
    return r.select("event_type", "event_id", "loss", F.round("mean_loss", 6).alias("mean_loss"))


def q_format_loss(spark, sf_dir):
    r = ngram.running_mean(loss_series(spark, sf_dir), "loss", "event_id", ("event_type",))
    f = ngram.format_loss(r)
    return f.select("event_type", "event_id", "raw_loss_text", "mean_loss_text")


# ----------------------------------------------------------------- completion


def _gen_inputs(spark, sf_dir):
    v = vocab(spark, sf_dir)
    model = train(v, corpus_blocks(spark, sf_dir, v)[0])
    tables = generate.ScoringTables.of(model)
    prompts = written(codec.encode(corpus.read_prompts(table(spark, sf_dir, "conversations")), v,
                                   keys=("seq_id",)), "prompts")
    blocked = blocklist.blocked_token_ids(v.df, blocklist_words(spark)).select("token_id")
    return v, model, tables, prompts, blocked


def q_next_token_scores(spark, sf_dir):
    _, _, tables, prompts, _ = _gen_inputs(spark, sf_dir)
    active = prompts.filter(F.size("ids") > 0)
    sc = generate.next_token_scores(active, tables, decimals=6)
    return sc.select("seq_id", F.col("token_id").cast("bigint").alias("token_id"), "score")


def _one_step(spark, sf_dir, **config):
    _, _, tables, prompts, blocked = _gen_inputs(spark, sf_dir)
    cfg = generate.GenConfig(seed=SEED, **config)
    st = generate.generate_step(generate.initial_state(prompts, cfg), tables, blocked, cfg, 0)
    return st.select("seq_id", F.col("n_new").cast("bigint").alias("n_new"),
                     F.element_at("ids", -1).cast("bigint").alias("last_id"), "reason")


def q_generate_step(spark, sf_dir):
    return _one_step(spark, sf_dir)


def q_nucleus_step(spark, sf_dir):
    """The same with top-p: each prompt's nucleus from the heads of the model's lists."""
    return _one_step(spark, sf_dir, top_p=TOP_P_FIXTURE)


def q_complete_batch(spark, sf_dir):
    v, model, tables, prompts, blocked = _gen_inputs(spark, sf_dir)
    st = generate.complete(prompts, model, generate.GenConfig(seed=SEED), blocked, tables)
    new = st.withColumn("_new", F.slice("ids", F.col("prompt_len") + 1, F.greatest("n_new", F.lit(0))))
    return codec.with_bytes(new, v, "_new", "continuation_hex").select(
        "seq_id", F.col("n_new").cast("bigint").alias("n_new"), "reason", ids_to_string("ids").alias("ids"), "continuation_hex")


# ----------------------------------------------------------------- sinks
#: New ids a prompt in the sink and stream queries (each delivery of a stream runs its own
#: steps, one after another); ``complete_batch`` runs the default.
STREAM_MAX_NEW = 16


def q_sink_completions(spark, sf_dir):
    v, model, tables, prompts, blocked = _gen_inputs(spark, sf_dir)
    cfg = generate.GenConfig(seed=SEED, max_new=STREAM_MAX_NEW)
    st = generate.complete(prompts, model, cfg, blocked, tables)
    path = scratch_path(spark, "completions")
    sinks.write_completions(st, v, path)
    back = spark.read.parquet(path)
    return back.select("seq_id", F.col("step").cast("bigint").alias("step"),
                       F.col("token_id").cast("bigint").alias("token_id"), "token_text")


def metrics_table(spark, sf_dir) -> DataFrame:
    v = vocab(spark, sf_dir)
    blocks = written(corpus_blocks(spark, sf_dir, v)[0], "blocks")
    ce = ngram.cross_entropy(blocks, written_model(v, blocks)).select(
        F.lit("run0").alias("run"), F.lit(1).alias("epoch"), "step", "loss")
    return ngram.format_loss(ngram.running_mean(ce, "loss", "step", ("run", "epoch")))


def q_sink_metrics(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(metrics_table(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.select("run", F.col("epoch").cast("bigint").alias("epoch"),
                       F.col("step").cast("bigint").alias("step"), F.round("loss", 6).alias("loss"),
                       F.round("mean_loss", 6).alias("mean_loss"))


def q_save_model(spark, sf_dir):
    path, v = scratch_path(spark, "model"), vocab(spark, sf_dir)
    sinks.save_model(train(v, corpus_blocks(spark, sf_dir, v)[0]), path, vocab=v)
    return _model_out(sinks.load_model(spark, path, required=True))


def q_load_model(spark, sf_dir):
    """Resume: load (absent -> fresh), train one more epoch, save, load again."""
    path, v = scratch_path(spark, "model"), vocab(spark, sf_dir)
    blocks = written(corpus_blocks(spark, sf_dir, v)[0], "blocks")
    first = sinks.load_model(spark, path, required=False)        # nothing saved yet
    m = train(v, blocks)
    if first is not None:
        m = ngram.merge_models(first, m)
    sinks.save_model(m, path, vocab=v)
    prev = sinks.load_model(spark, path, required=True)
    sinks.save_model(ngram.merge_models(prev, train(sinks.load_vocab(spark, path), blocks)), path, vocab=v)
    return _model_out(sinks.load_model(spark, path, required=True))


# ----------------------------------------------------------------- streaming
#: Deliveries in which a stream query's rows arrive.
STREAM_FILES = 4


def as_arriving(spark, df: DataFrame, key: str, name: str, read: Callable[[DataFrame], None]) -> None:
    """The rows of ``df`` arrive in a folder in ``STREAM_FILES`` deliveries, in ranges of
    ``key``, one after another; ``read`` runs its streaming query on the folder after each. What a
    delivery brought is one micro-batch, however many files its tasks wrote."""
    path = scratch_path(spark, name)
    bounds = df.select(F.percentile_approx(key, [i / STREAM_FILES for i in range(1, STREAM_FILES)]).alias("b")).first().b
    edges = [None, *sorted(set(bounds or [])), None]
    for lo, hi in zip(edges, edges[1:]):
        part = F.lit(True) if lo is None else F.col(key) >= lo
        part = part if hi is None else part & (F.col(key) < hi)
        df.filter(part if lo is not None else part | F.col(key).isNull()).write.mode("append").parquet(path)
        read(streams.stream_corpus(spark, path, df.schema, max_files_per_trigger=None))


def q_stream_corpus(spark, sf_dir):
    out, ckpt = scratch_path(spark, "stream-corpus"), scratch_path(spark, "ckpt")
    as_arriving(spark, documents(spark, sf_dir), "doc_id", "arriving",
                lambda stream: streams.write_stream_parquet(stream.select("doc_id", "text"), out, ckpt))
    return spark.read.parquet(out).select("doc_id", "text")


def q_stream_pack(spark, sf_dir):
    v = vocab(spark, sf_dir)
    out, state, ckpt = (scratch_path(spark, n) for n in ("stream-pack", "stream-state", "ckpt"))
    as_arriving(spark, documents(spark, sf_dir), "doc_id", "arriving",
                lambda stream: streams.stream_pack(
                    stream.select("doc_id", "text"), out, state, ckpt, ordered=True,
                    encode_fn=lambda mb: codec.encode(corpus.by_document(mb, "doc_id"), v)))
    return _blocks_out(spark.read.parquet(out))


def q_train_stream(spark, sf_dir):
    """Training while the documents arrive; the model that the versions add up to."""
    v = vocab(spark, sf_dir)
    path, ckpt = scratch_path(spark, "model"), scratch_path(spark, "train-stream")
    as_arriving(spark, documents(spark, sf_dir), "doc_id", "arriving",
                lambda stream: streams.train_stream(stream.select("doc_id", "text"), path, ckpt, v))
    return _model_out(sinks.load_model(spark, path, required=True))


def q_complete_stream(spark, sf_dir):
    v, model, tables, _, blocked = _gen_inputs(spark, sf_dir)
    cfg = generate.GenConfig(seed=SEED, max_new=STREAM_MAX_NEW)
    lists = generate.model_lists(tables, blocked)          # for all deliveries
    out, ckpt = scratch_path(spark, "stream-complete"), scratch_path(spark, "ckpt")
    as_arriving(spark, table(spark, sf_dir, "conversations"), "conv_id", "arriving", lambda stream: streams.complete_stream(
        corpus.read_prompts(stream),
        lambda mb: codec.encode(mb, v, keys=("seq_id",)),
        lambda enc: generate.complete(enc, model, cfg, blocked, tables, lists),
        out, ckpt))
    st = spark.read.parquet(out)
    return st.select("seq_id", F.col("n_new").cast("bigint").alias("n_new"), "reason", ids_to_string("ids").alias("ids"))


# ----------------------------------------------------------------- BPE
BPE_MERGES = 2000


def q_learn_merges(spark, sf_dir):
    toks = codec.explode_pretokens(documents(spark, sf_dir))
    return bpe.learn_merges(toks, BPE_MERGES).select(
        F.col("rank").cast("bigint").alias("rank"), "a", "b", "freq")


def q_bpe_encode(spark, sf_dir):
    docs = documents(spark, sf_dir)
    merges = bpe.learn_merges(codec.explode_pretokens(docs), BPE_MERGES)
    enc = bpe.bpe_encode_documents(docs, merges)
    return enc.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), ids_to_string("ids").alias("ids"))


def flagship(spark, sf_dir):
    """Minimum slice: documents -> pre-tokens -> vocab -> ids -> full batches."""
    return q_drop_remainder(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_corpus": q_scan_corpus,
    "scan_text_lines": q_scan_text_lines,
    "join_lines": q_join_lines,
    "scan_prompts": q_scan_prompts,
    "dataset_tag": q_dataset_tag,
    "pretokenize": q_pretokenize,
    "build_vocab": q_build_vocab,
    "encode": q_encode,
    "decode_token": q_decode_token,
    "decode_seq": q_decode_seq,
    "token_counts": q_token_counts,
    "encode_lines": q_encode_lines,
    "token_offsets": q_token_offsets,
    "concat_stream": q_concat_stream,
    "pack_blocks": q_pack_blocks,
    "reshape_rows": q_reshape_rows,
    "drop_remainder": q_drop_remainder,
    "pack_wrap": q_pack_wrap,
    "pack_carry": q_pack_carry,
    "steps_per_epoch": q_steps_per_epoch,
    "epochs": q_epochs,
    "training_pairs": q_training_pairs,
    "training_pairs_same": q_training_pairs_same,
    "sliding_blocks": q_sliding_blocks,
    "truncate_context": q_truncate_context,
    "blocked_token_ids": q_blocked_token_ids,
    "blocked_rate": q_blocked_rate,
    "temperature": q_temperature,
    "mask_blocked": q_mask_blocked,
    "no_repeat_ngram": q_no_repeat_ngram,
    "repetition_penalty": q_repetition_penalty,
    "softmax": q_softmax,
    "suppress_last": q_suppress_last,
    "top_k": q_top_k,
    "top_p": q_top_p,
    "greedy": q_greedy,
    "sample_token": q_sample_token,
    "append_token": q_append_token,
    "stop_rule": q_stop_rule,
    "processor_chain": q_processor_chain,
    "train_ngrams": q_train_ngrams,
    "resume_train": q_resume_train,
    "cross_entropy": q_cross_entropy,
    "running_mean_loss": q_running_mean_loss,
    "format_loss": q_format_loss,
    "next_token_scores": q_next_token_scores,
    "generate_step": q_generate_step,
    "nucleus_step": q_nucleus_step,
    "complete_batch": q_complete_batch,
    "sink_completions": q_sink_completions,
    "sink_metrics": q_sink_metrics,
    "save_model": q_save_model,
    "load_model": q_load_model,
    "stream_corpus": q_stream_corpus,
    "stream_pack": q_stream_pack,
    "train_stream": q_train_stream,
    "complete_stream": q_complete_stream,
    "learn_merges": q_learn_merges,
    "bpe_encode": q_bpe_encode,
}
