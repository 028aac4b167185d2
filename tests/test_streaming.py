"""Streaming: carry across micro-batches (FIXTURES 3.2) and stream = batch."""

import os
import shutil
import time

import pytest

from pyspark.sql import functions as F

from spindle.streaming import streams


def test_stream_carry_goldens(spark, tmpdir_path):
    src = f"{tmpdir_path}/in"
    os.makedirs(src)
    for f, base in enumerate((0, 10, 20)):
        rows = [(base + d, [base + d] * 3) for d in range(3)]
        spark.createDataFrame(rows, "doc_id bigint, ids array<int>").coalesce(1) \
             .write.parquet(f"{src}/f{f}")
        time.sleep(1.1)
    # flatten into one directory of files with ascending modification times
    flat = f"{tmpdir_path}/flat"
    os.makedirs(flat)
    for f in range(3):
        part = [p for p in os.listdir(f"{src}/f{f}") if p.endswith(".parquet")][0]
        os.link(f"{src}/f{f}/{part}", f"{flat}/f{f}.parquet")
        os.utime(f"{flat}/f{f}.parquet", (1_000_000 + f, 1_000_000 + f))
    stream = streams.stream_corpus(spark, flat, "doc_id bigint, ids array<int>")
    out, state = f"{tmpdir_path}/out", f"{tmpdir_path}/state"
    streams.stream_pack(stream, out, state, f"{tmpdir_path}/ckpt", block=4, batch=1)
    got = spark.read.parquet(out).orderBy("step").collect()
    by_batch = {}
    for r in got:
        by_batch.setdefault(r.batch_id, []).append(r.x)
    assert by_batch == {0: [[0, 0, 0, 1], [1, 1, 2, 2]], 1: [[2, 10, 10, 10], [11, 11, 11, 12]],
                        2: [[12, 12, 20, 20], [20, 21, 21, 21]]}
    assert streams.read_carry(spark, state).collect()[0].leftover == [22, 22, 22]
    assert [r.step for r in got] == list(range(6))


def test_epochs_forever_is_replay_safe(spark, tmpdir_path):
    from spindle.operators import ngram
    from spindle.sources import sinks
    blocks = spark.createDataFrame([(0, 0, [1, 2, 3, 1])], "step bigint, row bigint, x array<int>")
    path = f"{tmpdir_path}/m"
    sink = streams.epoch_sink(blocks, F.lit(4), path)
    empty = spark.range(0)
    sink(empty, 0)
    sink(empty, 1)
    sink(empty, 1)          # replay of batch 1 rewrites version 2
    m = sinks.load_model(spark, path, required=True)
    one = ngram.train_ngrams(blocks, F.lit(4)).counts
    want = sorted((r.ord, r.u, r.v, r.w, 2 * r.cnt) for r in one.collect())
    assert sorted((r.ord, r.u, r.v, r.w, r.cnt) for r in m.counts.collect()) == want


def test_epochs_forever_runs(spark, tmpdir_path):
    from spindle.sources import sinks
    blocks = spark.createDataFrame([(0, 0, [1, 2, 3])], "step bigint, row bigint, x array<int>")
    q = streams.train_epochs_forever(blocks, F.lit(4), f"{tmpdir_path}/m", f"{tmpdir_path}/ck")
    try:
        deadline = time.time() + 90
        while time.time() < deadline and (sinks.latest_version(spark, f"{tmpdir_path}/m") or 0) < 2:
            time.sleep(1)
    finally:
        q.stop()
    assert (sinks.latest_version(spark, f"{tmpdir_path}/m") or 0) >= 2


def test_micro_batch_replay_is_idempotent(spark, tmpdir_path):
    """Re-running the sink of a batch id (as after a failure) rewrites the same rows."""
    enc = spark.createDataFrame([(0, [1, 2, 3]), (1, [4, 5, 6, 7, 8])], "doc_id bigint, ids array<int>")
    state = f"{tmpdir_path}/state"
    carry0 = streams._latest_carry(spark, state, 0)
    blocks, carry = streams.pack_micro_batch(enc, carry0, block=3, batch=1)
    first = sorted((r.step, tuple(r.x)) for r in blocks.collect())
    carry.write.mode("overwrite").parquet(f"{state}/carry/batch_id=0")
    again_carry = streams._latest_carry(spark, state, 0)       # replay of batch 0 reads the same carry
    blocks2, _ = streams.pack_micro_batch(enc, again_carry, block=3, batch=1)
    assert sorted((r.step, tuple(r.x)) for r in blocks2.collect()) == first == [(0, (1, 2, 3)), (1, (4, 5, 6))]
    nxt = streams._latest_carry(spark, state, 1).collect()[0]
    assert (nxt.next_step, nxt.leftover) == (2, [7, 8])


def test_epochs_forever_adds_to_a_saved_model(spark, tmpdir_path):
    """A run starts from the saved model, never writes over it, and goes on after a restart."""
    from spindle.operators import ngram
    from spindle.sources import sinks
    blocks = spark.createDataFrame([(0, 0, [1, 2, 3, 1])], "step bigint, row bigint, x array<int>")
    path, empty = f"{tmpdir_path}/m", spark.range(0)
    sinks.save_model(ngram.train_ngrams(blocks, F.lit(4)), path)
    total = lambda v: sinks.load_model(spark, path, True, v).counts.agg(F.sum("cnt")).first()[0]
    one = total(1)
    base = streams.run_base(spark, path, f"{tmpdir_path}/ck")
    assert base == 1
    streams.epoch_sink(blocks, F.lit(4), path, base)(empty, 0)
    again = streams.run_base(spark, path, f"{tmpdir_path}/ck")          # restarted: same base
    assert again == 1
    streams.epoch_sink(blocks, F.lit(4), path, again)(empty, 0)         # batch 0 replayed
    streams.epoch_sink(blocks, F.lit(4), path, again)(empty, 1)
    assert (total(1), total(2), total(3)) == (one, 2 * one, 3 * one)
    assert sinks.latest_version(spark, path) == 3


def test_unfinished_version_does_not_count_and_vocabulary_is_saved(spark, tmpdir_path):
    import shutil

    import pytest
    from spindle.operators import codec, ngram
    from spindle.sources import sinks
    docs = spark.createDataFrame([(0, "one two one")], "doc_id bigint, text string")
    v = codec.build_vocab(codec.explode_pretokens(docs), 10)
    blocks = spark.createDataFrame([(0, 0, [1, 2])], "step bigint, row bigint, x array<int>")
    path = f"{tmpdir_path}/m"
    for _ in range(2):
        sinks.save_model(ngram.train_ngrams(blocks, v.n_ids()), path, vocab=v)
    shutil.rmtree(f"{path}/v=2/meta")
    assert sinks.latest_version(spark, path) == 1
    loaded = sinks.load_vocab(spark, path)
    assert loaded.digest() == v.digest() == sinks.load_model(spark, path).vocab
    enc = codec.encode(docs, loaded)
    assert codec.decode_seq(enc, loaded).first().text == "one two one"
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        codec.decode_seq(spark.createDataFrame([(0, [99_999])], "doc_id bigint, ids array<int>"), loaded).collect()


def test_metrics_of_an_epoch_written_twice(spark, tmpdir_path):
    from spindle.sources import sinks
    rows = spark.createDataFrame([("r", e, s, 1.0) for e in (1, 2) for s in range(3)],
                                 "run string, epoch int, step bigint, loss double")
    sinks.write_metrics(rows, f"{tmpdir_path}/x")
    sinks.write_metrics(rows.where("epoch = 2"), f"{tmpdir_path}/x")
    assert spark.read.parquet(f"{tmpdir_path}/x").count() == 6


def test_epochs_forever_keep_the_vocabulary(spark, tmpdir_path):
    """Train, one more epoch by the endless loop's sink, then complete and train again."""
    from spindle import api
    from spindle.plans.generate import GenConfig
    from spindle.sources import sinks
    docs = spark.createDataFrame([(i, "one two three four five " * 60) for i in range(40)], "doc_id long, text string")
    path = f"{tmpdir_path}/m"
    api.train(docs, path)
    vocab, model = sinks.load_vocab(spark, path), sinks.load_model(spark, path, required=True)
    blocks = spark.createDataFrame([(0, 0, [257, 258, 259, 260])], "step bigint, row bigint, x array<int>")
    before = model.counts.agg(F.sum("cnt")).first()[0]
    streams.epoch_sink(blocks, vocab.n_ids(), path, base=1)(spark.range(0), 0)
    assert sinks.load_model(spark, path, required=True).counts.agg(F.sum("cnt")).first()[0] == before + 9
    prompts = spark.createDataFrame([("a", "one two")], "seq_id string, text string")
    assert api.complete(prompts, path, GenConfig(max_new=2, seed=1)).count() == 1
    assert api.train(docs, path) == 3


def test_models_without_a_named_vocabulary_are_not_added(spark):
    from spindle.operators import ngram
    blocks = spark.createDataFrame([(0, 0, [1, 2, 3])], "step bigint, row bigint, x array<int>")
    with pytest.raises(ValueError, match="vocabularies"):
        ngram.merge_models(ngram.train_ngrams(blocks, F.lit(4), vocab="a"), ngram.train_ngrams(blocks, F.lit(4)))


def _texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, text string")


def _trigram_counts(m):
    return {(r.ord, r.u, r.v, r.w): r.cnt for r in m.counts.collect()}


def test_training_while_text_arrives_equals_batch_training(spark, tmpdir_path):
    """Text ids and a null one, a delivery without a full batch, a replay after each half of
    a micro-batch, a second run: every position counts once."""
    from spindle.operators import codec, ngram, packing
    from spindle.session import ensure_checkpoint_dir
    from spindle.sources import sinks
    deliveries = [[(None, "one two three four one two"), ("a", "three four five")], [("b", "six")], [],
                  [("c", "one two one two three three six seven eight nine ten one two three")],
                  [("d", "five five five five six six")]]
    everything = _texts(spark, [r for d in deliveries for r in d])
    vocab = codec.build_vocab(codec.explode_pretokens(everything.withColumn("doc_id", F.lit(1))), 30)
    ids = [i for r in codec.encode(everything.withColumn("doc_id", F.coalesce("doc_id", F.lit(""))), vocab).orderBy("doc_id").collect() for i in r.ids]
    rows = [(0, k, ids[4 * k:4 * k + 4]) for k in range(len(ids) // 8 * 2)]
    blocks = spark.createDataFrame(rows, "step bigint, row bigint, x array<int>")
    want = _trigram_counts(ngram.train_ngrams(blocks, vocab.n_ids()))

    path, state = f"{tmpdir_path}/m", f"{tmpdir_path}/state"
    sink = streams.train_sink(path, state, 0, vocab, block=4, batch=2)
    scratch = lambda: {n for n in os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")) if n.startswith("offsets-")}
    before = scratch()
    for b, rows in enumerate(deliveries):
        sink(_texts(spark, rows), b)
        sink(_texts(spark, rows), b)                                        # whole micro-batch replayed
        if b == 3:
            shutil.rmtree(f"{state}/carry/batch_id={b}")                    # lost after the model was written
            sink(_texts(spark, rows), b)
    assert scratch() == before
    model = sinks.load_model(spark, path, required=True)
    assert _trigram_counts(model) == want and model.vocab == vocab.digest()
    assert [n for n in sorted(os.listdir(path)) if os.path.exists(f"{path}/{n}/vocab")] == ["v=1"]


def test_deltas_add_up_and_are_written_whole_now_and_then(spark, tmpdir_path):
    from spindle.operators import ngram
    from spindle.sources import sinks
    blocks = spark.createDataFrame([(0, 0, [1, 2, 3])], "step bigint, row bigint, x array<int>")
    delta = ngram.train_ngrams(blocks, F.lit(4), vocab="a")
    path = f"{tmpdir_path}/m"
    for base in range(sinks.DELTAS_A_WHOLE + 2):
        assert sinks.append_model(delta, path, base) == base + 1
    n = sinks.DELTAS_A_WHOLE
    for version in (1, 3, n, n + 1, n + 2):
        got = sinks.load_model(spark, path, version=version)
        assert set(_trigram_counts(got).values()) == {version}
    metas = [spark.read.parquet(f"{path}/v={v}/meta").first().base for v in range(1, n + 3)]
    assert [v for v, base in enumerate(metas, 1) if not base] == [1, n + 1]
    with pytest.raises(ValueError, match="vocabularies"):
        sinks.append_model(ngram.train_ngrams(blocks, F.lit(4), vocab="b"), path, 2)


def test_train_stream_goes_on_where_it_stopped(spark, tmpdir_path):
    from spindle.operators import codec
    from spindle.sources import sinks
    docs = spark.createDataFrame([(i, "one two three four five six seven eight") for i in range(6)], "doc_id bigint, text string")
    vocab = codec.build_vocab(codec.explode_pretokens(docs), 20)
    arriving, path, ckpt = f"{tmpdir_path}/in", f"{tmpdir_path}/m", f"{tmpdir_path}/ckpt"
    docs.filter("doc_id < 4").write.parquet(arriving)
    stream = lambda: streams.stream_corpus(spark, arriving, docs.schema, max_files_per_trigger=None)
    with pytest.raises(ValueError, match="vocabulary"):
        streams.train_stream(stream(), path, f"{tmpdir_path}/none")
    streams.train_stream(stream(), path, ckpt, vocab, block=8, batch=3)     # 32 ids: one batch, 8 wait
    total = lambda: sinks.load_model(spark, path, required=True).counts.filter("ord = 1").agg(F.sum("cnt")).first()[0]
    assert total() == 24
    docs.filter("doc_id >= 4").write.mode("append").parquet(arriving)
    streams.train_stream(stream(), path, ckpt, vocab, block=8, batch=3)
    assert total() == 48
    streams.train_stream(stream(), path, ckpt, vocab, block=8, batch=3)
    assert total() == 48


def test_a_delivery_of_many_files_is_one_micro_batch(spark, tmpdir_path, monkeypatch):
    """Whatever the order in which the tasks' files were finished, and however many they are."""
    from spindle.plans import catalog
    rows = [(i * 7919 % 600, " ".join(f"w{(i * j) % 97}" for j in range(60))) for i in range(600)] + [(None, "no id " * 50)]
    (spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12).write.parquet(f"{tmpdir_path}/documents.parquet"))
    batches, run = [], streams.run_to_end
    monkeypatch.setattr(streams, "run_to_end", lambda df, sink, ckpt: run(
        df, lambda mb, b: (batches.append((b, mb.count())), sink(mb, b)), ckpt))
    got = catalog.q_stream_pack(spark, tmpdir_path).collect()
    assert [b for b, _ in batches] == list(range(catalog.STREAM_FILES)) and sum(n for _, n in batches) == 601
    assert sorted(got) == sorted(catalog.q_drop_remainder(spark, tmpdir_path).collect()) != []


def test_packing_ordered_rows_leaves_them_where_they_are(spark):
    from spindle.sources import corpus
    rows = [(None, [1, 2]), (-5, [3]), (-5, [3]), *((i, [i] * (i % 4)) for i in range(40))]
    enc = spark.createDataFrame(rows, "doc_id bigint, ids array<int>")
    carry = spark.createDataFrame([(3, 7, [91, 92, 93])], streams.CARRY_SCHEMA)
    want = streams.pack_micro_batch(enc, carry, block=4, batch=2)
    got = streams.pack_micro_batch(corpus.by_document(enc, "doc_id"), carry, block=4, batch=2, ordered=True)
    for a, b in zip(want, got):
        assert sorted(a.collect()) == sorted(b.collect()) != []
    with pytest.raises(ValueError, match="ranges"):
        streams.pack_micro_batch(enc.repartition(4, "ids"), carry, block=4, batch=2, ordered=True)
