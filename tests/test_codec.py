"""Codec: lossless pre-tokens, vocabulary layout, round trip, golden checksum."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindle import constants as C
from spindle.operators import codec
from spindle.plans import catalog as K

from conftest import SF001, SF01


def test_pretokens_are_lossless(spark):
    docs = K.documents(spark, SF001)
    bad = docs.filter(F.array_join(codec.pretokenize("text"), "") != F.col("text")).count()
    assert bad == 0


def test_vocab_layout(spark):
    v = K.vocab(spark, SF001)
    rows = {r.token_id: r for r in v.df.collect()}
    assert rows[65].token == "A" and rows[65].kind == "byte"
    assert rows[200].token == "�"
    assert rows[C.EOS_ID].token == C.EOS_TEXT
    words = sorted((r for r in rows.values() if r.kind == "word"), key=lambda r: r.token_id)
    assert words[0].token_id == C.FIRST_WORD_ID
    assert all((a.freq, b.token) >= (b.freq, a.token) or a.freq > b.freq for a, b in zip(words, words[1:]))
    assert sorted(rows) == list(range(len(rows)))


def test_round_trip_every_document(spark):
    v = K.vocab(spark, SF001)
    e = codec.encode(K.documents(spark, SF001), v)
    back = codec.decode_seq(e, v).select("doc_id", F.col("text").alias("back"))
    j = K.documents(spark, SF001).join(back, "doc_id")
    assert j.count() == 200
    assert j.filter(F.col("back") != F.col("text")).count() == 0


def test_byte_fallback_and_invalid_bytes(spark):
    v = K.vocab(spark, SF001)
    df = spark.createDataFrame([(0, "zzqx€ ok")], "doc_id bigint, text string")
    assert codec.decode_seq(codec.encode(df, v), v).collect()[0].text == "zzqx€ ok"
    lone = spark.createDataFrame([(0, [0xC3, 0xA9, 0xE2])], "doc_id bigint, ids array<int>")
    assert codec.decode_seq(lone, v).collect()[0].text == "é�"


def test_golden_checksum_sf001(spark):
    """FIXTURES 3.6 at sf0.01: counts and the weighted checksum of all ids."""
    v = K.vocab(spark, SF01)
    rows = codec.explode_pretokens(K.documents(spark, SF01))
    enc = codec.encode_exploded(rows, v)
    ex = enc.select("doc_id", "pos", "token", F.posexplode("ids").alias("q", "id"))
    agg = ex.agg(
        F.countDistinct("doc_id", "pos").alias("pre"),
        F.count("*").alias("n"),
        F.sum(((F.col("doc_id") + 7 * F.col("pos") + 13 * F.col("q") + 1) % 1009) * F.col("id")).alias("chk"),
    ).collect()[0]
    assert agg.pre == 470532
    assert agg.n == 1350852
    assert agg.chk == 259623016575
    assert enc.filter(F.col("ids")[0] < 256).count() == 112788


def test_vocab_and_encode_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for parts in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            v = K.vocab(spark, SF001)
            e = codec.encode(K.documents(spark, SF001), v)
            out.append((sorted(tuple(r) for r in v.df.select("token_id", "token").collect()),
                        sorted((r.doc_id, tuple(r.ids)) for r in e.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def test_separator_ends_every_row(spark):
    docs = spark.createDataFrame([(0, "a b"), (1, "")], "doc_id bigint, text string")
    v = codec.build_vocab(codec.explode_pretokens(docs), 10)
    plain = {r.doc_id: r.ids for r in codec.encode(docs, v).collect()}
    got = {r.doc_id: r.ids for r in codec.encode(docs, v, separator_id=256).collect()}
    assert got == {k: ids + [256] for k, ids in plain.items()}


def test_encode_is_one_pass(spark):
    """Rows stay where and as they are: no exchange, equal keys apart, null and empty texts kept."""
    texts = ["x y", "z w", None, "", "naïve ☃ x", "x y", " \n\tx"]
    df = spark.createDataFrame([("k", t) for t in texts], "key string, text string")
    v = codec.build_vocab(codec.explode_pretokens(df.limit(2), ("key",)), 3)
    words = {r.token: r.token_id for r in v.words().collect()}
    enc = codec.encode(df, v, keys=("key",), with_pretoken_count=True, separator_id=256)
    assert "Exchange" not in enc._jdf.queryExecution().executedPlan().toString()

    def plain(text):
        pieces = re.findall(r" ?[^\W\d_]+| ?\d+| ?[^\s\w]+|\s", text or "")
        return [i for t in pieces for i in ([words[t]] if t in words else t.encode())] + [256], len(pieces)

    assert sorted((r.ids, r.n_pretokens) for r in enc.collect()) == sorted(plain(t) for t in texts)


def test_text_is_not_shuffled(spark):
    """Queries that don't need an order of documents don't move their texts."""
    from spindle.plans import catalog as K
    for name in ("pretokenize", "scan_text_lines", "join_lines", "encode_lines", "token_counts"):
        plan = K.QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange rangepartitioning" not in plan and "Exchange hashpartitioning" not in plan, name


def test_encode_takes_a_bounded_number_of_pretokens_at_a_time(spark, monkeypatch):
    """A batch of any size is put together in slices of rows; the ids are those of the whole."""
    rows = [(1, "alpha beta " * 40), (2, None), (3, ""), (4, "caf\u00e9 \u4e2d\u6587 zzz"), (5, "alpha"), (6, "\U0001f600" * 9), (7, "beta x\ny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    v = codec.build_vocab(codec.explode_pretokens(docs.filter("doc_id in (1, 5)")), 3)
    ids = lambda **how: sorted((r.doc_id, r.ids, r.n_pretokens) for r in codec.encode(docs, v, with_pretoken_count=True, **how).collect())
    whole, ended = ids(), ids(separator_id=256)
    monkeypatch.setattr(codec, "SLICE_TOKENS", 8)
    assert ids() == whole and ids(separator_id=256) == ended
    back = codec.decode_seq(codec.encode(docs, v), v).collect()
    assert sorted((r.doc_id, r.text) for r in back) == [(i, t or "") for i, t in rows]
    batch = pa.RecordBatch.from_pydict({"_tokens": [["a"] * 5, None, ["b"] * 4, ["c"] * 20, []]})
    assert [s.num_rows for s in codec._row_slices(batch, "_tokens")] == [2, 1, 1, 1]


def test_the_vocabulary_is_counted_in_many_tasks_whatever_the_row_groups(spark, tmpdir_path, monkeypatch):
    """A table in one row group was cut into pre-tokens by one task."""
    rows = [(i % 7 or None, f"a b{i}") for i in range(400)] + [(1, None), (None, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmpdir_path}/t/documents.parquet")
    seen, build = [], codec.build_vocab
    monkeypatch.setattr(codec, "build_vocab", lambda tokens, size: seen.append(tokens) or build(tokens, size))
    v = K.vocab(spark, f"{tmpdir_path}/t")
    busy = seen[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(busy) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert {r.token: r.freq for r in v.df.filter("kind = 'word'").collect()}["a"] == 400
