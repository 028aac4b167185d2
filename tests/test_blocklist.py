"""Blocklist: normalisation edge cases and the equi-join against brute force."""

from pyspark.sql import functions as F

from spindle.operators import blocklist
from spindle.plans import catalog as K

from conftest import SF001


def test_normalize_rejects_null_and_empty(spark):
    w = spark.createDataFrame([("ThNt",), ("",), (None,), ("thnt",)], "word string")
    assert sorted(r.word for r in blocklist.normalize_blocklist(w).collect()) == ["thnt"]


def _brute(tokens, words):
    out = set()
    for t in tokens:
        s = t.lower().lstrip()
        if any(w in s for w in words):
            out.add(t)
    return out


def test_matches_brute_force_on_vocab(spark):
    v = K.vocab(spark, SF001)
    toks = [r.token for r in v.df.collect()]
    for words in (["er"], ["thnt", "blees"], ["The", "a", "xyzzy"]):
        wdf = spark.createDataFrame([(w,) for w in words], "word string")
        got = {r.token for r in blocklist.blocked_token_ids(v.df, wdf).collect()}
        assert got == _brute(toks, [w.lower() for w in words])


def test_word_inside_longer_token_and_split_word(spark):
    toks = spark.createDataFrame([(1, " Blees"), (2, "xblees!"), (3, " bl"), (4, "ees")],
                                 "token_id int, token string")
    w = spark.createDataFrame([("BLEES",)], "word string")
    got = sorted(r.token_id for r in blocklist.blocked_token_ids(toks, w).collect())
    assert got == [1, 2]   # a word split over two tokens passes


def test_mask_blocked(spark):
    sc = spark.createDataFrame([(0, 1, 1.0), (0, 2, 2.0)], "seq_id bigint, token_id int, score double")
    b = spark.createDataFrame([(2,)], "token_id int")
    got = {r.token_id: r.score for r in blocklist.mask_blocked(sc, b).collect()}
    assert got == {1: 1.0, 2: float("-inf")}


def test_block_bytes(spark):
    v = K.vocab(spark, SF001)
    words = spark.createDataFrame([("thnt",)], "word string")
    plain = {r.token_id for r in blocklist.blocked_token_ids(v.df, words).collect()}
    assert {r.token_id for r in blocklist.blocked_token_ids(v.df, words, block_bytes=True).collect()} == plain | set(range(256))
