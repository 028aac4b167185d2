"""Score-chain goldens (hand-computed) and sampler draws."""

import math

import pytest
from pyspark.sql import functions as F

from spindle.operators import blocklist, scoring

SCORES = {0: 2.0, 1: 1.5, 2: 1.0, 3: 3.0, 4: 0.5, 5: -1.0}
HISTORY = [1, 2, 3, 1, 2]


def _inputs(spark):
    sc = spark.createDataFrame([(0, k, v) for k, v in SCORES.items()],
                               "seq_id bigint, token_id int, score double")
    seqs = spark.createDataFrame([(0, HISTORY)], "seq_id bigint, ids array<int>")
    blocked = spark.createDataFrame([(4,)], "token_id int")
    return sc, seqs, blocked


def _processed(spark):
    sc, seqs, blocked = _inputs(spark)
    s = scoring.temperature(sc, 0.8)
    s = blocklist.mask_blocked(s, blocked)
    s = scoring.no_repeat_ngram(s, seqs, 3)
    s = scoring.repetition_penalty(s, seqs, 1.25)
    return s, seqs


def test_processors(spark):
    s, _ = _processed(spark)
    got = {r.token_id: r.score for r in s.collect()}
    assert got[0] == pytest.approx(2.5)
    assert got[1] == pytest.approx(1.5)
    assert got[2] == pytest.approx(1.0)
    assert got[3] == -math.inf and got[4] == -math.inf
    assert got[5] == pytest.approx(-1.25)


def test_softmax_and_suppress_last(spark):
    s, seqs = _processed(spark)
    soft = scoring.softmax(s)
    p = {r.token_id: r.p for r in soft.collect()}
    for k, v in {0: 0.619376, 1: 0.227856, 2: 0.138202, 3: 0, 4: 0, 5: 0.014566}.items():
        assert p[k] == pytest.approx(v, abs=1e-6)
    sup = {r.token_id: r.p for r in scoring.suppress_last(soft, seqs).collect()}
    for k, v in {0: 0.718702, 1: 0.264396, 2: 0, 3: 0, 4: 0, 5: 0.016902}.items():
        assert sup[k] == pytest.approx(v, abs=1e-6)
    assert sum(sup.values()) == pytest.approx(1.0)


def test_top_k_and_top_p(spark):
    s, seqs = _processed(spark)
    probs = scoring.suppress_last(scoring.softmax(s), seqs)
    tk = {r.token_id: r.p for r in scoring.top_k(probs, 2).collect()}
    assert tk == pytest.approx({0: 0.731059, 1: 0.268941}, abs=1e-6)
    # the crossing token is dropped (reference rule), the first is always kept
    assert {r.token_id: r.p for r in scoring.top_p(probs, 0.9).collect()} == {0: 1.0}
    assert {r.token_id: r.p for r in scoring.top_p(probs, 0.5).collect()} == {0: 1.0}


@pytest.mark.parametrize("u,expected", [(0.1, 0), (0.5, 1), (0.79, 1), (0.85, 2), (0.9999999, 2)])
def test_inverse_cdf_draw(spark, u, expected):
    p = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.3), (0, 2, 0.2)], "seq_id bigint, token_id int, p double")
    w = scoring._ranked()
    r = (p.withColumn("_rn", F.row_number().over(w))
          .withColumn("_cum", F.sum("p").over(scoring._running())).withColumn("u", F.lit(u)))
    got = r.groupBy("seq_id").agg(F.coalesce(
        F.min_by("token_id", F.when(F.col("_cum") > F.col("u"), F.col("_rn"))),
        F.max_by("token_id", F.col("_rn"))).alias("t")).collect()[0].t
    assert got == expected


def test_md5_uniform_values(spark):
    from spindle.functions.text import md5_uniform
    df = spark.range(3).select(md5_uniform(F.lit(42), F.col("id"), F.lit(0)).alias("u"))
    assert [r.u for r in df.orderBy("id").collect()] == [
        0.5509903090816513, 0.30100256247555457, 0.3200309975516178]


def test_no_candidate_when_all_masked(spark):
    p = spark.createDataFrame([(0, 0, 0.0), (0, 1, 0.0)], "seq_id bigint, token_id int, p double")
    assert scoring.sample(p, 42, 0).collect()[0].token_id is None


def test_ngram_bans_match_plain_python(spark):
    import random
    rnd = random.Random(7)
    hist = [[rnd.randrange(4) for _ in range(rnd.randrange(0, 14))] for _ in range(300)]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hist)], "seq_id bigint, ids array<int>")
    got = {r.seq_id: sorted(r.b) for r in
           df.select("seq_id", scoring.banned_ngram_ids(F.col("ids"), 3).alias("b")).collect()}
    for i, h in enumerate(hist):
        want = set()
        if len(h) >= 3:
            for j in range(len(h) - 2):
                if h[j:j + 2] == h[-2:]:
                    want.add(h[j + 2])
        assert got[i] == sorted(want)


def test_fixture_chain_goldens(spark):
    """FIXTURES 3.7 on the sf0.01 embeddings scores table."""
    from spindle.plans import catalog as K
    sf = "/root/testdata/sf0.01"
    probs = K._chain(spark, sf, "suppress_last")
    ranked = probs.withColumn("rank", F.row_number().over(scoring._ranked())).filter("rank <= 10")
    agg = ranked.agg(F.sum("p").alias("s"),
                     F.sum(F.col("token_id") * F.col("rank") * (F.col("seq_id") % 97 + 1)).alias("c")).collect()[0]
    assert agg.s == pytest.approx(353.024134, abs=1e-5)
    assert agg.c == 41242835
    tp = scoring.top_p(probs, 0.9)
    agg2 = tp.agg(F.count("*").alias("n"), F.sum(F.col("token_id") * (F.col("seq_id") % 97 + 1)).alias("c")).collect()[0]
    assert (agg2.n, agg2.c) == (11407, 17065916)
