"""Completion invariants on sf0.001 and sparse top-k = dense chain."""

import math

import pytest
from pyspark.sql import functions as F

from spindle.operators import blocklist, codec, scoring
from spindle.plans import catalog as K
from spindle.plans import generate as G

from conftest import SF001


@pytest.fixture(scope="module")
def gen(spark):
    return K._gen_inputs(spark, SF001)


def test_sparse_top_k_equals_dense(spark, gen):
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=42)
    active = prompts.filter(F.size("ids") > 0)
    dense = G.chain(G.next_token_scores(active, tables, cfg, keep_flags=True), blocked, cfg)
    sparse = G.sparse_kept(active, G.model_lists(tables, blocked), cfg)
    d = {(r.seq_id, r.token_id): r.p for r in dense.collect()}
    s = {(r.seq_id, r.token_id): r.p for r in sparse.collect()}
    assert d.keys() == s.keys()
    assert max(abs(d[k] - s[k]) for k in d) < 1e-9


def test_contexts_with_blocked_followers_only(spark, gen):
    """Their total still counts: it changes what the history's penalty does."""
    v, model, tables, prompts, _ = gen
    cfg = G.GenConfig(seed=42)
    active = prompts.filter(F.size("ids") > 1)
    ends = active.select(F.element_at("ids", -2).alias("u"), F.element_at("ids", -1).alias("v"))
    blocked = tables.n3.join(ends, ["u", "v"]).select(F.col("w").alias("token_id")).distinct()
    assert blocked.count() > 0
    dense = G.chain(G.next_token_scores(active, tables, cfg, keep_flags=True), blocked, cfg)
    sparse = G.sparse_kept(active, G.model_lists(tables, blocked), cfg)
    d = {(r.seq_id, r.token_id): r.p for r in dense.collect()}
    s = {(r.seq_id, r.token_id): r.p for r in sparse.collect()}
    assert d.keys() == s.keys() and max(abs(d[k] - s[k]) for k in d) < 1e-9


def test_prompts_with_null_or_equal_ids(spark, gen):
    v, model, tables, prompts, blocked = gen
    some = prompts.filter(F.size("ids") > 0).limit(3)
    same = some.withColumn("seq_id", F.lit(None).cast("string")).unionByName(some.withColumn("seq_id", F.lit("x")))
    out = G.complete(same, model, G.GenConfig(max_new=2, seed=1), blocked, tables).collect()
    want = sorted(r.ids for r in same.collect())
    assert sorted(r.ids[:r.prompt_len] for r in out) == want


def test_completion_invariants(spark, gen):
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=7, max_new=6)
    st = G.complete(prompts, model, cfg, blocked, tables)
    rows = st.collect()
    bad = {r.token_id for r in blocked.collect()}
    assert len(rows) == prompts.count()
    for r in rows:
        new = r.ids[r.prompt_len:]
        assert len(new) == r.n_new <= cfg.max_new
        assert not (set(new) & bad)
        seq = r.ids
        for i in range(r.prompt_len, len(seq)):
            assert i == 0 or seq[i] != seq[i - 1]                 # never the same id twice
            if i >= 2:                                           # no repeated 3-gram
                grams = {tuple(seq[j:j + 3]) for j in range(i - 2)}
                assert tuple(seq[i - 2:i + 1]) not in grams
        if r.prompt_len == 0:
            assert r.reason == "empty_prompt"
        else:
            assert r.reason in ("eos", "max_new", "no_candidate")


def test_one_step_equals_generate_step(spark, gen):
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=42, max_new=1)
    a = G.complete(prompts, model, cfg, blocked, tables).select("seq_id", "ids")
    b = G.generate_step(G.initial_state(prompts, cfg), tables, blocked, cfg, 0).select("seq_id", "ids")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("p, head, warmth", [(0.9, 256, 0.8), (0.5, 2, 1.0), (0.05, 1, 0.8), (0.999, 8, 1.3)])
def test_sparse_nucleus_equals_dense(spark, gen, monkeypatch, p, head, warmth):
    """Whatever the head that is read first, with a nucleus of one id and of most ids."""
    v, model, tables, prompts, blocked = gen
    monkeypatch.setattr(G, "FIRST_HEAD", head)
    cfg = G.GenConfig(seed=42, top_p=p, temperature=warmth)
    active = prompts.filter(F.size("ids") > 0)
    dense = G.chain(G.next_token_scores(active, tables, cfg, keep_flags=True), blocked, cfg)
    sparse = G.sparse_kept(active, G.model_lists(tables, blocked, warmth), cfg)
    d = {(r.seq_id, r.token_id): r.p for r in dense.collect()}
    s = {(r.seq_id, r.token_id): r.p for r in sparse.collect()}
    assert d.keys() == s.keys()
    assert max(abs(d[k] - s[k]) for k in d) < 1e-9


def test_top_p_steps(spark, gen):
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=1, max_new=2, top_p=0.9)
    rows = G.complete(prompts, model, cfg, blocked, tables).collect()
    assert len(rows) == prompts.count() and any(r.n_new == 2 for r in rows)
    with pytest.raises(ValueError, match="temperature"):
        G.complete(prompts, model, cfg, None, tables, G.model_lists(tables, None, 0.5))


def test_text_and_sink(spark, gen, tmpdir_path):
    from spindle.sources import sinks
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=3, max_new=3)
    st = G.complete(prompts, model, cfg, blocked, tables)
    out = G.with_text(st, v)
    src = K.corpus.read_prompts(K.table(spark, SF001, "conversations"))
    j = out.join(src.withColumnRenamed("text", "prompt"), "seq_id")
    assert j.filter(~F.col("text").startswith(F.col("prompt"))).count() == 0
    sinks.write_completions(st, v, f"{tmpdir_path}/c")
    assert spark.read.parquet(f"{tmpdir_path}/c").count() == st.agg(F.sum("n_new")).collect()[0][0]


def test_dense_rows_are_never_moved(spark, gen):
    """M3's row an id and sequence is made where it is put out; no exchange sees it."""
    v, model, tables, prompts, blocked = gen
    active = prompts.filter(F.size("ids") > 0)
    plan = G.next_token_scores(active, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0" not in plan
    assert plan.splitlines()[0].startswith("MapInArrow")


def test_a_list_is_met_by_several_sequences_at_once(spark, gen, monkeypatch):
    """Sequences that end alike share a list's row, in groups of any size."""
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=3)
    some = prompts.filter(F.size("ids") > 0).limit(5).select("ids")
    active = some.select(F.explode(F.sequence(F.lit(1), F.lit(7))).alias("seq_id"), "ids") \
        .select(F.concat_ws("-", "seq_id", F.md5(F.concat_ws(" ", "ids"))).alias("seq_id"), "ids")
    lists = G.model_lists(tables, blocked)
    kept = lambda: sorted((r.seq_id, r.token_id, r["rank"], r.p) for r in G.sparse_kept(active, lists, cfg).collect())
    whole = kept()
    monkeypatch.setattr(G, "SEQUENCES_A_LIST", 2)
    monkeypatch.setattr(G, "ENTRIES_AT_ONCE", 10)
    assert kept() == whole and len({r[0] for r in whole}) == 35


def test_a_step_sorts_no_lists_and_draws_by_running_totals(spark, gen):
    """The model's lists are streamed past the sequences; one sequence or many, each draws alone."""
    import numpy as np
    v, model, tables, prompts, blocked = gen
    cfg = G.GenConfig(seed=3)
    lists = G.model_lists(tables, blocked)
    rows = G.numbered(prompts.filter(F.size("ids") > 0)).withColumn("u", F.when(F.col("_row") % 7 == 0, 1.0 - 2.0 ** -53).otherwise(F.rand(5)))
    rows = rows.select("_row", "seq_id", "ids", "u").localCheckpoint()
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        asked = rows.select("_row", "ids", F.lit(G.ANY).alias("u"), F.element_at("ids", -1).alias("v"))
        plan = G._own_entries(asked, lists, 5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    got = G.top_k_lists(rows, lists, cfg).collect()
    assert len(got) == rows.count() > 20
    for r in got:
        assert r._next == r.tokens[min(np.searchsorted(np.cumsum(r.probs), r.u, side="right"), sum(p > 0 for p in r.probs) - 1)]
        assert abs(sum(r.probs) - 1) < 1e-12 and r.ids[-1] not in [t for t, p in zip(r.tokens, r.probs) if p > 0]


def test_dense_scores_travel_as_lists(spark, gen, monkeypatch):
    """No row an entry of a list is moved, a last id that all share is dealt to many rows, and
    sequences that share an id add up what they met, as ever."""
    v, model, tables, prompts, blocked = gen
    monkeypatch.setattr(G, "DENSE_TOGETHER", 4)
    some = prompts.filter(F.size("ids") > 2).limit(8)
    last = some.first().ids[-1]
    alike = some.select("seq_id", F.concat(F.slice("ids", -3, 2), F.array(F.lit(last))).alias("ids"))
    rows = alike.unionByName(alike.limit(1).select(F.lit("short").alias("seq_id"), F.array(F.lit(last)).alias("ids"))).localCheckpoint()
    met = G._followers(G._context(rows, tables, G.GenConfig()), tables, [], G.GenConfig())
    assert 1 < met.count() and met.selectExpr("sum(size(s))").first()[0] == 9
    n3, n2 = ({(*r[:-1],): r[-1] for r in t.collect()} for t in (tables.n3, tables.n2))
    n1 = {r.token_id: r.n1 for r in tables.uni.collect()}
    got = {(r.seq_id, r.token_id): r.score for r in G.next_token_scores(rows, tables, decimals=6).collect()}
    assert len(got) == 9 * tables.n_ids
    for r in rows.collect():
        u, e = r.ids[-2] if len(r.ids) > 1 else None, r.ids[-1]
        t3, t2 = (sum(n for k, n in t.items() if k[:-1] == c) for t, c in ((n3, (u, e)), (n2, (e,))))
        for w in range(0, tables.n_ids, 7):
            parts = [(0.0, 0.0) if not t3 else (G.LAMBDAS[0] * n3.get((u, e, w), 0) / t3, G.LAMBDAS[0]),
                     (0.0, 0.0) if not t2 else (G.LAMBDAS[1] * n2.get((e, w), 0) / t2, G.LAMBDAS[1]),
                     (G.LAMBDAS[2] * n1[w] / tables.t1, G.LAMBDAS[2]), (G.LAMBDAS[3] / tables.n_ids, G.LAMBDAS[3])]
            assert abs(got[r.seq_id, w] - math.log(sum(p for p, _ in parts) / sum(d for _, d in parts))) < 6e-7


def test_scores_are_rounded_as_spark_rounds(spark):
    import numpy as np
    rnd = np.random.default_rng(5)
    x = np.concatenate([-rnd.random(5000) * 20, np.round(-rnd.random(2000) * 9, 6) - 5e-7, [-0.0000005, -1.0000015, -2.5e-7, 0.0, -1e-9, -0.1234565]])
    want = [r[0] for r in spark.createDataFrame([(i, float(a)) for i, a in enumerate(x)], "i int, a double").orderBy("i").select(F.round("a", 6)).collect()]
    assert [repr(a) for a in G._rounded(x, 6).tolist()] == [repr(a + 0.0) for a in want]
