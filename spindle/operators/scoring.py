"""Score processors, top-k/top-p and sampling: N1-N11 (plus B3 in blocklist).

Inputs are ``scores(seq_id, token_id, score)`` and histories ``seqs(seq_id, ids)``
for any number of sequences at once. The order of the chain is part of the
semantics: temperature -> mask -> no-repeat n-gram -> repetition penalty ->
softmax -> suppress last id -> (top-p | top-k) -> sample -> append -> stop.

Scale notes
-----------
Everything is keyed by ``seq_id``. History-derived facts (banned ids, distinct
history, last id) are computed *per sequence row* with array functions and
joined on ``seq_id`` only, so the large scores side keeps its ``seq_id``
partitioning; windows are ``partitionBy(seq_id)`` and reuse it. Top-k uses a
``row_number() <= k`` filter, which Spark turns into a per-partition group
limit before the window sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from spindle import constants as C
from spindle.functions.text import md5_uniform

NEG_INF = float("-inf")

def _seq():
    return Window.partitionBy("seq_id")


def _ranked():
    return Window.partitionBy("seq_id").orderBy(F.desc("p"), F.asc("token_id"))


def _running():
    return _ranked().rowsBetween(Window.unboundedPreceding, Window.currentRow)


# ------------------------------------------------------- per-sequence history
def banned_ngram_ids(ids: Column, n: int = C.NO_REPEAT_NGRAM) -> Column:
    """Ids that would complete an ``n``-gram already present in ``ids``."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if n == 1:
        return F.array_distinct(ids)
    k = n - 1
    grams = F.transform(F.sequence(F.lit(0), F.size(ids) - n), lambda i: F.slice(ids, i + 1, n))
    tail = F.slice(ids, -k, k)
    hits = F.filter(grams, lambda g: F.slice(g, 1, k) == tail)
    return F.when(F.size(ids) >= n,
                  F.array_distinct(F.transform(hits, lambda g: F.element_at(g, n)))) \
            .otherwise(F.array().cast("array<int>"))


# --------------------------------------------------------------------------- N1
def temperature(scores: DataFrame, t: float = C.TEMPERATURE) -> DataFrame:
    if not t > 0:
        raise ValueError("temperature must be > 0")
    return scores.withColumn("score", F.col("score") / F.lit(float(t)))


# --------------------------------------------------------------------------- N2
def ban(scores: DataFrame, flag: Column) -> DataFrame:
    """Rule of N2 (and B3): a flagged id gets score -inf."""
    return scores.withColumn("score", F.when(flag, F.lit(NEG_INF)).otherwise(F.col("score")))


def _flagged(scores: DataFrame, seqs: DataFrame, ids: Column) -> DataFrame:
    """``scores`` plus ``_hit`` (null: no) where ``ids`` of the sequence has the row's id:
    one narrow row per (sequence, id) is joined, no array travels with the scores."""
    marks = seqs.select(F.col("seq_id").alias("_s"), F.explode(F.array_distinct(ids)).alias("_t"), F.lit(True).alias("_hit"))
    on = (scores["seq_id"] == F.col("_s")) & (scores["token_id"] == F.col("_t"))
    return scores.join(marks, on, "left").drop("_s", "_t")


def no_repeat_ngram(scores: DataFrame, seqs: DataFrame, n: int = C.NO_REPEAT_NGRAM) -> DataFrame:
    j = _flagged(scores, seqs, banned_ngram_ids(F.col("ids"), n))
    return ban(j, F.coalesce("_hit", F.lit(False))).drop("_hit")


# --------------------------------------------------------------------------- N3
def penalize(score: Column, r: float) -> Column:
    return F.when(score < 0, score * F.lit(float(r))).otherwise(score / F.lit(float(r)))


def penalty(scores: DataFrame, flag: Column, r: float = C.REPETITION_PENALTY) -> DataFrame:
    """Rule of N3 on ids flagged as seen in the history."""
    if not r > 0:
        raise ValueError("penalty must be > 0")
    return scores.withColumn("score", F.when(flag, penalize(F.col("score"), r))
                             .otherwise(F.col("score")))


def repetition_penalty(scores: DataFrame, seqs: DataFrame,
                       r: float = C.REPETITION_PENALTY) -> DataFrame:
    j = _flagged(scores, seqs, F.col("ids"))
    return penalty(j, F.coalesce("_hit", F.lit(False)), r).drop("_hit")


# --------------------------------------------------------------------------- N4
def softmax(scores: DataFrame) -> DataFrame:
    """``p`` = softmax of ``score`` per sequence; an all -inf sequence gets p = 0."""
    m = F.max("score").over(_seq())
    e = F.when(F.col("_m") == F.lit(NEG_INF), F.lit(0.0)).otherwise(F.exp(F.col("score") - F.col("_m")))
    return (scores.withColumn("_m", m).withColumn("_e", e)
            .withColumn("p", F.col("_e") / F.sum("_e").over(_seq()))
            .withColumn("p", F.coalesce(F.nanvl("p", F.lit(0.0)), F.lit(0.0)))
            .drop("_m", "_e"))


def renormalize(probs: DataFrame) -> DataFrame:
    tot = F.sum("p").over(_seq())
    return probs.withColumn("_t", tot) \
                .withColumn("p", F.when(F.col("_t") > 0, F.col("p") / F.col("_t")).otherwise(F.lit(0.0))) \
                .drop("_t")


# --------------------------------------------------------------------------- N5
def zero_and_renormalize(probs: DataFrame, flag: Column) -> DataFrame:
    """Rule of N5 on the id flagged as the previous one."""
    p = F.when(flag, F.lit(0.0)).otherwise(F.col("p"))
    return renormalize(probs.withColumn("p", p))


def suppress_last(probs: DataFrame, seqs: DataFrame) -> DataFrame:
    """Previous id gets p = 0, then renormalise."""
    last = seqs.select("seq_id", F.element_at("ids", -1).alias("_last"))
    flag = F.coalesce(F.col("token_id") == F.col("_last"), F.lit(False))
    return zero_and_renormalize(probs.join(last, "seq_id", "left"), flag).drop("_last")


# --------------------------------------------------------------------------- N6
def top_k(probs: DataFrame, k: int = C.TOP_K) -> DataFrame:
    """The ``k`` most probable ids (ties by id), renormalised; adds ``rank``."""
    if k < 1:
        raise ValueError("k must be >= 1")
    r = probs.withColumn("rank", F.row_number().over(_ranked())).filter(F.col("rank") <= k)
    return renormalize(r)


# --------------------------------------------------------------------------- N7
def top_p(probs: DataFrame, p: float) -> DataFrame:
    """Sorted descending, keep ``cum <= p`` plus always the first, renormalised."""
    r = (probs.withColumn("rank", F.row_number().over(_ranked()))
              .withColumn("_cum", F.sum("p").over(_running())))
    kept = r.filter((F.col("_cum") <= F.lit(float(p))) | (F.col("rank") == 1)).drop("_cum")
    return renormalize(kept)


# --------------------------------------------------------------------------- N8
def sample(probs: DataFrame, seed: int, step) -> DataFrame:
    """Inverse-CDF draw per sequence: ``(seq_id, token_id, u)``.

    ``u`` is an md5-uniform of (seed, seq_id, step); the first id in (p desc,
    id) order whose running total exceeds ``u`` wins, else the last one.
    """
    step_col = step if isinstance(step, Column) else F.lit(step)
    return pick(probs.withColumn("u", md5_uniform(F.lit(seed), F.col("seq_id"), step_col)))


def pick(probs: DataFrame) -> DataFrame:
    """The draw for the ``u`` that the rows of a sequence carry."""
    r = (probs.withColumn("_rn", F.row_number().over(_ranked()))
              .withColumn("_cum", F.sum("p").over(_running())))
    # rounding may keep the total below u: then the last id that can be drawn at all
    drawn = F.coalesce(F.min_by("token_id", F.when(F.col("_cum") > F.col("u"), F.col("_rn"))),
                       F.max_by("token_id", F.when(F.col("p") > 0, F.col("_rn"))))
    # a sequence whose kept mass is 0 has no candidate: no token is drawn
    return r.groupBy("seq_id").agg(
        F.when(F.sum("p") > 0, drawn).alias("token_id"),
        F.first("u").alias("u"))


def greedy(probs: DataFrame) -> DataFrame:
    """The most probable id per sequence (ties by lowest id)."""
    return probs.groupBy("seq_id").agg(
        F.min_by("token_id", F.struct(-F.col("p"), F.col("token_id"))).alias("token_id"))


# --------------------------------------------------------------------------- N9
def append_token(seqs: DataFrame, drawn: DataFrame) -> DataFrame:
    d = drawn.select("seq_id", F.col("token_id").alias("_next"))
    return seqs.join(d, "seq_id").withColumn("ids", F.concat("ids", F.array(F.col("_next")))) \
               .drop("_next")


# -------------------------------------------------------------------------- N10
def stop_flags(last_id: Column, n_new: Column, eos_id: int = C.EOS_ID,
               max_new: int = C.MAX_NEW_TOKENS) -> Column:
    """Reason a sequence stops after this token, or NULL to continue."""
    return (F.when(last_id == F.lit(eos_id), F.lit("eos"))
             .when(n_new >= F.lit(max_new), F.lit("max_new")))


# --------------------------------------------------------------------------- G1
def processor_chain(scores: DataFrame, seqs: DataFrame, blocked_ids: DataFrame | None = None,
                    t: float = C.TEMPERATURE, n: int = C.NO_REPEAT_NGRAM,
                    penalty: float = C.REPETITION_PENALTY, k: int = C.TOP_K,
                    p: float | None = C.TOP_P, processors=None) -> DataFrame:
    """The default chain up to the kept, renormalised distribution.

    ``processors`` (a list of DataFrame -> DataFrame over ``score``) replaces
    the no-repeat/penalty pair, like a user-supplied processor list.
    """
    s = temperature(scores, t)
    if blocked_ids is not None:
        from spindle.operators.blocklist import mask_blocked
        s = mask_blocked(s, blocked_ids)
    if processors is None:
        processors = [lambda d: no_repeat_ngram(d, seqs, n),
                      lambda d: repetition_penalty(d, seqs, penalty)]
    for f in processors:
        s = s.transform(f)
    probs = suppress_last(softmax(s), seqs)
    return top_p(probs, p) if p is not None else top_k(probs, k)
