"""Blocklist: B1-B4.

A token is blocked when its text, lower-cased and left-stripped, *contains*
any blocklist word. The substring test is a theta join; it is evaluated here
as an exact **equi-join**: every distinct token emits its substrings whose
length is one of the blocklist's word lengths, and those are joined to the
words. The work per token is bounded by ``len(token) * #distinct word lengths``
and no token x word product is ever formed, whatever the size of either side.
The join side size is decided by AQE at run time from the actual sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.functions.text import strip_left
from spindle.session import written


# --------------------------------------------------------------------------- B1
def normalize_blocklist(words: DataFrame, col: str = "word") -> DataFrame:
    """B1: words as lower-case text, distinct; NULL and empty words are rejected
    (an empty word would be contained in every token)."""
    w = words.select(F.lower(F.col(col).cast("string")).alias("word"))
    return w.filter(F.col("word").isNotNull() & (F.length("word") > 0)).distinct()


def _matchable(tokens: DataFrame, token_col: str) -> DataFrame:
    return tokens.withColumn("_m", strip_left(F.lower(F.col(token_col))))


def matching_tokens(tokens: DataFrame, words: DataFrame, token_col: str = "token") -> DataFrame:
    """Rows of ``tokens`` whose normalised text contains a word (semi join).

    ``tokens`` should hold distinct token texts; ``words`` is B1's output. Substrings
    travel with a hash of their token, never with its text; the text is held against
    the word it was matched with at the end.
    """
    lengths = words.select(F.length("word").alias("_len")).distinct()
    lens_arr = lengths.select(F.sort_array(F.collect_list("_len"))).scalar()
    t = _matchable(tokens, token_col).withColumn("_lens", lens_arr)
    # substrings of every word length, start positions 1..len-L+1
    subs = (t.select(F.xxhash64("_m").alias("_key"), "_m",
                     F.explode(F.filter("_lens", lambda n: n <= F.length("_m"))).alias("_n"))
            .select("*", F.explode(F.sequence(F.lit(1), F.length("_m") - F.col("_n") + 1)).alias("_i"))
            .select("_key", F.substring(F.col("_m"), F.col("_i"), F.col("_n")).alias("word")))
    hits = subs.join(words, "word").distinct()
    found = _matchable(tokens, token_col).withColumn("_key", F.xxhash64("_m"))
    on = (found["_key"] == hits["_key"]) & F.contains(found["_m"], hits["word"])
    return found.join(hits, on, "left_semi").select(*tokens.columns)


# --------------------------------------------------------------------------- B2
def blocked_token_ids(vocab_df: DataFrame, words: DataFrame, block_bytes: bool = False) -> DataFrame:
    """B2: ``(token_id, token)`` of every vocabulary entry that contains a word.

    ``block_bytes`` adds the byte entries, so that a word can't be spelled by bytes.
    """
    found = matching_tokens(vocab_df.select("token_id", "token"), normalize_blocklist(words))
    if block_bytes:
        found = found.union(vocab_df.filter(F.col("kind") == "byte").select("token_id", "token")).distinct()
    return found


# --------------------------------------------------------------------------- B3
def mask_blocked(scores: DataFrame, blocked_ids: DataFrame) -> DataFrame:
    """Score of a blocked id becomes -inf.

    ``blocked_ids`` is a subset of a vocabulary; where Spark knows it to be small
    (a written or literal table), the scores side isn't shuffled for this step.
    """
    b = blocked_ids.select(F.col("token_id").alias("_bid")).distinct()
    j = scores.join(b, scores["token_id"] == b["_bid"], "left")
    return j.withColumn("score", F.when(F.col("_bid").isNotNull(), F.lit(float("-inf")))
                        .otherwise(F.col("score"))).drop("_bid")


# --------------------------------------------------------------------------- B4
def blocked_rate(pretokens: DataFrame, words: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, how many pre-tokens are blocked, on pre-token text.

    The substring test runs once per distinct token; the blocked ones are written, and
    every occurrence is joined to them (by broadcast if Spark finds that table small,
    else by shuffle with hot tokens split), then counted per key with partial sums. A
    key whose only row has a null token (a document without pre-tokens) has no tokens
    and no rate.
    """
    token = F.col("token")
    # few bytes but many substrings: dealt to a fixed number of tasks, which AQE leaves as they are
    n = int(pretokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct_tokens = written(pretokens.select("token").where(token.isNotNull()).distinct().repartition(n), "tokens")
    blocked = written(matching_tokens(distinct_tokens, normalize_blocklist(words))
                      .select("token", F.lit(True).alias("_blocked")), "blocked")
    return (pretokens.select(key, "token").join(blocked, "token", "left").groupBy(key)
            .agg(F.count("token").alias("n_pretokens"), F.count("_blocked").alias("n_blocked"))
            .withColumn("blocked_rate", F.when(
                F.col("n_pretokens") > 0, F.round(F.col("n_blocked") / F.col("n_pretokens"), 6))))
