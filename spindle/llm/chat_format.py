"""Chat formatting by rotating the perspective of multi-party dialogues.

For every participant of a dialogue (every speaker but the system) the whole dialogue is
rendered with that speaker as the assistant and the others as users with their names; the
mask lists the character spans of the assistant's own words, end mark included, which
training is to learn from. A turn reads ``<|im_start|>user name=NAME\\nTEXT<|im_end|>\\n``
(``assistant`` and ``system`` turns without a name); marks inside a name or text are
broken up, so that a text can't forge a turn.

A dialogue is cut into parts of ``part_turns`` consecutive turn numbers, by the number
itself, so that a conversation with very many turns is rendered by many tasks; each part is
one row per participant of the whole conversation, and parts joined in order are the
dialogue. Where numbers don't bound a conversation's parts (more than ``part_turns`` rows
would share one, by repeated or missing numbers), all of that conversation is cut by
position instead: its distinct turns are counted, range-partitioned in order and numbered by
prefix sums of the counts, so no part holds more than ``part_turns`` rows whatever the
numbers are. Turns meet by (conversation, part), participants are gathered by partial
aggregation.

Defined cases: turns are ordered by number, then speaker, then text; every repeated row is a
turn; turns without a number come last, in a part of their own (part null) where parts go by
number; a null text is an empty one; a null speaker is a participant named
``unknown``; rows without a conversation id are one conversation with a null id; a
dialogue of system turns only has no participant and no row; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from spindle.llm.common import saved

#: The marks around a turn, and what breaks them up in a text.
START, STOP, MARK, BROKEN = "<|im_start|>", "<|im_end|>", "<|", "< |"
#: The speaker whose turns are instructions, and the name of a null speaker.
SYSTEM, UNKNOWN = "system", "unknown"
TURNS = 256


def _unforged(text: Column) -> Column:
    return F.replace(text, F.lit(MARK), F.lit(BROKEN))


def _by_position(turns: DataFrame, part_turns: int) -> DataFrame:
    """``conv_id, part, turn, who, text, n``: equal turns as one row with their number in a
    part, which is cut by the position in the conversation. No task or window sees more than
    a range; totals are one row a conversation and range."""
    order = [F.col("turn").asc_nulls_last(), F.col("who"), F.col("text")]
    once = turns.groupBy("conv_id", "turn", "who", "text").agg(F.count("*").alias("n"))
    # written, so that the ranges are fixed
    ranged = saved(once.repartitionByRange(F.col("conv_id"), *order).withColumn("range", F.spark_partition_id()), "chat-ranges")
    upto = F.sum("n").over(W.partitionBy("conv_id").orderBy("range"))
    totals = (ranged.groupBy("conv_id", "range").agg(F.sum("n").alias("n"))
              .select(F.col("conv_id").alias("__conv"), F.col("range").alias("__range"), (upto - F.col("n")).alias("start")))
    within = F.sum("n").over(W.partitionBy("range", "conv_id").orderBy(*order)
                             .rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    at, size = F.col("at"), F.lit(part_turns)
    return (ranged.withColumn("within", within)
            .join(totals, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("range") == F.col("__range")))
            .withColumn("at", F.col("start") + F.col("within"))
            .withColumn("part", F.explode(F.sequence(F.floor(at / size), F.floor((at + F.col("n") - 1) / size))))
            .select("conv_id", "part", "turn", "who", "text",
                    (F.least(at + F.col("n"), (F.col("part") + 1) * size) - F.greatest(at, F.col("part") * size)).alias("n")))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", part_turns: int = TURNS) -> DataFrame:
    """``conv_id, part, participant, text, mask`` (array of start, end: characters of this
    part), ``n_turns`` and ``n_own`` (long) per part and participant."""
    t = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        _unforged(F.coalesce(F.col(speaker_col), F.lit(UNKNOWN))).alias("who"),
        _unforged(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    people = (t.where(F.col("who") != SYSTEM).groupBy(F.col("conv_id").alias("__conv"))
              .agg(F.sort_array(F.collect_set("who")).alias("people")))
    numbered = t.withColumn("part", F.floor(F.col("turn") / part_turns))
    # conversations whose turn numbers don't bound the parts
    unbound = saved(numbered.groupBy("conv_id", "part").count().where(F.col("count") > part_turns)
                    .select(F.col("conv_id").alias("__unbound")).distinct(), "chat-unbound")
    among = F.col("conv_id").eqNullSafe(F.col("__unbound"))
    cut = (numbered.join(unbound, among, "left_anti").select("conv_id", "part", "turn", "who", "text", F.lit(1).cast("long").alias("n"))
           .unionByName(_by_position(t.join(unbound, among, "left_semi"), part_turns)))
    parts = (cut.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct(
                 F.col("turn").isNull().alias("late"), "turn", "who", "text", "n"))).alias("said"))
             .withColumn("said", F.flatten(F.transform("said", lambda s: F.array_repeat(
                 F.struct(s["who"].alias("who"), s["text"].alias("text")), s["n"].cast("int"))))))
    each = (parts.join(people, F.col("conv_id").eqNullSafe(F.col("__conv")))
            .select("conv_id", "part", "said", F.explode("people").alias("participant")))
    own = lambda s: s["who"] == F.col("participant")
    head = lambda s: F.concat(F.lit(START), F.when(own(s), F.lit("assistant")).when(
        s["who"] == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), s["who"])), F.lit("\n"))
    tail = lambda s: F.concat(s["text"], F.lit(STOP))
    lines = each.select("conv_id", "part", "participant", F.transform("said", lambda s: F.struct(
        head(s).alias("head"), tail(s).alias("tail"), own(s).alias("own"))).alias("lines"))
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    span = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["head"])
        end = begin + F.length(x["tail"])
        return F.struct((end + 1).alias("at"), F.when(x["own"], F.concat(acc["mask"], F.array(span(begin, end))))
                        .otherwise(acc["mask"]).alias("mask"))

    return lines.select(
        "conv_id", "part", "participant",
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["tail"], F.lit("\n"))), "").alias("text"),
        F.aggregate("lines", F.struct(F.lit(0).cast("long").alias("at"), none.alias("mask")), step,
                    lambda a: a["mask"]).alias("mask"),
        F.size("lines").cast("long").alias("n_turns"),
        F.size(F.filter("lines", lambda x: x["own"])).cast("long").alias("n_own"))
