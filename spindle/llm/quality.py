"""Quality rules, line first, in built-in functions only.

Every ``\\n``-split line with a word is judged alone; a line fails by

* punctuation: no sentence end (``. ! ? ...`` and the marks of other scripts before white
  space, a closing quote or bracket, or the line's end; not asked of lines half of whose
  characters are of a script without such marks), or more than ``symbol_share`` symbols a word;
* navigation: separators such as ``|`` at least ``separator_share`` times a word, or
  a line that is only a menu word;
* boilerplate: a licence, cookie or copyright phrase in a line of at most ``short_line``
  words or with ``phrase_share`` of its words in such phrases, or more than ``echo_share`` of
  the words equal to the word before them.

Failing lines are removed. A document is rejected if it fails the base rule (fewer
than ``min_words`` words, or more than ``repeat_percent`` % of them in five-word
windows that occur twice or more) or if the removed lines hold more than
``max_lost`` of its words.

All work is within the row: no shuffle, no skew, bounded by the longest text. The
windows are compared by 64-bit hashes, chained over the five words' own hashes.

Defined cases: a null text is an empty one (no words, rejected by the base rule); a
repeated row is judged again, alike; an empty table gives an empty result; columns
whose names begin with ``_qr_`` are internal, any others pass through, and a column
named like ``out_col`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import WORD, text_of

#: The symbols counted by the base figures.
SYMBOLS = "#*$%&|<>"
#: Separators of menus, breadcrumbs and table rows.
SEPARATORS = "|»›•·"
#: A sentence end within or at the end of a line: Latin and CJK marks, then those of Arabic and Urdu,
#: Indic, Armenian, Ethiopic, Khmer, Burmese, Tibetan, Mongolian and Sinhala script.
SENTENCE_END = (r"[.!?…。！？｡．؟۔।॥։።፧፨។៕။།༎᠃᠉෴‽]"
                r"[\"')\]»”’」』）]*([\x20\x09-\x0D]|$)")
#: Letters of scripts that mark no sentence end (Thai, Lao).
UNMARKED = r"[\u0E01-\u0E4E\u0E81-\u0ECD]"
#: Phrases of boilerplate lines, in lower case.
BOILERPLATE = ("licensed under", "released under the", "all rights reserved", "copyright",
               "terms of use", "terms of service", "privacy policy", "cookie", "javascript")
#: Lines that are nothing but a menu word, in lower case.
MENU = ("home", "menu", "login", "log in", "sign in", "sign up", "search", "next", "previous",
        "back", "back to top", "share", "read more", "contact", "contact us", "about us")

WINDOW = 5


@dataclass(frozen=True)
class LineRules:
    min_words: int = 10
    repeat_percent: int = 20
    symbol_share: float = 0.125
    separator_share: float = 0.2
    echo_share: float = 0.375
    short_line: int = 20
    phrase_share: float = 0.2
    max_lost: float = 0.625


def _count_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def with_repeated_words(df: DataFrame, hashes: str, out: str) -> DataFrame:
    """Adds ``out``: words in ``WINDOW``-word windows found twice or more, from the array
    column ``hashes`` of word hashes. What lambdas look up stands in a column of its own,
    as an expression there would be computed for every element."""
    n = F.size(hashes) - (WINDOW - 1)
    window = lambda i: F.xxhash64(*[F.get(hashes, i + F.lit(k)) for k in range(WINDOW)])
    df = df.withColumn("_qr_win", F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), window)))
    # only texts with a repeated window are sorted: equal windows come side by side
    pairs, h = F.col("_qr_pairs"), F.col("_qr_win")
    df = df.withColumn("_qr_pairs", F.when(
        F.size(F.array_distinct(h)) < F.size(h),
        F.sort_array(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))))
    twin = lambda p, j: F.get(pairs, j)["h"] == p["h"]
    same = F.transform(pairs, lambda p, j: F.when(
        F.when(j > 0, twin(p, j - 1)).otherwise(False) | F.coalesce(twin(p, j + 1), F.lit(False)), p["i"]))
    # their positions, in order again, cover WINDOW words each, or up to the next one
    return df.withColumn(out, F.coalesce(F.aggregate(
        F.sort_array(F.filter(same, lambda i: i.isNotNull())),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"),
                              (i + WINDOW).alias("end")),
        lambda a: a["n"]), F.lit(0))).drop("_qr_win", "_qr_pairs")


def _line_fails(line: Column, low: Column, words: Column, rules: LineRules) -> Column:
    n = F.size(words)
    echo = F.size(F.filter(
        F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))),
                   F.slice(words, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: a == b),
        lambda same: same))
    in_phrases = sum((F.regexp_count(low, F.lit(p)) * len(p.split()) for p in BOILERPLATE), F.lit(0))
    shown = F.length(F.translate(line, " \t\x0b\f\r", ""))
    return ((~line.rlike(SENTENCE_END) & (F.regexp_count(line, F.lit(UNMARKED)) * 2 < shown))
            | (_count_of(line, SYMBOLS) > n * F.lit(rules.symbol_share))
            | (_count_of(line, SEPARATORS) >= F.greatest(n * F.lit(rules.separator_share), F.lit(1.0)))
            | F.trim(low).isin(*MENU)
            | (low.rlike("|".join(BOILERPLATE))
               & ((n <= rules.short_line) | (in_phrases >= n * F.lit(rules.phrase_share))))
            | (echo > n * F.lit(rules.echo_share)))


def judge_documents(docs: DataFrame, text_col: str = "text", out_col: str = "quality",
                    rules: LineRules = LineRules()) -> DataFrame:
    """All rows and columns of ``docs`` plus the struct ``out_col``: ``cleaned`` (the text
    without failing lines), the base figures, ``n_lines``, ``n_failed_lines``,
    ``lost_words`` (long), ``base_failed`` and ``kept`` (boolean)."""
    own = [c for c in docs.columns if c.lower() != out_col.lower()]
    t = F.col("_qr_text")
    lines = F.transform(F.split(t, "\n", -1), lambda s: F.struct(
        s.alias("s"), F.lower(s).alias("low"), F.regexp_extract_all(s, F.lit(WORD), F.lit(0)).alias("w")))
    df = docs.select(*own, text_of(text_col).alias("_qr_text")).withColumn("_qr_lines", lines)
    df = df.withColumn("_qr_marked", F.transform("_qr_lines", lambda x: F.struct(
        x["s"].alias("s"), F.size(x["w"]).alias("n"),
        ((F.size(x["w"]) > 0) & _line_fails(x["s"], x["low"], x["w"], rules)).alias("bad"))))
    df = df.withColumn("_qr_hash", F.transform(F.flatten(F.transform("_qr_lines", lambda x: x["w"])),
                                               lambda w: F.xxhash64(w)))
    df = with_repeated_words(df.drop("_qr_lines"), "_qr_hash", "_qr_rep")
    marked = F.col("_qr_marked")
    df = df.select(
        *own, t, marked, F.size("_qr_hash").alias("_qr_n"), "_qr_rep",
        F.length(F.translate(t, " \t\n\x0b\f\r", "")).alias("_qr_chars"),
        F.transform(F.filter(marked, lambda x: x["n"] > 0), lambda x: x["s"]).alias("_qr_worded"),
        F.aggregate(F.filter(marked, lambda x: x["bad"]), F.lit(0), lambda a, x: a + x["n"]).alias("_qr_lost"))
    words, rep, lost = (F.col(f"_qr_{c}").cast("long") for c in ("n", "rep", "lost"))
    base = (words < rules.min_words) | (100 * rep > rules.repeat_percent * words)
    return df.select(*own, F.struct(
        F.array_join(F.transform(F.filter(marked, lambda x: ~x["bad"]), lambda x: x["s"]), "\n").alias("cleaned"),
        words.alias("n_words"),
        F.col("_qr_chars").cast("long").alias("word_chars"),
        _count_of(t, SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_qr_worded") - F.size(F.array_distinct("_qr_worded"))).cast("long").alias("n_dup_lines"),
        rep.alias("n_repeat_words"),
        F.size("_qr_worded").cast("long").alias("n_lines"),
        F.size(F.filter(marked, lambda x: x["bad"])).cast("long").alias("n_failed_lines"),
        lost.alias("lost_words"),
        base.alias("base_failed"),
        (~base & (lost <= words * F.lit(rules.max_lost))).alias("kept")).alias(out_col))


def filter_documents(docs: DataFrame, text_col: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """The documents kept, with their failing lines removed from the text and, where
    the table has it, ``n_chars`` counted anew; same columns, in the same order."""
    judged = judge_documents(docs, text_col, "_qr_quality", rules)
    # a generator, unlike a filter, isn't pushed below the figures, which would be computed twice
    judged = judged.withColumn("_qr_quality", F.explode(F.filter(F.array("_qr_quality"), lambda q: q["kept"])))
    cleaned = F.col("_qr_quality.cleaned")
    new = {text_col: cleaned, "n_chars": F.length(cleaned).cast("long")}
    return judged.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
