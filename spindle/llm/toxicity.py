"""Toxicity by a weighted lexicon, learnt from labelled documents.

Texts are folded (lower case; look-alike letters of other scripts, full-width forms and
digits or signs written for letters become the letter; invisible characters go). Terms
are beginnings of words; one Aho-Corasick pass over the folded text finds them all, and
a match counts if it begins a word and lies in no exception phrase. The matched weights,
divided by a power of the text's length in words, give the score.

Learning reads a bounded sample: at most ``DOCS_PER_CLASS`` labelled documents of each
class, by the order of a hash of the id, distinct texts only. Terms are beginnings of
``TERM_LETTERS`` letters whose log odds and likelihood ratio favour label 1, counted
first in documents and then, so that copied passages count once, in distinct contexts
(words before and after); of terms that begin one another the better is kept. A word or
pair of words around a term is an exception if it keeps to clean documents. The power of
the length and the cut are those of the best F1 on the sample, weighted to the classes'
sizes; scores are scaled to be 0.3 at the cut. Scoring is a map over whole texts.

Defined cases: a null or empty text scores 0; without labels of both classes the lexicon
is empty and all score 0; labelled rows with a null id or label, or ids or texts with both
labels, teach nothing; equal rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.arrow_map import kept, with_python_columns
from spindle.llm.common import saved, text_of

#: Bounds of the sample and of the lexicon.
DOCS_PER_CLASS = 3000
MAX_CANDIDATES = 20_000
MAX_TERMS = 2000
TERM_LETTERS = range(3, 9)
#: A term's least log odds for label 1, and least likelihood ratio (G squared).
MIN_WEIGHT, MIN_EVIDENCE = 1.5, 24.0
#: Share of a term's evidence with which a longer one replaces it.
NEARLY = 0.98
#: The score at the cut.
CUT_SCORE = 0.3

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
#: Digits written for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
#: Signs written for letters, within a word only.
SIGNS = {"@": "a", "$": "s", "!": "i"}
#: Characters without a mark of their own: soft hyphen, zero-width ones, byte-order mark.
INVISIBLE = "\xad​‌‍⁠﻿"

WORDS = re.compile(r"[^\W\d_]+")
IN_WORD_SIGN = re.compile(r"(?<=[^\W_])[@$!](?=[^\W_])")
FOLD = {ord(k): v for k, v in (LOOKALIKES | DIGITS).items()}
FOLD |= {0xFF41 + i: chr(ord("a") + i) for i in range(26)}
FOLD |= {0xFF10 + int(d): v for d, v in DIGITS.items()}
FOLD |= {ord(c): None for c in INVISIBLE}


def fold(text: str) -> str:
    text = text.lower()
    if "@" in text or "$" in text or "!" in text:
        text = IN_WORD_SIGN.sub(lambda m: SIGNS[m[0]], text)
    return text.translate(FOLD)


@dataclass(frozen=True)
class Lexicon:
    """Terms with weights, exception phrases, and how matches become a score."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    power: float = 1.0
    cut: float = 1.0

    def scorer(self) -> Scorer:
        return Scorer(self)

    def score(self, weight: float, n_words: int) -> float:
        x = weight / (n_words + 20.0) ** self.power
        return x / (x + self.cut * (1 - CUT_SCORE) / CUT_SCORE) if x > 0 else 0.0


class Scorer:
    """Finds a lexicon's terms in texts."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.automaton = None
        if lexicon.terms:
            self.automaton = ahocorasick.Automaton()
            for phrase in lexicon.exceptions:
                self.automaton.add_word(phrase, (len(phrase), 0.0, ""))
            for term, weight in lexicon.terms.items():
                self.automaton.add_word(term, (len(term), weight, term))
            self.automaton.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, float, str]]:
        """(start, weight, term) of the terms that begin a word outside of exceptions."""
        if self.automaton is None:
            return []
        found, spared = [], []
        for end, (size, weight, term) in self.automaton.iter(folded):
            start = end - size + 1
            if start and folded[start - 1].isalpha():
                continue
            if term:
                found.append((start, weight, term))
            elif end + 1 == len(folded) or not folded[end + 1].isalpha():
                spared.append((start, end))
        if spared:
            spared.sort()
            starts = [a for a, _ in spared]
            upto = list(accumulate((b for _, b in spared), max))     # the furthest end so far
            at = [bisect_right(starts, m[0]) - 1 for m in found]
            found = [m for m, i in zip(found, at, strict=True) if i < 0 or upto[i] < m[0]]
        return found

    def weigh(self, text: str) -> tuple[float, int]:
        folded = fold(text)
        return sum(m[1] for m in self.matches(folded)), len(folded.split())


def evidence(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    """G squared of a count split over the classes, against their sizes."""
    total = toxic + clean
    expected = total * n_toxic / (n_toxic + n_clean)
    part = lambda seen, due: seen * math.log(seen / due) if seen else 0.0
    return 2 * (part(toxic, expected) + part(clean, total - expected))


def log_odds(toxic: float, clean: float, n_toxic: float, n_clean: float) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Documents whose labels are never learnt from."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(col.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                    label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """``text, label`` of the bounded sample, and the labelled documents of each class. Equal
    texts count once, and not at all if their labels differ."""
    label = F.col(label_col).cast("int")
    known = saved(labels.select(F.col(id_col).alias("id"), label.alias("label"))
                  .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id"))
                  .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
                  .where(F.col("label") == F.col("most")).drop("most"), "toxicity-labels")
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    # a third more ids than wanted: some labelled documents aren't there, some are copies
    picked = None
    for k in (0, 1):
        part = (known.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id")
                .limit(DOCS_PER_CLASS + DOCS_PER_CLASS // 3))
        picked = part if picked is None else picked.unionByName(part)
    # bounded by DOCS_PER_CLASS, hence the broadcast
    found = (docs.select(F.col(id_col).alias("__id"), text_of(text_col).alias("text"))
             .join(F.broadcast(saved(picked, "toxicity-picked")), F.col("__id") == F.col("id"))
             .groupBy("text").agg(F.min("label").alias("label"), F.max("label").alias("most"), F.min(F.xxhash64("id")).alias("order"))
             .where(F.col("label") == F.col("most")).drop("most"))
    found = saved(found, "toxicity-found")
    sample = None
    for k in (0, 1):
        part = found.where(F.col("label") == k).orderBy("order", "text").limit(DOCS_PER_CLASS)
        sample = part if sample is None else sample.unionByName(part)
    return saved(sample.select("text", "label").repartition(16, F.xxhash64("text")), "toxicity-sample"), sizes


def _counted(sample: DataFrame, schema: str, keys: list[str], each) -> DataFrame:
    """Sums of ``n`` by ``keys`` of what ``each(folded text, label)`` yields, first added up
    within a task (the sample is bounded)."""
    def run(batches):
        sums: Counter = Counter()
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums.update(each(fold(text), label))
        if sums:
            columns = [*zip(*sums, strict=True), list(sums.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string() if isinstance(c[0], str) else pa.int64()) for c in columns],
                [*keys, "n"])

    return (sample.select("text", "label").mapInArrow(run, schema)
            .groupBy(*[k for k in keys if k != "label"])
            .agg(*[F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(name)
                   for k, name in ((1, "toxic"), (0, "clean"))]))


def learn_lexicon(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic") -> Lexicon:
    """The lexicon of the labelled documents outside ``held_out``."""
    sample, sizes = training_sample(docs, labels, id_col, text_col, label_col)
    seen = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return Lexicon()
    n1, n0 = seen[1], seen[0]

    def beginnings(folded, label):
        return {(w[:n], label) for w in set(WORDS.findall(folded)) for n in TERM_LETTERS if len(w) >= n}

    def g2(t, c):
        total = t + c
        due = total * (n1 / (n1 + n0))
        log = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
        return 2 * (log(t, due) + log(c, total - due))

    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    candidates = (_counted(sample, "term string, label long, n long", ["term", "label"], beginnings)
                  .where((F.log((t + 0.5) / (n1 + 1)) - F.log((c + 0.5) / (n0 + 1)) >= MIN_WEIGHT)
                         & (g2(t, c) >= MIN_EVIDENCE))
                  .orderBy(g2(t, c).desc(), "term").limit(MAX_CANDIDATES))
    odds = {r.term: log_odds(r.toxic, r.clean, n1, n0) for r in candidates.collect()}

    def contexts(folded, label):
        words = WORDS.findall(folded)
        out = set()
        for before, w, after in zip(["", *words], words, [*words[1:], ""], strict=False):
            out |= {(w[:n], before, w, after, label) for n in TERM_LETTERS if len(w) >= n and w[:n] in odds}
        return out

    around = saved(_counted(sample, "term string, before string, word string, after string, label long, n long",
                            ["term", "before", "word", "after", "label"], contexts), "toxicity-contexts")
    once = [F.count(F.when(F.col(k) > 0, True)).alias(k) for k in ("toxic", "clean")]
    # as many rows as candidates
    strength = {r.term: evidence(r.toxic, r.clean, n1, n0)
                for r in around.groupBy("term").agg(*once).collect()}
    longer: dict[str, list[str]] = defaultdict(list)
    for w in strength:
        for n in TERM_LETTERS:
            longer[w[:n]] += [w] if len(w) >= n else []
    terms: dict[str, float] = {}
    begun: set[str] = set()              # what accepted terms begin with
    for term in sorted(odds, key=lambda w: (-strength.get(w, 0), w)):
        if strength.get(term, 0) < MIN_EVIDENCE or len(terms) == MAX_TERMS:
            break
        if term not in begun and not any(term[:n] in terms for n in range(1, len(term))):
            # the longest term beginning so with nearly all of its evidence says it more exactly
            term = max((w for w in longer[term] if strength[w] >= NEARLY * strength[term]), key=lambda w: (len(w), w))
            terms[term] = odds[term]
            begun.update(term[:n] for n in range(1, len(term) + 1))
    # words around terms that keep to clean documents
    used = around.where(F.col("term").isin(*terms)) if terms else around.limit(0)
    phrases = (used.select(F.explode(F.array("word", F.concat_ws(" ", "before", "word"),
                                             F.concat_ws(" ", "word", "after"))).alias("phrase"), "toxic", "clean")
               .groupBy("phrase").agg(*once).where((F.col("clean") >= 3) & (F.col("toxic") == 0))
               .orderBy(F.col("clean").desc(), "phrase").limit(MAX_TERMS))
    exceptions = frozenset(p for r in phrases.collect() if (p := r.phrase.strip()) not in terms)
    return _calibrated(sample, Lexicon(terms, exceptions), sizes, seen)


def _weighed(docs: DataFrame, lexicon: Lexicon, text_col: str) -> DataFrame:
    def make():
        scorer = lexicon.scorer()
        return lambda texts: list(zip(*map(scorer.weigh, texts), strict=True))

    return with_python_columns(docs, text_col, {"weight": "double", "n_words": "long"}, make)


def _calibrated(sample: DataFrame, lexicon: Lexicon, sizes: dict, seen: dict) -> Lexicon:
    """The power and the cut of the best F1 on the sample, whose rows stand for their class."""
    rows = _weighed(sample, lexicon, "text").select("label", "weight", "n_words").collect()
    stands = {k: sizes[k] / seen[k] for k in seen}
    best = (-1.0, 1.0, 1.0)
    for power in (0.25, 0.5, 0.75, 1.0):
        marks = sorted(((r.weight / (r.n_words + 20.0) ** power, r.label) for r in rows), reverse=True)
        hits = found = 0.0
        for i, (x, label) in enumerate(marks):
            if x <= 0:
                break
            hits += stands[1] * label
            found += stands[label]
            below = max(marks[i + 1][0], 0.0) if i + 1 < len(marks) else 0.0
            if below < x:
                f1 = 2 * hits / (found + sizes[1])
                # near zero a little below the lowest mark, else halfway to the next one
                best = max(best, (f1, power, (x + below) / 2 if below else x * 0.75))
    return Lexicon(lexicon.terms, lexicon.exceptions, best[1], best[2])


def score_documents(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``score`` (double), ``weight`` of the matched terms
    and ``n_terms``."""
    def make():
        scorer = kept(("toxicity", lexicon.exceptions, frozenset(lexicon.terms.items())), lexicon.scorer)

        def apply(texts):
            out = ([], [], [])
            for text in texts:
                folded = fold(text)
                found = scorer.matches(folded)
                weight = sum(m[1] for m in found)
                for c, v in zip(out, (lexicon.score(weight, len(folded.split())), weight, len(found)), strict=True):
                    c.append(v)
            return out

        return apply

    return with_python_columns(docs, text_col, {"score": "double", "weight": "double", "n_terms": "long"}, make)


def predicted() -> Column:
    return (F.col("score") >= CUT_SCORE).cast("int")


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """The documents below the cut; same columns."""
    names = {c: f"__doc_{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    scored = score_documents(inner, lexicon, names[text_col]).where(predicted() == 0)
    return scored.select(*[F.col(n).alias(c) for c, n in names.items()])
