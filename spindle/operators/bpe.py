"""Byte-pair merges: T3 (learn) and T4 (encode).

Symbols are written as upper-case hex of their bytes; a word is its symbols
between spaces of their own (``" E3  81  82 "``), so a merge is one plain
replacement, leftmost first, and never needs escaping.

* ``learn_merges``: a round counts the pairs of the *distinct* words, weighted by
  frequency, and cuts the words where a pair isn't among the most frequent ones. Equal
  pieces are added up, and all merges more frequent than any pair that was cut happen inside
  the pieces (``piece_merges``): the driver gets ``MAX_PIECES`` of them at most, learns these
  merges from them and the words take them: hundreds of merges a round, the same ones in the
  same order as one at a time. Fewer pairs are kept if there are more pieces. If not even
  those of two counts fit, the best ``TOP_PAIRS`` pairs alone say which merges must be
  next (``next_merges``).
* ``read_merges`` and ``read_vocab``: given merge and vocabulary files with byte letters.
* ``bpe_encode``: distinct pre-tokens are encoded once with ``mapInPandas``
  (the merge table, bounded by the number of merges, is broadcast), then
  joined back to the occurrences.
* ``bpe_encode_documents``: whole documents in one pass; the distinct words of a bounded
  number of pre-tokens at a time are looked up in a bounded memo per task, and rows are put
  together in arrays; no join and no shuffle. A word of n bytes takes O(n log n).

Ids: bytes 0..255, end-of-text 256, merge ``r`` (0-based rank) is 257 + r; with a given
vocabulary its own.
"""

from __future__ import annotations

import heapq
import sys
from collections import defaultdict

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle import constants as C
from spindle.functions.text import pretokenize, utf8_hex
from spindle.operators import codec
from spindle.session import drop_path, scratch_path

#: Helpers of this module travel to the workers by value, with the values they read.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_PAIRS = 2048          # best pairs that reach the driver a round
MAX_PIECES = 1 << 16      # distinct pieces of words that reach the driver a round
MERGES_A_CUT = 64         # merges applied to the written words before they are written anew
FIRST_KEPT = 64           # pairs that words aren't cut at, in the first round


def word_table(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """``(word, freq, syms)`` from pre-token occurrences."""
    w = tokens.groupBy(F.col(token_col).alias("word")).agg(F.count(F.lit(1)).alias("freq"))
    hexes = F.regexp_extract_all(utf8_hex("word"), F.lit(".."), 0)
    return w.select("word", "freq", F.concat(F.lit(" "), F.array_join(hexes, "  "), F.lit(" ")).alias("syms"))


def _pairs(words: DataFrame) -> DataFrame:
    """``(pair, n)`` of every adjacent pair of ``(n, syms)``."""
    arr = F.split(F.trim(F.col("syms")), "  ")
    size = F.size(arr)
    z = F.arrays_zip(F.slice(arr, 1, size - 1).alias("a"), F.slice(arr, 2, size - 1).alias("b"))
    return (words.filter(size >= 2)
            .select("n", F.explode(z).alias("p"))
            .select(F.concat_ws(" ", "p.a", "p.b").alias("pair"), "n"))


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _merged(words: DataFrame, since: list[tuple[str, str]]) -> DataFrame:
    """``(n, syms)`` after the merges, in order; words of one symbol are left out."""
    if not since:
        return words
    ranks = {pair: r for r, pair in enumerate(since)}

    def run(batches):
        import pyarrow as pa
        for b in batches:
            syms = [s.split() for s in b.column("syms").to_pylist()]
            syms = [_encode_word(s, ranks) if any(p in ranks for p in zip(s, s[1:])) else s for s in syms]
            left = pa.array([len(s) > 1 for s in syms], pa.bool_())
            out = pa.array([f" {'  '.join(s)} " for s in syms], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("n"), out], ["n", "syms"]).filter(left)

    return words.select("n", "syms").mapInArrow(run, "n bigint, syms string")


def _pieces(words: DataFrame, kept: set[tuple[str, str]]) -> DataFrame:
    """``(syms, n)`` of the distinct pieces of two symbols or more that are left when the
    words are cut at all pairs but ``kept``."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            pieces, counts = [], []
            for word, n in zip(b.column("syms").to_pylist(), b.column("n").to_pylist()):
                syms, start = word.split(), 0
                for i in range(1, len(syms) + 1):
                    if i == len(syms) or (syms[i - 1], syms[i]) not in kept:
                        if i - start > 1:
                            pieces.append(" ".join(syms[start:i]))
                            counts.append(n)
                        start = i
            yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(counts, pa.int64())], ["syms", "n"])

    return words.select("n", "syms").mapInArrow(run, "syms string, n bigint").groupBy("syms").agg(F.sum("n").alias("n"))


def piece_merges(pieces: list[tuple[str, int]], floor: int, room: int) -> list[tuple[str, str, int]]:
    """The next merges that are more frequent than ``floor``, ``room`` at most, from the
    pieces ``(syms, n)`` of all words cut at every pair no more frequent than ``floor``.

    All of these are inside the pieces: where symbols p, q stand side by side, the last
    symbol of p and the first of q stood so when the words were cut. A merged symbol comes
    from one row of symbols only (no merge crosses its ends, so those inside are the same
    everywhere), so this pair was at least as frequent as (p, q) is. Runs of equal symbols
    are never cut inside, so they are merged from the same end.
    """
    syms, weight = [s.split(" ") for s, _ in pieces], [n for _, n in pieces]
    count: dict[tuple[str, str], int] = defaultdict(int)
    where: dict[tuple[str, str], set[int]] = defaultdict(set)
    for i, s in enumerate(syms):
        for p in zip(s, s[1:]):
            count[p] += weight[i]
            where[p].add(i)
    heap = [(-n, f"{p[0]} {p[1]}", p) for p, n in count.items() if n > floor]
    heapq.heapify(heap)
    taken: list[tuple[str, str, int]] = []
    while heap and len(taken) < room:
        n, _, best = heapq.heappop(heap)
        if count[best] != -n:
            continue                                            # an older count
        taken.append((*best, -n))
        ranks, changed = {best: 0}, set()
        for i in where.pop(best):
            old = syms[i]
            syms[i] = new = _encode_word(old, ranks)
            if len(new) == len(old):
                continue                                        # merged away since
            for s, sign in ((old, -weight[i]), (new, weight[i])):
                for p in zip(s, s[1:]):
                    count[p] += sign
                    changed.add(p)
            for p in zip(new, new[1:]):
                where[p].add(i)
        for p in changed:
            if count[p] > floor:
                heapq.heappush(heap, (-count[p], f"{p[0]} {p[1]}", p))
    return taken


def next_merges(top: list[tuple[str, int]], complete: bool, room: int) -> list[tuple[str, str, int]]:
    """The merges that come next for certain, given the best pairs ``(pair, n)`` by count
    desc, pair asc; ``complete`` says that no other pair exists.

    Merging (a, b) changes only the counts of pairs that end in a or begin with b, and the
    new pairs (x, ab), (ab, y) are no more frequent than (x, a), (b, y) were. So a pair is
    next if no merge taken ends in its first or begins with its second symbol: all that
    was ahead of it is taken, and nothing new can pass it. At equal counts (x, ab) sorts
    after (x, a), but (ab, y) may sort before (b, y), which ends the round where it would
    sort before the pair at hand. A pair of equal symbols ends the round, as its new pairs
    are bounded by itself only. Pairs as rare as the last one of an incomplete list
    aren't all known: only the first of a round may be one.
    """
    known = 0 if complete or not top else top[-1][1]
    tied: dict[int, list[tuple[str, str]]] = defaultdict(list)
    for pair, n in top:
        tied[n].append(tuple(pair.split(" ")))
    taken: list[tuple[str, str, int]] = []
    firsts: set[str] = set()                                    # first symbols of those taken
    merged_by_end: dict[str, list[str]] = defaultdict(list)     # second symbol -> merged symbols
    for pair, n in top[:room]:
        a, b = pair.split(" ")
        if taken:
            if n <= known or a in merged_by_end or b in firsts:
                break
            if any(f"{m} {y}" < pair for x, y in tied[n] if x in merged_by_end for m in merged_by_end[x]):
                break
        taken.append((a, b, n))
        if a == b:
            break
        firsts.add(a)
        merged_by_end[b].append(a + b)
    return taken


def learn_merges(tokens: DataFrame, n_merges: int, token_col: str = "token",
                 top_pairs: int = TOP_PAIRS, merges_a_cut: int = MERGES_A_CUT,
                 max_pieces: int = MAX_PIECES) -> DataFrame:
    """``(rank, a, b, freq)`` of the first ``n_merges`` merges: best count first, equal
    counts by the pair's text. Fewer rows if no pair is left; null tokens have no pairs.
    ``top_pairs``, ``merges_a_cut`` and ``max_pieces`` change the number of jobs, never the merges."""
    spark = tokens.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))     # as many files: each round reads them all
    words, path = _stored(word_table(tokens, token_col).filter(F.length("syms") > 4)
                          .select(F.col("freq").alias("n"), "syms").repartition(spread), "bpe-words")
    merges: list[tuple[int, str, str, int]] = []
    since: list[tuple[str, str]] = []
    n_kept = FIRST_KEPT
    while len(merges) < n_merges:
        now = _merged(words, since)
        if len(since) >= merges_a_cut:
            words, new_path = _stored(now, "bpe-words")
            drop_path(spark, path)
            path, since, now = new_path, [], words
        top = [(r.pair, int(r.n)) for r in
               _pairs(now).groupBy("pair").agg(F.sum("n").alias("n"))
               .orderBy(F.desc("n"), F.asc("pair")).limit(top_pairs).collect()]     # bounded by top_pairs
        complete, room = len(top) < top_pairs, n_merges - len(merges)
        taken: list[tuple[str, str, int]] = []
        while not taken:
            # the most frequent pair that words are cut at
            floor = top[n_kept][1] if n_kept < len(top) else 0 if complete else top[-1][1]
            kept = {tuple(pair.split(" ")) for pair, n in top if n > floor}
            if not kept:
                taken = next_merges(top, complete, room)
                break
            pieces = _pieces(now, kept).limit(max_pieces + 1).collect()              # bounded by max_pieces
            if len(pieces) <= max_pieces:
                taken = piece_merges([(r.syms, int(r.n)) for r in pieces], floor, room)
                n_kept = n_kept * 2 if len(pieces) < max_pieces // 4 and n_kept < top_pairs else n_kept
            else:
                # below all that were kept, of which ties may be more than asked for
                n_kept = min(n_kept, len(kept)) // 2
        n_kept = max(n_kept, 1)
        if not taken:
            break
        for a, b, n in taken:
            merges.append((len(merges), a, b, n))
            since.append((a, b))
    drop_path(spark, path)
    return spark.createDataFrame(merges, "rank int, a string, b string, freq bigint")


# ---------------------------------------------------------------- given files
def byte_letters() -> dict[str, str]:
    """Letter -> hex of its byte, as public byte-level files write them: printable Latin-1
    bytes stand for themselves, the others for the code points from 256 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return ({chr(b): f"{b:02X}" for b in sorted(printable)}
            | {chr(256 + i): f"{b:02X}" for i, b in enumerate(rest)})


def _letters_to_hex(col: Column) -> Column:
    """Hex symbol of a token in byte letters; null if a letter stands for no byte."""
    table = F.create_map(*[F.lit(v) for pair in byte_letters().items() for v in pair])
    hexes = F.transform(F.split(col, ""), lambda ch: F.element_at(table, ch))
    return F.when(~F.exists(hexes, lambda h: h.isNull()), F.array_join(hexes, ""))


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """T4: ``(rank, a, b)`` of a merge file: two tokens in byte letters a line, best first;
    a first line that starts with ``#version`` and empty lines don't count. A line of any
    other form is an error. One file is one row, as merges are bounded by a vocabulary."""
    lines = F.filter(F.split(F.regexp_replace("value", "\r\n?", "\n"), "\n"), lambda s: F.length(s) > 0)
    lines = F.when(F.get(lines, F.lit(0)).startswith("#version"), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines)
    parts = F.split("line", " ", -1)
    rows = (spark.read.text(path, wholetext=True).select(F.posexplode(lines).alias("rank", "line"))
            .select("rank", "line", F.size(parts).alias("k"),
                    _letters_to_hex(F.get(parts, F.lit(0))).alias("a"), _letters_to_hex(F.get(parts, F.lit(1))).alias("b")))
    bad = (F.col("k") != 2) | F.col("a").isNull() | F.col("b").isNull() | (F.col("a") == "") | (F.col("b") == "")
    fault = F.raise_error(F.concat(F.lit("not a merge: "), F.col("line")))
    return rows.select("rank", F.when(bad, fault.cast("string")).otherwise(F.col("a")).alias("a"), "b")


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """T4: ``(sym, id)`` of a vocabulary file, a JSON object of tokens in byte letters and
    their ids. Tokens with other letters (special strings) have no bytes and are left out."""
    whole = spark.read.text(path, wholetext=True)
    return (whole.select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "id"))
            .select(_letters_to_hex(F.col("token")).alias("sym"), "id").filter("sym is not null and sym != ''"))


# ------------------------------------------------------------------- T4 helper
def _encode_word(syms: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the merges lowest rank first, leftmost first, until none applies. The pairs
    wait in a heap and the symbols are linked, so n symbols take O(n log n). In a merge
    table a merge comes after those of its parts; then this is one merge at a time."""
    n = len(syms)
    syms, after, before = list(syms), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((syms[i], syms[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if syms[i] is None or j >= n or ranks.get((syms[i], syms[j])) != rank:
            continue                                            # an older pair, merged since
        syms[i], syms[j] = syms[i] + syms[j], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((syms[i], syms[k]))) is not None:
                heapq.heappush(heap, (r, i))
        h = before[i]
        if h >= 0 and (r := ranks.get((syms[h], syms[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return [s for s in syms if s is not None]


def bpe_encode(tokens: DataFrame, merges: DataFrame, token_col: str = "token") -> DataFrame:
    """T4: one row per occurrence of ``tokens`` plus ``ids`` (ARRAY<INT>).

    Distinct pre-tokens are encoded once; the merge table (bounded by the
    number of merges) is shipped to the tasks as a broadcast variable.
    """
    spark: SparkSession = tokens.sparkSession
    rows = merges.collect()
    table = {(r.a, r.b): r.rank for r in rows}
    sym_id = {r.a + r.b: C.FIRST_WORD_ID + r.rank for r in rows}
    bc = spark.sparkContext.broadcast((table, sym_id))

    def run(batches):
        import pandas as pd
        ranks, ids_of = bc.value
        for pdf in batches:
            out = []
            for w in pdf["word"]:
                syms = _encode_word([f"{b:02X}" for b in w.encode("utf-8")], ranks)
                out.append([ids_of.get(s, int(s, 16) if len(s) == 2 else -1) for s in syms])
            yield pd.DataFrame({"word": pdf["word"], "ids": out})

    distinct = tokens.select(F.col(token_col).alias("word")).distinct()
    coded = distinct.mapInPandas(run, "word string, ids array<int>")
    return tokens.join(coded.withColumnRenamed("word", token_col), token_col, "left")


MEMO_WORDS = 200_000      # words a task remembers before it starts afresh


def bpe_encode_documents(docs: DataFrame, merges: DataFrame, key: str = "doc_id",
                         text_col: str = "text", vocab: DataFrame | None = None) -> DataFrame:
    """T4 on documents: ``(key, ids)``, each row by itself, in one pass. With ``vocab``
    (``read_vocab``) the ids are the file's; a symbol it doesn't hold is an error."""
    rows = merges.collect()                 # bounded by the number of merges
    ranks = {(r.a, r.b): r.rank for r in rows}
    if vocab is None:
        ids_of = {f"{b:02X}": b for b in range(256)} | {r.a + r.b: C.FIRST_WORD_ID + r.rank for r in rows}
    else:
        ids_of = {r.sym: r.id for r in vocab.collect()}         # bounded by the file

    def run(batches):
        import numpy as np
        import pyarrow as pa
        memo: dict[str, list[int]] = {}

        def ids(word):
            found = memo.get(word)
            if found is None:
                if len(memo) >= MEMO_WORDS:
                    memo.clear()
                syms = _encode_word([f"{b:02X}" for b in word.encode("utf-8")], ranks)
                found = memo[word] = [ids_of[s] for s in syms]
            return found

        for whole in batches:
            for b in codec._row_slices(whole, "_tokens"):
                tokens = b.column("_tokens")
                coded = tokens.flatten().dictionary_encode()
                found = [ids(w) for w in coded.dictionary.to_pylist()]
                sizes = np.array([len(f) for f in found], np.int64)
                flat = np.array([i for f in found for i in f], np.int32)
                out = codec._rows_of(coded.indices.to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes, sizes, flat, codec._lengths(tokens))
                yield pa.RecordBatch.from_arrays([b.column(0), out], [key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(key, pretokenize(text_col).alias("_tokens"))
            .mapInArrow(run, f"`{key}` {kind}, ids array<int>"))
