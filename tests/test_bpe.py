"""BPE: Spark merge learning and encoding against a plain-Python reference."""

import json
import os
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spindle.operators import bpe, codec
from spindle.plans import catalog as K

from conftest import SF001


def _python_merges(words: Counter, n: int):
    table = {w: [f"{b:02X}" for b in w.encode("utf-8")] for w in words}
    merges = []
    for r in range(n):
        pairs = Counter()
        for w, f in words.items():
            s = table[w]
            for p in zip(s, s[1:]):
                pairs[p] += f
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p[0] + " " + p[1]))
        merges.append((r, best[0], best[1], pairs[best]))
        for w in table:
            s, out, i = table[w], [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == best:
                    out.append(s[i] + s[i + 1]); i += 2
                else:
                    out.append(s[i]); i += 1
            table[w] = out
    return merges, table


def test_learn_and_encode_match_python(spark):
    docs = K.documents(spark, SF001).orderBy("doc_id").limit(20)
    toks = codec.explode_pretokens(docs)
    words = Counter(r.token for r in toks.collect())
    want, table = _python_merges(words, 12)
    got = [tuple(r) for r in bpe.learn_merges(toks, 12).orderBy("rank").collect()]
    assert got == want
    merges = spark.createDataFrame(got, "rank int, a string, b string, freq bigint")
    enc = {r.token: r.ids for r in bpe.bpe_encode(toks.select("token").distinct(), merges).collect()}
    sym_id = {a + b: 257 + r for r, a, b, _ in got}
    for w, syms in table.items():
        assert enc[w] == [sym_id.get(s, int(s, 16) if len(s) == 2 else -1) for s in syms]
        assert all(i >= 0 for i in enc[w])


def test_documents_in_one_pass_equal_tokens(spark):
    docs = K.documents(spark, SF001).limit(10).union(
        spark.createDataFrame([(-1, ""), (-2, None)], "doc_id bigint, text string"))
    toks = codec.explode_pretokens(docs)
    merges = bpe.learn_merges(toks, 8)
    want = {}
    for r in bpe.bpe_encode(toks, merges).orderBy("doc_id", "pos").collect():
        want.setdefault(r.doc_id, []).extend(r.ids)
    got = {r.doc_id: r.ids for r in bpe.bpe_encode_documents(docs, merges).collect()}
    assert got == want | {-1: [], -2: []}


def _merge_word(s, pair):
    out, i = [], 0
    while i < len(s):
        if i + 1 < len(s) and (s[i], s[i + 1]) == pair:
            out.append(s[i] + s[i + 1]); i += 2
        else:
            out.append(s[i]); i += 1
    return out


def test_many_merges_a_round_equal_one_at_a_time():
    """Few letters and small counts: ties, conflicts and pairs of equal symbols abound."""
    rng, several = random.Random(7), 0
    for case in range(300):
        letters = ["61", "62", "63", "64", "20"][:rng.randint(1, 5)]
        words = Counter()
        for _ in range(rng.randint(1, 25)):
            words["".join(chr(int(rng.choice(letters), 16)) for _ in range(rng.randint(1, 9)))] += rng.randint(1, 4)
        want, _ = _python_merges(words, 30)
        table = [([f"{b:02X}" for b in w.encode()], f) for w, f in words.items()]
        got, top = [], rng.choice([1, 3, 10, 1000])
        while len(got) < 30:
            counts = Counter()
            for s, f in table:
                for a, b in zip(s, s[1:]):
                    counts[f"{a} {b}"] += f
            best = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:top]
            taken = bpe.next_merges(best, len(best) < top, 30 - len(got))
            if not taken:
                break
            several += len(taken) > 1
            for a, b, n in taken:
                got.append((len(got), a, b, n))
                table = [(_merge_word(s, (a, b)), f) for s, f in table]
        assert got == want, case
    assert several > 100


@pytest.mark.parametrize("top, cut", [(2048, 64), (40, 5)])
def test_hundreds_of_merges_match_python(spark, top, cut, monkeypatch):
    docs = K.documents(spark, SF001).filter("doc_id % 4 = 0")
    toks = codec.explode_pretokens(docs).unionByName(
        spark.createDataFrame([(-1, 0, None), (-1, 1, "a"), (-1, 2, "")], "doc_id bigint, pos bigint, token string"),
        allowMissingColumns=True)
    want, _ = _python_merges(Counter(r.token for r in toks.filter("token is not null").collect()), 150)
    rounds, plain = [], bpe.next_merges
    monkeypatch.setattr(bpe, "next_merges", lambda *a: rounds.append(1) or plain(*a))
    got = [tuple(r) for r in bpe.learn_merges(toks, 150, top_pairs=top, merges_a_cut=cut).orderBy("rank").collect()]
    assert got == want
    assert len(rounds) < 75


def test_merges_from_pieces_equal_one_at_a_time():
    """Words cut at all pairs but the most frequent ones give the same merges, whatever the cut."""
    rng, several = random.Random(11), 0
    for case in range(300):
        letters = "abcd "[:rng.randint(1, 5)]
        words = Counter()
        for _ in range(rng.randint(1, 25)):
            words["".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))] += rng.randint(1, 4)
        want, _ = _python_merges(words, 30)
        table, got = [([f"{b:02X}" for b in w.encode()], f) for w, f in words.items()], []
        while len(got) < 30:
            counts = Counter()
            for s, f in table:
                for p in zip(s, s[1:]):
                    counts[p] += f
            if not counts:
                break
            floor = rng.choice([0, *(n for n in counts.values() if n < max(counts.values()))])
            pieces = Counter()
            for s, f in table:
                start = 0
                for i in range(1, len(s) + 1):
                    if i == len(s) or counts[s[i - 1], s[i]] <= floor:
                        if i - start > 1:
                            pieces[" ".join(s[start:i])] += f
                        start = i
            taken = bpe.piece_merges(list(pieces.items()), floor, 30 - len(got))
            assert taken and all(n > floor for _, _, n in taken)
            several += len(taken) > 1
            for a, b, n in taken:
                got.append((len(got), a, b, n))
                table = [(_merge_word(s, (a, b)), f) for s, f in table]
        assert got == want, case
    assert several > 200


def test_helpers_travel_by_value():
    """A worker needs no copy of this library to merge the symbols of a word."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    sent = cloudpickle.dumps(bpe._encode_word)
    code = "import pickle, sys; print(pickle.load(sys.stdin.buffer)(['61', '62', '63'], {('61', '62'): 0}))"
    got = subprocess.run([sys.executable, "-I", "-c", code], input=sent, capture_output=True, cwd="/")
    assert got.stdout.decode().strip() == "['6162', '63']", got.stderr.decode()


@pytest.mark.parametrize("pieces, most", [(1 << 16, 12), (60, 75), (0, 150)])
def test_merges_take_few_rounds(spark, pieces, most, monkeypatch):
    """However few pieces may reach the driver, the merges are the same; plenty make few rounds."""
    toks = codec.explode_pretokens(K.documents(spark, SF001).filter("doc_id % 4 = 1"))
    want, _ = _python_merges(Counter(r.token for r in toks.collect()), 100)
    rounds, plain = [], bpe._pairs
    monkeypatch.setattr(bpe, "_pairs", lambda words: rounds.append(1) or plain(words))
    got = [tuple(r) for r in bpe.learn_merges(toks, 100, max_pieces=pieces).orderBy("rank").collect()]
    assert got == want
    assert len(rounds) <= most


def test_merges_end_when_no_pair_is_left(spark):
    toks = spark.createDataFrame([("aaaa",), ("b",), ("",), (None,)], "token string")
    assert [tuple(r) for r in bpe.learn_merges(toks, 9).orderBy("rank").collect()] == [
        (0, "61", "61", 3), (1, "6161", "6161", 1)]
    assert bpe.learn_merges(toks.filter("token = 'b'"), 9).count() == 0


def test_word_by_heap_equals_rescans_and_long_words_are_cheap():
    rng = random.Random(3)
    for _ in range(200):
        words = Counter("".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(8))
        merges, table = _python_merges(words, 12)
        ranks = {(a, b): r for r, a, b, _ in merges}
        for w, syms in table.items():
            assert bpe._encode_word([f"{b:02X}" for b in w.encode()], ranks) == syms
    start, n = time.perf_counter(), 100_000
    ranks = {("61" * 2 ** k, "61" * 2 ** k): k for k in range(8)}
    out = bpe._encode_word(["61"] * n, ranks)
    assert "".join(out) == "61" * n and len(out) == n // 256 + bin(n % 256).count("1")
    assert time.perf_counter() - start < 10


def test_given_files(spark, tmpdir_path):
    """Byte letters: a space is U+0120, e-acute two letters; ids are the file's."""
    letter = {int(h, 16): ch for ch, h in bpe.byte_letters().items()}
    assert len(letter) == 256 and letter[0x20] == "\u0120" and letter[0x41] == "A" and letter[0xAD] == "\u0143"
    lines = ["#version: 0.2", "h e", "he l", letter[0x20] + " w", letter[0xC3] + " " + letter[0xA9], "# #", ""]
    path, vpath = os.path.join(tmpdir_path, "merges.txt"), os.path.join(tmpdir_path, "vocab.json")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines))
    vocab = {letter[b]: 1000 - b for b in range(256)}
    vocab |= {"he": 5, "hel": 6, letter[0x20] + "w": 7, letter[0xC3] + letter[0xA9]: 8, "##": 9, "<|endoftext|> \u4e00": 10}
    with open(vpath, "w", encoding="utf-8") as fh:
        json.dump(vocab, fh)
    merges, ids = bpe.read_merges(spark, path), bpe.read_vocab(spark, vpath)
    assert [tuple(r) for r in merges.orderBy("rank").collect()] == [
        (0, "68", "65"), (1, "6865", "6C"), (2, "20", "77"), (3, "C3", "A9"), (4, "23", "23")]
    assert ids.count() == 256 + 5
    docs = spark.createDataFrame([(1, "hello w\u00e9###"), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r.doc_id: r.ids for r in bpe.bpe_encode_documents(docs, merges, vocab=ids).collect()}
    one = lambda ch: 1000 - ord(ch)
    assert got == {1: [6, one("l"), one("o"), 7, 8, 9, one("#")], 2: [], 3: []}
    with open(path, "a", encoding="utf-8") as fh:
        fh.write("a b c\n")
    with pytest.raises(Exception, match="not a merge"):
        bpe.read_merges(spark, path).collect()


def test_documents_meet_each_distinct_word_once_a_slice(spark, monkeypatch):
    """However small the memo, a word that comes often isn't encoded anew each time."""
    calls, plain = spark.sparkContext.accumulator(0), bpe._encode_word
    merges = spark.createDataFrame([(0, "61", "62", 9)], "rank int, a string, b string, freq bigint")
    docs = spark.createDataFrame([(1, "ab c " * 500), (2, None), (3, "ab"), (1, "")], "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(bpe, "MEMO_WORDS", 1)
    monkeypatch.setattr(bpe, "_encode_word", lambda syms, ranks: calls.add(1) or plain(syms, ranks))
    got = sorted(map(tuple, bpe.bpe_encode_documents(docs, merges).collect()))
    assert got == sorted([(1, ([257] + [32, 99, 32, 257] * 500)[:-1]), (2, []), (3, [257]), (1, [])])
    assert calls.value < 20
