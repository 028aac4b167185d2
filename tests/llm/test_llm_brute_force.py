"""The registered queries against plain versions, the libraries, or DuckDB."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from spindle.llm import mixing, toxicity
from spindle.llm.bpe import TextCodec
from spindle.llm.components import components
from spindle.llm.html_extract import Weights, extract
from spindle.llm.oracle import SQL
from spindle.llm.queries import QUERIES, tokenizer
from spindle.llm.simhash import fingerprint, links, segment_plan
from spindle.llm.token_counts import TokenCounter

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def read(name, columns, sf=SMALL):
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def library(name):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer(name))


def test_names():
    ops = [q for q in entry.queries() if re.match(r"op\d+_", q)]
    assert sorted(int(q[2:].split("_")[0]) for q in ops) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{MID}/{t}.parquet'")
    cur = con.execute(SQL[name])
    columns = sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in columns]
    want = Counter(tuple(str(r[i]) for i in at) for r in cur.fetchall())
    df = QUERIES[name](spark, MID)
    assert sorted(df.columns) == columns
    assert Counter(tuple(str(v) for v in r) for r in df.select(*columns).collect()) == want


def test_mixing_targets(spark):
    sizes = [("a", 100), ("b", 10_000), ("c", 50), (None, 5000), ("d", 0), ("e", 3)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(sizes, "source string, size long"), (5, 2, 1)).collect()}
    names = sorted(s for s, _ in sizes if s) + [None]
    size, weight = dict(sizes), {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, capped = float(sum(size.values())), set()
    while True:                                  # share out, cap, share the excess out again
        share = left / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and weight[s] * share >= 3 * size[s]}
        if not over:
            break
        capped |= over
        left -= sum(3 * size[s] for s in over)
    for s in names:
        assert got[s] == pytest.approx(3 * size[s] if s in capped else weight[s] * share)
    assert sum(got.values()) == pytest.approx(sum(size.values()))


def test_mixing_near_target(spark):
    rows = QUERIES["op1_mixing"](spark, "/root/testdata/sf0.1").collect()
    text = {i: s for i, s in read("documents", "doc_id, source", "/root/testdata/sf0.1")}
    taken, target = Counter(), {}
    for r in rows:
        taken[text[r.doc_id]] += r.taken
        target[text[r.doc_id]] = r.target
        assert r.taken <= 3 * r["size"]
    assert all(abs(taken[s] - t) <= 0.15 * t for s, t in target.items())
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.03


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in QUERIES["op3_toxicity"](spark, sf).collect()}
    marks = Counter()
    for i, toxic in read("labels", "doc_id, toxic", sf):
        assert rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= rows[i].score <= 1 and rows[i].predicted == (rows[i].score >= 0.3)
        if rows[i].held_out:
            marks[toxic, rows[i].predicted] += 1
    f1 = 2 * marks[1, 1] / (2 * marks[1, 1] + marks[0, 1] + marks[1, 0])
    assert f1 > 0.9, marks


def test_toxicity_folding():
    lexicon = toxicity.Lexicon({"idiot": 3.0, "scum": 2.0}, frozenset({"idiot proof"}))
    find = lambda t: [m[2] for m in lexicon.scorer().matches(toxicity.fold(t))]
    assert find("You ID10T, ｉｄｉｏｔ, іdіоt, id​iot and $cum, sc­um!") == ["idiot"] * 4 + ["scum"]
    assert find("an idiot proof lid") == [] and find("an idiot proofread it") == ["idiot"]
    assert find("viridiot") == [] and find("idiots") == ["idiot"]


def test_toxicity_brute_force(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet").select("doc_id", "text")
    lexicon = toxicity.learn_lexicon(docs, spark.read.parquet(f"{MID}/labels.parquet"))
    assert lexicon.terms
    for r in toxicity.score_documents(docs, lexicon).collect():
        f = toxicity.fold(r.text)
        weight = sum(w for t, w in lexicon.terms.items() for m in re.finditer(re.escape(t), f)
                     if not (m.start() and f[m.start() - 1].isalpha())
                     and not any(f.startswith(p, k) and k <= m.start() < k + len(p)
                                 for p in lexicon.exceptions for k in range(max(0, m.start() - len(p)), m.start() + 1)))
        assert math.isclose(r.score, lexicon.score(weight, len(f.split())))


def test_extraction(spark):
    pages = dict(read("pages", "page_id, html", MID))
    got = {r.page_id: r for r in QUERIES["op4_html_extraction"](spark, MID).collect()}
    assert set(got) == set(pages)
    import html
    for i, page in pages.items():
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>?", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)
        assert got[i].text == want and got[i].n_chars == len(want)


def test_best_region_brute_force():
    """The linear scan against all stretches."""
    from spindle.llm.html_extract import tokens
    rng = np.random.default_rng(3)
    w = Weights({"p": 0.9, "i": 0.2, "div": 0.01, "": 0.3}, {"p": -0.4, "i": -1.7, "div": -6.0})
    for _ in range(150):
        page = "".join(rng.choice(["<p>", "</p>", "<i>", "</i>", "<div>", "</div>", " one", " two three"], 24))
        parts = list(tokens(page))
        value = [w.tag(k) if n is not None else c * w.word(k) for k, n, _, c, _, _ in parts]
        sums = [sum(value[a:b]) for a in range(len(parts)) for b in range(a + 1, len(parts) + 1)]
        best = max(sums)
        found = extract(page, w).split()
        options = []
        for a in range(len(parts)):
            for b in range(a + 1, len(parts) + 1):
                if abs(sum(value[a:b]) - best) < 1e-9:
                    options.append(" ".join(t or "" for _, _, t, _, _, _ in parts[a:b]).split())
        assert found in options or best <= 0


def test_token_counts(spark):
    rows = dict(read("documents", "doc_id, text", MID))
    want = {i: len(library("byte_bpe_50k.json").encode(t, add_special_tokens=False).ids) for i, t in list(rows.items())[:300]}
    got = {r.doc_id: r for r in QUERIES["op5_token_counts"](spark, MID).collect()}
    assert all(got[i].n_tokens == n and got[i].over_limit == (n > 512) for i, n in want.items())
    assert all(got[i].n_bytes == len(t.encode()) for i, t in rows.items())


def test_token_cache(spark, tmp_path):
    """Calls on one cache: all documents against the library, stored counts reused, new texts
    added, another tokenizer's counts kept apart."""
    from spindle.llm.queries import tokenizer
    from spindle.llm.token_counts import count_tokens
    rows = read("documents", "doc_id, text", MID)
    texts, cache = {t or "" for _, t in rows}, f"{tmp_path}/cache"
    first = rows[:len(rows) // 2]
    for name, part, held in (("byte_bpe_50k.json", first, {t or "" for _, t in first}), ("byte_bpe_50k.json", rows, texts),
                             ("byte_bpe_50k.json", rows, texts), ("word_bpe_49k.json", rows, texts)):
        docs = spark.createDataFrame([tuple(r) for r in part], "doc_id long, text string")
        model = library(name)
        got = count_tokens(docs, tokenizer(name), cache).select("doc_id", "n_tokens").collect()
        assert sorted(map(tuple, got)) == sorted((i, len(model.encode(t or "", add_special_tokens=False).ids)) for i, t in part)
        kept = spark.read.parquet(cache).groupBy("tokenizer").count().collect()
        assert len(held) in [r["count"] for r in kept] and len(kept) == 1 + (name == "word_bpe_49k.json")


HARD = ["", " ", "a  b\n\n c\t\td \r\n", "x<|endoftext|> y<|startoftext|>Z", "İstanbul ΑΣ ς Ω é é ½ Ⅷ", "a\x1cb \x85 \xa0 c d",
        "don't I'M 'S x'll 12345 3.5", "日本語テキスト 😀👩‍👩‍👧", "ab" * 3000 + "!" * 500, "  lead and trail  \n", " \n x",
        "Ǆ ŉ ẞ µ ª × ÷ ﬁ", "​⁠zero", "tab\there\x0bvt\x0cff", "퟿\U0010ffff\x00\x01"]


def test_tokenizers_on_hard_texts():
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        counter = TokenCounter(tokenizer(name))
        for t in HARD:
            if name.endswith(".json"):
                assert counter.count(t) == len(library(name).encode(t, add_special_tokens=False).ids), t
            else:
                import sentencepiece
                assert counter.count(t) == len(sentencepiece.SentencePieceProcessor(model_file=tokenizer(name)).encode(t))
    codec, lib = TextCodec(tokenizer("word_bpe_49k.json")), library("word_bpe_49k.json")
    for t in HARD:
        ids = lib.encode(t, add_special_tokens=False).ids
        packed = codec.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == ids, t
        assert codec.decode(packed) == lib.decode(ids, skip_special_tokens=False)


def test_bpe(spark):
    lib = library("word_bpe_49k.json")
    got = {r.doc_id: r for r in QUERIES["op7_bpe"](spark, SMALL).collect()}
    for i, t in read("documents", "doc_id, text"):
        ids = lib.encode(t, add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def plain_fingerprint(text, shingle=4):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    w = WORD.findall(w)
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))] if w else []
    return sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in h) > len(h))


def plain_components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_simhash(texts):
    fps = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(fps)
    near = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if (fps[a] ^ fps[b]).bit_count() <= 4]
    return fps, plain_components(ids, near)


def test_simhash(spark):
    fps, component = plain_simhash(dict(read("documents", "doc_id, text")))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash"](spark, SMALL).collect()}
    assert got == {i: (f"{fps[i]:016x}", component[i]) for i in fps}
    assert fingerprint("", 4, 42) == 0


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 6])
def test_links_brute_force(spark, bits):
    plan = segment_plan(bits)
    assert sum(n for _, n, _ in plan) == 64 and sum(r + 1 for _, _, r in plan) == bits + 1
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2 ** 63, 6)
    fps = sorted({int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 4), replace=False))
                  for b in base for _ in range(30)})
    signed = [f - 2 ** 64 if f >= 2 ** 63 else f for f in fps]
    df = spark.createDataFrame([(s, s) for s in signed], "fp long, root long")
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in links(df, bits).collect()}
    want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i]
            if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= bits}
    assert got == want


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(1000, 1300)] + [(7, int(k)) for k in range(2000, 2400)]
    edges += [tuple(map(int, e)) for e in rng.integers(0, 500, (200, 2))] + [(5, 5)]
    ids = {v for e in edges for v in e}
    want = plain_components(sorted(ids), edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    groups = lambda m: {frozenset(v for v in m if m[v] == r) for r in set(m.values())}
    assert {g for g in groups(want) if len(g) > 1} == groups(got)


def test_vectors_recall(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base[rng.integers(0, 60, 700)] + rng.normal(scale=0.25, size=(700, 16)), rng.normal(size=(300, 16))])
    from spindle.llm.embedding_dedup import near_duplicate_vectors
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.id: r for r in near_duplicate_vectors(df.repartition(4)).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.9 * near.sum()
    whole = plain_components(range(len(x)), np.argwhere(near).tolist())
    assert np.mean([got[i].component_id == whole[i] for i in whole]) > 0.9


def plain_quality(text):
    """None for a rejected document, else its cleaned text."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(text.items()))
    return {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op2_quality_rules']}) WHERE kept").fetchall()}


def test_pipeline(spark):
    """Stage by stage against plain Python on a small table."""
    docs = read("documents", "doc_id, text, source", MID)
    lexicon = toxicity.learn_lexicon(spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet"))
    scorer = lexicon.scorer()
    clean = {i: t for i, t, _ in docs if lexicon.score(*scorer.weigh(t)) < 0.3}
    keep = plain_quality(clean)
    from spindle.llm.quality import judge_documents
    judged = {r.doc_id: r.quality.cleaned for r in judge_documents(spark.read.parquet(f"{MID}/documents.parquet")).collect()}
    _, component = plain_simhash({i: judged[i] for i in keep})
    alone = {i: judged[i] for i in keep if component[i] == i}
    source = {i: s for i, _, s in docs}
    sizes = Counter()
    for i, t in alone.items():
        sizes[source[i]] += len(WORD.findall(t))
    target = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(list(sizes.items()), "source string, size long"), (5, 2, 1)).collect()}
    want = Counter()
    codec = TextCodec(tokenizer("word_bpe_49k.json"))
    for i, t in alone.items():
        rate = target[source[i]] / sizes[source[i]]
        u = int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:13], 16) / 2 ** 52
        ids = codec.encode(t)
        row = (i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest())
        want[row] += math.floor(rate) + (u < rate - math.floor(rate))
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, MID).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == +want
