"""Every operator and stage on nulls, empty and very long texts, repeats, clashing names, no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spindle.llm import (bpe, chat_format, embedding_dedup, html_extract, mixing, quality, simhash, token_counts,
                         toxicity, url_filter)
from spindle.llm.common import saved
from spindle.llm.queries import tokenizer
from spindle.session import scratch_path

LONG = "word " * 60_000 + "x" * 50_000
ROWS = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, " \n\t ", "en", None, 3),
        (3, "One two three four five six seven eight nine ten eleven.", "en", "s", 56),
        (3, "One two three four five six seven eight nine ten eleven.", "en", "s", 56),
        (4, LONG, "en", "s", len(LONG)), (5, "Ünï “x” … é\x1c 日本 <|endoftext|> <|startoftext|>", "xx", "", 40),
        (None, "No id here but quite a few words of text in one line.", "en", "s", 50)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their outputs.
CLASH = ("size", "source_size", "target", "rate", "copies", "quality", "score", "weight", "n_terms", "n_bytes",
         "n_tokens", "ids", "decoded", "fp", "fingerprint", "root", "id", "label", "key", "order", "host")


@pytest.fixture(scope="module", params=["rows", "empty"])
def docs(spark, request):
    df = spark.createDataFrame(ROWS if request.param == "rows" else [], SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASH}).persist()


def test_mixing(docs):
    rows = mixing.plan_copies(docs).collect()
    assert len(rows) == docs.count()
    assert all(r["size"] is not None and r["copies"] is not None for r in rows)
    by = {(r["doc_id"], r["copies"]) for r in rows if r["doc_id"] == 3}
    assert len(by) <= 1                          # equal rows draw alike
    assert mixing.mix(docs).columns == docs.columns
    mixing.mix(docs).collect()


def test_quality(docs):
    rows = quality.judge_documents(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        if not (r["text"] or "").strip():
            assert r["quality"]["n_words"] == 0 and r["quality"]["base_failed"] and not r["quality"]["kept"]
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == (["3", "3", "None"] if rows else [])


def test_quality_long_lines_and_scripts(spark):
    """A phrase fails short lines and lines that are mostly phrases; other scripts end sentences as they do."""
    long = " ".join(f"word{i} on baking." for i in range(30))
    good = [f"A cookie recipe. {long}", f"{long} The copyright of this text is with the author.",
            " ".join(f"यह वाक्य {i} है।" for i in range(9)), " ".join(f"یہ جملہ {i} ہے۔" for i in range(9)),
            " ".join(f"هل هذا سؤال {i}؟" for i in range(9)), " ".join(f"ภาษาไทยข้อความ{'ก' * (i + 1)}" for i in range(15)),
            " ".join(f"Սա նախադասություն {i} է։" for i in range(9))]
    bad = ["This site uses a cookie to keep you logged in all the time.", "a line without any mark " * 4,
           "Copyright. Cookie. Terms of use. Privacy policy. All rights reserved. " * 4]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    failed = {r["doc_id"]: r["quality"]["n_failed_lines"] for r in quality.judge_documents(docs).collect()}
    assert failed == {i: int(i >= len(good)) for i in range(len(good + bad))}
    assert quality.filter_documents(docs).count() == len(good)


def test_toxicity(docs, spark):
    lexicon = toxicity.Lexicon({"idiot": 2.0}, frozenset({"idiot proof"}), 1.0, 0.05)
    rows = toxicity.score_documents(docs, lexicon).collect()
    assert len(rows) == docs.count() and all(r["score"] == 0.0 for r in rows)
    out = toxicity.drop_toxic(docs, lexicon)
    assert out.columns == docs.columns and out.count() == docs.count()
    none = toxicity.learn_lexicon(docs.select("doc_id", "text"),
                                  spark.createDataFrame([(None, 1), (3, None), (1, 0)], "doc_id long, toxic int"))
    assert none == toxicity.Lexicon()


def test_token_counts(docs, spark):
    out = token_counts.count_tokens(docs, tokenizer("byte_bpe_50k.json"), scratch_path(spark, "cache"))
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["n_bytes"] == len((r["text"] or "").encode()) and (r["n_tokens"] == 0) == (r["n_bytes"] == 0)


def test_bpe(docs):
    rows = bpe.encode_documents(docs, tokenizer("word_bpe_49k.json")).collect()
    assert len(rows) == docs.count()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def test_simhash(docs):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    if rows:
        zero = {(r["id"], r["component_id"]) for r in rows if r["fp"] == 0}
        assert zero == {(None, 1), (1, 1), (2, 1)}
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    # null, 1 and 2 are one group; the two rows of 3 another; the text without an id stays
    assert sorted(str(r["doc_id"]) for r in left.collect()) == (["1", "3", "4", "5", "None"] if rows else [])


def test_pipeline_stages(docs, spark, tmp_path):
    labels = spark.createDataFrame([(3, 0), (4, 1)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.saved(stage(spark, now, str(tmp_path)), f"edge-{name}")
        assert name == "tokens" or now.columns == docs.columns
    assert now.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("rows", [[], [
    (None, None, None), (1, "", None), (2, "http://a.example/x", "<p>One <b>two"), (2, "http://a.example/x", "<p>One <b>two"),
    (3, "://", "<div class=\"ad\">Buy</div><article><p>Text &amp; more&nbsp; text</p><p>" + "long " * 100_000 + "</p></article"),
    (4, "//h", "a < b <script>var x='<p>';</script> c <!-- d")]])
def test_pages(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {c: F.lit("clash") for c in ("text", "host", "pattern", "blocked", "kind")})
    texts = html_extract.extract_pages(pages, html_extract.learn_weights(pages)).collect()
    assert len(texts) == len(rows)
    got = [(r["page_id"], r["text"]) for r in texts]
    if rows:
        assert (None, "") in got and (1, "") in got and got.count((2, "One two")) == 2
        assert (3, "Text & more text\n" + ("long " * 100_000).strip()) in got and (4, "a < b c") in got
    entries = spark.createDataFrame(
        [("a.example", "block", "2024-01-01"), (None, "block", "2024-01-01"), ("a.example", "allow", None),
         ("a.example", "allow", "2024-01-01")], "pattern string, action string, listed_on string"
    ).withColumn("listed_on", F.col("listed_on").cast("date"))
    for listed in (entries, entries.limit(0)):
        judged = url_filter.filter_captures(pages.withColumn("fetched_on", F.lit("2024-02-01").cast("date")), listed)
        assert sorted(str(r["page_id"]) for r in judged.collect() if r["blocked"]) == (
            ["2", "2"] if rows and listed is entries else [])


def test_names_around_the_page():
    """Names that speak against content drop what they mark, but not the page they stand around."""
    text = "<h1>Title</h1><p>" + "one two three four five six seven " * 20 + "</p>"
    want = "Title\n" + ("one two three four five six seven " * 20).strip()
    junk = "<div class='ad'>Buy this now</div><div id='sidebar'>Other links here</div>"
    weights = html_extract.Weights()
    for page in (f"<div class='layout has-sidebar'>{text}</div>", f"<main class='no-sidebar'>{text}</main>",
                 f"<div class='widget-area'>{text}{junk}</div>", f"<div class='ad'><article>{text}</article>",
                 f"<div class='ad'>Buy<article>{text}</article></div>{junk}", f"<div class='sidebar'>{text}</div>",
                 f"<div class='widget'>{text}<div class='share'>Tell all</div></div>", f"{junk}<div class=notice>{text}</div>",
                 f"<article>{text}{junk}</article>", f"<form><article>{text}</article></form>"):
        assert html_extract.extract(page, weights) == want, page[:60]
    long = "<div class='related'>" + "other words " * 10 + "</div>"
    assert html_extract.extract(f"<body>{text}{long}</body>", weights) == want
    assert html_extract.extract(f"<article>{text}</article><div class='comments'>{long}</div>", weights) == want


def test_url_history(spark):
    entries = spark.createDataFrame([
        ("bad.example", "block", "2024-01-10"), ("bad.example", "none", "2024-02-10"),
        ("bad.example/ok", "allow", "2024-01-20"), ("sub.bad.example", "allow", "2024-01-15")],
        "pattern string, action string, listed_on string").withColumn("listed_on", F.col("listed_on").cast("date"))
    rows = [("http://bad.example/", "2024-01-09", False), ("http://bad.example/", "2024-01-10", True),
            ("http://www.BAD.example:80/x?y", "2024-02-09", True), ("http://bad.example/", "2024-02-10", False),
            ("http://bad.example/ok/page", "2024-01-19", True), ("http://bad.example/ok/page", "2024-01-20", False),
            ("http://sub.bad.example/", "2024-01-14", True), ("http://sub.bad.example/", "2024-01-15", False),
            ("http://notbad.example/", "2024-01-15", False), ("http://bad.example/", None, False), (None, "2024-01-15", False)]
    captures = spark.createDataFrame(rows, "url string, fetched_on string, want boolean").withColumn(
        "fetched_on", F.col("fetched_on").cast("date"))
    out = url_filter.filter_captures(captures, entries).collect()
    assert len(out) == len(rows) and all(r["blocked"] == r["want"] for r in out)


def test_url_patterns_of_any_depth_and_form(spark):
    listed = ("deep.example/a/b/c/d/e", "http://full.example/1/2/3/4/5/6.html?q", "www.bad.example", "port.example:8080",
              "dir.example/Dir/", "root.example/", "//", "/only/a/path")
    entries = spark.createDataFrame([(p, "block", "2024-01-01") for p in listed],
                                    "pattern string, action string, listed_on string").withColumn(
        "listed_on", F.col("listed_on").cast("date"))
    rows = [("http://deep.example/a/b/c/d/e", "deep.example/a/b/c/d/e"), ("http://deep.example/a/b/c/d/e/f/g?x", "deep.example/a/b/c/d/e"),
            ("http://deep.example/a/b/c/d", None), ("http://full.example/1/2/3/4/5/6.html", "full.example/1/2/3/4/5/6.html"),
            ("http://full.example/1/2/3/4/5/7.html", None), ("https://www.bad.example/x", "bad.example"), ("http://sub.bad.example/", "bad.example"),
            ("http://port.example/", "port.example"), ("http://dir.example/dir", "dir.example/dir"), ("http://dir.example/dir/x", "dir.example/dir"),
            ("http://dir.example/directory", None), ("http://root.example/a", "root.example"), ("http://other.example/only/a/path", None)]
    captures = spark.createDataFrame(rows, "url string, want string").withColumn("fetched_on", F.lit("2024-02-01").cast("date"))
    out = url_filter.filter_captures(captures, entries).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["pattern"], r["blocked"], r["n_matches"]) == (r["want"], r["want"] is not None, int(r["want"] is not None)), r


@pytest.mark.parametrize("rows", [[], [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|im_end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, "ann", "late"),
    (1, 300, "ann", "x" * 200_000), (None, None, None, None), (2, 0, "system", "alone")]])
def test_chat(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("clash") for c in ("part", "participant", "mask", "people", "said")})
    out = {(r["conv_id"], r["part"], r["participant"]): r for r in chat_format.rotate(turns).collect()}
    assert set(out) == ({(1, 0, "ann"), (1, 0, "bob"), (1, 1, "ann"), (1, 1, "bob"), (1, None, "ann"), (1, None, "bob"),
                         (None, None, "unknown")} if rows else set())
    if rows:
        r = out[1, 0, "ann"]
        assert r["text"] == ("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>assistant\nHi < |im_end|><|im_end|>\n"
                             + "<|im_start|>user name=bob\n<|im_end|>\n" * 2)
        assert [r["text"][m["start"]:m["end"]] for m in r["mask"]] == ["Hi < |im_end|><|im_end|>"]
        assert out[1, 0, "bob"]["n_own"] == 2 and out[1, 1, "ann"]["n_turns"] == 1


def test_chat_parts_are_bounded(spark):
    """Repeated and missing turn numbers, also of the null conversation: no part is over the
    bound, and the parts in order are the dialogue."""
    rows = ([(None, 0, "ann", "same")] * 23 + [(None, 1, "bob", f"t{i:02}") for i in range(9)]
            + [(None, None, "ann", f"n{i:02}") for i in range(11)] + [(5, None, "eve", f"m{i:02}") for i in range(17)]
            + [(6, 0, "ann", "a"), (6, 9, "ann", "b"), (6, None, "ann", "c")])
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = chat_format.rotate(turns, part_turns=4).collect()
    assert max(r["n_turns"] for r in out) == 4
    for conv, who in ((None, "ann"), (None, "bob"), (5, "eve")):
        mine = sorted((r for r in out if (r["conv_id"], r["participant"]) == (conv, who)), key=lambda r: r["part"])
        assert [r["part"] for r in mine] == list(range(len(mine))) and all(r["n_turns"] == 4 for r in mine[:-1])
        said = sorted((r[1] is None, r[1] or 0, r[2], r[3]) for r in rows if r[0] == conv)
        assert "".join(r["text"] for r in mine) == "".join(
            f"<|im_start|>{'assistant' if w == who else 'user name=' + w}\n{x}<|im_end|>\n" for _, _, w, x in said)
        assert [r["text"][m["start"]:m["end"]] for r in mine for m in r["mask"]] == [
            f"{x}<|im_end|>" for _, _, w, x in said if w == who]
    assert {r["part"] for r in out if r["conv_id"] == 6} == {0, 2, None}     # by number, where numbers bound the parts


@pytest.mark.parametrize("rows", [[], [
    (None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]),
    (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (9, [0.0, -1.0]), (10, [])]])
def test_vectors(spark, rows):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("clash") for c in ("id", "vec", "n_links", "key", "cell", "root")})
    out = sorted(((r["id"], r["n_links"], r["component_id"]) for r in
                  embedding_dedup.near_duplicate_vectors(vectors).collect()), key=str)
    want = [(None, 3, 1), (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7),
            (8, 0, 8), (9, 0, 9), (10, 0, 10)]
    assert out == (sorted(want, key=str) if rows else [])


@pytest.mark.parametrize("small", [embedding_dedup.SMALL, 10])
def test_vectors_of_all_lengths(spark, monkeypatch, small):
    """Rarer lengths are compared as well, with an index of their own or as one cell."""
    monkeypatch.setattr(embedding_dedup, "SMALL", small)
    def turned(n, i):
        return [1.0 if k == i % n else 0.0 for k in range(n)]
    rows = [(100 * n + i, [x * (1 + i % 3) for x in turned(n, i)]) for n, m in ((4, 60), (8, 40), (3, 6)) for i in range(m)]
    rows += [(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [0.5, -0.5])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = {r["id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicate_vectors(vectors).collect()}
    want = {1: (1, 1), 2: (1, 1), 3: (0, 3)}
    for n, m in ((4, 60), (8, 40), (3, 6)):
        want |= {100 * n + i: (m // n - 1, 100 * n + i % n) for i in range(m)}
    assert out == want


def test_simhash_never_broadcasts_exploded_classes(spark):
    """A class has two dozen rows after the explode, of which Spark's guess of their size knows nothing."""
    one = spark.range(2000).select(F.xxhash64("id").alias("fp"))
    fps = one.unionByName(one.select(F.col("fp").bitwiseXOR(F.lit(5)).alias("fp")))
    found = simhash.links(saved(fps.select("fp", F.col("fp").alias("root")), "classes"), 4)
    assert found.count() == len(found.collect()) == 2000
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin [seg" in plan and not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "salt" in x]
