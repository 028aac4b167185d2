"""File sources (temporary inputs), lines, separators and tags."""

import os
import time

import pytest
from pyspark.sql import functions as F

from spindle.functions.text import dataset_tag
from spindle.sources import corpus


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def test_text_dir_scan_order_and_hidden_files(spark, tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/b.txt", "B1\nB2\n")
    _write(f"{d}/a.txt", "A1\nA2")
    _write(f"{d}/.x.txt", "X")
    _write(f"{d}/z.md", "Z")
    _write(f"{d}/sub/s.txt", "S")
    df = corpus.read_text_dir(spark, d).orderBy("doc_id").collect()
    assert [r.file_name for r in df] == ["a.txt", "b.txt"]
    assert [r.text for r in df] == ["A1\nA2", "B1\nB2\n"]
    lines = corpus.text_lines(corpus.read_text_dir(spark, d)).orderBy("doc_id", "line_no").collect()
    assert [r.line for r in lines] == ["A1\n", "A2", "B1\n", "B2\n"]


def test_text_dir_reads_every_listed_file(spark, tmpdir_path):
    names = sorted(["a b.txt", "é.txt", "100%.txt", "c#d.txt", "e%20f.txt", "plain.txt", "q?.txt"])
    for n in names:
        _write(f"{tmpdir_path}/{n}", f"text of {n}")
    rows = corpus.read_text_dir(spark, tmpdir_path).orderBy("doc_id").collect()
    assert [(r.doc_id, r.file_name, r.text) for r in rows] == [(i, n, f"text of {n}") for i, n in enumerate(names)]


def test_text_dir_with_a_name_spark_hides_is_an_error(spark, tmpdir_path):
    _write(f"{tmpdir_path}/a.txt", "A")
    _write(f"{tmpdir_path}/_h.txt", "H")
    with pytest.raises(ValueError, match="_h.txt"):
        corpus.read_text_dir(spark, tmpdir_path)


def test_prompt_ids_never_collide(spark):
    conv = spark.createDataFrame([(1, 1000, "user", "a"), (2, 0, "user", "b"), (1, 1, "assistant", "c")],
                                 "conv_id bigint, turn bigint, role string, text string")
    assert {(r.seq_id, r.text) for r in corpus.read_prompts(conv).collect()} == {("1:1000", "a"), ("2:0", "b")}


def test_no_local_scratch_on_a_cluster():
    from spindle.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_empty_dir_is_an_error(spark, tmpdir_path):
    with pytest.raises(ValueError):
        corpus.read_text_dir(spark, tmpdir_path)


def test_text_file_and_missing_file(spark, tmpdir_path):
    p = f"{tmpdir_path}/one.txt"
    _write(p, "a\r\nb\n\nc")
    assert corpus.read_text_file(spark, p).collect()[0].text == "a\nb\n\nc"
    lines = [r.line for r in corpus.read_text_lines(spark, p).orderBy("line_no").collect()]
    assert lines == ["a\n", "b\n", "\n", "c"]
    with pytest.raises(FileNotFoundError):
        corpus.read_text_file(spark, f"{tmpdir_path}/missing.txt")


def test_open_corpus_fallback_and_paths(spark, tmpdir_path):
    def broken(_spark):
        raise IOError("offline")
    fb = corpus.open_corpus(spark, "tiny-shakespeare", {"tiny-shakespeare": broken}).collect()[0].text
    assert fb.startswith("From fairest creatures") and len(fb) == 200 * len(corpus.C.FALLBACK_STANZA)
    with pytest.raises(FileNotFoundError):
        corpus.open_corpus(spark, f"{tmpdir_path}/nope.txt")
    _write(f"{tmpdir_path}/c.txt", "x")
    assert corpus.open_corpus(spark, f"{tmpdir_path}/c.txt").collect()[0].text == "x"


def test_with_separator(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "doc_id bigint, text string")
    got = [r.text for r in corpus.with_separator(df).orderBy("doc_id").collect()]
    assert "".join(got) == "a\nb\nc"


@pytest.mark.parametrize("path,tag", [
    ("a.txt", "a"), (".txt", ".txt"), ("..txt", "..txt"), ("a..txt", "a."), (".a.txt", ".a"),
    ("noext", "noext"), ("a.b.c", "a.b"),
    ("/x/y/long_name_that_is_more_than_thirty_two_chars.txt", "long_name_that_is_more_than_thir"),
    ("/", ""), ("", ""), ("tiny-shakespeare", "tinyshakes"), ("wikitext-103", "wikitext103"),
    ("bookcorpus", "bookcorpus"),
])
def test_dataset_tag(spark, path, tag):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(dataset_tag("p").alias("t")).collect()[0].t == tag


def test_lines_of_files_cut_into_splits(spark, tmpdir_path):
    texts = {"a b.txt": "".join(f"line {i} é\r\n" for i in range(900)) + "open end",
             "b%.txt": "\n\nx\ry\n", "c.txt": "", "d.txt": "one\n" * 700}
    for n, t in texts.items():
        with open(f"{tmpdir_path}/{n}", "w", newline="") as f:
            f.write(t)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = corpus.read_dir_lines(spark, tmpdir_path)
        rows = df.orderBy("doc_id", "line_no").collect()
        alone = corpus.read_text_lines(spark, f"{tmpdir_path}/a b.txt").orderBy("line_no").collect()
        assert spark.read.text(f"{tmpdir_path}/a b.txt").rdd.getNumPartitions() > 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for i, (n, t) in enumerate(sorted(texts.items())):
        mine = [r for r in rows if r.file_name == n]
        want = t.replace("\r\n", "\n").replace("\r", "\n")
        assert "".join(r.line for r in mine) == want and all(r.doc_id == i for r in mine)
        assert [r.line_no for r in mine] == list(range(len(mine)))
        assert [r.line for r in mine] == want.splitlines(keepends=True)
    assert "".join(r.line for r in alone) == texts["a b.txt"].replace("\r\n", "\n")


def test_chunks_of_a_file_are_its_text_and_ids(spark, tmpdir_path):
    """One long line, lines, spaces at ends and in rows, a byte order mark, no byte; small splits and batches."""
    from spindle.operators import codec, packing
    long = "".join(f"wörd{i % 97},  7{i}\t x" + " " * (i % 4) for i in range(900))
    texts = {"a long.txt": long, "b.txt": "x y\r\n z\r \n\n" * 300 + " ", "c.txt": "  ", "d.txt": "", "e.txt": "\ufeffone two",
             "f.txt": "solid" * 400, "g.txt": " "}
    for n, t in texts.items():
        with open(f"{tmpdir_path}/{n}", "w", newline="", encoding="utf-8") as f:
            f.write(t)
    small = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1",
             "spark.sql.execution.arrow.maxRecordsPerBatch": "50"}
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        rows = corpus.read_dir_chunks(spark, tmpdir_path).orderBy("doc_id", "place").collect()
        one = corpus.read_text_chunks(spark, f"{tmpdir_path}/a long.txt")
        whole = corpus.read_text_file(spark, f"{tmpdir_path}/a long.txt")
        v = codec.build_vocab(codec.explode_pretokens(whole), 60)
        parts = codec.encode(one, v).orderBy("doc_id").collect()
        blocks = [[packing.pack_blocks(packing.with_offsets(codec.encode(corpus.by_document(d, "doc_id"), v), ordered=True))
                   .orderBy("step", "row").collect()] for d in (one, whole)]
        assert len(parts) > 20
    finally:
        for k, v_ in old.items():
            spark.conf.set(k, v_)
    for i, (n, t) in enumerate(sorted(texts.items())):
        mine = [r for r in rows if r.file_name == n]
        assert "".join(r.text for r in mine) == t.replace("\r\n", "\n").replace("\r", "\n")
        assert all(r.doc_id == i for r in mine) and len({r.place for r in mine}) == len(mine)
        assert all(r.text.startswith(" ") for r in mine[1:])
    want = codec.encode(whole, v).collect()[0].ids
    assert [i for r in parts for i in r.ids] == want
    assert blocks[0] == blocks[1] and blocks[0][0]
    with pytest.raises(FileNotFoundError):
        corpus.read_text_chunks(spark, f"{tmpdir_path}/missing.txt")
