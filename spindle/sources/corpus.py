"""Sources: S1-S9, S14.

A corpus is ``(doc_id BIGINT, text STRING, ...)`` whose order is ``doc_id``.
Files become rows ``(file_name, line_no, line)`` or ``(doc_id, file_name, text)``
with ``doc_id`` taken from the sorted file order, so the global order is a
column, never an accident of partitioning.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from spindle import constants as C
from spindle.functions.text import dataset_tag, normalize_newlines, split_lines
from spindle.session import written


# --------------------------------------------------------------------------- S1
def by_document(df: DataFrame, key: str) -> DataFrame:
    """Range-partition by ``key``, always, into ``spark.sql.shuffle.partitions`` parts.

    The per-document regroup after tokenisation needs its rows clustered by ``key``
    and packing needs them in order of it; both are given by this one exchange of the
    text, so the longer id arrays never move.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, key)


def dealt_out(df: DataFrame) -> DataFrame:
    """The rows of ``df`` dealt evenly to ``spark.sql.shuffle.partitions`` parts. A file's row group is
    read by one task, however large; what costs more than reading is done after this exchange."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_corpus(spark: SparkSession, path: str, text_col: str = "text",
                id_col: str = "doc_id", ordered: bool = False) -> DataFrame:
    """A map-style dataset split (parquet); only its id and text columns.

    ``ordered`` deals the documents to ranges of ids (see ``by_document``).
    """
    df = spark.read.parquet(path)
    df = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                   F.col(text_col).cast("string").alias("text"))
    return by_document(df, "doc_id") if ordered else df


# --------------------------------------------------------------------------- S2
def read_text_file(spark: SparkSession, path: str) -> DataFrame:
    """One UTF-8 file as a single-row corpus; a missing file is an error."""
    _require_exists(spark, path)
    df = spark.read.text(path, wholetext=True)
    return df.select(F.lit(0).cast("bigint").alias("doc_id"),
                     normalize_newlines("value").alias("text"))


def file_chunks(spark: SparkSession, files: list[tuple[str, str, str]]) -> DataFrame:
    """S2 on files of any size: ``(doc_id, file_name, place, text)``, ``files`` being ``(name,
    URI-encoded name, path)`` in the order of ``doc_id``. The chunks of a file in the order
    of ``place`` are its text; a file without a byte has none.

    Every chunk but a file's first begins with a space. No pre-token goes on beyond a
    space or holds one but at its start, so the pre-tokens (and ids) of the chunks, one
    after another, are those of the whole text. The reader cuts large files into splits at
    spaces; words are put together again by batches of a split, and nothing is shuffled.
    Only a file's first and last bytes are looked at beside that: what the reader drops of
    them (a byte order mark, a last space) is put back.
    """
    opened = []
    for i, (name, uri, path) in enumerate(files):
        size, head, tail = _ends(spark, path)
        opened.append((i, name, uri, "\ufeff" if head == b"\xef\xbb\xbf" else "", tail, size))
    order = spark.createDataFrame(opened, "doc_id bigint, file_name string, _uri string, _head string, _tail int, _size bigint")
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for _, _, path in files]
    words = spark.read.text(paths, lineSep=" ").select(
        F.col("_metadata.file_name").alias("_uri"), F.col("_metadata.file_block_start").alias("_start"), "value")

    def join(batches):
        number: dict = {}                           # chunks so far of the split that is read
        for b in batches:
            uri, start, value = (b.column(i) for i in range(3))
            if not b.num_rows:
                continue
            new = pc.or_(pc.not_equal(uri[1:], uri[:-1]), pc.not_equal(start[1:], start[:-1]))
            at = [0, *(np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1).tolist()]
            keys = [(uri[i].as_py(), start[i].as_py()) for i in at]
            place = []
            for key in keys:
                number = {key: number.get(key, -1) + 1}
                place.append(key[1] + number[key])
            runs = pa.ListArray.from_arrays(pa.array([*at, b.num_rows], pa.int32()), value)
            yield pa.RecordBatch.from_arrays([uri.take(pa.array(at)), pa.array(place, pa.int64()), pc.binary_join(runs, " ")],
                                             ["_uri", "place", "text"])

    # a chunk holds a byte at least, so a split has no more chunks than bytes
    chunks = words.mapInArrow(join, "_uri string, place bigint, text string").join(order, "_uri")
    begins = F.when(F.col("place") == 0, F.col("_head")).otherwise(" ")
    last = order.filter(F.col("_tail") == 32).select("doc_id", "file_name", F.col("_size").alias("place"), F.lit(" ").alias("text"))
    return chunks.select("doc_id", "file_name", "place",
                         normalize_newlines(F.concat(begins, F.col("text"))).alias("text")).unionByName(last)


def _ends(spark: SparkSession, path: str) -> tuple[int, bytes, int | None]:
    """A file's size, first three bytes and last byte."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = fs.getFileStatus(jpath).getLen()
    if size == 0:
        return 0, b"", None
    stream = fs.open(jpath)
    try:
        head = bytes(stream.read() for _ in range(min(3, size)))
        stream.seek(size - 1)
        return size, head, stream.read()
    finally:
        stream.close()


def read_text_chunks(spark: SparkSession, path: str) -> DataFrame:
    """S2 on one file of any size: ``(doc_id, text)``, ``doc_id`` being a chunk's place in the
    file. Encoded and packed in that order it gives the ids of the file as one text."""
    return file_chunks(spark, [_one_file(spark, path)]).select(F.col("place").alias("doc_id"), "text")


def read_dir_chunks(spark: SparkSession, directory: str) -> DataFrame:
    """S4 with files of any size: ``(doc_id, file_name, place, text)`` of every ``*.txt``."""
    _require_exists(spark, directory)
    files = _list_txt_files(spark, directory)
    if not files:
        raise ValueError(f"no *.txt files in {directory}")
    return file_chunks(spark, files)


def _one_file(spark: SparkSession, path: str) -> tuple[str, str, str]:
    _require_exists(spark, path)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getName(), jpath.toUri().getRawPath().rsplit("/", 1)[1], path


def _require_exists(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        raise FileNotFoundError(f"{path} not found.")


# --------------------------------------------------------------------------- S3
def text_lines(df: DataFrame, keys=("doc_id",), text_col: str = "text") -> DataFrame:
    """S3: lines of each text with the newline kept (``\\r\\n``/``\\r`` -> ``\\n``)."""
    return df.select(*keys, F.posexplode(split_lines(text_col)).alias("line_no", "line")) \
             .withColumn("line_no", F.col("line_no").cast("bigint"))


def file_lines(spark: SparkSession, files: list[tuple[str, str, str]]) -> DataFrame:
    """S3 on files of any size: ``(doc_id, file_name, line_no, line)``, ``files`` being
    ``(name, URI-encoded name, path)`` in the order of ``doc_id``.

    The reader cuts large files into splits, at lines. Rows of a split are numbered as
    they are read; a split's first line number is the count of the splits before it in
    the file, from a table with one row a split. Only a file's last byte is looked at
    beside that: whether its last line has a newline.
    """
    opened = [(i, name, uri, _ends(spark, path)[2] in (None, 10, 13)) for i, (name, uri, path) in enumerate(files)]
    order = spark.createDataFrame(opened, "doc_id bigint, file_name string, _uri string, _closed boolean")
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for _, _, path in files]
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_name").alias("_uri"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"), "value")
    splits = lines.groupBy("_uri", "_start").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    in_file = Window.partitionBy("_uri").orderBy("_start")
    splits = splits.select(
        "_uri", "_start", "_first", F.sum("_n").over(Window.partitionBy("_uri")).alias("_total"),
        F.coalesce(F.sum("_n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = lines.join(written(splits.join(order, "_uri"), "splits"), ["_uri", "_start"])
    number = F.col("_before") + F.col("_row") - F.col("_first")
    last = (number == F.col("_total") - 1) & ~F.col("_closed")
    return placed.select("doc_id", "file_name", number.alias("line_no"),
                         F.concat("value", F.when(last, "").otherwise("\n")).alias("line"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S3 on a file: ``(doc_id, line_no, line)``."""
    return file_lines(spark, [_one_file(spark, path)]).select("doc_id", "line_no", "line")


def read_dir_lines(spark: SparkSession, directory: str) -> DataFrame:
    """S4 line by line: ``(doc_id, file_name, line_no, line)`` of every ``*.txt``."""
    _require_exists(spark, directory)
    files = _list_txt_files(spark, directory)
    if not files:
        raise ValueError(f"no *.txt files in {directory}")
    return file_lines(spark, files)


# --------------------------------------------------------------------------- S4
def read_text_dir(spark: SparkSession, directory: str) -> DataFrame:
    """Every ``*.txt`` directly inside ``directory``, ordered by file name.

    Returns ``(doc_id, file_name, text)``. A name starting with ``.`` is no match of
    the glob. Spark's readers can't see a name starting with ``_``, so such a file is
    an error, as is a file that is listed but not read, and a directory without any
    ``*.txt``.
    """
    _require_exists(spark, directory)
    files = _list_txt_files(spark, directory)
    if not files:
        raise ValueError(f"no *.txt files in {directory}")
    # File names are metadata the driver already lists; only they become a table. The
    # reader reports names URI-encoded.
    order = spark.createDataFrame([(uri, name, i) for i, (name, uri, _) in enumerate(files)],
                                  "_uri string, file_name string, doc_id bigint")
    # paths are patterns to the reader, so their special characters are escaped
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for _, _, path in files]
    df = (spark.read.text(paths, wholetext=True)
          .select(F.col("_metadata.file_name").alias("_uri"), normalize_newlines("value").alias("text")))
    read = F.coalesce("text", F.raise_error(F.concat(F.lit("not read: "), F.col("file_name"))).cast("string"))
    return order.join(df, "_uri", "left").select("doc_id", "file_name", read.alias("text"))


def _list_txt_files(spark: SparkSession, directory: str) -> list[tuple[str, str, str]]:
    """(name, URI-encoded name, path) of each ``*.txt``, by name."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(directory)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for st in fs.listStatus(jpath):
        name = st.getPath().getName()
        if st.isFile() and name.startswith("_") and name.endswith(".txt"):
            raise ValueError(f"{name}: Spark can't read files whose names begin with an underscore; rename it")
        if st.isFile() and name.endswith(".txt") and not name.startswith("."):
            out.append((name, st.getPath().toUri().getRawPath().rsplit("/", 1)[1], st.getPath().toString()))
    return sorted(out)


# --------------------------------------------------------------------------- S5
def with_separator(df: DataFrame, sep: str = "\n", order_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Append ``sep`` to every row's text except the last in ``order_col`` order.

    Equivalent to joining all rows with ``sep`` without building one string.
    """
    last = df.select(F.max(order_col)).scalar()
    return df.withColumn(text_col, F.when(F.col(order_col) == last, F.col(text_col))
                         .otherwise(F.concat(F.col(text_col), F.lit(sep))))


# --------------------------------------------------------------------------- S6
def fallback_corpus(spark: SparkSession) -> DataFrame:
    """The bundled stanza repeated 200 times, as a one-row corpus."""
    return spark.range(1).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit(C.FALLBACK_STANZA), C.FALLBACK_REPEAT).alias("text"))


# --------------------------------------------------------------------------- S7
def open_corpus(spark: SparkSession, choice: str, registry: dict | None = None, chunked: bool = False) -> DataFrame:
    """A named dataset from ``registry`` (name -> callable(spark) -> DataFrame)
    or a path (parquet file/dir, ``*.txt`` directory, or a text file).

    If a registered loader fails, tiny-shakespeare falls back to the bundled
    stanza; other names re-raise. An unknown path is an error. ``chunked`` reads a text
    file as chunks (see ``read_text_chunks``), whatever its size.
    """
    registry = registry or {}
    if choice in registry:
        try:
            return registry[choice](spark)
        except Exception:
            if choice == "tiny-shakespeare":
                return fallback_corpus(spark)
            raise
    if choice == "tiny-shakespeare":
        return fallback_corpus(spark)
    if choice.endswith(".parquet"):
        return read_corpus(spark, choice)
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(choice)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        raise FileNotFoundError(f"{choice} not found.")
    if fs.getFileStatus(jpath).isDirectory():
        return read_text_dir(spark, choice).select("doc_id", "text")
    return read_text_chunks(spark, choice) if chunked else read_text_file(spark, choice)


def corpus_tag(choice: str) -> str:
    """S14 for a single choice (driver-side string; same rule as ``dataset_tag``)."""
    if choice in C.NAMED_DATASETS:
        return C.NAMED_DATASETS[choice]
    tag = os.path.splitext(os.path.basename(choice))[0][:C.TAG_LENGTH]
    if not tag:
        raise ValueError(f"empty dataset tag for {choice!r}")
    return tag


def with_dataset_tag(df: DataFrame, col: str, out_col: str = "tag") -> DataFrame:
    """S14 over a column of dataset choices / paths."""
    return df.withColumn(out_col, dataset_tag(col))


# --------------------------------------------------------------------------- S9
def read_prompts(conversations: DataFrame) -> DataFrame:
    """User turns as prompts, ``seq_id = 'conv_id:turn'`` (a string; a null part is
    empty, so no two different turns share one). Rows that repeat a turn share its id; the
    codec and completion keep them apart by row."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return (conversations.filter(F.col("role") == "user")
            .select(F.concat(part("conv_id"), F.lit(":"), part("turn")).alias("seq_id"), F.col("text").alias("text")))
