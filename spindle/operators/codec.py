"""Tokenise and vocabulary: T1, T2, T5-T9.

The codec is lossless: pre-tokens (pattern in ``constants``) concatenate back
to the text; pre-tokens in the learned vocabulary get one id, every other
pre-token falls back to its UTF-8 bytes (ids 0..255). Id 256 is end-of-text.

Scale notes
-----------
* ``build_vocab`` is one partial+final hash aggregation on the pre-token (hot
  tokens are combined map-side), then a top-N ``TakeOrderedAndProject`` whose
  output is bounded by ``size``.
* ``encode`` is one pass over the rows, without a shuffle: the vocabulary, bounded by
  ``size``, is sent to the workers, and a row's ids are put together in its own batch,
  a bounded number of pre-tokens at a time.
  Documents that come range-partitioned by their key (``corpus.by_document``) stay so.
* ``decode`` uses an id-indexed array (ids are dense, at most ``size`` + 257) as an
  O(1) lookup table evaluated once as a scalar subquery, so decoding is a narrow map
  with no join. An id outside the vocabulary is an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from spindle import constants as C
from spindle.functions.text import pretokenize, utf8_byte_ids, utf8_hex

#: Helpers of this module travel to the workers by value, with the values they read.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

@dataclass(frozen=True)
class Vocab:
    """A vocabulary table plus the proven upper bound of its word rows.

    ``df`` columns: token_id INT, token STRING, kind STRING ('byte'|'eos'|'word'),
    freq BIGINT, hex STRING (upper-case hex of the bytes the id decodes to).
    """

    df: DataFrame
    size: int

    def words(self) -> DataFrame:
        return self.df.filter(F.col("kind") == "word").select("token", "token_id")

    def digest(self) -> str:
        """A name of the ids and what they decode to; equal tables have equal names."""
        row = self.df.select(F.sum(F.xxhash64("token_id", "hex").cast("decimal(38,0)")).alias("s"),
                             F.count("*").alias("n")).first()
        return f"{row.n}-{row.s}"

    def n_ids(self) -> Column:
        """Number of ids (dense 0..n-1), as a scalar subquery column."""
        return self.df.select(F.max("token_id") + 1).scalar()

    def lookup_array(self, field: str) -> Column:
        """Scalar-subquery array indexed by ``token_id`` (element_at(arr, id+1))."""
        return (self.df
                .select(F.sort_array(F.collect_list(F.struct("token_id", field))).alias("a"))
                .select(F.col("a").getField(field))
                .scalar())


# --------------------------------------------------------------------------- T1
def explode_pretokens(df: DataFrame, keys=("doc_id",), text_col: str = "text") -> DataFrame:
    """One row per pre-token: keys..., pos (0-based), token."""
    return df.select(*keys, F.posexplode(pretokenize(text_col)).alias("pos", "token"))


# --------------------------------------------------------------------------- T2
def _byte_and_eos_rows(spark: SparkSession) -> DataFrame:
    b = spark.range(C.N_BYTES).select(F.col("id").cast("int").alias("token_id"))
    byte_rows = b.select(
        "token_id",
        F.when(F.col("token_id") < 128, F.expr("char(token_id)"))
         .otherwise(F.lit("�")).alias("token"),
        F.lit("byte").alias("kind"),
        F.lit(0).cast("bigint").alias("freq"),
        F.lpad(F.hex("token_id"), 2, "0").alias("hex"),
    )
    eos = spark.range(1).select(
        F.lit(C.EOS_ID).cast("int").alias("token_id"),
        F.lit(C.EOS_TEXT).alias("token"),
        F.lit("eos").alias("kind"),
        F.lit(0).cast("bigint").alias("freq"),
        utf8_hex(F.lit(C.EOS_TEXT)).alias("hex"),
    )
    return byte_rows.unionByName(eos)


def build_vocab(tokens: DataFrame, size: int = C.DEFAULT_VOCAB_SIZE,
                token_col: str = "token") -> Vocab:
    """The ``size`` most frequent pre-tokens (ties by token) get ids 257...

    ``tokens`` is one row per pre-token occurrence.
    """
    if size < 1:
        raise ValueError("vocabulary size must be positive")
    freq = tokens.groupBy(F.col(token_col).alias("token")).agg(F.count(F.lit(1)).alias("freq"))
    top = freq.orderBy(F.desc("freq"), F.asc("token")).limit(size)
    # ``size`` rows at most: a single-partition window over them is bounded.
    rank = Window.orderBy(F.desc("freq"), F.asc("token"))
    words = top.select(
        (F.row_number().over(rank) + F.lit(C.FIRST_WORD_ID - 1)).cast("int").alias("token_id"),
        "token",
        F.lit("word").alias("kind"),
        F.col("freq").cast("bigint").alias("freq"),
        utf8_hex("token").alias("hex"),
    )
    spark = tokens.sparkSession
    return Vocab(_byte_and_eos_rows(spark).unionByName(words), size)


# --------------------------------------------------------------------------- T5
def encode_exploded(tok_rows: DataFrame, vocab: Vocab) -> DataFrame:
    """Per pre-token row: add ``ids`` (one vocab id or its UTF-8 byte ids)."""
    j = tok_rows.join(vocab.words(), "token", "left")
    ids = F.when(F.col("token_id").isNotNull(), F.array(F.col("token_id"))) \
           .otherwise(utf8_byte_ids("token"))
    return j.withColumn("ids", ids).drop("token_id")


#: Pre-tokens put together at a time, which bounds a worker's memory whatever a batch holds;
#: a longer row comes alone, whole.
SLICE_TOKENS = 1 << 17


def _lengths(lists: pa.ListArray) -> np.ndarray:
    """Elements a row; a null row has none."""
    n = np.diff(lists.offsets.to_numpy())
    return np.where(lists.is_valid().to_numpy(zero_copy_only=False), n, 0)


def _row_slices(b: pa.RecordBatch, col: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``b`` with ``SLICE_TOKENS`` elements of ``col`` at most."""
    upto, start = np.cumsum(_lengths(b.column(col))), 0
    while start < len(upto):
        before = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + SLICE_TOKENS, side="right")))
        yield b.slice(start, stop - start)
        start = stop


def _bytes_of(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text's bytes begin and the last one's end, and the bytes of all."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0]:at[-1]]


def _rows_of(which: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray, per_row: np.ndarray) -> pa.Array:
    """A list of ids a row: the next ``per_row`` pieces of ``which``, piece ``w`` being the
    ``sizes[w]`` ids of ``flat`` from ``starts[w]`` on."""
    n = sizes[which]
    upto = np.concatenate([[0], np.cumsum(n)])
    ids = flat[np.repeat(starts[which] - upto[:-1], n) + np.arange(upto[-1])]
    offsets = upto[np.concatenate([[0], np.cumsum(per_row)])]
    return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(ids)).cast(pa.list_(pa.int32()))


def encode(df: DataFrame, vocab: Vocab, keys=("doc_id",), text_col: str = "text",
           out_col: str = "ids", with_pretoken_count: bool = False,
           separator_id: int | None = None) -> DataFrame:
    """T5: text -> ARRAY<INT> of ids, no special ids added unless ``separator_id`` is
    given, which then ends every row's ids.

    Returns ``keys..., ids`` (plus ``n_pretokens`` on request), a row each, whatever the
    keys; rows with a null or empty text get an empty array. One pass over the rows where
    they are: pre-tokens are cut by built-in functions, and every distinct one of a batch is
    looked up once. The vocabulary (``vocab.size`` words at most) is sent to the workers.
    """
    keys = list(keys)
    # ids of words follow their order, without gaps
    rows = vocab.words().orderBy("token_id").collect()
    words = df.sparkSession.sparkContext.broadcast(pa.array([r.token for r in rows], pa.string()))
    at = df.sparkSession.sparkContext.broadcast(np.array([r.token_id for r in rows], np.int32))
    end = np.zeros(0, np.int32) if separator_id is None else np.array([separator_id], np.int32)

    def run(batches):
        known, id_of = words.value, at.value
        for whole in batches:
            for b in _row_slices(whole, "_tokens"):
                tokens = b.column("_tokens")
                per_row = _lengths(tokens)
                coded = tokens.flatten().dictionary_encode()
                distinct, which = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
                place = pc.index_in(distinct, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)
                # the ids of all words, the bytes of the others, the separator: where each pre-token's begin
                other = distinct.filter(pa.array(place < 0))
                upto_byte, raw = _bytes_of(other)
                flat = np.concatenate([id_of, raw.astype(np.int32), end])
                sizes, starts = np.ones(len(place), np.int64), place.astype(np.int64)
                sizes[place < 0], starts[place < 0] = np.diff(upto_byte), len(id_of) + upto_byte[:-1]
                if len(end):                         # a last piece in every row: the separator
                    which = np.insert(which, np.cumsum(per_row), len(sizes))
                    sizes, starts = np.append(sizes, 1), np.append(starts, len(flat) - 1)
                made = _rows_of(which, starts, sizes, flat, per_row + len(end))
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))), made, pa.array(per_row.astype(np.int64))],
                                                 [*keys, out_col, "n_pretokens"])

    read = df.select(*keys, pretokenize(text_col).alias("_tokens"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in read.drop("_tokens").schema),
                        f"`{out_col}` array<int>", "n_pretokens bigint"])
    out = read.mapInArrow(run, schema)
    return out if with_pretoken_count else out.drop("n_pretokens")


# ------------------------------------------------------------------------ T6/T7
def decode_token(df: DataFrame, vocab: Vocab, id_col: str = "token_id",
                 out_col: str = "token_text") -> DataFrame:
    """One id -> its text (a lone byte id >= 0x80 decodes to U+FFFD)."""
    return df.withColumn(out_col, F.element_at(vocab.lookup_array("token"), F.col(id_col) + 1))


def ids_hex(ids: Column, hex_table: Column) -> Column:
    """The bytes that ids decode to, in order, as upper-case hex."""
    return F.array_join(F.transform(ids, lambda i: F.element_at(hex_table, i + 1)), "")


def decode_ids(ids: Column, hex_table: Column) -> Column:
    """Ids -> text, bytes concatenated in order, invalid UTF-8 replaced."""
    return F.make_valid_utf8(F.unhex(ids_hex(ids, hex_table)).cast("string"))


def with_bytes(df: DataFrame, vocab: Vocab, ids_col: str = "ids", out_col: str = "hex") -> DataFrame:
    """The bytes of ``ids_col`` as hex, before any of them is replaced."""
    return (df.withColumn("_hex_table", vocab.lookup_array("hex"))
              .withColumn(out_col, ids_hex(F.col(ids_col), F.col("_hex_table"))).drop("_hex_table"))


def decode_seq(df: DataFrame, vocab: Vocab, ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """T7 over a table: a new ``out_col`` with the decoded text of ``ids_col``."""
    # the lookup array is a scalar subquery; bind it to a column first since
    # subqueries may not appear inside lambdas
    return (df.withColumn("_hex_table", vocab.lookup_array("hex"))
              .withColumn(out_col, decode_ids(F.col(ids_col), F.col("_hex_table")))
              .drop("_hex_table"))
