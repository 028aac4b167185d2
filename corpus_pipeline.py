"""A training corpus from raw documents in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet below the shared checkpoint folder and read again as the next stage's documents:

1. ``toxicity``: a lexicon is learnt from the labelled rows; toxic documents go.
2. ``quality``: failing lines are removed; documents that fail the base rule or lose too
   much of their text go.
3. ``near_duplicates``: of documents whose SimHash fingerprints are linked, the one with
   the smallest id stays (4-word shingles, at most 4 differing bits).
4. ``mixing``: sources get targets by weight; each document is taken as often as its
   source's rate says, repeats being rows of their own.
5. ``tokens``: every document's ids, and the text they decode to, as digests.

All but the last return the columns of ``documents``. Stages handle null texts as empty
ones, repeated rows, empty tables and further columns as their operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import bpe, mixing, quality, simhash, toxicity
from spindle.llm.common import saved, table
from spindle.llm.queries import digests, tokenizer


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, lexicon)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(bpe.encode_documents(docs.select("doc_id", "text"), tokenizer("word_bpe_49k.json")))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: SQL can't express the lexicon, the fingerprints or the encoder; the tests hold the
#: pipeline against a plain Python version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
