"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.session import scratch_path

#: A word is a maximal run without space, tab, line feed, vertical tab, form feed or return.
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can read, and gives Spark the
    table's true size, so that its own broadcast threshold decides later joins.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str | Column = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def word_count(text: Column) -> Column:
    """Number of words as long."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
