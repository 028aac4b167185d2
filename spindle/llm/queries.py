"""The registered queries: each operator on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import (alignment, bpe, chat_format, embedding_dedup, html_extract, mixing, pii, quality, runs, simhash,
                         token_counts, toxicity, url_filter)
from spindle.llm.common import WORD, table, text_of
from spindle.session import scratch_path


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("copies")).alias("taken"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_failed_lines",
        "lost_words", "base_failed", "kept")])


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, lexicon).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", toxicity.predicted().alias("predicted"), "n_terms")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    weights = html_extract.learn_weights(pages)
    return html_extract.extract_pages(pages, weights).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        tokenizer("byte_bpe_50k.json"), scratch_path(spark, "token-cache"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(bpe.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                        tokenizer("word_bpe_49k.json")))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = chat_format.rotate(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rotated.withColumn("mask", F.array_join(spans, ","))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as captures against a list whose entries, with their dates, are drawn from
    the pages' own hosts and directories by hashes of the addresses."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = lambda salt, of: F.conv(F.substring(F.md5(F.concat(F.lit(salt), F.coalesce(
        of.cast("string"), F.lit("")))), 1, 6), 16, 10).cast("int")
    day = lambda salt, of: F.date_add(F.lit("2024-01-01").cast("date"), number(salt, of) % 365)
    url = F.col("url")
    host, path = url_filter.host_of(url), url_filter.path_of(url)
    entries = pages.where((number("listed", url) % 4 == 0) & (host != "")).select(
        F.when(number("pattern", url) % 3 == 0, host).otherwise(
            F.concat(host, F.lit("/"), F.split(path, "/")[1])).alias("pattern"),
        F.element_at(F.array(*map(F.lit, ("block", "block", "allow", "none"))), number("action", url) % 4 + 1).alias("action"),
        day("since", url).alias("listed_on"))
    captures = pages.withColumn("fetched_on", day("fetched", F.col("page_id")))
    return url_filter.filter_captures(captures, entries)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("pii")
    return found.select("doc_id", *[pii.n_base(spans, k).alias(f"n_{k}") for k in pii.BASE_KINDS],
                        F.sha2(pii.span_list(pii.base_spans(spans)), 256).alias("base_sha256"),
                        pii.span_list(spans).alias("spans"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's input: in a tenth of the documents, by a hash of the id, the words from a
    place on repeat with a period, both drawn from the hash; other texts stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    drawn = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"))
    chosen = F.col("h") % 10 == 0
    split = drawn.withColumn("w", F.when(chosen, F.regexp_extract_all(text_of(), F.lit(WORD), F.lit(0))))
    n = F.size("w").cast("long")
    placed = split.withColumn("n", n).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    period = F.slice("w", F.col("a") + 1, F.col("p"))
    tail = (F.col("n") - F.col("a")).cast("int")
    whole = F.concat(F.slice("w", F.lit(1), F.col("a")),
                     F.slice(F.flatten(F.array_repeat(period, F.ceil(tail / F.col("p")).cast("int"))), F.lit(1), tail))
    return placed.select("doc_id", F.when(chosen & (F.col("n") > 0), F.array_join(whole, " ")).otherwise(F.col("text"))
                         .alias("text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    top = F.col("top_run")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"),
                        top["length"].alias("length"), top["period"].alias("period"),
                        F.expr("1000 * top_run.length div top_run.period").alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                     tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_quality_rules, op3_toxicity, op4_html_extraction, op5_token_counts, op6_simhash, op7_bpe,
                                   op8_embedding_dedup, op9_chat_formatting, op10_url_filters, op11_pii, op12_runs,
                                   op13_alignment)}
