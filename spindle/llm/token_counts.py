"""Token counts through a digest cache.

Content is keyed by the SHA-256 of its UTF-8 text (the tokenizers count bytes, so the
normal form is the text itself, null as empty), the tokenizer by the SHA-256 of its
file. Digests that the stored table has are joined; each distinct one that it lacks is
encoded once and appended. Texts of copies meet in partial aggregation where they are
read, so a hot text moves at most once a task, and only digests and counts meet the
documents again (a hot digest there is split by Spark's skew join).

With byte-level files whose pattern splits at white space, a worker remembers the
counts of words in a bounded cache and hands the library only words it lacks: no
piece of that pattern reaches from a character that isn't white space into white space,
so the text between such places can be counted by itself.

Defined cases: a null text counts as empty, with no bytes and no tokens; repeated rows
are all returned; an empty table gives an empty result; columns of the input named like
the outputs are replaced. A run that dies appends nothing of an unfinished write; a
digest that two runs append at once is read once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.arrow_map import kept, with_python_columns
from spindle.llm.common import saved, text_of

CACHE_SCHEMA = "content binary, tokenizer string, n_tokens long"
#: Words in a generation of a worker's cache (two are kept).
CACHE_WORDS = 250_000


class TokenCounter:
    """Tokens of whole texts as the file's own library gives them."""

    #: White space of the library's pattern besides the four characters cut at below.
    OTHER_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
    PIECE = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        self.cache: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.special: re.Pattern | None = None
        self.by_word = False
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.library = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.library = lambda texts: [len(x.ids) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        spec = json.loads(model.to_str())
        before = spec.get("pre_tokenizer") or {}
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.by_word = (spec.get("normalizer") is None and before.get("type") == "ByteLevel"
                        and bool(before.get("use_regex")) and not before.get("add_prefix_space")
                        and not any(re.search(r"\s", a) for a in added))
        if added:
            self.special = re.compile("|".join(map(re.escape, added)))

    def count(self, text: str) -> int:
        if not self.by_word or self.OTHER_SPACE.search(text) or (self.special and self.special.search(text)):
            return self.library([text])[0]
        pieces = self.PIECE.findall(text)
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        missing = []
        for p in set(pieces).difference(cache):
            n = older.get(p)
            if n is None:
                missing.append(p)
            else:
                cache[p] = n
        if missing:
            cache.update(zip(missing, self.library(missing), strict=True))
        return sum([cache[p] for p in pieces])


def tokenizer_digest(path: str) -> str:
    """The version that counts are stored under."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def count_tokens(docs: DataFrame, tokenizer_path: str, cache_path: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_bytes`` and ``n_tokens`` (long).

    ``cache_path`` is a Parquet folder that every executor reaches; it is made if absent.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer_path)
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)

    def stored() -> DataFrame:
        return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
                .where(F.col("tokenizer") == version).select("content", "n_tokens"))

    def make():
        counter = kept(("counter", tokenizer_path, version), lambda: TokenCounter(tokenizer_path))
        return lambda texts: [[counter.count(t) for t in texts]]

    text = text_of(text_col)
    digest = F.unhex(F.sha2(text, 256))
    missing = (docs.select(digest.alias("content"), text.alias("text"))
               .groupBy("content").agg(F.first("text").alias("text"))
               .join(stored().select("content"), "content", "left_anti"))
    (with_python_columns(missing, "text", {"n_tokens": "long"}, make)
     .select("content", F.lit(version).alias("tokenizer"), "n_tokens")
     .write.mode("append").parquet(cache_path))
    counts = saved(stored().groupBy("content").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    own = [c for c in docs.columns if c.lower() not in ("n_bytes", "n_tokens")]
    return (docs.select(*own, F.octet_length(text).cast("long").alias("n_bytes"), digest.alias("__content"))
            .join(counts.withColumnRenamed("content", "__counted"), F.col("__content") == F.col("__counted"), "left")
            .select(*own, "n_bytes", "n_tokens"))
