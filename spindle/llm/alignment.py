"""Alignment of two tokenizers' tokens by galloping intersection of their ends.

Both tokenizers encode the same bytes (a space and the text). The byte offsets where tokens
of both end cut them into groups: the shorter list of ends drives a galloping search (step
one, two, four, ... from the last place, then binary) through the longer one; the indices
found in both lists are the groups' last tokens, and differences of neighbouring indices
give each group's range of tokens on either side. All pairs of a group's tokens are linked.

What a pair of ids counts, how many documents hold it linked, is gathered over the corpus:
documents are written with their distinct pairs, a block of up to ``BLOCK_CHARS``
characters lists each of its pairs once with the number of its documents, the lists are
added up by pair, and each block gets back the counts of its own pairs. So the shuffles
carry a row a pair and block, not one a token; a frequent pair's rows are added before the
shuffle and split by the skew join after it. A block's group is bounded by its text; a
longer text is a block of its own. Block numbers and pairs are in written files before they
are used, so lost executors change nothing.

Byte-level files whose merges give ids in order are encoded by ``tiktoken`` with the file's
vocabulary (the tests hold it equal to ``tokenizers``), other JSON files by ``tokenizers``,
``.model`` files by ``sentencepiece``. Special strings in texts are plain text.

Defined cases: a null or empty text, or one whose tokens' bytes differ from a space and the
text on either side, has no tokens: zeros and an empty digest; equal rows count as a
document each; an empty table gives an empty result; columns of the input named like the
outputs are replaced; the text column isn't returned.
"""

from __future__ import annotations

import hashlib
import json
import os
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.arrow_map import _slices, kept, with_python_columns
from spindle.llm.bpe import byte_letters
from spindle.llm.common import saved

#: Characters of texts in a block.
BLOCK_CHARS = 16_000_000
#: Groups with more links than this are counted by their distinct ids, not link by link.
WIDE_LINKS = 4096
#: Links gone through at a time.
CHUNK_LINKS = 1 << 21
#: The pattern of byte-level pre-tokenizers (a fixed value of their format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Side:
    """One tokenizer: ids of a space and the text, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the parallelism
        if path.endswith(".model"):
            import sentencepiece
            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: model.encode(texts, num_threads=1)       # adds the space
            self.bytes_of = [
                bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
                else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
        else:
            spec = json.load(open(path, encoding="utf-8"))
            model, special = spec["model"], {t["content"] for t in spec.get("added_tokens", [])}
            byte_of = {c: b for b, c in enumerate(byte_letters())}
            vocab = {t: i for t, i in model["vocab"].items() if t not in special}
            ranks = {bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items()}
            texts_of = {i: b for b, i in ranks.items()} | {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
            self.bytes_of = [texts_of.get(i, b"") for i in range(max(texts_of) + 1)]
            self.encode = self._by_ranks(ranks) if self._plain(spec, ranks) else self._by_library(path)
        self.size = len(self.bytes_of)
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)

    @staticmethod
    def _plain(spec: dict, ranks: dict) -> bool:
        """Whether merging the pair whose joined bytes have the least id is what the file says."""
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        made = [model["vocab"].get(m.replace(" ", "", 1) if isinstance(m, str) else "".join(m)) for m in model["merges"]]
        return (spec.get("normalizer") is None and model["type"] == "BPE" and before.get("type") == "ByteLevel"
                and bool(before.get("use_regex")) and not before.get("add_prefix_space")
                and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                                   "end_of_word_suffix", "byte_fallback", "ignore_merges"))
                and sorted(ranks.values()) == list(range(len(ranks))) and made == list(range(256, len(ranks))))

    @staticmethod
    def _by_ranks(ranks: dict):
        import tiktoken
        model = tiktoken.Encoding("aligned", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [model.encode_ordinary(" " + t) for t in texts]

    @staticmethod
    def _by_library(path: str):
        from tokenizers import Tokenizer
        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        model.no_truncation()
        model.no_padding()
        return lambda texts: [x.ids for x in model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def common_ends(short: list[int], long: list[int]) -> tuple[list[int], list[int]]:
    """Indices in both ascending lists of the values that both hold."""
    in_short, in_long, j, n = [], [], 0, len(long)
    for i, x in enumerate(short):
        if j == n:
            break
        if long[j] < x:
            step = 1
            while j + step < n and long[j + step] < x:
                j += step                        # still below: double the step from here
                step += step
            j = bisect_left(long, x, j + 1, min(j + step, n))
            if j == n:
                break
        if long[j] == x:
            in_short.append(i)
            in_long.append(j)
            j += 1
    return in_short, in_long


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(path_a), Side(path_b)
        # an id and what follows it: a neighbour of its side, the other side, or the next group
        self.after_a = [b"%d%c" % (i, c) for i in range(self.a.size) for c in b",|"]
        self.after_b = [b"%d%c" % (i, c) for i in range(self.b.size) for c in b",;"]
        self.strings = np.array(self.after_a + self.after_b, object)
        self.pair_type = np.uint32 if self.a.size * self.b.size <= 1 << 32 else np.uint64

    def ranges(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each group's last token on either side."""
        ends_a = np.cumsum(self.a.lengths[ids_a]).tolist()
        ends_b = np.cumsum(self.b.lengths[ids_b]).tolist()
        if len(ends_a) <= len(ends_b):
            at_a, at_b = common_ends(ends_a, ends_b)
        else:
            at_b, at_a = common_ends(ends_b, ends_a)
        return np.array(at_a, np.int64), np.array(at_b, np.int64)

    def texts(self, ids_a, ids_b, at_a, at_b) -> bytes:
        """``a1,a2|b1;a3|b2,b3``"""
        code_a, code_b = 2 * ids_a, 2 * ids_b + len(self.after_a)
        code_a[at_a] += 1
        code_b[at_b] += 1
        sizes_a, sizes_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        place = np.empty(len(code_a) + len(code_b), np.int64)
        place[np.arange(len(code_a)) + np.repeat(at_b + 1 - sizes_b, sizes_a)] = code_a
        place[np.arange(len(code_b)) + np.repeat(at_a + 1, sizes_b)] = code_b
        return b"".join(self.strings[place].tolist())[:-1]

    def pairs(self, ids_a, ids_b, at_a, at_b) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked pairs, as one number each, and how often each is linked."""
        size_a, size_b = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
        first_a, first_b, links = at_a + 1 - size_a, at_b + 1 - size_b, size_a * size_b
        wide = links > WIDE_LINKS
        made, times = [], []
        for g in np.flatnonzero(wide):
            xa, na = np.unique(ids_a[first_a[g]:at_a[g] + 1], return_counts=True)
            xb, nb = np.unique(ids_b[first_b[g]:at_b[g] + 1], return_counts=True)
            made.append((xa[:, None] * self.b.size + xb).ravel())
            times.append((na[:, None] * nb).ravel())
        narrow = np.flatnonzero(~wide)
        ends = np.cumsum(links[narrow])
        k = 0
        while k < len(narrow):
            to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + CHUNK_LINKS)))
            g = narrow[k:to]
            n = links[g]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            of_b = np.repeat(size_b[g], n)
            a = ids_a[np.repeat(first_a[g], n) + inner // of_b]
            b = ids_b[np.repeat(first_b[g], n) + inner % of_b]
            pair, number = np.unique(a * self.b.size + b, return_counts=True)
            made.append(pair)
            times.append(number)
            k = to
        if len(made) == 1:
            return made[0], times[0]
        pair, at = np.unique(np.concatenate(made), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, at, np.concatenate(times))
        return pair, total

    def encode(self, texts: list[str]):
        """Per text its ids on both sides, or None if it has no tokens."""
        for t, ids_a, ids_b in zip(texts, self.a.encode(texts), self.b.encode(texts), strict=True):
            raw = b" " + t.encode("utf-8")
            fits = t and self.a.joined(ids_a) == raw and self.b.joined(ids_b) == raw
            yield (np.array(ids_a, np.int64), np.array(ids_b, np.int64)) if fits else None


def packed(numbers: np.ndarray) -> bytes:
    """Little-endian integers of the least width that holds the greatest."""
    top = int(numbers.max()) if len(numbers) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    return numbers.astype(f"<u{width}").tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``groups``: ids in order, as ``a1,a2|b1;a3|b2,b3``
    (empty without tokens). No corpus counts, no shuffle."""
    def make():
        aligner = kept(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))

        def one(ids):
            if ids is None:
                return ""
            at = aligner.ranges(*ids)
            return aligner.texts(*ids, *at).decode()

        return lambda texts: [[one(ids) for ids in aligner.encode(texts)]]

    return with_python_columns(docs, text_col, {"groups": "string"}, make)


COUNTED = {"n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "groups_sha256": "string"}
SCORED = {"n_best": "bigint", "count_sum": "bigint"}


def _blocks(docs: DataFrame, own: list[str], path_a: str, path_b: str, text_col: str) -> DataFrame:
    """A row a document with its distinct pairs, and a row a block with the block's pairs and
    the number of its documents that hold each (``held``; null in document rows)."""
    read = docs.select(*own, docs[text_col].cast("string").alias("__text"))
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.select(*own).schema),
                        "__block bigint", *(f"{n} {t}" for n, t in COUNTED.items()),
                        "__pairs binary", "__times binary", "__held array<struct<pair:bigint,docs:bigint>>"])
    held_type = pa.list_(pa.struct([("pair", pa.int64()), ("docs", pa.int64())]))
    names = [*own, "__block", *COUNTED, "__pairs", "__times", "__held"]
    made_types = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]

    def run(batches):
        aligner = kept(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        task, number = TaskContext.get().partitionId(), 0
        chars, seen, types = 0, [], None

        def block_row():
            """The block's list of pairs; documents' lists hold a pair once each."""
            pair, docs_with = np.unique(np.concatenate(seen), return_counts=True)
            items = pa.StructArray.from_arrays([pa.array(pair.astype(np.int64)), pa.array(docs_with.astype(np.int64))], ["pair", "docs"])
            held = pa.ListArray.from_arrays(pa.array([0, len(pair)], pa.int32()), items)
            empty = [pa.nulls(1, t) for t in types] + [pa.array([block], pa.int64())] + [pa.nulls(1, t) for t in made_types]
            return pa.RecordBatch.from_arrays([*empty, held.cast(held_type)], names)

        for batch in batches:
            types = [batch.column(i).type for i in range(len(own))]
            for start, texts in _slices(batch, len(own)):
                size = sum(map(len, texts))
                if seen and chars + size > BLOCK_CHARS:
                    yield block_row()
                    chars, seen, number = 0, [], number + 1
                block = (task << 32) + number
                made = []
                for ids in aligner.encode(texts):
                    if ids is None:
                        made.append((0, 0, 0, 0, "", b"", b""))
                        continue
                    at = aligner.ranges(*ids)
                    pair, times = aligner.pairs(*ids, *at)
                    pair = pair.astype(aligner.pair_type)
                    seen.append(pair)
                    made.append((len(ids[0]), len(ids[1]), len(at[0]), int(times.sum()),
                                 hashlib.sha256(aligner.texts(*ids, *at)).hexdigest(), pair.tobytes(), packed(times)))
                chars += size
                part = batch.slice(start, len(texts))
                cols = [pa.array(c, t) for c, t in zip(zip(*made), made_types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(own))), pa.array([block] * len(texts), pa.int64()), *cols,
                     pa.nulls(len(texts), held_type)], names)
        if seen:
            yield block_row()

    return read.mapInArrow(run, schema)


def pair_counts(held: DataFrame, size_b: int) -> DataFrame:
    """``pair, n_docs, best``: how many documents hold a pair, and whether no pair of the same
    first id is held by more."""
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n_docs"))
    first = F.expr(f"pair div {size_b}")
    # a row an id of the first vocabulary
    top = counts.groupBy(first.alias("first")).agg(F.max("n_docs").alias("top"))
    return (counts.withColumn("first", first).join(top, "first")
            .select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best")))


def align_documents(docs: DataFrame, path_a: str, path_b: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` but its text plus, long: ``n_a``, ``n_b`` (tokens),
    ``n_groups``, ``n_links``, ``n_best`` (links whose pair is held by as many documents as any
    pair of its first id), ``count_sum`` (documents that hold the link's pair, over links);
    and ``groups_sha256`` (see ``aligned_groups``)."""
    outputs = {**COUNTED, **SCORED}
    own = [c for c in docs.columns if c.lower() not in {*outputs, text_col.lower()}]
    aligner = Aligner(path_a, path_b)            # the tables' sizes only
    size_b, pair_type = aligner.b.size, np.dtype(aligner.pair_type).newbyteorder("<").str
    written = saved(_blocks(docs, own, path_a, path_b, text_col), "aligned")
    lists = (written.where(F.col("__held").isNotNull())
             .select("__block", F.explode("__held").alias("h")).select("__block", "h.pair", "h.docs"))
    counts = saved(pair_counts(lists, size_b), "pair-counts")
    answers = (lists.select(F.col("__block").alias("__asked"), "pair").join(counts, "pair")
               .select("__asked", "pair", "n_docs", "best"))
    rows = written.where(F.col("__held").isNull()).drop("__held")
    kept_names = [*own, *COUNTED]
    schema = ", ".join([*(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.select(*own).schema),
                        *(f"{n} {t}" for n, t in outputs.items())])

    def score(documents: pa.Table, known: pa.Table) -> pa.Table:
        pair = known.column("pair").to_numpy()
        order = np.argsort(pair)
        pair = pair[order]
        n_docs, best = known.column("n_docs").to_numpy()[order], known.column("best").to_numpy()[order]
        n_best, count_sum = [], []
        for pairs, times in zip(documents.column("__pairs"), documents.column("__times")):
            mine = np.frombuffer(pairs.as_py(), pair_type).astype(np.int64)
            often, at = unpacked(times.as_py(), len(mine)), np.searchsorted(pair, mine)
            n_best.append(int(often[best[at]].sum()) if len(mine) else 0)
            count_sum.append(int((often * n_docs[at]).sum()) if len(mine) else 0)
        cols = [documents.column(c) for c in kept_names]
        return pa.table([*cols, pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], [*kept_names, *SCORED])

    return rows.groupBy("__block").cogroup(answers.groupBy("__asked")).applyInArrow(score, schema)
