"""BPE encoding by backtracking over Aho-Corasick matches, and decoding by offsets.

For a tokenizer file whose token ids follow the order of its merges, the one
segmentation that byte-pair merging yields is the only one in which every two
neighbours are compatible: merging their letters, in rank order, never joins across
their border. The encoder takes the longest token at a position (all matches of a
word come from one pass of an Aho-Corasick automaton), keeps it if it is compatible
with its predecessor, else tries the longest token that is a prefix of it, else goes
back one token and never again to that position. Verdicts on pairs are tabled.
Decoding gathers bytes from one buffer of all token texts by an offset table.

Words are looked up in a bounded cache per worker before they are encoded. Texts are
handled whole, one at a time; nothing is shuffled, and a lost task is just run again.

Defined cases: a null or empty text has no ids and decodes to an empty text; equal
rows are encoded alike, each by itself; special strings in a text become their ids,
as in the library; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import struct

import numpy as np
from pyspark.sql import DataFrame

from spindle.llm.arrow_map import kept, with_python_columns

#: Words in a generation of a worker's cache. Two are kept: words met again move from the
#: older one to the newer one, the others go with it (results are the same).
CACHE_WORDS = 250_000
#: Verdicts on pairs a worker remembers.
CACHE_PAIRS = 1_000_000
#: Ids decoded at a time, which bounds the gather's memory.
DECODE_IDS = 1 << 16
#: Raised by this much, the last character of a word stands for itself plus the word end.
END = 0x1000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: Latin-1's
    own visible characters, and code points from 256 up, in order, for the others."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    visible = set(own)
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]


class BacktrackEncoder:
    """Ids of single words, given the vocabulary and merges of a tokenizer file."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        import ahocorasick

        self.letters, self.suffix = byte_letters(), suffix
        shape = {self.folded(t): i for t, i in vocab.items()}
        self.size = [0] * (max(vocab.values()) + 1)
        self.automaton = ahocorasick.Automaton()
        for t, i in shape.items():
            self.size[i] = len(t)
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        # the longest token that is a proper prefix of a token
        self.prefix = [-1] * len(self.size)
        for t, i in shape.items():
            for n in range(len(t) - 1, 0, -1):
                if (p := shape.get(t[:n])) is not None:
                    self.prefix[i] = p
                    break
        self.parts = [(i, i) for i in range(len(self.size))]
        self.joined: dict[tuple[int, int], int] = {}
        last = -1
        for m in merges:
            a, b = m if isinstance(m, (list, tuple)) else m.split(" ")
            left, right, both = vocab[a], vocab[b], vocab[(a + b)]
            if both < last:
                raise ValueError("token ids don't follow the order of the merges")
            last = both
            self.joined[left, right] = both
            self.parts[both] = (left, right)
        self.pairs: dict[tuple[int, int], bool] = {}

    def folded(self, token: str) -> str:
        """The token with its word end folded into the last character."""
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            token = token[:-len(self.suffix)]
            return token[:-1] + chr(ord(token[-1]) + END)
        return token

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between tokens ``a`` and ``b``; tabled."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        known = self.pairs[a, b] = self._border_stays(a, b)
        return known

    def _border_stays(self, a: int, b: int) -> bool:
        # Undo the merges beside the border, latest first. At each point the tokens there
        # were neighbours until the later of them was made (by id): if they have a merge
        # that comes before that, it would have crossed the border. Of equal ids the left
        # one is made first, hence the half steps.
        until = float("inf")
        while True:
            both = self.joined.get((a, b))
            if both is not None and both < until:
                return False
            inner_a, inner_b = self.parts[a][1], self.parts[b][0]
            if inner_a == a and inner_b == b:
                return True
            if inner_b == b or (inner_a != a and a > b):
                until, a = a, inner_a
            else:
                until, b = b + 0.5, inner_b

    def encode(self, raw: str) -> list[int]:
        if raw.isascii() and raw.isprintable() and " " not in raw:
            word = raw                       # these letters stand for themselves
        else:
            word = "".join([self.letters[b] for b in raw.encode("utf-8")])
        if not word:
            return []
        if self.suffix:
            word = word[:-1] + chr(ord(word[-1]) + END)
        n, longest = len(word), [-1] * (len(word) + 1)
        for end, (i, size) in self.automaton.iter(word):
            longest[end - size + 1] = i      # ends ascend, so the longest comes last
        sizes, prefix, pairs = self.size, self.prefix, self.pairs
        ids: list[int] = []
        dead: set[int] = set()               # positions from which no way leads to the end
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + sizes[token]
                if end not in dead:
                    if last < 0:
                        break
                    fits = pairs.get((last, token))
                    if fits or fits is None and self.compatible(last, token):
                        break
                token = prefix[token]
            if token >= 0:
                ids.append(token)
                at, last, token = end, token, longest[end]
            elif ids:
                dead.add(at)
                token = ids.pop()            # its end is dead now, so a prefix follows
                at -= sizes[token]
                last = ids[-1] if ids else -1
            else:
                raise ValueError(f"no segmentation of {raw!r}")
        return ids


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class TextCodec:
    """Whole texts to packed ids and back, as the library does with the same file."""

    #: Texts of these characters only need no general normaliser: lower case is letter by
    #: letter there, everything is composed already, and letters, digits and white space are known.
    PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
    PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t-\ra-z0-9ß-öø-ÿ]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.encoder = BacktrackEncoder(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = {s: pack([i]) for s, i in special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.bytes_of = {c: b for b, c in enumerate(self.encoder.letters)}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # token texts in one buffer; without a decoder the library joins them by spaces
        texts = {i: t for t, i in model["vocab"].items()} | {i: s for s, i in special.items()}
        pieces = [texts.get(i, "").encode() + b" " for i in range(max(texts) + 1)]
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.buffer = np.frombuffer(b"".join(pieces), np.uint8)

    def words(self, text: str) -> list[str]:
        if self.PLAIN.fullmatch(text):
            return self.PLAIN_WORD.findall(text.lower())
        normal = self.library.normalizer.normalize_str(text)
        return [bytes(map(self.bytes_of.__getitem__, w)).decode("utf-8")
                for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split is not None and "<" in text:
            return b"".join(self.special.get(part) or self._encode(part) for part in self.split.split(text) if part)
        return self._encode(text)

    def _encode(self, text: str) -> bytes:
        words = self.words(text)
        if len(self.cache) > CACHE_WORDS:
            self.cache, self.older = {}, self.cache
        cache, older = self.cache, self.older
        for w in set(words).difference(cache):
            cache[w] = older.get(w) or pack(self.encoder.encode(w))
        return b"".join([cache[w] for w in words])

    def decode(self, packed: bytes) -> str:
        ids, out = np.frombuffer(packed, "<u4"), []
        for k in range(0, len(ids), DECODE_IDS):
            part = ids[k:k + DECODE_IDS]
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(self.starts[part] - (ends - sizes), sizes)
            out.append(self.buffer[at].tobytes())
        return b"".join(out)[:-1].decode("utf-8", "replace")


def encode_documents(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``n_tokens`` (long), ``ids`` (binary: little-endian
    unsigned 32-bit integers) and ``decoded`` (the text that the ids give back)."""
    def make():
        codec = kept(("bpe", tokenizer_path), lambda: TextCodec(tokenizer_path))

        def apply(texts):
            ids = [codec.encode(t) for t in texts]
            return [[len(x) // 4 for x in ids], ids, [codec.decode(x) for x in ids]]

        return apply

    return with_python_columns(docs, text_col, {"n_tokens": "long", "ids": "binary", "decoded": "string"}, make)
