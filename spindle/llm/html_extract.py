"""Main text of web pages as the maximum-scoring contiguous region.

A page is read as a run of tags and words. Words score the share of words in elements
like theirs that labelled pages have in their content, tags score below zero: slightly
if labelled pages have them within content, heavily, by their log odds, if outside. One
linear scan finds the contiguous region of the highest score. Its text is then cut into
blocks, without what is never content wherever it stands (scripts, forms, menus, adverts,
comments, by element name or by a whole token of class, id or role).

Labelled content (``<article>``, ``<main>``) ends a drop it stands in, as by an unclosed
advert before it or a wrapper. An element dropped by its class, id or role, or in a page
without labelled content by its name, that holds most of the page's words isn't dropped,
as a form around the page or a menu that is never closed: its tags score strongly below
zero instead, and what stands in it is judged like the rest. End tags that HTML lets
pages omit are implied. The time is linear in the page, whatever its markup.

Labels come from the pages' own markup: in pages with an ``<article>`` or ``<main>``
element, what stands in it is content. Weights are learnt from a bounded sample of
``SAMPLE_PAGES`` such pages, by the order of a hash of the page, and used for all pages,
marked up or not. Extraction is a map over whole pages: no shuffle, no skew.

Defined cases: null, empty or wordless html gives an empty text; a tag cut off by the
page's end is a tag; unclosed elements end with the element around them; equal rows give
equal texts; without labelled pages all elements count alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.arrow_map import with_python_columns
from spindle.llm.common import saved

SAMPLE_PAGES = 2000
#: Element kinds with weights of their own, the most frequent ones.
MAX_KINDS = 5000
#: Words that one unit of a tag's log odds outweighs, and what a tag within content costs.
OUTSIDE_WORDS, INSIDE_COST = 20.0, 0.1
#: What a tag costs whose name speaks against content, if its element holds more than this share of the words.
NAMED_COST, MOST = 100.0, 0.5
#: Mark of the kind of such a tag.
NAMED = "!"

#: Elements that mark content in labelled pages.
CONTENT_TAGS = frozenset(("article", "main"))
#: Elements that never hold content.
DROPPED_TAGS = frozenset((
    "aside", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "header", "iframe", "menu", "nav",
    "noscript", "object", "script", "select", "style", "svg", "template", "textarea", "title"))
#: Tokens of a class, id or role that mark what isn't content.
DROPPED_NAMES = frozenset((
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent",
    "cookie", "cookies", "disqus", "footer", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notification", "popup", "promo", "promoted", "related", "replies", "share", "sharing",
    "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"))
#: Elements that begin and end a block of text.
BLOCK_TAGS = frozenset((
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"))
#: Elements without an end tag.
VOID_TAGS = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
                       "track", "wbr"))
#: Elements that a head holds; anything else ends it.
HEAD_TAGS = frozenset(("base", "link", "meta", "noscript", "object", "script", "style", "template", "title"))
#: Open elements that a start tag ends.
ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
            "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "tbody": ("td", "th", "tr", "thead", "tbody"),
            "tfoot": ("td", "th", "tr", "tbody"), "body": ("head",)}
#: Elements whose inside is raw text.
RAW_TAGS = "script|style|textarea|title|noscript|iframe|template"

# a quote delimits a value only after an equals sign; possessive, hence linear
ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<raw>{RAW_TAGS})\b{ATTRIBUTES}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*+)(?P<rest>{ATTRIBUTES})(?:>|\Z)|(?P<text>[^<]+|<)",
    re.I | re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_WORD = re.compile(r"[a-z]+")


def tokens(page: str):
    """Yields (kind, name, text, words, drop, content): for a tag its kind (``name`` or
    ``name.class``, marked if a dropped name is overruled), for text the kind of the element around it; whether it stands in what
    is never content, and in labelled content."""
    # a scope is 0 outside, else a number for an element that is dropped by its name or names
    stack = [("", "", 0, False)]             # name, kind, scope, in content
    still: Counter = Counter()               # open elements by name: an end tag without one costs nothing
    parts, above, words, by_tag, opens = [], [0], [0], [False], {}
    labelled = 0

    def pop():
        still[stack.pop()[0]] -= 1

    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            n = len(text.split())
            if n and stack[-1][0] == "head":
                pop()
            _, kind, scope, content = stack[-1]
            words[scope] += n
            labelled += n if content and not scope else 0
            parts.append((kind, None, text, n, scope, content))
            continue
        name = m["name"]
        if name is None:                     # a comment, declaration or raw element
            continue
        name = name.lower()
        if m["end"]:
            if still[name]:
                while stack[-1][0] != name:
                    pop()
                _, kind, scope, content = stack[-1]
                if opens.get(scope) == len(stack) - 1:
                    kind = f"{NAMED}{scope} {kind}"
                pop()
            else:
                _, _, scope, content = stack[-1]
                kind = name
            parts.append((kind, name, None, 0, scope, content))
            continue
        rest, kind, named = m["rest"], name, False
        if "=" in rest:
            values = ["".join(g).lower() for g in NAMES.findall(rest)]
            names = [w for v in values for w in NAME_WORD.findall(v)]
            if names:
                kind = f"{name}.{names[0]}"
                named = any(not DROPPED_NAMES.isdisjoint(v.split()) for v in values)
        if stack[-1][0] == "head" and name not in HEAD_TAGS:
            pop()
        if stack[-1][0] == "p" and name in BLOCK_TAGS:
            pop()                            # a block ends the paragraph before
        while stack[-1][0] in ENDED_BY.get(name, ()):
            pop()
        _, _, scope, content = stack[-1]
        opened, by_name = kind, name in DROPPED_TAGS
        if name in CONTENT_TAGS:
            scope = scope if named else 0
        elif by_name or (named and name not in ("html", "body")):
            above.append(scope)
            words.append(0)
            by_tag.append(by_name)
            scope = len(above) - 1
            opens[scope] = len(stack)
            opened = f"{NAMED}{scope} {kind}"
        content = content or name in CONTENT_TAGS
        if name not in VOID_TAGS and not rest.endswith("/"):
            stack.append((name, kind, scope, content))
            still[name] += 1
        parts.append((opened, name, None, 0, scope, content))
    total, held = sum(words), words[:]
    for i in range(len(above) - 1, 0, -1):
        held[above[i]] += held[i]
    dropped = [False]
    for i in range(1, len(above)):
        dropped.append(dropped[above[i]] or (by_tag[i] and labelled > 0) or held[i] <= MOST * total)
    for kind, name, text, n, scope, content in parts:
        drop = dropped[scope]
        if kind.startswith(NAMED):
            own = kind.partition(" ")[2]
            kind = own if drop else NAMED + own
        yield kind, name, text, n, drop, content


@dataclass(frozen=True)
class Weights:
    """What a word in an element, and a tag, scores by the element's kind."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, kind: str) -> float:
        if kind in self.words:
            return self.words[kind]
        return self.words.get(kind.partition(".")[0], 0.5)

    def tag(self, kind: str) -> float:
        if kind.startswith(NAMED):
            return -NAMED_COST
        if kind in self.tags:
            return self.tags[kind]
        return self.tags.get(kind.partition(".")[0], -INSIDE_COST)


def extract(page: str, weights: Weights) -> str:
    """The blocks of the best region, joined by line feeds."""
    parts = list(tokens(page))
    # the best sum of a stretch that begins and ends with text
    best = total = 0.0
    first = start = end = -1
    for i, (kind, name, _, n, drop, _) in enumerate(parts):
        if name is not None:
            # an element that is cut out anyway doesn't part the text around it
            total += -INSIDE_COST if drop else weights.tag(kind)
        elif n and not drop:
            if total <= 0:
                total, first = 0.0, i
            total += n * weights.word(kind)
            if total > best:
                best, start, end = total, first, i
    if start < 0:
        return ""
    blocks, block = [], []
    for _, name, text, _, drop, _ in parts[start:end + 1]:
        if name in BLOCK_TAGS:
            blocks.append(block)
            block = []
        elif name == "br":
            block.append(" ")
        elif name is None and not drop:
            block.append(text)
    blocks.append(block)
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def learn_weights(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from the bounded sample of pages that mark their content."""
    marked = pages.select(F.col(html_col).alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    key = F.xxhash64("html")
    # bounded by SAMPLE_PAGES, hence the broadcast
    picked = saved(marked.select(key.alias("key")).distinct().orderBy("key").limit(SAMPLE_PAGES), "html-picked")
    sample = (marked.join(F.broadcast(picked), key == F.col("key")).select("html").dropDuplicates(["html"]))

    def run(batches):
        sums: Counter = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                for kind, name, _, n, drop, content in tokens(page):
                    for k in {kind, kind.partition(".")[0]}:
                        sums[k, name is None, content and not drop] += n if name is None else 1
        if sums:
            columns = [*zip(*sums, strict=True), tuple(sums.values())]
            types = (pa.string(), pa.bool_(), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                             ["kind", "word", "content", "n"])

    side = lambda inside: F.sum(F.when(F.col("content") == inside, F.col("n")).otherwise(0))
    rows = (sample.mapInArrow(run, "kind string, word boolean, content boolean, n long")
            .groupBy("kind", "word").agg(side(True).alias("inside"), side(False).alias("outside"))
            .orderBy((F.col("inside") + F.col("outside")).desc(), "kind", "word").limit(2 * MAX_KINDS).collect())
    words, tags = {}, {}
    for r in rows:
        share = (r.inside + 1) / (r.inside + r.outside + 2)
        if r.word:
            words[r.kind] = share
        else:
            odds = math.log((1 - share) / share)
            tags[r.kind] = -INSIDE_COST if odds <= 0 else -INSIDE_COST - OUTSIDE_WORDS * odds
    return Weights(words, tags)


def extract_pages(pages: DataFrame, weights: Weights, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` plus the main text."""
    return with_python_columns(pages, html_col, {out_col: "string"},
                               lambda: lambda texts: [[extract(t, weights) for t in texts]])
