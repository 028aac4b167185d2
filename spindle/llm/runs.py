"""Periodic runs of words by longest common extensions on a difference cover.

A run is a stretch of words with smallest period ``q``, at least ``max(MIN_WORDS, MIN_POWER * q)``
long, that can't be extended on either side. For every period the words at a grid of step
``(MIN_POWER - 1) * q`` are compared with the words ``q`` later: a run of that period holds
at least one such pair (the harmonic sum of grids is ``n log n``). Pairs that agree are
extended both ways by longest common extensions, which give the run that holds them.

Extensions need few words: positions whose remainder by ``V`` is in a difference cover are
sampled, and any two positions are both sampled after the same shift of fewer than ``V``
words. That shift is compared word by word; from there the answer is a range minimum over
the common prefixes of neighbours in the sorted order of sampled suffixes, kept as a sparse
table. Only sampled suffixes are sorted: by ``V`` words, then by doubling, each time only
those that are still tied. The documents of a batch are joined with separators of their own
and sorted apart, so that copies in other documents cost nothing. Reversed words give the
extensions to the left.

A map over whole texts, without a shuffle: a text is handled by itself in memory
proportional to its words, and a lost task is just run again.

Defined cases: a null or empty text has no words and no runs; equal rows give equal
results, each by itself; an empty table gives an empty result; a column of the input named
like an output is replaced; words are compared as bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from spindle.llm.arrow_map import with_python_columns

MIN_WORDS, MIN_POWER = 6, 4
#: The smallest difference covers of these moduli.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18)}
V = 31
#: Words of texts worked on together, and grid points compared at a time.
BATCH_WORDS, GRID_POINTS = 1 << 18, 1 << 20


class CommonExtensions:
    """Longest common extension of any two positions of ``words``, counted in words.

    ``group`` numbers ascend with the position (a document each); the last word of each
    group must occur nowhere else. Positions compared must be of one group.
    """

    def __init__(self, words: np.ndarray, group: np.ndarray, v: int = V):
        cover = np.array(COVERS[v])
        self.v, self.k = v, len(cover)
        n = len(words)
        rows = n // v + 2
        # room for a whole row of steps after the last word, each unlike any other
        self.words = np.concatenate([words, np.arange(-1, n - rows * v - v - 1, -1)])
        self.slot = np.full(v, -1)
        self.slot[cover] = np.arange(self.k)
        self.shift = self._shifts(cover)
        pos = (np.arange(rows)[:, None] * v + cover).ravel()
        self.pos = pos
        self.group = np.concatenate([group, np.full(len(self.words) - n, group[-1] + 1 if n else 0)])
        self._sort()

    def _shifts(self, cover: np.ndarray) -> np.ndarray:
        """The smallest shift after which two remainders are both in the cover."""
        inside = np.zeros(self.v, bool)
        inside[cover] = True
        r = np.arange(self.v)
        out = np.full((self.v, self.v), -1)
        for d in range(self.v - 1, -1, -1):
            both = inside[(r[:, None] + d) % self.v] & inside[(r + d) % self.v]
            out[both] = d
        return out

    def _sort(self) -> None:
        words, pos, m = self.words, self.pos, len(self.pos)
        # a sampled suffix starts with its group: ties are within a document
        first, low = words[pos], int(words.min())
        span = int(words.max()) - low + 1
        order = np.argsort(self.group[pos] * span + (first - low))
        new = np.ones(m, bool)
        new[1:] = (self.group[pos[order[1:]]] != self.group[pos[order[:-1]]]) | (first[order[1:]] != first[order[:-1]])
        rank = np.empty(m, np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(m), 0))
        common = np.zeros(m, np.int32)          # words shared with the suffix before, while untied
        levels = []

        def refine(key_of: Callable, rank: np.ndarray, shared: int | None) -> np.ndarray:
            """Ties in ``order`` broken by a further key; ``shared`` is the prefix of those parted."""
            nonlocal new
            tied = ~new
            tied[:-1] |= ~new[1:]
            at = np.flatnonzero(tied)
            if not len(at):
                return rank
            items = order[at]
            key = key_of(items)
            low = int(key.min())
            sub = np.argsort(rank[items] * (int(key.max()) - low + 1) + (key - low))
            items, key = items[sub], key[sub]
            order[at] = items
            r = rank[items]
            parted = np.ones(len(at), bool)
            parted[1:] = (r[1:] != r[:-1]) | (key[1:] != key[:-1])
            fresh = parted & ~new[at]
            if shared is not None:
                common[at[fresh]] = shared
            new[at] = parted
            rank = rank.copy()
            rank[items] = np.maximum.accumulate(np.where(parted, at, 0))
            return rank

        for t in range(1, self.v):
            if new.all():
                break
            rank = refine(lambda items, t=t: words[pos[items] + t], rank, t)
        by_words = new.copy()
        width = 1                                # in rows of the cover
        while not new.all():
            levels.append((width, rank))
            step = width * self.k
            # tied suffixes share their words so far, hence another sampled one follows
            rank = refine(lambda items, s=step, r=rank: r[items + s], rank, None)
            width *= 2
        # suffixes that share v words or more: down the levels, then word by word
        late = np.flatnonzero(new & ~by_words)
        a, b = order[late - 1].copy(), order[late].copy()
        length = np.zeros(len(late), np.int64)
        for width, r in reversed(levels):
            same = r[a] == r[b]
            length[same] += width * self.v
            a[same] += width * self.k
            b[same] += width * self.k
        pa, pb, alive = pos[a], pos[b], np.arange(len(late))
        while len(alive):
            alive = alive[words[pa[alive]] == words[pb[alive]]]
            length[alive] += 1
            pa[alive] += 1
            pb[alive] += 1
        common[late] = length
        self.place = np.empty(m, np.int64)
        self.place[order] = np.arange(m)
        sizes = np.bincount(self.group[pos]) if m else np.zeros(1, np.int64)
        self.table = [common]
        while (half := 1 << (len(self.table) - 1)) * 2 <= sizes.max():
            last = self.table[-1]
            level = last.copy()
            level[:-half] = np.minimum(last[:-half], last[half:])
            self.table.append(level)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words from ``a`` and ``b`` on that agree, for arrays of positions, all a != b."""
        shift = self.shift[a % self.v, b % self.v]
        out = np.zeros(len(a), np.int64)
        alive = np.arange(len(a))
        t = 0
        met = []
        while len(alive):
            arrived = shift[alive] == t
            met.append(alive[arrived])
            alive = alive[~arrived]
            alive = alive[self.words[a[alive] + t] == self.words[b[alive] + t]]
            t += 1
            out[alive] = t
        at = np.concatenate(met) if met else alive
        if len(at):
            x, y = self._sample(a[at] + shift[at]), self._sample(b[at] + shift[at])
            lo, hi = np.minimum(x, y) + 1, np.maximum(x, y) + 1
            level = np.frexp((hi - lo).astype(np.float64))[1] - 1
            least = np.empty(len(at), np.int64)
            for e in np.unique(level):
                i = level == e
                least[i] = np.minimum(self.table[e][lo[i]], self.table[e][hi[i] - (1 << int(e))])
            out[at] = shift[at] + least
        return out

    def _sample(self, p: np.ndarray) -> np.ndarray:
        return self.place[p // self.v * self.k + self.slot[p % self.v]]


def grid(sizes: np.ndarray, starts: np.ndarray):
    """Pairs ``(position, period)`` of all texts, in parts of about ``GRID_POINTS``."""
    most = sizes // MIN_POWER
    most[sizes < MIN_WORDS] = 0
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (MIN_POWER - 1) * period
    points = -(-(sizes[text] - period) // step)
    ends = np.cumsum(points)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_POINTS)))
        n = points[at:to]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(starts[text[at:to]], n) + k * np.repeat(step[at:to], n), np.repeat(period[at:to], n)
        at = to


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each text (arrays of word numbers >= 0): rows ``start, length, period`` by
    start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    none = np.zeros((0, 3), np.int64)
    if not len(texts) or sizes.max() < MIN_WORDS:
        return [none] * len(texts)
    top = max((int(t.max()) for t in texts if len(t)), default=0) + 1
    words = np.empty(total, np.int64)
    for i, (t, s) in enumerate(zip(texts, starts)):
        words[s:s + len(t)] = t
        words[s + len(t)] = top + i              # ends the text, and is met nowhere else
    group = np.repeat(np.arange(len(texts)), sizes + 1)
    # reversed texts end with their separators too
    at, inner = np.arange(total), np.arange(total) < (starts + sizes)[group]
    mirror = np.where(inner, (2 * starts + sizes - 1)[group] - at, at)
    onward = backward = None
    found = [none]
    for p, q in grid(sizes, starts):
        same = np.flatnonzero(words[p] == words[p + q])
        if not len(same):
            continue
        if onward is None:
            onward, backward = CommonExtensions(words, group), CommonExtensions(words[mirror], group)
        p, q = p[same], q[same]
        right, left = onward(p, p + q), backward(mirror[p], mirror[p + q])
        length = left - 1 + right + q
        keep = length >= np.maximum(MIN_WORDS, MIN_POWER * q)
        found.append(smallest_periods(np.stack([p - left + 1, length, q], axis=1)[keep]))
    runs = smallest_periods(np.concatenate(found))
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    text = group[runs[:, 0]]
    runs[:, 0] -= starts[text]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [runs[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Each stretch once: it is found at multiples of its period, and from several grid points."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def strongest(runs: np.ndarray) -> dict | None:
    """The run of the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best["period"] > best["length"] * period:
            best = {"start": start, "length": length, "period": period}
    return best


def collapse(words: list[bytes], runs: np.ndarray) -> str:
    """The words outside all runs and in some run's first period only, joined by one space."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode("utf-8")


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _rows(texts: list[str]) -> tuple[list, list, list]:
    words, batch, n, out = [], [], 0, ([], [], [])

    def done():
        number = defaultdict(count().__next__)   # equal words, equal numbers
        arrays = [np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in batch]
        for w, runs in zip(batch, find_runs(arrays), strict=True):
            out[0].append([dict(zip(("start", "length", "period"), r)) for r in runs.tolist()])
            out[1].append(strongest(runs))
            out[2].append(collapse(w, runs))

    for text in texts:
        words = text.encode("utf-8").split()     # bytes split at exactly the six characters
        if batch and n + len(words) > BATCH_WORDS:
            done()
            batch, n = [], 0
        batch.append(words)
        n += len(words)
    if batch:
        done()
    return out


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` plus ``runs`` (by start, then period), ``top_run`` (the
    run of the greatest exponent, null without runs) and ``collapsed`` (the words joined by
    one space, each run cut to its first period)."""
    return with_python_columns(docs, text_col, {"runs": f"array<{RUN}>", "top_run": RUN, "collapsed": "string"},
                               lambda: _rows)
