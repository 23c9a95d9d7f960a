"""Periodic runs of words: suffix-tree LCE over the text and its reversal, Lyndon roots as candidates.

A run is a maximal stretch of words with smallest period q (words q apart are identical, and no
neighbouring word extends it keeping period q). Runs of length at least ``max(MIN_LENGTH,
MIN_EXPONENT * q)`` are reported; a word is dropped when a run holds it after the run's first q words.

Method, per document (a Spark task handles a batch of documents; documents are independent):

1. Regions. A run of length >= 24 and >= 3q is covered by word 8-grams that occur twice in the
   document (every 8-gram inside it recurs q words away), so maximal intervals covered by repeated
   8-grams hold every run, and a run maximal inside its interval is maximal in the document. Text
   outside such intervals cannot hold a run and is not given to the trees. This is exact, not a cap.
2. For each region, Ukkonen suffix trees of the region and of its reversal, Euler tours of their
   string depths and sparse tables answer longest-common-extension queries in constant time
   (the string depth of the lowest common ancestor of two leaves).
3. Lyndon arrays for both orders of the word alphabet come from the forward tree's suffix order
   (next smaller suffix). Every run has a Lyndon root that is the longest Lyndon word at its start
   in one of the two orders (the runs theorem), so each position i with root length p is extended
   forwards (LCE of i and i+p) and backwards (LCE of the reversal at i-1 and i+p-1); a stretch of
   at least 2p is a run with smallest period p.

Defined results: null or empty text has no words and no runs; a text of under 24 words has no run.
Memory of a task is linear in its longest region (about 60 machine words a word of the region).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MIN_LENGTH, MIN_EXPONENT = 24, 3
_GRAM = 8  # a run of at least MIN_LENGTH words is covered by its repeated 8-grams (see above)


def suffix_tree(s: list[int]) -> tuple[list[int], list[int], list[dict]]:
    """Ukkonen's online construction over ``s`` followed by a unique terminal (-1).

    Returns (edge start, edge end, children by first symbol); node 0 is the root, leaf edges end at
    len(s) + 1.
    """
    text = list(s) + [-1]
    n = len(text)
    start, end, link, child = [0], [0], [0], [{}]

    def node(a: int, b: int) -> int:
        start.append(a)
        end.append(b)
        link.append(0)
        child.append({})
        return len(start) - 1

    an, ae, al, remainder = 0, 0, 0, 0
    for i in range(n):
        c = text[i]
        remainder += 1
        last = 0
        while remainder:
            if al == 0:
                ae = i
            kids = child[an]
            nxt = kids.get(text[ae])
            if nxt is None:
                kids[text[ae]] = node(i, n)
                if last:
                    link[last] = an
                    last = 0
            else:
                edge = min(end[nxt], i + 1) - start[nxt]
                if al >= edge:
                    ae += edge
                    al -= edge
                    an = nxt
                    continue
                if text[start[nxt] + al] == c:
                    if last and an:
                        link[last] = an
                    al += 1
                    break
                split = node(start[nxt], start[nxt] + al)
                kids[text[ae]] = split
                child[split][c] = node(i, n)
                start[nxt] += al
                child[split][text[start[nxt]]] = nxt
                if last:
                    link[last] = split
                last = split
            remainder -= 1
            if an == 0 and al > 0:
                al -= 1
                ae = i - remainder + 1
            elif an:
                an = link[an]
    return start, end, child


class Extensions:
    """Longest common extension of two suffixes of ``s`` in O(1), by a suffix tree and an Euler tour.

    ``order`` gives the suffix array for the normal (0) and the inverted (1) word order, the
    terminal being smallest in both.
    """

    def __init__(self, s: list[int]):
        n = len(s)
        start, end, child = suffix_tree(s)
        depth_of = [0] * len(start)
        tour: list[int] = []
        first = np.zeros(n + 1, np.int64)
        self.n = n
        self._child, self._start, self._end = child, start, end
        stack = [(0, iter(sorted(child[0].items())))]
        tour.append(0)
        while stack:
            v, it = stack[-1]
            nxt = next(it, None)
            if nxt is None:
                stack.pop()
                if stack:
                    tour.append(depth_of[stack[-1][0]])
                continue
            w = nxt[1]
            depth_of[w] = depth_of[v] + (min(end[w], n + 1) - start[w])
            if not child[w]:
                first[n + 1 - depth_of[w]] = len(tour)  # leaf of suffix n + 1 - depth (terminal counted)
                tour.append(depth_of[w] - 1)
                tour.append(depth_of[v])
            else:
                tour.append(depth_of[w])
                stack.append((w, iter(sorted(child[w].items()))))
        self.first = first
        levels = [np.asarray(tour, np.int64)]
        k = 1
        while 2 * k <= len(tour):
            prev = levels[-1]
            levels.append(np.minimum(prev[:-k], prev[k:]))
            k *= 2
        self.levels = levels
        self.depth_of = depth_of

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """LCE of suffixes i and j (arrays; positions in 0..n, n is the empty suffix)."""
        i, j = np.asarray(i, np.int64), np.asarray(j, np.int64)
        out = np.empty(len(i), np.int64)
        same = i == j
        out[same] = self.n - i[same]
        a, b = self.first[i[~same]], self.first[j[~same]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        k = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
        res = np.empty(len(lo), np.int64)
        for level in np.unique(k):
            m = k == level
            tab = self.levels[level]
            res[m] = np.minimum(tab[lo[m]], tab[hi[m] - (1 << int(level)) + 1])
        out[~same] = res
        return out

    def suffix_order(self, inverted: bool) -> list[int]:
        """Suffix start positions (0..n) in lexicographic order; the empty suffix first."""
        n, child, start, end = self.n, self._child, self._start, self._end
        key = (lambda c: (c != -1, -c)) if inverted else (lambda c: c)
        out: list[int] = []
        stack = [(0, 0)]
        while stack:
            v, d = stack.pop()
            if not child[v]:
                out.append(n + 1 - d)
                continue
            for c in sorted(child[v], key=key, reverse=True):
                w = child[v][c]
                stack.append((w, d + min(end[w], n + 1) - start[w]))
        return out


def _lyndon(order: list[int], n: int) -> np.ndarray:
    """Length of the longest Lyndon word at each position: up to the next smaller suffix."""
    rank = np.empty(n + 1, np.int64)
    rank[np.asarray(order, np.int64)] = np.arange(n + 1)
    nxt = [n] * n
    stack: list[int] = []
    r = rank.tolist()
    for i in range(n, -1, -1):
        while stack and r[stack[-1]] > r[i]:
            stack.pop()
        if i < n:
            nxt[i] = stack[-1] if stack else n
        stack.append(i)
    return np.asarray(nxt, np.int64) - np.arange(n)


def runs_of(ids: list[int]) -> set[tuple[int, int, int]]:
    """All maximal runs (start, length, period), exponent at least 2, of a sequence of ints."""
    n = len(ids)
    if n < 2:
        return set()
    fwd, bwd = Extensions(ids), Extensions(ids[::-1])
    found: set[tuple[int, int, int]] = set()
    pos = np.arange(n, dtype=np.int64)
    for inverted in (False, True):
        p = _lyndon(fwd.suffix_order(inverted), n)
        right = fwd.lce(pos, pos + p)
        back = np.zeros(n, np.int64)
        inner = pos > 0
        back[inner] = bwd.lce(n - pos[inner], n - pos[inner] - p[inner])
        length = back + p + right
        hit = length >= 2 * p
        for s, ln, q in zip((pos - back)[hit].tolist(), length[hit].tolist(), p[hit].tolist()):
            found.add((s, ln, q))
    return found


def regions(ids: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals covered by word 8-grams that occur twice or more; only they can hold runs."""
    n = len(ids)
    if n < MIN_LENGTH:
        return []
    with np.errstate(over="ignore"):
        h = np.zeros(n - _GRAM + 1, np.uint64)
        for j in range(_GRAM):
            h = h * np.uint64(0x100000001B3) + (ids[j:n - _GRAM + 1 + j].astype(np.uint64) + np.uint64(1))
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    rep = np.flatnonzero(counts[inverse] > 1)
    if not len(rep):
        return []
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, rep, 1)
    np.add.at(cover, rep + _GRAM, -1)
    on = np.concatenate([[0], (np.cumsum(cover)[:n] > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(on))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2]) if b - a >= MIN_LENGTH]


def analyse(words: list[str]) -> tuple[list[tuple[int, int, int]], list[str]]:
    """(runs sorted by start then period, kept words) of one word sequence."""
    n = len(words)
    if n < MIN_LENGTH:
        return [], list(words)
    codes, _ = pd.factorize(pd.Series(words, dtype=object))
    ids = codes.astype(np.int64)
    runs: list[tuple[int, int, int]] = []
    for a, b in regions(ids):
        for s, ln, q in runs_of(ids[a:b].tolist()):
            if ln >= max(MIN_LENGTH, MIN_EXPONENT * q):
                runs.append((a + s, ln, q))
    runs.sort(key=lambda r: (r[0], r[2]))
    if not runs:
        return runs, list(words)
    drop = np.zeros(n + 1, np.int64)
    for s, ln, q in runs:
        drop[s + q] += 1
        drop[s + ln] -= 1
    keep = np.cumsum(drop)[:n] == 0
    return runs, [w for w, k in zip(words, keep.tolist()) if k]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length/period (exact); ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (
                r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


_RUN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                     T.StructField("period", T.LongType())])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", words: str = "words") -> DataFrame:
    """Per row of ``df``: its id, ``n_words``, ``runs`` (array of start, length, period by start then
    period), ``best`` (the strongest run, null if none) and ``collapsed`` (kept words joined by one
    space). ``words`` is an array of strings; null counts as no words, null elements as empty words.
    """
    id_type = df.schema[id_col].dataType
    out = T.StructType([T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()),
                        T.StructField("runs", T.ArrayType(_RUN)), T.StructField("best", _RUN),
                        T.StructField("collapsed", T.StringType())])

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n_words, all_runs, best, collapsed = [], [], [], []
            for w in pdf["_w"]:
                seq = [] if w is None else ["" if x is None else str(x) for x in w]
                runs, kept = analyse(seq)
                n_words.append(len(seq))
                all_runs.append([{"start": s, "length": ln, "period": q} for s, ln, q in runs])
                top = strongest(runs)
                best.append(None if top is None else {"start": top[0], "length": top[1], "period": top[2]})
                collapsed.append(" ".join(kept))
            yield pd.DataFrame({id_col: pdf["_id"], "n_words": n_words, "runs": all_runs, "best": best,
                                "collapsed": collapsed})

    return df.selectExpr(f"`{id_col}` AS _id", f"`{words}` AS _w").mapInPandas(apply, out)


def sha_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
