"""Token counts at every prefix by dynamic programming, for a BPE model of the sentencepiece library.

A merge sequence is unique, so of all pieces that end at a position exactly one can be the last token
of that prefix: the one that fits behind the last token of the prefix before it. Two tokens fit when
no merge across their border would have come before the merges inside them. Counting forward with this
check gives the exact number of tokens of every prefix, and budget or truncation questions are lookups.

No piece of the model holds a blank behind another character, so a blank starts a new unit, and
units are counted once and remembered. Runs of blanks merge last and from the left. Characters without a
piece fall back to one token for each byte. A null or empty text has no tokens.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import slices

BLANK = "▁"
MEMO = 400_000
LIMIT = 4096
_BIG = 1 << 30


class PrefixCounter:
    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(sp.vocab_size())
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        by_text = {sp.id_to_piece(i): -sp.get_score(i) for i in usable}
        self.runs = {len(t) for t in by_text if set(t) == {BLANK}} | {1}
        assert not any(BLANK in t[1:] and set(t) != {BLANK} for t in by_text)
        multi = sorted((r, t) for t, r in by_text.items() if len(t) > 1 and set(t) != {BLANK})
        singles = sorted({t for t in by_text if len(t) == 1} | {BLANK})
        self.ids = {t: i for i, t in enumerate(singles)}
        self.rank = [-1] * len(singles)
        self.parts = [(i, i) for i in range(len(singles))]
        self.merge: dict[tuple[int, int], int] = {}
        self.fits: dict[int, bool] = {}
        for order, (_, t) in enumerate(multi):
            for cut in range(1, len(t)):
                a, b = self.ids.get(t[:cut]), self.ids.get(t[cut:])
                if a is not None and b is not None and self._fit(a, b, order):
                    self.parts.append((a, b))
                    self.rank.append(order)
                    self.merge[a, b] = order
                    self.ids[t] = len(self.rank) - 1
                    break  # pieces that no merges lead to are left out
        self.finder = ahocorasick.Automaton()
        for t, i in self.ids.items():
            self.finder.add_word(t, (i, len(t)))
        self.finder.make_automaton()  # finds all pieces that end at a place, the longest first
        self.whole: dict[str, int] = {}  # tokens of a whole unit, its blank left out of the key
        self.of_run = {0: 0}

    def _fit(self, a: int, b: int, limit: int = _BIG) -> bool:
        """Do tokens a, b stay apart, by merges that come before ``limit``?"""
        rank, parts, merge = self.rank, self.parts, self.merge
        while True:
            if merge.get((a, b), _BIG) < limit:
                return False
            if rank[a] > rank[b]:
                limit, a = rank[a], parts[a][1]
            elif rank[b] >= 0:
                limit, b = rank[b] + 1, parts[b][0]
            else:
                return True

    def unit(self, w: str) -> list[int]:
        """For a unit that starts with one blank, 2 * count + (is the blank a token of its own) of
        every prefix from the blank alone on."""
        fits = self.fits
        n = len(w)
        last, state = [-1] * (n + 1), [0] * (n + 1)
        done = 0
        for end, (t, size) in self.finder.iter(w):
            i = end + 1
            if i <= done:
                continue
            while done + 1 < i:  # characters without a piece
                done += 1
                state[done] = state[done - 1] + 2 * len(w[done - 1].encode("utf-8", "surrogatepass"))
            j = i - size
            if j:
                p = last[j]
                if p >= 0:
                    pair = p << 20 | t
                    ok = fits.get(pair)
                    if ok is None:
                        ok = fits[pair] = self._fit(p, t)
                    if not ok:
                        continue
                state[i] = state[j] + 2
            else:
                state[i] = 3 if i == 1 else 2
            last[i] = t
            done = i
        while done < n:
            done += 1
            state[done] = state[done - 1] + 2 * len(w[done - 1].encode("utf-8", "surrogatepass"))
        if len(fits) >= 4 * MEMO:
            fits.clear()
        return state[1:]

    def run(self, n: int) -> int:
        """Tokens of n blanks in a row: pairs of equal priority merge from the left.

        Full tokens of the longest run come first, so only a short rest is played through.
        """
        if n not in self.of_run:
            top = max(self.runs)
            if n >= 4 * top:
                whole = n // top - 2
                return whole + self.run(n - whole * top)
            sizes = [1] * n
            while (at := next((i for i, (a, b) in enumerate(zip(sizes, sizes[1:])) if a + b in self.runs), None)) is not None:
                sizes[at:at + 2] = [sizes[at] + sizes[at + 1]]
            self.of_run[n] = len(sizes)
        return self.of_run[n]

    def _units(self, text: str):
        """(blanks before the unit's own, unit), over the whole text."""
        if not text:
            return
        first, spare = True, 0
        for part in slices(text):
            t = part.replace(" ", BLANK)
            pieces = (t if first else t[1:]).split(BLANK)
            first = False
            for k, x in enumerate(pieces):
                if x or k == len(pieces) - 1:
                    yield spare, BLANK + x
                    spare = 0
                else:
                    spare += 1

    def count(self, text: str) -> int:
        total, first, whole = 0, True, self.whole
        if "  " in text or BLANK in text or text.startswith(" ") or text.endswith(" "):
            for spare, w in self._units(text):
                state = self.unit(w)[-1]
                if spare:
                    total += self.run(spare + (state & 1)) - (state & 1)
                total += state >> 1
            return total
        for part in slices(text):
            units = (part if first else part[1:]).split(" ") if part else []
            first = False
            if len(whole) >= MEMO:
                whole.clear()
            for w in set(units).difference(whole):
                whole[w] = self.unit(BLANK + w)[-1] >> 1
            total += sum(map(whole.__getitem__, units))
        return total

    def prefix_counts(self, text: str, budget: int = _BIG) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... len(text) code points.

        Ends after a unit that goes beyond ``budget``; all longer prefixes do too.
        """
        out, total = [], 0
        if not text:
            return np.zeros(1, np.int64)
        for spare, w in self._units(text):
            out.extend(total + self.run(i) for i in range(1, spare + 1))
            before = [total + self.run(spare), total + self.run(spare + 1) - 1]
            out.extend(before[s & 1] + (s >> 1) for s in self.unit(w))
            total = out[-1]
            if total > budget:
                break
        counts = np.array(out, np.int64)
        counts[0] = 0  # the blank that the model puts before a text is not a prefix of it
        return counts

    def fitting(self, text: str, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.prefix_counts(text, budget) <= budget)[-1])


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter per worker process and model."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = "piece_bpe_32k.model",
                 limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and the code points that fit into the limit."""
    def run(batches):
        c = counter(public_tokenizers.path(model))
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [c.count(t) for t in texts]
            fit = [len(t) if k <= limit else c.fitting(t, limit) for t, k in zip(texts, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
                 pa.array(n, pa.int64()), pa.array([k > limit for k in n]), pa.array(fit, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
