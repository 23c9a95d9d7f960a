"""Byte-level BPE encoding and decoding by speculation and verification.

A greedy longest match over the tokens that merges can reach proposes the tokens of every new word. A
proposal is right exactly when each pair of neighbours fits, that is when no merge across their
border would have come before a merge inside them; all distinct pairs of a batch are tested at once
on arrays. Only the words with a pair that doesn't fit are merged step by step. Words are remembered
per process within a bound. Texts are cut into words by the pattern of the tokenizer file's
pre-tokenizer; special strings become their own ids, as in the library.

A null or empty text has no tokens and decodes to the empty text; long texts are handled in slices.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import slices

MODEL = "byte_bpe_50k.json"
MEMO = 700_000
BATCH_CHARS = 1 << 21
SHORT = 200
PLAIN_END = "\u0250"
BEYOND = re.compile("[^\0-\u024f]")
LONGEST = 1000  # no token is longer
_BIG = 1 << 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the file: itself, or the next from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def plain_pattern() -> re.Pattern:
    """The same words for texts below ``PLAIN_END``, with the classes written out for the faster engine."""
    def of(*kinds: str) -> str:
        return "".join(c for c in map(chr, range(ord(PLAIN_END))) if unicodedata.category(c)[0] in kinds)

    letters, numbers = of("L"), of("N")
    blanks = r"\t-\r \x85\xa0"
    return re.compile(rf" ?[{letters}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{numbers}]+| ?[^{blanks}{letters}{numbers}]+"
                      rf"|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


class Codec:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = {c: b for b, c in enumerate(byte_letters())}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for t, i in vocab.items():
            if t not in self.special:
                self.bytes[i] = bytes(of[c] for c in t)
        for t, i in self.special.items():
            self.bytes[i] = t.encode()
        self.text = [str(i) for i in range(size)]
        self.size = size
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        a = np.array([vocab[x] for x, _ in merges], np.int64)
        b = np.array([vocab[y] for _, y in merges], np.int64)
        made = np.array([vocab[x + y] for x, y in merges], np.int64)
        order = np.argsort(a * size + b)
        self.pair_keys, self.pair_ranks = (a * size + b)[order], order.astype(np.int64)
        self.rank_of = dict(zip(zip(a.tolist(), b.tolist()), range(len(merges))))
        self.made = made.tolist()
        self.left, self.right, self.rank = np.arange(size), np.arange(size), np.full(size, -1, np.int64)
        self.left[made], self.right[made], self.rank[made] = a, b, np.arange(len(merges))
        self.byte_id = [vocab[c] for c in byte_letters()]
        # tokens that merging their own bytes really leads to
        sound = self.fit(a, b, np.arange(len(merges)))
        reach = np.zeros(size, bool)
        reach[self.byte_id] = True
        for x, y, m, ok in zip(a.tolist(), b.tolist(), made.tolist(), sound.tolist()):
            reach[m] = ok and reach[x] and reach[y]
        self.tokens = {self.bytes[i].decode("latin-1"): i for i in np.flatnonzero(reach).tolist()}
        self.trie = ahocorasick.Automaton()
        for t, i in self.tokens.items():
            self.trie.add_word(t, i)
        self.words = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}")
                                   .replace(r"\s+(?!\S)|\s+", r"\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"))
        self.plain_words = plain_pattern()
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
                                   or r"(?!)")
        self.memo: dict[str, tuple[int, ...]] = {}
        self.tails: dict[str, tuple[int, ...]] = {}

    def fit(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Which pairs of tokens stay apart, looking at merges before ``limit`` only."""
        good, live = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), _BIG) if limit is None else limit
        while len(live):
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            crossed = (self.pair_keys[at] == key) & (self.pair_ranks[at] < limit)
            good[live[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~crossed & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[go], a[go], b[go], ra[go], rb[go]
            first = ra > rb  # undo the later merge of the two
            limit = np.where(first, ra, rb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return good

    def propose(self, w: str) -> tuple[int, ...]:
        """Greedy longest match over a word's bytes (as Latin-1); the rest of a word is remembered."""
        known = self.tails.get(w)
        if known is not None:
            return known
        n, get, reach = len(w), self.tokens.get, self.trie.longest_prefix
        out, i, rest = [], 0, w
        while True:
            end = reach(rest)
            while (t := get(rest[:end])) is None:
                end -= 1
            out.append(t)
            i += end
            if i == n:
                return tuple(out)
            rest = w[i:i + LONGEST]
            if n <= SHORT and (known := self.tails.get(rest)) is not None:
                return (*out, *known)
            if len(out) == 1 and 1 < len(rest) <= 12 and n <= SHORT:
                self.tails[rest] = known = self.propose(rest)
                return (*out, *known)

    def merge(self, w: bytes) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost of equals."""
        if len(w) > SHORT:
            return self._merge_long(w)
        rank_of, made = self.rank_of.get, self.made
        ids = list(map(self.byte_id.__getitem__, w))
        ranks = list(map(rank_of, zip(ids, ids[1:]), repeat(_BIG)))
        while ranks and (low := min(ranks)) != _BIG:
            i = ranks.index(low)
            ids[i:i + 2] = [made[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of((ids[i - 1], ids[i]), _BIG)
            if i < len(ranks):
                ranks[i] = rank_of((ids[i], ids[i + 1]), _BIG)
        return ids

    def _merge_long(self, w: bytes) -> list[int]:
        """The same with a heap of pairs, for words of many bytes."""
        ids, n, rank_of, made = [self.byte_id[c] for c in w], len(w), self.rank_of.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := rank_of((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, x, y = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != x or ids[j] != y:
                continue
            ids[i], ids[j], after[i] = made[r], -1, after[j]
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    if (r := rank_of((ids[k], ids[after[k]]))) is not None:
                        heapq.heappush(heap, (r, k, ids[k], ids[after[k]]))
            if after[i] < n:
                before[after[i]] = i
        return [t for t in ids if t >= 0]

    def learn(self, words: set[str]) -> None:
        """Put the tokens of new words into the memo."""
        if len(self.memo) >= MEMO:
            self.memo.clear()
        if len(self.tails) >= MEMO:
            self.tails.clear()
        new = list(words.difference(self.memo))
        if not new:
            return
        raw = [w.encode("utf-8", "replace") for w in new]
        found: list = [self.propose(w.decode("latin-1")) for w in raw]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((t for f in found for t in f), np.int64, int(sizes.sum()))
        word = np.repeat(np.arange(len(new)), sizes)
        inner = word[1:] == word[:-1]
        key, back = np.unique(flat[:-1][inner] * self.size + flat[1:][inner], return_inverse=True)
        bad = ~self.fit(key // self.size, key % self.size)[back]
        for i in np.unique(word[1:][inner][bad]).tolist():
            found[i] = self.merge(raw[i])
        self.memo.update(zip(new, map(tuple, found)))

    def _pieces(self, text: str) -> Iterator[list[str] | int]:
        """The words of a slice, or the id of a special string, in order."""
        at = 0
        for m in [*self.marks.finditer(text), None]:
            for part in slices(text[at:m.start() if m else len(text)]):
                if part:
                    yield (self.words if BEYOND.search(part) else self.plain_words).findall(part)
            if m:
                yield self.special[m[0]]
                at = m.end()

    def encode_all(self, texts: list[str]) -> Iterator[tuple[int, list[int]]]:
        """(place of the text, ids of its next part) in order; new words are learned together."""
        waiting, chars, new = [], 0, set()
        for k, text in enumerate(texts):
            for piece in self._pieces(text):
                waiting.append((k, piece))
                if not isinstance(piece, int):
                    new.update(piece)
                    chars += sum(map(len, piece))
                if chars > BATCH_CHARS:
                    yield from self._resolve(waiting, new)
                    waiting, chars, new = [], 0, set()
        yield from self._resolve(waiting, new)

    def _resolve(self, waiting, new) -> Iterator[tuple[int, list[int]]]:
        self.learn(new)
        memo = self.memo
        for k, piece in waiting:
            if isinstance(piece, int):
                yield k, [piece]
            else:
                ids: list[int] = []
                for w in piece:
                    ids += memo[w]
                yield k, ids

    def encode(self, text: str) -> list[int]:
        return [i for _, ids in self.encode_all([text]) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """doc_id and the token ids of every text."""
    def run(batches):
        c = codec(public_tokenizers.path(model))
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.array(c.encode(t or ""), np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([ids], pa.list_(pa.int32()))],
                                                 ["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and the text of every row of ids."""
    def run(batches):
        c = codec(public_tokenizers.path(model))
        for b in batches:
            texts = [c.decode(ids or []).decode("utf-8", "replace") for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """Encode and decode every text; digests only, so that ids and texts never leave the task."""
    def run(batches):
        c = codec(public_tokenizers.path(model))
        for b in batches:
            n = b.num_rows
            counts, of_ids, of_text = [0] * n, [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
            for k, ids in c.encode_all([t or "" for t in b.column(1).to_pylist()]):
                of_ids[k].update(("," if counts[k] else "").encode() + ",".join(map(c.text.__getitem__, ids)).encode())
                # parts end at character borders, so each decodes on its own
                of_text[k].update(c.decode(ids).decode("utf-8", "replace").encode())
                counts[k] += len(ids)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array([x.hexdigest() for x in of_ids], pa.string()),
                 pa.array([x.hexdigest() for x in of_text], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
