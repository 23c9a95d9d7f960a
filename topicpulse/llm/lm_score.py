"""Language-model scores by prediction with partial matching over bytes.

A text is read as its words (lower-cased A-Z), each ended by a blank, and one end mark: one sequence of
bytes, and all of it is coded by the trie. A byte's context are the up to ``ORDER`` bytes before it, over
blanks and words, back to the start of the text (before it: blanks); a context counts how often each byte
followed it in the training texts, every occurrence counted. A byte is coded in the longest context that has
it; where it is new, an escape is coded (method C: distinct followers over their sum with all occurrences) and
the next shorter context is asked, in which the bytes already seen in the longer one are excluded; below order 0
all bytes not yet excluded are equally likely. The score of a text is the sum of the log10 probabilities of its
bytes, by the training texts alone.

The cost of a byte depends on its context only, so only distinct (context, byte) pairs travel, sorted and packed
by parts of their hash. Texts are read once into blocks of about ``BLOCK_CHARS``: a block holds its byte
sequences, its distinct pairs and, for the base score, its distinct words, both with their training counts,
words packed by parts as well. Counts are summed over blocks by groupings of the parts, costs come from joins, and each
block is scored where the costs of its pairs and the counts of its words come back to it. No table of the model is
ever in one place.

A null or empty text has the end mark only. Rows without doc_id are scored like others and belong to the
training texts. Repeated rows are scored one by one. With no training text all bytes are equally likely.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import release, slices, stored, words_of

ORDER = 5
FOLDS, HELD_OUT = 7, 2
BLOCK_CHARS = 28 << 20
END = b"\n"

# Parts of the pairs and of the words of a block; those of one part meet in one group.
PARTS, WORD_PARTS = 64, 512
# Bytes whose pairs are made at once.
STEP = 1 << 21

READ = "block long, part int, words binary, pairs binary, counts binary, payload binary"
COUNTED = "block long, part int, counts binary, total long, distinct long"
ANSWER = "block long, part int, pairs binary, costs binary, counts binary"


def text_pairs(before: list[bytes], texts: list[bytes]) -> np.ndarray:
    """(context, byte) pairs of all bytes of the sequences as numbers of ORDER + 1 bytes; ``before``: the
    ORDER bytes that each begins after."""
    buf = np.frombuffer(b"".join(x for both in zip(before, texts) for x in both), np.uint8)
    count = np.array([len(t) for t in texts], np.int64)
    pair = np.zeros(len(buf) - ORDER, np.int64)
    for k in range(ORDER + 1):
        pair <<= 8
        pair |= buf[k:len(buf) - ORDER + k]
    return pair[np.repeat(ORDER * np.arange(len(texts)), count) + np.arange(int(count.sum()))]


def _steps(sequences: list[bytes]):
    """Runs (from, to) of sequences of about STEP bytes."""
    start, size = 0, 0
    for i, t in enumerate(sequences):
        size += len(t)
        if size >= STEP:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sequences):
        yield start, len(sequences)


_CODEC = pa.Codec("zstd", 3)


def _squeezed(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)


def _released(raw: bytes) -> bytes:
    return _CODEC.decompress(raw[8:], int.from_bytes(raw[:8], "little"), asbytes=True) if int.from_bytes(raw[:8], "little") else b""


def _packed(x: np.ndarray) -> bytes:
    """Sorted or small numbers as compressed differences."""
    return _squeezed(np.diff(x, prepend=0).tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(_released(raw), np.int64))


def _sums(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts summed by pair; every array is sorted."""
    pair, n = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(pair, kind="stable")  # merges sorted runs
    pair, n = pair[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])[:len(pair)])
    return pair[first], np.add.reduceat(n, first) if len(first) else n


def _counted(pair: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted, and how often each stands where ``mine``."""
    key = pair << 1 | mine
    key.sort()
    pair = key >> 1
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    return pair[first], np.add.reduceat(key & 1, first)


def _places(pair: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each asked pair among the sorted ones; asked in sorted runs, which find them sooner."""
    out, size = np.empty(len(asked), np.int64), 1 << 16
    for i in range(0, len(asked), size):
        part = asked[i:i + size].astype(np.uint64)
        key = part << np.uint64(16) | np.arange(len(part), dtype=np.uint64)  # a pair has 48 bits
        key.sort()
        out[i + (key & np.uint64(size - 1)).astype(np.int64)] = np.searchsorted(pair, (key >> np.uint64(16)).astype(np.int64))
    return out


def _tokens(raw: bytes) -> pa.Array:
    """The tokens of byte sequences that follow each other, each with the blank after it; the end mark is one of its own."""
    buf = np.frombuffer(raw, np.uint8)
    ends = np.flatnonzero((buf == 32) | (buf == END[0])) + 1
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(raw)])


class _Words:
    """Distinct tokens of some sequences in the order of their parts, and each token's number in it."""

    def __init__(self, sequences: list[bytes]):
        coded = _tokens(b"".join(sequences)).dictionary_encode()
        part = np.fromiter(map(zlib.crc32, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary)) % WORD_PARTS
        order = np.argsort(part, kind="stable")
        self.words, part = coded.dictionary.take(pa.array(order)), part[order]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.at = number[coded.indices.to_numpy()]
        self.parts, self.first = np.unique(part, return_index=True)
        self.end = np.append(self.first[1:], len(part))
        self.count = np.array([s.count(b" ") + s.endswith(END) for s in sequences], np.int64)  # tokens of each sequence


class _Block:
    def __init__(self):
        self.rows, self.before, self.sequences = [], [], []
        self.chars = 0

    def add(self, row: int, doc, held: bool, before: bytes, sequence: bytes, chars: int) -> None:
        self.rows.append((row, doc, held))
        self.before.append(before)
        self.sequences.append(sequence)
        self.chars += chars

    def pairs(self, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs with their training counts."""
        pair, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j in _steps(self.sequences):  # summed step by step: memory by distinct pairs, not by text
            texts = self.sequences[i:j]
            some, c = _counted(text_pairs(self.before[i:j], texts), np.repeat(mine[i:j], [len(t) for t in texts]))
            pair, n = _sums([pair, some], [n, c])
        return pair, n

    def batches(self, block: int):
        mine = np.array([not r[2] for r in self.rows])
        w = _Words(self.sequences)
        n = np.bincount(w.at[np.repeat(mine, w.count)], minlength=len(w.words))
        yield _batch([(block, p, _squeezed(b"".join(w.words[i:j].to_pylist())), None, _packed(n[i:j]), None)
                      for p, i, j in zip(w.parts.tolist(), w.first.tolist(), w.end.tolist())])
        del w, n
        pair, n = self.pairs(mine)
        home = _part(pair)
        yield _batch([(block, p, None, _packed(pair[home == p]), _packed(n[home == p]), None) for p in np.unique(home).tolist()])
        payload = _squeezed(pickle.dumps((self.rows, self.before, self.sequences)))
        yield _batch([(block, None, None, None, None, payload)])


def _part(pair: np.ndarray) -> np.ndarray:
    return (pair * 0x9E3779B97F4A7C1 >> 40) % PARTS


def _batch(rows, schema: str = READ):
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(f.split() for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], list(names))


def _read(batches):
    task = TaskContext.get().partitionId() << 24
    block, seq, row = _Block(), 0, 0
    for b in batches:
        for doc, held, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            parts, before = list(slices(text or "")), b" " * ORDER
            for k, part in enumerate(parts):
                words = words_of(part)
                sequence = (b" ".join(words) + b" " if words else b"") + (END if k == len(parts) - 1 else b"")
                if sequence:
                    block.add(task + row, doc, held, before, sequence, len(part))
                    before = (before + sequence)[-ORDER:]
                if block.chars >= BLOCK_CHARS:
                    yield from block.batches(task + seq)
                    block, seq = _Block(), seq + 1
            row += 1
    if block.rows:
        yield from block.batches(task + seq)


def _pairs_of_part(asked: pa.Table) -> pa.Table:
    """The distinct pairs of a part with their training counts, over all blocks."""
    pair, n = _sums(*([_unpacked(x) for x in asked.column(c).to_pylist()] for c in ("pairs", "counts")))
    return pa.table([asked.column("part").combine_chunks().take(pa.array(np.zeros(len(pair), np.int64))),
                     pa.array(pair), pa.array(n)], names=["part", "pair", "n"])


def _words_of_part(asked: pa.Table) -> pa.Table:
    """The training counts of each block's words of a part, over all blocks, and one row with their sum and number."""
    words = [_tokens(_released(x)) for x in asked.column("words").to_pylist()]
    coded = pa.concat_arrays(words).dictionary_encode()
    at = coded.indices.to_numpy()
    n = np.concatenate([_unpacked(x) for x in asked.column("counts").to_pylist()])
    c = np.bincount(at, n, len(coded.dictionary)).astype(np.int64)
    ends = np.cumsum([len(w) for w in words])
    part = asked.column("part")[0].as_py()
    rows = [(block, part, _packed(c[at[j - len(w):j]]), None, None)
            for block, w, j in zip(asked.column("block").to_pylist(), words, ends.tolist())]
    return pa.Table.from_batches([_batch([*rows, (None, part, None, int(c.sum()), int((c > 0).sum()))], COUNTED)])


def _answer_part(asked: pa.Table, costs: pa.Table) -> pa.Table:
    """The costs of each block's pairs of a part."""
    pair, cost = costs.column("pair").to_numpy(), costs.column("cost").to_numpy()
    order = np.argsort(pair)
    pair, cost = pair[order], cost[order]
    rows = [(block, None, raw, cost[np.searchsorted(pair, _unpacked(raw))].tobytes(), None)
            for block, raw in zip(asked.column("block").to_pylist(), asked.column("pairs").to_pylist())]
    return pa.Table.from_batches([_batch(rows, ANSWER)])


def _mask(order: int) -> Column:
    """Keeps ``order`` context bytes and the byte."""
    return F.lit((1 << (8 * (order + 1))) - 1)


def pair_costs(seen: DataFrame, asked: DataFrame) -> DataFrame:
    """(pair, cost): log10 probability of each asked pair under the counts (pair, n) of ``seen``."""
    follow = {ORDER: seen}
    for k in range(ORDER - 1, -1, -1):
        follow[k] = stored(follow[k + 1].groupBy(F.col("pair").bitwiseAND(_mask(k)).alias("pair"))
                           .agg(F.sum("n").alias("n")), f"trie-{k}")
    context = {k: t.groupBy(F.shiftright("pair", 8).alias("c")).agg(
        F.sum("n").alias("tot"), F.count(F.lit(1)).alias("q")) for k, t in follow.items()}

    top = asked.select("pair", F.shiftright("pair", 8).alias("c")).join(seen, "pair", "left").join(context[ORDER], "c", "left")
    hit, all_ = F.col("n").isNotNull(), F.col("tot") + F.col("q")
    top = stored(top.select("pair", hit.alias("done"), F.when(hit, F.log10(F.col("n") / all_)).otherwise(
        F.coalesce(F.log10(F.col("q") / all_), F.lit(0.0))).alias("cost")), "trie-top")
    open_ = top.where("not done")
    for k in range(ORDER - 1, -1, -1):
        longer, shorter = follow[k + 1], follow[k]
        # what the longer context has seen, counted in the shorter one
        taken = (longer.select("pair", F.col("pair").bitwiseAND(_mask(k)).alias("p"))
                 .join(shorter.select(F.col("pair").alias("p"), F.col("n").alias("m")), "p")
                 .groupBy(F.shiftright("pair", 8).alias("c1")).agg(F.sum("m").alias("taken"), F.count(F.lit(1)).alias("q1")))
        here = open_.select("*", F.shiftright("pair", 8).bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1)).alias("c1"),
                            F.shiftright("pair", 8).bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("c"),
                            F.col("pair").bitwiseAND(_mask(k)).alias("p"))
        here = (here.join(taken, "c1", "left").join(context[k], "c", "left")
                .join(shorter.select(F.col("pair").alias("p"), F.col("n").alias("m")), "p", "left"))
        q = F.coalesce("q", F.lit(0)) - F.coalesce("q1", F.lit(0))
        all_ = F.coalesce("tot", F.lit(0)) - F.coalesce("taken", F.lit(0)) + q
        step = F.when(F.col("done"), 0.0).when(F.col("m").isNotNull(), F.log10(F.col("m") / all_)).when(
            q > 0, F.log10(q / all_)).otherwise(0.0)
        open_ = here.select("pair", (F.col("done") | F.col("m").isNotNull()).alias("done"), (F.col("cost") + step).alias("cost"))
    used = follow[0].count()
    flat = F.when(F.col("done"), 0.0).otherwise(F.log10(F.lit(1.0 / max(1, 256 - used))))
    return top.where("done").select("pair", "cost").unionByName(open_.select("pair", (F.col("cost") + flat).alias("cost")))


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(total: int, distinct: int):
    def run(answers: pa.Table, blocks: pa.Table) -> pa.Table:
        rows, begin, sequences = pickle.loads(_released(blocks.column("payload").to_pylist()[0]))
        w = _Words(sequences)
        found = answers.filter(pc.is_valid(answers.column("counts"))).sort_by("part")
        counts = np.concatenate([_unpacked(x) for x in found.column("counts").to_pylist()])
        base = np.log10((counts + 1) / (total + distinct + 1))
        starts = np.cumsum(w.count) - w.count  # a sequence has a token at least
        base_score, n_known = np.add.reduceat(base[w.at], starts), np.add.reduceat((counts > 0).astype(np.int64)[w.at], starts)
        n_tokens = w.count
        del w
        found = answers.filter(pc.is_valid(answers.column("pairs")))
        pair = np.concatenate([_unpacked(x) for x in found.column("pairs").to_pylist()])
        cost = np.concatenate([np.frombuffer(x, np.float64) for x in found.column("costs").to_pylist()])
        order = np.argsort(pair)
        pair, cost = pair[order], cost[order]
        scores = []
        for i, j in _steps(sequences):
            size = np.array([len(t) for t in sequences[i:j]])
            scores.append(np.add.reduceat(cost[_places(pair, text_pairs(begin[i:j], sequences[i:j]))], np.cumsum(size) - size))
        return pa.table([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] for r in rows]), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()),
            pa.array(base_score, pa.float64()), pa.array(np.concatenate(scores))],
            names=[f.split()[0] for f in SCORED.split(", ")])

    return run


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    held = F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    read = stored(docs.select(F.col(doc_id).cast("long").alias("d"), held.alias("h"), F.col(text).alias("t"))
                  .mapInArrow(_read, READ), "lm-blocks")
    counted = stored(read.where("words is not null").select("block", "part", "words", "counts").groupBy("part")
                     .applyInArrow(_words_of_part, COUNTED), "lm-words")
    total, distinct = (int(x) for x in counted.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct")]).first())
    parts = read.where("pairs is not null").select("block", "part", "pairs", "counts")
    pairs = stored(parts.groupBy("part").applyInArrow(_pairs_of_part, "part int, pair long, n long"), "lm-pairs")
    costs = stored(pair_costs(pairs.where("n > 0").select("pair", "n"), pairs.select("pair"))
                   .join(pairs.select("part", "pair"), "pair"), "lm-costs")
    release(docs.sparkSession)
    coded = parts.groupBy("part").cogroup(costs.groupBy("part")).applyInArrow(_answer_part, ANSWER)
    answers = counted.where("counts is not null").select("block", "part", "counts").unionByName(coded, allowMissingColumns=True)
    blocks = read.where("payload is not null").select(F.col("block").alias("own"), "payload")
    parts = answers.groupBy("block").cogroup(blocks.groupBy("own")).applyInArrow(_score(total, distinct), SCORED)
    whole = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
                        "base_score", "score")
