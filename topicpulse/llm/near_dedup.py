"""SimHash near-duplicates with pivot distance tables.

Fingerprints: 4-word shingles hashed by XXH64 (seed 42); a bit is set when over half of the hashes
have it. Distinct fingerprints are dealt into cells by two of ``radius + 2`` bit blocks (two blocks at least
are equal within the radius), so every pair within the radius meets. In a cell a table of Hamming
distances to ``PIVOTS`` fixed reference fingerprints discards pairs whose largest coordinate difference
exceeds the radius (triangle inequality); survivors are verified and only links that join two
groups leave the cell. Groups are the connected components over all links.

A null or wordless text has fingerprint 0 and is linked like any other. Texts of fewer words than a
shingle are one shingle. Equal fingerprints are one node, however many rows have them. Rows
without doc_id have no id to offer and get their group's smallest, null if it has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import Forest, cells, components, hex64, release, slices, stored, words_of

RADIUS = 4
SHINGLE = 4
SEED = 42
PIVOTS = 12
CELL_ROWS = 4096


def shingle_hashes(text: str, size: int) -> Iterator[np.ndarray]:
    """XXH64 of every shingle, in blocks."""
    carry: list[bytes] = []
    digest, some = xxhash.xxh64_intdigest, False
    for part in slices(text):
        words = carry + words_of(part)
        n = len(words) - size + 1
        if n > 0:
            some = True
            joined = b" ".join(words)
            ends = list(accumulate(len(w) + 1 for w in words))
            starts = [0, *ends[:n - 1]]
            yield np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:])),
                              np.uint64, n)
        carry = words[max(0, len(words) - size + 1):]
    if not some and carry:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def simhash(text: str, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number."""
    votes, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, size):
        for i in range(0, len(h), 1 << 16):
            part = h[i:i + (1 << 16)]
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                0, dtype=np.int64)
            n += len(part)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp)."""
    def run(batches):
        for b in batches:
            prints = [simhash(t or "", size) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, fp long")


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of radius + 2 blocks."""
    cuts = [64 * i // (radius + 2) for i in range(radius + 3)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def pivots(count: int = PIVOTS) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED) for i in range(count)], np.uint64)


def linked(cell: np.ndarray, fp: np.ndarray, radius: int, same: Callable[[int, int], bool] | None = None,
           counts: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (pairs of row numbers) that join two groups, over rows with cells together.

    A pair within the radius is a link when ``same`` says so too, if given. With ``counts`` the radius only
    tells which pairs are asked first: of the others all that ``possible`` leaves are asked too.
    """
    x, ref = fp.view(np.uint64), pivots()
    table = np.stack([np.bitwise_count(x ^ p) for p in ref], axis=1).astype(np.int8)
    order = np.lexsort((table[:, 0], cell))
    cell, x, table = cell[order], x[order], table[order]
    sets, label, out = Forest(len(x)), np.arange(len(x)), []
    at = np.arange(len(x))
    for lag in range(1, len(x)):
        at = at[at + lag < len(x)]
        # sorted by the first coordinate within a cell: once too far, farther lags are too
        at = at[(cell[at] == cell[at + lag]) & (table[at + lag, 0] - table[at, 0] <= radius)]
        if not len(at):
            break
        near = at[label[at] != label[at + lag]]
        near = near[np.abs(table[near] - table[near + lag]).max(axis=1, initial=0) <= radius]
        near = near[np.bitwise_count(x[near] ^ x[near + lag]) <= radius]
        joined = len(out)
        for i in near.tolist():
            if sets.find(i) == sets.find(i + lag):
                continue
            pair = int(order[i]), int(order[i + lag])
            if same is None or same(*pair):
                sets.union(i, i + lag)
                out.append(pair)
        if len(out) > joined:
            label = np.fromiter((sets.find(i) for i in range(len(x))), np.int64, len(x))
    if counts is not None and same is not None:
        out += _linked_apart(cell, x, radius, counts[order], sets, lambda i, j: same(int(order[i]), int(order[j])), order)
    return out


def possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Can sets with these counts per part of all hashes have a Jaccard similarity of ``SIMILARITY``? Never a false no.

    The counts differ by no more than the sets do, and sets of n and m members with that similarity differ by (n + m) / 9.
    """
    size = a.sum(axis=1) + b.sum(axis=1)
    return (np.abs(a - b).sum(axis=1) * 9 <= size) | (a[:, 0] < 0) | (b[:, 0] < 0)


def _linked_apart(cell: np.ndarray, x: np.ndarray, radius: int, counts: np.ndarray, sets: Forest,
                  same: Callable[[int, int], bool], order: np.ndarray) -> list[tuple[int, int]]:
    """Links among the pairs beyond the radius, which ``linked`` has not asked."""
    size = np.where(counts[:, 0] < 0, 1 << 40, counts.sum(axis=1))  # uncounted sets are last in their cell
    by = np.lexsort((size, cell))
    cell, x, size, counts = cell[by], x[by], size[by], counts[by]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(cell)]]) - 1
    open_ = np.repeat(counts[last, 0] < 0, last - first + 1)
    roots = lambda: np.fromiter((sets.find(i) for i in by.tolist()), np.int64, len(by))
    label, at, out = roots(), np.arange(len(by)), []
    for lag in range(1, len(by)):
        at = at[at + lag < len(by)]
        # sorted by size within a cell: once four fifths are too few, they are for farther lags
        at = at[(cell[at] == cell[at + lag]) & (open_[at] | (5 * size[at] >= 4 * size[at + lag]))]
        if not len(at):
            break
        near = at[(label[at] != label[at + lag]) & (np.bitwise_count(x[at] ^ x[at + lag]) > radius)]
        near = near[possible(counts[near], counts[near + lag])]
        joined = len(out)
        for i, j in zip(by[near].tolist(), by[near + lag].tolist()):
            if sets.find(i) != sets.find(j) and same(i, j):
                sets.union(i, j)
                out.append((int(order[i]), int(order[j])))
        if len(out) > joined:
            label = roots()
    return out


def _search(radius: int, verdict: Callable[[bytes, bytes], bool | None] | None = None):
    """Over rows sorted by cell: cell, node (the fingerprint), or cell, node, fingerprint, what ``verdict`` compares, counts.

    With a verdict, rows of pairs it leaves open (None) come out as (cell, node, null), links as (null, a, b).
    """
    def run(batches):
        def done(cols):
            node, fp, open_ = cols[1], cols[2 if verdict else 1], set()

            def same(i: int, j: int) -> bool:
                said = verdict(cols[3][i], cols[3][j])
                if said is None:
                    open_.update((i, j))
                return bool(said)

            pairs = linked(np.unique(cols[0], return_inverse=True)[1], fp, radius, same if verdict else None,
                           np.stack(cols[4]).astype(np.int64) if verdict else None)
            a, b = ([int(node[p[k]]) for p in pairs] for k in (0, 1))
            if not verdict:
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            left = sorted(open_)
            return pa.RecordBatch.from_arrays(
                [pa.array([None] * len(a) + [cols[0][i] for i in left], pa.string()),
                 pa.array(a + [int(node[i]) for i in left], pa.int64()), pa.array(b + [None] * len(left), pa.int64())],
                ["cell", "a", "b"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            held = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            cut = int(np.argmax(held[0] == held[0][-1]))  # the last cell may go on in the next batch
            if cut:
                yield done([x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None:
            yield done(held)

    return run


def links(nodes: DataFrame, radius: int = RADIUS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all groups within ``radius``."""
    parts = [F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1)) for first, bits in _blocks(radius)]
    width = max(bits for _, bits in _blocks(radius))
    keys = [F.lit(t << (2 * width)) + F.shiftleft(parts[i], width) + parts[j]
            for t, (i, j) in enumerate(combinations(range(radius + 2), 2))]
    rows = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    dealt = cells(rows, "key", "fp", cell_rows).select("cell", "fp")
    return (dealt.repartition("cell").sortWithinPartitions("cell")
            .mapInArrow(_search(radius), "a long, b long"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints = stored(fingerprints(docs, doc_id, text, size), "simhash")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-nodes")
    edges = stored(links(nodes, radius), "simhash-links")
    release(docs.sparkSession)
    group = components(edges, "a", "b")
    member = nodes.join(group, nodes["fp"] == group["node"], "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    of = stored(member.join(lowest, "root").select("fp", "component_id"), "simhash-groups")
    return prints.join(of, "fp").select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


# The stage. On 64 bits no radius parts a similarity of 0.8 from less: texts that alike differ in about 10 bits
# and, where a passage repeats in one of them, in any number. Here the cells come from MinHash
# bands (a pair of similarity 0.8 meets with probability 1 - (1 - 0.8^5)^16 > 0.998), the pivot
# tables find the pairs within STAGE_RADIUS bits, which are asked first, and of the others those are asked that the
# sizes of the sets and their counts in PIVOTS parts of all hashes allow, bounds that hold for every pair.
# Pairs are verified by the Jaccard similarity of their shingles:
# on sketches where these are whole sets or leave no doubt, else on the whole sets.
STAGE_SHINGLE = 5
STAGE_RADIUS = 20
SIMILARITY = 0.8
BANDS, ROWS = 16, 5
SKETCH = 512
# Of 512 draws at a similarity of 0.8 a share under the first or from the second on has a probability below 1e-13.
SURE = 0.65, 0.93
STAGE_CELL_ROWS = 2048
# Texts with more distinct shingles are not counted by parts, so nothing is concluded from their counts.
COUNTED = 1 << 22
_BLOCK = 1024


def _multipliers() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"band {i}".encode(), SEED) | 1 for i in range(BANDS * ROWS)], np.uint64)


def signature(text: str, size: int = STAGE_SHINGLE) -> tuple[int, list[int], bytes, list[int]]:
    """(fingerprint, band keys, sketch, counts) of the distinct shingles, in one pass and bounded memory.

    The sketch holds the ``SKETCH`` smallest 32-bit shingle hashes: the whole set where it has no more. A text
    without words has no band keys. ``counts``: distinct shingles by the remainder of their hash, -1 if not counted.
    """
    votes, n = np.zeros(64, np.int64), 0
    factors = _multipliers()
    least, low = np.full(len(factors), 2 ** 64 - 1, np.uint64), np.array([], np.uint32)
    all_, late, counted = np.array([], np.uint64), [], True
    for h in shingle_hashes(text, size):
        for i in range(0, len(h), 1 << 16):
            part = h[i:i + (1 << 16)]
            votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
                0, dtype=np.int64)
            n += len(part)
            own = np.unique(part)
            low = np.unique(np.concatenate([low, (own >> np.uint64(32)).astype(np.uint32)]))[:SKETCH]
            if counted:
                late.append(own)
                if sum(map(len, late)) >= max(len(all_), 1 << 16):  # united at doubled sizes
                    all_, late = np.unique(np.concatenate([all_, *late])), []
                    counted = len(all_) <= COUNTED
            for k in range(0, len(own), _BLOCK):
                least = np.minimum(least, (factors[:, None] * own[None, k:k + _BLOCK]).min(axis=1))
    fp = int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])
    bands = least.reshape(BANDS, ROWS)
    keys = [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(bands)] if n else []
    counts = [-1] * PIVOTS
    if counted:
        all_ = np.unique(np.concatenate([all_, *late])) if late else all_
        counts = np.bincount((all_ % np.uint64(PIVOTS)).astype(np.int64), minlength=PIVOTS).tolist()
    return fp, keys, low.tobytes(), counts


def jaccard(a: bytes, b: bytes) -> float:
    """Exact for two sketches that are whole sets, else estimated on the ``SKETCH`` smallest of the union."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    both = np.concatenate([x, y])
    both.sort()
    twice = both[1:] == both[:-1]
    total = len(both) - int(twice.sum())
    if not total:
        return 1.0
    if max(len(x), len(y)) < SKETCH or total <= SKETCH:
        return int(twice.sum()) / total
    last = both[np.flatnonzero(np.concatenate([[True], ~twice]))[SKETCH - 1]]
    return int((twice & (both[1:] <= last)).sum()) / SKETCH


def alike(a: bytes, b: bytes) -> bool:
    return jaccard(a, b) >= SIMILARITY


def verdict(a: bytes, b: bytes) -> bool | None:
    """Whether two sketches' texts are similar; None if that takes their whole sets."""
    j = jaccard(a, b)
    full = [len(x) // 4 >= SKETCH for x in (a, b)]
    if not any(full):
        return j >= SIMILARITY
    return False if j < SURE[0] else True if all(full) and j >= SURE[1] else None


def whole_set(text: str, size: int = STAGE_SHINGLE) -> bytes:
    """All distinct shingle hashes, sorted."""
    found = [np.unique(h) for h in shingle_hashes(text, size)]
    return np.unique(np.concatenate(found)).tobytes() if found else b""


def alike_sets(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILARITY * (len(x) + len(y) - both)


def _sets(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([whole_set(t or "") for t in b.column(1).to_pylist()], pa.binary())], ["node", "shingles"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, th, fp, keys, sketch, counts, node); texts with equal signatures are one node."""
    def run(batches):
        for b in batches:
            found = [signature(t or "") for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x[0] for x in found], pa.int64()),
                 pa.array([x[1] for x in found], pa.list_(pa.int64())), pa.array([x[2] for x in found], pa.binary()),
                 pa.array([x[3] for x in found], pa.list_(pa.int64()))],
                ["doc_id", "th", "fp", "keys", "sketch", "counts"])

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       F.col("text").alias("t")).mapInArrow(
                           run, "doc_id long, th long, fp long, keys array<long>, sketch binary, counts array<long>")
    return made.withColumn("node", F.xxhash64("fp", "keys", "sketch", "counts"))


def _settled(docs: DataFrame, nodes: DataFrame, open_: DataFrame) -> DataFrame:
    """(a, b): links among the nodes (cell, node) that sketches left open, by their whole shingle sets."""
    asked = (nodes.join(open_.select("node").distinct(), "node")
             .select("node", F.col("at.doc_id").alias("_id"), F.col("at.th").alias("_th")))
    texts = docs.select(F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_h"), F.col("text").alias("t"))
    texts = texts.join(asked, (F.col("_h") == F.col("_th")) & F.col("_d").eqNullSafe(F.col("_id"))).select("node", "t")
    sets = stored(texts.mapInArrow(_sets, "node long, shingles binary"), "near-sets")
    release(docs.sparkSession)
    sets = sets.groupBy("node").agg(F.first("shingles").alias("shingles"))  # rows repeated under one doc_id
    met = open_.join(nodes.select("node", "fp", "counts"), "node").join(sets, "node").select(
        "cell", "node", "fp", "shingles", "counts")
    return stored(met.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        _search(STAGE_RADIUS, alike_sets), "cell string, a long, b long").select("a", "b"), "near-exact")


def similar(docs: DataFrame, cell_rows: int = STAGE_CELL_ROWS) -> DataFrame:
    """(doc_id, component_id): groups of rows linked by a shingle similarity of 0.8 or more."""
    prints = stored(signatures(docs), "near-prints")
    nodes = stored(prints.groupBy("node").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "th")).alias("at"), F.first("fp").alias("fp"), F.first("keys").alias("keys"),
        F.first("sketch").alias("sketch"), F.first("counts").alias("counts")), "near-nodes")
    release(docs.sparkSession)
    # Sketches join only the rows of keys that two nodes share.
    dealt = cells(nodes.select("node", F.explode("keys").alias("key")), "key", "node", cell_rows).select("cell", "node")
    met = dealt.join(nodes.select("node", "fp", "sketch", "counts"), "node").select("cell", "node", "fp", "sketch", "counts")
    found = stored(met.repartition("cell").sortWithinPartitions("cell")
                   .mapInArrow(_search(STAGE_RADIUS, verdict), "cell string, a long, b long"), "near-links")
    release(docs.sparkSession)
    exact = _settled(docs, nodes, found.where("b is null").select("cell", F.col("a").alias("node")))
    edges = found.where("b is not null").select("a", "b").unionByName(exact)
    release(docs.sparkSession)
    group = components(edges, "a", "b")
    member = nodes.join(group, "node", "left").select("node", "low", F.coalesce("component", "node").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    of = stored(member.join(lowest, "root").select("node", "component_id"), "near-groups")
    return prints.select("doc_id", "node").join(of, "node").select("doc_id", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those of a group whose doc_id is not its smallest.

    Texts without words are one group. Rows repeated under one doc_id stand or fall together; rows without doc_id stay.
    """
    found = similar(docs)
    gone = stored(found.where("doc_id > component_id").select(F.col("doc_id").alias("_gone")).distinct(), "near-gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
