"""Best-fit packing of documents into sequences under source and duplicate-cluster conflicts.

A document is cut into pieces of at most ``capacity`` words; a piece goes into the bin whose
residual is the smallest that holds it and that carries neither the piece's source nor its
duplicate cluster. Bins are kept by residual with the intersection of the source bitmaps of all
bins of a residual, so the successor search jumps over residuals where every bin has the source
already and goes on until the tightest compatible bin is found; else a new bin opens.
Pieces come largest first; ties by (doc_id, text hash, piece).

Documents are dealt into shards by a hash of their id and text, with about ``shard_docs`` documents each,
and a bin belongs to one shard; conflicts only concern one bin, so every shard is packed on its own and a
hot source or cluster is spread over all shards. The bitmap of a shard has one bit per source.

A null or empty text is one piece of zero words and can join any bin without a conflict. A null
source is a source of its own. Repeated rows have equal texts, so they share a cluster and never a bin.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.quality import text_words

CAPACITY = 2048
SHARD_DOCS = 10_000
PACKED = "shard int, bin int, doc_id long, piece int, start long, n_words int, place int, source string, cluster long"


class Bins:
    """Open bins of one shard."""

    def __init__(self, capacity: int, sources: int):
        self.capacity = capacity
        self.lanes = (sources + 63) // 64 or 1
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        self.common = np.full((self.lanes, capacity + 1), full)  # all sources where no bin is
        self.at = defaultdict(list)
        self.masks, self.clusters, self.used, self.filled = [], [], [], []

    def _refresh(self, residual: int) -> None:
        for lane in range(self.lanes):
            m = 0xFFFFFFFFFFFFFFFF
            for b in self.at[residual]:
                m &= self.masks[b] >> (64 * lane) & 0xFFFFFFFFFFFFFFFF
                if not m:
                    break
            self.common[lane, residual] = m

    def find(self, need: int, source: int, cluster: int) -> int | None:
        lane, bit = divmod(source, 64)
        free = np.flatnonzero((self.common[lane, need:] >> np.uint64(bit) & np.uint64(1)) == 0)
        for r in free:
            for b in self.at[need + int(r)]:
                if not self.masks[b] >> source & 1 and cluster not in self.clusters[b]:
                    return b
        return None

    def put(self, need: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, place in it)."""
        b = self.find(need, source, cluster)
        if b is None:
            b = len(self.used)
            self.masks.append(0), self.clusters.append(set()), self.used.append(0), self.filled.append(0)
        else:
            old = self.capacity - self.used[b]
            self.at[old].remove(b)
            self._refresh(old)
        place = self.filled[b]
        self.masks[b] |= 1 << source
        self.clusters[b].add(cluster)
        self.used[b] += need
        self.filled[b] += 1
        new = self.capacity - self.used[b]
        self.at[new].append(b)
        for lane in range(self.lanes):
            self.common[lane, new] &= np.uint64(self.masks[b] >> (64 * lane) & 0xFFFFFFFFFFFFFFFF)
        return b, place

    def put_empty(self) -> tuple[int, int]:
        if not self.used:
            self.masks.append(0), self.clusters.append(set()), self.used.append(0), self.filled.append(0)
            self.at[self.capacity].append(0)
            self.common[:, self.capacity] = 0
        self.filled[0] += 1
        return 0, self.filled[0] - 1


def _pack(capacity: int):
    """Rows sorted by shard: shard, doc_id, th, source, cluster, n."""
    def shard(rows):
        names = {s: i for i, s in enumerate(sorted({r[3] for r in rows}, key=lambda s: (s is not None, s or "")))}
        pieces = []
        for _, doc, th, source, cluster, n in rows:
            for start in range(0, max(n, 1), capacity):
                pieces.append((min(capacity, n - start), doc is not None, doc or 0, th, start, doc, source, cluster))
        pieces.sort(key=lambda p: (-p[0], *p[1:5]))
        bins, out = Bins(capacity, len(names)), []
        for n, _, _, _, start, doc, source, cluster in pieces:
            b, place = bins.put(n, names[source], cluster) if n else bins.put_empty()
            out.append((rows[0][0], b, doc, start // capacity, start, n, place, source, cluster))
        return out

    def batch(rows):
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64()]
        cols = list(zip(*rows)) or [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                          [x.split()[0] for x in PACKED.split(", ")])

    def run(batches):
        rows = []
        for b in batches:
            for r in zip(*(b.column(i).to_pylist() for i in range(6))):
                if rows and r[0] != rows[0][0]:
                    yield batch(shard(rows))
                    rows = []
                rows.append(r)
        if rows:
            yield batch(shard(rows))

    return run


def packed(docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: its bin (shard, bin), place in the bin, and the words it takes from the document.

    The duplicate cluster is the hash of the lower-cased text with single blanks.
    """
    words = text_words(F.coalesce(F.lower("text"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"),
                       F.col("source").cast("string").alias("source"), words.alias("w"))
    rows = rows.select("doc_id", "th", "source", F.xxhash64(F.array_join("w", " ")).alias("cluster"),
                       F.size("w").alias("n"))
    shards = max(1, -(-docs.count() // shard_docs))
    dealt = rows.select(F.pmod(F.xxhash64("doc_id", "th"), F.lit(shards)).cast("int").alias("shard"), "*")
    return (dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_pack(capacity), PACKED))
