"""Exact deduplication against an immutable snapshot, screened by binary fuse filters.

Texts are equal when identical after every run of ``[\\x20\\x09-\\x0D]`` is replaced by one space
(a null text counts as empty). Of equal texts the row with the smallest doc_id stays.

The work is split the way an ingest system meets it:

* the **snapshot** (rows with doc_id below a split point, or a given table) is reduced to one row
  per distinct text digest (keep id, count) and summarised by static binary fuse filters, one per
  hash shard of about ``SHARD_KEYS`` digests (3-wise, 8-bit fingerprints: 1.13 bytes a digest,
  false positives about 1/256);
* the **incoming batch** is reduced to one row per digest (partial aggregation first, so a text
  copied in a third of all rows costs one row per map task), and only its distinct digests are
  screened, shard by shard, against the filters;
* positives join the snapshot's exact buckets by digest and the two representative texts are
  compared byte by byte; negatives and false positives are new texts, grouped within the batch.

Since every snapshot doc_id is below every batch doc_id, a batch text found in the snapshot keeps
the snapshot's row. Rows with a null doc_id are never kept and never a keep_id; a group of null ids
only has keep_id null. Repeated rows with the smallest doc_id are all kept (they are one document).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicpulse.llm.common import stored

# Distinct digests per filter shard; a shard's filter is about 1.13 bytes a digest.
SHARD_KEYS = 1 << 20
# Digest tables (about 100 bytes a row) are broadcast up to this many rows (about 10 MB); larger ones
# are joined by shuffle, where adaptive execution splits the partition of a hot digest.
BROADCAST_DIGESTS = 100_000


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_DIGESTS else df
_SPACE = r"[\x20\x09-\x0D]+"
_M64 = (1 << 64) - 1


def normalised(text) -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), _SPACE, " ")


def digested(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_norm`` (normalised text), ``_sha`` (its SHA-256 hex) and ``_key`` (first 64 bits, signed)."""
    return (df.withColumn("_norm", normalised(text)).withColumn("_sha", F.sha2("_norm", 256))
            .withColumn("_key", F.conv(F.substring("_sha", 1, 16), 16, -10).cast("long")))


# --- binary fuse filter (Graf and Lemire, 2022), 3-wise, 8-bit fingerprints --------------------

def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser of key + seed (splitmix64), as uint64."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64(seed)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def _layout(n: int) -> tuple[int, int]:
    """(segment length, segment count) for n keys."""
    seg = 1 << max(1, min(18, int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    count = max(1, math.ceil(n * factor / seg) - 2)
    return seg, count


def _slots(h: np.ndarray, seg: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    span = np.uint64(seg * count)
    hi = ((h >> np.uint64(32)) * span) >> np.uint64(32)  # first slot, uniform over the first `count` segments
    mask = np.uint64(seg - 1)
    h0 = hi
    h1 = (hi + np.uint64(seg)) ^ ((h >> np.uint64(18)) & mask)
    h2 = (hi + np.uint64(2 * seg)) ^ (h & mask)
    return h0.astype(np.int64), h1.astype(np.int64), h2.astype(np.int64)


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, fingerprints) of a filter over distinct int64 keys.

    Peeling runs in rounds: every slot touched by one remaining key frees that key; keys freed in
    one round are independent, so they are assigned together, in the reverse order of rounds.
    """
    keys = np.unique(keys.astype(np.int64))
    seg, count = _layout(len(keys))
    size = seg * (count + 2)
    for seed in range(1, 1000):
        h = _mix(keys.view(np.uint64), seed * 0x9E3779B97F4A7C15 & _M64)
        s = np.stack(_slots(h, seg, count))
        degree = np.zeros(size, np.int64)
        xor = np.zeros(size, np.int64)
        idx = np.arange(len(keys), dtype=np.int64)
        for r in range(3):
            np.add.at(degree, s[r], 1)
            np.bitwise_xor.at(xor, s[r], idx)
        alive = np.ones(len(keys), bool)
        order: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            single = np.flatnonzero(degree == 1)
            if not len(single):
                break
            who = xor[single]
            who, first = np.unique(who, return_index=True)
            at = single[first]
            who, at = who[alive[who]], at[alive[who]]
            if not len(who):
                break
            alive[who] = False
            order.append((who, at))
            for r in range(3):
                np.add.at(degree, s[r, who], -1)
                np.bitwise_xor.at(xor, s[r, who], who)
        if alive.any():
            continue
        fp = np.zeros(size, np.uint8)
        mine = _fingerprint(h)
        for who, at in reversed(order):
            val = mine[who] ^ fp[s[0, who]] ^ fp[s[1, who]] ^ fp[s[2, who]]
            fp[at] = val ^ fp[at]  # fp[at] is still 0: its own slot is not yet assigned
        return seed, seg, count, fp.tobytes()
    raise RuntimeError("no seed gave a peelable binary fuse filter")


def probe(keys: np.ndarray, seed: int, seg: int, count: int, fingerprints: bytes) -> np.ndarray:
    """True where a key may be in the filter; always true for its keys."""
    if not len(keys):
        return np.zeros(0, bool)
    fp = np.frombuffer(fingerprints, np.uint8)
    h = _mix(keys.astype(np.int64).view(np.uint64), seed * 0x9E3779B97F4A7C15 & _M64)
    h0, h1, h2 = _slots(h, seg, count)
    return (fp[h0] ^ fp[h1] ^ fp[h2]) == _fingerprint(h)


_FILTER = T.StructType([T.StructField("_shard", T.IntegerType()), T.StructField("seed", T.IntegerType()),
                        T.StructField("seg", T.IntegerType()), T.StructField("count", T.IntegerType()),
                        T.StructField("fp", T.BinaryType())])


def filters(digests: DataFrame, shards: int) -> DataFrame:
    """One binary fuse filter per shard of the distinct ``_key`` of ``digests`` (column ``_shard``)."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, seg, count, fp = build_filter(pdf["_key"].to_numpy())
        return pd.DataFrame({"_shard": [int(pdf["_shard"].iloc[0])], "seed": [seed], "seg": [seg],
                             "count": [count], "fp": [fp]})
    return digests.select("_shard", "_key").groupBy("_shard").applyInPandas(build, _FILTER)


def _screened(batch: DataFrame, flt: DataFrame) -> DataFrame:
    """The rows of ``batch`` (one per digest) with ``_maybe``: the digest passed its shard's filter."""
    out = T.StructType([T.StructField("_sha", T.StringType()), T.StructField("_maybe", T.BooleanType())])

    def screen(mine: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        sha = mine["_sha"].astype(str).to_numpy()
        if not len(f) or not len(mine):
            return pd.DataFrame({"_sha": sha, "_maybe": np.zeros(len(sha), bool)})
        row = f.iloc[0]
        hit = probe(mine["_key"].to_numpy(), int(row["seed"]), int(row["seg"]), int(row["count"]), bytes(row["fp"]))
        return pd.DataFrame({"_sha": sha, "_maybe": hit})
    return batch.select("_shard", "_sha", "_key").groupBy("_shard").cogroup(flt.groupBy("_shard")).applyInPandas(
        screen, out)


def _groups(df: DataFrame) -> DataFrame:
    """One row per (digest, normalised text) with the smallest doc_id and the count."""
    return df.groupBy("_sha", "_key").agg(F.min("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))


def groups(snapshot: DataFrame, batch: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(_sha, keep_id, group_size) over snapshot and batch; both carry doc_id, _norm, _sha, _key.

    Snapshot doc_ids must all be below batch doc_ids.
    """
    snap = stored(_groups(snapshot), "exact-snapshot")
    new = stored(_groups(batch), "exact-batch")
    n_snap, n_new = snap.count(), new.count()
    shards = max(1, math.ceil(max(n_snap, n_new) / shard_keys))
    shard = F.pmod(F.col("_key"), F.lit(shards)).cast("int")
    flt = filters(snap.withColumn("_shard", shard), shards)
    screened = _screened(new.withColumn("_shard", shard), flt)
    maybe = stored(screened.where("_maybe").select("_sha"), "exact-positives")
    n_maybe = maybe.count()
    # Byte check of the positives: one text of each side (partial aggregation keeps one a task).
    def one_text(side: DataFrame, name: str) -> DataFrame:
        return side.join(_small(maybe, n_maybe), "_sha").groupBy("_sha").agg(F.first("_norm").alias(name))
    checked = (maybe.join(snap.select("_sha", F.col("_keep").alias("_s_keep"), F.col("_n").alias("_s_n")), "_sha")
               .join(one_text(snapshot, "_s_t"), "_sha").join(one_text(batch, "_b_t"), "_sha")
               .where(F.col("_s_t") == F.col("_b_t")).select("_sha", "_s_keep", "_s_n"))
    checked = stored(checked, "exact-checked")
    merged = (new.join(_small(checked, n_maybe), "_sha", "left")
              .select("_sha", F.coalesce("_s_keep", "_keep").alias("keep_id"),
                      (F.col("_n") + F.coalesce("_s_n", F.lit(0))).alias("group_size")))
    old = snap.join(checked.select("_sha", F.lit(True).alias("_seen")), "_sha", "left_anti")
    return old.select("_sha", F.col("_keep").alias("keep_id"), F.col("_n").alias("group_size")).unionByName(merged)


def exact_duplicates(docs: DataFrame, snapshot_fraction: float = 0.5, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, plus its other columns.

    The rows with doc_id at or below the ``snapshot_fraction`` quantile form the snapshot; the others
    are the incoming batch (null ids go with the batch). Every row is read and classified.
    """
    d = digested(docs.select(*[F.col(c) for c in docs.columns if c not in ("_norm", "_sha", "_key")]))
    split = d.approxQuantile("doc_id", [snapshot_fraction], 0.001) if snapshot_fraction > 0 else []
    cut = split[0] if split and split[0] is not None and not math.isnan(split[0]) else None
    if cut is None:
        is_snap = F.lit(False)
    else:
        is_snap = F.coalesce(F.col("doc_id") <= F.lit(cut), F.lit(False))
    g = groups(d.where(is_snap), d.where(~is_snap), shard_keys)
    n_groups = g.count()
    g = stored(g, "exact-groups")
    out = d.join(_small(g, n_groups), "_sha")
    return (out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)))
            .withColumn("text_sha256", F.col("_sha")).drop("_norm", "_sha", "_key"))
