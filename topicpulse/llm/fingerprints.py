"""Document fingerprints by SimHash, and search within a Hamming radius by permuted block tables.

Terms are words and pairs of neighbouring words, lower-cased; a term that occurs f times votes with
weight 1 + ln f on each of 64 bits, by the signs of its hash's bits. Ties give a 0 bit.

Search: the 64 bits are cut into ``BLOCKS`` blocks. Within ``RADIUS`` differing bits at least BLOCKS - RADIUS
blocks agree, so every choice of that many blocks is a table keyed by their bits; query and
document meet in at least one table and are then verified by their exact distance.

A null or wordless text has no votes and fingerprint 0. Equal texts have equal fingerprints.
The edited text of a document needs the next one in descending doc_id (then by text hash); rows
without doc_id come last, rows repeated in full are ordered arbitrarily among themselves, being equal.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import hex64, slices, stored, words_of
from topicpulse.llm.substring_dedup import mix, word_hashes

BLOCKS, RADIUS = 5, 3
ROWS_PER_RANGE = 4000
_CHUNK = 1 << 15


def _votes(terms: np.ndarray) -> np.ndarray:
    value, count = np.unique(terms, return_counts=True)
    votes = np.zeros(64)
    for i in range(0, len(value), _CHUNK):
        bits = np.unpackbits(value[i:i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        weight = 1.0 + np.log(count[i:i + _CHUNK])
        votes += 2.0 * (weight @ bits) - weight.sum()
    return votes


def fingerprint(text: str, memo: dict) -> int:
    """The fingerprint as a signed 64-bit number."""
    parts = [word_hashes(words_of(p), memo) for p in slices(text)]
    words = np.concatenate(parts)
    pairs = mix(mix(words[:-1]) + words[1:])
    votes = _votes(np.concatenate([mix(words), pairs]))
    # sums of logarithms differ in the last digits by order only, and the order is sorted
    return int(np.packbits(votes > 1e-9, bitorder="little").view(np.int64)[0])


def distance(a: int, b: int) -> int:
    return ((a ^ b) & 0xFFFFFFFFFFFFFFFF).bit_count()


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp)."""
    def run(batches):
        memo: dict = {}
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([fingerprint(t or "", memo) for t in b.column(1).to_pylist()], pa.int64())],
                ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, "doc_id long, fp long")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fp, distance): for each distinct query fingerprint all distinct ones within ``radius``."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    part = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])]
    width = max(b - a for a, b in zip(cuts, cuts[1:]))
    tables = list(combinations(range(blocks), blocks - radius))

    def keyed(df: DataFrame, name: str) -> DataFrame:
        keys = []
        for t, chosen in enumerate(tables):
            key = F.lit(t).cast("long")
            for c in chosen:
                key = F.shiftleft(key, width) + part[c]
            keys.append(key)
        return df.select("fp").distinct().select(F.col("fp").alias(name), F.explode(F.array(*keys)).alias("key"))

    met = keyed(queries, "query").join(keyed(prints, "fp"), "key")
    far = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    return met.where(far <= radius).select("query", "fp", far.cast("int").alias("distance")).distinct()


def with_next(docs: DataFrame, doc_id: str, text: str, rows_per_range: int):
    """Rows in ranges of doc_id, each range ending with a copy of the row that follows it (guest).

    Only the borders of the ranges and one doc_id for each go to the driver; their number is the row
    count over ``rows_per_range``. The last range is followed by the first row of all.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t"))
    total, low_, high_ = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    count = max(1, -(-total // rows_per_range))
    cuts = []
    if low_ is not None:
        shares = [i / count for i in range(1, count)]
        cuts = sorted(set(rows.agg(F.percentile_approx("doc_id", shares, 100 * count)).first()[0])) if shares else []
    # range i holds ids above cuts[i - 1] and up to cuts[i]
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("doc_id"))) if cuts else F.lit(0))
    placed = rows.select(place.cast("int").alias("range"), "doc_id", F.xxhash64("t").alias("h"), "t")
    tops = {r["range"]: (r["m"]["doc_id"], r["m"]["h"]) for r in placed.groupBy("range").agg(
        F.max(F.struct("doc_id", "h")).alias("m")).collect()}
    filled = sorted(tops)
    guest_of = {r: filled[(i + 1) % len(filled)] for i, r in enumerate(filled)}  # the range above ends with it
    host = F.lit(None).cast("int")
    for r, (i, h) in tops.items():
        mine = (F.col("range") == r) & F.col("doc_id").eqNullSafe(F.lit(i)) & (F.col("h") == h)
        host = F.when(mine, guest_of[r]).otherwise(host)
    if len(filled) > 64:  # a lookup table instead of a long expression
        spark = docs.sparkSession
        table = F.broadcast(spark.createDataFrame(
            [(r, i, h, guest_of[r]) for r, (i, h) in tops.items()], "r int, i long, th long, host int"))
        placed = placed.join(table, (F.col("range") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("i"))
                             & (F.col("h") == F.col("th")), "left").drop("r", "i", "th")
    else:
        placed = placed.withColumn("host", host)
    both = F.array(F.struct(F.col("range").alias("at"), F.lit(False).alias("guest")),
                   F.struct(F.col("host").alias("at"), F.lit(True).alias("guest")))
    dealt = placed.select("doc_id", "h", "t", F.explode(F.filter(both, lambda x: x["at"].isNotNull())).alias("x"))
    return (dealt.select("x.at", "x.guest", "doc_id", "h", "t").repartition(max(count, 1), "at")
            .sortWithinPartitions("at", "guest", F.col("doc_id").desc_nulls_last(), F.col("h").desc()))


FIELDS = ("doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long")


def _edit(batches):
    """Rows come as (at, guest, doc_id, h, t), sorted; a row's successor in its range is the next document."""
    memo: dict = {}
    held = None
    for b in batches:
        out = []
        for row in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
            at, guest, doc, t = row[0], row[1], row[2], row[3] or ""
            if held is not None and held[0] == at:
                out.append(_edited(held[1], held[2], held[3], t, own := fingerprint(t, memo), memo))
                held = None if guest else (at, doc, t, own)
            elif not guest:
                held = (at, doc, t, fingerprint(t, memo))
        cols = list(zip(*out)) or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, y) for c, y in zip(cols, types)],
                                         [f.split()[0] for f in FIELDS.split(", ")])


def _edited(doc, text, fp, after, after_fp, memo):
    half = len(text) // 2
    new = text[:len(text) - half] + after[:half]
    return (doc, len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), fp,
            fingerprint(new, memo), after_fp)


def document_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Fingerprints of every text and of its edited text, likeness of both and of the next document.

    ``n_near`` counts the other documents within ``RADIUS`` bits, for every doc_id divisible by 100.
    """
    found = stored(with_next(docs, doc_id, text, rows_per_range).mapInArrow(_edit, FIELDS), "fingerprints")
    likeness = lambda c: 1 - F.bit_count(F.col("fp").bitwiseXOR(F.col(c))) / 64
    asked = found.where("doc_id % 100 = 0")
    copies = found.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    near = (within_radius(asked, found).join(copies, "fp").groupBy("query").agg((F.sum("n") - 1).alias("n_near")))
    return found.join(near, found["fp"] == near["query"], "left").select(
        "doc_id", "n_chars", "edited_sha256", hex64(F.col("fp")).alias("fingerprint"),
        hex64(F.col("edited_fp")).alias("edited_fingerprint"), likeness("edited_fp").alias("near_edited"),
        likeness("next_fp").alias("near_next"), F.when(F.col("doc_id") % 100 == 0, F.col("n_near")).alias("n_near"))
