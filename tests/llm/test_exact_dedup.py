"""Exact deduplication: filters without false negatives, groups equal to a plain grouping, odd rows."""

import hashlib
import random
import re

import numpy as np

from topicpulse.llm import exact_dedup

SCHEMA = "doc_id long, text string, _sha string"


def plain(rows):
    """Sorted (doc_id, keep_id, group_size, kept, sha) by grouping normalised texts."""
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def test_filter_has_no_false_negatives_and_few_positives():
    rnd = np.random.default_rng(3)
    for n in (1, 2, 7, 1000, 50_000):
        keys = rnd.integers(-2**63, 2**63 - 1, n, dtype=np.int64)
        seed, seg, count, fp = exact_dedup.build_filter(keys)
        assert exact_dedup.probe(keys, seed, seg, count, fp).all()
        assert len(fp) <= 1.4 * n + 3 * seg
        other = rnd.integers(-2**63, 2**63 - 1, 200_000, dtype=np.int64)
        assert exact_dedup.probe(other, seed, seg, count, fp).mean() < 0.01


def test_groups_equal_plain_grouping(spark):
    rnd = random.Random(8)
    base = ["a b c", "a  b\tc", "x\ny", "", None, " ", "long " * 5000, "é ß  日本"] + [f"t{k} u" for k in range(30)]
    rows = [(i, rnd.choice(base)) for i in range(300)] + [(None, "a b c"), (None, "only null"), (None, "only null")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_sha", exact_dedup.F.lit("clash"))
    want = plain(rows)
    for frac, shard_keys in ((0.5, 1 << 20), (0.3, 4), (0.0, 1 << 20), (1.0, 2)):
        got = exact_dedup.exact_duplicates(df, frac, shard_keys).collect()
        assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=str) == want


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(empty).count() == 0
    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b")]
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in
                 exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False), (3, 3, 1, True)]
