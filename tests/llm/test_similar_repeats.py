"""Equal or alike sets of shingles whose SimHash fingerprints lie far apart."""

import os
import random
import sys

import numpy as np

from topicpulse.llm import near_dedup

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402


def _pairs(n, size=300):
    rnd, texts = random.Random(7), []
    for k in range(n):
        words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(size)]
        phrase = [f"p{rnd.randrange(10 ** 6)}" for _ in range(14)]
        for times in (2, 60):  # the same shingles, other votes
            texts.append(" ".join(words[:150] + phrase * times + words[150:]))
    return texts


def test_equal_sets_far_beyond_the_radius_are_found(spark):
    texts = _pairs(6) + ["lone " + " ".join(f"x{i}" for i in range(200))]
    fps = [near_dedup.signature(t)[0] for t in texts]
    far = [(a ^ b) & (2 ** 64 - 1) for a, b in zip(fps[::2], fps[1::2])]
    assert any(d.bit_count() > near_dedup.STAGE_RADIUS for d in far)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.similar(table).collect()}
    assert got == brute.similar(list(enumerate(texts))) == {i: i - i % 2 for i in range(len(texts))}


def test_counts_never_discard_a_similar_pair():
    rnd = np.random.default_rng(3)
    for _ in range(300):
        a = rnd.choice(2 ** 62, int(rnd.integers(5, 400)), replace=True).astype(np.uint64)
        keep = a[: max(1, int(len(a) * rnd.uniform(0.7, 1)))]
        b = np.concatenate([keep, rnd.choice(2 ** 62, int(len(a) * rnd.uniform(0, 0.3))).astype(np.uint64)])
        a, b = np.unique(a), np.unique(b)
        count = [np.bincount((x % np.uint64(near_dedup.PIVOTS)).astype(np.int64), minlength=near_dedup.PIVOTS)[None] for x in (a, b)]
        if near_dedup.alike_sets(a.tobytes(), b.tobytes()):
            assert near_dedup.possible(*count)[0]


def test_uncounted_texts_meet_all_others_of_their_cell(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "COUNTED", 100)
    assert near_dedup.signature(" ".join(f"x{i}" for i in range(1 << 17)))[3] == [-1] * near_dedup.PIVOTS
    cell, fp = np.zeros(4, np.int64), np.array([0, -1, 2 ** 40 - 1, 2 ** 62 - 1], np.int64)
    counts = np.array([[5] * 12, [-1] * 12, [50] * 12, [52] * 12])
    asked = set()
    near_dedup.linked(cell, fp, 4, lambda i, j: asked.add((min(i, j), max(i, j))), counts)
    assert asked == {(0, 1), (1, 2), (1, 3), (2, 3)}
