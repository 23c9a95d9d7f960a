"""Periodic runs: suffix-tree extensions and runs against plain scans, the registered query against a plain version."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from topicpulse.llm import periodic_runs as pr
from topicpulse.llm.queries import planted_words


def plain_runs(s):
    """Maximal runs (start, length, smallest period) of exponent >= 2, by scanning every period."""
    n, out = len(s), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            smallest = next(d for d in range(1, q + 1) if all(s[k] == s[k + d] for k in range(i, i + length - d)))
            if length >= 2 * q and smallest == q:
                out.add((i, length, q))
            i = j
    return out


def plain_words(doc_id, text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def plain_row(doc_id, text):
    w = plain_words(doc_id, text)
    runs = sorted((r for r in plain_runs(w) if r[1] >= max(24, 3 * r[2])), key=lambda r: (r[0], r[2]))
    drop = set()
    for s, ln, q in runs:
        drop.update(range(s + q, s + ln))
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    spec = "".join(f"{s},{ln},{q}\n" for s, ln, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    return (doc_id, len(runs), *(best or (None, None, None)),
            None if best is None else 1000 * best[1] // best[2],
            hashlib.sha256(spec.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_extensions_and_runs_equal_plain_scans():
    rnd = random.Random(1)
    for _ in range(1500):
        n, k = rnd.randint(1, 40), rnd.randint(1, 3)
        s = [rnd.randint(0, k - 1) for _ in range(n)]
        ext = pr.Extensions(s)
        for _ in range(5):
            i, j = rnd.randint(0, n), rnd.randint(0, n)
            want = 0
            while i + want < n and j + want < n and s[i + want] == s[j + want]:
                want += 1
            assert ext.lce([i], [j])[0] == want
        assert pr.runs_of(s) == plain_runs(s)


def test_regions_hold_every_long_run():
    rnd = random.Random(2)
    for _ in range(300):
        words = [f"w{rnd.randint(0, 3)}" for _ in range(rnd.randint(20, 120))]
        if rnd.random() < 0.5:
            at, q = rnd.randint(0, 40), rnd.randint(1, 12)
            words[at:at + 40] = (words[at:at + q] * 40)[:40]
        runs, _ = pr.analyse(words)
        want = sorted((r for r in plain_runs(words) if r[1] >= max(24, 3 * r[2])), key=lambda r: (r[0], r[2]))
        assert runs == want


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(4)
    vocab = [f"v{k}" for k in range(30)] + ["the", "a", "é", "日本"]
    out = []
    for k in range(120):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(0, 300))]
        if k % 4 == 0 and len(w) > 60:
            q = rnd.randint(1, 15)
            at = rnd.randint(0, len(w) - 50)
            w[at:] = (w[at:at + q] * 400)[:len(w) - at]
        out.append("\n ".join(" ".join(w[i:i + 9]) for i in range(0, len(w), 9)))
    return out + ["", None, " \t ", "x " * 30, "ab " * 23, "a b " * 40 + "c"]


def test_query_equals_plain_version(spark, texts):
    rows = [(i * 7 + 3, t) for i, t in enumerate(texts)] + [(None, "a b " * 20), (5, texts[0]), (5, texts[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit("clash"))
    found = pr.periodic_runs(planted_words(docs), "doc_id", "words")
    spec = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                                F.lit("\n"))), "")
    got = found.select("doc_id", F.size("runs"), "best.start", "best.length", "best.period",
                       F.floor(F.col("best.length") * 1000 / F.col("best.period")),
                       F.sha2(spec, 256), F.sha2("collapsed", 256)).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted((plain_row(i, t) for i, t in rows), key=str)
    assert any(r[1] for r in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, words array<string>")
    assert pr.periodic_runs(empty).count() == 0
