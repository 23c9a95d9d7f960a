"""Conversation prefix trie against a plain trie built from the rows, over shards of every size."""

import hashlib
import random
import zlib

import pytest

from topicpulse.llm import prefix_trie
from topicpulse.llm.queries import op13_prefix_trie


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain_nodes(rows):
    """Sorted node tuples of the query, by a dictionary trie over rebuilt conversations."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn if turn is not None else 0,
                                            digest(role, text), (role or "", text or "")))
    own = {c: [(t[2], t[3]) for t in sorted(ts, key=lambda t: t[:3])] for c, ts in convs.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        b = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        built[c] = own.get(b, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            key = tuple(t[0] for t in ts[:d])
            node = nodes.setdefault(key, {"members": [], "ends": [], "last": ts[d - 1][1][1] if d else ""})
            node["members"].append(c)
            if d == len(ts):
                node["ends"].append(c)
    children = {}
    for key in nodes:
        if key:
            children.setdefault(key[:-1], []).append(key)

    def subtree(key):
        kids = children.get(key, [])
        node = nodes[key]
        own_saved = (len(node["members"]) - 1) * len(node["last"].encode())
        sums = [subtree(k) for k in kids]
        return (1 if not kids else sum(s[0] for s in sums)), own_saved + sum(s[1] for s in sums)

    out = []
    for key, node in nodes.items():
        leaves, saved = subtree(key)
        parent = min(nodes[key[:-1]]["members"]) if key else None
        out.append((min(node["members"]), len(key), parent, len(node["members"]), len(children.get(key, [])), leaves,
                    saved, hashlib.sha256(",".join(str(c) for c in sorted(node["ends"])).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    firsts = [("user", "hello"), ("system", "be brief"), ("user", "hi é"), ("user", None)]
    out = []
    for c in range(0, 160):
        n = rnd.choice([0, 1, 2, 3, 5, 9, 12])
        if n == 0 and c % 3:
            continue
        for t in range(n):
            role, text = rnd.choice(firsts) if t == 0 or rnd.random() < 0.5 else (
                rnd.choice(["user", "assistant", None]), rnd.choice(["yes", "no", "ok 日本", "", "long " * 50]))
            out.append((c, t if rnd.random() < 0.95 else None, role, text))
        if n == 0:
            out.append((c, None, None, None))
    out += [(None, 1, "user", "orphan"), (7, 3, "user", "same turn"), (7, 3, "user", "same turn b")]
    out += [(200 + k, t, "user", f"copy {t}") for k in range(30) for t in range(4)]
    return out


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_trie_equals_plain_trie(spark, rows, partitions, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        path = str(tmp_path / "conversations.parquet")
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(path)
        got = op13_prefix_trie(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((tuple(r) for r in got), key=str) == plain_nodes(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string, key string")
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(empty)).count() == 0
