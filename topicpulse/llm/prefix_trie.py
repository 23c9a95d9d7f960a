"""Prefix trie of conversations by a splitter skeleton: range-partitioned sorted shards, partial sums.

A node is a distinct sequence of the first d turns (role, text) of some conversation, from the
textless root (d = 0). Its members are the conversations starting with it (a turnless one belongs
to the root only). Per node: smallest member (``conv_id``), ``depth``, parent's ``conv_id``,
``n_convs``, ``n_children``, ``n_leaves`` (childless nodes of its subtree), ``saved_tokens``
(over its subtree, each node's (n_convs - 1) times the UTF-8 bytes of its last text) and
``ends_sha256`` (SHA-256 of the ascending, comma-joined ids of members with exactly d turns).

Method:

* every turn becomes a 16-byte digest of (role, text); a conversation is one row with the array of
  its digests and of its text sizes (no texts travel further);
* rows are range-partitioned by (digests, conv_id) and sorted in each shard, so the members of any
  node are a contiguous run of the global order and equal conversations may still be spread over
  shards by id;
* each shard scans its rows once with a stack of open nodes. A node that is neither a prefix of the
  shard's first row nor of its last row lies wholly inside the shard and is finished there. The
  others are the shard's part of the skeleton: the trie of the splitter paths between shards. For
  them the shard emits partial aggregates (members, smallest id, children and subtree sums of its
  finished children, its slice of the ending ids);
* skeleton nodes combine their partial rows by reduction (sums, minimum, ending ids in shard
  order), and their subtree sums are completed over the skeleton alone, which holds at most two
  paths per shard;
* a join on the parent's path gives ``parent_conv_id``.

Node identity is a chain of 128-bit digests (blake2b of the parent's and the turn's); collisions are
ignored. Equal turn numbers are ordered by the digest of their (role, text).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = bytes(16)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_SCAN = T.StructType([
    T.StructField("path", T.BinaryType()), T.StructField("depth", T.LongType()),
    T.StructField("parent_path", T.BinaryType()), T.StructField("conv_id", T.LongType()),
    T.StructField("n_convs", T.LongType()), T.StructField("n_children", T.LongType()),
    T.StructField("n_leaves", T.LongType()), T.StructField("saved_tokens", T.LongType()),
    T.StructField("last_bytes", T.LongType()), T.StructField("ends_sha256", T.StringType()),
    T.StructField("ends", T.StringType()), T.StructField("n_ends", T.LongType()),
    T.StructField("shard", T.IntegerType()), T.StructField("final", T.BooleanType())])


def turn_digest(role: str = "role", text: str = "text") -> F.Column:
    """16 bytes of SHA-256 over the role's length, the role and the text (nulls as empty)."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    return F.unhex(F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256), 1, 32))


def conversation_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, key: digests by turn, lens: UTF-8 bytes of each text); null conv_id rows are left out."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.struct(F.col("turn").isNotNull().alias("has"), F.col("turn").alias("turn"),
                            turn_digest().alias("d"),
                            F.octet_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("b")).alias("t"))
    per = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return per.select("conv_id", F.transform("ts", lambda x: x["d"]).alias("key"),
                      F.transform("ts", lambda x: x["b"]).alias("lens"))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One shard in (key, conv_id) order: finished rows for inner nodes, partial rows for the skeleton."""
    out: list[dict] = []
    stack: list[dict] = []
    shard = None
    prev: list[bytes] = []
    first_row = True

    def close(node: dict, final: bool) -> None:
        if final:
            leaves = 1 if node["children"] == 0 else node["leaves"]
            saved = (node["n"] - 1) * node["last"] + node["saved"]
            out.append({"path": node["path"], "depth": node["depth"], "parent_path": node["parent"],
                        "conv_id": node["min"], "n_convs": node["n"], "n_children": node["children"],
                        "n_leaves": leaves, "saved_tokens": saved, "last_bytes": node["last"],
                        "ends_sha256": hashlib.sha256(",".join(node["ends"]).encode()).hexdigest(), "ends": None, "n_ends": node["n_ends"],
                        "shard": shard, "final": True})
            if stack:
                parent = stack[-1]
                parent["leaves"] += leaves
                parent["saved"] += saved
                parent["inner"] += 1
        else:
            out.append({"path": node["path"], "depth": node["depth"], "parent_path": node["parent"],
                        "conv_id": node["min"], "n_convs": node["n"], "n_children": node["inner"],
                        "n_leaves": node["leaves"], "saved_tokens": node["saved"], "last_bytes": node["last"],
                        "ends_sha256": None, "ends": ",".join(node["ends"]), "n_ends": node["n_ends"],
                        "shard": shard, "final": False})

    def opened(path: bytes, depth: int, parent: bytes | None, last: int, skeleton: bool) -> dict:
        return {"path": path, "depth": depth, "parent": parent, "min": None, "n": 0, "children": 0, "inner": 0,
                "leaves": 0, "saved": 0, "last": last, "ends": [], "n_ends": 0, "skeleton": skeleton}

    for pdf in batches:
        for conv_id, key, lens, part in zip(pdf["conv_id"], pdf["key"], pdf["lens"], pdf["shard"]):
            shard = int(part)
            key = [bytes(k) for k in key]
            lens = [int(x) for x in lens]
            if first_row:
                stack.append(opened(ROOT, 0, None, 0, True))
                lcp = 0
            else:
                lcp = 0
                while lcp < len(prev) and lcp < len(key) and prev[lcp] == key[lcp]:
                    lcp += 1
                while len(stack) > lcp + 1:
                    node = stack.pop()
                    close(node, not node["skeleton"])
            for d in range(lcp + 1, len(key) + 1):
                top = stack[-1]
                top["children"] += 1
                path = hashlib.blake2b(top["path"] + key[d - 1], digest_size=16).digest()
                stack.append(opened(path, d, top["path"], lens[d - 1], first_row))
            for node in stack:
                node["n"] += 1
                if node["min"] is None or conv_id < node["min"]:
                    node["min"] = int(conv_id)
            end = stack[-1]
            end["ends"].append(str(int(conv_id)))  # ids come ascending: rows are sorted by (key, conv_id)
            end["n_ends"] += 1
            prev = key
            first_row = False
        if len(out) >= 10_000:
            yield pd.DataFrame(out, columns=[f.name for f in _SCAN.fields])
            out = []
    while stack:  # prefixes of the shard's last row: skeleton
        close(stack.pop(), False)
    if out:
        yield pd.DataFrame(out, columns=[f.name for f in _SCAN.fields])


def _skeleton_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and saved bytes of skeleton nodes over the skeleton (deepest first)."""
    pdf = pdf.sort_values("depth", ascending=False).reset_index(drop=True)
    kids: dict[bytes, list] = {}
    children, leaves, saved = [], [], []
    for row in pdf.itertuples(index=False):
        mine = kids.get(row.path, [0, 0, 0])
        n_children = int(row.n_children) + mine[0]
        n_leaves = 1 if n_children == 0 else int(row.n_leaves) + mine[1]
        total = (int(row.n_convs) - 1) * int(row.last_bytes) + int(row.saved_tokens) + mine[2]
        children.append(n_children)
        leaves.append(n_leaves)
        saved.append(total)
        if row.parent_path is not None:
            up = kids.setdefault(bytes(row.parent_path), [0, 0, 0])
            up[0] += 1
            up[1] += n_leaves
            up[2] += total
    return pd.DataFrame({"path": pdf["path"], "depth": pdf["depth"], "parent_path": pdf["parent_path"],
                         "conv_id": pdf["conv_id"], "n_convs": pdf["n_convs"], "n_children": children,
                         "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": pdf["ends_sha256"]})


_NODE = T.StructType([f for f in _SCAN.fields if f.name in (
    "path", "depth", "parent_path", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")])


def prefix_trie(rows: DataFrame) -> DataFrame:
    """Nodes of the trie of (conv_id, key, lens) rows: path, depth, parent_path, conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 and parent_conv_id."""
    shards = (rows.select("conv_id", "key", "lens").repartitionByRange("key", "conv_id")
              .sortWithinPartitions("key", "conv_id").withColumn("shard", F.spark_partition_id()))
    scanned = shards.mapInPandas(_scan, _SCAN)
    done = scanned.where("final").select(*[f.name for f in _NODE.fields])
    ordered = F.array_sort(F.collect_list(F.when(F.col("n_ends") > 0, F.struct("shard", "ends"))))
    parts = (scanned.where("not final").groupBy("path").agg(
        F.first("depth").alias("depth"), F.first("parent_path").alias("parent_path"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"), F.first("last_bytes").alias("last_bytes"),
        F.sha2(F.array_join(F.transform(ordered, lambda x: x["ends"]), ","), 256).alias("ends_sha256")))
    skeleton = parts.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(
        lambda pdf: _skeleton_sums(pdf.drop(columns=["_one"])), _NODE)
    nodes = done.unionByName(skeleton)
    parents = nodes.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, "parent_path", "left")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversation c as the first h turns of c - c % 5 followed by its own turns after its first h,
    h = crc32(decimal c) % 9: (conv_id, key, lens)."""
    own = conversation_rows(conversations)
    base = own.select(F.col("conv_id").alias("_b"), F.col("key").alias("_bk"), F.col("lens").alias("_bl"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(9)).cast("int")
    mine = own.withColumn("_h", h).withColumn("_b", F.col("conv_id") - F.col("conv_id") % 5)
    joined = mine.join(base, "_b", "left")

    def spliced(a: str, b: str) -> F.Column:
        head = F.slice(F.coalesce(F.col(b), F.array().cast(own.schema[a].dataType)), 1, F.col("_h"))
        tail = F.slice(F.col(a), F.col("_h") + 1, F.greatest(F.size(a) - F.col("_h"), F.lit(0)))
        return F.concat(head, tail)
    return joined.select("conv_id", spliced("key", "_bk").alias("key"), spliced("lens", "_bl").alias("lens"))
