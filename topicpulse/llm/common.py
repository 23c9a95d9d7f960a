"""What several operators share: stored tables, slices of long texts, bounded cells, components."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicpulse.runtime import release, scratch_path  # noqa: F401  (release is used from here)

# Texts above this many code points are handled in slices.
SLICE_CHARS = 1 << 20
_CUT = re.compile(r"\S(?= \S)")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: no lineage, true sizes."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """The text in pieces of about ``size``, cut between a non-blank and one blank before a non-blank."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.end()]
        start = cut.end()
    yield text[start:] if start else text


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def cells(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """Deal the members of each key with two or more of them into cells of at most about 2 * size.

    A key of up to ``size`` members is one cell. A larger one is cut into chunks by a hash of the
    member, and every pair of chunks is a cell, so any two members still meet in one.
    Adds ``cell`` (string).
    """
    many = (rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            .select(key, F.ceil(F.col("_n") / size).cast("int").alias("_g")))
    mine = F.pmod(F.xxhash64(member), F.col("_g"))
    dealt = (rows.join(many, key).withColumn("_c", mine)
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)))
             .where("_g <= 2 or _o <> _c"))
    dealt = dealt.where("_g <> 2 or _o = 0")  # two chunks have one pair; no chunk is paired with itself
    pair = F.when(F.col("_g") == 1, F.lit("0")).when(F.col("_g") == 2, F.lit("0-1")).otherwise(
        F.concat_ws("-", F.least("_c", "_o"), F.greatest("_c", "_o")))
    return dealt.withColumn("cell", F.concat_ws("/", F.col(key).cast("string"), pair)).drop("_g", "_c", "_o")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node on an edge; the component is its smallest node.

    Alternating large and small stars; each round is stored, and ends when nothing changes.
    Nodes without an edge are not returned.
    """
    edge = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edge = stored(edge, "edges")
    state = _state(edge)
    while state[0]:
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        edge = stored(small, "edges")
        last, state = state, _state(edge)
        if state == last:
            break
    return edge.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edge.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


class Forest:
    """Union-find over 0..n-1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def hex64(c: Column) -> Column:
    """A long as 16 lowercase hex digits, unsigned."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))
