"""Line dedup by winnowing over line hashes, native.

Lines with a word are numbered within their document. From every line a window of following
lines is opened that closes as soon as it holds ``GUARANTEE`` words; a repeated run with so many
words therefore always contains a whole window. The window's smallest line hash is its fingerprint
and is joined together with the digest of the window, so equal fingerprints from different surroundings
never meet. Each fingerprint is matched with its first occurrence (by doc_id, then line); the match
is extended by the lines that follow as long as they agree with those that follow the first
occurrence. Extension backwards needs no step of its own: a line before a match that agrees too opens
a window that lies inside the match. All later occurrences are deleted, the first one stays.

Lines are compared by two independent 64-bit hashes. A null text stays null and an empty one empty;
lines without a word are kept and never matched. Rows repeated under one doc_id with one text share
their deletions. Rows without doc_id come first in order. Other columns are carried untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.quality import BLANKS, bind, text_words

GUARANTEE = 10
SECOND = "\x01second"


def _lines(text: Column) -> Column:
    """Per line with a word: place among all lines, two hashes, words."""
    return F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(
        i.alias("i"), F.xxhash64(x).alias("h"), F.xxhash64(x, F.lit(SECOND)).alias("s"),
        F.when(F.btrim(x, F.lit(BLANKS)) == "", 0).otherwise(F.size(text_words(x))).alias("n"))),
        lambda x: x["n"] > 0)


def _windows(lines: Column, words: int) -> Column:
    """For line k (from 1): its window of m lines, digest, minimum, and the lines that follow it."""
    def one(k: Column) -> Column:
        def measure(ahead: Column) -> Column:
            start = F.struct(F.lit(0).alias("w"), F.lit(0).alias("m"))
            return F.aggregate(ahead, start, lambda a, x: F.when(a["w"] >= words, a).otherwise(
                F.struct((a["w"] + x["n"]).alias("w"), (a["m"] + 1).alias("m"))))

        def shape(size: Column) -> Column:
            inside = F.slice(lines, k, size["m"])
            return F.struct(
                k.alias("k"), size["m"].alias("m"), size["w"].alias("w"),
                F.array_min(F.transform(inside, lambda x: x["h"])).alias("least"),
                F.xxhash64(F.transform(inside, lambda x: F.struct(x["h"], x["s"]))).alias("digest"),
                F.xxhash64(F.transform(inside, lambda x: F.struct(x["s"], x["h"])), F.lit(SECOND)).alias("guard"),
                F.transform(F.slice(lines, k + size["m"], words - 1),
                            lambda x: F.struct(x["h"].alias("h"), x["s"].alias("s"))).alias("tail"))

        return bind(measure(F.slice(lines, k, words)), shape)

    return F.when(F.size(lines) > 0, F.filter(
        F.transform(F.sequence(F.lit(1), F.size(lines)), one), lambda x: x["w"] >= words))


def _key(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_th")]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 words: int = GUARANTEE) -> DataFrame:
    found = bind(_lines(F.col(text)), lambda ls: _windows(ls, words))
    return docs.select(*_key(doc_id, text), F.explode(found).alias("x")).select("_id", "_th", "x.*")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   words: int = GUARANTEE) -> DataFrame:
    """(_id, _th, gone): the numbers of the deleted lines of each document that has some."""
    prints = fingerprints(docs, doc_id, text, words).withColumn("at", F.struct("_id", "_th", "k"))
    keys = ["least", "digest", "guard"]
    first = (prints.groupBy(*keys).agg(F.min(F.struct("at", "tail")).alias("f"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(*keys, F.col("f.at").alias("at0"), F.col("f.tail").alias("tail0")))
    agree = F.zip_with("tail", "tail0", lambda x, y: F.coalesce(x == y, F.lit(False)))
    more = F.aggregate(agree, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, x: F.when(
        a["on"] & x, F.struct((a["n"] + 1).alias("n"), F.lit(True).alias("on"))).otherwise(
        F.struct(a["n"].alias("n"), F.lit(False).alias("on"))))["n"]
    later = prints.join(first, keys).where("at > at0")
    return (later.select("_id", "_th", F.explode(F.sequence("k", F.col("k") + F.col("m") + more - 1)).alias("k"))
            .groupBy("_id", "_th").agg(F.collect_set("k").alias("gone")))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words: int = GUARANTEE) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; adds n_lines and n_removed."""
    def rest(gone: Column) -> Column:
        def cut(ls: Column) -> Column:
            places = F.transform(gone, lambda k: F.get(ls, k - 1)["i"])
            return bind(F.split(F.col("_b"), "\n"), lambda all_lines: F.array_join(F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), places),
                lambda i: F.get(all_lines, i)), "\n"))
        return bind(_lines(F.col("_b")), cut)

    row = F.struct(*[F.col(c) for c in docs.columns if c != text]).alias("_row")
    left = docs.select(row, F.col(text).alias("_b"), *_key(doc_id, text))
    gone = repeated_lines(docs, doc_id, text, words).withColumnsRenamed({"_id": "_gid", "_th": "_gth"})
    both = left.join(gone, (F.col("_th") == F.col("_gth")) & F.col("_id").eqNullSafe(F.col("_gid")), "left")
    clean = F.when(F.col("gone").isNull(), F.col("_b")).otherwise(rest(F.col("gone")))
    return both.select("_row.*", clean.alias(text),
                       F.coalesce(F.size(F.split("_b", "\n")), F.lit(0)).cast("long").alias("_n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_n_removed"))


def drop_repeats(docs: DataFrame) -> DataFrame:
    """The stage: ``docs`` with cleaned texts, columns and rows otherwise unchanged.

    ``n_chars`` follows the new text where the table has it.
    """
    new = without_repeats(docs)
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*docs.columns)
