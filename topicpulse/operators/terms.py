"""Document frequency and TF-IDF over one or many batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicpulse.functions.text import vocabulary_terms
from topicpulse.runtime import broadcast_if


def document_frequency(df: DataFrame, by: Sequence[str] = (), tokens: str = "tokens") -> DataFrame:
    """Number of documents (rows) that hold each token, per batch."""
    return (df.select(*by, F.explode(F.array_distinct(F.col(tokens))).alias("termo"))
            .groupBy(*by, "termo").agg(F.count(F.lit(1)).alias("frequencia")))


def ranked(stats: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Term statistics in report order: per batch the highest first, ties by term."""
    return stats.orderBy(*by, F.desc(metric), F.asc("termo"))


def smooth_idf(n_docs: Column, df: Column) -> Column:
    return F.log((n_docs + 1.0) / (df + 1.0)) + 1.0


def batch_count(df: DataFrame, by: Sequence[str]) -> int:
    """Number of batches; reads the batch columns only."""
    return df.select(*by).distinct().count() if by else 1


def top_vocabulary(counts: DataFrame, by: Sequence[str], max_features: int) -> DataFrame:
    """The ``max_features`` most frequent terms (``tf``) of each batch, ties by term.

    The rank filter becomes a group limit that runs before the shuffle, so a batch with a
    huge vocabulary still sends only ``max_features`` rows per task to its final sort.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("tf"), F.asc("termo"))
    return (counts.withColumn("_pos", F.row_number().over(order))
            .filter(F.col("_pos") <= max_features).drop("_pos"))


def term_counts(docs: DataFrame, by: Sequence[str], terms: Column) -> DataFrame:
    """Occurrences ``tf`` and documents ``df`` of each term of a batch, in one shuffle.

    Each document sends its terms, and its distinct terms once more; both are summed on the
    map side, so no document key is shuffled.
    """
    listed = docs.select(*by, terms.alias("_termos"))
    uses = F.transform("_termos", lambda t: F.struct(t.alias("termo"), F.lit(1).alias("tf"), F.lit(0).alias("df")))
    once = F.transform(F.array_distinct("_termos"),
                       lambda t: F.struct(t.alias("termo"), F.lit(0).alias("tf"), F.lit(1).alias("df")))
    return (listed.select(*by, F.inline(F.concat(uses, once)))
            .groupBy(*by, "termo").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df")))


def tfidf(docs: DataFrame, doc: str, text: str = "texto_completo", by: Sequence[str] = (),
          min_corpus: int = 5, max_features: int = 200,
          n_batches: int | None = None) -> DataFrame:
    """Mean L2-normalised TF-IDF weight of the top terms of each batch.

    Batches with fewer than ``min_corpus`` documents give no rows. ``doc`` identifies a row
    within its batch.
    """
    return tfidf_of_lists(docs, doc, vocabulary_terms(F.col(text)), by, min_corpus, max_features,
                          n_batches)


def tfidf_of_lists(docs: DataFrame, doc: str, terms: Column, by: Sequence[str] = (),
                   min_corpus: int = 5, max_features: int = 200,
                   n_batches: int | None = None) -> DataFrame:
    """The same for documents whose terms are given as an array column."""
    n_batches = batch_count(docs, by) if n_batches is None else n_batches
    sizes = docs.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    vocab = _vocabulary(term_counts(docs, by, terms), sizes, by, min_corpus, max_features, n_batches)
    weights = (docs.select(*by, doc, F.explode(terms).alias("termo")).join(vocab, ["termo", *by])
               .groupBy(*by, doc, "termo", "_n").agg(F.sum("_idf").alias("_w")))
    return _mean_weights(weights, doc, by)


def tfidf_of_counts(counts: DataFrame, doc: str, by: Sequence[str], min_corpus: int = 5,
                    max_features: int = 200, n_batches: int | None = None) -> DataFrame:
    """The same from a long table: one row per (by, doc, termo) with its count ``tf``.

    Only documents with at least one row count towards the batch size.
    """
    n_batches = batch_count(counts, by) if n_batches is None else n_batches
    sizes = counts.select(*by, doc).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    stats = counts.groupBy(*by, "termo").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
    vocab = _vocabulary(stats, sizes, by, min_corpus, max_features, n_batches)
    weights = (counts.join(vocab.select(*by, "termo", "_n", "_idf"), ["termo", *by])
               .select(*by, doc, "termo", "_n", (F.col("tf") * F.col("_idf")).alias("_w")))
    return _mean_weights(weights, doc, by)


def _vocabulary(stats: DataFrame, sizes: DataFrame, by: Sequence[str], min_corpus: int,
                max_features: int, n_batches: int) -> DataFrame:
    """Kept terms with the batch size and smoothed IDF.

    At most one size row and ``max_features`` term rows per batch; broadcast within the limit.
    """
    top = top_vocabulary(stats, by, max_features)
    if by:
        sized = top.join(broadcast_if(sizes, n_batches), list(by))
    else:
        sized = top.withColumn("_n", sizes.scalar())
    vocab = sized.filter(F.col("_n") >= min_corpus).select(
        *by, "termo", "_n", smooth_idf(F.col("_n"), F.col("df")).alias("_idf"))
    return broadcast_if(vocab, n_batches * max_features)


def _mean_weights(weights: DataFrame, doc: str, by: Sequence[str]) -> DataFrame:
    """L2-normalise per document (at most ``max_features`` weights each), then average."""
    per_doc = weights.groupBy(*by, doc, "_n").agg(
        F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norma"),
        F.collect_list(F.struct("termo", "_w")).alias("_pesos"))
    return (per_doc.select(*by, "_n", "_norma", F.inline("_pesos"))
            .groupBy(*by, "termo")
            .agg((F.sum(F.col("_w") / F.col("_norma")) / F.first("_n")).alias("tfidf_score")))
