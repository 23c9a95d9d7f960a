"""Sentiment, predominant label and sources of each term."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.functions.labels import predominant, signed_score
from topicpulse.operators.containment import any_term_matches, term_matches
from topicpulse.runtime import cut_lineage, release

UNKNOWN_SOURCE = "desconhecida"
_COUNTS = {"_neg": "NEG", "_neu": "NEU", "_pos": "POS"}


def term_sentiment(articles: DataFrame, terms: DataFrame, doc: str = "ordem",
                   by: Sequence[str] = ("data",), text: str = "texto_completo",
                   letters_only: bool = True) -> DataFrame:
    """Mean signed score, most frequent label and sorted source list per term.

    An article counts once per term it contains. Terms that occur nowhere give no row.
    """
    if "fonte" not in articles.columns:
        articles = articles.withColumn("fonte", F.lit(UNKNOWN_SOURCE))
    slim = articles.select(*by, doc, text, "sentimento_label", "sentimento_score", "fonte")
    carried = [doc, "sentimento_label", "sentimento_score", "fonte"]
    if letters_only:
        matches = term_matches(slim, terms, carried, by, text)
    else:
        matches = any_term_matches(slim, terms, carried, by, text)
    # Stored, so that what the search has shuffled is let go before the terms are summed.
    parts = cut_lineage(_by_source(matches, by))
    release(articles.sparkSession)
    return _by_term(parts, by)


def summarize_matches(matches: DataFrame, by: Sequence[str] = ("data",)) -> DataFrame:
    """Aggregate one row per (article, term) into one row per term.

    Sources are grouped first: sums by (term, source) are plain hash aggregates, and the list of
    sources is collected from those few rows instead of from all matches.
    """
    return _by_term(_by_source(matches, by), by)


def _by_source(matches: DataFrame, by: Sequence[str]) -> DataFrame:
    label = F.col("sentimento_label")
    signed = signed_score(label, F.col("sentimento_score"))
    return matches.groupBy(*by, "termo", "fonte").agg(
        F.sum(signed).alias("_soma"), F.count(signed).alias("_n"),
        *[F.count_if(label == v).alias(k) for k, v in _COUNTS.items()])


def _by_term(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    agg = parts.groupBy(*by, "termo").agg(
        F.try_divide(F.sum("_soma"), F.sum("_n")).alias("sentimento_medio_termo"),
        *[F.sum(k).alias(k) for k in _COUNTS],
        F.array_join(F.array_sort(F.collect_set("fonte")), ",").alias("fontes"))
    return agg.select(*by, "termo", "sentimento_medio_termo",
                      predominant(F.col("_neg"), F.col("_neu"), F.col("_pos"))
                      .alias("sentimento_predominante_termo"), "fontes")


def theme_sentiment(articles: DataFrame, day: str = "data") -> DataFrame:
    """Per theme of the whole article: mean unsigned score, counts and label shares.

    ``articles`` has ``tema_noticia``. Shares are over all rows of the theme, the count is
    over rows with a score. One aggregate, no join.
    """
    label = F.col("sentimento_label")

    def share(value: str):
        return F.avg(F.when(label == value, 1.0).otherwise(0.0))

    return (articles.groupBy(day, "tema_noticia")
            .agg(F.avg("sentimento_score").alias("sentimento_medio"),
                 F.count("sentimento_score").alias("qtd_noticias"),
                 share("POS").alias("pct_positivo"), share("NEG").alias("pct_negativo"),
                 share("NEU").alias("pct_neutro"))
            .withColumn("tema", F.col("tema_noticia")))
