"""The two gold tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.functions.themes import categorize
from topicpulse.operators.term_sentiment import theme_sentiment
from topicpulse.schemas import GOLD_THEMES, GOLD_TOPICS


def gold_topics(emerging: DataFrame, tfidf: DataFrame, sentiment: DataFrame,
                themes: Mapping[str, Iterable[str]], theme_mode: str = "contains") -> DataFrame:
    """Daily topics: the scored terms with TF-IDF, theme, sentiment and sources.

    All three inputs are keyed by (data, termo), so the two joins share one partitioning.
    """
    keys = ["termo", "data"]
    joined = emerging.join(tfidf, keys, "left").join(sentiment, keys, "left")
    return (joined.withColumn("tfidf_score", F.coalesce("tfidf_score", F.lit(0.0)))
            .withColumn("tema", categorize(F.col("termo"), themes, theme_mode))
            .withColumn("sentimento_medio_termo", F.coalesce("sentimento_medio_termo", F.lit(0.0)))
            .withColumn("sentimento_predominante_termo",
                        F.coalesce("sentimento_predominante_termo", F.lit("NEU")))
            .withColumn("fontes", F.coalesce("fontes", F.lit("")))
            .select(*GOLD_TOPICS.names))


def gold_themes(articles: DataFrame, themes: Mapping[str, Iterable[str]],
                text: str = "texto_completo", theme_mode: str = "contains") -> DataFrame:
    """Daily sentiment per article theme."""
    named = articles.withColumn("tema_noticia", categorize(F.col(text), themes, theme_mode))
    return theme_sentiment(named).select(*GOLD_THEMES.names)
