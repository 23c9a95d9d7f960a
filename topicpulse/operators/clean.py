"""Cleaning and tokenising of news rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicpulse.config import Config
from topicpulse.functions import text as tx
from topicpulse.runtime import cut_lineage


def has_text() -> Column:
    """Is the title or the summary more than white space?"""
    return ~(tx.is_blank(F.col("titulo")) & tx.is_blank(F.col("resumo")))


def clean_news(df: DataFrame) -> DataFrame:
    """Normalise title and summary, add ``texto_completo`` and drop blank rows."""
    kept = df.filter(has_text())
    return (kept.withColumn("titulo", tx.normalize_text(F.col("titulo")))
            .withColumn("resumo", tx.normalize_text(F.col("resumo")))
            .withColumn("texto_completo", tx.full_text(F.col("titulo"), F.col("resumo"))))


def news_tokens(df: DataFrame, config: Config, text: str = "texto_completo") -> DataFrame:
    """Add the ``tokens`` column."""
    tokens = tx.filter_tokens(tx.tokenize(F.col(text)), config.stopwords, config.fold_stopwords)
    return df.withColumn("tokens", tokens)


def arrival_order(df: DataFrame) -> DataFrame:
    """Default ``ordem`` of a row in its batch, unique: by source, then link, then content.

    Items without a link or with the same one stay apart by a digest of their fields, and rows that
    agree in all fields by a number. The rows are stored, so that the number stays theirs.
    """
    fields = ["titulo", "resumo", "data_publicacao"]
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in fields if c in df.columns])), 256)
    number = F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0")
    key = F.concat_ws("\u0001", F.coalesce(F.col("fonte"), F.lit("")), F.coalesce(F.col("link"), F.lit("")),
                      digest, number)
    return cut_lineage(df.withColumn("ordem", key))
