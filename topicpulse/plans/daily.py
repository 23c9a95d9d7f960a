"""One run for a set of dates: bronze to silver to both gold tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicpulse.config import Config
from topicpulse.functions.dates import shift_day
from topicpulse.functions.text import full_text
from topicpulse.operators.clean import arrival_order, clean_news, news_tokens
from topicpulse.operators.dedup import dedup_news
from topicpulse.operators.sentiment import Scorer, compute_sentiment
from topicpulse.operators.term_sentiment import term_sentiment
from topicpulse.operators.terms import document_frequency, tfidf
from topicpulse.operators.trends import emergence_backfill
from topicpulse.plans.gold import gold_themes, gold_topics
from topicpulse.runtime import cut_lineage, release
from topicpulse.schemas import BRONZE, GOLD_TOPICS, SILVER
from topicpulse.sources.tables import (
    read_gold_topics, read_or_empty, upsert_gold, validate_non_empty, write_stage,
)


@dataclass(frozen=True)
class Layout:
    """Where the tables of one base folder lie."""

    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/news_raw"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/news"

    @property
    def topics(self) -> str:
        return f"{self.base}/gold/daily_trending_topics"

    @property
    def themes(self) -> str:
        return f"{self.base}/gold/daily_overall_sentiment"


def build_silver(bronze: DataFrame, config: Config, scorer: Scorer) -> DataFrame:
    """Clean, deduplicate within the run date, score and tokenise."""
    # The whole text is title and summary again, so it is not stored with them.
    ordered = arrival_order(clean_news(bronze).drop("texto_completo")).withColumn(
        "texto_completo", full_text(F.col("titulo"), F.col("resumo")))
    unique = dedup_news(ordered, config.similarity, date_mode=config.date_mode)
    return news_tokens(compute_sentiment(unique, scorer), config).select(*SILVER.names)


def term_history(today: DataFrame, gold: DataFrame, days: list[str], config: Config) -> DataFrame:
    """Score the terms of ``days`` against gold history plus the days computed now."""
    past = gold.filter((F.col("data") >= shift_day(min(days), -config.history_days))
                       & (F.col("data") < max(days)) & ~F.col("data").isin(days))
    known = today.unionByName(past.select("data", "termo", "frequencia"))
    scored = emergence_backfill(known, config.history_days, config.z_threshold,
                                config.min_history_days)
    return scored.filter(F.col("data").isin(days))


def run_days(spark: SparkSession, base: str, days: Iterable[str], config: Config,
             scorer: Scorer) -> DataFrame:
    """Recompute the given run dates from all of their bronze rows, in one set of plans.

    Returns one row per date: articles, terms and the table paths.
    """
    days, at = sorted(set(days)), Layout(base)
    bronze = read_or_empty(spark, at.bronze, BRONZE).filter(F.col("data_coleta").isin(days))
    validate_non_empty(bronze, BRONZE.names)
    # Silver has four consumers, so it is stored once instead of recomputed.
    write_stage(build_silver(bronze, config, scorer), at.silver, days)
    release(spark)
    silver = (read_or_empty(spark, at.silver, SILVER).filter(F.col("data_coleta").isin(days))
              .withColumn("data", F.col("data_coleta")))

    # The term table is small next to the texts; stored once, its size is known.
    freq = cut_lineage(document_frequency(silver, ["data"]))
    release(spark)
    emerging = term_history(freq, read_gold_topics(spark, at.topics), days, config)
    # Stored, so that what one of them shuffles is let go before the next.
    weights = cut_lineage(tfidf(silver, "ordem", by=["data"], min_corpus=config.min_corpus,
                                max_features=config.max_features, n_batches=len(days)))
    release(spark)
    sentiment = cut_lineage(term_sentiment(silver, freq))
    release(spark)
    topics = upsert_gold(gold_topics(emerging, weights, sentiment, config.themes), at.topics, days)
    themes = upsert_gold(gold_themes(silver, config.themes), at.themes, days)

    articles = themes.groupBy("data").agg(F.sum("qtd_noticias").alias("total_noticias"))
    terms = topics.groupBy("data").agg(F.count(F.lit(1)).alias("total_termos"))
    return (articles.join(terms, "data", "full").na.fill(0)
            .withColumn("gold1_path", F.lit(at.topics)).withColumn("gold2_path", F.lit(at.themes)))


def rescore_days(spark: SparkSession, base: str, days: Iterable[str], config: Config) -> DataFrame:
    """New z-scores and flags for stored days whose history changed; reads gold only, no texts."""
    days, at = sorted(set(days)), Layout(base)
    gold = read_gold_topics(spark, at.topics)
    rows = gold.filter(F.col("data").isin(days))
    scored = term_history(rows.select("data", "termo", "frequencia"), gold, days, config)
    new = rows.drop("z_score", "emergente").join(scored.drop("frequencia"), ["data", "termo"])
    return upsert_gold(new.select(*GOLD_TOPICS.names), at.topics, days)


def run_day(spark: SparkSession, base: str, day: str, config: Config, scorer: Scorer) -> DataFrame:
    return run_days(spark, base, [day], config, scorer)
