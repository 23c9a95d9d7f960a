"""Registered queries: one entry per operator or product, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicpulse.catalog.setup import (
    CONFIG, EVENT_THEMES, NEGATIVE_WORDS, POSITIVE_WORDS, RUN_DAY,
)
from topicpulse.functions import dates, labels, text, themes
from topicpulse.operators import clean, dedup, sentiment, similarity, term_sentiment, terms, trends
from topicpulse.plans import daily, gold, products
from topicpulse.runtime import cut_lineage, release, scratch_path
from topicpulse.sources import feeds, tables, views
from topicpulse.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round all doubles, so summation order does not show.

    The first rounding removes the noise of sums, which could tip a tie of the second.
    """
    return df.select(*[F.round(F.round(f.name, 12), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


# --- documents as news ------------------------------------------------------------------

def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_news(views.news(spark, sf))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    score = sentiment.prediction_scorer(views.predictions(spark, sf), "ordem")
    return sentiment.compute_sentiment(_clean(spark, sf), score).withColumn("data", F.col("data_coleta"))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    unique = dedup.dedup_news(_clean(spark, sf), CONFIG.similarity)
    score = sentiment.prediction_scorer(views.predictions(spark, sf), "ordem")
    scored = sentiment.compute_sentiment(unique, score).withColumn("data", F.col("data_coleta"))
    return clean.news_tokens(scored, CONFIG)


def _doc_terms(df: DataFrame) -> DataFrame:
    return terms.document_frequency(clean.news_tokens(df, CONFIG), ["data"])


def strip_html(spark, sf):
    pages = views.spread(views.read_table(spark, sf, "pages"), "page_id")
    return pages.select("page_id", text.strip_html(F.col("html")).alias("texto"))


def clean_news(spark, sf):
    return _clean(spark, sf).select("ordem", "titulo", "resumo", "texto_completo")


def tokens(spark, sf):
    t = clean.news_tokens(_clean(spark, sf), CONFIG)
    return t.select("ordem", F.size("tokens").alias("n_tokens"),
                    F.array_join("tokens", " ").alias("tokens"))


def document_frequency(spark, sf):
    return terms.ranked(_doc_terms(_clean(spark, sf).withColumn("data", F.col("data_coleta"))), "frequencia", ["data"])


def tfidf(spark, sf):
    docs = _clean(spark, sf).withColumn("data", F.col("data_coleta"))
    return terms.ranked(rounded(terms.tfidf(docs, "ordem", by=["data"])), "tfidf_score", ["data"])


def tfidf_corpus(spark, sf):
    return terms.ranked(rounded(terms.tfidf(_clean(spark, sf), "ordem")), "tfidf_score")


def similar_titles(spark, sf):
    return rounded(similarity.similar_titles(_clean(spark, sf), CONFIG.similarity))


def dedup_news(spark, sf):
    return dedup.dedup_news(_clean(spark, sf), CONFIG.similarity).select(
        "data_coleta", "ordem", "link", "titulo", "data_publicacao")


def dedup_audit(spark, sf):
    return dedup.dedup_audit(_clean(spark, sf), CONFIG.similarity).select(
        "data_coleta", "ordem", "duplicata", "duplicata_de")


def publication_times(spark, sf):
    parsed = dates.publication_time(F.col("data_publicacao"))
    return views.news(spark, sf).select(
        "ordem", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("publicado_em"))


def theme_of_article(spark, sf):
    return _clean(spark, sf).select(
        "ordem", themes.categorize(F.col("texto_completo"), CONFIG.themes).alias("tema"))


def lexicon_sentiment(spark, sf):
    score = sentiment.lexicon_scorer(POSITIVE_WORDS, NEGATIVE_WORDS)
    return rounded(score(_clean(spark, sf)).select("ordem", "sentimento_label", "sentimento_score"))


def prediction_sentiment(spark, sf):
    return _scored(spark, sf).select(
        "ordem", "sentimento_label", "sentimento_score",
        labels.signed_score(F.col("sentimento_label"), F.col("sentimento_score")).alias("pontuado"))


def model_sentiment(spark, sf):
    def factory():
        def predict(texts):
            for t in texts:
                stops, commas = t.count("."), t.count(",")
                label = "POS" if stops > commas else "NEG" if commas > stops else "NEU"
                yield label, {label: max(stops, commas) / max(stops + commas, 1)}
        return predict

    score = sentiment.model_scorer(factory)
    return rounded(score(_clean(spark, sf)).select("ordem", "sentimento_label", "sentimento_score"))


def term_sentiment_query(spark, sf):
    scored = _scored(spark, sf)
    freq = cut_lineage(_doc_terms(scored))
    return rounded(term_sentiment.term_sentiment(scored, freq))


def phrase_sentiment(spark, sf):
    """Sentiment of phrases: the first two words of each title, sought in all articles of the day."""
    scored = cut_lineage(_scored(spark, sf).select("data", "ordem", "titulo", "texto_completo", "sentimento_label",
                                                   "sentimento_score", "fonte"))
    phrases = (scored.select("data", F.substring_index("titulo", " ", 2).alias("termo"))
               .filter(F.col("termo").rlike(r"^\S+ \S+$")).distinct())
    return rounded(term_sentiment.term_sentiment(scored, phrases, letters_only=False))


def lexicon_table_sentiment(spark, sf):
    """The word lists as a table: every word that a document holds, with its polarity."""
    words = _clean(spark, sf).select(F.explode(text.tokenize(F.col("texto_completo"))).alias("palavra")).distinct()
    polarity = F.when(F.col("palavra").isin(*POSITIVE_WORDS), 1).when(F.col("palavra").isin(*NEGATIVE_WORDS), -1)
    table = words.withColumn("polaridade", polarity).filter("polaridade is not null")
    score = sentiment.lexicon_table_scorer(table, "ordem")
    return rounded(score(_clean(spark, sf)).select("ordem", "sentimento_label", "sentimento_score"))


def document_gold(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both gold tables of all days from the documents; what they read of silver is stored once, without its tokens,
    which only the frequencies read."""
    silver = cut_lineage(_silver(spark, sf).select("data", "ordem", "fonte", "texto_completo", "sentimento_label",
                                                   "sentimento_score"))
    release(spark)
    freq = cut_lineage(_doc_terms(silver))
    release(spark)
    emerging = trends.emergence_backfill(freq, CONFIG.history_days, CONFIG.z_threshold)
    # Stored, so that what one of them shuffles is let go before the next.
    sent = cut_lineage(term_sentiment.term_sentiment(silver, freq))
    release(spark)
    weights = cut_lineage(terms.tfidf(silver, "ordem", by=["data"], n_batches=views.BATCH_DAYS))
    release(spark)
    return (gold.gold_topics(emerging, weights, sent, CONFIG.themes),
            gold.gold_themes(silver, CONFIG.themes))


def gold_topics(spark, sf):
    return rounded(document_gold(spark, sf)[0])


def gold_theme_sentiment(spark, sf):
    return rounded(gold.gold_themes(_silver(spark, sf), CONFIG.themes))


def source_counts(spark, sf):
    return views.news(spark, sf).groupBy("fonte").agg(F.count(F.lit(1)).alias("noticias"))


def run_counts(spark, sf):
    """Rows per batch before and after cleaning and deduplication; the texts are read once."""
    rows = cut_lineage(views.news(spark, sf).select(
        "data_coleta", "ordem", "link", "data_publicacao", text.normalize_text(F.col("titulo")).alias("titulo"),
        clean.has_text().alias("limpa")))
    gone = (dedup.dropped_rows(rows.filter("limpa"), CONFIG.similarity).groupBy("data_coleta")
            .agg(F.count(F.lit(1)).alias("duplicatas")))
    out = (rows.groupBy("data_coleta").agg(F.count(F.lit(1)).alias("extraidas"), F.count_if("limpa").alias("limpas"))
           .join(gone, "data_coleta", "left").na.fill(0))
    return out.withColumn("unicas", F.col("limpas") - F.col("duplicatas")).withColumn(
        "descartadas", F.col("extraidas") - F.col("limpas"))


# --- feeds, runs and the incremental run ---------------------------------------------------

def _land_feeds(spark, sf, kind: str = "rss") -> str:
    """The documents as feed files, one folder per source and day."""
    folder = scratch_path(spark, "landing")
    if kind == "atom":
        (views.news(spark, sf).select(
            F.col("titulo").alias("title"), F.concat(F.lit("<p>"), "resumo", F.lit("</p>")).alias("summary"),
            F.col("data_publicacao").alias("published"), F.struct(F.col("link").alias("_href")).alias("link"),
            "fonte", "data_coleta")
         .write.format("xml").option("rowTag", "entry").option("rootTag", "feed")
         .partitionBy("fonte", "data_coleta").save(folder))
        return folder
    (views.news(spark, sf).select(
        F.col("titulo").alias("title"), F.concat(F.lit("<p>"), "resumo", F.lit("</p>")).alias("description"),
        F.col("data_publicacao").alias("pubDate"), "link", "fonte", "data_coleta")
     .write.format("xml").option("rowTag", "item").option("rootTag", "channel")
     .partitionBy("fonte", "data_coleta").save(folder))
    return folder


def feed_items(spark, sf):
    items = feeds.require_any_source(feeds.read_feed_items(spark, _land_feeds(spark, sf)))
    return feeds.project_feed(items)


def atom_items(spark, sf):
    items = feeds.require_any_source(feeds.read_feed_items(spark, _land_feeds(spark, sf, "atom"), "atom"))
    return feeds.project_feed(items)


def feed_failures(spark, sf):
    """Good and broken files per source and day: each source also has a file that breaks off on one day of ten."""
    folder = _land_feeds(spark, sf)
    days = views.news(spark, sf).filter(F.substring("data_coleta", -1, 1) == BROKEN_DAYS).select(
        "fonte", "data_coleta").distinct()
    (days.select(F.lit("<channel><item><title>a</title></item><item><title>b").alias("value"), "fonte", "data_coleta")
     .write.mode("append").partitionBy("fonte", "data_coleta").text(folder))
    return feeds.feed_failures(spark, folder).groupBy("fonte", "data_coleta").agg(
        F.sum("itens").alias("itens"), F.sum("quebrados").alias("quebrados"), F.count_if("sem_itens").alias("sem_itens"))


# Settings of the source report: every second source name, half of them without any landed file.
REPORTED_SOURCES = tuple((f"src{k}", f"feeds/src{k}.xml") for k in range(0, 40, 2))


def source_report(spark, sf):
    """Configured sources against the landed files: a configured source without files shows with zeros."""
    return feeds.source_report(spark, _land_feeds(spark, sf), REPORTED_SOURCES).drop("arquivos")


def _all_days() -> list[str]:
    return [dates.shift_day(views.FIRST_DAY, i) for i in range(views.BATCH_DAYS)]


def run_summary(spark, sf):
    """A run over all days from stored bronze: articles and terms per day."""
    base = scratch_path(spark, "run")
    tables.write_bronze(views.news(spark, sf).drop("ordem"), daily.Layout(base).bronze)
    score = sentiment.lexicon_scorer(POSITIVE_WORDS, NEGATIVE_WORDS)
    return daily.run_days(spark, base, _all_days(), CONFIG, score).select(
        "data", "total_noticias", "total_termos")


def incremental_run(spark, sf):
    """Feed files through the stream to gold; the topics table read back."""
    base = scratch_path(spark, "incremental")
    stream = incremental.feed_stream(spark, _land_feeds(spark, sf))
    score = sentiment.lexicon_scorer(POSITIVE_WORDS, NEGATIVE_WORDS)
    incremental.ingest(stream, base, CONFIG, score, f"{base}/checkpoint")
    return rounded(tables.read_gold_topics(spark, daily.Layout(base).topics))


# --- events as dated terms ----------------------------------------------------------------

def event_gold(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Both gold tables from the events; an event is one mention of its term by its source."""
    ev = views.term_events(spark, sf)
    emerging = trends.emergence_backfill(views.term_days(ev), CONFIG.history_days, CONFIG.z_threshold)
    # A document is one user on one day.
    counts = ev.groupBy("data", "doc", "termo").agg(F.count(F.lit(1)).alias("tf"))
    weights = terms.tfidf_of_counts(counts, "doc", ["data"], CONFIG.min_corpus, CONFIG.max_features)
    g1 = gold.gold_topics(emerging, weights, term_sentiment.summarize_matches(ev), EVENT_THEMES)
    return g1, gold.gold_themes(ev, EVENT_THEMES, "termo")


BROKEN_DAYS = "0"  # last digit of the days
RERUN_DAY, EMPTIED_DAY = "2024-01-20", "2024-01-21"


def upsert_result(spark, sf):
    """Store gold, rerun one day with other rows and one without rows; the table read back."""
    path = scratch_path(spark, "gold")
    g1 = event_gold(spark, sf)[0]
    stored = tables.upsert_gold(g1, path, _all_days())
    rerun = stored.filter((F.col("data") == RERUN_DAY) & (F.col("frequencia") > 1)).withColumn(
        "frequencia", F.col("frequencia") * 10)
    tables.upsert_gold(rerun, path, [RERUN_DAY, EMPTIED_DAY])
    return rounded(tables.read_gold_topics(spark, path))


def baseline(spark, sf):
    days = views.term_days(views.term_events(spark, sf))
    return rounded(trends.baseline(days, CONFIG.history_days, RUN_DAY))


def emerging_terms(spark, sf):
    days = views.term_days(views.term_events(spark, sf))
    base = trends.baseline(days, CONFIG.history_days, RUN_DAY)
    today = days.filter(F.col("data") == RUN_DAY)
    return rounded(trends.emergence(today, base, CONFIG.z_threshold))


def emergence_backfill(spark, sf):
    days = views.term_days(views.term_events(spark, sf))
    return rounded(trends.emergence_backfill(days, CONFIG.history_days, CONFIG.z_threshold))


def term_mode_label(spark, sf):
    out = term_sentiment.summarize_matches(views.term_events(spark, sf))
    return out.select("data", "termo", "sentimento_predominante_termo")


def term_sources(spark, sf):
    return term_sentiment.summarize_matches(views.term_events(spark, sf)).select("data", "termo", "fontes")


def _on_topics(product: Callable[..., DataFrame], **kwargs) -> Query:
    return lambda spark, sf: rounded(product(event_gold(spark, sf)[0], **kwargs))


def _on_themes(product: Callable[..., DataFrame], **kwargs) -> Query:
    return lambda spark, sf: rounded(product(event_gold(spark, sf)[1], **kwargs))


def insights(spark, sf):
    # Gold is a stored table in the daily run.
    return rounded(products.insights(*[cut_lineage(g) for g in event_gold(spark, sf)]))


FILTERED = products.Filters(temas=("política", "economia", "outros"), fontes=("purchase", "error"),
                            sentimentos=("NEU", "POS"), inicio="2024-01-10", fim="2024-01-25")


def filtered_topics(spark, sf):
    return rounded(FILTERED.topics(event_gold(spark, sf)[0]))


def filtered_themes(spark, sf):
    return rounded(FILTERED.themes(event_gold(spark, sf)[1]))


def filtered_kpis(spark, sf):
    return rounded(products.kpis(event_gold(spark, sf)[0], FILTERED))


QUERIES: dict[str, Query] = {
    "emerging_terms": emerging_terms,
    "baseline": baseline,
    "emergence_backfill": emergence_backfill,
    "strip_html": strip_html,
    "clean_news": clean_news,
    "tokens": tokens,
    "document_frequency": document_frequency,
    "tfidf": tfidf,
    "tfidf_corpus": tfidf_corpus,
    "similar_titles": similar_titles,
    "dedup_news": dedup_news,
    "dedup_audit": dedup_audit,
    "publication_times": publication_times,
    "theme_of_article": theme_of_article,
    "lexicon_sentiment": lexicon_sentiment,
    "lexicon_table_sentiment": lexicon_table_sentiment,
    "prediction_sentiment": prediction_sentiment,
    "model_sentiment": model_sentiment,
    "term_sentiment": term_sentiment_query,
    "term_mode_label": term_mode_label,
    "term_sources": term_sources,
    "phrase_sentiment": phrase_sentiment,
    "gold_topics": gold_topics,
    "gold_theme_sentiment": gold_theme_sentiment,
    "source_counts": source_counts,
    "run_counts": run_counts,
    "feed_items": feed_items,
    "source_report": source_report,
    "atom_items": atom_items,
    "feed_failures": feed_failures,
    "run_summary": run_summary,
    "incremental_run": incremental_run,
    "upsert_result": upsert_result,
    "kpis": _on_topics(products.kpis),
    "filtered_topics": filtered_topics,
    "filtered_themes": filtered_themes,
    "filtered_kpis": filtered_kpis,
    "insights": insights,
    "sentiment_over_time": _on_themes(products.sentiment_over_time),
    "sentiment_distribution": _on_topics(products.sentiment_distribution),
    "top_by_frequency": _on_topics(products.top_terms, metric="frequencia"),
    "top_by_tfidf": _on_topics(products.top_terms, metric="tfidf_score"),
    "top_emerging": _on_topics(products.top_emerging),
    "emerging_evolution": _on_topics(products.emerging_evolution),
    "theme_distribution": _on_topics(products.theme_distribution),
    "source_distribution": _on_topics(products.source_distribution),
    "frequency_vs_z": _on_topics(products.frequency_vs_z),
    "theme_sentiment_shares": _on_themes(products.theme_sentiment_shares),
    "word_weights": _on_topics(products.word_weights),
    "topic_table": _on_topics(products.topic_table),
    "topic_summary": _on_topics(products.topic_summary),
    "filter_options": _on_topics(products.filter_options),
    "day_over_day": _on_topics(trends.day_over_day),
}
