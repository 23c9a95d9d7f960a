"""Report queries over the gold tables.

Every product takes the gold DataFrames and a :class:`Filters`; filters on ``data`` reach
the scan as partition filters. "Latest day" is a scalar subquery, not a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicpulse.functions import labels as lb
from topicpulse.functions.text import capitalize, csv_items, display_label
from topicpulse.operators.trends import day_over_day
from topicpulse.runtime import cut_lineage


@dataclass(frozen=True)
class Filters:
    """Empty fields do not filter."""

    temas: Sequence[str] = ()
    fontes: Sequence[str] = ()
    sentimentos: Sequence[str] = ()
    inicio: str | None = None
    fim: str | None = None

    def _common(self, df: DataFrame) -> DataFrame:
        if self.inicio:
            df = df.filter(F.col("data") >= self.inicio)
        if self.fim:
            df = df.filter(F.col("data") <= self.fim)
        return df.filter(F.col("tema").isin(list(self.temas))) if self.temas else df

    def topics(self, g1: DataFrame) -> DataFrame:
        g1 = self._common(g1)
        if self.fontes:
            wanted = F.array(*[F.lit(f) for f in self.fontes])
            g1 = g1.filter(F.arrays_overlap(F.split("fontes", ","), wanted))
        if self.sentimentos:
            g1 = g1.filter(F.col("sentimento_predominante_termo").isin(list(self.sentimentos)))
        return g1

    def themes(self, g2: DataFrame) -> DataFrame:
        return self._common(g2)


NO_FILTERS = Filters()


def latest(df: DataFrame) -> DataFrame:
    """Rows of the last day."""
    return df.filter(F.col("data") == df.select(F.max("data")).scalar())


def _today(g1: DataFrame, filters: Filters) -> DataFrame:
    return latest(filters.topics(g1))


def _emerging_count() -> Column:
    return F.count_if(F.col("emergente"))


def _top(df: DataFrame, metric: str, k: int) -> DataFrame:
    """First ``k`` rows by the metric, ties by term; NULL metrics last."""
    return df.orderBy(F.desc_nulls_last(metric), F.asc("termo")).limit(k)


def kpis(g1: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """One row of headline numbers; none when nothing passes the filters."""
    d = filters.topics(g1)
    last = d.select(F.max("data")).scalar()
    today = F.col("data") == last
    row = d.agg(
        F.count(F.lit(1)).alias("linhas_no_periodo"),
        F.avg(F.when(today, F.col("sentimento_medio_termo"))).alias("sentimento_medio"),
        F.count_if(today & F.col("emergente")).alias("topicos_emergentes"),
        F.count_distinct("tema").alias("temas_ativos"),
        F.count_if(today).alias("termos_hoje"),
        F.count_distinct("data").alias("dias_com_dados"))
    return (row.filter(F.col("linhas_no_periodo") > 0)
            .withColumn("humor", lb.mood(F.col("sentimento_medio"))))


def filter_options(g1: DataFrame) -> DataFrame:
    """Values offered by the report filters: (tipo, valor, rotulo)."""
    themes = (g1.select("tema").filter(F.col("tema").isNotNull()).distinct()
              .select(F.lit("tema").alias("tipo"), F.col("tema").alias("valor"),
                      capitalize(F.col("tema")).alias("rotulo")))
    sources = (g1.select(F.explode(csv_items(F.col("fontes"))).alias("valor")).distinct()
               .select(F.lit("fonte").alias("tipo"), "valor", capitalize(F.col("valor")).alias("rotulo")))
    bounds = (g1.agg(F.min("data").alias("data_minima"), F.max("data").alias("data_maxima"))
              .unpivot([], ["data_minima", "data_maxima"], "tipo", "valor")
              .filter(F.col("valor").isNotNull())
              .select("tipo", "valor", F.col("valor").alias("rotulo")))
    return reduce(DataFrame.unionByName, [themes, sources, bounds]).orderBy("tipo", "valor")


def sentiment_over_time(g2: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return (filters.themes(g2).select("data", "tema", "sentimento_medio")
            .orderBy("data", "tema"))


def sentiment_distribution(g1: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Terms of the last day per predominant label, with display name and share."""
    counts = (_today(g1, filters).groupBy("sentimento_predominante_termo")
              .agg(F.count(F.lit(1)).alias("termos")))
    every = Window.partitionBy()  # one row per label
    return counts.select(
        "sentimento_predominante_termo",
        lb.label_name(F.col("sentimento_predominante_termo")).alias("rotulo"), "termos",
        (F.col("termos") / F.sum("termos").over(every)).alias("parcela")
    ).orderBy(F.desc("termos"), "sentimento_predominante_termo")


def top_terms(g1: DataFrame, metric: str = "frequencia", k: int = 10,
              filters: Filters = NO_FILTERS) -> DataFrame:
    top = _top(_today(g1, filters), metric, k)
    return top.select("data", "termo", "tema", metric,
                      display_label(F.col("termo"), F.col("tema")).alias("rotulo"))


def top_emerging(g1: DataFrame, k: int = 5, filters: Filters = NO_FILTERS) -> DataFrame:
    return _top(_today(g1, filters).filter("emergente"), "z_score", k).select(
        "data", "termo", "tema", "frequencia", "z_score")


def emerging_evolution(g1: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return (filters.topics(g1).groupBy("data")
            .agg(F.count("termo").alias("termos"), _emerging_count().alias("emergentes"))
            .orderBy("data"))


def theme_distribution(g1: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return (_today(g1, filters).filter(F.col("tema").isNotNull()).groupBy("tema")
            .agg(F.count("termo").alias("termos"), F.sum("frequencia").alias("frequencia_total"))
            .orderBy("frequencia_total", "tema"))


def _today_sources(today: DataFrame) -> DataFrame:
    return (today.select(F.explode(csv_items(F.col("fontes"))).alias("fonte"))
            .groupBy("fonte").agg(F.count(F.lit(1)).alias("contagem")))


def source_distribution(g1: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    return _today_sources(_today(g1, filters)).orderBy(F.desc("contagem"), "fonte")


def frequency_vs_z(g1: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    freq, z = F.col("frequencia"), F.col("z_score")
    return _today(g1, filters).select("termo", "tema", "frequencia", "z_score",
                                      (freq * lb.POINT_SCALE).alias("tamanho"),
                                      lb.hot_zone(freq, z).alias("quadrante_quente"))


def theme_sentiment_shares(g2: DataFrame, filters: Filters = NO_FILTERS) -> DataFrame:
    """Label shares of the last day, one row per theme and label."""
    shares = ["pct_positivo", "pct_negativo", "pct_neutro"]
    long = latest(filters.themes(g2)).unpivot(["data", "tema"], shares, "medida", "parcela")
    name = (F.when(F.col("medida") == shares[0], "Positivo")
            .when(F.col("medida") == shares[1], "Negativo").otherwise("Neutro"))
    return long.select("data", "tema", capitalize(F.col("tema")).alias("rotulo_tema"),
                       name.alias("sentimento"), (F.col("parcela") * 100).alias("percentual"),
                       lb.percent_text(F.col("parcela")).alias("texto"))


def word_weights(g1: DataFrame, k: int = 60, filters: Filters = NO_FILTERS) -> DataFrame:
    """Top terms of the last day with weight relative to the largest frequency."""
    top = _top(_today(g1, filters), "frequencia", k)
    every = Window.partitionBy()  # k rows at most
    return top.select("termo", "frequencia",
                      (F.col("frequencia") / F.max("frequencia").over(every)).alias("peso"))


def topic_table(g1: DataFrame, k: int = 50, filters: Filters = NO_FILTERS) -> DataFrame:
    return _top(_today(g1, filters), "frequencia", k).select(
        "termo", "frequencia", F.bround("tfidf_score", 4).alias("tfidf_score"),
        F.bround("z_score", 2).alias("z_score"), "tema", "sentimento_predominante_termo",
        lb.row_class(F.col("emergente"), F.col("sentimento_predominante_termo")).alias("classe"))


def topic_summary(g1: DataFrame, k: int = 5, filters: Filters = NO_FILTERS) -> DataFrame:
    """Top terms by frequency, by TF-IDF and among the emerging: (tipo, termo, valor)."""
    today = _today(g1, filters)

    def part(kind: str, df: DataFrame, metric: str) -> DataFrame:
        return _top(df, metric, k).select(F.lit(kind).alias("tipo"), "termo",
                                          F.col(metric).cast("double").alias("valor"))

    return reduce(DataFrame.unionByName, [
        part("frequencia", today, "frequencia"), part("tfidf", today, "tfidf_score"),
        part("emergente", today.filter("emergente"), "z_score")])


def insights(g1: DataFrame, g2: DataFrame, filters: Filters = NO_FILTERS, k: int = 3) -> DataFrame:
    """The insight bar as rows (tipo, chave, valor)."""
    d1, d2 = filters.topics(g1), filters.themes(g2)
    # Twelve rows read the last day, so it is stored once; so are the two day counts.
    today, today2 = cut_lineage(latest(d1)), latest(d2)

    def rows(df: DataFrame, kind: str, key, value) -> DataFrame:
        return df.select(F.lit(kind).alias("tipo"), key.cast("string").alias("chave"),
                         value.cast("double").alias("valor"))

    every = Window.partitionBy()  # a handful of rows: labels, themes
    mood = today.groupBy("sentimento_predominante_termo").agg(F.count(F.lit(1)).alias("n"))
    mood = mood.withColumn("pct", F.col("n") / F.sum("n").over(every) * 100)
    by_theme = today.filter(F.col("tema").isNotNull()).groupBy("tema").agg(F.sum("frequencia").alias("n"))
    by_theme = by_theme.withColumn("pct", F.col("n") / F.sum("n").over(every) * 100)
    total = today.agg(_emerging_count().alias("e"), F.count(F.lit(1)).alias("n"))
    scored = today2.filter(F.col("sentimento_medio").isNotNull())
    change = cut_lineage(day_over_day(d1))
    label = F.col("sentimento_predominante_termo")
    one = F.lit(1.0)
    return reduce(DataFrame.unionByName, [
        rows(_today_sources(today), "fonte_ativa", F.col("fonte"), one),
        rows(mood, "sentimento", label, F.col("n")),
        rows(mood, "sentimento_pct", label, F.col("pct")),
        rows(by_theme.orderBy(F.desc("n"), "tema").limit(1), "tema_dominante", F.col("tema"), F.col("pct")),
        rows(scored.orderBy(F.desc("sentimento_medio"), "tema").limit(1), "mais_positivo",
             F.col("tema"), F.col("sentimento_medio")),
        rows(scored.orderBy("sentimento_medio", "tema").limit(1), "mais_negativo",
             F.col("tema"), F.col("sentimento_medio")),
        rows(total.filter("e > 0"), "emergentes", F.lit("emergentes"), F.col("e")),
        rows(total.filter("e > 0"), "emergentes", F.lit("termos"), F.col("n")),
        rows(_top(today.filter("emergente"), "z_score", k), "emergente_top", F.col("termo"), F.col("z_score")),
        rows(change, "volume", F.lit("hoje"), F.col("termos_hoje")),
        rows(change, "volume", F.lit("ontem"), F.col("termos_ontem")),
        rows(change, "volume", F.col("direcao"), F.col("diferenca"))])
