"""Views that present the provided tables as news and as dated terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the views: first batch day, number of batch days, and the publication cycle.
FIRST_DAY = "2024-01-01"
BATCH_DAYS = 30
PUBLICATION_STEP, PUBLICATION_DAYS, UNDATED_EVERY = 37, 23, 11
LABEL_SCORES = {"POS": 0.9, "NEG": 0.8, "NEU": 0.6}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a table with fewer input splits than cores by ``key``, since text work is bound by CPU."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news: first line is the title, the rest the summary."""
    d = read_table(spark, sf_dir, "documents")
    day = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"),
                                   (F.col("doc_id") % BATCH_DAYS).cast("int")), "yyyy-MM-dd")
    published = F.date_format(
        F.date_add(F.lit(FIRST_DAY).cast("date"),
                   ((F.col("doc_id") * PUBLICATION_STEP) % PUBLICATION_DAYS).cast("int")), "yyyy-MM-dd")
    title = F.substring_index("text", "\n", 1)
    return spread(d.select(
        title.alias("titulo"),
        F.col("text").substr(F.length(title) + 2, F.length("text")).alias("resumo"),
        F.when(F.col("doc_id") % UNDATED_EVERY == 0, "").otherwise(published).alias("data_publicacao"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("link"),
        F.col("source").alias("fonte"), day.alias("data_coleta"), F.col("doc_id").alias("ordem")), "ordem")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as sentiment predictions: toxic is negative, else good quality is positive."""
    label = (F.when(F.col("toxic") == 1, "NEG").when(F.col("quality") == 1, "POS").otherwise("NEU"))
    score = F.when(F.col("sentimento_label") == "NEG", LABEL_SCORES["NEG"]).when(
        F.col("sentimento_label") == "POS", LABEL_SCORES["POS"]).otherwise(LABEL_SCORES["NEU"])
    return (read_table(spark, sf_dir, "labels")
            .select(F.col("doc_id").alias("ordem"), label.alias("sentimento_label"))
            .withColumn("sentimento_score", score))


def term_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as dated term mentions with a label, a score and a source."""
    label = (F.when(F.col("event_type") == "purchase", "POS")
             .when(F.col("event_type") == "error", "NEG").otherwise("NEU"))
    return read_table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("data"),
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("termo"),
        F.col("event_type").alias("fonte"), F.col("user_id").alias("doc"),
        label.alias("sentimento_label"),
        (F.abs("value") / (F.abs("value") + 10)).alias("sentimento_score"))


def term_days(events: DataFrame) -> DataFrame:
    return events.groupBy("data", "termo").agg(F.count(F.lit(1)).alias("frequencia"))
