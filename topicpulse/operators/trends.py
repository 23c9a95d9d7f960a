"""Trailing baselines and the emergence score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicpulse.functions.dates import day_number, shift_day

EPSILON = 1e-6


def history_window(history: DataFrame, window_days: int, day: str) -> DataFrame:
    """Rows of the ``window_days`` before ``day``; plain bounds, so partitions are pruned."""
    return history.filter((F.col("data") >= shift_day(day, -window_days)) & (F.col("data") < day))


def baseline(history: DataFrame, window_days: int, day: str) -> DataFrame:
    """Mean and sample deviation of each term over the days on which it appears."""
    return (history_window(history, window_days, day)
            .filter(F.col("termo").isNotNull())
            .groupBy("termo")
            .agg(F.avg("frequencia").alias("media_frequencia"),
                 F.stddev_samp("frequencia").alias("std_frequencia")))


def _z(freq: Column, mean: Column, std: Column) -> Column:
    return F.when(mean.isNull(), freq.cast("double")).otherwise((freq - mean) / (std + EPSILON))


def _flag(z: Column, mean: Column, threshold: float) -> Column:
    return F.when(mean.isNotNull(), F.coalesce(z >= threshold, F.lit(False)))


def emergence(today: DataFrame, base: DataFrame, threshold: float) -> DataFrame:
    """z-score and flag of today's terms; the flag is NULL for terms without history."""
    mean, std = F.col("media_frequencia"), F.col("std_frequencia")
    joined = today.join(base.select("termo", mean, std), "termo", "left")
    scored = joined.withColumn("z_score", _z(F.col("frequencia"), mean, std))
    return (scored.withColumn("emergente", _flag(F.col("z_score"), mean, threshold))
            .drop("media_frequencia", "std_frequencia"))


def emergence_backfill(term_days: DataFrame, window_days: int, threshold: float,
                       min_history_days: int = 0) -> DataFrame:
    """The same score for every (day, term) at once, through one calendar-range window.

    One window partition holds one term, so at most one row per calendar day.
    """
    past = (Window.partitionBy("termo").orderBy(day_number(F.col("data")))
            .rangeBetween(-window_days, -1))
    mean, std = F.col("_media"), F.col("_std")
    scored = (term_days.filter(F.col("termo").isNotNull())
              .withColumn("_media", F.avg("frequencia").over(past))
              .withColumn("_std", F.stddev_samp("frequencia").over(past))
              .withColumn("_dias", F.count("frequencia").over(past))
              .withColumn("z_score", _z(F.col("frequencia"), mean, std)))
    flag = _flag(F.col("z_score"), mean, threshold)
    if min_history_days > 0:
        flag = F.when(F.col("_dias") >= min_history_days, flag)
    return scored.withColumn("emergente", flag).drop("_media", "_std", "_dias")


def day_over_day(topics: DataFrame) -> DataFrame:
    """Row counts of the last day and the day before it that has data."""
    per_day = topics.groupBy("data").agg(F.count(F.lit(1)).alias("n"))
    last_two = per_day.orderBy(F.desc("data")).limit(2)
    order = Window.orderBy("data")  # two rows at most
    out = (last_two.withColumn("data_anterior", F.lag("data").over(order))
           .withColumn("n_anterior", F.lag("n").over(order))
           .filter(F.col("data_anterior").isNotNull()))
    diff = F.col("n") - F.col("n_anterior")
    return out.select(
        "data", "data_anterior", F.col("n").alias("termos_hoje"),
        F.col("n_anterior").alias("termos_ontem"), diff.alias("diferenca"),
        F.when(diff > 0, "sobe").when(diff < 0, "desce").otherwise("igual").alias("direcao"))
