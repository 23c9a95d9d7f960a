"""Incremental daily run: new feed files flow to bronze, touched dates are recomputed, later ones re-scored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicpulse.config import Config
from topicpulse.functions.dates import shift_day
from topicpulse.operators.sentiment import Scorer
from topicpulse.plans.daily import Layout, rescore_days, run_days
from topicpulse.runtime import release
from topicpulse.schemas import BRONZE
from topicpulse.sources.feeds import _chunks, parse_items, project_feed
from topicpulse.sources.tables import append_bronze, read_or_empty


def feed_stream(spark: SparkSession, landing: str, kind: str = "rss",
                files_per_batch: int | None = None) -> DataFrame:
    """Streaming bronze rows from the landing folder; files are cut at item ends and every item is
    parsed on its own, as in the batch reader, so a broken item costs only itself."""
    reader = _chunks(spark.readStream, kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return project_feed(parse_items(reader.text(landing), kind))


def _with_key(df: DataFrame) -> DataFrame:
    """An item is all of its fields; two different items may share a link or have none."""
    fields = F.to_json(F.struct("titulo", "resumo", "data_publicacao", "link"))
    return df.withColumn("_chave", F.sha2(fields, 256))


def append_new(batch: DataFrame, path: str, days: list[str]) -> None:
    """Append the items that bronze does not hold yet; replaying a batch adds nothing."""
    keys = ["data_coleta", "fonte", "_chave"]
    known = read_or_empty(batch.sparkSession, path, BRONZE).filter(F.col("data_coleta").isin(days))
    fresh = _with_key(batch).dropDuplicates(keys).join(
        _with_key(known).select(*keys), keys, "left_anti")
    append_bronze(fresh.select(*BRONZE.names), path)


def later_days(spark: SparkSession, path: str, touched: list[str], window_days: int) -> list[str]:
    """The other stored dates whose baseline window contains a touched one."""
    day = F.col("data_coleta")
    stored = (read_or_empty(spark, path, BRONZE)
              .filter(day.between(min(touched), shift_day(max(touched), window_days)))
              .select(day).distinct().collect())
    later = {r["data_coleta"] for r in stored
             if any(day < r["data_coleta"] <= shift_day(day, window_days) for day in touched)}
    return sorted(later - set(touched))


def ingest(stream: DataFrame, base: str, config: Config, scorer: Scorer, checkpoint: str) -> None:
    """Process everything that has landed, then stop.

    A micro-batch is never the whole of a date, so each touched date is recomputed from all
    of its bronze rows. Later dates keep their frequencies and get new scores from gold.
    """
    spark, at = stream.sparkSession, Layout(base)

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        batch = batch.persist()
        try:
            touched = [r["data_coleta"] for r in batch.select("data_coleta").distinct().collect()]
            if touched:
                append_new(batch, at.bronze, touched)
                batch.unpersist()  # all else is read from bronze
                release(spark)
                run_days(spark, base, touched, config, scorer)
                later = later_days(spark, at.bronze, touched, config.history_days)
                if later:
                    rescore_days(spark, base, later, config)
        finally:
            batch.unpersist()

    (stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
