"""Bronze, silver and gold tables: Parquet directories partitioned by day."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicpulse.runtime import cut_lineage
from topicpulse.schemas import GOLD_THEMES, GOLD_TOPICS


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in schema order, or no rows when the path does not exist yet.

    The explicit schema keeps the day column a string.
    """
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_gold_topics(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, GOLD_TOPICS)


def read_gold_themes(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, GOLD_THEMES)


def validate_non_empty(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Stop a run that has no data or lacks columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if df.isEmpty():
        raise RuntimeError("no data was extracted")
    return df


def drop_days(spark: SparkSession, path: str, column: str, days: Iterable[str]) -> None:
    """Remove whole day partitions, if present."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for day in days:
        folder = hadoop.Path(f"{path}/{column}={day}")
        folder.getFileSystem(conf).delete(folder, True)


def write_days(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """Write one folder per day; overwriting touches only the days present in ``df``.

    The rebalance splits a huge day over several tasks and merges small ones.
    """
    (df.hint("rebalance", F.col(column)).write.mode(mode).option("compression", "zstd")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))


def write_bronze(df: DataFrame, path: str) -> None:
    """Raw rows by run date; a rerun replaces its date."""
    write_days(df, path, "data_coleta")


def append_bronze(df: DataFrame, path: str) -> None:
    write_days(df, path, "data_coleta", mode="append")


def write_stage(df: DataFrame, path: str, days: Iterable[str], column: str = "data_coleta") -> None:
    """Replace the given days of an intermediate table, also when they come out empty."""
    drop_days(df.sparkSession, path, column, days)
    write_days(df, path, column)


def upsert_gold(df: DataFrame, path: str, days: Iterable[str]) -> DataFrame:
    """Replace the rows of ``days`` and keep all others; running it twice changes nothing.

    A day that now has no rows loses its old ones (a dynamic overwrite alone would keep them).
    Returns the written rows.
    """
    staged = cut_lineage(df)
    present = {r["data"] for r in staged.select("data").distinct().collect()}
    write_days(staged, path, "data")
    drop_days(df.sparkSession, path, "data", set(days) - present)
    return staged
