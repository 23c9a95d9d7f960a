"""Running minima and counts over the earlier (or later) rows of a key, without a key in one task.

Two levels: rows are range-partitioned by (key, order), so a key of any size is cut into ranges
of consecutive rows; each range answers its own rows with a window, one summary row per range is
made, the summaries of a key (at most one per partition) are combined by a prefix over ranges, and
that is joined back to the rows of each range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicpulse.runtime import cut_lineage


def before(rows: DataFrame, keys: list[str], order: str, value: str, descending: bool = False,
           prefix: str = "_") -> DataFrame:
    """Adds ``{prefix}min`` (smallest ``value`` of the rows of the same key strictly before this one by
    ``order``, or after it when ``descending``; null if none) and ``{prefix}n`` (how many such rows).

    ``order`` must be unique within a key.
    """
    ranged = cut_lineage(rows.repartitionByRange(*keys, order).withColumn("_rng", F.spark_partition_id()))
    by = F.desc(order) if descending else F.asc(order)
    local = Window.partitionBy(*keys, "_rng").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy(*keys, "_rng").agg(F.min(value).alias("_rmin"), F.count(F.lit(1)).alias("_rn"))
    across = Window.partitionBy(*keys).orderBy(F.desc("_rng") if descending else F.asc("_rng")).rowsBetween(
        Window.unboundedPreceding, -1)
    ranges = ranges.select(*keys, "_rng", F.min("_rmin").over(across).alias("_pmin"),
                           F.coalesce(F.sum("_rn").over(across), F.lit(0)).alias("_pn"))
    out = (ranged.withColumn("_lmin", F.min(value).over(local))
           .withColumn("_ln", F.count(F.lit(1)).over(local))
           .join(ranges, [*keys, "_rng"]))
    return (out.withColumn(f"{prefix}min", F.least("_lmin", "_pmin"))
            .withColumn(f"{prefix}n", F.col("_ln") + F.col("_pn"))
            .drop("_rng", "_lmin", "_ln", "_pmin", "_pn"))
