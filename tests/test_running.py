"""Running minima in ranges against a plain scan; hot titles with rising dates against the row rule."""

import random

from pyspark.sql import functions as F

from topicpulse.operators import running
from topicpulse.operators.dedup import dedup_news

from test_dedup import SCHEMA, sequential


def test_running_minima_equal_plain_scan(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 30)}", o, rnd.choice([None, *range(50)]))
            for o in rnd.sample(range(100_000), 3000)]
    df = spark.createDataFrame(rows, "k string, o long, v long")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for desc in (False, True):
            got = {(r.k, r.o): (r._min, r._n) for r in running.before(df, ["k"], "o", "v", descending=desc).collect()}
            for k, o, _ in rows:
                prior = [v for k2, o2, v in rows if k2 == k and (o2 > o if desc else o2 < o)]
                vals = [v for v in prior if v is not None]
                assert got[(k, o)] == (min(vals) if vals else None, len(prior))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        ranges = df.repartitionByRange("k", "o").where(F.col("k") == "hot").select(F.spark_partition_id()).distinct()
        assert ranges.count() > 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_title_with_rising_and_falling_dates(spark):
    rising = [("d", i, "ouro prata", f"2024-{1 + i // 28 % 12:02d}-{1 + i % 28:02d}", f"u{i}") for i in range(400)]
    falling = [("d", 1000 + i, "cobre zinco", f"2024-{12 - i // 28 % 12:02d}-{28 - i % 28:02d}", f"f{i}")
               for i in range(300)]
    undated = [("d", 2000 + i, "ferro estanho", "" if i % 3 else "2024-05-05", f"x{i}") for i in range(100)]
    data = rising + falling + undated
    want = {o for o, link in sequential(data, 0.75).items() if link is None}
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = dedup_news(spark.createDataFrame(data, SCHEMA), 0.75, slice_rows=40, block=5)
        assert {r["ordem"] for r in got.collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
