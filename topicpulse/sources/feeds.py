"""Landed feed files as news rows.

Files lie under ``landing/fonte=<name>/data_coleta=<day>/``, so the source and the run date are
partition columns: a source without files gives no rows and reading one day opens only its files.
Files are cut at item ends and every item is parsed on its own, so a broken item costs itself only:
the items behind it are read. :func:`feed_failures` counts broken items per file. Each item carries
its file (``arquivo``) and its number in the file (``item``, from 0), its arrival position.
An item end written inside a CDATA section would cut that item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicpulse.functions.text import strip_html
from topicpulse.schemas import BRONZE, FEED_ITEM

_PARTITIONS = [T.StructField("fonte", T.StringType()), T.StructField("data_coleta", T.StringType())]
_ATOM_LINK = T.StructField("link", T.StructType([T.StructField("_href", T.StringType())]))
_ROW_TAG = {"rss": "item", "atom": "entry"}
BROKEN = "_quebrado"


def feed_schema(kind: str = "rss") -> T.StructType:
    fields = [f for f in FEED_ITEM.fields if f.name != "link"]
    link = _ATOM_LINK if kind == "atom" else T.StructField("link", T.StringType())
    return T.StructType(fields + [link, T.StructField(BROKEN, T.StringType())] + _PARTITIONS)


def feed_options(kind: str = "rss") -> dict[str, str]:
    """A file is read up to its first broken item, whose row has the text in ``BROKEN`` and nothing else."""
    if kind not in _ROW_TAG:
        raise ValueError(f"unknown feed kind: {kind}")
    return {"rowTag": _ROW_TAG[kind], "mode": "PERMISSIVE", "ignoreCorruptFiles": "true",
            "ignoreMissingFiles": "true", "columnNameOfCorruptRecord": BROKEN}


def _chunks(reader, kind: str):
    """A file reader (batch or stream) set to cut files after every item end."""
    tag = _ROW_TAG[kind] if kind in _ROW_TAG else feed_options(kind)["rowTag"]
    return (reader.option("lineSep", f"</{tag}>").option("ignoreCorruptFiles", "true")
            .option("ignoreMissingFiles", "true")
            .schema(T.StructType([T.StructField("value", T.StringType()), *_PARTITIONS])))


def parse_items(chunks: DataFrame, kind: str = "rss", keep: Sequence[str] = ()) -> DataFrame:
    """Text pieces cut after item ends (``value``) to items: the piece from its last opening tag on is
    parsed as one item with its own corrupt-record column; pieces without an item are left out."""
    tag = _ROW_TAG[kind] if kind in _ROW_TAG else feed_options(kind)["rowTag"]
    body = F.regexp_extract("value", rf"(?s).*(<{tag}[\s>].*)$", 1)
    item_schema = T.StructType([f for f in feed_schema(kind).fields if f.name not in ("fonte", "data_coleta")])
    parsed = F.from_xml(F.concat(body, F.lit(f"</{tag}>")), item_schema,
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    return chunks.where(body != "").select(parsed.alias("_i"), "fonte", "data_coleta", *keep).select(
        "_i.*", "fonte", "data_coleta", *keep)


def read_feed_items(spark: SparkSession, landing: str, kind: str = "rss") -> DataFrame:
    """Good and broken items, the latter with ``BROKEN`` set (its text), plus ``arquivo`` and ``item``.

    The files are read as text cut after every item end (splittable, no file in one piece); the
    piece from the last opening tag on is parsed as one item with its own corrupt-record column.
    """
    chunks = _chunks(spark.read, kind).text(landing).select(
        "value", "fonte", "data_coleta", F.col("_metadata.file_path").alias("arquivo"),
        F.col("_metadata.file_block_start").alias("_bloco"), F.monotonically_increasing_id().alias("_seq"))
    items = parse_items(chunks, kind, ["arquivo", "_bloco", "_seq"])
    in_file = Window.partitionBy("arquivo").orderBy("_bloco", "_seq")
    return items.withColumn("item", (F.row_number().over(in_file) - 1).cast("long")).drop("_bloco", "_seq")


def is_broken() -> Column:
    """Nothing but the raw text was read. (Spark refuses to read ``BROKEN`` without another column.)"""
    return F.col(BROKEN).isNotNull() & F.col("title").isNull()


def feed_failures(spark: SparkSession, landing: str, kind: str = "rss") -> DataFrame:
    """One row per landed file: (fonte, data_coleta, arquivo, itens, sem_titulo, quebrados, sem_itens).

    ``quebrados`` counts its broken items (the others are read), ``sem_itens`` tells that it gave no good
    item at all: empty, unreadable or of another kind. Files are listed without opening them.
    """
    file = F.col("arquivo")
    broken = is_broken()
    counts = {"itens": ~broken, "sem_titulo": ~broken & F.col("title").isNull(), "quebrados": broken}
    read = (read_feed_items(spark, landing, kind).groupBy(file)
            .agg(*[F.count_if(c).alias(name) for name, c in counts.items()]))
    files = (spark.read.format("binaryFile").load(landing)
             .select(*[F.col(p.name).cast("string").alias(p.name) for p in _PARTITIONS],
                     F.col("_metadata.file_path").alias("arquivo")))
    return (files.join(read, "arquivo", "left").na.fill(0, list(counts))
            .select("fonte", "data_coleta", "arquivo", *counts, (F.col("itens") == 0).alias("sem_itens")))


def source_report(spark: SparkSession, landing: str, sources: Sequence[tuple[str, str]],
                  kind: str = "rss") -> DataFrame:
    """Configured sources against the landed files, one row per source named on either side:
    (fonte, ordem_config, url, dias, arquivos, itens, quebrados, configurada).

    A configured source without files shows with zeros; a landed source that is not configured has
    no ``ordem_config`` and ``configurada`` false. ``ordem_config`` is the position in the settings.
    """
    configured = spark.createDataFrame([(i, name, url) for i, (name, url) in enumerate(sources)],
                                       "ordem_config long, fonte string, url string")
    landed = feed_failures(spark, landing, kind).groupBy("fonte").agg(
        F.count_distinct("data_coleta").alias("dias"), F.count(F.lit(1)).alias("arquivos"),
        F.sum("itens").alias("itens"), F.sum("quebrados").alias("quebrados"))
    counts = ["dias", "arquivos", "itens", "quebrados"]
    return (F.broadcast(configured).join(landed, "fonte", "full")
            .select("fonte", "ordem_config", "url", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                    F.col("ordem_config").isNotNull().alias("configurada")))


def project_feed(items: DataFrame) -> DataFrame:
    """Good items to bronze columns: absent values become "", tags leave the summary."""
    def text(*cols: Column) -> Column:
        return F.coalesce(*cols, F.lit(""))

    is_atom = isinstance(items.schema["link"].dataType, T.StructType)
    link = F.col("link._href") if is_atom else F.col("link")
    good = items.filter(~is_broken()) if BROKEN in items.columns else items
    return good.select(
        text(F.col("title")).alias("titulo"),
        strip_html(text(F.col("summary"), F.col("description"))).alias("resumo"),
        text(F.col("published"), F.col("pubDate")).alias("data_publicacao"),
        text(link).alias("link"), "fonte", "data_coleta")


def tag_source(df: DataFrame, fonte: str, data_coleta: str) -> DataFrame:
    """Constant source and run date for one source read on its own."""
    return df.withColumn("fonte", F.lit(fonte)).withColumn("data_coleta", F.lit(data_coleta))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All sources below each other, in bronze columns."""
    if not frames:
        raise RuntimeError("no source given")
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out.select(*BRONZE.names)


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("fonte").agg(F.count(F.lit(1)).alias("noticias"))


def require_any_source(df: DataFrame) -> DataFrame:
    """One empty source is fine; nothing at all is an error."""
    if df.isEmpty():
        raise RuntimeError("no source gave any item")
    return df
