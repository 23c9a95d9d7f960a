"""Explicit schemas of every table the pipeline reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TOKENS = T.ArrayType(T.StringType(), False)

FEED_ITEM = _struct(
    ("title", _S), ("description", _S), ("summary", _S), ("pubDate", _S),
    ("published", _S), ("link", _S),
)

BRONZE = _struct(
    ("titulo", _S), ("resumo", _S), ("data_publicacao", _S), ("link", _S),
    ("fonte", _S), ("data_coleta", _S),
)

SILVER = T.StructType(
    BRONZE.fields
    + _struct(
        ("texto_completo", _S), ("ordem", _S), ("sentimento_label", _S),
        ("sentimento_score", _D), ("tokens", _TOKENS),
    ).fields
)

BASELINE = _struct(("termo", _S), ("media_frequencia", _D), ("std_frequencia", _D))

EMERGING = _struct(("termo", _S), ("frequencia", _L), ("z_score", _D), ("emergente", _B))

GOLD_TOPICS = _struct(
    ("data", _S), ("termo", _S), ("frequencia", _L), ("tfidf_score", _D), ("z_score", _D),
    ("emergente", _B), ("tema", _S), ("sentimento_medio_termo", _D),
    ("sentimento_predominante_termo", _S), ("fontes", _S),
)

GOLD_THEMES = _struct(
    ("tema_noticia", _S), ("sentimento_medio", _D), ("qtd_noticias", _L), ("data", _S),
    ("tema", _S), ("pct_positivo", _D), ("pct_negativo", _D), ("pct_neutro", _D),
)
