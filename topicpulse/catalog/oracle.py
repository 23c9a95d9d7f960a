"""DuckDB SQL with the same meaning as the registered queries, written independently of them.

Similarity is brute force over all row pairs, containment is a plain ``contains`` join (cleaned texts are lower case) and the
greedy deduplication is a recursive query, so the SQL shares no shortcut with the Spark code.
Doubles are rounded to 12 places before 6: sums differ in the last bits between engines, which
would otherwise show where a mean ends exactly on a 5.
"""

from __future__ import annotations

from topicpulse.catalog.registry import BROKEN_DAYS, EMPTIED_DAY, FILTERED, RERUN_DAY
from topicpulse.catalog.setup import (
    CONFIG, DOCUMENT_THEMES, EVENT_THEMES, NEGATIVE_WORDS, POSITIVE_WORDS, RUN_DAY,
)

_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_CHUNK = r'[\s\x0b\x1c-\x1f\x{85}\p{Z};@#$%&?!"()\[\]{}<>,:]|--|\.\.\.'
_ACCENTED, _PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüæð÷ø", "aaaaaaceeeeiiiinooooouuuu"


def _words(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in sorted(values)) + "]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"


def _chunks(x: str) -> str:
    marked = f"regexp_replace(lower({x}), '[,:]([0-9])', chr(1) || '\\1', 'g')"
    return f"list_transform(regexp_split_to_array({marked}, '{_CHUNK}'), lambda t: rtrim(t, '.'))"


def _tokens(x: str) -> str:
    return (f"list_filter({_chunks(x)}, lambda t: length(t) > 2 AND regexp_matches(t, '^[a-zà-ü]+$') "
            f"AND NOT list_contains({_words(CONFIG.stopwords)}, translate(t, '{_ACCENTED}', '{_PLAIN}')))")


def _hits(words) -> str:
    return f"len(list_filter({_chunks('texto_completo')}, lambda t: list_contains({_words(words)}, t)))"


def _terms(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def _theme(x: str, lexicon) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({x}), '{k}')" for k in kws) + f" THEN '{tema}'"
        for tema, kws in lexicon.items())
    return f"CASE {whens} ELSE 'outros' END"


def _capital(x: str) -> str:
    return f"upper(substr({x}, 1, 1)) || lower(substr({x}, 2))"


_SIGNED = "CASE label WHEN 'POS' THEN score WHEN 'NEG' THEN -score ELSE 0.0 END"

_NEWS = """
news AS (
  SELECT doc_id AS ordem, split_part(text, chr(10), 1) AS titulo,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS resumo,
         CASE WHEN doc_id % 11 = 0 THEN ''
              ELSE strftime(DATE '2024-01-01' + CAST((doc_id * 37) % 23 AS INTEGER), '%Y-%m-%d')
         END AS data_publicacao,
         'doc/' || doc_id AS link, source AS fonte,
         strftime(DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS data_coleta
  FROM documents)"""

_CLEAN = f""",
stripped AS (
  SELECT * REPLACE ({_strip("lower(coalesce(titulo, ''))")} AS titulo,
                    {_strip("lower(coalesce(resumo, ''))")} AS resumo) FROM news),
limpas AS (
  SELECT *, titulo || ' ' || resumo AS texto_completo, data_coleta AS data
  FROM stripped WHERE {_strip("titulo || ' ' || resumo")} <> '')"""

_PREDICTIONS = """,
predicoes AS (
  SELECT doc_id AS ordem, CASE WHEN toxic = 1 THEN 'NEG' WHEN quality = 1 THEN 'POS' ELSE 'NEU' END AS label,
         CASE WHEN toxic = 1 THEN 0.8 WHEN quality = 1 THEN 0.9 ELSE 0.6 END AS score
  FROM labels)"""


def _scored(source: str) -> str:
    return f""",
pontuadas AS (
  SELECT l.*, coalesce(p.label, 'NEU') AS label, CAST(coalesce(p.score, 0.6) AS DOUBLE) AS score
  FROM {source} l LEFT JOIN predicoes p USING (ordem))"""


def _frequency(source: str) -> str:
    return f""",
freq AS (
  SELECT data, termo, count(*) AS frequencia
  FROM (SELECT data, unnest(list_distinct({_tokens('texto_completo')})) AS termo FROM {source})
  GROUP BY ALL)"""


def _tfidf(terms: str, sizes: str, prefix: str = "") -> str:
    """CTEs ending in ``tfidf(lote, termo, tfidf_score)``."""
    return f""",
ocorrencias AS ({terms}),
tamanhos AS ({sizes}),
contagem AS (SELECT lote, termo, count(*) AS c FROM ocorrencias GROUP BY ALL),
vocabulario AS (
  SELECT lote, termo FROM contagem
  QUALIFY row_number() OVER (PARTITION BY lote ORDER BY c DESC, termo) <= {CONFIG.max_features}),
tf AS (SELECT lote, doc, termo, count(*) AS tf FROM ocorrencias JOIN vocabulario USING (lote, termo) GROUP BY ALL),
dft AS (SELECT lote, termo, count(*) AS df FROM tf GROUP BY ALL),
pesos AS (
  SELECT lote, doc, termo, n, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w
  FROM tf JOIN dft USING (lote, termo) JOIN tamanhos USING (lote) WHERE n >= {CONFIG.min_corpus}),
normas AS (SELECT lote, doc, sqrt(sum(w * w)) AS norma FROM pesos GROUP BY ALL),
tfidf AS (
  SELECT lote, termo, sum(w / norma) / any_value(n) AS tfidf_score
  FROM pesos JOIN normas USING (lote, doc) GROUP BY lote, termo)"""


def _doc_tfidf(source: str, batch: str = "data") -> str:
    return _tfidf(f"SELECT {batch} AS lote, ordem AS doc, unnest({_terms('texto_completo')}) AS termo FROM {source}",
                  f"SELECT {batch} AS lote, count(*) AS n FROM {source} GROUP BY 1")


def _emergence(source: str) -> str:
    return f""",
historico AS (
  SELECT *, avg(frequencia) OVER w AS m, stddev_samp(frequencia) OVER w AS s FROM {source}
  WINDOW w AS (PARTITION BY termo ORDER BY CAST(data AS DATE)
               RANGE BETWEEN INTERVAL {CONFIG.history_days} DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING)),
emergencia AS (
  SELECT data, termo, frequencia,
         CASE WHEN m IS NULL THEN CAST(frequencia AS DOUBLE) ELSE (frequencia - m) / (s + 1e-6) END AS z_score,
         CASE WHEN m IS NULL THEN NULL
              ELSE coalesce((frequencia - m) / (s + 1e-6) >= {CONFIG.z_threshold}, false) END AS emergente
  FROM historico)"""


def _pairs(source: str) -> str:
    """CTEs ending in ``pares(lote, i, j, sim)``: all similar row pairs i < j by brute force."""
    return f""",
titulos AS (SELECT data_coleta AS lote, ordem, link, data_publicacao AS pub, {_terms('titulo')} AS ts FROM {source}),
ttf AS (SELECT lote, ordem, termo, count(*) AS tf FROM (SELECT lote, ordem, unnest(ts) AS termo FROM titulos) GROUP BY ALL),
tn AS (SELECT lote, count(*) AS n FROM titulos GROUP BY lote),
tdf AS (SELECT lote, termo, count(*) AS df FROM ttf GROUP BY ALL),
tw AS (SELECT lote, ordem, termo, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS w
       FROM ttf JOIN tdf USING (lote, termo) JOIN tn USING (lote)),
tv AS (SELECT lote, ordem, termo, w / sqrt(sum(w * w) OVER (PARTITION BY lote, ordem)) AS w FROM tw),
pares AS (
  SELECT lote, i, j, sim FROM (
    SELECT a.lote, a.ordem AS i, b.ordem AS j, round(sum(a.w * b.w), 9) AS sim
    FROM tv a JOIN tv b ON a.lote = b.lote AND a.termo = b.termo AND a.ordem < b.ordem
    GROUP BY ALL) WHERE sim >= {CONFIG.similarity})"""


_GREEDY = """,
mais_velha AS (
  SELECT p.*, (a.pub <> '' AND b.pub <> '' AND b.pub < a.pub) AS j_vence
  FROM pares p JOIN titulos a ON a.lote = p.lote AND a.ordem = p.i
               JOIN titulos b ON b.lote = p.lote AND b.ordem = p.j),
estado AS (
  SELECT 0 AS r, lote, ordem, 0 AS s FROM titulos
  UNION ALL
  SELECT e.r + 1, e.lote, e.ordem,
         CASE WHEN e.s <> 0 THEN e.s WHEN coalesce(k.morto, false) THEN -1
              WHEN coalesce(k.preso, false) THEN 0 ELSE 1 END
  FROM estado e LEFT JOIN (
    SELECT m.lote, m.j, bool_or(x.s = 1) AS morto, bool_or(x.s = 0) AS preso
    FROM mais_velha m JOIN estado x ON x.lote = m.lote AND x.ordem = m.i
    WHERE NOT m.j_vence GROUP BY ALL) k ON k.lote = e.lote AND k.j = e.ordem
  WHERE EXISTS (SELECT 1 FROM estado y WHERE y.s = 0)),
fim AS (SELECT lote, ordem, s = 1 AS ativa FROM estado WHERE r = (SELECT max(r) FROM estado)),
segunda AS (
  SELECT m.lote, m.i AS ordem, max(m.j) AS por
  FROM mais_velha m JOIN fim f ON f.lote = m.lote AND f.ordem = m.i
  WHERE f.ativa AND m.j_vence GROUP BY ALL),
primeira AS (
  SELECT m.lote, m.j AS ordem, max(m.i) AS por
  FROM mais_velha m JOIN fim f ON f.lote = m.lote AND f.ordem = m.i
                    JOIN fim g ON g.lote = m.lote AND g.ordem = m.j
  WHERE f.ativa AND NOT g.ativa AND NOT m.j_vence GROUP BY ALL),
removidas AS (SELECT * FROM segunda UNION ALL SELECT * FROM primeira),
unicas AS (
  SELECT l.* FROM limpas l WHERE NOT EXISTS (
    SELECT 1 FROM removidas r WHERE r.lote = l.data_coleta AND r.ordem = l.ordem))"""


def _matches(articles: str, words: str) -> str:
    return f""",
achados AS (
  SELECT t.data, t.termo, a.label, a.score, a.fonte
  FROM {words} t JOIN {articles} a ON a.data = t.data AND contains(a.texto_completo, t.termo))"""


def _by_term(source: str) -> str:
    return f""",
por_termo AS (
  SELECT data, termo, avg({_SIGNED}) AS sentimento_medio_termo,
         CASE WHEN count_if(label = 'NEG') >= greatest(count_if(label = 'NEU'), count_if(label = 'POS')) THEN 'NEG'
              WHEN count_if(label = 'NEU') >= count_if(label = 'POS') THEN 'NEU'
              ELSE 'POS' END AS sentimento_predominante_termo,
         string_agg(DISTINCT fonte, ',' ORDER BY fonte) AS fontes
  FROM {source} GROUP BY data, termo)"""


def _gold1(lexicon) -> str:
    return f""",
g1 AS (
  SELECT e.data, e.termo, e.frequencia, round(coalesce(t.tfidf_score, 0.0), 12) AS tfidf_score,
         e.z_score, e.emergente, {_theme('e.termo', lexicon)} AS tema,
         coalesce(s.sentimento_medio_termo, 0.0) AS sentimento_medio_termo,
         coalesce(s.sentimento_predominante_termo, 'NEU') AS sentimento_predominante_termo,
         coalesce(s.fontes, '') AS fontes
  FROM emergencia e LEFT JOIN tfidf t ON t.lote = e.data AND t.termo = e.termo
                    LEFT JOIN por_termo s ON s.data = e.data AND s.termo = e.termo)"""


def _gold2(source: str, column: str, lexicon) -> str:
    return f""",
g2 AS (
  SELECT tema AS tema_noticia, avg(score) AS sentimento_medio, count(score) AS qtd_noticias, data, tema,
         count_if(label = 'POS') / count(*) AS pct_positivo, count_if(label = 'NEG') / count(*) AS pct_negativo,
         count_if(label = 'NEU') / count(*) AS pct_neutro
  FROM (SELECT *, {_theme(column, lexicon)} AS tema FROM {source}) GROUP BY data, tema)"""


_EVENTS = """
eventos AS (
  SELECT strftime(ts, '%Y-%m-%d') AS data, 'k' || json_extract_string(props, '$.k') AS termo,
         event_type AS fonte, user_id AS doc,
         CASE event_type WHEN 'purchase' THEN 'POS' WHEN 'error' THEN 'NEG' ELSE 'NEU' END AS label,
         abs(value) / (abs(value) + 10) AS score
  FROM events),
dias AS (SELECT data, termo, count(*) AS frequencia FROM eventos GROUP BY ALL)"""

_EVENT_GOLD = (
    _EVENTS + _emergence("dias")
    + _tfidf("SELECT data AS lote, doc, termo FROM eventos",
             "SELECT data AS lote, count(DISTINCT doc) AS n FROM eventos GROUP BY 1")
    + _by_term("eventos") + _gold1(EVENT_THEMES) + _gold2("eventos", "termo", EVENT_THEMES)
    + """,
hoje AS (SELECT * FROM g1 WHERE data = (SELECT max(data) FROM g1)),
hoje2 AS (SELECT * FROM g2 WHERE data = (SELECT max(data) FROM g2)),
contas AS (SELECT data, count(*) AS n FROM g1 GROUP BY data),
par AS (SELECT data, n, lag(data) OVER (ORDER BY data) AS d0, lag(n) OVER (ORDER BY data) AS n0 FROM contas
        QUALIFY row_number() OVER (ORDER BY data DESC) = 1),
itens AS (SELECT trim(x) AS fonte FROM (SELECT unnest(string_split(fontes, ',')) AS x FROM hoje) WHERE trim(x) <> '')""")

_WITH_NEWS = "WITH" + _NEWS + _CLEAN
_DEDUPED = "WITH RECURSIVE" + _NEWS + _CLEAN + _pairs("limpas") + _GREEDY
_SILVER = _DEDUPED + _PREDICTIONS + _scored("unicas")
_EV = "WITH" + _EVENT_GOLD + "\n"

# The daily run orders a batch by source and link, and scores with the word lists.
_ARRIVAL = _NEWS.replace(
    "SELECT doc_id AS ordem", "SELECT row_number() OVER (PARTITION BY doc_id % 30 ORDER BY source, 'doc/' || doc_id) AS ordem")
_RUN = ("WITH RECURSIVE" + _ARRIVAL + _CLEAN + _pairs("limpas") + _GREEDY + """,
acertos AS (SELECT *, HITS_P AS p, HITS_N AS n FROM unicas),
pontuadas AS (
  SELECT *, CASE WHEN p > n THEN 'POS' WHEN n > p THEN 'NEG' ELSE 'NEU' END AS label,
         CASE WHEN p + n = 0 THEN 1.0 WHEN p = n THEN 0.5 ELSE greatest(p, n) / (p + n) END AS score
  FROM acertos)""".replace("HITS_P", _hits(POSITIVE_WORDS)).replace("HITS_N", _hits(NEGATIVE_WORDS))
    + _frequency("unicas"))

_G1_COLUMNS = ("data, termo, frequencia, round(round(tfidf_score, 12), 6) AS tfidf_score, round(round(z_score, 12), 6) AS z_score, "
               "emergente, tema, round(round(sentimento_medio_termo, 12), 6) AS sentimento_medio_termo, "
               "sentimento_predominante_termo, fontes")
_G2_COLUMNS = ("tema_noticia, round(round(sentimento_medio, 12), 6) AS sentimento_medio, qtd_noticias, data, tema, "
               "round(round(pct_positivo, 12), 6) AS pct_positivo, round(round(pct_negativo, 12), 6) AS pct_negativo, "
               "round(round(pct_neutro, 12), 6) AS pct_neutro")


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_FILTER = (f"data >= '{FILTERED.inicio}' AND data <= '{FILTERED.fim}' AND tema IN {_list(FILTERED.temas)} "
           f"AND sentimento_predominante_termo IN {_list(FILTERED.sentimentos)} "
           f"AND list_has_any(string_split(fontes, ','), {_words(FILTERED.fontes)})")


def _kpis(source: str) -> str:
    return f"""
SELECT *, CASE WHEN sentimento_medio > 0.1 THEN 'positivo' WHEN sentimento_medio < -0.1 THEN 'negativo'
               ELSE 'neutro' END AS humor
FROM (SELECT count(*) AS linhas_no_periodo,
             round(round(avg(sentimento_medio_termo) FILTER (data = (SELECT max(data) FROM {source})), 12), 6) AS sentimento_medio,
             count(*) FILTER (emergente AND data = (SELECT max(data) FROM {source})) AS topicos_emergentes,
             count(DISTINCT tema) AS temas_ativos,
             count(*) FILTER (data = (SELECT max(data) FROM {source})) AS termos_hoje,
             count(DISTINCT data) AS dias_com_dados FROM {source})
WHERE linhas_no_periodo > 0"""


def _top(metric: str, k: int, where: str = "true") -> str:
    return f"(SELECT * FROM hoje WHERE {where} ORDER BY {metric} DESC NULLS LAST, termo LIMIT {k})"


def _ranked(metric: str, shown: str) -> str:
    return (f"SELECT data, termo, tema, {shown} AS {metric}, termo || ' [' || {_capital('tema')} || ']' AS rotulo "
            f"FROM {_top(metric, 10)}")


def _clean_shares(name: str, column: str) -> str:
    return (f"SELECT data, tema, {_capital('tema')} AS rotulo_tema, '{name}' AS sentimento, "
            f"round({column} * 100, 6) AS percentual, CASE WHEN {column} > 0.05 "
            f"THEN CAST(CAST(round_even({column} * 100, 0) AS INTEGER) AS VARCHAR) || '%' ELSE '' END AS texto FROM hoje2")


_LEXICON = _WITH_NEWS + f"""
SELECT ordem, CASE WHEN p > n THEN 'POS' WHEN n > p THEN 'NEG' ELSE 'NEU' END AS sentimento_label,
       round(CASE WHEN p + n = 0 THEN 1.0 WHEN p = n THEN 0.5 ELSE greatest(p, n) / (p + n) END, 6) AS sentimento_score
FROM (SELECT ordem, {_hits(POSITIVE_WORDS)} AS p, {_hits(NEGATIVE_WORDS)} AS n FROM limpas)"""
_FEED_ITEMS = "WITH" + _NEWS + """
SELECT titulo, regexp_replace(resumo, '<[^>]+>', '', 'g') AS resumo, data_publicacao, link, fonte, data_coleta FROM news"""

ORACLE: dict[str, str] = {
    "strip_html": "SELECT page_id, regexp_replace(coalesce(html, ''), '<[^>]+>', '', 'g') AS texto FROM pages",
    "clean_news": _WITH_NEWS + " SELECT ordem, titulo, resumo, texto_completo FROM limpas",
    "tokens": _WITH_NEWS + f"""
SELECT ordem, CAST(len(ts) AS INTEGER) AS n_tokens, array_to_string(ts, ' ') AS tokens
FROM (SELECT ordem, {_tokens('texto_completo')} AS ts FROM limpas)""",
    "document_frequency": _WITH_NEWS + _frequency("limpas") + " SELECT data, termo, frequencia FROM freq",
    "tfidf": _WITH_NEWS + _doc_tfidf("limpas")
        + " SELECT lote AS data, termo, round(round(tfidf_score, 12), 6) AS tfidf_score FROM tfidf",
    "tfidf_corpus": _WITH_NEWS + _doc_tfidf("limpas", "0")
        + " SELECT termo, round(round(tfidf_score, 12), 6) AS tfidf_score FROM tfidf",
    "similar_titles": _WITH_NEWS + _pairs("limpas") + """,
grupos AS (SELECT lote, min(ordem) AS ordem, count(*) AS copias FROM titulos WHERE len(ts) > 0
           GROUP BY lote, list_sort(ts))
SELECT p.lote AS data_coleta, p.i AS ordem_i, p.j AS ordem_j, a.copias AS copias_i, b.copias AS copias_j,
       round(round(p.sim, 12), 6) AS sim
FROM pares p JOIN grupos a ON a.lote = p.lote AND a.ordem = p.i JOIN grupos b ON b.lote = p.lote AND b.ordem = p.j""",
    "dedup_news": _DEDUPED + " SELECT data_coleta, ordem, link, titulo, data_publicacao FROM unicas",
    "dedup_audit": _DEDUPED + """
SELECT l.data_coleta, l.ordem, r.por IS NOT NULL AS duplicata, o.link AS duplicata_de
FROM limpas l LEFT JOIN removidas r ON r.lote = l.data_coleta AND r.ordem = l.ordem
LEFT JOIN limpas o ON o.data_coleta = r.lote AND o.ordem = r.por""",
    "publication_times": "WITH" + _NEWS + """
SELECT ordem, CASE WHEN data_publicacao <> '' THEN data_publicacao || ' 00:00:00' END AS publicado_em FROM news""",
    "theme_of_article": _WITH_NEWS + f" SELECT ordem, {_theme('texto_completo', DOCUMENT_THEMES)} AS tema FROM limpas",
    "lexicon_sentiment": _LEXICON,
    "lexicon_table_sentiment": _LEXICON,
    "prediction_sentiment": _WITH_NEWS + _PREDICTIONS + _scored("limpas") + f"""
SELECT ordem, label AS sentimento_label, score AS sentimento_score, {_SIGNED} AS pontuado FROM pontuadas""",
    "model_sentiment": _WITH_NEWS + """
SELECT ordem, CASE WHEN s > c THEN 'POS' WHEN c > s THEN 'NEG' ELSE 'NEU' END AS sentimento_label,
       round(greatest(s, c) / greatest(s + c, 1), 6) AS sentimento_score
FROM (SELECT ordem, length(texto_completo) - length(replace(texto_completo, '.', '')) AS s,
             length(texto_completo) - length(replace(texto_completo, ',', '')) AS c FROM limpas)""",
    "term_sentiment": _WITH_NEWS + _PREDICTIONS + _scored("limpas") + _frequency("limpas")
        + _matches("pontuadas", "freq") + _by_term("achados") + """
SELECT data, termo, round(round(sentimento_medio_termo, 12), 6) AS sentimento_medio_termo,
       sentimento_predominante_termo, fontes FROM por_termo""",
    "phrase_sentiment": _WITH_NEWS + _PREDICTIONS + _scored("limpas") + """,
frases AS (
  SELECT DISTINCT data, termo FROM (
    SELECT data, array_to_string(list_slice(string_split(titulo, ' '), 1, 2), ' ') AS termo FROM limpas)
  WHERE regexp_full_match(termo, '\\S+ \\S+'))""" + _matches("pontuadas", "frases") + _by_term("achados") + """
SELECT data, termo, round(round(sentimento_medio_termo, 12), 6) AS sentimento_medio_termo,
       sentimento_predominante_termo, fontes FROM por_termo""",
    "gold_topics": _SILVER + _frequency("unicas") + _doc_tfidf("unicas") + _emergence("freq")
        + _matches("pontuadas", "freq") + _by_term("achados") + _gold1(DOCUMENT_THEMES)
        + f" SELECT {_G1_COLUMNS} FROM g1",
    "gold_theme_sentiment": _SILVER + _gold2("pontuadas", "texto_completo", DOCUMENT_THEMES)
        + f" SELECT {_G2_COLUMNS} FROM g2",
    "source_counts": "SELECT source AS fonte, count(*) AS noticias FROM documents GROUP BY source",
    "run_counts": _DEDUPED + """
SELECT data_coleta, extraidas, coalesce(limpas, 0) AS limpas, coalesce(unicas, 0) AS unicas,
       extraidas - coalesce(limpas, 0) AS descartadas, coalesce(limpas, 0) - coalesce(unicas, 0) AS duplicatas
FROM (SELECT data_coleta, count(*) AS extraidas FROM news GROUP BY 1)
LEFT JOIN (SELECT data_coleta, count(*) AS limpas FROM limpas GROUP BY 1) USING (data_coleta)
LEFT JOIN (SELECT data_coleta, count(*) AS unicas FROM unicas GROUP BY 1) USING (data_coleta)""",
    "feed_items": _FEED_ITEMS,
    "atom_items": _FEED_ITEMS,
    "feed_failures": "WITH" + _NEWS + f"""
SELECT fonte, data_coleta, count(*) + any_value(q) AS itens, any_value(q) AS quebrados, CAST(0 AS BIGINT) AS sem_itens
FROM (SELECT *, CAST(CASE WHEN data_coleta LIKE '%{BROKEN_DAYS}' THEN 1 ELSE 0 END AS BIGINT) AS q FROM news) GROUP BY fonte, data_coleta""",
    "source_report": "WITH" + _NEWS + """,
cfg AS (SELECT k // 2 AS ordem_config, 'src' || k AS fonte, 'feeds/src' || k || '.xml' AS url FROM range(0, 40, 2) t(k)),
landed AS (SELECT fonte, count(DISTINCT data_coleta) AS dias, count(*) AS itens FROM news GROUP BY fonte)
SELECT fonte, ordem_config, url, coalesce(dias, 0) AS dias, coalesce(itens, 0) AS itens, CAST(0 AS BIGINT) AS quebrados,
       ordem_config IS NOT NULL AS configurada
FROM cfg FULL JOIN landed USING (fonte)""",
    "run_summary": _RUN + """
SELECT data, total_noticias, total_termos
FROM (SELECT data, count(*) AS total_noticias FROM pontuadas GROUP BY data)
JOIN (SELECT data, count(*) AS total_termos FROM freq GROUP BY data) USING (data)""",
    "incremental_run": _RUN + _doc_tfidf("unicas") + _emergence("freq") + _matches("pontuadas", "freq")
        + _by_term("achados") + _gold1(DOCUMENT_THEMES) + f" SELECT {_G1_COLUMNS} FROM g1",
    "upsert_result": _EV + f"""
SELECT {_G1_COLUMNS} FROM g1 WHERE data NOT IN ('{RERUN_DAY}', '{EMPTIED_DAY}')
UNION ALL SELECT {_G1_COLUMNS} FROM (SELECT * REPLACE (frequencia * 10 AS frequencia) FROM g1
                                     WHERE data = '{RERUN_DAY}' AND frequencia > 1)""",
    "baseline": "WITH" + _EVENTS + f"""
SELECT termo, round(round(avg(frequencia), 12), 6) AS media_frequencia, round(round(stddev_samp(frequencia), 12), 6) AS std_frequencia
FROM dias WHERE CAST(data AS DATE) >= DATE '{RUN_DAY}' - {CONFIG.history_days} AND CAST(data AS DATE) < DATE '{RUN_DAY}'
GROUP BY termo""",
    "emerging_terms": "WITH" + _EVENTS + f""",
base AS (SELECT termo, avg(frequencia) AS m, stddev_samp(frequencia) AS s FROM dias
         WHERE CAST(data AS DATE) >= DATE '{RUN_DAY}' - {CONFIG.history_days} AND CAST(data AS DATE) < DATE '{RUN_DAY}'
         GROUP BY termo)
SELECT termo, data, frequencia,
       round(CASE WHEN m IS NULL THEN CAST(frequencia AS DOUBLE) ELSE (frequencia - m) / (s + 1e-6) END, 6) AS z_score,
       CASE WHEN m IS NOT NULL THEN coalesce((frequencia - m) / (s + 1e-6) >= {CONFIG.z_threshold}, false) END AS emergente
FROM dias LEFT JOIN base USING (termo) WHERE data = '{RUN_DAY}'""",
    "emergence_backfill": "WITH" + _EVENTS + _emergence("dias")
        + " SELECT data, termo, frequencia, round(round(z_score, 12), 6) AS z_score, emergente FROM emergencia",
    "term_mode_label": "WITH" + _EVENTS + _by_term("eventos")
        + " SELECT data, termo, sentimento_predominante_termo FROM por_termo",
    "term_sources": "WITH" + _EVENTS + _by_term("eventos") + " SELECT data, termo, fontes FROM por_termo",
    "kpis": _EV + _kpis("g1"),
    "filtered_topics": _EV + f"SELECT {_G1_COLUMNS} FROM g1 WHERE {_FILTER}",
    "filtered_themes": _EV + f"""SELECT {_G2_COLUMNS} FROM g2
WHERE data >= '{FILTERED.inicio}' AND data <= '{FILTERED.fim}' AND tema IN {_list(FILTERED.temas)}""",
    "filtered_kpis": "WITH" + _EVENT_GOLD + f", gf AS (SELECT * FROM g1 WHERE {_FILTER})" + _kpis("gf"),
    "sentiment_over_time": _EV + "SELECT data, tema, round(round(sentimento_medio, 12), 6) AS sentimento_medio FROM g2",
    "sentiment_distribution": _EV + """
SELECT sentimento_predominante_termo,
       CASE sentimento_predominante_termo WHEN 'POS' THEN 'Positivo' WHEN 'NEG' THEN 'Negativo'
            WHEN 'NEU' THEN 'Neutro' ELSE sentimento_predominante_termo END AS rotulo,
       count(*) AS termos, round(count(*) / (SELECT count(*) FROM hoje), 6) AS parcela
FROM hoje GROUP BY 1""",
    "top_by_frequency": _EV + _ranked("frequencia", "frequencia"),
    "top_by_tfidf": _EV + _ranked("tfidf_score", "round(round(tfidf_score, 12), 6)"),
    "top_emerging": _EV + f"""
SELECT data, termo, tema, frequencia, round(round(z_score, 12), 6) AS z_score FROM {_top('z_score', 5, 'emergente')}""",
    "emerging_evolution": _EV + """
SELECT data, count(termo) AS termos, count(*) FILTER (emergente) AS emergentes FROM g1 GROUP BY data""",
    "theme_distribution": _EV + """
SELECT tema, count(termo) AS termos, CAST(sum(frequencia) AS BIGINT) AS frequencia_total FROM hoje GROUP BY tema""",
    "source_distribution": _EV + "SELECT fonte, count(*) AS contagem FROM itens GROUP BY fonte",
    "frequency_vs_z": _EV + """
SELECT termo, tema, frequencia, round(round(z_score, 12), 6) AS z_score, frequencia * 3 AS tamanho,
       coalesce(frequencia >= 5 AND z_score >= 2, false) AS quadrante_quente FROM hoje""",
    "theme_sentiment_shares": _EV + " UNION ALL ".join([
        _clean_shares("Positivo", "pct_positivo"), _clean_shares("Negativo", "pct_negativo"),
        _clean_shares("Neutro", "pct_neutro")]),
    "word_weights": _EV + f"""
SELECT termo, frequencia, round(frequencia / max(frequencia) OVER (), 6) AS peso FROM {_top('frequencia', 60)}""",
    "topic_table": _EV + f"""
SELECT termo, frequencia, round_even(tfidf_score, 4) AS tfidf_score, round_even(z_score, 2) AS z_score, tema,
       sentimento_predominante_termo,
       CASE WHEN coalesce(emergente, false) THEN 'emergente' WHEN sentimento_predominante_termo = 'POS' THEN 'positivo'
            WHEN sentimento_predominante_termo = 'NEG' THEN 'negativo' ELSE 'normal' END AS classe
FROM {_top('frequencia', 50)}""",
    "topic_summary": _EV + " UNION ALL ".join(
        f"SELECT '{kind}' AS tipo, termo, round(CAST({metric} AS DOUBLE), 6) AS valor FROM {_top(metric, 5, where)}"
        for kind, metric, where in (("frequencia", "frequencia", "true"), ("tfidf", "tfidf_score", "true"),
                                    ("emergente", "z_score", "emergente"))),
    "filter_options": _EV + f"""
SELECT 'tema' AS tipo, tema AS valor, {_capital('tema')} AS rotulo FROM (SELECT DISTINCT tema FROM g1)
UNION ALL
SELECT 'fonte', f, {_capital('f')} FROM (SELECT DISTINCT trim(x) AS f FROM
  (SELECT unnest(string_split(fontes, ',')) AS x FROM g1)) WHERE f <> ''
UNION ALL SELECT 'data_minima', min(data), min(data) FROM g1
UNION ALL SELECT 'data_maxima', max(data), max(data) FROM g1""",
    "day_over_day": _EV + """
SELECT data, d0 AS data_anterior, n AS termos_hoje, n0 AS termos_ontem, n - n0 AS diferenca,
       CASE WHEN n > n0 THEN 'sobe' WHEN n < n0 THEN 'desce' ELSE 'igual' END AS direcao
FROM par WHERE d0 IS NOT NULL""",
    "insights": _EV + f"""
SELECT 'fonte_ativa' AS tipo, fonte AS chave, CAST(1 AS DOUBLE) AS valor FROM (SELECT DISTINCT fonte FROM itens)
UNION ALL SELECT 'sentimento', sentimento_predominante_termo, CAST(count(*) AS DOUBLE) FROM hoje GROUP BY 2
UNION ALL SELECT 'sentimento_pct', sentimento_predominante_termo,
                 round(count(*) / (SELECT count(*) FROM hoje) * 100, 6) FROM hoje GROUP BY 2
UNION ALL (SELECT 'tema_dominante', tema, round(sum(frequencia) / (SELECT sum(frequencia) FROM hoje) * 100, 6)
           FROM hoje GROUP BY tema ORDER BY sum(frequencia) DESC, tema LIMIT 1)
UNION ALL (SELECT 'mais_positivo', tema, round(round(sentimento_medio, 12), 6) FROM hoje2 ORDER BY sentimento_medio DESC, tema LIMIT 1)
UNION ALL (SELECT 'mais_negativo', tema, round(round(sentimento_medio, 12), 6) FROM hoje2 ORDER BY sentimento_medio, tema LIMIT 1)
UNION ALL SELECT 'emergentes', 'emergentes', CAST(count(*) AS DOUBLE) FROM hoje WHERE emergente HAVING count(*) > 0
UNION ALL SELECT 'emergentes', 'termos', CAST(count(*) AS DOUBLE) FROM hoje HAVING bool_or(emergente)
UNION ALL SELECT 'emergente_top', termo, round(round(z_score, 12), 6) FROM {_top('z_score', 3, 'emergente')}
UNION ALL SELECT 'volume', 'hoje', CAST(n AS DOUBLE) FROM par WHERE d0 IS NOT NULL
UNION ALL SELECT 'volume', 'ontem', CAST(n0 AS DOUBLE) FROM par WHERE d0 IS NOT NULL
UNION ALL SELECT 'volume', CASE WHEN n > n0 THEN 'sobe' WHEN n < n0 THEN 'desce' ELSE 'igual' END,
                 CAST(n - n0 AS DOUBLE) FROM par WHERE d0 IS NOT NULL""",
}
