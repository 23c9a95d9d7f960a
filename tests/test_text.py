import unicodedata

from pyspark.sql import functions as F

from conftest import rows
from topicpulse.config import PORTUGUESE_STOPWORDS, Config
from topicpulse.functions import dates, labels, text as tx
from topicpulse.functions.themes import categorize
from topicpulse.operators.clean import arrival_order, clean_news, news_tokens
from topicpulse.operators.terms import document_frequency


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr.alias("r")).first()["r"]


def tokens(spark, value, stop=()):
    return one(spark, value, tx.filter_tokens(tx.tokenize(F.col("t")), stop))


def test_clean(spark):
    data = [("  Notícia IMPORTANTE  ", "  Resumo DETALHADO  "), (None, "Notícia"), ("válido", None),
            ("", ""), ("  ", " \n "), (" Título ", "b")]
    out = clean_news(spark.createDataFrame(data, "titulo string, resumo string"))
    assert [r["texto_completo"] for r in out.collect()] == [
        "notícia importante resumo detalhado", " notícia", "válido ", "título b"]
    assert out.columns == ["titulo", "resumo", "texto_completo"]


def test_strip_knows_every_space(spark):
    spaces = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
    assert one(spark, f"{spaces}a{spaces}b{spaces}", tx.strip(F.col("t"))) == f"a{spaces}b"


def test_strip_html(spark):
    assert one(spark, "<p>Outro &amp; <b>resumo</b></p>", tx.strip_html(F.col("t"))) == "Outro &amp; resumo"
    assert one(spark, None, tx.strip_html(F.col("t"))) == ""


def test_tokens_are_whole_chunks(spark):
    got = tokens(spark, "O guarda-chuva, d'água e 5g: a.b sol.chuva 1,5 reais; ação(nova) fim... mar--rio céu. Vento")
    assert got == ["reais", "ação", "nova", "fim", "mar", "rio", "céu", "vento"]
    assert tokens(spark, "preço,10 preço,alto hora:30") == ["preço", "alto"]
    assert tokens(spark, "notícia 123 sobre futebol") == ["notícia", "sobre", "futebol"]
    assert tokens(spark, None) == []


def test_stopwords(spark):
    text = "O presidente disse que a economia vai bem segundo analistas"
    stop = PORTUGUESE_STOPWORDS | {"segundo", "disse"}
    assert tokens(spark, text, stop) == ["presidente", "economia", "vai", "bem", "analistas"]
    # The token is folded, the list is not: an accented entry only works with fold.
    tok = tx.tokenize(F.col("t"))
    assert one(spark, "também", tx.filter_tokens(tok, ["também"])) == ["também"]
    assert one(spark, "também", tx.filter_tokens(tok, ["tambem"])) == []
    assert one(spark, "também", tx.filter_tokens(tok, ["também"], fold=True)) == []


def test_fold_accents_equals_nfkd(spark):
    alphabet = "".join(chr(i) for i in range(ord("à"), ord("ü") + 1)) + "abcxyz"
    want = unicodedata.normalize("NFKD", alphabet).encode("ascii", "ignore").decode()
    assert one(spark, alphabet, tx.fold_accents(F.col("t"))) == want


def test_document_frequency(spark):
    df = spark.createDataFrame([(["gato", "cachorro", "gato"],), (["gato", "pássaro"],),
                                (["cachorro", "peixe"],)], "tokens array<string>")
    assert dict(rows(document_frequency(df))) == {"gato": 2, "cachorro": 2, "pássaro": 1, "peixe": 1}


def test_news_tokens_column(spark):
    df = spark.createDataFrame([("o gato e o cão",)], "texto_completo string")
    assert news_tokens(df, Config()).first()["tokens"] == ["gato", "cão"]


def test_arrival_order_sorts_by_source_then_link(spark):
    df = spark.createDataFrame([("b", "1"), ("a", "2"), ("a", "10"), ("ab", "0")], "fonte string, link string")
    got = [(r["fonte"], r["link"]) for r in arrival_order(df).orderBy("ordem").collect()]
    assert got == [("a", "10"), ("a", "2"), ("ab", "0"), ("b", "1")]


def test_themes(spark):
    def theme(v, **kw):
        return one(spark, v, categorize(F.col("t"), **kw))

    assert theme("presidente") == theme("governo federal") == "política"
    assert theme("Inflação") == theme("mercado financeiro") == "economia"
    assert theme("receita de bolo") == theme("clima hoje") == "outros"
    assert theme("sentimento") == "esporte" and theme("suspeito") == "saúde"
    assert theme("sentimento", mode="word") == "outros" and theme("o time", mode="word") == "esporte"
    assert theme("governo e copa") == "política"


def test_labels(spark):
    df = spark.createDataFrame([("POS", 0.9), ("NEG", 0.8), ("NEU", 0.7)], "l string, s double")
    assert [r[0] for r in df.select(labels.signed_score(F.col("l"), F.col("s"))).collect()] == [0.9, -0.8, 0.0]
    moods = spark.createDataFrame([(0.2,), (-0.2,), (0.1,), (None,)], "m double").select(labels.mood(F.col("m")))
    assert [r[0] for r in moods.collect()] == ["positivo", "negativo", "neutro", "neutro"]
    pct = spark.createDataFrame([(0.05,), (0.051,), (0.125,), (0.135,)], "p double")
    assert [r[0] for r in pct.select(labels.percent_text(F.col("p"))).collect()] == ["", "5%", "12%", "14%"]
    ties = spark.createDataFrame([(1, 1, 1), (0, 2, 2), (0, 1, 2)], "a long, b long, c long")
    assert [r[0] for r in ties.select(labels.predominant(F.col("a"), F.col("b"), F.col("c"))).collect()] == [
        "NEG", "NEU", "POS"]
    assert one(spark, "inteligência Artificial", tx.capitalize(F.col("t"))) == "Inteligência artificial"


def test_publication_times(spark):
    data = ["2026-07-19", "2026-07-19T10:00:00Z", "Sun, 19 Jul 2026 10:00:00 GMT",
            "Sun, 19 Jul 2026 10:00:00 -0300", "", "ontem", None]
    df = spark.createDataFrame([(d,) for d in data], "t string")
    got = [r[0] for r in df.select(F.date_format(dates.publication_time(F.col("t")), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2026-07-19 00:00", "2026-07-19 10:00", "2026-07-19 10:00", "2026-07-19 13:00", None, None, None]


def test_config_keys(tmp_path):
    path = tmp_path / "c.json"
    path.write_text('{"fontes_rss": [{"nome": "a", "url": "u"}], "stopwords_customizadas": ["x", "x"],'
                    '"janela_historica_dias": 7, "corpus_minimo_tfidf": 3}', encoding="utf-8")
    c = Config.load(str(path))
    assert (c.sources, c.custom_stopwords, c.history_days, c.min_corpus) == ((("a", "u"),), {"x"}, 7, 3)
    assert (c.similarity, c.z_threshold, c.max_features) == (0.75, 2.0, 200)
    assert "x" in c.stopwords and "estávamos" in c.stopwords and len(PORTUGUESE_STOPWORDS) > 150
