import pytest
from pyspark.sql import functions as F

from conftest import rows
from topicpulse.config import THEME_KEYWORDS
from topicpulse.operators.containment import any_term_matches, term_matches
from topicpulse.operators.sentiment import (
    compute_sentiment, lexicon_scorer, lexicon_table_scorer, model_scorer, prediction_scorer,
)
from topicpulse.operators.term_sentiment import term_sentiment
from topicpulse.plans.gold import gold_themes, gold_topics
from topicpulse.schemas import GOLD_THEMES, GOLD_TOPICS

KNOWN = {"chove forte no litoral": ("NEG", {"NEG": 0.71, "POS": 0.09, "NEU": 0.20}),
         "a safra bateu recorde": ("POS", {"POS": 0.88, "NEG": 0.04, "NEU": 0.08}),
         "abre segunda a biblioteca": ("NEU", {"NEU": 0.77, "POS": 0.15, "NEG": 0.08})}


def test_model_scorer(spark):
    known = dict(KNOWN)

    def factory():
        unknown = ("NEG", {"NEG": 0.45, "POS": 0.25, "NEU": 0.30})
        return lambda texts: [known[t] if t in known else unknown for t in texts]

    df = spark.createDataFrame([(t,) for t in [*KNOWN, None]], "texto_completo string")
    out = compute_sentiment(df, model_scorer(factory))
    assert out.columns == ["texto_completo", "sentimento_label", "sentimento_score"]
    assert {r[1:] for r in rows(out)} == {("POS", 0.88), ("NEG", 0.71), ("NEU", 0.77), ("NEG", 0.45)}


def test_lexicon_and_prediction_scorers(spark):
    df = spark.createDataFrame([(0, "bom bom ruim"), (1, "ruim."), (2, "bom ruim"), (3, "nada")],
                               "id long, texto_completo string")
    out = lexicon_scorer(["bom"], ["ruim"])(df)
    assert [r[2:] for r in sorted(rows(out))] == [("POS", 2 / 3), ("NEG", 1.0), ("NEU", 0.5), ("NEU", 1.0)]
    words = spark.createDataFrame([("bom", 1), ("ruim", -1)], "palavra string, polaridade int")
    assert sorted(rows(lexicon_table_scorer(words, "id")(df))) == sorted(rows(out))
    table = spark.createDataFrame([(0, "NEG", 0.7)], "id long, sentimento_label string, sentimento_score double")
    out = prediction_scorer(table, "id")(df).select("id", "sentimento_label", "sentimento_score")
    assert sorted(rows(out))[:2] == [(0, "NEG", 0.7), (1, "NEU", 0.6)]


TEXTS = ["governo anuncia pacote", "o sentimento do time", "desgovernado: time-maço", "",
         "inteligência artificial e inteligência", "computadoresportáteis na nuvem", "aaaaaaaaaaaaab aaa"]
TERMS = ["governo", "time", "sentimento", "pacote", "nuvem", "computadores", "computadoresportáteis",
         "portáteis", "aaaaaaaaa", "aaaaaaaab", "ausente", "inteligência", "govern", "maço"]


@pytest.mark.parametrize("kind", ["letters", "any"])
def test_matches_equal_contains(spark, kind):
    terms = TERMS + (["inteligência artificial", "a", "do time", "time-maço", "l e"] if kind == "any" else [])
    articles = spark.createDataFrame(list(enumerate(TEXTS)), "id long, texto_completo string")
    table = spark.createDataFrame([(t,) for t in terms], "termo string")
    match = term_matches if kind == "letters" else any_term_matches
    out = match(articles, table, ["id"])
    want = {(i, t) for i, text in enumerate(TEXTS) for t in terms if t in text}
    got = [(r["id"], r["termo"]) for r in out.collect()]
    assert set(got) == want and len(got) == len(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


ARTICLES = [("d", 0, "governo anuncia pacote", "POS", 0.9, "g"), ("d", 1, "governo cai", "NEG", 0.8, "f"),
            ("d", 2, "time vence", "POS", 0.5, "f"), ("d", 3, "time perde", "NEG", 0.5, "f"),
            ("e", 0, "governo volta", "NEU", 0.4, "h")]
ARTICLE = ("data string, ordem long, texto_completo string, sentimento_label string, "
           "sentimento_score double, fonte string")


def test_term_sentiment(spark):
    articles = spark.createDataFrame(ARTICLES, ARTICLE)
    terms = spark.createDataFrame([("d", "governo"), ("d", "time"), ("d", "nada"), ("e", "governo")],
                                  "data string, termo string")
    got = {r[:2]: r[2:] for r in rows(term_sentiment(articles, terms))}
    assert got == {("d", "governo"): (pytest.approx(0.05), "NEG", "f,g"), ("d", "time"): (0.0, "NEG", "f"),
                   ("e", "governo"): (0.0, "NEU", "h")}
    bare = term_sentiment(articles.drop("fonte"), terms).filter("data = 'e'").first()
    assert bare["fontes"] == "desconhecida"


def test_gold_tables(spark):
    articles = spark.createDataFrame(ARTICLES, ARTICLE)
    emerging = spark.createDataFrame(
        [("d", "governo", 2, 3.0, True), ("d", "sol", 1, 1.0, None)],
        "data string, termo string, frequencia long, z_score double, emergente boolean")
    weights = spark.createDataFrame([("d", "governo", 0.5)], "data string, termo string, tfidf_score double")
    g1 = gold_topics(emerging, weights, term_sentiment(articles, emerging), THEME_KEYWORDS)
    assert g1.columns == GOLD_TOPICS.names
    assert sorted(rows(g1)) == [
        ("d", "governo", 2, 0.5, 3.0, True, "política", pytest.approx(0.05), "NEG", "f,g"),
        ("d", "sol", 1, 0.0, 1.0, None, "outros", 0.0, "NEU", "")]
    g2 = gold_themes(articles, THEME_KEYWORDS)
    assert g2.columns == GOLD_THEMES.names
    got = {(r["data"], r["tema"]): r for r in g2.collect()}
    assert got["d", "política"]["sentimento_medio"] == pytest.approx(0.85)  # unsigned
    assert got["d", "política"]["pct_negativo"] == 0.5 and got["d", "esporte"]["qtd_noticias"] == 2


def test_matches_by_blocks(spark, monkeypatch):
    """Many blocks and buckets, a word and a term longer than a window: as a plain search, and no row per
    (article, word, term) is shuffled: the search ends in one row per article."""
    from topicpulse.operators import containment

    monkeypatch.setattr(containment, "BLOCK_CHARS", 300)
    monkeypatch.setattr(containment, "BUCKET_CHARS", 200)
    monkeypatch.setattr(containment, "STEP_PAIRS", 7)
    long = "abcdefghij" * 5
    texts = [f"casa{i % 7} {long[i % 11:]} Casamento do Time {i % 3} ção aba{'ba' * (i % 5)}" for i in range(60)]
    terms = ["casa", "cas", "ment", long, long[3:40], long[:26] + "zz", "ção", "bab", "ababa", "ime"]
    phrases = [*terms, "do time", "time 1", "o t", "a"]
    rows_in = [("x" if i % 2 else "y", i, t) for i, t in enumerate(texts)]
    articles = spark.createDataFrame([*rows_in, (None, 99, "casa")], "data string, id long, texto_completo string")
    for match, wanted in ((term_matches, terms), (any_term_matches, phrases)):
        table = spark.createDataFrame([(d, t) for d in "xy" for t in wanted], "data string, termo string")
        got = [tuple(r) for r in match(articles, table, ["id"], ["data"]).collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(d, i, t) for d, i, text in rows_in for t in wanted if t in text.lower()}
    out = term_matches(articles, table.filter("length(termo) > 2 and not contains(termo, ' ')"), ["id"], ["data"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "SortMergeJoin" not in plan and plan.count("FlatMapCoGroupsInArrow") >= 2
