import pytest

from conftest import rows
from topicpulse.plans import products as pr
from topicpulse.plans.products import Filters
from topicpulse.schemas import GOLD_THEMES, GOLD_TOPICS

TOPICS = [
    ("2026-07-20", "governo", 4, 0.10, 4.0, None, "política", 0.3, "POS", "g1,folha"),
    ("2026-07-20", "time", 2, 0.20, 2.0, None, "esporte", -0.3, "NEG", "g1"),
    ("2026-07-21", "governo", 9, 0.12345, 3.456, True, "política", 0.4, "POS", "g1, folha"),
    ("2026-07-21", "copa", 9, 0.30, 2.5, True, "esporte", -0.25, "NEG", "folha"),
    ("2026-07-21", "sol", 1, 0.05, None, False, "outros", 0.0, "NEU", ""),
]
THEMES = [("política", 0.8, 3, "2026-07-21", "política", 2 / 3, 1 / 3, 0.0),
          ("esporte", 0.8, 20, "2026-07-21", "esporte", 0.95, 0.05, 0.0),
          ("outros", 0.5, 1, "2026-07-20", "outros", 0.0, 0.0, 1.0)]


@pytest.fixture(scope="module")
def g1(spark):
    return spark.createDataFrame(TOPICS, GOLD_TOPICS).persist()


@pytest.fixture(scope="module")
def g2(spark):
    return spark.createDataFrame(THEMES, GOLD_THEMES).persist()


def test_kpis(g1):
    r = pr.kpis(g1).first()
    assert (r["linhas_no_periodo"], r["topicos_emergentes"], r["temas_ativos"], r["termos_hoje"],
            r["dias_com_dados"], r["humor"]) == (5, 2, 3, 3, 2, "neutro")
    assert r["sentimento_medio"] == pytest.approx(0.05)
    assert pr.kpis(g1, Filters(temas=["nenhum"])).isEmpty()
    # The last day is the last one that passes the filters.
    assert pr.kpis(g1, Filters(fim="2026-07-20")).first()["termos_hoje"] == 2


def test_filters(g1, g2):
    def terms(**kw):
        return sorted(r["termo"] for r in Filters(**kw).topics(g1).collect())

    assert terms(inicio="2026-07-21") == ["copa", "governo", "sol"]
    assert terms(temas=["esporte"], sentimentos=["NEG"]) == ["copa", "time"]
    assert terms(fontes=["folha"]) == ["copa", "governo"]  # " folha" after a blank is another item
    assert len(rows(Filters(fontes=["g1"], temas=["política"]).themes(g2))) == 1


def test_rankings(g1):
    assert [r["termo"] for r in pr.top_terms(g1).collect()] == ["copa", "governo", "sol"]
    top = pr.top_terms(g1, "tfidf_score", 1).first()
    assert (top["termo"], top["rotulo"]) == ("copa", "copa [Esporte]")
    assert [r["termo"] for r in pr.top_emerging(g1).collect()] == ["governo", "copa"]
    table = {r["termo"]: r for r in pr.topic_table(g1).collect()}
    assert (table["governo"]["tfidf_score"], table["governo"]["z_score"]) == (0.1234, 3.46)
    assert (table["governo"]["classe"], table["sol"]["classe"]) == ("emergente", "normal")
    assert [r["peso"] for r in pr.word_weights(g1, 2).collect()] == [1.0, 1.0]
    assert [tuple(r)[:2] for r in pr.topic_summary(g1, 1).collect()] == [
        ("frequencia", "copa"), ("tfidf", "copa"), ("emergente", "governo")]


def test_distributions(g1, g2):
    assert rows(pr.theme_distribution(g1)) == [("outros", 1, 1), ("esporte", 1, 9), ("política", 1, 9)]
    assert rows(pr.source_distribution(g1)) == [("folha", 2), ("g1", 1)]
    assert rows(pr.emerging_evolution(g1)) == [("2026-07-20", 2, 0), ("2026-07-21", 3, 2)]
    dist = rows(pr.sentiment_distribution(g1))
    assert [r[:3] for r in dist] == [("NEG", "Negativo", 1), ("NEU", "Neutro", 1), ("POS", "Positivo", 1)]
    shares = {(r["tema"], r["sentimento"]): (r["percentual"], r["texto"]) for r in pr.theme_sentiment_shares(g2).collect()}
    assert shares["esporte", "Positivo"] == (pytest.approx(95.0), "95%") and shares["esporte", "Negativo"][1] == ""
    assert len(shares) == 6
    points = {r["termo"]: r for r in pr.frequency_vs_z(g1).collect()}
    assert points["copa"]["tamanho"] == 27 and points["copa"]["quadrante_quente"] and not points["sol"]["quadrante_quente"]
    assert [r[0] for r in rows(pr.sentiment_over_time(g2))] == ["2026-07-20", "2026-07-21", "2026-07-21"]


def test_filter_options(g1):
    got = {(r["tipo"], r["valor"]): r["rotulo"] for r in pr.filter_options(g1).collect()}
    assert got["tema", "política"] == "Política" and got["fonte", "g1"] == "G1"
    assert ("data_minima", "2026-07-20") in got and ("data_maxima", "2026-07-21") in got and len(got) == 7


def test_insights(g1, g2):
    got = {(r["tipo"], r["chave"]): r["valor"] for r in pr.insights(g1, g2).collect()}
    assert ("fonte_ativa", "folha") in got and got["sentimento", "POS"] == 1.0
    assert got["tema_dominante", "esporte"] == pytest.approx(900 / 19)
    assert ("mais_positivo", "esporte") in got and ("mais_negativo", "esporte") in got
    assert got["emergentes", "emergentes"] == 2.0 and got["emergente_top", "governo"] == 3.456
    assert got["volume", "sobe"] == 1.0 and got["volume", "ontem"] == 2.0
    assert pr.insights(g1.limit(0), g2.limit(0)).isEmpty()
