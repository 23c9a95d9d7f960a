import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from topicpulse.operators.terms import tfidf
from topicpulse.operators.trends import baseline, day_over_day, emergence, emergence_backfill
from topicpulse.schemas import BASELINE, GOLD_TOPICS
from topicpulse.sources.tables import read_gold_topics

TODAY = "termo string, frequencia long"
DAYS = "data string, termo string, frequencia long"


def test_emergence_without_history(spark, tmp_path):
    base = baseline(read_gold_topics(spark, str(tmp_path / "none")), 14, "2026-07-20")
    assert base.columns == BASELINE.names and base.isEmpty()
    counts = [(f"termo{k}", 3 * k + 2) for k in range(6)]
    out = emergence(spark.createDataFrame(counts, TODAY), base, 2.0)
    # Without a baseline the score is the day's count and the flag is unknown.
    assert sorted(rows(out.select("termo", "z_score", "emergente"))) == sorted(
        (t, float(c), None) for t, c in counts)


def test_emergence_with_history(spark):
    """Scores against days of history computed here from their counts; one day has no deviation."""
    history = {"geada": [4, 6, 5, 9], "seca": [20, 22, 21], "orvalho": [3], "brisa": [7, 7, 7]}
    today = {"geada": 15, "seca": 22, "orvalho": 40, "brisa": 7, "tufao": 12}
    days = [(f"2024-03-{i + 1:02d}", t, c) for t, cs in history.items() for i, c in enumerate(cs)]
    base = baseline(spark.createDataFrame(days, DAYS), 14, "2024-03-10")
    got = {r["termo"]: r for r in emergence(spark.createDataFrame(list(today.items()), TODAY), base, 1.5).collect()}
    for term, c in today.items():
        seen = history.get(term)
        if seen is None:
            assert got[term]["z_score"] == float(c) and got[term]["emergente"] is None
        elif len(seen) == 1:
            assert got[term]["z_score"] is None and got[term]["emergente"] is False
        else:
            mean = sum(seen) / len(seen)
            std = math.sqrt(sum((x - mean) ** 2 for x in seen) / (len(seen) - 1))
            z = (c - mean) / (std + 1e-6)
            assert got[term]["z_score"] == pytest.approx(z) and got[term]["emergente"] == (z >= 1.5)
    assert got["geada"]["emergente"] and not got["seca"]["emergente"] and not got["brisa"]["emergente"]


def test_backfill_equals_the_daily_loop(spark):
    data = [(f"2024-01-{d:02d}", t, (d * 7 + len(t) * d * d) % 13 + 1)
            for d in range(1, 29) for t in ("a", "bb", "ccc") if (d * len(t)) % 4]
    df = spark.createDataFrame(data, DAYS)
    back = {(r["data"], r["termo"]): (r["z_score"], r["emergente"])
            for r in emergence_backfill(df, 5, 1.0).collect()}
    loop = {}
    for day in ("2024-01-01", "2024-01-02", "2024-01-09", "2024-01-28"):
        out = emergence(df.filter(F.col("data") == day).drop("data"), baseline(df, 5, day), 1.0)
        loop |= {(day, r["termo"]): (r["z_score"], r["emergente"]) for r in out.collect()}
    for key, (z, flag) in loop.items():
        assert back[key][1] == flag and back[key][0] == pytest.approx(z)
    assert len(back) == len(data)


def test_history_minimum(spark):
    df = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-02", "a", 3), ("2024-01-03", "a", 9)], DAYS)
    got = {r["data"]: r["emergente"] for r in emergence_backfill(df, 14, 2.0, min_history_days=2).collect()}
    assert got == {"2024-01-01": None, "2024-01-02": None, "2024-01-03": True}


def test_day_over_day(spark):
    df = spark.createDataFrame([("2024-01-01", "a", 1), ("2024-01-01", "b", 1), ("2024-01-05", "a", 1)], DAYS)
    assert rows(day_over_day(df)) == [("2024-01-05", "2024-01-01", 1, 2, -1, "desce")]
    assert day_over_day(df.filter("data = '2024-01-01'")).isEmpty()


def sequential_tfidf(docs, limit):
    bags = [Counter(re.findall(r"\w{2,}", d.lower())) for d in docs]
    total, df, n = Counter(), Counter(), len(docs)
    for b in bags:
        total.update(b)
        df.update(b.keys())
    kept = sorted(total, key=lambda t: (-total[t], t))[:limit]
    score = defaultdict(float)
    for b in bags:
        w = {t: b[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in kept if t in b}
        norm = math.sqrt(sum(x * x for x in w.values()))
        for t, x in w.items():
            score[t] += x / norm / n
    return score


@pytest.mark.parametrize("limit", [200, 5])
def test_tfidf_equals_the_sequential_rule(spark, limit):
    docs = ["o gato subiu no telhado hoje", "o cachorro correu no parque hoje hoje", "",
            "o gato e o cachorro são amigos hoje", "gato gato x 2024 x_y"]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, texto_completo string")
    got = dict(rows(tfidf(df, "id", min_corpus=2, max_features=limit)))
    assert got == pytest.approx(sequential_tfidf(docs, limit))


def test_tfidf_per_batch_and_guard(spark):
    data = [("d1", 0, "um documento"), ("d2", 0, "sol mar"), ("d2", 1, "mar")]
    df = spark.createDataFrame(data, "data string, id long, texto_completo string")
    out = tfidf(df, "id", by=["data"], min_corpus=2).collect()
    assert {(r["data"], r["termo"]) for r in out} == {("d2", "sol"), ("d2", "mar")}
    one = tfidf(df.filter("data = 'd1'"), "id", min_corpus=5)
    assert one.isEmpty() and one.columns == ["termo", "tfidf_score"]


def test_vocabulary_limit_runs_before_the_shuffle(spark):
    df = spark.createDataFrame([("d1", 0, "um documento")], "data string, id long, texto_completo string")
    plan = tfidf(df, "id", by=["data"], n_batches=1)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_gold_schema_has_string_day():
    assert GOLD_TOPICS["data"].dataType.simpleString() == "string"
