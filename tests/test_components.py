"""Components of similar titles: one ordered pass for small ones, rounds for giant ones, both equal to the row rule."""

import time

import pytest

from topicpulse.operators.dedup import components, dedup_audit, dedup_news

from test_dedup import SCHEMA, WORDS, grouped, random_news, sequential


@pytest.mark.parametrize("component_rows", [0, 3, 20_000])
def test_components_and_rounds_equal_the_sequential_rule(spark, component_rows):
    data = [(f"x{r[0]}", *r[1:]) for r in random_news(11, 80)] + [
        (f"y{r[0]}", *r[1:]) for r in random_news(61, 80, WORDS[:3], 2)]  # arrival order is unique in a batch
    want = {(b, o): link for b, rows in grouped(data).items() for o, link in sequential(rows, 0.6).items()}
    df = spark.createDataFrame(data, SCHEMA)
    audit = dedup_audit(df, 0.6, slice_rows=2, block=3, component_rows=component_rows).collect()
    assert {(r["data_coleta"], r["ordem"]): r["duplicata_de"] for r in audit} == want
    left = {(r["data_coleta"], r["ordem"]) for r in dedup_news(df, 0.6, component_rows=component_rows).collect()}
    assert left == {k for k, v in want.items() if v is None}


def test_components_of_chains_and_stars(spark):
    edges = [("a", f"g{i:03d}", f"g{i + 1:03d}") for i in range(60)] + [("a", "h0", f"s{k}") for k in range(5)]
    edges += [("b", "g001", "g000")]
    both = edges + [(b, p, d) for b, d, p in edges]
    got = {(r.lote, r.grupo): r.comp for r in
           components(spark.createDataFrame(both, "lote string, de string, para string")).collect()}
    assert all(got[("a", f"g{i:03d}")] == "g000" for i in range(61))
    assert all(got[("a", f"s{k}")] == "h0" for k in range(5)) and got[("a", "h0")] == "h0"
    assert got[("b", "g000")] == got[("b", "g001")] == "g000"


def test_branching_titles_in_one_pass(spark, monkeypatch):
    """200 titles of sliding windows, each similar to several others."""
    from topicpulse.operators import dedup

    words = [f"termo{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(210)]
    rows = [("d", i, " ".join(words[i:i + 8]), f"2024-01-{1 + (i * 7) % 28:02d}", f"l{i}") for i in range(200)]
    rounds, plain = [], dedup._round
    monkeypatch.setattr(dedup, "_round", lambda *a: rounds.append(1) or plain(*a))
    start = time.time()
    kept = {r["ordem"] for r in dedup.dedup_news(spark.createDataFrame(rows, SCHEMA), 0.7).collect()}
    took = time.time() - start
    assert kept == {o for o, link in sequential(rows, 0.7).items() if link is None}
    assert not rounds
    print(f"200 branching titles: {took:.1f} s")


def test_candidates_come_once(spark):
    """Many distinct titles sharing words: each candidate pair is emitted once, at its rarest shared term."""
    from pyspark.sql import functions as F

    from topicpulse.operators.similarity import _candidates, title_groups, title_vectors, with_title_key

    words = [f"palavra{k}" for k in range(12)]
    rows = [("d", i, " ".join(words[(i * j) % 12] for j in range(1, 5)) + f" extra{i % 7}", "", f"l{i}")
            for i in range(300)]
    keyed = with_title_key(spark.createDataFrame(rows, SCHEMA))
    sizes = keyed.groupBy("data_coleta").agg(F.count(F.lit(1)).alias("_n"))
    vectors = title_vectors(title_groups(keyed, "data_coleta"), sizes, "data_coleta", 1).cache()
    for block in (20_000, 4):
        pairs = _candidates(vectors, "data_coleta", 0.5, block)
        assert pairs.count() == pairs.distinct().count() > 0


def test_vectors_grow_with_the_title_not_its_square(spark):
    """No list per position of a title: every row of a vector has one bound of fixed size, and it is a bound."""
    from pyspark.sql import functions as F

    from topicpulse.operators.similarity import SLOTS, title_groups, title_vectors, with_title_key

    rows = [("d", i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(60)), "", f"l{i}") for i in range(4)]
    keyed = with_title_key(spark.createDataFrame(rows, SCHEMA))
    sizes = keyed.groupBy("data_coleta").agg(F.count(F.lit(1)).alias("_n"))
    got = title_vectors(title_groups(keyed, "data_coleta"), sizes, "data_coleta", 1).collect()
    lists = {k: len(v) for r in got for k, v in r.asDict().items() if isinstance(v, list)}
    assert lists == {"normas": SLOTS}
    vectors, norms = {}, {}
    for r in got:
        vectors.setdefault(r["grupo"], {})[r["termo"]] = r["peso"]
        norms[r["grupo"]] = r["normas"]
    for a, va in vectors.items():
        for b, vb in vectors.items():
            cos = sum(w * vb.get(t, 0.0) for t, w in va.items())
            assert sum(x * y for x, y in zip(norms[a], norms[b])) >= cos - 1e-5
