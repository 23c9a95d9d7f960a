"""What travels and what is stored grows with the input, not with the terms or pairs made from it."""

import pytest
from pyspark.sql import functions as F

from topicpulse.operators import similarity

from test_dedup import SCHEMA, WORDS, cosine, grouped, random_news, vectors


def _stored(monkeypatch, module):
    """Rows of every table that a module stores."""
    rows, plain = [], module.cut_lineage

    def count(df):
        out = plain(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(module, "cut_lineage", count)
    return rows


def test_a_title_vector_is_stored_as_one_row(spark, monkeypatch):
    rows = _stored(monkeypatch, similarity)
    data = [("d", i, " ".join(f"g{i // 3}w{j}" for j in range(40)) + f" own{i}", "", f"l{i}") for i in range(60)]
    keyed = similarity.with_title_key(spark.createDataFrame(data, SCHEMA))
    pairs = similarity.similar_groups(keyed, "data_coleta", 0.75).count()
    assert pairs == 60 and max(rows) == 60  # a row per term would be 2460, per term of a pair as many


@pytest.mark.parametrize("block,chunk_chars", [(20_000, 24 << 20), (2, 40)])
def test_products_in_cells_of_chunks_equal_brute_force(spark, block, chunk_chars):
    data = random_news(19, 40, WORDS, 5)
    want = {}
    for b, batch in grouped(data).items():
        vec = vectors([r[2] for r in batch])
        for i, a in enumerate(batch):
            for j, c in enumerate(batch):
                if a[1] < c[1] and vec[i] and vec[i].keys() and cosine(vec[i], vec[j]) >= 0.6:
                    want[b, a[1], c[1]] = cosine(vec[i], vec[j])
    keyed = similarity.with_title_key(spark.createDataFrame(data, SCHEMA))
    pairs = similarity.similar_groups(keyed, "data_coleta", 0.6, block=block, chunk_chars=chunk_chars)
    row = keyed.select("data_coleta", "ordem", "grupo")
    named = (pairs.join(row.withColumnsRenamed({"grupo": "grupo_i", "ordem": "i"}), ["data_coleta", "grupo_i"])
             .join(row.withColumnsRenamed({"grupo": "grupo_j", "ordem": "j"}), ["data_coleta", "grupo_j"]))
    got = {(r["data_coleta"], r["a"], r["b"]): r["sim"] for r in named.select(
        "data_coleta", F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "sim").collect()}
    copies = {k for k, v in want.items() if k not in got}
    assert all(want[k] == pytest.approx(1.0) for k in copies)  # copies of a vector are one group
    assert {k: round(v, 8) for k, v in got.items()} == {k: round(v, 8) for k, v in want.items() if k in got} and got


def test_long_and_short_posting_lists_give_the_same_pairs(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(5)
    n = 300
    cell = np.sort(rng.integers(0, 6, n))
    side = rng.integers(-1, 2, n).astype(np.int8)
    side = np.where(cell % 2 == 0, -1, np.abs(side)).astype(np.int8)
    peso, rest = rng.random(n), rng.random(n)
    norms = rng.random((n, similarity.SLOTS)).astype(np.float32) / 4
    args = (cell, side, peso, rest, norms, 0.5)
    found = []
    for short, tile in ((64, 512), (512, 512), (1, 7)):
        monkeypatch.setattr(similarity, "SHORT_LIST", short)
        monkeypatch.setattr(similarity, "TILE", tile)
        found.append({tuple(sorted(p)) for p in zip(*(x.tolist() for x in similarity._near(*args)))})
    assert found[0] == found[1] == found[2] and found[0]


def test_a_phrase_is_sought_at_starts_and_ends_of_words_only():
    import pyarrow as pa

    from topicpulse.operators import containment as c

    words = ["abcdefghij", "xyzuvw", "ab"]
    row = pa.RecordBatch.from_arrays(
        [pa.array(["l"]), pa.array([0]), pa.array([3]), pa.array([c._squeeze("\n".join(words).encode())])],
        names=["_lote", "_fatia", "_baldes", "_palavras"])

    def sent(*modes):
        out = [(m, w) for b in c._cut(1, modes)([row]) for m, x in zip(b.column(2).to_pylist(), b.column(5).to_pylist())
               for w in c._names(x)]
        return sorted(w for _, w in out if len(w) >= c.HEAD_CHARS)

    assert sent(c.START) == ["abcdefghij", "xyzuvw"]
    assert sent(c.END) == ["jihgfedcba", "wvuzyx"]
    assert len(sent(c.ANYWHERE)) == 8 + 4


def test_phrases_over_blanks_and_word_parts_equal_a_plain_search(spark, monkeypatch):
    from topicpulse.operators import containment as c

    monkeypatch.setattr(c, "BLOCK_CHARS", 60)
    monkeypatch.setattr(c, "BUCKET_CHARS", 40)
    monkeypatch.setattr(c, "WINDOW_CHARS", 6)
    texts = ["casa nova no alto", " casa  nova", "a casa\nnova", "grandecasa novamente vem", "vem\tnova casa", "", "ção é bom x",
             "longuissimapalavra curta", "umalonguissimapalavra curtas"]
    phrases = ["casa nova", "a n", "casa  nova", "a\nn", "sa no", "nova", "ova c", "\tnova", "ção é", "é bom x", "va no al",
               "longuissimapalavra curta", "a curta", "longuissimapalavro curta", " casa"]
    articles = spark.createDataFrame([(i, "d", t) for i, t in enumerate(texts)], "id long, data string, texto_completo string")
    terms = spark.createDataFrame([("d", p) for p in phrases], "data string, termo string")
    got = [(r["id"], r["termo"]) for r in c.any_term_matches(articles, terms, ["id"], ["data"]).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(i, p) for i, t in enumerate(texts) for p in phrases if p in t}


def test_a_search_stores_a_row_per_block(spark, monkeypatch):
    from topicpulse.operators import containment as c

    rows = _stored(monkeypatch, c)
    articles = spark.createDataFrame([(i, "d", f"casa{i} nova") for i in range(50)], "id long, data string, texto_completo string")
    terms = spark.createDataFrame([("d", "nova"), ("d", "nova")], "data string, termo string")
    assert c.term_matches(articles, terms, ["id"], ["data"]).count() == 50
    assert max(rows) == 1  # articles before


@pytest.mark.parametrize("name", ["dedup_news", "dedup_audit", "dropped_rows"])
def test_dedup_stores_rows_not_title_terms(spark, monkeypatch, name):
    from topicpulse.operators import dedup

    rows = _stored(monkeypatch, similarity)
    data = [("d", i, " ".join(f"g{i // 2}w{j}" for j in range(30)) + f" own{i}", "2024-01-02", f"l{i}") for i in range(40)]
    out = getattr(dedup, name)(spark.createDataFrame(data, SCHEMA), 0.75)
    left = {"dedup_news": 20, "dedup_audit": 40, "dropped_rows": 20}[name]
    assert out.count() == left and max(rows) == 40  # a row per term would be 1240
