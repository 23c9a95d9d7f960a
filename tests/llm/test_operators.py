"""Every operator against its library, its SQL or a plain version, with odd rows among the inputs."""

import hashlib
import itertools
import os
import random
import sys
import zlib

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as contract
import check
import corpus_pipeline
from topicpulse.llm import (bpe, common, fingerprints, html_extract, line_dedup, lm_score, near_dedup, packing, quality,
                            substring_dedup, token_counts)

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["", None, " ", "a", "\n\n", "word", "é ß", "日本 語", "x" * 3000, "<|endoftext|> a", " \t lead", "a  b   c", "Ünï\x1cx", "  "]


def prose(rnd, n):
    return " ".join(rnd.choice(["the", "of", "and", "rain"]) if rnd.random() < 0.3 else
                    "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Exact copies, near copies, shared lines and passages, junk and odd texts."""
    rnd = random.Random(5)
    lines = [prose(rnd, rnd.randint(3, 70)) for _ in range(60)]
    shared = prose(rnd, 80)
    out = []
    for k in range(40):
        own = [rnd.choice(lines) for _ in range(rnd.randint(1, 4))] + [prose(rnd, rnd.randint(5, 60)) for _ in range(3)]
        if k % 5 == 0:
            own.append(prose(rnd, 12) + " " + shared + " " + prose(rnd, 9))
        rnd.shuffle(own)
        out.append("\n".join(own))
    for k in range(8):
        w = out[k].split(" ")
        w[len(w) // 2] = "edited"
        out.append(" ".join(w))
    return out + out[:6] + ["BAD!! " * 30, "Go Go Go Go " * 20, "a # b $ c | " * 20] + ODD


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_encoding_equals_library(docs, texts, spark):
    t = Tokenizer.from_file(public_tokenizers.path(bpe.MODEL))
    got, ids = by_id(bpe.round_trip(docs)), bpe.encoded(docs)
    plain, back = by_id(ids), by_id(bpe.decoded(ids))
    for i, x in enumerate(texts):
        want = t.encode(x or "", add_special_tokens=False).ids
        text = t.decode(want, skip_special_tokens=False)
        assert plain[i]["ids"] == want and back[i]["text"] == text == (x or "")
        assert got[i]["n_tokens"] == len(want)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encoding_of_long_and_random_texts():
    c, t = bpe.Codec(public_tokenizers.path(bpe.MODEL)), Tokenizer.from_file(public_tokenizers.path(bpe.MODEL))
    rnd = random.Random(1)
    bits = ["a", "the", " ", "  ", "\n", "é", "日", "😀", "'s", "0", "!!", "\xa0", "\x85", "\x1c", "ab" * 150, "-" * 90, "<|endoftext|>", "Ⅷ"]
    for _ in range(400):
        x = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 20)))
        assert c.encode(x) == t.encode(x, add_special_tokens=False).ids, repr(x)
    long = prose(rnd, 300_000)
    assert len(long) > common.SLICE_CHARS and c.encode(long) == t.encode(long, add_special_tokens=False).ids


def test_main_text():
    page = ("<body><header>Site<nav><a href=x>Home</a></nav></header><div class='cookie-notice'>We use cookies. Accept them.</div>"
            "<main><article><h1>Title &amp; more</h1><p>First  paragraph\n of text, with a <a href=y>link</a>.<p>Short."
            "<script>var t='</p>'</script><div class=ad>Buy now. It is good.</div><section id=comments><p>I like this. Very "
            "good, and long enough.</p></section></article><aside><p>Related stories. More.</p></aside></main><footer>&copy; Site.")
    assert html_extract.main_text(page) == "Title & more\n\nFirst paragraph of text, with a link.\n\nShort."
    for odd in ("", "<", "<p", "<p>", "<!-- x", "<script>x", "&amp;" * 3, "</p></div>"):
        assert isinstance(html_extract.main_text(odd), str)
    assert html_extract.main_text("<p>" * 5000 + "deep words here.") == "deep words here."


def test_minimum_cut_is_minimal():
    rnd = random.Random(3)
    for _ in range(60):
        n = rnd.randint(1, 8)
        gain = [rnd.randint(-9, 9) for _ in range(n)]
        links = [(a, b, rnd.randint(1, 6)) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.5]

        def cost(side):
            return (sum(abs(g) for g, s in zip(gain, side) if (g > 0) != s and g)
                    + sum(c for a, b, c in links if side[a] != side[b]))
        best = min(cost(s) for s in itertools.product([True, False], repeat=n))
        assert cost(html_extract.minimum_cut(gain, links)) == best


def test_extraction_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "v", "<p>One two three four five.</p>")],
                                  "page_id long, url string, html string")
    assert sorted((r["url"] or "", r["text"], r["n_chars"]) for r in html_extract.extracted(pages).collect()) == [
        ("", "", 0), ("u", "", 0), ("v", "One two three four five.", 24)]


def test_near_duplicates_equal_brute_force(docs, texts):
    fp, group = brute.near_duplicates(list(enumerate(texts)))
    got = by_id(near_dedup.near_duplicates(docs))
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == fp
    assert {i: r["component_id"] for i, r in got.items()} == group


def test_near_links_in_split_cells(spark):
    rnd = random.Random(8)
    base = [rnd.getrandbits(64) for _ in range(6)]
    fps = sorted({b ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 3))) & (2 ** 64 - 1) for b in base for _ in range(40)})
    signed = [f - 2 ** 64 if f >> 63 else f for f in fps]
    want = brute.components(sorted(signed), lambda a, b: ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 4)
    edges = near_dedup.links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4, cell_rows=7)
    found = {r["node"]: r["component"] for r in common.components(edges, "a", "b").collect()}
    assert {s: found.get(s, s) for s in signed} == want


def test_similar_texts_equal_brute_force(spark, docs, texts):
    rnd = random.Random(12)
    base = [prose(rnd, rnd.randint(30, 200)).split() for _ in range(6)]
    near = []
    for w in base:
        for edits in range(0, 8):
            own = list(w)
            for _ in range(edits):
                own[rnd.randrange(len(own))] = "changed"
            near.append(" ".join(own))
    every = texts + near
    for rows_per_cell in (3, 1024):
        table = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string").repartition(3)
        got = {r["doc_id"]: r["component_id"] for r in near_dedup.similar(table, rows_per_cell).collect()}
        assert got == brute.similar(list(enumerate(every)))
    assert len(set(got.values())) < len(every) - 20


def test_similarity_of_long_texts():
    rnd = random.Random(13)
    words = [f"w{rnd.randrange(10 ** 6)}" for _ in range(6000)]
    for edits in (30, 100, 300):
        own = list(words)
        for i in range(edits):
            own[20 * i] = "x"
        sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (words, own)]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        made = [near_dedup.signature(" ".join(w))[2] for w in (words, own)]
        assert abs(near_dedup.jaccard(*made) - true) < 0.07
    assert near_dedup.signature("")[1] == [] and near_dedup.jaccard(b"", b"") == 1.0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 130)}}


def test_quality_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    ok, note = check.compare(spark, check.oracle_connection(sf), sf, "op4_quality_rules")
    assert ok, note


def test_quality_of_odd_texts(docs, texts):
    got = by_id(quality.judged(docs))
    for i, t in enumerate(texts):
        w = brute.words(t)
        assert got[i]["n_words"] == len(w) and got[i]["word_chars"] == sum(map(len, w))
        grams = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        covered = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)}
        assert got[i]["n_repeat_words"] == len(covered)
        assert not (got[i]["base_failed"] and got[i]["kept"])
    bad = {texts.index("BAD!! " * 30), texts.index("a # b $ c | " * 20), texts.index("Go Go Go Go " * 20)}
    assert not any(got[i]["kept"] for i in bad) and all(got[i]["kept"] or got[i]["base_failed"] for i in range(40))


def test_packing_holds_all_words_without_conflicts(docs, texts):
    rows = packing.packed(docs, capacity=100, shard_docs=25).collect()
    bins = {}
    for r in rows:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
    for b in bins.values():
        full = [r for r in b if r["n_words"]]
        assert sum(r["n_words"] for r in b) <= 100
        assert sorted(r["place"] for r in b) == list(range(len(b)))
        assert len({r["source"] for r in full}) == len({r["cluster"] for r in full}) == len(full)
    for i, t in enumerate(texts):
        own = sorted((r["start"], r["n_words"]) for r in rows if r["doc_id"] == i)
        assert sum(n for _, n in own) == len(brute.words(t)) and [s for s, _ in own] == [100 * k for k in range(len(own))]


def test_packing_takes_the_tightest_compatible_bin():
    bins = packing.Bins(10, 3)
    assert [bins.put(n, s, c) for n, s, c in ((7, 0, 1), (5, 1, 2), (3, 0, 3), (3, 2, 4), (2, 2, 2), (2, 0, 9))] == [
        (0, 0), (1, 0), (1, 1), (0, 1), (2, 0), (2, 1)]


def test_token_counts_equal_library(docs, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = by_id(token_counts.token_counts(docs, limit=50))
    for i, t in enumerate(texts):
        t = t or ""
        n = len(sp.encode(t))
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len(t.encode()), n, n > 50)
        assert len(sp.encode(t[:got[i]["fit_chars"]])) <= 50


def test_every_prefix_count():
    path = public_tokenizers.path("piece_bpe_32k.model")
    c, sp, rnd = token_counts.PrefixCounter(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(2)
    bits = ["a", "b", "the", "  ", " ", "\n", "é", "日本", "😀", "▁", "ing", "<s>", "\t", " " * 17, " " * 40, "aaaa", "\xa0", "<0x0A>"]
    for _ in range(150):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 10)))
        assert c.prefix_counts(t).tolist() == [len(sp.encode(t[:i])) for i in range(len(t) + 1)], repr(t)
    long = prose(rnd, 300_000)
    assert c.count(long) == len(sp.encode(long))


@pytest.mark.parametrize("rows_per_range", [4, 1000])
def test_edited_texts_and_neighbours(docs, texts, rows_per_range):
    got = by_id(fingerprints.document_fingerprints(docs, rows_per_range=rows_per_range))
    assert len(got) == len(texts)
    fp = {i: int(r["fingerprint"], 16) for i, r in got.items()}
    for i, t in enumerate(texts):
        t, after = t or "", texts[i - 1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert fp[i] == fingerprints.fingerprint(t, {}) & (2 ** 64 - 1)
        assert got[i]["near_next"] == 1 - (fp[i] ^ fp[(i - 1) % len(texts)]).bit_count() / 64
    near = sum((fp[0] ^ f).bit_count() <= fingerprints.RADIUS for i, f in fp.items() if i)
    assert got[0]["n_near"] == near and got[1]["n_near"] is None


def test_substring_dedup_equals_brute_force(docs, texts):
    want = {i: x for i, x in brute.passages(list(enumerate(texts))).items() if x}
    got = {r["doc_id"]: {tuple(s) for s in r["spans"]} for r in substring_dedup.removals(docs).collect()}
    assert got == want and len(want) > 10
    new = by_id(substring_dedup.without_passages(docs))
    for i, t in enumerate(texts):
        assert new[i]["text"] == (t if i not in want else brute.cut(t, want[i]))


@pytest.mark.parametrize("block", [200, 1 << 24])
def test_scores_equal_brute_force(docs, texts, monkeypatch, block):
    monkeypatch.setattr(lm_score, "BLOCK_CHARS", block)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    model = brute.Ppm([t for i, t in enumerate(texts) if not held[i]], lm_score.ORDER)
    got = by_id(lm_score.scored(docs))
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(brute.words(t)) + 1, model.n)
        assert r["n_known"] == sum(model.c[w] > 0 for w in [*brute.words(brute.lower(t or "")), "\n"])
        assert r["base_score"] == pytest.approx(model.base(t)) and r["score"] == pytest.approx(model.score(t))


def test_line_dedup_equals_brute_force(docs, texts):
    want = brute.line_dedup([(i, t) for i, t in enumerate(texts) if t is not None], line_dedup.GUARANTEE)
    got = by_id(line_dedup.without_repeats(docs))
    assert {i: r["text"] for i, r in got.items() if texts[i] is not None} == want
    assert sum(r["_n_removed"] > 0 for r in got.values()) > 10
    assert all(r["text"] is None for i, r in got.items() if texts[i] is None)


def test_native_plans_have_no_python(docs):
    for df in (line_dedup.without_repeats(docs), quality.judged(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_pipeline_equals_brute_force(spark, docs, texts, tmp_path):
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    kept = {i for i, r in by_id(quality.judged(docs)).items() if r["kept"]}
    left = brute.line_dedup([(i, texts[i]) for i in sorted(kept)], line_dedup.GUARANTEE)
    group = brute.similar(sorted(left.items()))
    left = [(i, left[i]) for i in sorted(left) if group[i] == i]
    gone = brute.passages(left)
    want = {i: len(brute.words(brute.cut(t, gone[i]) if gone[i] else t)) for i, t in left}
    got = {}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_words"]
    assert got == want and len(want) < len(texts)


def test_empty_tables_clashing_columns_and_repeated_rows(spark, empty, docs):
    for f in (bpe.round_trip, near_dedup.near_duplicates, quality.judged, packing.packed, token_counts.token_counts,
              fingerprints.document_fingerprints, substring_dedup.removals, lm_score.scored, line_dedup.without_repeats,
              quality.keep_good, line_dedup.drop_repeats, near_dedup.one_of_each, substring_dedup.without_passages):
        assert f(empty).count() == 0
    long = prose(random.Random(4), 60)
    rows = [(1, long, "en", "a", 5, 7, "x"), (1, long, "en", "a", 5, 7, "x"), (None, long, None, None, None, None, None),
            (2, None, "en", "a", 5, 7, "x")]
    odd = spark.createDataFrame(rows, SCHEMA + ", node long, component_id string")
    for f in (quality.keep_good, line_dedup.drop_repeats, near_dedup.one_of_each, substring_dedup.without_passages):
        assert f(odd).columns == odd.columns
        assert f(odd).count() >= 1
    for f in (bpe.round_trip, near_dedup.near_duplicates, quality.judged, token_counts.token_counts,
              fingerprints.document_fingerprints, lm_score.scored, line_dedup.without_repeats):
        assert f(odd).count() == 4


def test_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in contract.queries()


def test_scores_use_contexts_over_words_and_occurrences(spark):
    """All words below are known and equally frequent, so a score by word counts could not tell the orders apart."""
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    rows = [(i, "casa azul mar verde") for i in range(200) if i not in held and zlib.crc32(str(i).encode()) % 7 != 2]
    docs = spark.createDataFrame([*rows, (held[0], "casa azul mar verde"), (held[1], "verde mar azul casa")],
                                 "doc_id long, text string")
    got = by_id(lm_score.scored(docs))
    assert got[held[0]]["base_score"] == pytest.approx(got[held[1]]["base_score"])
    assert got[held[0]]["score"] > got[held[1]]["score"] + 2
    assert got[held[0]]["score"] > -1  # seen often: nearly certain


def test_words_of_a_block_travel_packed(spark, monkeypatch):
    """Rows of a block are bounded by the parts, whatever its number of distinct words; scores stay the model's."""
    rnd, sizes, stored = random.Random(25), {}, lm_score.stored
    texts = [" ".join(f"{rnd.randrange(10 ** 6):x}" for _ in range(300)) for _ in range(40)]
    texts += [None, " \t\n ", "a\x00b A\x00B é É\n", texts[2], texts[3].upper()]

    def counted(df, name):
        out = stored(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(lm_score, "stored", counted)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    model = brute.Ppm([t for i, t in enumerate(texts) if not held[i]], lm_score.ORDER)
    got = by_id(lm_score.scored(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)))
    for i, t in enumerate(texts):
        assert got[i]["n_known"] == sum(model.c[w] > 0 for w in [*brute.words(brute.lower(t or "")), "\n"])
        assert got[i]["base_score"] == pytest.approx(model.base(t)) and got[i]["score"] == pytest.approx(model.score(t))
    assert sizes["lm-blocks"] <= lm_score.WORD_PARTS + lm_score.PARTS + 1 < len(model.c) / 10
