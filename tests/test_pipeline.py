import pytest
from pyspark.sql import functions as F

from conftest import rows
from topicpulse.config import Config
from topicpulse.operators.sentiment import lexicon_scorer
from topicpulse.plans.daily import Layout, run_day, run_days
from topicpulse.schemas import BRONZE, GOLD_TOPICS, SILVER
from topicpulse.sources import feeds, tables
from topicpulse.streaming.incremental import feed_stream, ingest

CONFIG = Config(history_days=3, min_corpus=1)
SCORER = lexicon_scorer(["vence", "sobe"], ["cai", "perde"])

RSS = """<?xml version="1.0" encoding="UTF-8"?><rss><channel><title>canal</title>{}</channel></rss>"""
ITEM = ("<item><title>{t}</title><description><![CDATA[<p>{s}</p>]]></description>"
        "<pubDate>{d}</pubDate><link>{l}</link></item>")


def land(root, fonte, day, name, items):
    folder = root / f"fonte={fonte}" / f"data_coleta={day}"
    folder.mkdir(parents=True, exist_ok=True)
    body = "".join(ITEM.format(t=t, s=s, d="2026-07-19", l=link) for t, s, link in items)
    (folder / name).write_text(RSS.format(body), encoding="utf-8")


def test_feed_items(spark, tmp_path):
    land(tmp_path, "a", "2026-07-20", "f.xml", [("Título &amp; 1", "um", "http://x/1"), ("Dois", "dois", "http://x/2")])
    land(tmp_path, "b", "2026-07-20", "f.xml", [("Três", "três", "http://y/1")])
    land(tmp_path, "c", "2026-07-20", "f.xml", [])
    broken = tmp_path / "fonte=d" / "data_coleta=2026-07-20"
    broken.mkdir(parents=True)
    (broken / "f.xml").write_text("<rss><channel><item><title>só isto</title></item>", encoding="utf-8")
    out = feeds.project_feed(feeds.read_feed_items(spark, str(tmp_path)))
    assert out.columns == BRONZE.names
    got = {r["titulo"]: r for r in out.collect()}
    assert set(got) == {"Título & 1", "Dois", "Três", "só isto"}
    assert got["Dois"]["resumo"] == "dois" and got["Dois"]["fonte"] == "a"
    assert got["só isto"]["link"] == "" and got["só isto"]["data_coleta"] == "2026-07-20"
    assert dict(rows(feeds.source_counts(out))) == {"a": 2, "b": 1, "d": 1}


def test_failures_are_reported(spark, tmp_path):
    folder = tmp_path / "fonte=a" / "data_coleta=2026-07-20"
    folder.mkdir(parents=True)
    (folder / "good.xml").write_text("<channel><item><title>x</title></item><item><link>y</link></item></channel>")
    (folder / "cut.xml").write_text("<channel><item><title>x</title></item><item><title>z")
    (folder / "noise.xml").write_bytes(bytes(range(256)))
    (folder / "torn.xml.gz").write_bytes(b"\x1f\x8b\x08\x00\x00")
    got = {r["arquivo"].rsplit("/", 1)[1]: tuple(r)[3:] for r in feeds.feed_failures(spark, str(tmp_path)).collect()}
    assert got == {"good.xml": (2, 1, 0, False), "cut.xml": (1, 0, 1, False), "noise.xml": (0, 0, 0, True),
                   "torn.xml.gz": (0, 0, 0, True)}
    assert feeds.project_feed(feeds.read_feed_items(spark, str(tmp_path))).count() == 3


def test_atom_items_and_tagging(spark, tmp_path):
    folder = tmp_path / "fonte=a" / "data_coleta=2026-07-20"
    folder.mkdir(parents=True)
    (folder / "f.xml").write_text('<feed><entry><title>T</title><summary>S</summary><published>2026</published>'
                                  '<link href="http://z"/></entry></feed>', encoding="utf-8")
    out = feeds.project_feed(feeds.read_feed_items(spark, str(tmp_path), "atom"))
    assert rows(out) == [("T", "S", "2026", "http://z", "a", "2026-07-20")]
    two = feeds.union_sources([out, feeds.tag_source(out, "b", "2026-07-21")])
    assert sorted(r["fonte"] for r in two.collect()) == ["a", "b"]


def test_empty_sources_and_validation(spark):
    none = spark.createDataFrame([], BRONZE)
    with pytest.raises(RuntimeError):
        feeds.require_any_source(none)
    with pytest.raises(RuntimeError):
        tables.validate_non_empty(none, BRONZE.names)
    with pytest.raises(ValueError):
        tables.validate_non_empty(none, ["inexistente"])


def gold_row(day, termo, freq):
    return (day, termo, freq, 0.0, 1.0, None, "outros", 0.0, "NEU", "")


def test_upsert_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "gold")

    def upsert(data, days):
        tables.upsert_gold(spark.createDataFrame(data, GOLD_TOPICS), path, days)
        return sorted((r["data"], r["termo"], r["frequencia"]) for r in tables.read_gold_topics(spark, path).collect())

    a, b, c = gold_row("2026-07-20", "x", 1), gold_row("2026-07-20", "y", 2), gold_row("2026-07-21", "x", 3)
    assert len(upsert([a, b], ["2026-07-20"])) == 2
    assert upsert([c], ["2026-07-21"]) == upsert([c], ["2026-07-21"])
    assert upsert([gold_row("2026-07-20", "x", 9)], ["2026-07-20"]) == [
        ("2026-07-20", "x", 9), ("2026-07-21", "x", 3)]
    assert upsert([], ["2026-07-21"]) == [("2026-07-20", "x", 9)]
    df = tables.read_gold_topics(spark, path)
    assert df.schema["data"].dataType.simpleString() == "string" and df.columns == GOLD_TOPICS.names
    plan = df.filter(F.col("data") == "2026-07-20")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data" in plan


def news(day, titles):
    return [(t, f"resumo {t}", "", f"http://{day}/{i}", "g1", day) for i, t in enumerate(titles)]


def test_two_days_and_a_rerun(spark, tmp_path):
    base, day1, day2 = str(tmp_path), "2026-07-20", "2026-07-21"
    data = news(day1, ["governo sobe imposto", "governo sobe imposto", "time vence jogo"]) + news(
        day2, ["governo cai", "crise no governo", "governo e congresso"])
    tables.write_bronze(spark.createDataFrame(data, BRONZE), Layout(base).bronze)
    first = run_day(spark, base, day1, CONFIG, SCORER).first()
    assert (first["data"], first["total_noticias"]) == (day1, 2) and first["total_termos"] > 0
    run_day(spark, base, day2, CONFIG, SCORER)

    def gold():
        return sorted(rows(tables.read_gold_topics(spark, Layout(base).topics)), key=repr)

    once = gold()
    assert {r[0] for r in once} == {day1, day2}
    known = {r[:2]: r for r in once}
    # Second day: seen terms have a verdict, new terms do not.
    assert known[day2, "governo"][5] is False and known[day2, "crise"][5] is None
    assert known[day1, "governo"][2] == 1 and known[day2, "governo"][2] == 3
    run_day(spark, base, day2, CONFIG, SCORER)
    assert gold() == once
    run_days(spark, base, [day1, day2], CONFIG, SCORER)  # both dates in one plan: the same table
    assert gold() == once
    silver = tables.read_or_empty(spark, Layout(base).silver, SILVER)
    assert silver.filter(F.col("data_coleta") == day1).count() == 2


def test_run_without_data_stops(spark, tmp_path):
    with pytest.raises(RuntimeError):
        run_day(spark, str(tmp_path), "2026-07-20", CONFIG, SCORER)


def test_stream_recomputes_whole_dates(spark, tmp_path):
    landing, base, oneshot = tmp_path / "landing", str(tmp_path / "base"), str(tmp_path / "oneshot")
    day1, day2 = "2026-07-20", "2026-07-21"

    def run():
        ingest(feed_stream(spark, str(landing), files_per_batch=1), base, CONFIG, SCORER, f"{base}/checkpoint")

    def gold(where):
        return sorted(rows(tables.read_gold_topics(spark, Layout(where).topics)), key=repr)

    land(landing, "a", day1, "1.xml", [("governo sobe imposto", "nota", "u1"), ("time vence", "jogo", "u2")])
    land(landing, "a", day2, "1.xml", [("governo cai", "crise", "u3")])
    run()
    # Late: one repeated item and one new item for the first day.
    land(landing, "a", day1, "2.xml", [("time vence", "jogo", "u2"), ("governo anuncia", "pacote", "u4")])
    run()
    run()  # nothing new
    bronze = tables.read_or_empty(spark, Layout(base).bronze, BRONZE)
    assert sorted(r["link"] for r in bronze.collect()) == ["u1", "u2", "u3", "u4"]
    tables.write_bronze(bronze, Layout(oneshot).bronze)
    run_days(spark, oneshot, [day1, day2], CONFIG, SCORER)
    assert gold(base) == gold(oneshot)


def test_linkless_rows_stay_apart(spark):
    """Two items without a link, one of them a copy of another source's: only the copy goes."""
    from topicpulse.config import Config
    from topicpulse.operators.sentiment import lexicon_scorer
    from topicpulse.plans.daily import build_silver
    from topicpulse.schemas import BRONZE

    same = {"data_coleta": "2024-05-01", "resumo": "", "data_publicacao": "2024-05-01"}
    items = [dict(same, fonte="a", link="l1", titulo="ponte nova abre hoje no centro"),
             dict(same, fonte="b", link="", titulo="ponte nova abre hoje no centro"),
             dict(same, fonte="b", link="", titulo="governo sobe imposto sobre vinho")]
    bronze = spark.createDataFrame([tuple(i.get(c) for c in BRONZE.names) for i in items], BRONZE)
    silver = build_silver(bronze, Config(), lexicon_scorer(["bom"], ["ruim"]))
    assert sorted((r["fonte"], r["titulo"]) for r in silver.collect()) == [
        ("a", "ponte nova abre hoje no centro"), ("b", "governo sobe imposto sobre vinho")]


def test_phrase_with_null_column(spark):
    from topicpulse.operators.containment import any_term_matches

    articles = spark.createDataFrame([(1, None, "o dono do time saiu")], "ordem long, fonte string, texto_completo string")
    terms = spark.createDataFrame([("time",), ("do time",)], "termo string")
    found = any_term_matches(articles, terms, ["ordem", "fonte"])
    assert {r["termo"] for r in found.collect()} == {"time", "do time"}


def test_items_behind_a_broken_one_are_read(spark, tmp_path):
    folder = tmp_path / "fonte=a" / "data_coleta=2026-07-20"
    folder.mkdir(parents=True)
    (folder / "mid.xml").write_text("<rss><channel><title>c</title><item><title>um</title></item>"
                                    "<item><title>dois</item><item><title>três</title><link>l3</link></item>"
                                    "<itemize/><item>\n<title>quatro</title></item></channel></rss>", encoding="utf-8")
    items = feeds.read_feed_items(spark, str(tmp_path))
    got = sorted((r["item"], r["title"], feeds.BROKEN in r and r[feeds.BROKEN] is not None) for r in items.collect())
    assert [(i, t) for i, t, _ in got] == [(0, "um"), (1, None), (2, "três"), (3, "quatro")]
    assert got[1][2] and not got[0][2]
    report = feeds.feed_failures(spark, str(tmp_path)).collect()
    assert [tuple(r)[3:] for r in report] == [(3, 0, 1, False)]


def test_source_report_shows_configured_sources_without_files(spark, tmp_path):
    land(tmp_path, "a", "2026-07-20", "f.xml", [("Um", "um", "http://x/1"), ("Dois", "dois", "http://x/2")])
    land(tmp_path, "a", "2026-07-21", "f.xml", [("Três", "três", "http://x/3")])
    land(tmp_path, "extra", "2026-07-20", "f.xml", [("Quatro", "q", "http://z/4")])
    report = feeds.source_report(spark, str(tmp_path), [("b", "feeds/b.xml"), ("a", "feeds/a.xml")])
    got = {r["fonte"]: tuple(r)[1:] for r in report.collect()}
    assert got == {"a": (1, "feeds/a.xml", 2, 2, 3, 0, True), "b": (0, "feeds/b.xml", 0, 0, 0, 0, True),
                   "extra": (None, None, 1, 1, 1, 0, False)}


def test_stream_reads_items_behind_a_broken_one(spark, tmp_path):
    folder = tmp_path / "landing" / "fonte=a" / "data_coleta=2026-07-20"
    folder.mkdir(parents=True)
    (folder / "mid.xml").write_text("<rss><channel><item><title>um</title></item><item><title>dois</item>"
                                    "<item><title>três</title></item></channel></rss>", encoding="utf-8")
    query = (feed_stream(spark, str(tmp_path / "landing")).writeStream.format("memory").queryName("itens_stream")
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r["titulo"] for r in spark.table("itens_stream").collect()) == ["três", "um"]
