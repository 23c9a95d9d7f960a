"""Repeated runs of over 50 words against a plain search of all runs, without the module's own classes."""

import random

from topicpulse.llm import substring_dedup

SIZE = 51


def prose(rnd, n):
    return ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7))) for _ in range(n)]


def wrapped(words, width):
    return "\n".join(" ".join(words[i:i + width]) for i in range(0, len(words), width))


def plain(docs):
    """docs: (id, text) sorted by id; the words each has left."""
    first, left = {}, {}
    for i, t in docs:
        w = t.split()
        gone = set()
        for k in range(len(w) - SIZE + 1):
            j, at = first.setdefault(tuple(w[k:k + SIZE]), (i, k))
            if j != i or k >= at + SIZE:
                gone.update(range(k, k + SIZE))
        left[i] = [x for k, x in enumerate(w) if k not in gone]
    return left


def removed(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    new = {r["doc_id"]: r["text"] for r in substring_dedup.without_passages(table, over_lines=True).collect()}
    spans = {r["doc_id"]: r for r in substring_dedup.passages(table).collect()}
    return new, spans


def test_runs_inside_different_lines_go_whole(spark):
    rnd = random.Random(21)
    texts = []
    for size in (50, 51, 52, 60, 70, 100) * 3:
        shared = prose(rnd, size)
        texts += [" ".join(prose(rnd, rnd.randint(50, 70)) + shared + prose(rnd, rnd.randint(50, 70))) for _ in range(3)]
    new, spans = removed(spark, texts)
    want = plain(list(enumerate(texts)))
    assert {i: t.split() for i, t in new.items()} == want
    assert sum(len(t.split()) - len(want[i]) for i, t in enumerate(texts)) == 2 * 3 * (51 + 52 + 60 + 70 + 100)
    assert len(spans) == 2 * 3 * 5 and all(len(r["spans"]) == 1 for r in spans.values())


def test_runs_go_over_line_breaks(spark):
    rnd = random.Random(22)
    texts = []
    for width in (4, 7, 11, 24):
        shared = prose(rnd, rnd.randint(51, 90))
        for own in (width, width + 3, 13):
            texts.append(wrapped(prose(rnd, 20) + shared + prose(rnd, 30), own))
        texts.append(" ".join(shared))
    texts += ["\n\n".join(wrapped(texts[0].split(), 9).split("\n")), wrapped(prose(rnd, 6) * 30, 8), wrapped(prose(rnd, 50), 8)]
    new, spans = removed(spark, texts)
    want = plain(list(enumerate(texts)))
    assert {i: t.split() for i, t in new.items()} == want
    assert not want[16] and len(want[17]) < 70 and len(want[18]) == 50
    for i, r in spans.items():
        lines = [x.split() for x in texts[i].split("\n")]
        ahead = [w for s in r["spans"] for w in sum(lines[s["line"]:], [])[s["first"]:s["last"]]]
        assert len(ahead) == len(texts[i].split()) - len(want[i])


def test_runs_kept_apart_from_an_earlier_short_copy(spark):
    rnd = random.Random(23)
    core, more = prose(rnd, 40), prose(rnd, 30)
    texts = [wrapped(prose(rnd, 30) + core + prose(rnd, 30), 10), wrapped(core + more, 9), wrapped(prose(rnd, 5) + core + more, 8)]
    new, _ = removed(spark, texts)
    assert [len(new[i].split()) for i in range(3)] == [100, 70, 5]


def test_runs_travel_as_stretches(spark, monkeypatch):
    """Copies, edited copies and shifted ones: an anchor has several classes; a row for each stretch, not for each run."""
    rnd = random.Random(24)
    base = prose(rnd, 400)
    texts = [" ".join(base)] * 2
    for _ in range(12):
        a, b = sorted(rnd.sample(range(400), 2))
        own = base[a:b] + prose(rnd, 5) + base[:a]
        for k in rnd.sample(range(len(own)), 3):
            own[k] = "x" + own[k]
        texts.append(wrapped(own, rnd.randint(5, 40)))
    texts += [texts[5], wrapped(texts[6].split(), 6)]
    rows, stored = {}, substring_dedup.stored

    def counted(df, name):
        out = stored(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(substring_dedup, "stored", counted)
    new, _ = removed(spark, texts)
    assert {i: t.split() for i, t in new.items()} == plain(list(enumerate(texts)))
    runs = sum(max(0, len(t.split()) - SIZE + 1) for t in texts)
    assert rows["passages-looked"] < runs / 4
