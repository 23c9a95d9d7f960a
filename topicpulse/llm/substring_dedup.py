"""Repeated passages: MinHash banding over paragraphs, exact verification, removal by components.

A paragraph is a line of ``MIN_WORDS`` words or more. Shingles have five lower-cased words.
``BANDS`` bands of ``ROWS`` MinHash values each find a pair of Jaccard similarity 0.8 with
probability 1 - (1 - 0.8^2)^5 > 0.993; equal paragraphs are one node and always meet. Colliding
paragraphs are verified on their whole shingle sets (Jaccard >= ``SIMILARITY``), and within a
component the occurrence with the smallest (doc_id, text hash, place) stays; all others are removed.

A passage may also stand inside different texts, so every run of ``PASSAGE`` words that occurred earlier is
removed too, which takes out the whole of any longer run. Runs go over line breaks (``over_lines``), so the same words
laid out in other lines are found. They are found in two steps, without pairs: of the hashes of ``GRAM`` words
the least of each run is its anchor (``REACH`` of them lie in a run, so equal runs have equal anchors wherever they stand);
then only runs whose anchor occurs twice are hashed as a whole and grouped. The runs that share one place of an anchor
follow each other: they are a stretch, and travel as one row. Stretches of equal runs are one class, which has one first
occurrence; only where an anchor has several classes are the runs of a class (once, not of each stretch) compared one by one.
A run that overlaps its own first occurrence stays.

Nodes are 64-bit hashes of the words. Null and empty texts have no passages. Rows repeated under
one doc_id with one text are one document and share their removals; rows without doc_id come first
in order. A span (line, first, last) counts words from the start of its line; one that passes the end of the line
goes on in the next lines with words. What is left of a cut line is joined by single blanks; a line without words left goes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicpulse.llm.common import Forest, cells, components, release, stored

SHINGLE = 5
MIN_WORDS = 25
PASSAGE = 51
GRAM = 20
REACH = PASSAGE - GRAM + 1
SIMILARITY = 0.8
BANDS, ROWS = 5, 2
BATCH_CHARS = 1 << 20
CELL_ROWS = 1024
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], memo: dict) -> np.ndarray:
    if len(memo) > 500_000:
        memo.clear()
    new = set(words).difference(memo)
    digest = xxhash.xxh64_intdigest
    for w in new:
        memo[w] = digest(w)
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def rolled(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words (the array is shorter by size - 1)."""
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size if len(out) else 0):
        out = mix(out + h[k:len(h) - size + 1 + k] + np.uint64(k + 1))
    return out


_BASE = 0x9E3779B97F4A7C15


def run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """As ``rolled``, by prefix sums: the cost does not depend on ``size``."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    one = np.ones(1, np.uint64)
    up, down = (np.cumprod(np.concatenate([one, np.full(len(h), x, np.uint64)]), dtype=np.uint64)
                for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    total = np.concatenate([0 * one, np.cumsum(mix(h) * up[:-1], dtype=np.uint64)])
    return mix((total[size:] - total[:-size]) * down[:len(h) - size + 1])


def least(h: np.ndarray, size: int) -> np.ndarray:
    """Place of the first least of each ``size`` values that follow each other."""
    place, width = np.arange(len(h)), 1
    while width < size:
        step = min(width, size - width)
        place = np.where(h[step:] < h[:-step], place[step:], place[:-step])
        h = np.minimum(h[step:], h[:-step])
        width += step
    return place


class Paragraphs:
    """Paragraphs and runs of some texts, all words in one array.

    ``whole`` and ``spans``: (text, line, first word, end word, place of the first word in ``words``, is a whole line).
    """

    def __init__(self, texts: list[str], memo: dict):
        words: list[bytes] = []
        self.whole, lines, ends = [], [], []
        for k, text in enumerate(texts):
            for at, line in enumerate(text.split("\n") if text else ()):
                own = line.encode("utf-8", "surrogatepass").lower().split()
                if own:
                    lines.append((at, len(words), len(own)))
                if len(own) >= MIN_WORDS:
                    self.whole.append((k, at, 0, len(own), len(words), True))
                words += own
            ends.append(len(words))
        self.words = word_hashes(words, memo)
        self.shingles = rolled(self.words)
        self.ends = np.array(ends, np.int64)  # of the texts
        size = np.array([x[2] for x in lines], np.int64)
        self.line = np.repeat(np.array([x[0] for x in lines], np.int64), size)
        self.line_start = np.repeat(np.array([x[1] for x in lines], np.int64), size)
        self.line_end = self.line_start + np.repeat(size, size)

    def runs(self, over_lines: bool = True) -> np.ndarray:
        """Places of the first words of all runs of ``PASSAGE`` words in one text, or in one line."""
        at = np.arange(max(0, len(self.words) - PASSAGE + 1))
        end = self.ends[np.searchsorted(self.ends, at, "right")] if over_lines else self.line_end[at]
        return at[at + PASSAGE <= end]

    def run_nodes(self, at: np.ndarray) -> np.ndarray:
        return run_hashes(self.words, PASSAGE)[at].view(np.int64)

    def anchors(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and place of the anchor of each run."""
        grams = run_hashes(self.words, GRAM)
        if not len(at):
            return np.zeros(0, np.int64), at
        low = least(grams, REACH)[at]
        return grams[low].view(np.int64), low

    def stretches(self, at: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the runs ``at`` with their anchors' places: where each stretch begins in ``at``, its class, the runs' nodes."""
        begin = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        nodes = self.run_nodes(at)
        # a node has its anchor in one place, so the set of its nodes gives a stretch
        return begin, mix(np.add.reduceat(mix(nodes.view(np.uint64)), begin)).view(np.int64), nodes

    def breaks(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line starts within each stretch of ``size`` runs, after its first: offsets of a list, runs before, line."""
        heads = np.flatnonzero(self.line_start == np.arange(len(self.words)))
        a, b = np.searchsorted(heads, first, "right"), np.searchsorted(heads, first + size, "left")
        count = np.maximum(b - a, 0)
        ends = np.concatenate([[0], np.cumsum(count)])
        own = heads[np.repeat(a - ends[:-1], count) + np.arange(ends[-1])]
        return ends, own - np.repeat(first, count), self.line[own]

    @property
    def spans(self) -> list[tuple]:
        at = self.runs(over_lines=False)
        text = np.searchsorted(self.ends, at, "right")
        first = at - self.line_start[at]
        return self.whole + [(k, i, x, x + PASSAGE, a, False) for k, i, x, a in zip(
            text.tolist(), self.line[at].tolist(), first.tolist(), at.tolist())]

    def nodes(self) -> list[int]:
        """Of ``spans``."""
        return self.line_nodes() + self.run_nodes(self.runs(over_lines=False)).tolist()

    def line_nodes(self) -> list[int]:
        raw = memoryview(self.words.view(np.uint8))
        digest = xxhash.xxh64_intdigest
        return [digest(raw[8 * a:8 * (a + y - x)], 1) - (1 << 63) for _, _, x, y, a, _ in self.whole]

    def start(self, text: int) -> int:
        return int(self.ends[text - 1]) if text else 0

    def set_of(self, span) -> np.ndarray:
        _, _, x, y, a, _ = span
        return self.shingles[a:a + y - x - SHINGLE + 1]


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """(paragraphs, BANDS) keys; all paragraphs at once."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    flat = np.concatenate(sets)
    keys = np.zeros((BANDS, len(sets)), np.uint64)
    for band in range(BANDS):
        for row in range(ROWS):
            seed = np.uint64(xxhash.xxh64_intdigest(f"{band}/{row}".encode()))
            keys[band] = mix(keys[band] ^ np.minimum.reduceat((flat ^ seed) * _M1, starts)) + np.uint64(band)
    return keys.T


# A row for each paragraph, and one with the anchors of each text that has runs. ``pos``: words before it in the text.
FOUND = "doc_id long, th long, line int, last int, pos int, node long, keys array<long>, anchors array<long>"
# A row for each asked line, and one for each stretch of ``size`` runs, with its first run's place and the line
# starts behind that. ``nodes``: of its runs; a task gives them once or a few times for a class.
LOOKED = ("node long, shingles binary, doc_id long, th long, line int, first int, pos int, anchor long, cls long, size int, "
          "breaks array<struct<at:int,line:int>>, nodes array<long>")
GIVEN = 500_000


def _groups(texts: list[str]):
    """Consecutive texts of about ``BATCH_CHARS`` together: (first, end)."""
    first, weight = 0, 0
    for k, t in enumerate(texts):
        weight += len(t or "")
        if weight > BATCH_CHARS or k == len(texts) - 1:
            yield first, k + 1
            first, weight = k + 1, 0


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _arrow(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<struct<at:int,line:int>>": pa.list_(pa.struct([("at", pa.int32()), ("line", pa.int32())]))}
    return [kinds[x.split()[1]] for x in schema.split(", ")]


def _looked(n: int, **columns):
    cols = [columns.get(c, pa.nulls(n, t)) for c, t in zip(_names(LOOKED), _arrow(LOOKED))]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, _arrow(LOOKED))],
                                      _names(LOOKED))


def _list(ends: np.ndarray, values: pa.Array, given: np.ndarray | None = None) -> pa.Array:
    """Lists of ``values`` between ``ends``; null where not ``given`` (those are empty)."""
    at = pa.array(ends, pa.int32()) if given is None else pa.array(ends, pa.int32(), mask=np.append(~given, False))
    return pa.ListArray.from_arrays(at, values)


def _find(batches):
    memo: dict = {}
    for b in batches:
        ids, ths, texts = (b.column(i).to_pylist() for i in range(3))
        for i, j in _groups(texts):
            p = Paragraphs(texts[i:j], memo)
            whole, at = p.whole, p.runs()
            if whole:
                keys = band_keys([p.set_of(s) for s in whole]).view(np.int64)
                ends = np.arange(0, BANDS * len(whole) + 1, BANDS)
                cols = [pa.array([ids[i + s[0]] for s in whole], pa.int64()), pa.array([ths[i + s[0]] for s in whole], pa.int64()),
                        pa.array([s[1] for s in whole], pa.int32()), pa.array([s[3] for s in whole], pa.int32()),
                        pa.array([s[4] - p.start(s[0]) for s in whole], pa.int32()), pa.array(p.line_nodes(), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.reshape(-1))),
                        pa.nulls(len(whole), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(cols, _names(FOUND))
            if len(at):
                anchor, low = p.anchors(at)
                first = np.concatenate([[True], low[1:] != low[:-1]])  # each place once
                anchor, text = anchor[first], np.searchsorted(p.ends, low[first], "right")
                own, begin = np.unique(text, return_index=True)
                n = len(own)
                cols = [pa.array([ids[i + k] for k in own.tolist()], pa.int64()), pa.array([ths[i + k] for k in own.tolist()], pa.int64()),
                        *[pa.nulls(n, pa.int32())] * 3, pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())),
                        pa.ListArray.from_arrays(pa.array(np.append(begin, len(anchor)), pa.int32()), pa.array(anchor))]
                yield pa.RecordBatch.from_arrays(cols, _names(FOUND))


def _look(over_lines: bool):
    """Shingles of the asked lines, and the stretches that have an asked anchor; columns t, doc_id, th, asked, anchors."""
    def run(batches):
        memo: dict = {}
        given: set[int] = set()
        for b in batches:
            texts, ids, ths, asked = (b.column(i).to_pylist() for i in range(4))
            marks = [np.array(x or [], np.int64) for x in b.column(4).to_pylist()]
            for i, j in _groups(texts):
                p = Paragraphs(texts[i:j], memo)
                want = {(k, x["line"]): x["node"] for k in range(i, j) for x in asked[k] or ()}
                lines = [(n, np.unique(p.set_of(s)).tobytes()) for s in p.whole
                         if (n := want.get((i + s[0], s[1]))) is not None]
                if lines:
                    yield _looked(len(lines), node=[x[0] for x in lines], shingles=[x[1] for x in lines])
                at = p.runs(over_lines)
                # asked by any text of the group: no run is missed, and equal runs are found by their nodes
                anchor, low = p.anchors(at)
                hit = np.isin(anchor, np.concatenate(marks[i:j]))
                at, anchor, low = at[hit], anchor[hit], low[hit]
                if not len(at):
                    continue
                begin, cls, nodes = p.stretches(at, low)
                first, size = at[begin], np.diff(np.append(begin, len(at)))
                text = np.searchsorted(p.ends, first, "right")
                if len(given) > GIVEN:
                    given.clear()
                new = np.zeros(len(cls), bool)
                for k, c in enumerate(cls.tolist()):
                    if c not in given:
                        given.add(c)
                        new[k] = True
                ends, before, line = p.breaks(first, size)
                breaks = pa.StructArray.from_arrays([pa.array(before, pa.int32()), pa.array(line, pa.int32())], ["at", "line"])
                yield _looked(
                    len(cls), doc_id=pa.array(ids[i:j], pa.int64()).take(pa.array(text)),
                    th=pa.array(ths[i:j], pa.int64()).take(pa.array(text)), line=p.line[first], first=first - p.line_start[first],
                    pos=first - np.concatenate([[0], p.ends])[text], anchor=anchor[begin], cls=cls, size=size,
                    breaks=_list(ends, breaks), nodes=_list(np.concatenate([[0], np.cumsum(np.where(new, size, 0))]),
                                                            pa.array(nodes[np.repeat(new, size)]), new))

    return run


def _similar(batches):
    """Links within each cell that join two groups. Rows come sorted by cell."""
    def links(nodes, sets):
        out, f = [], Forest(len(nodes))
        for j in range(1, len(nodes)):
            for i in range(j):
                if f.find(i) == f.find(j):
                    continue
                a, b = sets[i], sets[j]
                if min(len(a), len(b)) < SIMILARITY * max(len(a), len(b)):
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= SIMILARITY * (len(a) + len(b) - both):
                    f.union(i, j)
                    out.append((nodes[i], nodes[j]))
        return out

    def batch(pairs):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                           pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

    cell, nodes, sets = None, [], []
    for b in batches:
        out = []
        for c, n, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            if c != cell:
                out += links(nodes, sets)
                cell, nodes, sets = c, [], []
            nodes.append(n)
            sets.append(np.frombuffer(s, np.uint64))
        yield batch(out)
    yield batch(links(nodes, sets))


PLACE = ["doc_id", "th", "pos"]


def looked_up(rows: DataFrame, found: DataFrame, lines: DataFrame, met: DataFrame, over_lines: bool) -> DataFrame:
    """Shingles of the paragraphs in cells, and the stretches of runs whose anchor occurs more than once."""
    prints = found.where("anchors is not null").select("doc_id", "th", F.explode("anchors").alias("anchor"))
    again = prints.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    ask = lines.join(met.select("node").distinct(), "node").select("at.doc_id", "at.th", F.struct("at.line", "node").alias("ask"))
    asked = (ask.withColumn("anchor", F.lit(None).cast("long"))
             .unionByName(prints.join(again, "anchor"), allowMissingColumns=True).groupBy("doc_id", "th")
             .agg(F.collect_list("ask").alias("asked"), F.collect_set("anchor").alias("anchors")))
    asked = stored(asked.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "passages-asked")
    release(rows.sparkSession)
    texts = (rows.join(asked, (F.col("th") == F.col("_th")) & F.col("doc_id").eqNullSafe(F.col("_id")))
             .select("t", "doc_id", "th", "asked", "anchors"))
    return stored(texts.mapInArrow(_look(over_lines), LOOKED), "passages-looked")


def line_links(looked: DataFrame, met: DataFrame) -> DataFrame:
    """(a, b): verified links between the nodes of whole lines that join all similar ones."""
    sets = looked.where("shingles is not null").groupBy("node").agg(F.first("shingles").alias("shingles"))  # repeated rows ask twice
    dealt = met.join(sets, "node").select("cell", "node", "shingles")
    return stored(dealt.repartition("cell").sortWithinPartitions("cell")
                  .mapInArrow(_similar, "a long, b long"), "paragraph-links")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", over_lines: bool = False) -> DataFrame:
    """Occurrences to remove: all but the first of each component or run, with the document of the first.

    A row has a whole line, or ``runs`` runs that follow each other, as one span."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("t"))
    found = stored(rows.mapInArrow(_find, FOUND), "paragraphs")
    whole = found.where("line is not null").withColumn("first", F.lit(0))
    lines = stored(whole.groupBy("node").agg(F.min(F.struct("doc_id", "th", "line")).alias("at"),
                                             F.first("keys").alias("keys")), "paragraph-nodes")
    met = stored(cells(lines.select("node", F.explode("keys").alias("key")), "key", "node", CELL_ROWS)
                 .select("cell", "node"), "paragraph-cells")
    looked = looked_up(rows, found, lines, met, over_lines)
    release(docs.sparkSession)
    group = components(line_links(looked, met), "a", "b")
    place = F.struct(*PLACE)
    node = stored(whole.groupBy("node").agg(F.min(place).alias("head"), F.count(F.lit(1)).alias("n"))
                  .join(group.withColumnRenamed("node", "linked"), F.col("node") == F.col("linked"), "left")
                  .where("n > 1 or component is not null").select("node", "head", "component"), "paragraph-heads")
    release(docs.sparkSession)
    first = node.where("component is not null").groupBy("component").agg(F.min("head").alias("low"))
    heads = node.join(first, "component", "left").select("node", F.coalesce("low", "head").alias("head"))
    out = [*PLACE, "line", "first", "last", F.col("head.doc_id").alias("kept_in")]
    again = whole.join(heads, "node").where(place > F.col("head")).select(*out)

    segments = run_heads(looked.where("cls is not null")).withColumnRenamed("cls", "_cls")
    runs = looked.where("cls is not null").join(segments, F.col("cls") == F.col("_cls"))
    apart = ~(F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("th") == F.col("head.th"))
              & (F.col("pos") < F.col("head.pos") + PASSAGE))
    start = F.element_at(F.filter("breaks", lambda x: x["at"] <= F.col("low")), -1)  # the line in which run ``low`` begins
    later = (runs.where((place > F.col("head")) & apart).withColumn("start", F.when(
        F.exists("breaks", lambda x: x["at"] <= F.col("low")), start))
             .withColumn("runs", F.col("high") - F.col("low") + 1)
             .withColumn("first", F.coalesce(F.col("low") - F.col("start.at"), F.col("first") + F.col("low")))
             .select("doc_id", "th", (F.col("pos") + F.col("low")).alias("pos"), F.coalesce("start.line", "line").alias("line"),
                     "first", (F.col("first") + F.col("runs") - 1 + PASSAGE).alias("last"),
                     F.col("head.doc_id").alias("kept_in"), "runs"))
    return again.withColumn("runs", F.lit(None).cast("int")).unionByName(later)


def run_heads(runs: DataFrame) -> DataFrame:
    """(cls, head, low, high): the runs low to high of each stretch of the class first occur from ``head`` on, which is
    the place that a run 0 would have there; left out where nothing but the first occurrence itself has them."""
    classes = stored(runs.groupBy("anchor", "cls", "size").agg(F.min(F.struct(*PLACE)).alias("head"), F.count(F.lit(1)).alias("n")),
                     "passage-classes")
    many = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("anchor")
    alone = classes.where("n > 1").join(many, "anchor", "left_anti").select(
        "cls", "head", F.lit(0).alias("low"), (F.col("size") - 1).alias("high"))
    several = classes.join(many, "anchor").select("cls", "head", "n")
    nodes = runs.where("nodes is not null").select("cls", "nodes").join(several, "cls").dropDuplicates(["cls"])
    each = stored(nodes.select("cls", "head", "n", F.posexplode("nodes").alias("k", "node")), "passage-runs")
    at = F.struct("head.doc_id", "head.th", (F.col("head.pos") + F.col("k")).alias("pos"))
    first = each.groupBy("node").agg(F.min(at).alias("at"))
    # Runs between low and high may have a still earlier head: they are removed by that one as well, never by this one alone.
    found = (each.join(first, "node")
             .groupBy("cls", F.struct("at.doc_id", "at.th", (F.col("at.pos") - F.col("k")).alias("pos")).alias("own"), "head", "n")
             .agg(F.min("k").alias("low"), F.max("k").alias("high")).where("n > 1 or own <> head")
             .select("cls", F.col("own").alias("head"), "low", "high"))
    return alone.unionByName(found)


def _spans(items):
    return F.array_sort(F.collect_set(items))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, spans, kept_in): paragraphs and runs within lines, a span each, of documents that lose something."""
    run = F.transform(F.sequence(F.lit(0), F.col("runs") - 1), lambda k: F.struct(
        "line", (F.col("first") + k).alias("first"), (F.col("first") + k + PASSAGE).alias("last")))
    one = F.when(F.col("runs").isNull(), F.array(F.struct("line", "first", "last"))).otherwise(run)
    return repeats(docs, doc_id, text).select("doc_id", "th", F.explode(one).alias("span"), "kept_in").groupBy("doc_id", "th").agg(
        _spans(F.col("span")).alias("spans"), _spans(F.col("kept_in")).alias("kept_in"))


def _joined(batches):
    """Spans (pos, line, first, last) sorted by pos, those that meet made one."""
    for b in batches:
        out = []
        for spans in b.column(2).to_pylist():
            merged, end = [], -1
            for s in spans:
                if s["pos"] <= end:
                    over = s["pos"] + s["last"] - s["first"] - end
                    if over > 0:
                        merged[-1]["last"] += over
                        end += over
                else:
                    merged.append({k: s[k] for k in ("line", "first", "last")})
                    end = s["pos"] + s["last"] - s["first"]
            out.append(merged)
        shape = pa.list_(pa.struct([(k, pa.int32()) for k in ("line", "first", "last")]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, shape), b.column(3)],
                                         ["doc_id", "th", "spans", "kept_in"])


def passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``removals``, with runs over line breaks, and spans that overlap or touch made one."""
    found = repeats(docs, doc_id, text, over_lines=True).groupBy("doc_id", "th").agg(
        _spans(F.struct("pos", "line", "first", "last")).alias("spans"), _spans(F.col("kept_in")).alias("kept_in"))
    return found.mapInArrow(_joined, "doc_id long, th long, spans array<struct<line:int,first:int,last:int>>, kept_in array<long>")


def without_spans(text: str, spans: list[dict]) -> str:
    lines = text.split("\n")
    words = [x.encode("utf-8", "surrogatepass").split() for x in lines]
    start = np.cumsum([0] + [len(w) for w in words])
    gone = np.zeros(start[-1], bool)
    for s in spans:
        gone[start[s["line"]] + s["first"]:start[s["line"]] + s["last"]] = True
    out = []
    for line, own, a in zip(lines, words, start.tolist()):
        drop = gone[a:a + len(own)]
        if not drop.any():
            out.append(line)
        elif not drop.all():
            out.append(b" ".join(w for w, x in zip(own, drop.tolist()) if not x).decode("utf-8", "surrogatepass"))
    return "\n".join(out)


def _cut(batches):
    for b in batches:
        out = []
        for t, spans in zip(b.column(b.schema.get_field_index("_b")).to_pylist(),
                            b.column(b.schema.get_field_index("_spans")).to_pylist()):
            out.append(without_spans(t, spans) if t and spans else t)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["_row", "_t"])


def without_passages(docs: DataFrame, over_lines: bool = False) -> DataFrame:
    """The stage: ``docs`` with the later occurrences taken out of the texts; all rows stay.

    ``n_chars`` follows the new text where the table has it. Runs go over line breaks if ``over_lines``.
    """
    gone = stored((passages if over_lines else removals)(docs).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"),
                                        F.col("spans").alias("_spans")), "paragraph-spans")
    row = F.struct(*[F.col(c) for c in docs.columns if c != "text"]).alias("_row")
    left = docs.select(row, F.col("text").alias("_b"), F.col("doc_id").cast("long").alias("_key"),
                       F.xxhash64("text").alias("_h"))
    both = left.join(gone, (F.col("_h") == F.col("_th")) & F.col("_key").eqNullSafe(F.col("_id")), "left")
    shape = left.schema["_row"].dataType.simpleString()
    new = (both.select("_row", "_b", "_spans").mapInArrow(_cut, f"_row {shape}, _t string")
           .select("_row.*", F.col("_t").alias("text")))
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*docs.columns)
