"""Exact cosine-similarity join of titles inside a batch.

Rows with the same multiset of title terms have the same vector, so they are one *group*;
the join works on groups and its cost does not depend on how many copies a title has.

A vector is one row with its lists, made in blocks of titles: only the distinct terms of a block travel to be
counted. Only postings of prefixes travel one by one, with the bound of their title in a byte per slot, and once
per cell. Exact products are made in cells of two chunks of titles, to which a vector goes once, however many pairs it has there.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicpulse.functions.text import vocabulary_terms
from topicpulse.operators.terms import batch_count
from topicpulse.runtime import broadcast_if, cut_lineage, release

GUARD = 1e-9
# Posting lists longer than this are split into blocks that are joined pairwise.
POSTING_BLOCK = 20_000
# Terms are dealt to so many slots by hash; the norms per slot of two titles bound their cosine.
SLOTS = 32
SLOT_GUARD = 1e-5  # slot norms, and weights where postings meet, are floats
LEVELS = 255  # of a slot norm that travels, rounded up
# Characters of titles per block, and per chunk of the exact products.
BLOCK_CHARS, CHUNK_CHARS = 8 << 20, 24 << 20
# Postings compared at once: rows of short lists, and the side of a tile of a long one.
STEP_ROWS, SHORT_LIST, TILE = 1 << 15, 64, 512
# Terms of pairs looked up at once.
STEP_TERMS = 1 << 20


def with_title_key(df: DataFrame, title: str = "titulo") -> DataFrame:
    """Add ``chave`` (sorted title terms) and ``grupo`` (128 bits of its digest)."""
    key = F.array_join(F.sort_array(vocabulary_terms(F.col(title))), " ")
    return df.withColumn("chave", key).withColumn("grupo", F.unhex(F.substring(F.sha2("chave", 256), 1, 32)))


def title_groups(keyed: DataFrame, batch: str) -> DataFrame:
    """One row per distinct non-empty title vector, with its number of copies."""
    return (keyed.filter(F.col("chave") != "").groupBy(batch, "grupo", "chave")
            .agg(F.count(F.lit(1)).alias("copias")))


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The values, the row of each value, and where each row begins."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    return lists.flatten(), np.repeat(np.arange(len(sizes)), sizes), begin


def _weigh(batch: str):
    """The vectors of a block of titles: terms by rising document frequency, their weights and numbers of groups."""
    def run(titles: pa.Table, terms: pa.Table) -> pa.Table:
        words, title, _ = _flat(pc.split_pattern(_whole(titles, "chave"), " "))
        names = _whole(terms, "termo")
        code = pc.index_in(words, names).to_numpy(zero_copy_only=False).astype(np.int64)
        pair, tf = np.unique(title * len(names) + code, return_counts=True)
        title, code = pair // max(1, len(names)), pair % max(1, len(names))
        df, shared = (_whole(terms, c).to_numpy(zero_copy_only=False) for c in ("df", "grupos"))
        rank = np.empty(len(names), np.int64)
        rank[pc.array_sort_indices(names).to_numpy()] = np.arange(len(names))
        order = np.lexsort((rank[code], df[code], title))
        title, code, tf = title[order], code[order], tf[order]
        rows = titles.num_rows
        n = _whole(titles, "_n").to_numpy(zero_copy_only=False)
        w = tf * (np.log((n[title] + 1.0) / (df[code] + 1.0)) + 1.0)
        peso = w / np.sqrt(np.bincount(title, w * w, minlength=rows))[title]
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(title, minlength=rows))]).astype(np.int32))
        return pa.table([_whole(titles, batch), _whole(titles, "grupo")] + [
            pa.ListArray.from_arrays(ends, x) for x in (names.take(pa.array(code)), pa.array(peso, pa.float64()),
                                                        pa.array(shared[code], pa.int64()))],
            names=[batch, "grupo", "termos", "pesos", "grupos"])

    return run


def packed_vectors(groups: DataFrame, sizes: DataFrame, batch: str, n_batches: int) -> DataFrame:
    """One row per group: (batch, grupo, termos, pesos, grupos), the normalised TF-IDF weights of its terms."""
    groups = groups.dropna(subset=[batch])
    total = groups.groupBy(batch).agg((1 + F.floor(F.sum(F.length("chave")) / BLOCK_CHARS)).alias("_blocos"))
    lots = total.join(broadcast_if(sizes, n_batches), batch)
    placed = (groups.join(broadcast_if(lots, n_batches), batch)
              .withColumn("_fatia", F.pmod(F.xxhash64("grupo"), F.col("_blocos")).cast("int"))
              .select(batch, "_fatia", "grupo", "chave", "copias", "_n").repartition(batch, "_fatia"))
    # Counted where the block is; summed over the blocks of the batch, and sent back.
    own = (placed.select(batch, "_fatia", "copias", F.explode(F.array_distinct(F.split("chave", " "))).alias("termo"))
           .groupBy(batch, "_fatia", "termo").agg(F.sum("copias").alias("df"), F.count(F.lit(1)).alias("grupos")))
    everywhere = Window.partitionBy(batch, "termo")
    terms = own.select(*[F.col(c).alias(c) for c in (batch, "_fatia")], "termo", F.sum("df").over(everywhere).alias("df"),
                       F.sum("grupos").over(everywhere).alias("grupos"))
    kinds = {f.name: f.dataType.simpleString() for f in groups.schema.fields}
    schema = (f"`{batch}` {kinds[batch]}, grupo {kinds['grupo']}, termos array<string>, pesos array<double>, "
              "grupos array<bigint>")
    return (placed.select(batch, "_fatia", "grupo", "chave", "_n").groupBy(batch, "_fatia")
            .cogroup(terms.groupBy(batch, "_fatia")).applyInArrow(_weigh(batch), schema))


def _norms(title: np.ndarray, terms: pa.Array, square: np.ndarray, rows: int) -> np.ndarray:
    coded = terms.dictionary_encode()
    slot = np.array([zlib.crc32(t.encode()) % SLOTS for t in coded.dictionary.to_pylist()], np.int64)
    at = title * SLOTS + slot[coded.indices.to_numpy()]
    return np.sqrt(np.bincount(at, square, minlength=rows * SLOTS).reshape(rows, SLOTS)).astype(np.float32)


def postings(packed: DataFrame, batch: str, threshold: float | None = None) -> DataFrame:
    """(batch, grupo, termo, grupos, peso, cauda, resto, normas): a row per term of a vector.

    ``resto`` is the norm after the term, ``cauda`` the squared norm from the term (inclusive), ``grupos`` the
    number of groups with the term, ``normas`` the norms of the whole vector per slot of terms. With a threshold
    only the terms that can be the first shared one of a pair: of prefixes, and of more than one group.
    """
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            terms, title, begin = _flat(b.column(2))
            peso, shared = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (3, 4))
            square = peso * peso
            total = np.concatenate([[0.0], np.cumsum(square)])
            after = total[1:] - total[begin][title]
            tail, rest = 1 - (after - square), np.sqrt(np.maximum(0.0, 1 - after))
            norms = _norms(title, terms, square, b.num_rows)
            at = (np.arange(len(peso)) if threshold is None else
                  np.flatnonzero((tail >= threshold * threshold - GUARD) & (shared > 1)))
            ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * SLOTS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(title[at])), b.column(1).take(pa.array(title[at])), terms.take(pa.array(at)),
                 pa.array(shared[at], pa.int64()), pa.array(peso[at]), pa.array(tail[at]), pa.array(rest[at]),
                 pa.ListArray.from_arrays(ends, pa.array(norms[title[at]].ravel()))],
                [batch, "grupo", "termo", "grupos", "peso", "cauda", "resto", "normas"])

    kinds = {f.name: f.dataType.simpleString() for f in packed.schema.fields}
    return packed.select(batch, "grupo", "termos", "pesos", "grupos").mapInArrow(
        run, f"`{batch}` {kinds[batch]}, grupo {kinds['grupo']}, termo string, grupos bigint, peso double, "
             "cauda double, resto double, normas array<float>")


def title_vectors(groups: DataFrame, sizes: DataFrame, batch: str, n_batches: int) -> DataFrame:
    """Normalised TF-IDF weight per (group, term), with the norm from that term onwards."""
    return postings(packed_vectors(groups, sizes, batch, n_batches), batch)


def _near(cell: np.ndarray, side: np.ndarray, peso: np.ndarray, rest: np.ndarray, norms: np.ndarray,
          threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one cell (rows sorted by it) that both bounds let through."""
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    end = np.concatenate([first[1:], [len(cell)]])
    size = end - first
    out = []
    # Short lists together: each row with the next, with the one after it, and so on.
    at = np.arange(len(cell))[np.repeat(size <= SHORT_LIST, size)]
    stop = np.repeat(end, size)
    for lag in range(1, SHORT_LIST):
        at = at[at + lag < stop[at]]
        if not len(at):
            break
        to = at + lag
        ok = peso[at] * peso[to] + rest[at] * rest[to] >= threshold - SLOT_GUARD
        ok &= (side[at] < 0) | (side[at] != side[to])
        i, j = at[ok], to[ok]
        ok = np.einsum("ij,ij->i", norms[i], norms[j]) >= threshold - SLOT_GUARD
        out.append((i[ok], j[ok]))
    for lo, hi in zip(first[size > SHORT_LIST], end[size > SHORT_LIST]):
        for a in range(lo, hi, TILE):
            x = slice(a, min(a + TILE, hi))
            for b in range(a, hi, TILE):
                y = slice(b, min(b + TILE, hi))
                ok = np.outer(peso[x], peso[y]) + np.outer(rest[x], rest[y]) >= threshold - SLOT_GUARD
                ok &= (side[x, None] < 0) | (side[x, None] != side[None, y])
                if a == b:
                    ok = np.triu(ok, 1)
                if ok.any():
                    i, j = np.nonzero(ok & (norms[x] @ norms[y].T >= threshold - SLOT_GUARD))
                    out.append((i + a, j + b))
    return tuple(np.concatenate([p[k] for p in out]) if out else np.zeros(0, np.int64) for k in (0, 1))


def _meet_postings(batch: str, threshold: float):
    """Over rows sorted by cell: the pairs of groups of one batch that meet in a cell within both bounds."""
    def pairs(t: pa.Table) -> pa.RecordBatch:
        number = [_whole(t, c).to_numpy(zero_copy_only=False) for c in ("celula", "lado", "peso", "resto")]
        norms = (_whole(t, "normas").flatten().to_numpy(zero_copy_only=False).astype(np.int16) + 128).reshape(-1, SLOTS)
        i, j = (pa.array(x) for x in _near(*number, norms.astype(np.float32) / LEVELS, threshold))
        lot, group = _whole(t, batch), _whole(t, "grupo")
        out = pa.RecordBatch.from_arrays([lot.take(i), group.take(i), group.take(j)], [batch, "grupo_i", "grupo_j"])
        return out.filter(pc.and_(pc.equal(lot.take(i), lot.take(j)), pc.not_equal(out.column(1), out.column(2))))

    def run(batches):
        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows < STEP_ROWS:
                continue
            t = pa.Table.from_batches(held)
            cell = _whole(t, "celula").to_numpy(zero_copy_only=False)
            cut = int(np.argmax(cell == cell[-1]))  # the last cell may go on in the next batch
            if cut:
                yield pairs(t.slice(0, cut))
            held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if held:
            yield pairs(pa.Table.from_batches(held))

    return run


def _candidates(vectors: DataFrame, batch: str, threshold: float, block: int, most: int | None = None) -> DataFrame:
    """Pairs of groups that can reach the threshold.

    The rarest shared term of such a pair lies in the prefix of both (what follows the
    prefix has norm below the threshold), and weight product plus remaining norms bounds
    the cosine there, so nothing is lost. The products of the norms per slot bound it at any shared
    term; both bounds are asked where the postings meet, so only pairs near the threshold
    leave the cell. Terms of a single group meet nothing and are not sent. ``most``: the largest number of
    groups of a term, if known.
    """
    prefix = vectors.filter((F.col("cauda") >= threshold * threshold - GUARD) & (F.col("grupos") > 1))
    k, b = F.lit(1), F.lit(0)
    if most is None or most > block:
        # Few terms are hot, so they are stored and their number is known.
        hot = cut_lineage(prefix.filter(F.col("grupos") > block).groupBy(batch, "termo")
                          .agg(F.count(F.lit(1)).alias("_tam")).filter(F.col("_tam") > block)
                          .select(batch, "termo", F.ceil(F.col("_tam") / block).cast("int").alias("_k")))
        prefix = prefix.join(broadcast_if(hot, hot.count()), ["termo", batch], "left")
        k = F.coalesce("_k", F.lit(1))
        b = F.pmod(F.xxhash64("grupo"), k).cast("int")
    level = F.transform("normas", lambda x: (F.least(F.ceil(x * LEVELS), F.lit(LEVELS)) - 128).cast("tinyint"))
    # Every two blocks of a term are a cell, each block with itself as well.
    placed = (prefix.withColumn("_b", b).withColumn("_o", F.explode(F.sequence(F.lit(0), k - 1)))
              .select(F.xxhash64(batch, "termo", F.least("_b", "_o"), F.greatest("_b", "_o")).alias("celula"),
                      F.when(F.col("_b") == F.col("_o"), -1).when(F.col("_b") < F.col("_o"), 0).otherwise(1)
                      .cast("tinyint").alias("lado"),
                      batch, "grupo", F.col("peso").cast("float"), F.col("resto").cast("float"), level.alias("normas")))
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}
    pairs = placed.repartition("celula").sortWithinPartitions("celula").mapInArrow(
        _meet_postings(batch, threshold), f"`{batch}` {kinds[batch]}, grupo_i {kinds['grupo']}, grupo_j {kinds['grupo']}")
    return pairs.select(batch, F.least("grupo_i", "grupo_j").alias("grupo_i"),
                        F.greatest("grupo_i", "grupo_j").alias("grupo_j")).distinct()


def _products(batch: str):
    """The cosines of the pairs of a cell."""
    def run(vectors: pa.Table, pairs: pa.Table) -> pa.Table:
        known = _whole(vectors, "grupo")
        i, j = (pc.index_in(_whole(pairs, g), known).to_numpy(zero_copy_only=False).astype(np.int64)
                for g in ("grupo_i", "grupo_j"))
        terms, title, begin = _flat(_whole(vectors, "termos"))
        coded = terms.dictionary_encode()
        width = len(coded.dictionary) + 1
        key = title * width + coded.indices.to_numpy()
        weight = _whole(vectors, "pesos").flatten().to_numpy(zero_copy_only=False)
        order = np.argsort(key)
        key, weight = key[order], weight[order]  # by title still
        size = np.bincount(title, minlength=len(begin))
        sims, work, p = np.zeros(len(i)), np.concatenate([[0], np.cumsum(size[i])]), 0
        while p < len(i):
            q = max(p + 1, int(np.searchsorted(work, work[p] + STEP_TERMS, "right")) - 1)
            n = size[i[p:q]]
            pair = np.repeat(np.arange(q - p), n)
            at = begin[i[p:q]][pair] + np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            sought = j[p:q][pair] * width + key[at] % width
            there = np.minimum(np.searchsorted(key, sought), len(key) - 1)
            sims[p:q] = np.bincount(pair, np.where(key[there] == sought, weight[at] * weight[there], 0.0), minlength=q - p)
            p = q
        return pairs.select([batch, "grupo_i", "grupo_j"]).append_column("sim", pa.array(sims, pa.float64()))

    return run


def similar_groups(keyed: DataFrame, batch: str, threshold: float,
                   block: int = POSTING_BLOCK, n_batches: int | None = None,
                   chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Pairs of distinct title vectors of one batch with cosine >= threshold."""
    spark = keyed.sparkSession
    if n_batches is None:
        n_batches = batch_count(keyed, [batch])
    sizes = keyed.groupBy(batch).agg(F.count(F.lit(1)).alias("_n"))
    # Read below by the prefixes and by the exact products.
    vectors = cut_lineage(packed_vectors(title_groups(keyed, batch), sizes, batch, n_batches))
    release(spark)
    most = vectors.agg(F.max(F.array_max("grupos"))).first()[0]
    pairs = cut_lineage(_candidates(postings(vectors, batch, threshold), batch, threshold, block, most or 0))
    release(spark)
    # Cells of two chunks: only vectors of pairs travel, once for each cell.
    chars = vectors.groupBy(batch).agg((1 + F.floor(F.sum(F.size("termos")) * 8 / chunk_chars)).alias("_partes"))
    part = [F.pmod(F.xxhash64(g), F.col("_partes")).cast("int") for g in ("grupo_i", "grupo_j")]
    cells = pairs.join(broadcast_if(chars, n_batches), batch).select(
        batch, F.least(*part).alias("_p"), F.greatest(*part).alias("_q"), "grupo_i", "grupo_j")
    asked = cells.select(batch, "_p", "_q", F.explode(F.array("grupo_i", "grupo_j")).alias("grupo")).distinct()
    sent = asked.join(vectors.select(batch, "grupo", "termos", "pesos"), ["grupo", batch]).select(
        *[F.col(c).alias(c) for c in (batch, "_p", "_q", "grupo", "termos", "pesos")])
    cell = [batch, "_p", "_q"]
    schema = pairs.select(batch, "grupo_i", "grupo_j").schema.add("sim", "double")
    dots = sent.groupBy(*cell).cogroup(cells.groupBy(*cell)).applyInArrow(_products(batch), schema)
    return dots.select(batch, "grupo_i", "grupo_j", F.round("sim", 9).alias("sim")).filter(F.col("sim") >= threshold)


def similar_titles(df: DataFrame, threshold: float, batch: str = "data_coleta",
                   row: str = "ordem", block: int = POSTING_BLOCK) -> DataFrame:
    """Similar title pairs, each vector shown by its first row and number of copies.

    Copies of one vector have cosine 1; they appear as ``copias``, not as pairs.
    """
    keyed = with_title_key(df.select(batch, row, "titulo"))
    first = (keyed.filter(F.col("chave") != "").groupBy(batch, "grupo")
             .agg(F.min(row).alias(row), F.count(F.lit(1)).alias("copias")))

    def role(i: str) -> DataFrame:
        return first.select(batch, *[F.col(c).alias(f"{c}_{i}") for c in ("grupo", row, "copias")])

    pairs = similar_groups(keyed.drop(row), batch, threshold, block)
    named = pairs.join(role("i"), ["grupo_i", batch]).join(role("j"), ["grupo_j", batch])
    swap = F.col(f"{row}_i") > F.col(f"{row}_j")

    def pick(c: str, i: str, j: str):
        return F.when(swap, F.col(f"{c}_{j}")).otherwise(F.col(f"{c}_{i}")).alias(f"{c}_{i}")

    return named.select(batch, pick(row, "i", "j"), pick(row, "j", "i"),
                        pick("copias", "i", "j"), pick("copias", "j", "i"), "sim")
