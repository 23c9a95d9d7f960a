"""Near-duplicate headlines: greedy resolution in arrival order, per batch.

Visiting rows in arrival order, a live row ``i`` removes every later similar row ``j``,
except that when both are dated and ``j`` is strictly older, ``i`` itself is removed (and
still goes on removing). The same outcome as set rules:

* ``i`` *kills* ``j`` when i < j, similar, and not (both dated and pub_j < pub_i);
* a row is *active* when no active row kills it;
* a row survives when it is active and no later similar row is strictly older.

Rows with the same title vector share all their neighbours, so similarity is kept between
title groups and the rules are answered with running minima over "rows of a group and of
one neighbour group", never with row pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicpulse.functions.dates import publication_time
from topicpulse.operators import running
from topicpulse.operators.similarity import POSTING_BLOCK, similar_groups, with_title_key
from topicpulse.runtime import broadcast_if, cut_lineage, release

# Rows of one group that share a slice; larger groups are spread over several tasks.
SLICE_ROWS = 50_000
# Components of similar groups with at most this many undecided rows are settled in one ordered pass;
# larger ones go through rounds.
COMPONENT_ROWS = 20_000
_ROW = ["lote", "grupo", "fatias", "ordem", "pub", "link"]


@dataclass(frozen=True)
class _Resolution:
    members: DataFrame   # all rows of groups with a copy or a similar group
    kept: DataFrame      # rows that can be active or remove another one; column ``ativo``
    links: DataFrame     # (lote, de, para): neighbour groups in both directions, and self
    survivors: DataFrame  # (lote, grupo, ordem)


def _before(*cols: str, order: list[Column], rows: tuple[int, int]):
    return Window.partitionBy(*cols).orderBy(*order).rowsBetween(*rows)


def _prune(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows that are surely inactive and whose date is covered by a later row.

    Valid on any subset of a group: a dated row needs an earlier and a later member with a
    date <= its own; an undated row needs any earlier member.
    """
    earlier = _before(*keys, order=[F.asc("ordem")], rows=(Window.unboundedPreceding, -1))
    later = _before(*keys, order=[F.desc("ordem")], rows=(Window.unboundedPreceding, -1))
    marked = (rows.withColumn("_antes", F.min("pub").over(earlier))
              .withColumn("_n_antes", F.count(F.lit(1)).over(earlier))
              .withColumn("_depois", F.min("pub").over(later)))
    covered = F.coalesce((F.col("_antes") <= F.col("pub")) & (F.col("_depois") <= F.col("pub")),
                         F.lit(False))
    keep = F.when(F.col("pub").isNull(), F.col("_n_antes") == 0).otherwise(~covered)
    return marked.filter(keep)


def _prune_wide(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``_prune`` over whole groups with running minima in ranges: no group is one task."""
    marked = running.before(rows, keys, "ordem", "pub", prefix="_a")
    marked = running.before(marked, keys, "ordem", "pub", descending=True, prefix="_d")
    marked = (marked.withColumnRenamed("_amin", "_antes").withColumnRenamed("_an", "_n_antes")
              .withColumnRenamed("_dmin", "_depois").drop("_dn"))
    covered = F.coalesce((F.col("_antes") <= F.col("pub")) & (F.col("_depois") <= F.col("pub")),
                         F.lit(False))
    keep = F.when(F.col("pub").isNull(), F.col("_n_antes") == 0).otherwise(~covered)
    return marked.filter(keep)


def _meet(probes: DataFrame, sources: DataFrame, links: DataFrame) -> DataFrame:
    """Put probes and the source rows of each neighbour group side by side.

    One (lote, de, para, fatia) holds a slice of the probes of group ``de`` and all sources of
    group ``para``; big probe groups have several slices, with the sources repeated in each.
    """
    width = (probes.groupBy("lote", F.col("grupo").alias("de"))
             .agg(F.max("fatias").alias("_largura")))
    asked = links.join(width, ["de", "lote"])
    p = (probes.withColumnRenamed("grupo", "de").join(links, ["de", "lote"])
         .select("lote", "de", "para", "fatias",
                 F.pmod(F.xxhash64("ordem"), F.col("fatias")).cast("int").alias("fatia"),
                 "ordem", "pub", "link", F.lit(0).alias("tipo"),
                 F.lit(None).cast("boolean").alias("ativo")))
    s = (sources.withColumnRenamed("grupo", "para").join(asked, ["para", "lote"])
         .select("lote", "de", "para", "fatias",
                 F.explode(F.sequence(F.lit(0), F.col("_largura") - 1)).alias("fatia"),
                 "ordem", "pub", "link", F.lit(1).alias("tipo"), "ativo"))
    return p.unionByName(s)


_CELL = ("de", "para", "lote", "fatia")
_UP_TO = (Window.unboundedPreceding, Window.currentRow)


def _killed_by(met: DataFrame, chosen: Column, name: str) -> DataFrame:
    """Does a chosen earlier source kill the probe?"""
    w = _before(*_CELL, order=[F.asc("ordem"), F.asc("tipo")], rows=_UP_TO)
    src = (F.col("tipo") == 1) & chosen
    some = F.max(F.when(src, True)).over(w)
    undated = F.max(F.when(src & F.col("pub").isNull(), True)).over(w)
    oldest = F.min(F.when(src, F.col("pub"))).over(w)
    hit = F.when(F.col("pub").isNull(), some).otherwise(undated | (oldest <= F.col("pub")))
    return met.withColumn(name, F.coalesce(hit, F.lit(False)))


def _round(state: DataFrame, links: DataFrame) -> DataFrame:
    """Decide every undecided row whose earlier similar rows allow it."""
    open_rows = state.filter(F.col("ativo").isNull())
    met = _meet(open_rows, state.filter(F.coalesce("ativo", F.lit(True))), links)
    met = _killed_by(met, F.coalesce("ativo", F.lit(False)), "_morto")
    met = _killed_by(met, F.col("ativo").isNull(), "_preso")
    w = _before(*_CELL, order=[F.asc("ordem"), F.asc("tipo")], rows=_UP_TO)
    met = (met.withColumn("_fontes", F.sum("tipo").over(w))
           .withColumn("_fonte", F.max(F.when(F.col("tipo") == 1, F.col("ordem"))).over(w)))
    decided = (met.filter(F.col("tipo") == 0).groupBy("lote", F.col("de").alias("grupo"), "ordem")
               .agg(F.max("_morto").alias("_morto"), F.max("_preso").alias("_preso"),
                    F.first("fatias").alias("fatias"), F.first("pub").alias("pub"),
                    F.first("link").alias("link"), F.sum("_fontes").alias("_fontes"),
                    F.max("_fonte").alias("_fonte"))
               .select(*_ROW, F.when(F.col("_morto"), False).when(~F.col("_preso"), True).alias("ativo"),
                       F.when(~F.col("_morto") & F.col("_preso") & (F.col("_fontes") == 1),
                              F.col("_fonte")).alias("unico")))
    return state.filter(F.col("ativo").isNotNull()).unionByName(decided, allowMissingColumns=True)


def _follow_chains(state: DataFrame) -> DataFrame:
    """Settle undecided rows with one possible remover (``unico``) by pointer jumping.

    Such a row is active exactly when its remover is not, so a path of them only needs the state of its
    end and the parity of its length; steps double, and a chain takes logarithmically many.
    """
    paths = cut_lineage(state.filter(F.col("unico").isNotNull()).select(
        "lote", "ordem", F.col("unico").alias("fim"), F.lit(True).alias("impar"), F.lit(True).alias("andou")))
    if paths.isEmpty():
        return state.drop("unico")
    while not paths.filter("andou").isEmpty():
        ahead = paths.select("lote", F.col("ordem").alias("fim"), F.col("fim").alias("_fim"),
                             F.col("impar").alias("_impar"))
        paths = cut_lineage(paths.join(ahead, ["fim", "lote"], "left").select(
            "lote", "ordem", F.coalesce("_fim", "fim").alias("fim"),
            F.when(F.col("_fim").isNull(), F.col("impar")).otherwise(F.col("impar") != F.col("_impar")).alias("impar"),
            F.col("_fim").isNotNull().alias("andou")))
    ends = state.filter(F.col("ativo").isNotNull()).select("lote", F.col("ordem").alias("fim"),
                                                          F.col("ativo").alias("_ativo"))
    known = paths.join(ends, ["fim", "lote"]).select("lote", "ordem", (F.col("_ativo") != F.col("impar")).alias("_sabe"))
    return cut_lineage(state.join(known, ["ordem", "lote"], "left").select(
        *_ROW, F.coalesce("ativo", "_sabe").alias("ativo")))


def _resolve_links(state: DataFrame, links: DataFrame) -> DataFrame:
    """Rounds until no row is undecided; each settles at least the first open rows and the chains behind them."""
    settled = state.filter(F.col("ativo").isNotNull())
    state = cut_lineage(state.filter(F.col("ativo").isNull()))
    while not state.filter(F.col("ativo").isNull()).isEmpty():
        state = _follow_chains(cut_lineage(_round(state, links)))
    return settled.unionByName(state)


def components(edges: DataFrame) -> DataFrame:
    """(lote, grupo, comp) for every group on an edge (lote, de, para; both directions): ``comp`` is
    the smallest group of its connected component. Minimum labels with pointer jumping, each round stored."""
    edges = cut_lineage(edges.select("lote", "de", "para").distinct())
    label = cut_lineage(edges.groupBy("lote", F.col("de").alias("grupo")).agg(
        F.least(F.first("de"), F.min("para")).alias("comp")))
    while True:
        seen = (edges.join(label.select("lote", F.col("grupo").alias("para"), F.col("comp").alias("_c")),
                           ["lote", "para"])
                .groupBy("lote", F.col("de").alias("grupo")).agg(F.min("_c").alias("_m")))
        step = label.join(seen, ["lote", "grupo"]).select("lote", "grupo", F.least("comp", "_m").alias("comp"))
        jump = step.join(step.select("lote", F.col("grupo").alias("comp"), F.col("comp").alias("_cc")),
                         ["lote", "comp"], "left").select("lote", "grupo", F.least("comp", F.coalesce("_cc", "comp"))
                                                         .alias("comp"))
        jump = cut_lineage(jump)
        moved = jump.join(label.select("lote", "grupo", F.col("comp").alias("_old")), ["lote", "grupo"]).filter(
            F.col("comp") != F.col("_old"))
        label = jump
        if moved.isEmpty():
            return label


def _one_pass(rows: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
    """The activity rule over one component, visited in arrival order.

    An earlier active row i of the same or a similar group removes j unless both are dated and j is
    strictly older; per group it is enough to know whether an active row is undated, whether one is
    active at all, and the smallest date of its active rows.
    """
    if not len(rows):
        return rows.assign(ativo=pd.Series([], dtype=bool))
    near: dict = {}
    for de, para in zip(edges["de"], edges["para"]):
        near.setdefault(de, set()).add(para)
    rows = rows.sort_values("ordem").reset_index(drop=True)
    undated, active, oldest = set(), set(), {}
    out = []
    for g, pub in zip(rows["grupo"], rows["pub"]):
        mine_undated = pub is None or pd.isna(pub)
        killed = False
        for h in near.get(g, set()) | {g}:
            if h in undated or (h in active and (mine_undated or oldest.get(h) is not None and oldest[h] <= pub)):
                killed = True
                break
        out.append(not killed)
        if not killed:
            active.add(g)
            if mine_undated:
                undated.add(g)
            elif oldest.get(g) is None or pub < oldest[g]:
                oldest[g] = pub
    return rows.assign(ativo=out)


def _resolve_components(kept: DataFrame, links: DataFrame, component_rows: int) -> DataFrame:
    """Undecided rows by components of similar groups: small ones in one pass each, giant ones by rounds."""
    settled = kept.filter(F.col("ativo").isNotNull())
    open_rows = kept.filter(F.col("ativo").isNull())
    edges = links.filter(F.col("de") != F.col("para"))
    comps = components(edges)
    tagged = open_rows.join(comps, ["lote", "grupo"])
    sizes = tagged.groupBy("lote", "comp").agg((F.count(F.lit(1)) <= component_rows).alias("_small"))
    tagged = cut_lineage(tagged.join(sizes, ["lote", "comp"]))
    cols = [*_ROW, "ativo"]
    schema = tagged.select(*cols).schema
    small = tagged.filter("_small").select("comp", *cols).drop("ativo")
    comp_edges = edges.join(comps.select("lote", F.col("grupo").alias("de"), "comp"), ["lote", "de"])
    done = (small.groupBy("lote", "comp").cogroup(comp_edges.groupBy("lote", "comp"))
            .applyInPandas(lambda r, e: _one_pass(r.drop(columns=["comp"]), e)[cols], schema))
    giant = tagged.filter(~F.col("_small")).select(*cols)
    return settled.unionByName(done).unionByName(_resolve_links(giant, links))


def _resolve(df: DataFrame, threshold: float, batch: str, order: str, date_mode: str,
             block: int, slice_rows: int, component_rows: int = COMPONENT_ROWS) -> _Resolution:
    link = F.col("link") if "link" in df.columns else F.col(order).cast("string")
    # Titles, groups and members are derived from this narrow table; the texts are read once.
    rows = cut_lineage(with_title_key(df).select(
        F.col(batch).alias("lote"), "chave", "grupo", F.col(order).alias("ordem"),
        publication_time(F.col("data_publicacao"), date_mode).alias("pub"), link.alias("link")))
    pairs = cut_lineage(similar_groups(rows.select("lote", "chave", "grupo"), "lote", threshold, block))
    both = (pairs.select("lote", F.col("grupo_i").alias("de"), F.col("grupo_j").alias("para"))
            .unionByName(pairs.select("lote", F.col("grupo_j").alias("de"),
                                      F.col("grupo_i").alias("para"))))
    linked = both.select("lote", F.col("de").alias("grupo")).distinct().withColumn("ligado", F.lit(True))
    groups = (rows.filter(F.col("chave") != "").groupBy("lote", "grupo")
              .agg(F.count(F.lit(1)).alias("_n"))
              .join(linked, ["grupo", "lote"], "left")
              .filter((F.col("_n") > 1) | F.col("ligado"))
              .select("lote", "grupo", F.coalesce("ligado", F.lit(False)).alias("ligado"),
                      F.ceil(F.col("_n") / slice_rows).cast("int").alias("fatias")))
    groups = cut_lineage(groups)
    links = both.unionByName(groups.select("lote", F.col("grupo").alias("de"),
                                           F.col("grupo").alias("para")))
    members = rows.join(groups, ["grupo", "lote"]).select(*_ROW, "ligado")

    sliced = members.withColumn("_f", F.pmod(F.xxhash64("ordem"), F.col("fatias")))
    kept = cut_lineage(_prune_wide(_prune(sliced, ["grupo", "lote", "_f"]).drop("_antes", "_n_antes", "_depois"),
                                   ["grupo", "lote"]))
    # The first row of a group is never pruned; whether it is undated is a group aggregate.
    starts = kept.groupBy("lote", "grupo").agg(
        F.min_by(F.col("pub").isNull(), F.col("ordem")).alias("_inicio_sem_data"))
    # A group without similar groups is settled by its own earlier rows alone.
    alone = (F.col("_n_antes") == 0) | F.coalesce(
        ~F.col("_inicio_sem_data") & (F.col("_antes").isNull() | (F.col("pub") < F.col("_antes"))),
        F.lit(False))
    kept = (kept.join(starts, ["lote", "grupo"])
            .select(*_ROW, F.when(~F.col("ligado"), alone).alias("ativo")))
    kept = cut_lineage(_resolve_components(cut_lineage(kept), links, component_rows))

    # A later row of the same group that is strictly older: running minimum from the end, in ranges.
    own = running.before(kept, ["lote", "grupo"], "ordem", "pub", descending=True, prefix="_l")
    own_ok = own.filter(F.col("ativo") & ~F.coalesce(F.col("_lmin") < F.col("pub"), F.lit(False)))
    # Later rows of similar groups: probes and sources side by side, group pairs only.
    met = _meet(kept.filter("ativo"), kept, links.filter(F.col("de") != F.col("para")))
    w = _before(*_CELL, order=[F.desc("ordem"), F.asc("tipo")], rows=_UP_TO)
    oldest_later = F.min(F.when(F.col("tipo") == 1, F.col("pub"))).over(w)
    met = met.withColumn("_sai", F.coalesce(oldest_later < F.col("pub"), F.lit(False)))
    gone = met.filter((F.col("tipo") == 0) & F.col("_sai")).select("lote", F.col("de").alias("grupo"), "ordem")
    survivors = own_ok.select("lote", "grupo", "ordem").join(gone, ["lote", "grupo", "ordem"], "left_anti")
    return _Resolution(members, kept, links, survivors)


def dropped_rows(df: DataFrame, threshold: float = 0.75, batch: str = "data_coleta",
                 order: str = "ordem", date_mode: str = "timestamp",
                 block: int = POSTING_BLOCK, slice_rows: int = SLICE_ROWS,
                 component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """(batch, order) of the removed rows."""
    r = _resolve(df, threshold, batch, order, date_mode, block, slice_rows, component_rows)
    return (r.members.select("lote", "grupo", "ordem")
            .join(r.survivors, ["grupo", "lote", "ordem"], "left_anti")
            .select(F.col("lote").alias(batch), F.col("ordem").alias(order)))


def dedup_news(df: DataFrame, threshold: float = 0.75, batch: str = "data_coleta",
               order: str = "ordem", date_mode: str = "timestamp",
               block: int = POSTING_BLOCK, slice_rows: int = SLICE_ROWS,
               component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """Rows left after removing near-duplicate titles within each batch.

    ``order`` is the arrival order, unique in a batch.
    """
    gone = cut_lineage(dropped_rows(df, threshold, batch, order, date_mode, block, slice_rows, component_rows))
    release(df.sparkSession)
    return df.join(broadcast_if(gone, gone.count()), [order, batch], "left_anti")


def dedup_audit(df: DataFrame, threshold: float = 0.75, batch: str = "data_coleta",
                order: str = "ordem", date_mode: str = "timestamp",
                block: int = POSTING_BLOCK, slice_rows: int = SLICE_ROWS,
                component_rows: int = COMPONENT_ROWS) -> DataFrame:
    """All rows with ``duplicata`` and ``duplicata_de`` (link of the row that removed it)."""
    r = _resolve(df, threshold, batch, order, date_mode, block, slice_rows, component_rows)
    live = r.kept.filter("ativo")
    gone = r.members.drop("ligado").join(r.survivors, ["grupo", "lote", "ordem"], "left_anti")
    killed = gone.join(live.select("lote", "grupo", "ordem"), ["grupo", "lote", "ordem"], "left_anti")
    outdated = gone.join(live.select("lote", "grupo", "ordem"), ["grupo", "lote", "ordem"], "left_semi")
    source = F.when(F.col("tipo") == 1, F.struct("ordem", "pub", "link"))

    # Active rows of one group are ever older, so the last one before the probe decides.
    by_arrival = _before(*_CELL, order=[F.asc("ordem"), F.asc("tipo")], rows=_UP_TO)
    first = _meet(killed, live, r.links).withColumn("_por", F.max(source).over(by_arrival))
    first = first.filter(F.col("pub").isNull() | F.col("_por.pub").isNull()
                         | (F.col("_por.pub") <= F.col("pub")))
    # The last row that is strictly older than the probe, if it comes after it.
    by_date = _before(*_CELL, order=[F.asc("pub"), F.asc("tipo")], rows=_UP_TO)
    dated = r.kept.filter(F.col("pub").isNotNull())
    second = _meet(outdated, dated, r.links).withColumn("_por", F.max(source).over(by_date))
    second = second.filter(F.col("_por.ordem") > F.col("ordem"))

    found = (first.unionByName(second).filter((F.col("tipo") == 0) & F.col("_por").isNotNull())
             .groupBy("lote", "ordem")
             .agg(F.max(F.struct("_por.ordem", "_por.link")).getField("link").alias("duplicata_de"))
             .select(F.col("lote").alias(batch), F.col("ordem").alias(order),
                     F.lit(True).alias("duplicata"), "duplicata_de"))
    return (df.join(cut_lineage(found), [order, batch], "left")
            .withColumn("duplicata", F.coalesce("duplicata", F.lit(False))))
