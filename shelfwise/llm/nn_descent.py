"""Embedding near-duplicates by NN-descent.

1. Equal vectors become one point with a multiplicity; vectors that are null, zero
   or hold null or non-finite components take no part.
2. A first neighbour graph: points that share a leaf of random hyperplanes, in
   several tables, are compared; each keeps its K nearest.  A leaf that holds too
   many points (one dense group may hold a third of all) is dealt out by a hash.
   Before that cut, the pairs at or above the threshold are kept as a spanning
   forest of the leaf.
3. NN-descent: for every point, its neighbours and those that have it as neighbour
   are compared with each other, as neighbours of neighbours tend to be neighbours;
   only pairs with a new entry, until few lists change.  A point whose K nearest all
   pass the threshold is saturated, so a list holds also the K nearest outside the
   point's component as known so far, and rounds go on while they join components:
   at the end no entry outside a point's component passes.
4. Audit: every hundredth point (more of a small table, and ten times as many while
   they have fewer than ``MIN_LINKS`` links) is compared with all points, block by
   block.  Links that the graph lacks are added to it; while it has too few of them,
   it is searched again with further tables and lists twice as long, and audited on
   other points.  If that does not suffice, all points are asked, which is exact.
5. Edges at or above the threshold, in double precision, give components.  Lists
   are enlarged to the point's component, block by block, without writing pairs: a
   task compares two blocks and returns numbers of links.

Defined results: a vector left out links with nothing and is its own component;
repeated rows and equal vectors link with each other; vectors of different lengths
never link; null ids are never a component's smallest and are never kept; an
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import bound_batches, cut_lineage
from shelfwise.llm.components import components

MIN_COSINE = 0.95
NEIGHBOURS = 10
TABLES = 6
LEAF = 32
LEAF_MOST = 64
ROUNDS = 4
#: The descent ends when fewer than this share of list entries are new.
FEW_CHANGES = 0.02
#: The audit asks one point in ASK_OF, of a small table AUDIT_POINTS or more.
ASK_OF = 100
AUDIT_POINTS = 512
MIN_LINKS = 400
MIN_RECALL = 0.98
AUDITS = 3
BLOCK = 2048
ASK_BLOCK = 4096
#: Pairs that a task finds; ``forest``: kept whatever the lists hold.
FOUND = "p long, q long, sim double, forest boolean"
SEED = 42


def usable(vector: Column) -> Column:
    """Whether a vector has a direction."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in doubles; scaled first, so that squares stay in range."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.StructArray, np.ndarray]]:
    """The lists of points of a batch's first column, with their unit vectors."""
    lists = batch.column(0)
    for i in range(len(lists)):
        points = lists[i].values
        vectors = points.field("v")
        yield points, _unit(vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(points), -1))


def _numbers(points: pa.StructArray, field: str) -> np.ndarray:
    return points.field(field).to_numpy(zero_copy_only=False)


def _table(columns: list, names: list[str], types: list) -> pa.RecordBatch:
    joined = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(joined, names=names)


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a symmetric matrix of links: every point's component, and the edges of a
    spanning forest."""
    label, a, b = np.arange(len(linked)), [], []
    free = linked.any(axis=1)
    for root in np.flatnonzero(free).tolist():
        if not free[root]:
            continue
        free[root], todo = False, [root]
        while todo:
            x = todo.pop()
            new = np.flatnonzero(linked[x] & free).tolist()
            free[new], label[new] = False, root
            a += [x] * len(new)
            b += new
            todo += new
    return label, np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def leaves(points: DataFrame, n: int, tables: range, leaf: int = LEAF) -> DataFrame:
    """Every point's leaf in every table: (tree, dim, leaf, p, v)."""
    bits = max(1, min(62, math.ceil(math.log2(max(2, n / leaf)))))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            dims = np.diff(vectors.offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                v = vectors.take(at)
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, dim]).standard_normal((dim, 1024))
                unit = _unit(v.flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim))
                for t in tables:
                    own = planes[dim][:, (t * bits) % 1024:(t * bits) % 1024 + bits]
                    if own.shape[1] < bits:
                        own = np.random.default_rng([SEED, dim, t]).standard_normal((dim, bits))
                    code = (unit @ own > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t), pa.int32()), pa.array(np.full(len(at), dim), pa.int32()),
                                                      pa.array(code, pa.int64()), ids.take(at), v], names=["tree", "dim", "leaf", "p", "v"])

    kind = points.schema["v"].dataType.simpleString()
    return points.select("p", "v").mapInArrow(dealt, f"tree int, dim int, leaf long, p long, v {kind}")


def first_graph(points: DataFrame, n: int, tables: range, k: int = NEIGHBOURS, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(p, q, sim, forest): for every point its nearest in each of its leaves, also
    outside its component there, and the spanning forest of the leaf's links."""
    dealt = leaves(points, n, tables)
    key = ["tree", "dim", "leaf"]
    sizes = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    part = F.pmod(F.xxhash64("p", "tree"), F.ceil(F.col("n") / F.lit(LEAF_MOST)))
    grouped = dealt.join(sizes, key).withColumn("part", part).groupBy(*key, "part").agg(
        F.collect_list(F.struct("p", "v")).alias("points")).where("size(points) > 1").select("points")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, s, t = [], [], [], []
            for points, unit in _groups(batch):
                ids, sim = _numbers(points, "p"), unit @ unit.T
                np.fill_diagonal(sim, -2)
                label, x, y = _forest(sim >= min_cosine)
                few = min(k, len(ids) - 1)
                at = np.repeat(np.arange(len(ids)), few)
                best = np.argpartition(-sim, few - 1, axis=1)[:, :few].ravel()
                if len(x):
                    out = np.where(label[:, None] == label[None, :], -2, sim)
                    other = np.argpartition(-out, few - 1, axis=1)[:, :few].ravel()
                    told = label[at] != label[other]
                    at, best = np.concatenate([at, at[told]]), np.concatenate([best, other[told]])
                a += [ids[at], ids[x]]
                b += [ids[best], ids[y]]
                s += [sim[at, best], sim[x, y]]
                t += [np.zeros(len(at), bool), np.ones(len(x), bool)]
            yield _table([a, b, s, t], ["p", "q", "sim", "forest"], [pa.int64(), pa.int64(), pa.float64(), pa.bool_()])

    return grouped.mapInArrow(nearest, FOUND)


def _labelled(rows: DataFrame, labels: DataFrame, of: str, out: str) -> DataFrame:
    """``out``: the component of the point in column ``of``; alone, the point itself."""
    named = labels.select(F.col("node").alias("_node"), F.col("component").alias(out))
    joined = rows.join(named, F.col(of) == F.col("_node"), "left").drop("_node")
    return joined.withColumn(out, F.coalesce(out, of))


def _best(edges: DataFrame, k: int, labels: DataFrame | None = None) -> DataFrame:
    """Each point's K nearest of the edges (p, q, sim, old, forest), its K nearest
    outside its component (``foreign``; all are without ``labels``), and the forest
    edges between components; old where any of the same pair's rows is."""
    once = edges.groupBy("p", "q").agg(F.max("sim").alias("sim"), F.max("old").alias("old"), F.max("forest").alias("forest"))
    if labels is None:
        once = once.withColumn("foreign", F.lit(True))
    else:
        once = _labelled(_labelled(once, labels, "p", "_cp"), labels, "q", "_cq")
        once = once.withColumn("foreign", F.col("_cp") != F.col("_cq")).drop("_cp", "_cq")
    order = Window.partitionBy("p").orderBy(F.desc("sim"), "q")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = once.withColumn("near", F.row_number().over(order) <= k)
    far = F.col("foreign") & (F.sum(F.col("foreign").cast("int")).over(upto) <= k)
    placed = placed.withColumn("far", far)
    return placed.where("near or far or (forest and foreign)")


def descend(points: DataFrame, lists: DataFrame, k: int = NEIGHBOURS, labels: DataFrame | None = None,
            min_cosine: float = MIN_COSINE) -> DataFrame:
    """One round: (p, q, sim, forest) of neighbours' neighbours that improve a list
    or join two components; of a task's pairs that join the same two, one."""
    lists = lists.where("near or far")
    full = lambda which: F.when(F.sum(F.col(which).cast("int")) >= k, F.min(F.when(F.col(which), F.col("sim")))).otherwise(-2.0)
    last = lists.groupBy("p").agg(full("near").alias("least"), full("far").alias("least_far"))
    rank = F.row_number().over(Window.partitionBy("q", "near").orderBy(F.xxhash64("p", "q")))
    back = lists.withColumn("r", rank).where(F.col("r") <= k).select(F.col("q").alias("at"), F.col("p").alias("p"), "old")
    around = lists.select(F.col("p").alias("at"), F.col("q").alias("p"), "old").unionByName(back)
    around = around.groupBy("at", "p").agg(F.min("old").alias("old"))
    told = points.select("p", "v").join(last, "p", "left")
    told = told.withColumn("c", F.col("p")) if labels is None else _labelled(told, labels, "p", "c")
    told = told.withColumns({c: F.coalesce(c, F.lit(-2.0)) for c in ("least", "least_far")})
    met = around.join(told, "p").groupBy("at").agg(
        F.collect_list(F.struct("p", "v", "c", "least", "least_far", F.col("old").cast("int").alias("old"))).alias("points"), F.min("old").alias("o"))
    met = met.where("not o and size(points) > 1").select("points")

    def improved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, s, t = [], [], [], []
            for points, unit in _groups(batch):
                ids, label, sim = _numbers(points, "p"), _numbers(points, "c"), unit @ unit.T
                old, foreign = _numbers(points, "old") > 0, label[:, None] != label[None, :]
                better = (sim > _numbers(points, "least")[:, None]) | (foreign & (sim > _numbers(points, "least_far")[:, None]))
                better &= ~(old[:, None] & old[None, :])
                np.fill_diagonal(better, False)
                x, y = np.nonzero(better)
                u, w = np.nonzero(foreign & (sim >= min_cosine))
                _, one = np.unique(np.stack([np.minimum(label[u], label[w]), np.maximum(label[u], label[w])]), axis=1, return_index=True)
                u, w = u[one], w[one]
                a += [ids[x], ids[u]]
                b += [ids[y], ids[w]]
                s += [sim[x, y], sim[u, w]]
                t += [np.zeros(len(x), bool), np.ones(len(u), bool)]
            yield _table([a, b, s, t], ["p", "q", "sim", "forest"], [pa.int64(), pa.int64(), pa.float64(), pa.bool_()])

    return met.mapInArrow(improved, FOUND)


def joined(lists: DataFrame, labels: DataFrame | None, min_cosine: float = MIN_COSINE) -> tuple[DataFrame, int]:
    """The components (node, component) with the links of ``lists`` between them,
    and the number of components that were joined to another."""
    links = lists.where(F.col("foreign") & (F.col("sim") >= min_cosine)).select(F.col("p").alias("a"), F.col("q").alias("b"))
    if labels is None:
        found = cut_lineage(components(links))
        return found, found.count()
    links = _labelled(_labelled(links, labels, "a", "ca"), labels, "b", "cb")
    return merged(labels, links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))


def merged(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """``labels`` (node, component) with the components of each pair (a, b) made one,
    and the number of components that were joined to another."""
    links = cut_lineage(links.where("a <> b").distinct())
    if not links.head(1):
        return labels, 0
    moved = cut_lineage(components(links))
    # a component's own name is no node of it
    kept = labels.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    kept = kept.select("node", F.coalesce("to", "component").alias("component"))
    return cut_lineage(kept.unionByName(moved)), moved.count()


def neighbour_graph(points: DataFrame, n: int, k: int = NEIGHBOURS, tables: range = range(TABLES), rounds: int = ROUNDS,
                    start: tuple[DataFrame, DataFrame] | None = None, min_cosine: float = MIN_COSINE) -> tuple[DataFrame, DataFrame]:
    """The lists (p, q, sim, ...) and components (node, component) after NN-descent
    from the first graph (and ``start``, lists and components)."""
    lists, labels = start or (None, None)
    fresh = first_graph(points, n, tables, k, min_cosine).withColumn("old", F.lit(False))
    if lists is not None:
        fresh = fresh.unionByName(lists.select("p", "q", "sim", "forest", F.lit(True).alias("old")))
    lists = cut_lineage(_best(fresh, k, labels))
    labels, new = joined(lists, labels, min_cosine)
    turn = 0
    while turn < rounds or new:
        found = descend(points, lists, k, labels, min_cosine).withColumn("old", F.lit(False))
        both = lists.withColumn("old", F.lit(True)).select("p", "q", "sim", "forest", "old").unionByName(found)
        lists = cut_lineage(_best(both, k, labels))
        labels, new = joined(lists, labels, min_cosine)
        turn += 1
        if not new and lists.where(~F.col("old")).count() <= FEW_CHANGES * n * k:
            break
    return lists, labels


def asked_links(points: DataFrame, found: DataFrame, asked: Column, n: int, n_asked: int, min_cosine: float = MIN_COSINE,
                block: int = ASK_BLOCK) -> tuple[int, int, DataFrame]:
    """The number of links of the points where ``asked``, how many of them lie within
    a component of ``found`` (node, component), and the pairs of components (a, b)
    that the others join.

    Blocks of asked points meet blocks of all points; a task returns two numbers and
    the pairs of components."""
    n_left, n_right = max(1, -(-n_asked // block)), max(1, -(-n // block))
    named = _labelled(points.select("p", "v", asked.alias("asked")), found, "p", "c").withColumn("dim", F.size("v"))
    left = F.pmod(F.xxhash64("p", F.lit(3)), F.lit(n_left)).cast("int")
    right = F.pmod(F.xxhash64("p", F.lit(5)), F.lit(n_right)).cast("int")
    asking = named.where("asked").select("dim", left.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(n_right - 1))).alias("y"), "p", "v", "c", F.lit(1).alias("asks"))
    others = named.select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1))).alias("x"), right.alias("y"), "p", "v", "c", F.lit(0).alias("asks"))
    met = asking.unionByName(others).groupBy("dim", "x", "y").agg(F.collect_list(F.struct("p", "v", "c", "asks")).alias("points")).select("points")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for points, unit in _groups(batch):
                ids, label, asks = _numbers(points, "p"), _numbers(points, "c"), _numbers(points, "asks") > 0
                mine, rest, count, hit, missed = np.flatnonzero(asks), np.flatnonzero(~asks), 0, 0, set()
                for at in range(0, len(rest), 512):
                    own = rest[at:at + 512]
                    linked = (unit[mine] @ unit[own].T >= min_cosine) & (ids[mine][:, None] != ids[own][None, :])
                    apart = linked & (label[mine][:, None] != label[own][None, :])
                    lost = int(apart.sum())
                    count, hit = count + int(linked.sum()), hit + int(linked.sum()) - lost
                    if lost:
                        x, y = np.nonzero(apart)
                        missed.update(zip(label[mine[x]].tolist(), label[own[y]].tolist()))
                # the numbers, as a loop at point 0
                rows = [(0, 0, count, hit), *[(a, b, 0, 0) for a, b in missed]]
                yield _table([[np.array(c, dtype=np.int64)] for c in zip(*rows)], ["a", "b", "n", "hit"], [pa.int64()] * 4)

    out = cut_lineage(met.mapInArrow(links, "a long, b long, n long, hit long"))
    told = out.agg(F.sum("n").alias("n"), F.sum("hit").alias("hit")).first()
    return told["n"] or 0, told["hit"] or 0, out.where("a <> b").select("a", "b")


def audit(points: DataFrame, found: DataFrame, min_cosine: float = MIN_COSINE, queries: int = AUDIT_POINTS, min_links: int = MIN_LINKS) -> float:
    """The share of links that lie within a component of ``found`` (node, component),
    as ``audited`` tells it."""
    return audited(points, found, min_cosine, queries, min_links)[1]


def audited(points: DataFrame, found: DataFrame, min_cosine: float = MIN_COSINE, queries: int = AUDIT_POINTS, min_links: int = MIN_LINKS,
            turn: int = 0, ask_of: int = ASK_OF) -> tuple[DataFrame, float, bool]:
    """``found`` with the links that the audit met, the share of links that it had
    before, and whether all points were asked (then no link is missing).  Fewer than
    ``min_links`` links tell nothing: more points are asked then."""
    n = points.count()
    of = max(1, min(ask_of, n // max(1, queries)))
    while True:
        asked = F.pmod(F.xxhash64("p", F.lit(SEED + turn)), F.lit(of)) == 0
        links, hit, missed = asked_links(points, found, asked, n, -(-n // of), min_cosine)
        if links >= min_links or of == 1:
            break
        of = max(1, of // 10)
    return merged(found, missed)[0], hit / links if links else 1.0, of == 1


def link_counts(points: DataFrame, labelled: DataFrame, min_cosine: float = MIN_COSINE, block: int = BLOCK) -> DataFrame:
    """(p, n_links): for the points (p, v, copies) of the components in
    ``labelled`` (p, component), the rows they link with, themselves included.

    The members of a component are compared block by block; a block pair is one
    task's unit and returns numbers, so a component of any size writes no pairs."""
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = labelled.join(sizes, "component").join(points.select("p", "v", "copies"), "p")
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("p", F.lit(9)), parts).cast("int")
    meets = F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.struct(F.least(own, o).alias("x"), F.greatest(own, o).alias("y")))
    members = members.select("component", "p", "v", "copies", own.alias("side"), F.explode(meets).alias("pair"))
    grouped = members.groupBy("component", "pair").agg(
        F.collect_list(F.struct("p", "v", "copies", "side")).alias("points"),
        F.first(F.col("pair.x") == F.col("pair.y")).alias("same")).select("points", "same")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, c = [], []
            for same, (points, unit) in zip(batch.column(1).to_pylist(), _groups(batch)):
                ids, copies, side = _numbers(points, "p"), _numbers(points, "copies"), _numbers(points, "side")
                if same:
                    linked = unit @ unit.T >= min_cosine
                    np.fill_diagonal(linked, True)
                    a.append(ids)
                    c.append(linked @ copies)
                    continue
                x, y = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
                if side.min() == side.max():
                    continue
                linked = unit[x] @ unit[y].T >= min_cosine
                a += [ids[x], ids[y]]
                c += [linked @ copies[y], linked.T @ copies[x]]
            yield _table([a, c], ["p", "n"], [pa.int64(), pa.int64()])

    return grouped.mapInArrow(counted, "p long, n long").groupBy("p").agg(F.sum("n").alias("n_links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE,
                    k: int = NEIGHBOURS, min_recall: float = MIN_RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    bound_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    fine = rows.where(usable(F.col("v")))
    points = fine.groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    points = cut_lineage(points)
    # numbered once written, so that the numbers stay
    points = cut_lineage(points.withColumn("p", F.monotonically_increasing_id()))
    n = points.count()
    graph, found = None, None
    for turn in range(AUDITS):
        # near the threshold, a single-precision slip cannot be told: sims are of doubles throughout
        graph = neighbour_graph(points, n, k << turn, range(turn * TABLES, (turn + 1) * TABLES), start=graph, min_cosine=min_cosine)
        found, recall, whole = audited(points, graph[1], min_cosine, turn=turn)
        if whole or recall >= min_recall:
            break
        graph = graph[0], found
    else:
        found = audited(points, found, min_cosine, ask_of=1)[0]
    labelled = points.select("p", "least_id", "copies").join(found, points.p == found.node, "left").select(
        "p", "least_id", "copies", F.coalesce("component", "p").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    counts = link_counts(points, labelled.select("p", "component"), min_cosine)
    told = labelled.join(least, "component").join(counts, "p", "left").select(
        "p", "component_id", (F.coalesce("n_links", "copies") - 1).alias("n_links"))
    told = told.join(points.select("p", "v"), "p").select("v", "component_id", "n_links")
    linked = fine.join(told, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable(F.col("v"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
