"""Hard negatives by anchor-clustered shared lists.

For an anchor, positives are the rows of its label with the highest scores; hard
negatives of a positive are the highest rows of other labels that score at most as
high as the positive and at least ``MIN_SHARE`` of it.  A score is the inner product
of two vectors of whole numbers.

1. Anchors are clustered by direction (spherical k-means; the centres are fitted on a
   bounded sample, every anchor joins its nearest centre).  A cluster's radius is the
   largest angle between its centre and a member.
2. Every candidate has one bound for a whole cluster: |x| cos(max(0, angle of x to the
   centre - radius)).  No member scores x above |member| times that.  The candidates in
   the order of their bounds are the list that all members share; it is cut into
   segments that double in length, at bounds found by one counting pass.
3. All members walk their list, segment by segment, in blocks of members and of
   candidates.  A member leaves the walk when it is certified: the bound at which the
   next segment begins cannot reach what it still wants.  A walk for the positives is
   followed by one for the negatives, which needs the positives' scores.

Where vectors have no structure (random directions in many dimensions) no bound
excludes anything and the walk compares all anchors with all rows, in blocks; the
results are exact in any case.

Scale: a candidate is sent once to every block of members of which an open cluster has
it in the present segment.  Members are dealt to blocks by cluster, a cluster with very
many members to several.  A task keeps the best few of each member and gives out only
these; equal vectors, of which there may be very many, are rows like others, and ties
are resolved by the id.  Centres and radii are a bounded number of rows (``CLUSTERS`` a
vector length in the sample); nothing else passes the driver but counts.

Scores are exact while the sums fit a long; beyond that they are the nearest doubles,
held in the range of a long.

Defined results: rows with a null label, a null vector or any null or non-finite
component take no part; vectors of different lengths have no score; zero and empty
vectors score 0; a null id is no anchor, is the last of a tie and may be a negative or
a positive; rows that share an id are rows of their own; columns other than the three
are not read; an empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import bound_batches, cut_lineage

POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this share (in hundredths) of its positive.
MIN_SHARE = 80
CLUSTERS = 16
#: Anchors that the centres are fitted on.
FIT_ROWS = 4096
FIT_ROUNDS = 10
#: Numbers in a block of candidates or members.
BLOCK_NUMBERS = 1 << 18
#: Candidates of a cluster's first segment.
FIRST_SEGMENT = 4096
#: Steps of the counting pass between the least and the largest bound.
STEPS = 4096
#: Relative room for rounding in a bound.
SLACK = 1e-9


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


class Cluster(NamedTuple):
    """``number``: of the cluster; ``centre``: None if no anchor of this vector length was
    in the sample, so that lengths alone bound the scores."""

    number: int
    dim: int
    centre: np.ndarray | None


def _matrix(lists: pa.ListArray) -> np.ndarray:
    numbers = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return numbers.reshape(len(lists), len(numbers) // max(1, len(lists)))


def _directions(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows (zero rows stay) and lengths."""
    most = np.abs(v).max(axis=1, initial=0, keepdims=True)
    scaled = v / np.where(most > 0, most, 1)
    size = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / np.where(size > 0, size, 1), (size * most)[:, 0]


def fit_centres(sample: list, clusters: int = CLUSTERS, rounds: int = FIT_ROUNDS) -> list[Cluster]:
    """Centres of the sampled anchors' vectors, ``clusters`` at most a vector length;
    the last cluster takes anchors of any other length."""
    found = []
    for dim in sorted({len(v) for v in sample} - {0}):
        unit, _ = _directions(np.array([v for v in sample if len(v) == dim], dtype=np.float64).reshape(-1, dim))
        unit = unit[np.lexsort(unit.T)]
        centres = unit[np.linspace(0, len(unit) - 1, min(clusters, len(unit))).astype(int)]
        for _ in range(rounds):
            own = (unit @ centres.T).argmax(axis=1)
            sums = np.array([unit[own == c].sum(axis=0) for c in range(len(centres))]).reshape(len(centres), dim)
            centres = np.where(np.abs(sums).sum(axis=1, keepdims=True) > 0, _directions(sums)[0], centres)
        found += [Cluster(len(found) + i, dim, c) for i, c in enumerate(centres)]
    return [*found, Cluster(len(found), -1, None)]


def _assign(clusters: list[Cluster]):
    """Each anchor's cluster, length and angle to the centre."""
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.diff(batch.column(1).offsets.to_numpy())
            cluster = np.full(len(dims), clusters[-1].number)
            norm, angle = np.zeros(len(dims)), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                unit, norm[at] = _directions(_matrix(batch.column(1).take(pa.array(at))))
                own = [c for c in clusters if c.dim == dim]
                if own:
                    cos = unit @ np.array([c.centre for c in own]).T
                    best = cos.argmax(axis=1)
                    cluster[at] = [own[b].number for b in best]
                    angle[at] = np.arccos(np.clip(cos[np.arange(len(at)), best], -1, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(norm), pa.array(angle)],
                                             names=["r", "cluster", "norm", "angle"])
    return assigned


def bounds(v: np.ndarray, clusters: list[Cluster], radius: dict[int, float]) -> np.ndarray:
    """What a member of length 1 of each cluster scores at most, a column a cluster."""
    unit, norm = _directions(v)
    out = np.empty((len(v), len(clusters)))
    for i, c in enumerate(clusters):
        if c.centre is None or c.dim != v.shape[1]:
            out[:, i] = norm
            continue
        # arccos near 1 and -1 is good to about the root of a double's precision
        angle = np.arccos(np.clip(unit @ c.centre, -1, 1)) - radius[c.number] - 1e-7
        out[:, i] = norm * np.cos(np.maximum(0.0, angle))
    return out + SLACK * norm[:, None]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, as longs."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0**53:
        return (a @ b.T).astype(np.int64)
    limit = np.nextafter(2.0**63, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        near = np.nan_to_num(a @ b.T, nan=0.0)
        # whole numbers wrap around: right where the sum of all magnitudes fits
        exact = np.clip(a, -limit, limit).astype(np.int64) @ np.clip(b, -limit, limit).astype(np.int64).T
        fits = np.abs(a) @ np.abs(b).T < 2.0**62
    return np.where(fits, exact, np.clip(near, -limit, limit).astype(np.int64))


#: A candidate that a task keeps for a member's list: ``slot`` is the positive's number, or 0 of the positives' own list.
KEPT = "r long, slot int, score long, no_id boolean, id long, row long"
_KEPT = pa.schema([("r", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("no_id", pa.bool_()), ("id", pa.int64()), ("row", pa.int64())])


def _best(rows: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Of candidates by (no_id, id, row), those with the highest scores."""
    if len(score) > 8 * most:
        edge = np.partition(score, len(score) - most)[len(score) - most]
        at = np.flatnonzero(score >= edge)
    else:
        at = np.arange(len(score))
    order = np.lexsort((rows["row"][at], rows["id"][at], rows["no_id"][at], -score[at]))
    return at[order[:most]]


_ROW = np.dtype([("no_id", bool), ("id", np.int64), ("row", np.int64)])


def _walked(most: int, share: int):
    """Compares the blocks of members and candidates that come in; gives out each
    member's best few, per task."""
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                sizes = [len(s) for _, s in held.values()]
                rows, score = (np.concatenate([x[i] for x in held.values()]) for i in (0, 1))
                who = np.repeat(np.array(list(held), dtype=np.int64), sizes, axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(who[:, 0]), pa.array(who[:, 1], pa.int32()), pa.array(score), pa.array(rows["no_id"]),
                                                  pa.array(rows["id"]), pa.array(rows["row"])], schema=_KEPT)
                held.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                members, cands = batch.column(0)[i].values, batch.column(1)[i].values
                of = lambda t, c: t.field(c).to_numpy(zero_copy_only=False)
                rows = np.empty(len(cands), _ROW)
                rows["no_id"], rows["row"] = np.asarray(cands.field("vec_id").is_null()), of(cands, "r")
                rows["id"] = np.asarray(cands.field("vec_id").fill_null(0))
                label, hit = of(cands, "label"), of(cands, "clusters")
                score = products(_matrix(members.field("v")), _matrix(cands.field("v")))
                wanted = members.field("wanted").to_pylist()
                for j, (r, own, cluster) in enumerate(zip(of(members, "r").tolist(), of(members, "label").tolist(), of(members, "bit").tolist())):
                    s = score[j]
                    near = (hit >> cluster & 1).astype(bool)
                    if wanted[j] is None:
                        lists = [(0, np.flatnonzero(near & (label == own) & (rows["row"] != r)))]
                    else:
                        low, high = min(w["score"] for w in wanted[j]), max(w["score"] for w in wanted[j])
                        some = np.flatnonzero(near & (label != own) & (s <= high) & (s >= low * (share / 100) - 1))
                        lists = []
                        for w in wanted[j]:
                            # share * positive <= 100 * score, in whole numbers
                            least = -(-share * w["score"] // 100)
                            lists.append((w["slot"], some[(s[some] <= w["score"]) & (s[some] >= least)]))
                    for slot, at in lists:
                        if not len(at):
                            continue
                        at = at[_best(rows[at], s[at], most)]
                        mine, value = rows[at], s[at]
                        if (r, slot) in held:
                            mine, value = np.concatenate([held[r, slot][0], mine]), np.concatenate([held[r, slot][1], value])
                            keep = _best(mine, value, most)
                            mine, value = mine[keep], value[keep]
                        held[r, slot] = (mine, value)
                if len(held) > 1 << 16:
                    yield from out()
        yield from out()
    return met


def _top(rows: DataFrame, most: int) -> DataFrame:
    """The best ``most`` of each (r, slot), numbered ``rank`` from 1."""
    order = Window.partitionBy("r", "slot").orderBy(F.desc("score"), "no_id", "id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


class Lists:
    """The shared lists of all clusters over ``rows`` (r, vec_id, label, v)."""

    def __init__(self, rows: DataFrame, anchors: DataFrame, clusters: list[Cluster], first_segment: int = FIRST_SEGMENT):
        self.rows, self.spark = rows, rows.sparkSession
        own = anchors.select("r", "v").mapInArrow(_assign(clusters), "r long, cluster int, norm double, angle double")
        self.anchors = cut_lineage(anchors.join(own, "r"))
        sums = self.anchors.groupBy("cluster").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"))
        per = {x["cluster"]: x for x in sums.collect()}  # a row a cluster
        self.clusters = [c for c in clusters if c.number in per]
        self.radius = {c: x["radius"] for c, x in per.items()}
        self.longest = max([x["dim"] for x in per.values()], default=1)
        self._deal(per)
        self._cut(first_segment)

    def _deal(self, per: dict) -> None:
        """Blocks of members: big clusters have several, small ones share one.
        ``bit`` is a cluster's place in its block."""
        size = max(1, min(1024, BLOCK_NUMBERS // max(1, self.longest)))
        self.block, self.bit, self.parts, used, filled, bits = {}, {}, {}, 0, 0, 0
        for c in self.clusters:
            n = per[c.number]["n"]
            parts = -(-n // size)
            if parts > 1 or filled + n > size or bits == 60:
                used, filled, bits = used + (filled > 0), 0, 0
            self.block[c.number], self.bit[c.number], self.parts[c.number] = used, bits, parts
            if parts > 1:
                used += parts
            else:
                filled, bits = filled + n, bits + 1

    def _cut(self, first: int) -> None:
        """Where the segments of each list begin, from counts of bounds; the bound
        of a step is its upper edge."""
        clusters, radius = self.clusters, self.radius

        def most(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            top = 0.0
            for batch in batches:
                for v in _by_length(batch.column(0)):
                    top = max(top, float(_directions(v[1])[1].max(initial=0)))
            yield pa.RecordBatch.from_arrays([pa.array([top])], names=["top"])

        top = self.rows.select("v").mapInArrow(most, "top double").agg(F.max("top")).first()[0] or 0.0
        self.top = top = top * (1 + 4 * SLACK) + SLACK

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts = np.zeros((len(clusters), STEPS), dtype=np.int64)
            for batch in batches:
                for _, v in _by_length(batch.column(0)):
                    step = _steps(bounds(v, clusters, radius), top)
                    for i in range(len(clusters)):
                        counts[i] += np.bincount(step[:, i], minlength=STEPS)
            at = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(counts[at])], names=["c", "step", "n"])

        self.starts: list[list[int]] = []
        counts = np.zeros((len(clusters), STEPS), dtype=np.int64)
        if clusters:
            got = self.rows.select("v").mapInArrow(counted, "c int, step int, n long").groupBy("c", "step").agg(F.sum("n").alias("n"))
            for x in got.collect():  # clusters x steps at most
                counts[x["c"], x["step"]] = x["n"]
        for own in counts:
            # steps from the highest bound down; a segment is [its first step, the next's first step)
            through, goal, cuts = 0, first, [0]
            for step in range(STEPS):
                through += int(own[step])
                if through >= goal and step + 1 < STEPS:
                    cuts.append(step + 1)
                    goal = through * 2
            self.starts.append([*cuts, STEPS])
        self.counts = counts

    def segments(self) -> int:
        return max((len(s) - 1 for s in self.starts), default=0)

    def walk(self, members: DataFrame, most: int, share: int = MIN_SHARE) -> DataFrame:
        """``r, slot, rank, score, id, no_id, row``: the best of every member (r, label, v,
        cluster, norm, wanted); ``wanted`` is null for positives, or an array of
        (slot, score)."""
        found, open_members = None, members
        for k in range(self.segments()):
            left = [i for i, s in enumerate(self.starts) if k < len(s) - 1]
            numbers = [self.clusters[i].number for i in left]
            met = self._segment(open_members.where(F.col("cluster").isin(numbers)), k, left, most, share)
            found = cut_lineage(_top(met if found is None else met.unionByName(found.drop("rank")), most))
            if k + 1 < self.segments():
                open_members = cut_lineage(self._uncertified(open_members, found, k + 1, most, share))
                if open_members.isEmpty():
                    break
        return found

    def _uncertified(self, members: DataFrame, found: DataFrame, k: int, most: int, share: int) -> DataFrame:
        """Members for which segment ``k`` may hold something."""
        # the highest score that a member of length 1 may meet from this segment on
        nexts = {self.clusters[i].number: (self.top * (1 - s[k] / STEPS) if k < len(s) - 1 else -1.0) for i, s in enumerate(self.starts)}
        nexts = F.element_at(F.create_map(*[F.lit(x) for pair in nexts.items() for x in pair]), F.col("cluster"))
        ends = found.groupBy("r", "slot").agg(F.when(F.count(F.lit(1)) >= most, F.min("score")).alias("last"))
        reach = F.floor(F.col("norm") * nexts * (1 + SLACK) + SLACK)
        asks = members.select("r", F.when(nexts >= 0, reach).alias("reach"), F.explode_outer(F.col("wanted")).alias("w"))
        asks = asks.select("r", "reach", F.coalesce("w.slot", F.lit(0)).alias("slot"), F.ceil(F.col("w.score") * share / F.lit(100)).alias("least"))
        met = asks.join(ends, ["r", "slot"], "left")
        # a later row of equal score may have a smaller id
        still = F.col("reach").isNotNull() & (F.col("last").isNull() | (F.col("reach") >= F.col("last"))) & (
            F.col("least").isNull() | (F.col("reach") >= F.col("least")))
        return members.join(met.where(still).select("r").distinct(), "r", "left_semi")

    def _segment(self, members: DataFrame, k: int, left: list[int], most: int, share: int) -> DataFrame:
        clusters, radius, top = self.clusters, self.radius, self.top
        edges = {i: (self.starts[i][k], self.starts[i][k + 1]) for i in left}
        numbers = lambda d: F.element_at(F.create_map(*[F.lit(x) for c in clusters for x in (c.number, d[c.number])]), F.col("cluster"))
        part = F.pmod(F.xxhash64("r"), numbers(self.parts))
        grouped = members.withColumn("m", (numbers(self.block) + part).cast("int")).withColumn("bit", numbers(self.bit).cast("int"))
        m_blocks = cut_lineage(grouped.groupBy("m").agg(
            F.collect_list(F.struct("r", "label", "bit", "v", "wanted")).alias("members"), F.collect_set("cluster").alias("open")))
        # blocks of members that still walk, by cluster; a number a block
        open_blocks: dict[int, list[int]] = {}
        for x in m_blocks.select("m", F.explode("open").alias("c")).collect():
            open_blocks.setdefault(x["c"], []).append(x["m"])
        in_segment = max((int(self.counts[i][slice(*edges[i])].sum()) for i in left), default=0)
        n_blocks = max(1, -(-in_segment // max(1, BLOCK_NUMBERS // max(1, self.longest))))
        bit = self.bit

        def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, v in _by_length(batch.column(3)):
                    step = _steps(bounds(v, clusters, radius), top)
                    hits: dict[int, np.ndarray] = {}
                    for i, (low, high) in edges.items():
                        inside = ((step[:, i] >= low) & (step[:, i] < high)).astype(np.int64) << bit[clusters[i].number]
                        for m in open_blocks.get(clusters[i].number, ()):
                            hits[m] = hits.get(m, 0) | inside
                    for m, mask in hits.items():
                        on = np.flatnonzero(mask)
                        if len(on):
                            rows = batch.take(pa.array(at[on]))
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(on), m), pa.int32()), pa.array(mask[on]), *rows.columns],
                                                             names=["m", "clusters", *rows.schema.names])

        cands = self.rows.select("r", "vec_id", "label", "v").mapInArrow(
            sent, "m int, clusters long, r long, vec_id long, label long, v array<double>")
        # vectors of one length meet; a block holds one length
        cands = cands.withColumn("dim", F.size("v")).withColumn("b", F.pmod(F.xxhash64("r"), F.lit(n_blocks)).cast("int"))
        c_blocks = cands.groupBy("m", "dim", "b").agg(F.collect_list(F.struct("r", "vec_id", "label", "clusters", "v")).alias("cands"))
        same = F.filter("members", lambda x: F.size(x["v"]) == F.col("dim"))
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        met = c_blocks.join(m_blocks.drop("open"), "m").select(same.alias("members"), "cands", "m", "b").where(F.size("members") > 0)
        return met.repartition(n, "m", "b").select("members", "cands").mapInArrow(_walked(most, share), KEPT)


def _by_length(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    dims = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield at, _matrix(lists.take(pa.array(at)))


def _steps(bound: np.ndarray, top: float) -> np.ndarray:
    """The step of a bound: 0 is the highest; a bound is at most top * (1 - step / STEPS)."""
    return np.clip(np.floor((1 - bound / top) * STEPS - 1e-6), 0, STEPS - 1).astype(np.int64)


FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, anchor: Column, clusters: int = CLUSTERS, positives: int = POSITIVES, negatives: int = NEGATIVES,
         share: int = MIN_SHARE, first_segment: int = FIRST_SEGMENT) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (vec_id long, label long, v:
    whole numbers as array<double>); ``anchor`` tells which rows are anchors."""
    spark = rows.sparkSession
    bound_batches(spark)
    # written once: the row numbers must not change between the passes
    rows = cut_lineage(rows.select("vec_id", F.col("label").cast("long").alias("label"), "v"))
    rows = cut_lineage(rows.select(F.monotonically_increasing_id().alias("r"), "vec_id", "label", "v"))
    anchors = rows.where(anchor)
    sample = [x["v"] for x in anchors.orderBy(F.xxhash64("r")).limit(FIT_ROWS).select("v").collect()]  # a bounded sample
    if not sample:
        return spark.createDataFrame([], FOUND)
    lists = Lists(rows, anchors, fit_centres(sample, clusters), first_segment)
    members = lists.anchors.select("r", "vec_id", "label", "v", "cluster", "norm", F.lit(None).cast("array<struct<slot:int,score:long>>").alias("wanted"))
    near = lists.walk(members, positives, share)
    near = near.select("r", F.col("rank").alias("slot"), F.when(~F.col("no_id"), F.col("id")).alias("positive_id"), F.col("score").alias("positive_score"))
    near = cut_lineage(near)
    # at most ``positives`` a member; a negative score has no range below itself
    wanted = near.where("positive_score >= 0").groupBy("r").agg(
        F.collect_list(F.struct("slot", F.col("positive_score").alias("score"))).alias("wanted"))
    hard = lists.walk(members.drop("wanted").join(wanted, "r"), negatives, share)
    met = hard.join(near, ["r", "slot"]).join(members.select("r", F.col("vec_id").alias("anchor_id")), "r")
    return met.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.when(~F.col("no_id"), F.col("id")).alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


def relabelled(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """The rows that take part, as ``mine`` wants them: whole numbers, and one label
    in seven moved on, so that hard cases occur."""
    v, label, key = (F.col(f"`{c}`") for c in (vector_col, label_col, id_col))
    moved = F.when(key % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    return vectors.where(label.isNotNull() & usable(v)).select(key.cast("long").alias("vec_id"), moved.cast("long").alias("label"), quantised(v).alias("v"))


#: The same by comparing every anchor with every row, for DuckDB.
ORACLE = """
WITH fine AS (SELECT row_number() OVER () AS r, vec_id, embedding, label FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
q AS (SELECT r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM fine),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label AS al, b.r AS br, b.vec_id, b.label AS bl,
             CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM q a JOIN q b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST) AS slot FROM s WHERE al = bl) WHERE slot <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, p.slot, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.slot ORDER BY s.score DESC, s.vec_id NULLS LAST) AS rank
      FROM p JOIN s ON s.ar = p.ar AND s.bl <> s.al AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
