"""Near-duplicates by SimHash fingerprints and pivot distance tables.

1. Fingerprints (Python, one pass over the texts).
2. Equal fingerprints become one point, so copies are never compared.
3. Pivot table: the Hamming distance of every point to ``PIVOTS`` fixed reference
   fingerprints.  By the triangle inequality two points within d bits differ by
   at most d in every coordinate.
4. Pairs are looked for within blocks that lose none: of SEGMENTS parts of the 64
   bits, d differing bits leave SEGMENTS - d parts equal, so points are grouped by
   each choice of that many parts.  (Coordinates alone cannot serve as join keys:
   distances to a reference crowd around 32, see the README.)
5. In a block the points are sorted by the first coordinate, pairs outside its
   window of d are never formed, pairs whose largest coordinate difference
   exceeds d are discarded, and the survivors are verified bit by bit.
6. A block's links leave the task as a spanning forest, not as all pairs, which
   keeps every component.  Blocks of more than ``BLOCK`` points are dealt out as
   pairs of sub-blocks, so no task gets an unbounded group.
7. Components by star contraction.

Defined results: null and empty texts (and texts of white space) have
fingerprint 0 and link like any other; texts of fewer words than a shingle are
one shingle; an id is reachable from itself; null ids never are a component's
smallest, and a component of null ids alone has a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfwise.llm.common import bound_batches, cut_lineage, one_row_each, row_key, words
from shelfwise.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
PIVOTS = 16
BLOCK = 2048
SEGMENT_BITS = (11, 11, 11, 11, 10, 10)
#: Shingles of a long text whose bits are counted at a time.
PART = 1 << 16
#: Links of a batch that are held before they are reduced to a forest.
HELD_LINKS = 1 << 20
#: Parts into which the points of a component are dealt when they get its id.
SALTS = 32


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of a text as an unsigned number."""
    w = words(text)
    if not w:
        return 0
    w = [x.lower() for x in w]  # of bytes: A-Z only
    k = min(shingle_words, len(w))
    joined = b" ".join(w)
    ends = [e + i for i, e in enumerate(accumulate(map(len, w)))]
    starts = [0, *[e + 1 for e in ends[:-1]]]
    digest, n = xxhash.xxh64_digest, len(w) - k + 1
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, PART):
        upto = min(at + PART, n)
        hashes = b"".join([digest(joined[a:b], seed) for a, b in zip(starts[at:upto], ends[at + k - 1:upto + k - 1])])
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a (signed) long."""
    @pandas_udf("long")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            prints = np.fromiter((simhash(t, shingle_words) for t in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(prints.view(np.int64))
    return made(text)


def _pivots() -> list[int]:
    """The reference fingerprints: hashes of 0, 1, 2, ..., as signed longs."""
    made = np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(PIVOTS)], dtype=np.uint64)
    return made.view(np.int64).tolist()


def _packed(fp: Column, pivots: list[int]) -> Column:
    """Up to eight distances to references, a byte each, in one long."""
    out = F.lit(0).cast("long")
    for i, p in enumerate(pivots):
        d = F.bit_count(fp.bitwiseXOR(F.lit(p).cast("long"))).cast("long")
        out = out.bitwiseOR(F.shiftleft(d, 8 * i))
    return out


def _block_keys(fp: Column, max_bits: int) -> Column:
    """One key for each choice of parts that d differing bits may leave equal."""
    same = len(SEGMENT_BITS) - max_bits
    if same < 1:
        raise ValueError(f"max_bits must be below {len(SEGMENT_BITS)}")
    at = [0, *accumulate(SEGMENT_BITS)]
    keys = []
    for i, chosen in enumerate(combinations(range(len(SEGMENT_BITS)), same)):
        mask = sum(((1 << SEGMENT_BITS[s]) - 1) << at[s] for s in chosen)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.struct(F.lit(i).cast("byte").alias("way"), fp.bitwiseAND(F.lit(mask).cast("long")).alias("part")))
    return F.array(*keys)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links a-b among n points, as links to the smallest."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, label[a], low)
        np.minimum.at(after, label[b], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def links_in_blocks(fp: np.ndarray, pivots: np.ndarray, side: np.ndarray, sizes: np.ndarray, max_bits: int):
    """Spanning links (fp, fp) of consecutive blocks of points.  ``pivots``: a row
    of coordinates for each point.  ``side``: points of one block with both sides
    present are only compared across."""
    block = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((pivots[:, 0], block))
    fp, pivots, side = fp[order], pivots[order], side[order]
    end = np.repeat(np.cumsum(sizes), sizes)
    mixed = np.repeat(np.maximum.reduceat(side, np.cumsum(sizes) - sizes) != np.minimum.reduceat(side, np.cumsum(sizes) - sizes), sizes)
    i, lag = np.arange(len(fp)), 0
    a, b, held = [], [], 0
    while len(i):
        lag += 1
        i = i[i + lag < end[i]]
        i = i[pivots[i + lag, 0] - pivots[i, 0] <= max_bits]  # sorted: no later lag comes back into the window
        j = i + lag
        keep = (np.abs(pivots[i] - pivots[j]) <= max_bits).all(axis=1) & (~mixed[i] | (side[i] != side[j]))
        x, y = i[keep], j[keep]
        keep = np.bitwise_count(fp[x] ^ fp[y]) <= max_bits
        a.append(x[keep])
        b.append(y[keep])
        held += int(keep.sum())
        if held > HELD_LINKS:
            a, b = ([z] for z in _forest(np.concatenate(a), np.concatenate(b), len(fp)))
            held = len(a[0])
    if held:
        x, y = _forest(np.concatenate(a), np.concatenate(b), len(fp))
        return fp[x], fp[y]
    return fp[:0], fp[:0]


def fingerprint_links(points: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between different fingerprints (column ``fp``, distinct) within
    ``max_bits``: not all of them, but enough to connect what they connect."""
    keys = points.select("fp", F.explode(_block_keys(F.col("fp"), max_bits)).alias("k")).select("fp", "k.way", "k.part")
    shared = keys.groupBy("way", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = keys.join(shared, ["way", "part"])
    # a block beyond the size is dealt out as pairs of its sub-blocks
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), parts).cast("int")
    pair = lambda other: F.struct(F.least(own, other).alias("x"), F.greatest(own, other).alias("y"))
    meets = F.transform(F.sequence(F.lit(0), parts - 1), pair)
    members = members.select("way", "part", "fp", own.alias("side"), F.explode(meets).alias("pair"))
    pivots = _pivots()
    point = F.struct("fp", _packed(F.col("fp"), pivots[:8]).alias("p0"), _packed(F.col("fp"), pivots[8:]).alias("p1"), "side")
    grouped = members.groupBy("way", "part", "pair").agg(F.collect_list(point).alias("points")).where("size(points) > 1").select("points")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            if not len(lists):
                continue
            rows = lists.flatten()
            long = lambda f: rows.field(f).to_numpy(zero_copy_only=False)
            table = np.ascontiguousarray(np.stack([long("p0"), long("p1")], axis=1)).view(np.int8).astype(np.int16)
            sizes = np.diff(lists.offsets.to_numpy())
            x, y = links_in_blocks(long("fp").view(np.uint64), table, long("side"), sizes, max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["a", "b"])

    return grouped.mapInArrow(linked, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, with_key: bool = False) -> DataFrame:
    """``doc_id, fp`` (signed long) and ``component_id`` of every document; with
    ``with_key`` also ``row_key`` by which the row is found again."""
    bound_batches(docs.sparkSession)
    key = row_key(docs) if with_key else F.lit(0).cast("long")
    prints = docs.select(F.col(id_col).alias("doc_id"), key.alias("row_key"), fingerprint(F.col(text_col), shingle_words).alias("fp"))
    prints = cut_lineage(prints)  # ids and hashes: the texts are read once
    points = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    found = components(fingerprint_links(points.select("fp"), max_bits))
    labelled = points.join(found, points.fp == found.node, "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    shared = cut_lineage(labelled.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("component", "component_id"))
    # one component may hold a third of all points: they meet its id on (component, salt)
    salts = shared.select("component", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    members = found.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salts, ["component", "salt"])
    members = members.select(F.col("node").alias("fp"), "component_id").unionByName(
        shared.select(F.col("component").alias("fp"), "component_id"))
    # written, so that the join below is one of two shuffles and a fingerprint of very many copies can be split
    by_print = cut_lineage(points.join(members, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id")))
    out = prints.join(by_print, "fp")
    return out.select("doc_id", "fp", "component_id", *(["row_key"] if with_key else []))


def fingerprint_text(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id (null
    ids last); of rows that share it, one."""
    found = near_duplicates(docs, id_col, text_col, with_key=True, **options)
    # a component of null ids alone is told by its fingerprint
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    first = found.groupBy(*[g.alias(n) for g, n in zip(group, ("c", "f"))]).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("row_key"))).alias("k"))
    return one_row_each(docs, first.select("k.doc_id", "k.row_key"), id_col)
