"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are laid out, in a shuffled order, as one stream of
words that is cut into blocks of equal length; the mix is a sequence of slots,
each of which takes the next block of one source.  Which source a slot takes is
read off the van der Corput sequence: the points of the sequence fall evenly
into the cumulative shares of the sources, so every stretch of the schedule has
nearly the target proportions.  A slot's rank among the slots of its source says
which block it takes; ranks beyond the last block start the source again.

Everything is DataFrame code.  No task holds a whole source: positions in a
source are running sums over hash buckets, and blocks meet slots on (source,
block).

Size of the schedule: with ``need`` slots for a source, of ``total`` in all, its
share of the unit interval is need / total.  The first 2**m points of the
sequence are the multiples of 2**-m, so with 2**m >= 2 * total every source gets
at least ``need`` of them; those ranked beyond are dropped.

Defined results: a null text has size 0; a null source is a source of its own,
the last in order; a document without words takes none; a repeated row is a
document of its own; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import WORD, cut_lineage, free_name, one_row_each, row_key, running_start, word_count

#: The weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
#: A source gives at most so many times its words.
MOST_REPEATS = 3
BLOCK_WORDS = 4096
SALT = "mix"
#: Points of the schedule that one task makes at a time.
CHUNK = 1 << 16


def source_targets(sized: DataFrame, weights=WEIGHTS, most_repeats: int = MOST_REPEATS,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per ``source`` of (source, size): ``source_no``, ``source_size``,
    ``target``, and how the schedule serves it: ``wanted`` (words, a whole
    number), ``blocks``, ``need`` (slots).

    The targets are a water level: level * weight, stopped at ``most_repeats``
    times the size.  With the sources in the order of the level that fills them,
    the level is the largest of (words not taken by the sources before) /
    (weight from here on).
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(cycle, ((F.col("source_no") - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", most_repeats * F.col("source_size").cast("double"))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    earlier = filled.rowsBetween(Window.unboundedPreceding, -1)
    onward = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = per.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
    per = per.withColumn("level", F.col("left") / F.sum("weight").over(onward))
    per = per.withColumn("target", F.least("cap", F.max("level").over(everything) * F.col("weight")))
    size, wanted = F.col("source_size"), F.col("wanted")
    per = per.withColumn("wanted", F.least(F.floor(F.col("target") + 0.5), most_repeats * size).cast("long"))
    per = per.withColumn("blocks", F.ceil(size / F.lit(block_words)).cast("long"))
    once = F.floor(wanted / size).cast("long")
    need = once * F.col("blocks") + F.ceil((wanted - once * size) / F.lit(block_words)).cast("long")
    per = per.withColumn("need", F.when(size > 0, need).otherwise(0))
    return per.select("source", "source_no", "source_size", "target", "wanted", "blocks", "need")


def _reversed_bits(i: Column, bits: Column) -> Column:
    """The lowest ``bits`` bits of ``i`` in reversed order."""
    return F.conv(F.reverse(F.lpad(F.bin(i), bits, F.lit("0"))), 2, 10).cast("long")


def schedule(sources: DataFrame) -> DataFrame:
    """The slots of the mix, (source_no, slot, rank, block, epoch), from the rows
    of ``source_targets``: ``slot`` orders the whole mix, ``rank`` the slots of a
    source; ``block`` is the block the slot takes in the ``epoch``-th reading of
    the source."""
    everything = Window.partitionBy()
    shares = sources.where("need > 0").withColumn("total", F.sum("need").over(everything))
    # lpad takes a whole column as the length, so the number of bits stays in the plan
    shares = shares.withColumn("bits", F.greatest(F.lit(1), F.ceil(F.log2(2 * F.col("total")))).cast("int"))
    shares = shares.withColumn("points", F.expr("shiftleft(1L, bits)"))
    through = F.sum("need").over(Window.orderBy("source_no"))
    shares = shares.withColumn("through", through)
    # the points i / points of this source are those with before <= i * total / points < through
    edge = lambda c: F.expr(f"cast(ceil(cast({c} as decimal(38,0)) * points / total) as long)")
    shares = shares.withColumn("first", edge("(through - need)")).withColumn("end", edge("through"))
    chunks = shares.where(F.col("end") > F.col("first")).select(
        "source_no", "need", "blocks", "bits", "end",
        F.explode(F.sequence("first", F.col("end") - 1, F.lit(CHUNK).cast("long"))).alias("from"))
    chunks = chunks.repartition("source_no", "from")
    points = chunks.select("source_no", "need", "blocks", "bits", F.explode(
        F.sequence("from", F.least(F.col("from") + CHUNK, F.col("end")) - 1)).alias("i"))
    slots = points.withColumn("slot", _reversed_bits(F.col("i"), F.col("bits"))).withColumn("one", F.lit(1).cast("long"))
    slots = slots.withColumn("stretch", F.expr("shiftright(slot, greatest(0, bits - 12))"))
    ranked = running_start(slots, ["source_no"], "stretch", ["slot"], "one", "rank").where("rank < need")
    return ranked.select("source_no", "slot", "rank", (F.col("rank") % F.col("blocks")).alias("block"),
                         F.floor(F.col("rank") / F.col("blocks")).cast("long").alias("epoch"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, most_repeats: int = MOST_REPEATS, block_words: int = BLOCK_WORDS, salt: str = SALT,
        with_key: bool = False) -> DataFrame:
    """What the mix takes of each document: one row per (document, epoch) with
    ``doc_id, size, source_size, target, source_no, start`` (its place in its
    source), ``epoch`` and ``taken``, the number of its first words that the
    epoch takes; a document of which nothing is taken has one row of 0.

    ``with_key`` adds ``row_key``, by which the rows of ``docs`` are found again.
    The shuffled order is that of md5(salt:id), so reruns agree.
    """
    key = row_key(docs) if with_key else F.lit(0).cast("long")
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                        word_count(f"`{text_col}`").alias("size"), key.alias("row_key"))
    # ids and numbers only: the texts are read once.  Rows are numbered as written, as
    # rows without words of one id would else be one
    sized = cut_lineage(sized).withColumn("row_no", F.monotonically_increasing_id())
    # the sums by source are few rows; written once, as three branches read them
    sources = cut_lineage(source_targets(sized, weights, most_repeats, block_words))
    # numbered by source without a join on the bare (possibly hot) source
    digest = F.md5(F.concat(F.lit(salt + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = sized.select("doc_id", "row_key", "row_no", "size", F.coalesce("source", F.lit("")).alias("name"),
                         F.col("source").isNull().alias("nameless"), digest.alias("digest"),
                         F.substring(digest, 1, 3).alias("bucket"))
    extra = sources.select(F.coalesce("source", F.lit("")).alias("name"), F.col("source").isNull().alias("nameless"),
                           "source_no", "source_size", "target", "wanted", "blocks")
    placed = running_start(keyed, ["name", "nameless"], "bucket", ["digest", "size", "row_key", "row_no"], "size", "start", extra)
    block = F.lit(block_words).cast("long")
    span = F.when(F.col("size") > 0, F.sequence(F.floor(F.col("start") / block).cast("long"),
                                                F.floor((F.col("start") + F.col("size") - 1) / block).cast("long")))
    pieces = placed.withColumn("block", F.explode_outer(span))
    pieces = pieces.withColumn("from", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
    pieces = pieces.withColumn("upto", F.least(F.col("start") + F.col("size") - F.col("block") * block, block))
    slots = schedule(sources).select("source_no", "block", "epoch")
    met = pieces.join(slots, ["source_no", "block"], "left")
    # the last slot of a source stops where its wanted words are reached
    reach = F.col("wanted") - F.col("epoch") * F.col("source_size") - F.col("block") * block
    got = F.greatest(F.lit(0), F.least(F.col("upto"), reach) - F.col("from"))
    met = met.withColumn("got", F.when(F.col("epoch").isNotNull(), got).otherwise(0).cast("long"))
    return met.groupBy("doc_id", "row_key", "row_no", "size", "source_size", "target", "source_no", "start", "epoch").agg(
        F.sum("got").cast("long").alias("taken"))


def mix_totals(docs: DataFrame, **options) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    return mix(docs, **options).groupBy("doc_id", "row_no", "size", "source_size", "target", "source_no", "start").agg(
        F.sum("taken").cast("long").alias("taken")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    length_col: str | None = None, **options) -> DataFrame:
    """The mix itself: a row per document and epoch that takes words of it, with
    the columns of ``docs``.  A document taken whole keeps its text; of a
    document at the end of a source's share the first words are kept, joined by
    spaces.  ``length_col``, if given, is set to the text's code points.
    """
    took = mix(docs, id_col, text_col, source_col, with_key=True, **options).where("taken > 0")
    # rows alike in all columns are told apart by their place; their takes are joined in one list
    # of at most repeats * epochs entries each
    takes = took.groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("epoch", "taken", "size")).alias("takes"))
    kept = one_row_each(docs, takes, id_col, "takes")
    take = free_name("take", kept.columns)
    kept = kept.withColumn(take, F.explode(kept.columns[-1]))
    taken, body = F.col(f"{take}.taken"), F.col(f"`{text_col}`")
    some = F.array_join(F.slice(F.regexp_extract_all(body, F.lit(WORD), F.lit(0)), F.lit(1), taken.cast("int")), " ")
    out = kept.withColumn(text_col, F.when(taken < F.col(f"{take}.size"), some).otherwise(body))
    if length_col:
        out = out.withColumn(length_col, F.length(f"`{text_col}`").cast(docs.schema[length_col].dataType))
    return out.select(*[f"`{c}`" for c in docs.columns])


#: The same totals from a closed form of each document's place, for DuckDB.
ORACLE = rf"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                      md5('{SALT}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
per AS (SELECT source, sum(size) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM sized GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][(no - 1) % 3 + 1] AS DOUBLE) AS w, CAST(3 * s AS DOUBLE) AS cap FROM per),
lv AS (SELECT *, (sum(s) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY cap / w, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, s, least(cap, max(level) OVER () * w) AS target FROM lv),
t2 AS (SELECT *, least(floor(target + 0.5), 3 * s)::BIGINT AS wanted FROM t),
d AS (SELECT a.doc_id, a.size, t2.s, t2.target, t2.wanted,
             coalesce(sum(size) OVER (PARTITION BY a.source ORDER BY digest, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized a JOIN t2 ON a.source IS NOT DISTINCT FROM t2.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(s AS BIGINT) AS source_size, target,
       CAST(CASE WHEN s = 0 THEN 0 ELSE (wanted // s) * size + greatest(0, least(wanted % s - start, size)) END AS BIGINT) AS taken
FROM d
"""
