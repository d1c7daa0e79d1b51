"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import cut_lineage

__all__ = ["WORD", "blank_if_null", "bound_batches", "cut_lineage", "free_name", "held_out", "one_row_each",
           "row_key", "running_start", "scan", "with_value", "word_count", "words"]

#: A word: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Array elements that a scan takes at a time.
CHUNK = 128

ARROW_ROWS = 1000
ARROW_BYTES = "16m"


def bound_batches(spark: SparkSession) -> None:
    """Keep an Arrow batch to a bounded number of rows and bytes, so that a run
    of very long texts cannot fill a Python worker."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= ARROW_ROWS:
        spark.conf.set(rows, str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() parts at ASCII white space
    exactly, which is what ``WORD`` says."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def blank_if_null(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def word_count(text: Column | str) -> Column:
    """Number of words of a text as long; null counts as empty."""
    return F.regexp_count(blank_if_null(text), F.lit(WORD)).cast("long")


def held_out(doc_id: Column | str) -> Column:
    """True for rows whose labels must not be learned from: crc32 of the id as
    text leaves remainder 1 of 3.  A null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(F.coalesce(c.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def free_name(base: str, *taken: Sequence[str]) -> str:
    """``base``, with underscores added until no given column has that name
    (column names are compared without case, as Spark does)."""
    used = {c.lower() for names in taken for c in names}
    while base.lower() in used:
        base += "_"
    return base


def row_key(docs: DataFrame) -> Column:
    """A hash of every column of a row: tells apart rows that share an id."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def one_row_each(docs: DataFrame, chosen: DataFrame, id_col: str, more: str | None = None) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (``doc_id``, ``row_key``, and ``more``
    if given) names, one row for rows that are alike in all columns.  ``row_key``
    must hold ``row_key`` of the row.  ``more`` is added as the last column, under
    a name that ``docs`` does not have.

    One shuffle of the texts: the join and the removal of repeated rows use the
    same partitioning.
    """
    key, own_id, own_key = (free_name(n, docs.columns) for n in ("_row_key", "_chosen_id", "_chosen_key"))
    extra = [F.col(more).alias(free_name(more, docs.columns))] if more else []
    left = docs.withColumn(key, row_key(docs))
    right = chosen.select(F.col("doc_id").alias(own_id), F.col("row_key").alias(own_key), *extra)
    joined = left.join(right, (F.col(key) == F.col(own_key)) & F.col(f"`{id_col}`").eqNullSafe(F.col(own_id)))
    return joined.drop(own_id, own_key).dropDuplicates([key, id_col]).drop(key)


def running_start(rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], value: str,
                  out: str, extra: DataFrame | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all earlier rows of the row's
    group, in the order (``bucket``, ``order``).

    A group may hold a third of all rows, so no task gets a whole group: rows are
    summed by (group, bucket), the few sums of a group are accumulated, and only
    the rows of one bucket meet in a task.  ``extra``: columns by ``group`` to be
    added to the rows on the way, so that no join on the bare group is needed.
    """
    keys = [*group, bucket]
    sums = rows.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    if extra is not None:
        base = base.join(extra, list(group))
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_in", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return placed.join(base, keys).withColumn(out, (F.col("_base") + F.col("_in")).cast("long")).drop("_base", "_in")


def with_value(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def scan(items: Column, zero: Column, step: Callable, emit: Callable, kind: str) -> Column:
    """``emit(state, item)`` of every item, in order, where ``state`` is the fold of
    ``step(state, item)`` over the items before it.  ``kind`` is the type of what
    is emitted.  Chunk by chunk, so that no long array is copied for every item."""
    def through(state: Column, chunk: Column) -> Column:
        start = F.struct(state.alias("s"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(chunk, start, lambda a, x: F.struct(
            step(a["s"], x).alias("s"), F.concat(a["out"], F.array(emit(a["s"], x))).alias("out")))

    def over(items: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))
        chunks = F.transform(numbers, lambda i: F.slice(items, i * CHUNK + 1, CHUNK))
        start = F.struct(zero.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        whole = F.aggregate(chunks, start, lambda a, c: with_value(through(a["s"], c), lambda t: F.struct(
            t["s"].alias("s"), F.concat(a["out"], F.array(t["out"])).alias("out"))))
        return F.when(F.size(items) > 0, F.flatten(whole["out"])).otherwise(F.array().cast(f"array<{kind}>"))

    return with_value(items, over)
