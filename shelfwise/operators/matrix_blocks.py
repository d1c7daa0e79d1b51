"""The stored rating matrix in compressed blocks, and dense tiles of it.

A block holds the cells of ``ROWS`` rows and ``COLUMNS`` columns: the rows that have
cells, where each one's cells begin, and the cells' columns and values in order.
Blocks are rows of a Parquet table, partitioned by row block and sorted by column block
within a file, so a tile reads only the folders of its rows and the row groups of its
columns.  A dense pivot of a whole matrix has no bound on its columns; a tile has the
width that the caller asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 256
COLUMNS = 4096
CELL = "row_idx bigint, col_idx bigint, value double"


def to_blocks(cells: DataFrame, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """``row_block, col_block, rows, offsets, columns, values`` of long cells (row_idx,
    col_idx, value).  Two groupings: a row's cells in a block, then the rows."""
    placed = cells.select(F.floor(F.col("row_idx") / rows).cast("int").alias("row_block"), F.floor(F.col("col_idx") / columns).cast("int").alias("col_block"),
                          "row_idx", F.struct("col_idx", F.col("value").cast("double").alias("value")).alias("cell"))
    lines = placed.groupBy("row_block", "col_block", "row_idx").agg(F.array_sort(F.collect_list("cell")).alias("line"))
    blocks = lines.groupBy("row_block", "col_block").agg(F.array_sort(F.collect_list(F.struct("row_idx", "line"))).alias("lines"))
    sizes = F.transform("lines", lambda x: F.size(x["line"]))
    begun = F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    flat = F.flatten(F.transform("lines", lambda x: x["line"]))
    return blocks.select("row_block", "col_block", F.transform("lines", lambda x: x["row_idx"]).alias("rows"), begun.alias("offsets"),
                         F.transform(flat, lambda c: c["col_idx"]).alias("columns"), F.transform(flat, lambda c: c["value"]).alias("values"))


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Writes blocks so that ranges of rows and columns can be read alone."""
    (blocks.repartition("row_block").sortWithinPartitions("row_block", "col_block")
     .write.partitionBy("row_block").parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def to_cells(blocks: DataFrame) -> DataFrame:
    """The long cells of blocks."""
    line = blocks.select(F.posexplode("rows").alias("at", "row_idx"), "offsets", "columns", "values")
    begin, size = F.col("offsets")[F.col("at")], F.col("offsets")[F.col("at") + 1] - F.col("offsets")[F.col("at")]
    part = lambda c: F.slice(c, begin + 1, size)
    cells = line.select("row_idx", F.explode(F.arrays_zip(part("columns").alias("c"), part("values").alias("v"))).alias("cell"))
    return cells.select("row_idx", F.col("cell.c").alias("col_idx"), F.col("cell.v").alias("value"))


def _between(c: str, first: int, end: int) -> Column:
    return F.col(c).between(first, end - 1)


def tile_cells(blocks: DataFrame, first_row: int, end_row: int, first_column: int, end_column: int,
               rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """The cells of a range of rows and columns; whole blocks outside are not read."""
    near = blocks.where(_between("row_block", first_row // rows, -(-end_row // rows)) & _between("col_block", first_column // columns, -(-end_column // columns)))
    return to_cells(near).where(_between("row_idx", first_row, end_row) & _between("col_idx", first_column, end_column))


def dense_tile(blocks: DataFrame, first_row: int, end_row: int, first_column: int, end_column: int,
               rows: int = ROWS, columns: int = COLUMNS, names: list[str] | None = None) -> DataFrame:
    """A row for every row of the range: ``row_idx`` and a column for every column of
    the range (``names``, or c0, c1, ...), 0 where there is no cell."""
    width = end_column - first_column
    names = names or [f"c{first_column + i}" for i in range(width)]
    cells = tile_cells(blocks, first_row, end_row, first_column, end_column, rows, columns)
    lines = cells.groupBy("row_idx").agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("line"))
    every = blocks.sparkSession.range(first_row, end_row).select(F.col("id").alias("row_idx"))
    met = every.join(lines, "row_idx", "left")
    value = lambda i: F.coalesce(F.col("line")[F.lit(first_column + i).cast("bigint")], F.lit(0.0))
    return met.select("row_idx", *[value(i).alias(n) for i, n in enumerate(names)])
