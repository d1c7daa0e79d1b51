"""A query set against all rows of a table, in blocks.

Some scores are defined for every (query, row) and no key prunes them.  Queries
and rows are dealt into blocks of bounded size by a hash; a task gets one block
of each and returns only what is kept of the pairs.  No pair becomes a row, no
side passes the driver, and a lost task is one pair of blocks to redo.

Many queries (Arrow only): a shuffle would hold every row once for each block of
queries.  The blocks of both sides are written once to the checkpoint folder, and a
task has one block of queries, or a part of it, and reads the blocks of rows from there, one at a time.
Disk grows with the two sides, not with their product.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shelfwise import session

QUERY_BLOCK = 1024
ROW_BLOCK = 16_384
# Tasks that small inputs are parted into, at most, and the rows that a block then keeps at least.
TASKS = 64
FEW = 256
# Column of a stored row: the part of its block, and the queries that a part has at least.
PART = "_part"
PART_QUERIES = 8192
# Most partitions of the block pairs.
MOST_PARTITIONS = 4096


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it."""
    local = re.match(r"file:/+(.*)", uri)
    if local:
        return arrow_fs.LocalFileSystem(), "/" + local[1]
    return arrow_fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def stored_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, with the scheme of its store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{session.ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def store_blocks(df: DataFrame, key: str, n: int, parts: int = 1, order: tuple[str, ...] = ()) -> str:
    """Writes ``df`` in ``n`` blocks by a hash of ``key``, with the number of its ``PART``
    of the block in each row; the folder."""
    for seen in session.BEFORE_CUT:
        seen(df)
    folder = stored_folder(df.sparkSession, "blocks")
    dealt = df.withColumns({PART: F.pmod(F.hash(key), F.lit(parts)).cast("int"),
                            "_block": F.pmod(F.xxhash64(key), F.lit(n)).cast("int")}).repartition(n, "_block")
    if order:
        dealt = dealt.sortWithinPartitions("_block", *order)
    dealt.write.partitionBy("_block").parquet(folder, compression="zstd")
    return folder


def stored_block(folder: str, block: int, part: int | None = None) -> pa.Table | None:
    """A block that was written, or a part of it; none if it has no rows."""
    files, path = file_system(folder)
    found = files.get_file_info(arrow_fs.FileSelector(f"{path}/_block={block}", allow_not_found=True))
    tables = []
    for name in sorted(f.path for f in found if f.path.endswith(".parquet")):
        with files.open_input_file(name) as f:
            table = pq.ParquetFile(f).read(use_threads=False)
            own = table if part is None else table.filter(pc.equal(table.column(PART), part))
            tables.append(own.drop_columns([PART]))
    found = pa.concat_tables(tables) if tables else None
    return found if found is not None and len(found) else None


def _stored_blocks(queries: DataFrame, query_key: str, queries_in: int, n_query: int, rows: DataFrame, row_key: str, n_row: int, score: Callable,
                   schema: str, ready: Callable | None, carried: bool, order: tuple[str, ...]) -> DataFrame:
    spark = rows.sparkSession
    # few blocks of queries are parted for the tasks, each of which reads all rows
    parts = max(1, min(-(-TASKS // n_query), -(-queries_in // n_query) // PART_QUERIES))
    asked = store_blocks(queries, query_key, n_query, parts, order)
    met = asked if rows is queries and n_row == n_query and row_key == query_key else store_blocks(rows, row_key, n_row, order=order)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number in (x for b in batches for x in b.column(0).to_pylist()):
            q, found = stored_block(asked, *divmod(number, parts)), None
            if q is None:
                continue
            q = ready(q) if ready else q
            for i in range(n_row):
                r = stored_block(met, i)
                if r is None:
                    continue
                if carried:
                    found = score(q, r, found)
                else:
                    yield from score(q, r).to_batches()
            if found is not None:
                yield from found.to_batches()

    n = n_query * parts
    return spark.range(0, n, 1, n).mapInArrow(scored, schema)


def _dealt(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def query_blocks(queries: DataFrame, query_key: str, rows: DataFrame, row_key: str,
                 score: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str,
                 query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK, *, arrow: bool = False,
                 ready: Callable | None = None, carried: bool = False, order: tuple[str, ...] = ()) -> DataFrame:
    """``score(queries, rows)`` for every pair of blocks; the results together.

    Rows with one key share a block.  The two counts size the blocks (a row count
    is read from Parquet footers where the input is a plain scan).  ``arrow``: the
    blocks are Arrow tables, and both sides are parted for the cluster's tasks, so
    that neither is repeated for each of many small blocks of the other.

    Arrow blocks of more than ``query_block`` queries are stored.  ``ready`` is applied
    to a block of queries before it is scored, ``order`` sorts the rows of a stored
    block, and with ``carried`` the score gets the result of the blocks before as a
    third argument (none at first) and returns that of all so far."""
    queries_in = queries.count()
    rows_in = queries_in if rows is queries else rows.count()
    if arrow and queries_in > query_block and rows_in:
        n_query, n_row = -(-queries_in // query_block), -(-rows_in // row_block)
        return _stored_blocks(queries, query_key, queries_in, n_query, rows, row_key, n_row, score, schema, ready, carried, order)
    n_query = max(1, -(-queries_in // query_block))
    n_row = max(1, -(-rows_in // row_block))
    # small inputs still use the cluster's tasks
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if arrow:
        while n_query * n_row < min(TASKS, partitions) and max(queries_in / n_query, rows_in / n_row) > FEW:
            if queries_in / n_query > rows_in / n_row:
                n_query += 1
            else:
                n_row += 1
    else:
        n_row = max(n_row, min(TASKS, partitions // n_query))
    blocks = ["query_block", "row_block"]
    # a set number: the work of a pair does not go by its bytes, by which adaptive execution would merge them into few tasks
    n = min(MOST_PARTITIONS, 2 * n_query * n_row)
    left = _dealt(queries, query_key, "query_block", n_query, "row_block", n_row).repartition(n, *blocks)
    right = _dealt(rows, row_key, "row_block", n_row, "query_block", n_query).repartition(n, *blocks)

    def scored(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({c.split()[0]: pd.Series([], dtype=object) for c in schema.split(", ")})
        return score(q, r)

    def scored_tables(q: pa.Table, r: pa.Table) -> pa.Table:
        if not len(q) or not len(r):
            return empty
        q = ready(q) if ready else q
        return score(q, r, None) if carried else score(q, r)

    if arrow:
        empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
        return left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInArrow(scored_tables, schema)
    return left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInPandas(scored, schema)
