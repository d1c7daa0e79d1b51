"""Compressed matrix blocks: round trip, tiles, and what a tile reads."""

import random

from shelfwise.operators import matrix_blocks as mb


def _cells(seed, n, rows, columns):
    r = random.Random(seed)
    return sorted({(r.randrange(rows), r.randrange(columns)) for _ in range(n)})


def _stored(spark, tmp_path, cells):
    df = spark.createDataFrame([(i, j, float(i * 100 + j)) for i, j in cells], mb.CELL)
    mb.write_blocks(mb.to_blocks(df, 4, 16), str(tmp_path / "m"))
    return mb.read_blocks(spark, str(tmp_path / "m"))


def test_round_trip_and_block_sizes(spark, tmp_path):
    cells = _cells(1, 300, 30, 70)
    blocks = _stored(spark, tmp_path, cells)
    assert sorted((r.row_idx, r.col_idx, r.value) for r in mb.to_cells(blocks).collect()) == [(i, j, float(i * 100 + j)) for i, j in cells]
    for b in blocks.collect():
        assert len(b.offsets) == len(b.rows) + 1 and b.offsets[-1] == len(b.columns) == len(b["values"]) <= 64
        assert b.rows == sorted(set(b.rows)) and {x // 4 for x in b.rows} == {b.row_block} and {x // 16 for x in b.columns} == {b.col_block}


def test_tiles(spark, tmp_path):
    cells = _cells(2, 200, 30, 70)
    blocks = _stored(spark, tmp_path, cells)
    for first, end, left, right in [(0, 30, 0, 3), (5, 9, 14, 19), (3, 4, 69, 70), (28, 40, 60, 75), (6, 6, 0, 2)]:
        got = {tuple(r) for r in mb.dense_tile(blocks, first, end, left, right, 4, 16).collect()}
        assert got == {(i, *(float(i * 100 + j) if (i, j) in set(cells) else 0.0 for j in range(left, right))) for i in range(first, end)}


def test_a_tile_reads_its_blocks_only(spark, tmp_path):
    blocks = _stored(spark, tmp_path, _cells(3, 300, 64, 64))
    plan = mb.tile_cells(blocks, 8, 12, 0, 16, 4, 16)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(row_block" in plan and "PushedFilters: [IsNotNull(col_block)" in plan


def test_no_cells(spark, tmp_path):
    blocks = mb.to_blocks(spark.createDataFrame([], mb.CELL))
    assert mb.to_cells(blocks).collect() == [] and [tuple(r) for r in mb.dense_tile(blocks, 0, 2, 0, 1, names=["user 7"]).collect()] == [(0, 0.0), (1, 0.0)]
