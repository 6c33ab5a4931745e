"""Greedy near-duplicate removal on vectors: a row stays iff no earlier row that stayed is more similar than a threshold.

That is the lexicographically first maximal independent set of the similarity graph. Pairs come from an exact join in blocks
(matrix products in Arrow batches, only pairs above the threshold leave a block), and rounds settle them stretch by stretch: a
row with no undecided or kept earlier neighbour stays, a row with a kept earlier neighbour goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import importable
from .scratch import cut

FLOOR = 1e-9
#: Blocks of a table in a join with itself, so that a row is sent so many times; more only where a block would outgrow BLOCK_BYTES.
BLOCKS = 16
BLOCK_BYTES = 64 << 20
#: Rows of the first stretch that is settled, how much longer the next ones are, and pairs a row beyond which a stretch is halved.
FIRST, STEP, PAIRS = 4096, 4, 256


def _vectors(df: DataFrame, order: str, vector: str) -> tuple[DataFrame, int, int]:
    """(id, v) with vectors of the commonest length, their number and length."""
    importable(df.sparkSession)
    v = F.col(vector) if dict(df.dtypes)[vector] == "array<float>" else F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = df.select(F.col(order).cast("long").alias("id"), v.alias("v")).where("v IS NOT NULL AND id IS NOT NULL")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    n, d = (common["count"], common["d"]) if common else (0, 0)
    return rows.where(F.size("v") == d), n, d


def _blocks(n: int, d: int, block: int, most: int = BLOCKS) -> int:
    return max(1, min(-(-n // block), most), -(-n * max(d, 1) * 8 // BLOCK_BYTES))


def _own(blocks: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long")


def _in_cells(rows: DataFrame, cells: int, run, schema: str) -> DataFrame:
    """``run`` over rows (cell, side, id, v), each cell in a task of its own, side 0 first."""
    return rows.repartitionById(cells, F.col("cell").cast("int")).sortWithinPartitions("cell", "side").mapInArrow(run, schema)


def _pieces(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(cell, side, ids, unit vectors) of sorted rows, up to ``block`` rows at a time."""

    def whole(key, parts):
        x = np.concatenate([p[1] for p in parts])
        return *key, np.concatenate([p[0] for p in parts]), x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), FLOOR)

    now, held, size = None, [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, side, ids = (batch.column(c).to_numpy() for c in range(3))
        x = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
        s = 0
        while s < len(ids):
            key = (int(cell[s]), int(side[s]))
            if held and (key != now or size == block):
                yield whole(now, held)
                held, size = [], 0
            now = key
            same = (cell[s : s + block - size] == key[0]) & (side[s : s + block - size] == key[1])
            e = s + (len(same) if same.all() else int(same.argmin()))
            held.append((ids[s:e], x[s:e]))
            size, s = size + e - s, e
    if held:
        yield whole(now, held)


def similar_pairs(df: DataFrame, order: str, vector: str, threshold: float = 0.92, block: int = 1024) -> DataFrame:
    """(a, b), a < b in order, with cosine above the threshold; vectors of null or other length take no part.

    A task joins two of at most BLOCKS blocks (more only beyond BLOCK_BYTES), the second in pieces of ``block`` rows.
    """
    return _pairs(*_vectors(df, order, vector), threshold, block)


def _pairs(rows: DataFrame, n: int, d: int, threshold: float, block: int) -> DataFrame:
    blocks = _blocks(n, d, block)
    rows = rows.withColumn("own", _own(blocks)).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    low, high = F.least("own", "k"), F.greatest("own", "k")
    # cells of the upper triangle, row by row
    cell = F.expr(f"least(own, k) * {blocks} - least(own, k) * (least(own, k) - 1) div 2") + high - low
    rows = rows.select(cell.alias("cell"), (F.col("own") != low).cast("int").alias("side"), "id", "v")

    squares = {i * blocks - i * (i - 1) // 2 for i in range(blocks)}

    def pairs(left, right):
        at = np.flatnonzero((left[1] @ right[1].T > threshold).ravel())
        i, j = np.divmod(at, len(right[0]))
        a, b = left[0][i], right[0][j]
        keep = a < b if left is right else a != b
        a, b = a[keep], b[keep]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first = None, []
        for cell, side, ids, x in _pieces(batches, block):
            if cell != now:
                now, first = cell, []
            piece = (ids, x)
            if side == 0:
                first.append(piece)
            # a block with itself has no second side
            for left in first if side or cell in squares else ():
                yield pairs(left, piece)

    return _in_cells(rows, blocks * (blocks + 1) // 2, run, "a long, b long")


def _covered(kept: DataFrame, n_kept: int, rest: DataFrame, n_rest: int, d: int, threshold: float, block: int) -> DataFrame:
    """(v): ids of ``rest`` with a vector of ``kept`` above the threshold. Only ``kept`` is held, in as few blocks as fit."""
    rows_of, columns = _blocks(n_kept, d, block, 1), max(1, min(-(-n_rest // (4 * block)), max(BLOCKS, n_rest // max(n_kept, 1))))
    spread_over = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    held = kept.withColumn("own", _own(rows_of)).withColumn("k", spread_over(columns)).select((F.col("own") * columns + F.col("k")).alias("cell"), F.lit(0).alias("side"), "id", "v")
    asked = rest.withColumn("own", _own(columns)).withColumn("k", spread_over(rows_of)).select((F.col("k") * columns + F.col("own")).alias("cell"), F.lit(1).alias("side"), "id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first = None, []
        for cell, side, ids, x in _pieces(batches, block):
            if cell != now:
                now, first = cell, []
            if side == 0:
                first.append(x)
                continue
            gone = np.zeros(len(ids), dtype=bool)
            for left in first:
                at = np.flatnonzero(~gone)
                gone[at] = (left @ x[at].T > threshold).any(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[gone])], names=["v"])

    return _in_cells(held.unionAll(asked), rows_of * columns, run, "v long")


def _settled(edges: DataFrame) -> DataFrame | None:
    """(v): the rows that go by the rule, of the graph of these pairs; None if there are none."""
    edges, gone = cut(edges.distinct()), None
    while not edges.isEmpty():
        # a vertex without an undecided earlier neighbour is settled: it stays
        later = edges.select(F.col("b").alias("v")).distinct()
        stays = edges.select(F.col("a").alias("v")).distinct().join(later, "v", "left_anti")
        out = cut(edges.join(stays.withColumnRenamed("v", "a"), "a", "left_semi").select(F.col("b").alias("v")).distinct())
        gone = out if gone is None else gone.unionAll(out)
        edges = cut(edges.join(out.withColumnRenamed("v", "a"), "a", "left_anti").join(out.withColumnRenamed("v", "b"), "b", "left_anti").join(stays.withColumnRenamed("v", "a"), "a", "left_anti"))
    return gone


def _first_copies(rows: DataFrame, threshold: float) -> DataFrame:
    """The rows without later copies of a vector, which go whatever their first one does; all rows if an id is there twice."""
    if threshold >= 1 - FLOOR or not rows.groupBy("id").count().where("count > 1").isEmpty():
        return rows
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    proper = (square > FLOOR) & (square < float("inf"))
    return rows.where(proper).groupBy("v").agg(F.min("id").alias("id")).select("id", "v").unionAll(rows.where(~proper))


def semantic_dedup(df: DataFrame, order: str, vector: str, threshold: float = 0.92, block: int = 1024) -> DataFrame:
    """The rows that stay, in the sense above; rows without a vector stay.

    Rows are settled in stretches of their order, each STEP times as long as all before. What a settled stretch keeps first
    removes its neighbours from the rest, so that few pairs are left in a stretch, and those alone are ever written. A
    stretch of more than PAIRS pairs a row is halved.
    """
    rows, n, d = _vectors(df, order, vector)
    rows = cut(rows)
    left = cut(_first_copies(rows, threshold))
    parts = [cut(rows.select(F.col("id").alias("v")).join(left.select(F.col("id").alias("v")), "v", "left_anti"))]
    shares = [FIRST * STEP**k / n for k in range(64) if FIRST * STEP**k < n]
    ends: list[int | None] = [*sorted({int(x) for x in left.approxQuantile("id", shares, 0.001)}), None] if shares else [None]
    while ends:
        end = ends.pop(0)
        now = left if end is None else left.where(F.col("id") <= end)
        m = now.count()
        pairs = _pairs(now, m, d, threshold, block)
        if m > FIRST and pairs.count() > PAIRS * m:
            lowest, middle, highest = now.agg(F.min("id"), F.expr("percentile_approx(id, 0.5)"), F.max("id")).first()
            middle = middle if middle < highest else (lowest if lowest < highest else None)
            if middle is not None:
                ends[:0] = [middle, end]
                continue
        gone = _settled(pairs)
        if gone is not None:
            parts.append(gone)
        if end is None:
            break
        kept = now if gone is None else now.join(gone.select(F.col("v").alias("id")).distinct(), "id", "left_anti")
        rest = left.where(F.col("id") > end)
        out = cut(_covered(kept, kept.count(), rest, rest.count(), d, threshold, block).distinct())
        parts.append(out)
        left = cut(rest.join(out.withColumnRenamed("v", "id"), "id", "left_anti"))
    gone = reduce(DataFrame.unionAll, parts)
    return df.join(gone.select(F.col("v").alias(order)).distinct(), order, "left_anti")
