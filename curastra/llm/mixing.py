"""Mixing sources to target weights by Pfair scheduling.

Documents of a source, in a random but fixed order, form blocks of BLOCK rows. A source of weight w (of a sum of one) gives
its i-th block (from 1) the release time floor((i - 1) / w) and the deadline ceil(i / w); earliest deadline first, among
released blocks, fills one slot at a time. Weights are exact fractions, so that at every slot each source is less than one
block away from its target weight, as long as it has blocks, however long the table. Every block gets its own slot: one
task walks through the blocks (not the rows) and holds two blocks of each source. When a source runs out, its next slot
stays empty, then the others go on in their own windows; no row is dropped or repeated.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, string_columns, table

BLOCK = 32
PERIOD = 4096
#: Default weights are the sources' row counts to this power.
TEMPER = 0.7
ROWS_PER_PART = 2_000
#: Blocks in a batch of the schedule.
_TURNS = 1 << 16
_MD5_CELLS = 1 << 16


def shares(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source in a period, by largest remainders; every source with a weight gets one at least."""
    weights = {k: w for k, w in weights.items() if w > 0}
    while period < 4 * len(weights):
        period *= 2
    total = sum(Fraction(w) for w in weights.values())
    exact = {k: Fraction(w) * (period - len(weights)) / total for k, w in weights.items()}
    out = {k: 1 + int(x) for k, x in exact.items()}
    by_rest = sorted(weights, key=lambda k: (int(exact[k]) - exact[k], k))
    for k in by_rest[: period - sum(out.values())]:
        out[k] += 1
    return out


def schedule(slots: dict[str, int]) -> list[str]:
    """One period: the source of each slot, by earliest deadline first among released blocks."""
    period = sum(slots.values())
    release: list[list[tuple[int, str]]] = [[] for _ in range(period + 1)]
    for k, c in slots.items():
        for i in range(1, c + 1):
            release[(i - 1) * period // c].append((-(-i * period // c), k))
    ready: list[tuple[int, int, str]] = []
    out = []
    for t in range(period):
        for deadline, k in release[t]:
            heapq.heappush(ready, (deadline, -slots[k], k))
        deadline, _, k = heapq.heappop(ready)
        assert t < deadline, "a set of weights that sums to one can't miss a deadline"
        out.append(k)
    return out


def exact(weights: dict[str, float]) -> dict[str, int]:
    """The weights above 0 as integers in exactly the same proportion."""
    given = {k: Fraction(w) for k, w in weights.items() if w > 0}
    unit = math.lcm(*[w.denominator for w in given.values()])
    return {k: int(w * unit) for k, w in given.items()}


def turns(weights: dict[str, int], blocks: dict[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block from 0, slot) of all blocks: earliest deadline first, in windows of the exact weights.

    Sources of ``blocks`` without a weight follow behind, one after another.
    """
    total = sum(weights.values())
    later = [(0, k, 0) for k in weights if blocks.get(k)]
    heapq.heapify(later)
    ready: list[tuple[int, int, str, int]] = []
    t, end = 0, 0
    while later or ready:
        while later and later[0][0] <= t:
            _, k, i = heapq.heappop(later)
            heapq.heappush(ready, (-(-(i + 1) * total // weights[k]), -weights[k], k, i))
            if i < blocks[k]:  # one block past the last, whose slot stays empty
                heapq.heappush(later, ((i + 1) * total // weights[k], k, i + 1))
        if not ready:
            t = later[0][0]
            continue
        deadline, _, k, i = heapq.heappop(ready)
        assert t < deadline, "a set of weights that sums to one can't miss a deadline"
        if i < blocks[k]:
            yield k, i, t
            end = t + 1
        t += 1
    for k in sorted(set(blocks) - set(weights)):
        for i in range(blocks[k]):
            yield k, i, end + i
        end += blocks[k]


def tempered(counts: dict[str, int], power: float = TEMPER) -> dict[str, float]:
    return {k: n**power for k, n in counts.items() if n > 0}


def place(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", period: int | None = None) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``block`` (of its source, from 0), ``slot`` and ``place`` (rows in order).

    ``weights`` are by source, in any unit; without them the row counts to the power TEMPER. A null source is the
    source ''. Sources without a weight come last, in slots after all others. The order within a source is by md5 of the id, so
    a hot source is ranked in parts by the first digits of the hash; equal ids stand together in any order. An
    empty table gives an empty result. With ``period``, weights are first rounded to multiples of its inverse. What the
    driver holds is one count per source.
    """
    scratch = Scratch(docs.sparkSession)
    md5 = F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("_source"), md5.alias("_md5"))
    counts = {r["_source"]: r["count"] for r in rows.groupBy("_source").count().collect()}
    if not counts:
        return rows.select("row", *[F.lit(None).cast("long").alias(c) for c in ("block", "slot", "place")])
    total = sum(counts.values())
    parts = min(_MD5_CELLS, max(1, -(-total // ROWS_PER_PART)))
    rows = rows.withColumn("_part", F.floor(F.conv(F.substring("_md5", 1, 4), 16, 10).cast("long") * parts / _MD5_CELLS))
    sizes = rows.groupBy("_source", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = scratch.cut(sizes.select("_source", "_part", before.alias("_before")))
    if len(counts) * parts <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)

    wanted = {k: w for k, w in (tempered(counts) if weights is None else weights).items() if k in counts}
    ints = (exact(wanted) if period is None else shares(wanted, period)) if any(w > 0 for w in wanted.values()) else {}
    blocks = {k: -(-n // block) for k, n in counts.items()}
    if any(-(-blocks[k] * sum(ints.values()) // w) * block >= 1 << 62 for k, w in ints.items()):
        raise ValueError("weights are too far apart for places of 64 bits")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, part = ["_source", "block", "slot"], []
        if not sum(b.num_rows for b in batches):
            return
        for turn in turns(ints, blocks):
            part.append(turn)
            if len(part) == _TURNS:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], names=names)
                part = []
        if part:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], names=names)

    spark = docs.sparkSession
    table_ = scratch.cut(spark.range(0, 1, 1, 1).mapInArrow(plan, "_source string, block long, slot long"))
    if sum(blocks.values()) <= BROADCAST_ROWS:
        table_ = F.broadcast(table_)

    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("_source", "_part").orderBy("_md5", "_id")) - 1)
    ranked = ranked.join(offsets, ["_source", "_part"])
    rank = F.col("_rank") + F.col("_before")
    ranked = ranked.withColumn("block", F.floor(rank / block)).withColumn("_in", rank % block).join(table_, ["_source", "block"])
    return ranked.withColumn("place", F.col("slot") * block + F.col("_in")).select("row", "block", "slot", "place")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """The rows and columns of ``docs`` in mixed order: partitions and the rows in them follow the schedule."""
    placed = place(docs, weights, block)
    return placed.repartitionByRange("place").sortWithinPartitions("place").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = string_columns(table(spark, sf_dir, "documents"), doc_id="doc_id", source="source")
    return place(docs).select("row.*", "block", "slot", "place")
