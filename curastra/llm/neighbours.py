"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one per shard.

Vectors are dealt into shards of about SHARD_ROWS by hash. In a shard, vectors get one more component that makes all
norms equal, so that the largest inner product is the least distance. Each batch of points searches the graph built so
far greedily; the beam it ends with proposes neighbours, relaxed distance pruning (a neighbour goes if a closer one is
ALPHA times nearer to it) keeps diverse edges, and reverse edges are pruned the same way; a ring through all rows keeps
each of them in reach. Every query is then searched
by beam in each shard, and the nearest of all shards are ranked by exact double-precision products.

How wide a beam must be depends on the vectors: every shard measures the recall of its own graph against brute force on
SAMPLE of its vectors and doubles the beam until it is RECALL.

Equal vectors are indexed once. Their smallest ids, as many as a result can hold, come back when results are ranked, so
a third of all rows may be one vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

K = 20
QUERY_STEP = 20
SHARD_ROWS = 8192
DEGREE = 40
BUILD_BEAM = 96
BEAM = 128
ALPHA = 1.15
PASSES = 1
SAMPLE = 64
#: Least share of the true nearest of a shard that its searches must find on the sample.
RECALL = 0.95
_BATCH = 256
_WIDTH = 4
_ENTRIES = 16


class Graph:
    """A navigable graph over the rows of ``x`` (float32); ``search`` finds rows of large inner product."""

    def __init__(self, x: np.ndarray, seed: int = 1, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
        norms = (x.astype(np.float64) ** 2).sum(axis=1)
        more = np.sqrt(np.maximum(norms.max() - norms, 0))
        self.x = np.concatenate([x, more[:, None]], axis=1).astype(np.float32)
        self.degree, self.alpha2 = degree, np.float32(alpha * alpha)
        n = len(x)
        rng = np.random.default_rng(seed)
        self.entries = rng.permutation(n)[:_ENTRIES]
        self.entries[0] = int((self.x @ self.x.mean(axis=0)).argmax())
        self.entries = np.unique(self.entries)
        self.edges = rng.integers(0, n, size=(n, min(degree, max(1, n - 1)))).astype(np.int32)
        if n <= degree + 1:
            self.edges = np.tile(np.arange(n, dtype=np.int32), (n, 1))
            return
        for _ in range(PASSES):
            order = rng.permutation(n)
            for i in range(0, n, _BATCH):
                self._insert(order[i : i + _BATCH], beam)
        # one ring through all rows, so that no row is out of reach however edges were pruned
        ring = rng.permutation(n)
        after = np.empty((n, 1), dtype=np.int32)
        after[ring, 0] = np.roll(ring, -1)
        self.edges = np.concatenate([self.edges, after], axis=1)

    def enough(self, k: int, beam: int, recall: float = RECALL) -> int:
        """The beam, doubled until the k nearest of SAMPLE rows are found to this share; at most all rows."""
        n = len(self.x)
        k = min(k, n)
        rows = np.random.default_rng(n).permutation(n)[:SAMPLE]
        q = np.concatenate([self.x[rows, :-1], np.zeros((len(rows), 1), np.float32)], axis=1)
        exact = q @ self.x.T
        least = np.partition(exact, n - k, axis=1)[:, n - k] - 1e-5 * np.abs(exact).max(axis=1)
        while beam < n:
            _, score = self.search(q, max(beam, k))
            if (score[:, :k] >= least[:, None]).mean() >= recall:
                return beam
            beam *= 2
        return n

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of each query: rows (-1: none) and products, best first. A wider beam takes more of it in a step."""
        b, n = len(q), len(self.x)
        beam = min(beam, n)
        step = max(_WIDTH, beam // 32)
        seen = np.zeros((b, n), dtype=bool)
        ids = np.full((b, beam), -1, dtype=np.int64)
        score = np.full((b, beam), -np.inf, dtype=np.float32)
        done = np.ones((b, beam), dtype=bool)
        query = np.repeat(np.arange(b), len(self.entries))
        found = np.tile(self.entries, b)
        while len(query):
            seen[query, found] = True
            s = np.einsum("pd,pd->p", self.x[found], q[query])
            counts = np.bincount(query, minlength=b)
            width = int(counts.max())
            at = np.arange(len(query)) - np.concatenate([[0], np.cumsum(counts)[:-1]])[query]
            all_ids = np.concatenate([ids, np.full((b, width), -1, dtype=np.int64)], axis=1)
            all_score = np.concatenate([score, np.full((b, width), -np.inf, dtype=np.float32)], axis=1)
            all_done = np.concatenate([done, np.ones((b, width), dtype=bool)], axis=1)
            all_ids[query, beam + at], all_score[query, beam + at], all_done[query, beam + at] = found, s, False
            keep = np.argsort(-all_score, axis=1)[:, :beam]
            ids, score, done = (np.take_along_axis(x, keep, axis=1) for x in (all_ids, all_score, all_done))
            open_ = ~done
            pick = open_ & (np.cumsum(open_, axis=1) <= step)
            query, col = np.nonzero(pick)
            done[pick] = True
            if not len(query):
                break
            near = self.edges[ids[query, col]]
            pair = np.unique((query[:, None] * n + near).ravel())
            query, found = np.divmod(pair, n)
            fresh = ~seen[query, found]
            query, found = query[fresh], found[fresh]
            if not len(query):
                # nothing new from these; others of the beam may still be open
                if done.all():
                    break
                open_ = ~done
                pick = open_ & (np.cumsum(open_, axis=1) <= beam)
                query, col = np.nonzero(pick)
                done[pick] = True
                near = self.edges[ids[query, col]]
                pair = np.unique((query[:, None] * n + near).ravel())
                query, found = np.divmod(pair, n)
                fresh = ~seen[query, found]
                query, found = query[fresh], found[fresh]
        return ids, score

    def _prune(self, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Robust pruning of candidate rows (-1: none) for each point: its new edges, padded by repeating the first."""
        x, r = self.x, self.edges.shape[1]
        cand = np.where(cand == points[:, None], -1, cand)
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        v = x[cand]
        sq = np.einsum("bcd,bcd->bc", v, v)
        own = x[points]
        to_point = sq + np.einsum("bd,bd->b", own, own)[:, None] - 2 * np.einsum("bcd,bd->bc", v, own)
        between = np.maximum(sq[:, :, None] + sq[:, None, :] - 2 * (v @ v.transpose(0, 2, 1)), 0)
        to_point = np.where(cand < 0, np.inf, np.maximum(to_point, 0))
        left = to_point.copy()
        out = np.full((len(points), r), -1, dtype=np.int64)
        rows = np.arange(len(points))
        for k in range(r):
            best = left.argmin(axis=1)
            ok = np.isfinite(left[rows, best])
            if not ok.any():
                break
            out[ok, k] = cand[rows, best][ok]
            left[rows, best] = np.inf
            left = np.where((self.alpha2 * between[rows, best] <= to_point) & ok[:, None], np.inf, left)
        return np.where(out < 0, np.where(out[:, :1] < 0, points[:, None], out[:, :1]), out).astype(np.int32)

    def _insert(self, points: np.ndarray, beam: int) -> None:
        ids, _ = self.search(self.x[points], beam)
        cand = np.concatenate([ids, self.edges[points]], axis=1)
        self.edges[points] = self._prune(points, cand)
        pair = np.stack([self.edges[points].ravel(), np.repeat(points, self.edges.shape[1])], axis=1)
        pair = np.unique(pair[pair[:, 0] != pair[:, 1]], axis=0)
        target, first, count = np.unique(pair[:, 0], return_index=True, return_counts=True)
        for lo in range(0, len(target), 1024):
            t, f, c = target[lo : lo + 1024], first[lo : lo + 1024], count[lo : lo + 1024]
            # a hub gets many reverse edges at once: the pruned set takes them in runs
            for run in range(0, int(c.max()), self.degree):
                some = c > run
                width = int(min(self.degree, (c[some] - run).max()))
                at = f[some][:, None] + run + np.arange(width)
                inside = np.arange(width) < (c[some] - run)[:, None]
                back = np.where(inside, pair[np.minimum(at, len(pair) - 1), 1], -1)
                tt = t[some]
                self.edges[tt] = self._prune(tt, np.concatenate([self.edges[tt].astype(np.int64), back], axis=1))


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _shards(k: int, beam: int):
    """Rows (shard, asks, id, vector) sorted by shard and asks: a shard's vectors, then all queries."""

    def answer(graph: Graph, beam: int, ids: np.ndarray, full: np.ndarray, qid: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        rows, _ = graph.search(np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32), max(beam, k))
        rows = rows[:, : 2 * k]
        score = np.einsum("bcd,bd->bc", full[rows], q)
        score[rows < 0] = -np.inf
        order = np.lexsort((ids[rows], -score), axis=1)[:, :k]
        rows, score = np.take_along_axis(rows, order, axis=1), np.take_along_axis(score, order, axis=1)
        ok = rows >= 0
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(qid, rows.shape[1])[ok.ravel()]), pa.array(ids[rows][ok]), pa.array(score[ok])], names=["query_id", "rep", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, vectors, graph, full = None, [], [], None, None
        for batch in batches:
            s, asks, i, v = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), _vectors(batch.column(3))
            cuts = [0, *(np.flatnonzero((s[1:] != s[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), len(s)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if asks[a] == 0:
                    if s[a] != shard:
                        shard, ids, vectors, graph = s[a], [], [], None
                    ids.append(i[a:b])
                    vectors.append(v[a:b])
                elif s[a] == shard and ids:
                    if graph is None:
                        own = np.concatenate(ids)
                        order = np.argsort(own)
                        own, full = own[order], np.concatenate(vectors)[order]
                        graph = Graph(full.astype(np.float32), seed=int(shard) + 1)
                        wide = graph.enough(k, beam)
                        size = max(1, _BATCH * BEAM // max(wide, BEAM))  # memory of a batch doesn't grow with the beam
                    for c in range(a, b, size):
                        yield answer(graph, wide, own, full, i[c : min(b, c + size)], v[c : min(b, c + size)])

    return run


def usable(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: finite non-zero vectors of the commonest length, one row per id."""
    v = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    rows = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.forall("v", good) & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("v") == (common["d"] if common else 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def search(embeddings: DataFrame, queries: str = f"vec_id % {QUERY_STEP} = 0", k: int = K, beam: int = BEAM, shard_rows: int = SHARD_ROWS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row, itself left out.

    Nearest first by inner product in double precision, ties to the smaller vec_id. Vectors that are null, zero or hold a
    null or non-finite component take no part, nor do ids that are null or vectors of another length than most;
    an id that is there more than once counts once (with its smallest vector). Fewer than k rows come back if there are
    fewer candidates. Other columns are not read; an empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    scratch = Scratch(spark)
    rows = scratch.cut(usable(embeddings, id_col, vector_col))
    same = Window.partitionBy("v").orderBy("vec_id")
    copies = scratch.cut(rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1))
    reps = copies.where("place = 1").select("vec_id", "v")
    n = max(1, -(-reps.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(n)).cast("long")
    base = reps.select(shard.alias("shard"), F.lit(0).alias("asks"), F.col("vec_id").alias("id"), "v")
    asked = rows.where(queries).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("shard"), F.lit(1).alias("asks"), F.col("vec_id").alias("id"), "v")
    dealt = base.unionAll(asked).repartitionById(n, F.col("shard").cast("int")).sortWithinPartitions("shard", "asks", "id")
    found = scratch.cut(dealt.mapInArrow(_shards(k + 1, beam), "query_id long, rep long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "rep")
    found = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    # equal vectors come back here
    many = scratch.cut(copies.where("place > 1").join(reps.select("v", F.col("vec_id").alias("rep")), "v").select("rep", "vec_id"))
    members = found.select("query_id", "score", F.col("rep").alias("vec_id")).unionAll(found.join(many, "rep").select("query_id", "score", "vec_id"))
    ranked = members.where("vec_id <> query_id").withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
