"""Recall of the graph search on vectors that are hard for it."""

import numpy as np
import pytest

pytest.importorskip("curastra.llm")
from curastra.llm import neighbours  # noqa: E402


def vectors(kind, n=1500):
    rng = np.random.default_rng(7)
    if kind == "clusters":
        return rng.normal(size=(60, 64))[rng.integers(0, 60, n)] + 0.1 * rng.normal(size=(n, 64))
    x = rng.normal(size=(n, 256 if kind == "gaussian256" else 64))
    return x * np.exp(rng.normal(size=(n, 1)) / 2) if kind == "lognormal" else x


@pytest.mark.parametrize("kind", ["gaussian64", "gaussian256", "lognormal", "clusters"])
def test_recall_of_hard_vectors(spark, kind):
    x = vectors(kind)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.search(df, shard_rows=1000).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    for q, rows in got.items():
        near = x @ x[q]
        near[q] = -np.inf
        assert [r[0] for r in sorted(rows)] == list(range(1, 21))
        assert all(abs(near[i] - s) < 1e-9 for _, i, s in rows)
        hits += len({i for _, i, _ in rows} & set(np.argsort(-near)[:20].tolist()))
    assert len(got) == len(x) // 20 and hits >= 0.9 * 20 * len(got)


def test_every_row_is_in_reach():
    x = vectors("gaussian256", 600).astype(np.float32)
    graph = neighbours.Graph(x)
    found, _ = graph.search(np.concatenate([x[:5], np.zeros((5, 1), np.float32)], axis=1), len(x))
    assert all(sorted(row.tolist()) == list(range(len(x))) for row in found)
