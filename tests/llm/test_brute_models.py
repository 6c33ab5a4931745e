"""Trained and scheduled operators against plain reimplementations."""

import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("curastra.llm")
from curastra.llm import language, mixing, quality  # noqa: E402
from curastra.llm.common import summed  # noqa: E402

from .test_models import junk  # noqa: E402


def fold(i, by):
    return zlib.crc32(str(i).encode()) % by


def test_sums_in_a_tree(spark):
    def part(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([np.full(3, float(sum(b.column(0).to_pylist()))).tobytes()], pa.binary())], names=["sums"])

    df = spark.range(0, 300, 1, 90).mapInArrow(part, "sums binary")
    assert summed(df, np.float64).tolist() == [sum(range(300))] * 3
    assert summed(spark.range(0).mapInArrow(part, "sums binary").where("sums IS NULL"), np.float64) is None


def test_quality_against_a_dense_solve(spark):
    rng = random.Random(14)
    data = [(i, junk(rng, i % 3 > 0), int(i % 3 > 0) ^ (rng.random() < 0.1)) for i in range(500)]
    docs = spark.createDataFrame(data, "doc_id long, text string, quality int").repartition(5)
    stats = {r.doc_id: np.array(r.x) for r in quality.statistics(docs).collect()}
    model = quality.fit(quality.statistics(docs), docs.select("doc_id", "quality"))
    known = [i for i in stats if fold(i, 5)]
    x, y = np.stack([stats[i] for i in known]), np.array([data[i][2] for i in known], dtype=float)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    z = np.random.default_rng(quality._SEED)
    w, b = z.normal(size=(x.shape[1], quality.FEATURES)) / 4.0, z.uniform(0, 2 * np.pi, quality.FEATURES)
    scale = np.where(scale > 1e-9, scale, 1)
    feature = lambda v: np.append(np.cos(np.clip((v - mean) / scale, -8, 8) @ w + b) * math.sqrt(2 / quality.FEATURES), 1.0)
    ridge = [k for k, i in enumerate(known) if fold(i, 5) > 1]
    a, t = np.stack([feature(x[k]) for k in ridge]), y[ridge]
    penalty = np.eye(quality.FEATURES + 1) * quality.RIDGE * len(ridge)
    penalty[-1, -1] = 1e-9
    beta = np.linalg.solve(a.T @ a + penalty, a.T @ t)
    raw = {i: float(feature(v) @ beta) for i, v in stats.items()}
    assert all(abs(raw[i] - float(model.raw(v[None])[0])) < 1e-5 for i, v in stats.items())
    cells = {}
    for k, i in enumerate(known):
        if fold(i, 5) == 1:
            cells.setdefault(math.floor(min(max(raw[i], -1.0), 2.0) * quality.GRID / 3), []).append((raw[i], y[k]))
    rows = [np.array(cells[c]) for c in sorted(cells)]
    at, level = quality.isotonic(np.array([r[:, 0].mean() for r in rows]), np.array([r[:, 1].mean() for r in rows]), np.array([float(len(r)) for r in rows]))
    got = {r.doc_id: r for r in quality.score(docs, docs.select("doc_id", "quality")).collect()}
    for i, r in raw.items():
        want = 0.99 * np.interp(r, at, level) + 0.01 / (1 + math.exp(-8 * (r - 0.5)))
        assert abs(got[i].score - min(max(want, 0), 1)) < 1e-4 and got[i].held_out == (fold(i, 5) == 0)


def test_document_frequencies_against_plain_counts(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abÉç 日") for _ in range(rng.randrange(60))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    got = summed(df.mapInArrow(language._frequencies, "sums binary"), np.int64)
    assert got[-1] == len(texts)
    # places are hashes: each distinct n-gram has one, found by a text that is the n-gram alone
    grams_of = lambda t: {t.lower()[i : i + n] for n in language.ORDERS for i in range(len(t) - n + 1)}
    plain = Counter(g for t in texts for g in grams_of(t))

    def place(g):
        raw = np.frombuffer(g.encode(), dtype=np.uint8)
        return int(next(language.grams(raw, np.array([0, len(raw)])))[-1])

    sets = {}
    for g in plain:
        sets.setdefault(place(g), set()).add(g)
    want = {p: sum(bool(gs & grams_of(t)) for t in texts) for p, gs in sets.items()}
    assert {int(p): int(got[p]) for p in np.flatnonzero(got[:-1])} == want


def test_ftrl_against_a_dense_loop(monkeypatch):
    monkeypatch.setattr(language, "DIMS", 40)
    rng = np.random.default_rng(8)
    rows = [(np.sort(rng.choice(40, size=6, replace=False)), rng.random(6), int(rng.integers(3))) for _ in range(50)]
    w, bias = language.ftrl(rows, 3, epochs=2)
    z, n = np.zeros((41, 3)), np.zeros((41, 3))
    for _ in range(2):
        for at, v, y in rows:
            x = np.zeros(41)
            x[at], x[40] = v, 1.0
            theta = np.zeros((41, 3))
            for i in range(41):
                for k in range(3):
                    if abs(z[i, k]) > language.L1:
                        theta[i, k] = -(z[i, k] - math.copysign(language.L1, z[i, k])) / ((language.BETA + math.sqrt(n[i, k])) / language.ALPHA + language.L2)
            logits = x @ theta
            p = np.exp(logits - logits.max())
            p /= p.sum()
            for i in np.flatnonzero(x):
                for k in range(3):
                    g = x[i] * (p[k] - (k == y))
                    s = (math.sqrt(n[i, k] + g * g) - math.sqrt(n[i, k])) / language.ALPHA
                    z[i, k] += g - s * theta[i, k]
                    n[i, k] += g * g
    last = np.where(np.abs(z) <= language.L1, 0, -(z - np.sign(z) * language.L1) / ((language.BETA + np.sqrt(n)) / language.ALPHA + language.L2))
    assert np.allclose(w, last[:-1], atol=1e-6) and np.allclose(bias, last[-1])


def brute_places(rows, weights, block):
    """Slot by slot: among released blocks the earliest deadline, then the larger weight, then the name."""
    order = {}
    for i, s in sorted(rows, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(), r[0])):
        order.setdefault(s, []).append(i)
    total = sum(weights.values())
    share = {k: w / total for k, w in weights.items()}
    sizes = {k: -(-len(v) // block) for k, v in order.items()}
    done, out, t = dict.fromkeys(weights, 0), {}, 0
    while any(done[k] < sizes[k] for k in weights):
        ready = [(math.ceil((done[k] + 1) / share[k]), -weights[k], k) for k in weights if done[k] <= sizes[k] and math.floor(done[k] / share[k]) <= t]
        if ready:
            _, _, k = min(ready)
            for j, i in enumerate(order[k][done[k] * block : (done[k] + 1) * block]):
                out[i] = (done[k], t, t * block + j)
            done[k] += 1
        t += 1
    return out


def test_places_against_slot_by_slot_scheduling(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice("aaaabbcd")) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(7)
    for weights in ({"a": 0.5, "b": 0.3, "c": 0.1999, "d": 0.0001}, {"a": 1 / 3, "b": 0.1, "c": 5.0, "d": 2.0}):
        want = brute_places(rows, {k: Fraction(w) for k, w in weights.items()}, 8)
        got = {r[0]: tuple(r)[1:] for r in mixing.place(df, weights, block=8).select("row.doc_id", "block", "slot", "place").collect()}
        assert got == want
