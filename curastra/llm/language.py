"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to three lower-cased characters are hashed to DIMS places. Document frequencies come from all training
documents, summed by partition into vectors of fixed size and added in a tree. Follow-the-regularised-leader with elastic-net penalties
fits the weights in one task on at most MAX_TRAIN documents, drawn by hash and in equal parts by language; a fifth of
them sets the temperature of the softmax instead.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_mod, string_columns, summed, table
from .textkernel import blocks

DIMS = 1 << 16
ORDERS = (1, 2, 3)
#: Most documents that the classifier is fitted on.
MAX_TRAIN = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-5
#: Most languages; counts and weights of each are held by the driver.
MAX_LANGS = 1000
UNKNOWN = "und"

_FOLD = np.arange(0x250, dtype=np.uint32)
for _i in range(0x250):
    if len(chr(_i).lower()) == 1:
        _FOLD[_i] = ord(chr(_i).lower())
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def grams(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """Of each text, the hashed places of all its n-grams, with repeats."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    small = codes < len(_FOLD)
    codes = np.where(small, _FOLD[np.where(small, codes, 0)], codes)
    places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    rolled = []
    h = np.zeros(len(codes), dtype=np.uint32)
    for n in ORDERS:
        h = (h[: len(codes) - n + 1] * np.uint32(0x9E3779B1)) ^ (codes[n - 1 :] * np.uint32(0x85EBCA6B) + np.uint32(n)) if n > 1 else codes * np.uint32(0x85EBCA6B) + np.uint32(1)
        x = h ^ (h >> np.uint32(15))
        x = x * np.uint32(0x2C1B3C6D)
        rolled.append(((x ^ (x >> np.uint32(13))) & np.uint32(DIMS - 1)).astype(np.int64))
    for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
        yield np.concatenate([r[a : max(a, b - n + 1)] for n, r in zip(ORDERS, rolled)])


def _counts(g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    tf = np.bincount(g, minlength=DIMS)
    at = np.flatnonzero(tf)
    return at, tf[at]


def _values(at: np.ndarray, tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf[at]
    norm = np.sqrt((v * v).sum())
    return v / norm if norm > 0 else v


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = None
    for batch in batches:
        for _, _, data, at in blocks(batch.column(0)):
            df = np.zeros(DIMS + 1, dtype=np.int64) if df is None else df
            for g in grams(data, at):
                df[np.unique(g) if len(g) < 512 else np.flatnonzero(np.bincount(g, minlength=DIMS))] += 1
            df[-1] += len(at) - 1
    if df is not None:
        yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary())], names=["sums"])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, at in blocks(batch.column(1)):
            made = [_counts(g) for g in grams(data, at)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array([a.astype(np.int32).tobytes() for a, _ in made], pa.binary()), pa.array([t.astype(np.int32).tobytes() for _, t in made], pa.binary())],
                names=["lang", "at", "tf"],
            )


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    w: np.ndarray  # DIMS x languages
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.w[at] + self.bias

    def predict(self, g: np.ndarray) -> tuple[str, float]:
        at, tf = _counts(g)
        p = _softmax(self.logits(at, _values(at, tf, self.idf)) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (places, values, class): weights and biases."""
    z, n = np.zeros((DIMS + 1, n_classes)), np.zeros((DIMS + 1, n_classes))

    def weights(at):
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2))

    for _ in range(epochs):
        for at, v, y in rows:
            at, v = np.append(at, DIMS), np.append(v, 1.0)
            w = weights(at)
            p = _softmax(v @ w)
            p[y] -= 1
            g = v[:, None] * p
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(DIMS + 1))
    return w[:-1].astype(np.float32), w[-1]


def _train(df: np.ndarray, langs: list[str]):
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for lang, at, tf in zip(*(c.to_pylist() for c in batch.columns)):
                at, tf = np.frombuffer(at, np.int32).astype(np.int64), np.frombuffer(tf, np.int32)
                rows.append((at, _values(at, tf, idf), langs.index(lang)))
        if not rows:
            return
        # the order must not hang on how rows arrive
        rows.sort(key=lambda r: (len(r[0]), float(r[1].sum()), r[2]))
        order = np.random.default_rng(7).permutation(len(rows))
        cut = len(rows) // 5 if len(rows) >= 50 else 0
        held, used = [rows[i] for i in order[:cut]], [rows[i] for i in order[cut:]]
        w, bias = ftrl(used, len(langs))
        model = Model(langs, idf, w, bias, 1.0)
        if held:
            logits, y = np.stack([model.logits(a, v) for a, v, _ in held]), np.array([k for _, _, k in held])
            grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
            loss = [-np.log(np.clip(_softmax(logits / t)[np.arange(len(y)), y], 1e-12, 1)).mean() for t in grid]
            model.temperature = float(grid[int(np.argmin(loss))])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return run


def fit(docs: DataFrame) -> Model | None:
    """A model from ``docs`` (doc_id, text, lang) whose crc32(doc_id as text) modulo 3 is not 1; None if there are none."""
    known = docs.where(F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(False)) & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return None
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"{len(sizes)} languages; this classifier takes {MAX_LANGS} at most")
    langs = sorted(sizes)
    quota = max(1, MAX_TRAIN // len(langs))
    df = summed(known.select("text").mapInArrow(_frequencies, "sums binary"), np.int64)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(int(min(1.0, quota / n) * (1 << 20)))) for k, n in sizes.items()])
    # an id that is there many times counts once among the drawn ones, so that MAX_TRAIN bounds them
    rows = known.where(drawn < share).groupBy("lang", "doc_id").agg(F.min("text").alias("text")).select("lang", "text").mapInArrow(_vectors, "lang string, at binary, tf binary")
    return pickle.loads(rows.repartition(1).mapInArrow(_train(df, langs), "model binary").first()["model"])


def _lettered(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    plain = np.diff(np.concatenate([[0], np.cumsum(_LETTER[data])])[at]) > 0
    for t in np.flatnonzero(~plain):
        if at[t + 1] > at[t]:
            plain[t] = any(c.isalpha() for c in data[at[t] : at[t + 1]].tobytes().decode("utf-8", "replace"))
    return plain


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row.

    held_out rows (crc32(doc_id as text) modulo 3 is 1, and rows without an id) and rows without a language are never
    learnt from. A null text, or one without any letter, is ``und`` with score 0, as is every text if there is nothing
    to learn from. Repeated rows get equal results; other columns are not read; an empty table gives an empty result.
    """
    docs = string_columns(docs, doc_id=id_col, text=text_col, lang=lang_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    model = fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in blocks(batch.column(1)):
                letters = _lettered(data, at)
                found = [model.predict(g) if model and letters[t] else (UNKNOWN, 0.0) for t, g in enumerate(grams(data, at))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(True)).alias("held_out"), "lang_pred", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
