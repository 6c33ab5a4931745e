"""Quality classifier: a Gaussian kernel over document statistics, by random Fourier features.

Every text becomes a row of statistics. Labelled rows are mapped to FEATURES random cosines, and each partition sums its
share of the normal equations; the sums of all partitions, of fixed size, are added in a tree. Ridge regression on them
gives raw scores. Isotonic regression, on labelled rows that the ridge has not seen and binned to a
fixed grid, turns raw scores into chances.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc_mod, string_columns, summed, table
from .rules import _counted, _twice, measure_block
from .textkernel import blocks, mix, split_words

FEATURES = 256
RIDGE = 1e-3
GRID = 512
ACCEPT = 0.3
_SEED = 20240301


def _flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(chars, dtype=np.uint8)] = True
    return out


_UPPER, _LOWER, _DIGIT = _flags(bytes(range(65, 91))), _flags(bytes(range(97, 123))), _flags(b"0123456789")
_STOP, _SHOUT, _ODD, _SYMBOL = _flags(b".,;:"), _flags(b"!?"), _flags(b"[]{}()\\/_=+~^@\"'`-"), _flags(b"#*$%&|<>")
_HIGH = np.arange(256) >= 0xC0
STATISTICS = (
    "log_words", "word_length", "upper", "digits", "stops", "shouts", "odd", "symbols", "accents", "line_words", "dup_lines",
    "repeats", "fresh_words", "long_words", "short_words", "plain_ends", "log_chars", "capital_starts", "symbol_words",
)


def statistics_block(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text; an empty text is all zeros."""
    w = split_words(data, at)
    h = w.hashes()
    counts, _, _, _ = measure_block(data, at, w, h, normal=False)
    n_words = counts["n_words"].astype(float)
    words, chars = np.maximum(n_words, 1), np.maximum(counts["word_chars"].astype(float), 1)
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(w.first))
    length = w.end - w.start
    _, before = _twice(mix(h + text_of.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    share = lambda table, by: _counted(table[data], at) / by
    of_words = lambda flags: _counted(flags, w.first) / words
    ends = data[w.end - 1] if len(w.end) else np.zeros(0, np.uint8)
    starts = data[w.start] if len(w.start) else np.zeros(0, np.uint8)
    symbols = np.flatnonzero(_SYMBOL[data])
    marked = np.searchsorted(symbols, w.end) > np.searchsorted(symbols, w.start) if len(symbols) else np.zeros(len(w.end), dtype=bool)
    lines = _counted(data == 0x0A, at) + 1.0
    x = np.stack([
        np.log1p(n_words), counts["word_chars"] / words, share(_UPPER, chars), share(_DIGIT, chars), share(_STOP, words), share(_SHOUT, words), share(_ODD, words), share(_SYMBOL, words),
        share(_HIGH, chars), np.log1p(n_words / lines), counts["n_dup_lines"] / lines, counts["n_repeat_words"] / words, of_words(~before), of_words(length > 14), of_words(length <= 2),
        of_words(_LOWER[ends] | (ends >= 0x80)), np.log1p(chars), of_words(_UPPER[starts]), of_words(marked),
    ], axis=1)
    return np.where((n_words > 0)[:, None], x, 0.0)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, at in blocks(batch.column(1)):
            x = statistics_block(data, at)
            offsets = pa.array(np.arange(0, (j - i + 1) * x.shape[1], x.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["doc_id", "x"])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Kernel:
    """Standardised statistics through random cosines whose inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray

    @classmethod
    def over(cls, mean: np.ndarray, scale: np.ndarray, width: float = 4.0) -> Kernel:
        rng = np.random.default_rng(_SEED)
        return cls(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(size=(len(mean), FEATURES)) / width, rng.uniform(0, 2 * np.pi, FEATURES))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b) * np.sqrt(2 / FEATURES)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _sums(kernel: Kernel):
    """One row per partition: its part of Z'Z and Z'y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                z, y = kernel(_matrix(part.column(0))), part.column(1).to_numpy(zero_copy_only=False)
                both = z.T @ np.column_stack([z, y])
                total = both if total is None else total + both
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over sorted x: the weighted mean x and level of each block, levels rising."""
    blocks_: list[list[float]] = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist()):
        blocks_.append([a, b, w])
        while len(blocks_) > 1 and blocks_[-2][1] >= blocks_[-1][1]:
            a2, b2, w2 = blocks_.pop()
            a1, b1, w1 = blocks_[-1]
            blocks_[-1] = [(a1 * w1 + a2 * w2) / (w1 + w2), (b1 * w1 + b2 * w2) / (w1 + w2), w1 + w2]
    return np.array([r[0] for r in blocks_]), np.array([r[1] for r in blocks_])


@dataclass
class Model:
    kernel: Kernel
    beta: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        r = self.raw(x)
        level = np.interp(r, self.at, self.level) if len(self.at) else np.clip(r, 0, 1)
        # a small share of the raw score keeps the order of documents within one level
        return np.clip(0.99 * level + 0.01 / (1 + np.exp(-8 * (r - 0.5))), 0, 1)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    docs = string_columns(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string")).withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(_statistics, "doc_id long, x array<double>")


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model | None:
    """A model from all labelled rows whose crc32(doc_id as text) modulo 5 is 2, 3 or 4 (ridge) and 1 (calibration).

    Null labels and ids are left out; repeated labels of one document are averaged. None without any labelled row.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y")).where("y IS NOT NULL AND doc_id IS NOT NULL")
    y = y.groupBy("doc_id").agg(F.avg("y").alias("y"))
    scratch = Scratch(stats.sparkSession)
    rows = scratch.cut(stats.join(y, "doc_id").withColumn("fold", crc_mod("doc_id", 5)).where("fold <> 0"))
    moments = rows.select(*[F.struct(F.avg(F.col("x")[i]), F.stddev_pop(F.col("x")[i])).alias(f"m{i}") for i in range(len(STATISTICS))]).first()
    if moments[0][0] is None:
        return None
    kernel = Kernel.over(np.array([m[0] for m in moments]), np.array([m[1] for m in moments]))
    added = lambda part: summed(part.select("x", "y").mapInArrow(_sums(kernel), "sums binary"), np.float64)
    total = added(rows.where("fold > 1"))
    if total is None:  # every labelled row is in the calibration fold
        total = added(rows)
    total = total.reshape(FEATURES + 1, FEATURES + 2)
    n = max(total[-1, -2], 1.0)
    penalty = np.eye(FEATURES + 1) * RIDGE * n
    penalty[-1, -1] = 1e-9
    model = Model(kernel, np.linalg.solve(total[:, :-1] + penalty, total[:, -1]), np.zeros(0), np.zeros(0))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(batch.column(0)))), batch.column(1)], names=["r", "y"])

    cell = F.floor(F.least(F.greatest(F.col("r"), F.lit(-1.0)), F.lit(2.0)) * (GRID / 3))
    cells = rows.where("fold = 1").select("x", "y").mapInArrow(scored, "r double, y double").groupBy(cell.alias("cell")).agg(F.avg("r").alias("r"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("cell").collect()
    if cells:
        model.at, model.level = isotonic(np.array([c["r"] for c in cells]), np.array([c["y"] for c in cells]), np.array([float(c["n"]) for c in cells]))
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    held_out rows (crc32(doc_id as text) modulo 5 is 0, and rows without an id) are never learnt from. A null or empty
    text has zero statistics and is scored like any other. Without labels every score is 0.5. Repeated rows get equal
    results; other columns are not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    stats = scratch.cut(statistics(docs, id_col, text_col))
    model = fit(stats, labels, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = np.full(batch.num_rows, 0.5) if model is None else model.score(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    out = stats.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with their columns. One pass over the texts learns, one scores."""
    scratch = Scratch(docs.sparkSession)
    model = fit(scratch.cut(statistics(docs)), labels)
    if model is None:
        return docs
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in blocks(batch.column(names.index("text"))):
                good = model.score(statistics_block(data, at)) >= ACCEPT
                yield batch.slice(i, j - i).filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
