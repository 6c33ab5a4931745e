"""Quality rules: repetition within a text, and lines that many documents of a host share.

One pass over the texts counts words, symbols, repeated lines and repeated five-word windows and hashes every distinct
normalised line. Lines are then counted over distinct documents of their host, in two steps (one row per host, line and
document; then one per host and line), so that a line of a third of all rows is summed before it is dealt out. A line
above the limit is removed everywhere but in its first document; a document that loses too much is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, table
from .textkernel import LOWER, Words, blocks, mix, sequence_hashes, span_hashes, split_words

WINDOW = 5
#: A line is common if more documents of a host have it; the limit is the same for hosts of every size.
MIN_DOCS = 20
MIN_WORDS = 10
MIN_LEFT = 0.3
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True


def _counted(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set between consecutive offsets."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), at))


def _twice(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs more than once, and whether it is counted as a repeat (all but one are)."""
    order = np.argsort(keys)
    s = keys[order]
    same = s[1:] == s[:-1]
    again, before = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    before[order[1:]] = same
    return again, before


def measure_block(data: np.ndarray, at: np.ndarray, w: Words | None = None, h: np.ndarray | None = None, normal: bool = True) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each text; and of its lines with words: text, hash of the normalised line (unless it isn't wanted), words."""
    n = len(at) - 1
    w = split_words(data, at) if w is None else w
    h = w.hashes() if h is None else h
    text_of = np.repeat(np.arange(n), np.diff(w.first))
    character = (data & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(character, dtype=np.int64)])
    chars = np.concatenate([[0], np.cumsum(points[w.end] - points[w.start])])
    out = {"n_words": np.diff(w.first), "word_chars": np.diff(chars[w.first]), "n_symbols": _counted(_SYMBOL[data], at)}

    covered = np.zeros(len(h) + 1, dtype=np.int64)
    if len(h) >= WINDOW:
        first = np.arange(len(h) - WINDOW + 1)
        first = first[text_of[first] == text_of[first + WINDOW - 1]]
        key = mix(sequence_hashes(h, first, first + WINDOW) + text_of[first].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        again, _ = _twice(key)
        np.add.at(covered, first[again], 1)
        np.add.at(covered, first[again] + WINDOW, -1)
    out["n_repeat_words"] = _counted(np.cumsum(covered[:-1]) > 0, w.first)

    lines = split_words(data, at, _NEWLINE)
    words_to = np.searchsorted(w.start, lines.end)
    words_from = np.searchsorted(w.start, lines.start)
    full = words_to > words_from
    a, b, start, end = words_from[full], words_to[full], lines.start[full], lines.end[full]
    line_text = text_of[a] if len(a) else np.zeros(0, dtype=np.int64)
    key = mix(span_hashes(data, start, end) + line_text.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    _, before = _twice(key)
    out["n_dup_lines"] = np.bincount(line_text[before], minlength=n)

    small = span_hashes(LOWER[data], w.start, w.end) if normal else h
    return out, line_text, sequence_hashes(small, a, b).view(np.int64), b - a


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("h", pa.int64()), ("w", pa.int64())])
    for batch in batches:
        for i, j, data, at in blocks(batch.column(2)):
            counts, t, h, words = measure_block(data, at)
            order = np.lexsort((h, t))
            t, h, words = t[order], h[order], words[order]
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])]) if len(t) else np.zeros(0, dtype=bool)
            firsts = np.flatnonzero(new)
            total = np.add.reduceat(words, firsts) if len(firsts) else words
            offsets = np.searchsorted(t[firsts], np.arange(j - i + 1)).astype(np.int32)
            lines = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(h[firsts]), pa.array(total.astype(np.int64))], fields=list(kind)))
            cols = [batch.column(c).slice(i, j - i) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*cols, *[pa.array(counts[c].astype(np.int64)) for c in _COUNTS], lines], names=["doc_id", "host", *_COUNTS, "lines"])


def _with_lines(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return picked.mapInArrow(_measure, "doc_id long, host string, " + ", ".join(f"{c} long" for c in _COUNTS) + ", lines array<struct<h:long,w:long>>")


def common_lines(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(host, h, owner): lines in more than min_docs documents of a host, and the first of these."""
    seen = measured.select("host", "doc_id", F.explode("lines.h").alias("h")).distinct()
    return seen.groupBy("host", "h").agg(F.count("*").alias("n"), F.min("doc_id").alias("owner")).where(F.col("n") > min_docs).select("host", "h", "owner")


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their counts and lines, and the common lines; both are tables."""
    scratch = Scratch(docs.sparkSession)
    measured = scratch.cut(_with_lines(docs, id_col, text_col, host_col))
    common = scratch.cut(common_lines(measured))
    return measured, F.broadcast(common) if common.count() <= BROADCAST_ROWS else common


def _judged(measured: DataFrame, common: DataFrame) -> DataFrame:
    rows = measured.select("host", "doc_id", F.explode("lines").alias("x")).select("host", "doc_id", F.col("x.h").alias("h"), F.col("x.w").alias("w"))
    lost = rows.join(common, ["host", "h"]).where(~F.col("doc_id").eqNullSafe(F.col("owner")))
    lost = lost.groupBy("host", "doc_id").agg(F.sum("w").alias("lost_words"))
    # a document that is there more than once loses its lines in each of its rows
    times = measured.groupBy("host", "doc_id").agg(F.count("*").alias("times"))
    lost = lost.join(times, ["host", "doc_id"]).select("host", "doc_id", (F.col("lost_words") / F.col("times")).alias("lost_words"))
    out = measured.drop("lines").join(lost, ["host", "doc_id"], "left").withColumn("n_lost_words", F.coalesce("lost_words", F.lit(0.0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_lost_words")
    kept = ~failed & (left >= MIN_WORDS) & (left >= MIN_LEFT * F.col("n_words"))
    return out.select("host", "doc_id", *_COUNTS, failed.alias("base_failed"), "n_lost_words", kept.alias("kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """doc_id, counts, base_failed, n_lost_words and kept of every row.

    kept is false if base_failed (under 10 words, or over 20 % of the words in five-word windows that recur), or if the
    lines that more than MIN_DOCS documents of the host share leave less than MIN_WORDS words or MIN_LEFT of them. A null
    text has no words and fails; a null host is a host of its own; rows with one doc_id are one document when lines are
    counted and lose the mean of their common words; rows without an id lose no lines; other columns are not read; an empty
    table gives an empty result.
    """
    return _judged(*_measured(docs, id_col, text_col, host_col)).drop("host")


def clean(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows that ``judge`` keeps, without the lines that many documents of their host share, but for the first of these.

    An id with several texts stays if one of them is kept. Rows without an id lose no lines and stay if they don't fail.
    """
    measured, common = _measured(docs, "doc_id", text_col, host_col)
    rows = measured.select("host", "doc_id", F.explode("lines.h").alias("h")).join(common, ["host", "h"])
    per_doc = rows.where("doc_id <> owner").groupBy("host", "doc_id").agg(F.collect_set("h").alias("_lost_lines"))
    verdict = _judged(measured, common).where("kept").select(F.col("host").alias("_host"), F.col("doc_id").alias("_id")).distinct()
    verdict = verdict.join(per_doc, (F.col("_host") == F.col("host")) & (F.col("_id") == F.col("doc_id")), "left").select("_host", "_id", "_lost_lines")
    names = docs.columns
    host = F.coalesce(docs[host_col].cast("string"), F.lit(""))
    left = docs.join(verdict, (host == F.col("_host")) & docs["doc_id"].cast("long").eqNullSafe(F.col("_id"))).select(*[docs[c] for c in names], "_lost_lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = names.index(text_col)
        for batch in batches:
            lost = batch.column(len(names)).to_pylist()
            texts = batch.column(k).to_pylist()
            at = [r for r, gone in enumerate(lost) if gone and texts[r]]
            if at:
                lines = [x for r in at for x in texts[r].split("\n")]
                owner = [r for r in at for _ in texts[r].split("\n")]
                hashes = [int(h[0]) if len(h) else None for h in _line_hashes(lines)]
                sets = {r: set(lost[r]) for r in at}
                kept: dict[int, list[str]] = {r: [] for r in at}
                for r, line, h in zip(owner, lines, hashes):
                    if h is None or h not in sets[r]:
                        kept[r].append(line)
                for r in at:
                    texts[r] = "\n".join(kept[r])
            cols = list(batch.columns)[: len(names)]
            cols[k] = pa.array(texts, cols[k].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return left.mapInArrow(run, docs.schema)


def _line_hashes(lines: list[str]) -> Iterator[np.ndarray]:
    """Of each line the hash of its normalised form, or nothing if it has no words."""
    for i, j, data, at in blocks(pa.array(lines, pa.string())):
        _, t, h, _ = measure_block(data, at)
        yield from np.split(h, np.searchsorted(t, np.arange(1, j - i)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).drop("n_lost_words")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = "'[^\\x20\\x09-\\x0D]+'"
ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS ws FROM documents),
lines AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line FROM docs),
full_lines AS (SELECT doc_id, host, line, regexp_extract_all(translate(line, '{_UPPER}', '{_LOWER}'), {_WORDS}) AS lw FROM lines WHERE regexp_matches(line, {_WORDS})),
dups AS (SELECT doc_id, sum(n - 1)::bigint AS n FROM (SELECT doc_id, line, count(*) AS n FROM full_lines GROUP BY ALL) GROUP BY doc_id),
windows AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS w FROM docs WHERE len(ws) >= 5),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM again) GROUP BY doc_id),
normal AS (SELECT doc_id, host, array_to_string(lw, ' ') AS line, sum(len(lw)) AS w FROM full_lines GROUP BY ALL),
common AS (SELECT host, line, min(doc_id) AS owner FROM normal GROUP BY host, line HAVING count(DISTINCT doc_id) > {MIN_DOCS}),
lost AS (SELECT doc_id, sum(w)::bigint AS n FROM normal JOIN common USING (host, line) WHERE doc_id <> owner GROUP BY doc_id),
counts AS (SELECT doc_id, len(ws)::bigint AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
  coalesce(dups.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS gone
  FROM docs LEFT JOIN dups USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words) AND n_words - gone >= {MIN_WORDS} AND n_words - gone >= {MIN_LEFT} * n_words AS kept FROM counts
"""
