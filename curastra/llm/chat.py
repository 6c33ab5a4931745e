"""Chat formatting by columnar byte assembly.

The template is ``<s>role\\ntext</s>`` for every turn. Roles and texts are escaped reversibly: a backslash is doubled, and
a backslash is put after the first character of any control string, so that no control string is left inside. All
segments of a batch (marks, roles, texts) are laid out at once: lengths, running offsets, and one scatter of every source
into a buffer that is allocated once and becomes the Arrow string column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import importable
from .common import table

OPEN, BREAK, CLOSE = b"<s>", b"\n", b"</s>"
#: Strings that chat templates give a meaning; none is left whole in an escaped text.
CONTROL = (b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>", b"<|")
ESCAPE = 0x5C
LOSS_ROLE = "assistant"


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string()).fill_null("")
    _, at, data = column.buffers()
    at = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def escape(data: np.ndarray, at: np.ndarray, newline: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Escaped bytes and offsets of a column; with ``newline``, line feeds get a backslash before them as well."""
    after = np.zeros(len(data) + 1, dtype=np.int64)  # after[i]: an extra backslash goes before byte i
    after[:-1] += data == ESCAPE
    if newline:
        after[:-1] += data == 0x0A
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for mark in CONTROL:
        n = len(mark)
        if len(data) >= n:
            hit = np.ones(len(data) - n + 1, dtype=bool)
            for k, c in enumerate(mark):
                hit &= data[k : len(data) - n + 1 + k] == c
            places = np.flatnonzero(hit)
            places = places[row[places] == row[places + n - 1]]
            after[places + 1] = 1
    moved = np.arange(len(data)) + np.cumsum(after[:-1])
    grown = np.concatenate([[0], np.cumsum(after[:-1])])
    out = np.full(len(data) + int(grown[-1]), ESCAPE, dtype=np.uint8)
    out[moved] = data
    return out, at + grown[at]


def unescape(text: str) -> str:
    """The text before ``escape``."""
    if "\\" not in text:
        return text
    out, i = [], 0
    while True:
        j = text.find("\\", i)
        if j < 0 or j + 1 >= len(text):
            return "".join([*out, text[i:] if j < 0 else text[i:j]])
        out += [text[i:j], text[j + 1]]
        i = j + 2


def assemble(role: pa.Array, text: pa.Array, turns_at: np.ndarray) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray, np.ndarray]:
    """Formatted conversations; turn k's escaped text lies at code points start[k]:end[k] of its conversation.

    ``turns_at`` has the offsets of conversations in turns. Also returns the conversation of each turn.
    """
    n = len(role)
    sources = [escape(*_bytes(role), newline=True), escape(*_bytes(text))]
    lengths = np.empty((n, 5), dtype=np.int64)
    lengths[:, 0], lengths[:, 2], lengths[:, 4] = len(OPEN), len(BREAK), len(CLOSE)
    lengths[:, 1], lengths[:, 3] = np.diff(sources[0][1]), np.diff(sources[1][1])
    offsets = np.concatenate([[0], np.cumsum(lengths.ravel())])
    begin = offsets[:-1].reshape(n, 5)
    buffer = np.empty(int(offsets[-1]), dtype=np.uint8)
    for k, mark in ((0, OPEN), (2, BREAK), (4, CLOSE)):
        for i, c in enumerate(mark):
            buffer[begin[:, k] + i] = c
    for k, (data, at) in ((1, sources[0]), (3, sources[1])):
        buffer[np.arange(len(data)) + np.repeat(begin[:, k] - at[:-1], np.diff(at))] = data
    of_conv = np.repeat(np.arange(len(turns_at) - 1), np.diff(turns_at))
    conv_at = np.append(begin[:, 0], offsets[-1])[turns_at]
    points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80, dtype=np.int64)])
    origin = points[conv_at[:-1]][of_conv]
    start, end = points[begin[:, 3]] - origin, points[begin[:, 4]] - origin
    made = pa.LargeStringArray.from_buffers(len(turns_at) - 1, pa.py_buffer(conv_at.astype(np.int64)), pa.py_buffer(buffer))
    return made, of_conv, start, end


_OUT = "conv_id long, n_turns long, formatted string, loss_spans array<struct<start:long,end:long>>"


def _finished(rows: pa.Table) -> pa.RecordBatch:
    ids = rows["conv_id"].to_numpy(zero_copy_only=False)
    missing = rows["conv_id"].is_null().to_numpy()
    filled = rows["conv_id"].fill_null(0).to_numpy()
    cuts = np.flatnonzero((filled[1:] != filled[:-1]) | (missing[1:] != missing[:-1])) + 1
    turns_at = np.concatenate([[0], cuts, [len(ids)]])
    role, text = rows["role"].combine_chunks(), rows["text"].combine_chunks()
    made, of_conv, start, end = assemble(role, text, turns_at)
    lossy = pa.compute.equal(role.fill_null(""), LOSS_ROLE).to_numpy(zero_copy_only=False)
    offsets = np.searchsorted(of_conv[lossy], np.arange(len(turns_at))).astype(np.int32)
    spans = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(start[lossy]), pa.array(end[lossy])], names=["start", "end"]))
    return pa.RecordBatch.from_arrays([rows["conv_id"].combine_chunks().take(pa.array(turns_at[:-1])), pa.array(np.diff(turns_at)), made.cast(pa.string()), spans], names=["conv_id", "n_turns", "formatted", "loss_spans"])


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns; the last conversation of a batch waits for the next one, which may go on with it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_pylist()
        if held and held[0].column("conv_id")[0].as_py() != ids[0]:
            yield _finished(pa.Table.from_batches(held))
            held = []
        k = len(ids) - 1
        while k > 0 and ids[k - 1] == ids[-1]:
            k -= 1
        if k:
            yield _finished(pa.Table.from_batches([*held, batch.slice(0, k)]))
            held = []
        held.append(batch.slice(k))
    if held:
        yield _finished(pa.Table.from_batches(held))


def format_chat(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (code points of the escaped assistant texts in ``formatted``).

    Turns of a conversation stand by turn (null first), then role and text; repeated rows stay. A null role or text is
    an empty one, and rows without conv_id form one conversation without id. Other columns are not read; an empty table
    gives an empty result. A conversation is one value of the result, so its turns meet in one task.
    """
    importable(turns.sparkSession)
    picked = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_assembled, _OUT)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    out, i = [], 0
    while i < len(formatted):
        if not formatted.startswith("<s>", i):
            raise ValueError(f"no turn at {i}")
        end = formatted.index("</s>", i)
        body = formatted[i + 3 : end]
        k = body.index("\n")
        while (k - len(body[:k].rstrip("\\"))) % 2:  # an escaped line feed belongs to the role
            k = body.index("\n", k + 1)
        out.append((unescape(body[:k]), unescape(body[k + 1 :])))
        i = end + 4
    return out


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist()):
            turns = parse(text)
            loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
            rows["n_turns"].append(len(turns))
            rows["turns_sha256"].append(hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
            rows["loss_chars"].append(len(loss))
            rows["loss_sha256"].append(hashlib.sha256(loss.encode()).hexdigest())
            rows["formatted_chars"].append(len(text))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *map(pa.array, rows.values())], names=["conv_id", *rows])


def digests(formatted: DataFrame) -> DataFrame:
    return formatted.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return digests(format_chat(turns.unionByName(own)))


def _extra(column: str) -> str:
    """Backslashes that escaping adds to a column, in SQL: one for each backslash and each control string."""
    marks = [c.decode() for c in CONTROL]
    return f"length({column}) - length(replace({column}, chr(92), ''))" + "".join(f" + (length({column}) - length(replace({column}, '{m}', ''))) // {len(m)}" for m in marks)


ORACLE = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
chats AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(length(role) + length(text) + {len(OPEN) + len(BREAK) + len(CLOSE)} + length(role) - length(replace(role, chr(10), '')) + {_extra("role")} + {_extra("text")})::bigint AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::bigint AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM chats
"""
