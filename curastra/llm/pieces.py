"""SentencePiece encoding and decoding with N-best segmentation.

A text is a lattice of vocabulary pieces over its characters (blanks are U+2581, one is put first, a character without
piece falls back to its bytes). The best path is found by Viterbi, for all distinct words of a block at once. Where no
piece can cross a place, the lattice falls apart into independent segments, so that the N best paths of a text differ
from the best one in few segments: those whose second-best path costs least. Those costs come exactly from forward and
backward scores; only the N - 1 cheapest segments of a text are searched, backwards by A-star with the forward Viterbi
scores as exact heuristic, and their lists are merged.

Scores are those of the model file and their sum is what a path is worth, as in a unigram lattice. With a BPE model
(scores are negative merge ranks) the best path may differ from the pieces that BPE merging gives; decoding gives
the same text for any path.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import string_columns, table
from .textkernel import _power, blocks, mix

SPACE, LITERAL = 0x2581, 0x110000  # a blank; a U+2581 of the text itself, which no piece has
N_BEST = 4
#: Larger blocks than elsewhere: distinct words are looked up once in each.
BLOCK = 1 << 20
UNKNOWN_PENALTY = 10.0
_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_TABLE_BITS = 18
_CELLS = 1 << 18
#: Longer segments are cut wherever no piece crosses; groups of fewer than FEW of them are searched one by one.
LONG, FEW = 64, 32


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Vocabulary:
    """Pieces, scores and kinds of a model, as small arrays that travel to the executors."""

    pieces: list[str]
    scores: np.ndarray
    byte_id: np.ndarray  # 256 ids; -1 where the model has none
    unknown: int
    special: set[int]
    longest: int = 0
    unknown_score: float = 0.0
    id_of: dict[str, int] = field(default_factory=dict)
    tables: list = field(default_factory=list)
    joined: np.ndarray | None = None
    bytes_: np.ndarray | None = None
    bytes_at: np.ndarray | None = None
    cut_at_blanks: bool = True

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        byte_id = np.full(256, -1, dtype=np.int64)
        special = set()
        for i, p in enumerate(pieces):
            if sp.is_byte(i):
                byte_id[int(p[3:5], 16)] = i
            if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                special.add(i)
        if sp.normalize(probe := "\ufb01  \u2167 a ") != (chr(SPACE) + probe).replace(" ", chr(SPACE)):
            raise ValueError("a model that normalises texts has no exact round trip")
        return cls(pieces, np.array([sp.get_score(i) for i in range(n)]), byte_id, sp.unk_id(), special).ready()

    def ready(self) -> Vocabulary:
        self.id_of = {p: i for i, p in enumerate(self.pieces) if i not in self.special and p}
        normal = np.array(sorted(self.id_of.values()))
        self.longest = max(map(len, self.id_of), default=1)
        self.unknown_score = float(self.scores[normal].min() if len(normal) else 0) - UNKNOWN_PENALTY
        self.cut_at_blanks = not any(chr(SPACE) in p.lstrip(chr(SPACE)) for p in self.id_of)
        # characters that are in some piece with other characters; at all others the lattice can be cut
        self.joined = np.zeros(0x30000, dtype=bool)
        for p in self.id_of:
            if len(p) > 1:
                for c in p:
                    if ord(c) < len(self.joined):
                        self.joined[ord(c)] = True
        hashes = np.array([self._hash(p) for p in self.id_of], dtype=np.uint64)
        ids = np.array(list(self.id_of.values()), dtype=np.int32)
        self.tables = []
        shift = np.uint64(0)
        while len(ids):
            slot = ((hashes >> shift) & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
            keys, values = np.zeros(1 << _TABLE_BITS, dtype=np.uint64), np.full(1 << _TABLE_BITS, -1, dtype=np.int32)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], values[slot[first]] = hashes[first], ids[first]
            self.tables.append((shift, keys, values))
            rest = np.ones(len(ids), dtype=bool)
            rest[first] = False
            hashes, ids, shift = hashes[rest], ids[rest], shift + np.uint64(9)
        parts = [b"" if i in self.special else p.replace(chr(SPACE), " ").encode() for i, p in enumerate(self.pieces)]
        for v, i in enumerate(self.byte_id.tolist()):
            if i >= 0:
                parts[i] = bytes([v])
        self.bytes_ = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.bytes_at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return self

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_B) + ord(c) + 1) & ((1 << 64) - 1)
        return int(mix(np.array([h], dtype=np.uint64))[0])

    def lookup(self, rolling: np.ndarray) -> np.ndarray:
        h = mix(rolling)
        out = np.full(len(h), -1, dtype=np.int32)
        for shift, keys, values in self.tables:
            slot = ((h >> shift) & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
            hit = keys[slot] == h
            out[hit] = values[slot[hit]]
        return out

    def fallback(self, code: int) -> list[int]:
        raw = chr(SPACE if code == LITERAL else code).encode("utf-8", "replace")
        ids = [int(self.byte_id[b]) for b in raw]
        return ids if min(ids) >= 0 else [self.unknown]


def paths(v: Vocabulary, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best path of every segment codes[start:start + length]: ids and their offsets by segment, score, and what the
    second-best path loses against it (inf if there is none)."""
    n = len(start)
    best, loss = np.zeros(n), np.full(n, np.inf)
    all_ids: list[np.ndarray] = [np.zeros(0, np.int64)] * n
    order = np.argsort(-length, kind="stable")
    a = 0
    while a < n:
        longest = int(length[order[a]])
        rows = order[a : a + max(1, min(20_000, _CELLS // max(1, longest)))]
        # a part must not hold words of very different length
        rows = rows[: int(np.searchsorted(-length[rows], -(longest // 2), side="right"))] if longest > 24 else rows
        a += len(rows)
        if longest > LONG and len(rows) < FEW:
            for r in rows.tolist():
                all_ids[r], best[r], loss[r] = _path_of(v, codes[start[r] : start[r] + length[r]])
        else:
            _paths_of(v, codes, start[rows], length[rows], rows, best, loss, all_ids)
    counts = np.array([len(x) for x in all_ids], dtype=np.int64)
    return np.concatenate(all_ids) if n else np.zeros(0, np.int64), np.concatenate([[0], np.cumsum(counts)]), best, loss


def edges_of(v: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces over ``codes``: first place, length and id (-2: a character without piece), by length and then place."""
    c = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(c), dtype=np.uint64)
    places, sizes, found = [], [], []
    for l in range(1, min(v.longest, len(c)) + 1):
        h = h[: len(c) - l + 1] * _B + c[l - 1 :]
        ids = v.lookup(h)
        if l == 1:
            ids[ids < 0] = -2
        at = np.flatnonzero(ids != -1)
        places.append(at)
        sizes.append(np.full(len(at), l))
        found.append(ids[at])
    return np.concatenate(places), np.concatenate(sizes), np.concatenate(found)


class Lattice:
    """The pieces over one segment by their end, and the best score that reaches each place: one forward Viterbi scan."""

    _last: list = []

    def __init__(self, v: Vocabulary, codes: np.ndarray):
        n = len(codes)
        place, size, ids = edges_of(v, codes)
        order = np.lexsort((place, place + size))
        self.place, self.ids = place[order], ids[order]
        self.end = self.place + size[order]
        self.score = np.where(self.ids >= 0, v.scores[self.ids], v.unknown_score)
        self.first = np.searchsorted(self.end, np.arange(n + 2)).tolist()
        self.a, self.s = self.place.tolist(), self.score.tolist()
        a, s, first = self.a, self.s, self.first
        self.f, self.back = f, back = [0.0] * (n + 1), [0] * (n + 1)
        for t in range(1, n + 1):
            top = -np.inf
            for k in range(first[t], first[t + 1]):
                x = f[a[k]] + s[k]
                if x >= top:
                    top, to = x, k
            f[t], back[t] = top, to

    @classmethod
    def of(cls, v: Vocabulary, codes: np.ndarray) -> Lattice:
        """That of a long segment is kept until the next long one: its best path is wanted first, then its n best."""
        if len(codes) <= LONG:
            return cls(v, codes)
        if not (cls._last and cls._last[0] is v and np.array_equal(cls._last[1], codes)):
            cls._last[:] = [v, codes.copy(), cls(v, codes)]
        return cls._last[2]


def _path_of(v: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, float, float]:
    """What ``_paths_of`` gives, for one long segment: pieces are looked up at all places at once, then one scan each way."""
    n = len(codes)
    lattice = Lattice.of(v, codes)
    a, s, first, f, back = lattice.a, lattice.s, lattice.first, lattice.f, lattice.back
    g = [-np.inf] * n + [0.0]
    for t in range(n, 0, -1):
        tail = g[t]
        for k in range(first[t], first[t + 1]):
            x = s[k] + tail
            if x > g[a[k]]:
                g[a[k]] = x
    on, t = [], n
    while t:
        on.append(back[t])
        t = a[back[t]]
    off = np.ones(len(a), dtype=bool)
    off[on] = False
    second = (np.array(f)[lattice.place[off]] + (lattice.score[off] + np.array(g)[lattice.end[off]])).max(initial=-np.inf)
    out = []
    for k in reversed(on):
        x = int(lattice.ids[k])
        out += [x] if x != -2 else v.fallback(int(codes[a[k]]))
    return np.array(out, dtype=np.int64), f[n], max(f[n] - second, 0.0) if np.isfinite(second) else np.inf


def _paths_of(v, codes, start, length, rows, best, loss, all_ids) -> None:
    m, n = len(start), int(length[0])
    c = codes[np.minimum(start + np.arange(n)[:, None], len(codes) - 1)].astype(np.uint64)  # n x m
    at_least = np.searchsorted(-length, -np.arange(n + 1), side="right")  # rows with that length or more come first
    f = np.full((n + 1, m), -np.inf)
    back = np.zeros((n + 1, m), dtype=np.int32)
    back_id = np.full((n + 1, m), -1, dtype=np.int32)
    f[0] = 0
    edges: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for i in range(n):
        h = np.zeros(at_least[i + 1], dtype=np.uint64)
        for l in range(1, min(v.longest, n - i) + 1):
            k = at_least[i + l]
            if not k:
                break
            h = h[:k] * _B + c[i + l - 1, :k] + np.uint64(1)
            ids = v.lookup(h)
            if l == 1:
                ids[ids < 0] = -2
                at, found = np.arange(k), ids
                s = np.where(ids >= 0, v.scores[ids], v.unknown_score)
            else:
                at = np.flatnonzero(ids >= 0)
                if not len(at):
                    continue
                found = ids[at]
                s = v.scores[found]
            edges[i, l] = at, s
            total = f[i, at] + s
            better = total >= f[i + l, at]  # ties go to the longer last piece
            w = at[better]
            f[i + l, w], back[i + l, w], back_id[i + l, w] = total[better], l, found[better]
    columns = np.arange(m)
    on = np.zeros((n + 1, m), dtype=bool)
    place = length.copy()
    on[place, columns] = True
    steps = []
    live = columns
    while len(live):
        p = place[live]
        steps.append((live, back_id[p, live], p))
        place[live] = p - back[p, live]
        on[place[live], live] = True
        live = live[place[live] > 0]
    top = f[length, columns]
    best[rows] = top
    g = np.full((n + 1, m), -np.inf)
    g[length, columns] = 0
    second = np.full(m, -np.inf)
    for i in range(n - 1, -1, -1):
        for l in range(1, min(v.longest, n - i) + 1):
            if (i, l) in edges:
                at, s = edges[i, l]
                tail = s + g[i + l, at]
                g[i, at] = np.maximum(g[i, at], tail)
                other = ~(on[i + l, at] & (back[i + l, at] == l))
                w = at[other]
                second[w] = np.maximum(second[w], f[i, w] + tail[other])
    loss[rows] = np.where(np.isfinite(second), np.maximum(top - second, 0), np.inf)
    counts = np.zeros(m, dtype=np.int64)
    for live, _, _ in steps:
        counts[live] += 1
    ends = np.cumsum(counts)
    flat = np.empty(int(ends[-1]) if m else 0, dtype=np.int64)
    fill = ends.copy()
    odd = []
    for live, ids, p in steps:
        fill[live] -= 1
        flat[fill[live]] = ids
        odd += [(int(j), int(q)) for j, q in zip(live[ids == -2], p[ids == -2])]
    for j, b, e in zip(range(m), (ends - counts).tolist(), ends.tolist()):
        all_ids[rows[j]] = flat[b:e]
    if odd:
        unknown: dict[int, list[int]] = {}
        for j, q in odd:
            unknown.setdefault(j, []).append(q)
        for j, places in unknown.items():
            places.sort()
            spelled, k = [], 0
            for x in all_ids[rows[j]].tolist():
                if x == -2:
                    spelled += v.fallback(int(codes[start[j] + places[k] - 1]))
                    k += 1
                else:
                    spelled.append(x)
            all_ids[rows[j]] = np.array(spelled, dtype=np.int64)


def n_best(v: Vocabulary, codes: np.ndarray, n: int, best: list[int]) -> list[tuple[float, list[int]]]:
    """The n best paths of one segment, best first: Viterbi forwards, then A-star backwards; ``best`` is the path to put first.

    A partial path costs what it loses against the best one, which is exactly what its best completion loses. Open paths
    lead to different ends, each to one of that cost at least, so that only as many of them stay open as paths are still wanted.
    """
    size, lattice = len(codes), Lattice.of(v, codes)
    a, s, first, f = lattice.a, lattice.s, lattice.first, lattice.f
    # (loss, place, tie-break, edges so far): the one nearest the start first among equals
    open_, out, tick = [(0.0, size, 0, None)], [], 0
    while open_ and len(out) < n:
        loss, at, _, path = open_.pop(0)
        if at == 0:
            found = []
            while path is not None:
                k, path = path
                x = int(lattice.ids[k])
                found += v.fallback(int(codes[a[k]])) if x < 0 else [x]
            out.append((f[size] - loss, found))
            continue
        want, top = n - len(out), f[at]
        for k in range(first[at], first[at + 1]):
            more = loss + (top - (f[a[k]] + s[k]))
            if len(open_) < want or more <= open_[-1][0]:
                tick += 1
                bisect.insort(open_, (more, a[k], tick, (k, path)))
                if len(open_) > want:
                    open_.pop()
    # among equals, the best path of the text comes first
    others = [x for x in out if x[1] != best]
    return [(f[size], best), *others[: n - 1]]


def merged(lists: list[list[tuple[float, list[int]]]], best: float, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best sums of one entry from each list: (score of the text, chosen entries)."""
    first = (0,) * len(lists)
    heap, seen, out = [(-best, first)], {first}, []
    while heap and len(out) < n:
        cost, pick = heapq.heappop(heap)
        out.append((-cost, pick))
        for k in range(len(lists)):
            if pick[k] + 1 < len(lists[k]):
                nxt = (*pick[:k], pick[k] + 1, *pick[k + 1 :])
                if nxt not in seen:
                    seen.add(nxt)
                    heapq.heappush(heap, (cost + lists[k][pick[k]][0] - lists[k][pick[k] + 1][0], nxt))
    return out


def _gather(flat: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists numbered ``which``, one after another, and their offsets."""
    size = at[which + 1] - at[which]
    to = np.concatenate([[0], np.cumsum(size)])
    return flat[np.arange(int(to[-1])) + np.repeat(at[which] - to[:-1], size)], to


def decode_ids(v: Vocabulary, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of id lists: pieces one after another, without the blank that was put first."""
    data, piece_at = _gather(v.bytes_, v.bytes_at, ids)
    text_at = piece_at[at]
    full = text_at[1:] > text_at[:-1]
    keep = np.ones(len(data), dtype=bool)
    heads = text_at[:-1][full]
    keep[heads[data[heads] == 0x20]] = False
    return data[keep], np.concatenate([[0], np.cumsum(keep)])[text_at]


def edit(at: int, old: list[int], new: list[int]) -> tuple[int, int, list[int]]:
    """(first piece, pieces replaced, ids) that make ``new`` of ``old``, which begins at piece ``at``; long lists without their
    common ends."""
    if len(old) <= LONG:
        return at, len(old), new
    most = min(len(old), len(new))
    x, y = np.array(old), np.array(new)
    differ = np.flatnonzero(x[:most] != y[:most])
    head = int(differ[0]) if len(differ) else most
    differ = np.flatnonzero(x[::-1][: most - head] != y[::-1][: most - head])
    tail = int(differ[0]) if len(differ) else most - head
    return at + head, len(old) - head - tail, new[head : len(new) - tail]


def encode_block(v: Vocabulary, data: np.ndarray, at: np.ndarray, n: int, cache: dict):
    """ids, offsets by text, and for each text its n best (score, [(first piece, pieces replaced, ids)])."""
    codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    text_at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    full = text_at[1:] > text_at[:-1]
    codes = np.where(codes == SPACE, LITERAL, np.where(codes == 0x20, SPACE, codes))
    codes = np.insert(codes, text_at[:-1][full], SPACE)
    text_at = text_at + np.concatenate([[0], np.cumsum(full)])
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64), [[(0.0, [])] for _ in range(len(at) - 1)]
    lone = ~v.joined[np.minimum(codes, len(v.joined) - 1)] | (codes >= len(v.joined))
    cut = np.zeros(len(codes), dtype=bool)
    cut[text_at[:-1][full]] = True
    cut |= lone
    cut[1:] |= lone[:-1]
    if v.cut_at_blanks:
        blank = codes == SPACE
        cut[1:] |= blank[1:] & ~blank[:-1]
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(codes))
    far = np.flatnonzero(end - start > LONG)
    for k in far.tolist():
        place, size, _ = edges_of(v, codes[start[k] : end[k]])
        crossed = np.zeros(int(end[k] - start[k]) + 1, dtype=np.int64)
        np.add.at(crossed, place + 1, 1)
        np.add.at(crossed, place + size, -1)
        cut[start[k] : end[k]] |= np.cumsum(crossed)[:-1] == 0
    if len(far):
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(codes))
    up, down = _power("up", 0x9E3779B97F4A7C15 | 1, len(codes)), _power("down", pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64), len(codes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)])])
    key = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    _, rep, which = np.unique(key, return_index=True, return_inverse=True)
    flat, flat_at, best, loss = paths(v, codes, start[rep], (end - start)[rep])
    ids, piece_at = _gather(flat, flat_at, which)
    seg_at = np.searchsorted(start, text_at)
    found = []
    losses = loss[which]
    for a, b in zip(seg_at[:-1].tolist(), seg_at[1:].tolist()):
        score = float(best[which[a:b]].sum())
        if n <= 1 or a == b:
            found.append([(score, [])])
            continue
        part = losses[a:b]
        near = np.argpartition(part, min(n - 1, b - a) - 1)[: n - 1] if b - a > n - 1 else np.arange(b - a)
        near = [a + int(k) for k in near[np.argsort(part[near], kind="stable")] if np.isfinite(part[k])]
        lists = []
        for k in near:
            word, own = codes[start[k] : end[k]], ids[piece_at[k] : piece_at[k + 1]].tolist()
            if len(word) > LONG:
                lists.append(n_best(v, word, n, own))
                continue
            name = word.tobytes()
            if name not in cache:
                if len(cache) > 100_000:
                    cache.clear()
                cache[name] = n_best(v, word, n, own)
            lists.append(cache[name])
        options = []
        for s, pick in merged(lists, score, n):
            edits = sorted(edit(int(piece_at[k] - piece_at[a]), lists[x][0][1], lists[x][pick[x]][1]) for x, k in enumerate(near) if pick[x])
            options.append((s, edits))
        found.append(options)
    return ids, piece_at[seg_at], found


_OUT = "doc_id long, n_pieces long, ids array<int>, n_best array<struct<score:double,edits:array<struct<at:int,n:int,ids:array<int>>>>>, round_trip boolean"
_EDIT = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
_BEST = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))]))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, n: int = N_BEST, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_pieces, ids (best path), n_best, round_trip of every row, and the columns named in ``keep``.

    n_best has the n best paths of the whole text, best first: the score, and how the path differs from ``ids`` (at which
    piece, how many pieces it replaces, by which). There are fewer if the lattice has fewer. round_trip says that decoding
    ``ids`` gives back the text. A null or empty text has no pieces, one path of score 0, and is true; repeated rows
    get equal results; other columns are not read; an empty table gives an empty result. The model is read by the
    driver and travels as arrays of the vocabulary's size.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model or default_model()))
    docs = string_columns(docs, **{"doc_id": id_col, "text": text_col, **{c: c for c in keep}})
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *[f"`{c}`" for c in keep])
    out = ", ".join([_OUT, *[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, cache = vocabulary.value, {}
        for batch in batches:
            for i, j, data, at in blocks(batch.column(1), BLOCK):
                ids, ids_at, found = encode_block(v, data, at, n, cache)
                back, back_at = decode_ids(v, ids, ids_at)
                if len(back) == len(data) and np.array_equal(back_at, at) and np.array_equal(back, data):
                    same = np.ones(j - i, dtype=bool)
                else:
                    same = np.array([np.array_equal(back[back_at[t] : back_at[t + 1]], data[at[t] : at[t + 1]]) for t in range(j - i)])
                lists = pa.ListArray.from_arrays(pa.array(ids_at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                options = [[{"score": s, "edits": [{"at": a, "n": k, "ids": x} for a, k, x in edits]} for s, edits in rows] for rows in found]
                kept = [batch.column(2 + k).slice(i, j - i) for k in range(len(keep))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(ids_at)), lists, pa.array(options, _BEST), pa.array(same), *kept], names=["doc_id", "n_pieces", "ids", "n_best", "round_trip", *keep])

    return docs.mapInArrow(run, out)


def decode(rows: DataFrame, ids_col: str = "ids", model: str | None = None, to: str = "text") -> DataFrame:
    """The rows with a column of decoded texts; a null list gives a null text, unknown pieces nothing."""
    vocabulary = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model or default_model()))

    def run(parts: Iterator) -> Iterator:
        import pandas as pd

        v = vocabulary.value
        for part in parts:
            lists = [np.asarray(x if x is not None else [], dtype=np.int64) for x in part]
            at = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            data, text_at = decode_ids(v, np.concatenate(lists) if lists else np.zeros(0, np.int64), at)
            raw = data.tobytes()
            yield pd.Series([None if x is None else raw[a:b].decode("utf-8", "replace") for x, a, b in zip(part, text_at[:-1], text_at[1:])])

    import pandas as pd

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(run, "string")
    return rows.withColumn(to, udf(F.col(ids_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))
