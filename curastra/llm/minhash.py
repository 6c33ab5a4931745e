"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

Two permutations make all signature coordinates: ``sigma`` spreads shingles over a universe of ``UNIVERSE`` places
and coordinate k is the least value of ``pi`` shifted circularly by k. The k-th values of one place are neighbours in
memory, so a shingle costs one contiguous read and one vector minimum for all coordinates together.

No group is ever expanded into all its pairs:

1. Rows with equal shingle sets fall into one class by a 128-bit set hash. Classes are numbered; doc_ids come back at the end,
   so that an id may stand for several texts.
2. Band keys give each bucket a pivot, its smallest class. The distinct (pivot, member) rows of all buckets of a pivot
   form a star.
3. Pivots are verified against their members, in chunks; links give first components.
4. Buckets whose members still lie in several components are compared in blocks of bounded size, those outside the bucket's
   commonest component against all: first on signature bits, where only members with a possible partner go on, then on full
   shingle sets. A block returns links that join components, not pairs.
5. Components of all links.

Every link is confirmed on full sets. A pair at the threshold is missed with a chance under ``MISS`` by the bands and under
another ``MISS`` by the tests of signature bits in steps 3 and 4 (a margin of ``SIGMAS`` deviations), and less the more alike
the texts are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, bits_needed, ceil_div, keys_join, string_columns, table
from .components import components
from .textkernel import LOWER, blocks, mix, split_words

UNIVERSE = 1 << 22
MISS = 1e-7
CHUNK = 256
SIDE = 512
#: Sides of blocks of signature bits (a member takes some 80 bytes), and most shingles on a side of a block of texts.
BITS_SIDE = 2048
SIDE_SHINGLES = 1 << 21
SIGMAS = 6.0
_SEED = 20240229
_WORDS64 = 4
#: A shingle in at most so many pairs of sets is counted pair by pair; the others go into matrices of so many columns.
RARE, COLUMNS = 16, 4096

_pi: dict[int, np.ndarray] = {}


def bands_for(threshold: float) -> tuple[int, int]:
    """(rows, bands): as few bands as leave a pair at the threshold unseen with a chance of ``MISS``."""
    rows = 6 if threshold >= 0.85 else 5 if threshold >= 0.75 else 4 if threshold >= 0.6 else 3
    bands = math.ceil(math.log(MISS) / math.log(1 - threshold**rows))
    while rows * bands > 64 * _WORDS64 and rows > 1:
        rows -= 1
        bands = math.ceil(math.log(MISS) / math.log(1 - threshold**rows))
    return rows, bands


def _shifted_pi(k: int) -> np.ndarray:
    """Row s holds pi at s, s + 1, ... s + k - 1 (circular): all coordinates of one place."""
    if k not in _pi:
        pi = np.random.default_rng(_SEED).permutation(UNIVERSE).astype(np.uint32)
        _pi[k] = np.lib.stride_tricks.sliding_window_view(np.concatenate([pi, pi[:k]]), k)
    return _pi[k]


def shingle_sets(data: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """For each text its sorted distinct 64-bit hashes of n-word shingles; a shorter text is one shingle, an empty one none."""
    w = split_words(LOWER[data], at)
    h = w.hashes()
    roll = h
    for _ in range(n - 1):
        roll = mix(roll[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[len(h) - len(roll) + 1 :]) if len(roll) else roll
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= n:
            s = np.sort(roll[a : b - n + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) > 1 else s)
        elif b > a:
            one = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in h[a:b]:
                    one = mix(np.array([one * np.uint64(31) + x]))[0]
            out.append(np.array([one], dtype=np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray, k: int) -> np.ndarray:
    """k circulant MinHash coordinates of a set that has elements."""
    pi = _shifted_pi(k)
    place = ((s * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 22)).astype(np.int64)  # sigma
    out = pi[place[:4096]].min(axis=0)
    for i in range(4096, len(place), 4096):
        out = np.minimum(out, pi[place[i : i + 4096]].min(axis=0))
    return out


def _set_hash(s: np.ndarray) -> tuple[int, int]:
    one, two = mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _sketch(sigs: np.ndarray) -> np.ndarray:
    """The lowest bit of each coordinate, packed into 64-bit words."""
    bits = np.zeros((len(sigs), 64 * _WORDS64), dtype=np.uint8)
    bits[:, : sigs.shape[1]] = sigs & 1
    return np.packbits(bits, axis=1).view(np.int64)


_SKETCH = [f"s{i}" for i in range(_WORDS64)]


def _signed(words: int, rows: int, bands: int):
    k = rows * bands
    names = ["doc_id", "t", "n", "f1", "f2", *_SKETCH, "bands"]
    times = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    salt = mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, t = batch.column(0), batch.column(1)
            for i, j, data, at in blocks(batch.column(2)):
                sets = shingle_sets(data, at, words)
                sigs = np.zeros((j - i, k), dtype=np.uint32)
                f = np.zeros((j - i, 2), dtype=np.int64)
                for r, s in enumerate(sets):
                    if len(s):
                        sigs[r], f[r] = signature(s, k), _set_hash(s)
                key = mix((sigs.reshape(j - i, bands, rows).astype(np.uint64) * times).sum(axis=2, dtype=np.uint64) + salt).view(np.int64)
                sketch = _sketch(sigs)
                n = np.array([len(s) for s in sets], dtype=np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * bands, bands, dtype=np.int32)), pa.array(key.ravel()))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), t.slice(i, j - i), pa.array(n), pa.array(f[:, 0]), pa.array(f[:, 1]), *[pa.array(sketch[:, c]) for c in range(_WORDS64)], lists], names=names)

    return run, "doc_id long, t long, n long, f1 long, f2 long, " + ", ".join(f"{c} long" for c in _SKETCH) + ", bands array<long>"


def _linked(inter, na, nb, num: int, den: int):
    return den * inter >= num * (na + nb - inter)


def _sorted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i, j, data, at in blocks(batch.column("text")):
            yield batch, i, j, data, at


def _verify_stars(words: int, num: int, den: int):
    """Rows (p, salt, member, id, text), sorted so that a pivot's row comes before its members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, key = None, None
        for batch, i, j, data, at in _sorted_rows(batches):
            ps, salts, member, ids = (batch.column(c).slice(i, j - i).to_pylist() for c in ("p", "salt", "member", "id"))
            a, b = [], []
            for r, s in enumerate(shingle_sets(data, at, words)):
                if not member[r]:
                    pivot, key = s, (ps[r], salts[r])
                elif key == (ps[r], salts[r]) and len(s) and len(pivot):
                    where = np.searchsorted(pivot, s)
                    where[where == len(pivot)] = 0
                    if _linked(int((pivot[where] == s).sum()), len(pivot), len(s), num, den):
                        a.append(ps[r])
                        b.append(ids[r])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys; a group has about two chunks of rows at most by construction."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            if a == b:
                continue
            key = tuple(c[a] for c in cols)
            if held and key != now:
                yield pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _may_link(k: int, need: int, num: int, den: int):
    """Members of a block that have a possible partner in another component, by size and signature bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _grouped(batches, ["h", "bi", "bj"]):
            sk = np.stack([g[c].to_numpy() for c in _SKETCH], axis=0).view(np.uint64)
            n, comp, ids, chunk = (g[c].to_numpy() for c in ("n", "comp", "id", "chunk"))
            hit = np.zeros(len(n), dtype=bool)
            left, right = np.flatnonzero(chunk == g["bi"][0].as_py()), np.flatnonzero(chunk == g["bj"][0].as_py())
            for s in range(0, len(left), 64):
                rows = left[s : s + 64]
                differ = np.zeros((len(rows), len(right)), dtype=np.uint16)
                for word in sk:
                    differ += np.bitwise_count(word[rows][:, None] ^ word[right])
                low, high = np.minimum(n[rows][:, None], n[right]), np.maximum(n[rows][:, None], n[right])
                ok = (differ <= k - need) & (comp[rows][:, None] != comp[right]) & (den * low >= num * high)
                hit[rows] |= ok.any(axis=1)
                hit[right] |= ok.any(axis=0)
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(g["h"].to_numpy()[hit]), pa.array(ids[hit])], names=["h", "id"])

    return run


def intersections(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each set of ``a`` with each of ``b``; sets are distinct hashes.

    Shingles that few sets hold are counted pair by pair, the others by products of 0/1 matrices, COLUMNS at a time.
    """
    na, nb = len(a), len(b)
    out = np.zeros(na * nb, dtype=np.float64)
    row = np.repeat(np.arange(na + nb), [len(s) for s in (*a, *b)])
    if not len(row):
        return out.reshape(na, nb)
    _, col = np.unique(np.concatenate([*a, *b]), return_inverse=True)
    mine = row < na
    left, right = np.bincount(col[mine], minlength=int(col.max()) + 1), np.bincount(col[~mine], minlength=int(col.max()) + 1)
    times = left * right
    rare = (times > 0) & (times <= RARE)
    # rare shingles: every entry of a set of ``a`` meets the entries of ``b`` in its column
    x, y = np.flatnonzero(mine & rare[col]), np.flatnonzero(~mine & rare[col])
    y = y[np.argsort(col[y], kind="stable")]
    first = np.searchsorted(col[y], col[x])
    size = right[col[x]]
    to = np.concatenate([[0], np.cumsum(size)])
    meet = np.arange(int(to[-1])) - np.repeat(to[:-1] - first, size)
    out += np.bincount(np.repeat(row[x], size) * nb + row[y[meet]] - na, minlength=na * nb)
    out = out.reshape(na, nb)
    often = np.flatnonzero(times > RARE)
    place = np.full(len(times), -1)
    place[often] = np.arange(len(often))
    used = np.flatnonzero(place[col] >= 0)
    used = used[np.argsort(place[col[used]], kind="stable")]
    cuts = np.searchsorted(place[col[used]], np.arange(0, len(often) + COLUMNS, COLUMNS))
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        e = used[lo:hi]
        m = np.zeros((na + nb, COLUMNS), dtype=np.float32)
        m[row[e], place[col[e]] - k * COLUMNS] = 1
        out += m[:na] @ m[na:].T
    return out.astype(np.int64)


def _link_blocks(words: int, num: int, den: int):
    """Exact links between components within a block of texts; one link for each two components that meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _grouped(batches, ["h", "bi", "bj"]):
            ids, root, chunk = g["id"].to_numpy(), g["comp"].to_numpy().copy(), g["chunk"].to_numpy()
            sets = [s for _, _, data, at in blocks(g["text"]) for s in shingle_sets(data, at, words)]
            n = np.array([len(s) for s in sets])
            left, right = np.flatnonzero(chunk == g["bi"][0].as_py()), np.flatnonzero(chunk == g["bj"][0].as_py())
            linked = _linked(intersections([sets[i] for i in left], [sets[i] for i in right]), n[left][:, None], n[right], num, den)
            a, b = [], []
            for x, row in zip(left.tolist(), linked):
                for i in right[row & (root[right] != root[x])].tolist():
                    if root[i] != root[x]:
                        a.append(ids[x])
                        b.append(ids[i])
                        root[root == root[i]] = root[x]
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _chunked(members: DataFrame, most: int, name: str) -> DataFrame:
    """The rows with ``c``, the number of chunks of ``most`` members in their star, and a chunk drawn by the id.

    Only stars of several chunks are joined, by broadcast unless they are too many: no task gets a hot star whole.
    """
    large = members.groupBy("p").agg(ceil_div(F.count("*"), most).alias("c")).where("c > 1")
    dealt = keys_join(members, large, "p", "left").withColumn("c", F.coalesce("c", F.lit(1).cast("long")))
    return dealt.withColumn(name, F.pmod(F.xxhash64("id"), F.col("c")))


def _blocked(members: DataFrame, side: int) -> DataFrame:
    """Rows (h, id, n, minor, ...) dealt into blocks (h, bi, bj) of two chunks of about ``side`` members each, or one chunk.

    Chunks of minor members (those outside their bucket's commonest component) meet each other and all other chunks;
    two chunks of the commonest component don't meet.
    """
    minor = lambda x: F.sum(F.when(F.col("minor"), x).otherwise(0))
    major = lambda x: F.sum(F.when(F.col("minor"), 0).otherwise(x))
    chunks = lambda part: F.greatest(ceil_div(part(F.lit(1)), side), ceil_div(part(F.col("n")), SIDE_SHINGLES))
    sizes = members.groupBy("h").agg(chunks(minor).alias("few"), chunks(major).alias("many"))
    dealt = keys_join(members, sizes, "h", "inner")
    draw = F.xxhash64("id", "h")
    dealt = dealt.withColumn("chunk", F.when(F.col("minor"), F.pmod(draw, F.col("few"))).otherwise(F.col("few") + F.pmod(draw, F.greatest("many", F.lit(1)))))
    last = F.when(F.col("minor"), F.col("few") + F.col("many")).otherwise(F.col("few")) - 1
    dealt = dealt.where("few > 0").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return dealt.withColumn("bi", F.least("chunk", "k")).withColumn("bj", F.greatest("chunk", "k")).drop("few", "many", "k")


def _rows(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int) -> DataFrame:
    """doc_id, t (hash of the text), n (shingles), component (a number of it, null without shingles), least (the smallest id in it)."""
    scratch = Scratch(docs.sparkSession)
    rows, bands = bands_for(num / den)
    k = rows * bands
    docs = string_columns(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")

    run, schema = _signed(words, rows, bands)
    signed = scratch.cut(docs.mapInArrow(run, schema))
    classes = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("f1", "f2", "n")
    classes = classes.agg(F.min(F.struct("doc_id", "t")).alias("rep"), *[F.first(c).alias(c) for c in _SKETCH], F.first("bands").alias("bands"))
    # numbers differ between attempts of a task; those of the written table are the ones that count
    classes = scratch.cut(classes.select(F.monotonically_increasing_id().alias("id"), "f1", "f2", "n", "rep.doc_id", "rep.t", *_SKETCH, "bands"))
    thin = classes.select("id", "n", *_SKETCH)

    def texts(wanted: DataFrame) -> DataFrame:
        """(id, text) of classes; a row that is there many times counts once."""
        reps = keys_join(classes.select("id", "doc_id", "t"), wanted, "id", "left_semi")
        return keys_join(docs, reps, ["doc_id", "t"], "inner").groupBy("id").agg(F.first("text").alias("text"))

    entries = classes.select("id", F.explode("bands").alias("h"))
    pivots = entries.groupBy("h").agg(F.min("id").alias("p"), F.max("id").alias("top")).where("p < top").select("h", "p")
    buckets = scratch.cut(entries.join(pivots, "h").where("id <> p").select("h", "p", "id"))

    # pivots against their members
    need = bits_needed((1 + num / den) / 2, k, SIGMAS)
    other = thin.select(F.col("id").alias("p"), F.col("n").alias("pn"), *[F.col(c).alias(f"p{c}") for c in _SKETCH])
    agree = F.lit(k) - sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"p{c}"))) for c in _SKETCH), F.lit(0))
    star = buckets.select("p", "id").distinct().join(thin, "id").join(other, "p").where((agree >= need) & (den * F.least("n", "pn") >= num * F.greatest("n", "pn"))).select("p", "id")
    star = scratch.cut(star)
    dealt = _chunked(star, CHUNK, "salt")
    asked = dealt.select("p", "salt", F.lit(1).alias("member"), "id").unionAll(dealt.select("p", "salt").distinct().select("p", "salt", F.lit(0), F.col("p").alias("id")))
    rowed = asked.join(texts(asked.select("id").distinct()), "id").repartition("p", "salt").sortWithinPartitions("p", "salt", "member").select("p", "salt", "member", "id", "text")
    links = scratch.cut(rowed.mapInArrow(_verify_stars(words, num, den), "a long, b long"))
    first = components(scratch, links)

    # what the pivots left apart, in blocks
    parted = scratch.cut(keys_join(buckets.select("h", "id"), first, "id", "left").select("h", "id", F.coalesce("comp", "id").alias("comp")))
    per = parted.groupBy("h", "comp").agg(F.count("*").alias("m")).groupBy("h")
    per = per.agg(F.max(F.struct("m", "comp")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("h", F.col("main.comp").alias("main"))
    members = keys_join(parted, per, "h", "inner").select("h", "id", "comp", (F.col("comp") != F.col("main")).alias("minor"))
    members = scratch.cut(members.join(thin, "id"))
    by_block = ["h", "bi", "bj"]
    sketched = _blocked(members, BITS_SIDE).repartition(*by_block).sortWithinPartitions(*by_block).select(*by_block, "chunk", "id", "comp", "n", *_SKETCH)
    alive = scratch.cut(sketched.mapInArrow(_may_link(k, need, num, den), "h long, id long").distinct())
    staged = _blocked(members.select("h", "id", "comp", "minor", "n").join(alive, ["h", "id"]), SIDE)
    staged = staged.join(texts(alive.select("id").distinct()), "id").repartition(*by_block).sortWithinPartitions(*by_block).select(*by_block, "chunk", "id", "comp", "text")
    more = scratch.cut(staged.mapInArrow(_link_blocks(words, num, den), "a long, b long"))
    comps = components(scratch, links.unionAll(more))

    least = comps.join(classes.select("id", "doc_id"), "id").groupBy("comp").agg(F.min("doc_id").alias("least"))
    comps = scratch.cut(comps.join(least, "comp").select("id", "comp", "least"))
    scratch.drop(buckets, star, links, parted, members, alive, more)
    of_class = keys_join(classes.select("f1", "f2", "n", "id", "doc_id"), comps, "id", "left")
    of_class = of_class.select("f1", "f2", "n", F.coalesce("comp", "id").alias("component"), F.coalesce("least", "doc_id").alias("least"))
    return signed.select("doc_id", "t", "n", "f1", "f2").join(of_class, ["f1", "f2", "n"], "left").select("doc_id", "t", "n", "component", "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Texts are lower-cased (A-Z) and split at ASCII white space. Two rows are linked if
    den * |A and B| >= num * |A or B| on their sets of ``words``-word shingles (num/den is the similarity). component_id
    is the smallest id that links reach, and kept says whether that is the row's own id.

    A null or blank text has no shingles and is linked with nothing. Repeated rows get equal results; rows with one id and
    different texts are documents of their own. A row with a null id takes the component of equal texts that have an id,
    or none; kept is then false. An empty table gives an empty result. Other columns are not read.
    """
    rows = _rows(docs, id_col, text_col, words, num, den)
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The columns of ``docs``, with one document of each near-duplicate group: the smallest id, then the smallest hash of the text.

    Of rows that repeat both id and text, the one with the smallest hash of all columns stays (columns that hold maps don't
    count); an id with texts of several groups keeps a row in each. Rows without an id stay: they can't be told apart.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.cut(_rows(docs, "doc_id", "text", words, num, den).where("doc_id IS NOT NULL").select("doc_id", "t", "component"))
    first = found.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("doc_id", "t")).alias("k"), F.max(F.struct("doc_id", "t")).alias("top"))
    first = first.where("k <> top").select("component", "k")
    lost = keys_join(found, first, "component", "inner").where(F.struct("doc_id", "t") != F.col("k"))
    lost = scratch.cut(lost.select(F.col("doc_id").alias("_lost_id"), F.col("t").alias("_lost_t")).distinct())
    key, text = docs["doc_id"].cast("long"), F.xxhash64(docs["text"].cast("string"))
    small = lambda keys: F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    left = docs.join(small(lost), (key == lost["_lost_id"]) & (text == lost["_lost_t"]), "left_anti")
    twice = scratch.cut(found.groupBy("doc_id", "t").count().where("count > 1").select(F.col("doc_id").alias("_twice_id"), F.col("t").alias("_twice_t")))
    if twice.isEmpty():
        return left
    on = (key == twice["_twice_id"]) & (text == twice["_twice_t"])
    once = left.join(small(twice), on, "left_anti")
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    again = left.join(small(twice), on, "left_semi").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("k1"), text.alias("k2"), F.xxhash64(*hashed).alias("h"))
    again = again.groupBy("k1", "k2").agg(F.min_by("row", "h").alias("row")).select("row.*")
    return once.unionByName(again)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS s FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
edges AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a),
comps AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comps ON id = d.doc_id LEFT JOIN sizes USING (doc_id)
"""
