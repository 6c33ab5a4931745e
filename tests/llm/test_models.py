"""Trained and searching operators: held-out accuracy, exact round trips, brute force."""

import hashlib
import heapq
import random
import struct
from collections import defaultdict

import numpy as np
import pytest

pytest.importorskip("curastra.llm")
from pyspark.sql import functions as F  # noqa: E402

from curastra.llm import chat, language, mixing, neighbours, pieces, quality  # noqa: E402
from curastra.llm.common import Scratch  # noqa: E402
from curastra.llm.components import components  # noqa: E402

LONG = " ".join(f"w{i % 977}" for i in range(40_000))
ODD = [(1, None, "en", "a"), (2, "", "en", "a"), (3, "12 34 !!", None, "a"), (4, LONG, "en", "b"), (5, "one two", "en", None), (5, "one two", "en", None), (None, "naïve über ▁ x\t\ny  z ", "fr", "b")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS x", "2 AS score", "3 AS ids", "4 AS _rank", "5 AS held_out")


def rows_of(df, key=0):
    return {r[key]: r for r in df.collect()}


# quality


def junk(rng, good):
    w = [rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + rng.choice("abcdefgh") for _ in range(rng.randrange(30, 150))]
    if good:
        return " ".join(x.capitalize() + "." if i % 9 == 8 else x for i, x in enumerate(w))
    return " ".join(x.upper() + "!!" for x in w) if rng.random() < 0.5 else " ".join(x + rng.choice(["***", "$$$", "&&&"]) for x in w)


def test_quality_separates_held_out_rows(spark):
    rng = random.Random(4)
    data = [(i, junk(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string, quality int").repartition(6)
    out = quality.score(docs.select("doc_id", "text"), docs.select("doc_id", "quality")).collect()
    truth = {i: y for i, _, y in data}
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    good, bad = [r.score for r in held if truth[r.doc_id]], [r.score for r in held if not truth[r.doc_id]]
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    kept = quality.keep_good(docs.select("doc_id", "text"), docs.select("doc_id", "quality"))
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.predicted}


def test_quality_learns_nothing_from_held_out_labels(spark):
    rng = random.Random(9)
    data = [(i, junk(rng, i % 3 > 0), int(i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame(data, "doc_id long, text string, quality int")
    flipped = docs.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (rows_of(quality.score(docs.select("doc_id", "text"), y.select("doc_id", "quality"))) for y in (docs, flipped))
    assert all(abs(a[k].score - b[k].score) < 1e-9 for k in a)


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 1), (4, 0)], "doc_id long, quality int")
    out = quality.score(odd(spark), labels).collect()
    assert len(out) == len(ODD) and all(0 <= r.score <= 1 for r in out) and [r.held_out for r in out if r.doc_id is None] == [True]
    assert {r.score for r in quality.score(odd(spark), labels.limit(0)).collect()} == {0.5}
    assert quality.score(odd(spark).limit(0), labels).count() == 0
    assert quality.keep_good(odd(spark), labels).columns == odd(spark).columns


def test_isotonic_is_the_least_squares_monotone_fit():
    rng = np.random.default_rng(0)
    x, y, w = np.arange(40.0), rng.random(40) + np.arange(40) / 60, rng.random(40) + 0.1
    at, level = quality.isotonic(x, y, w)
    assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all()
    fit = np.maximum.accumulate([max(min((w[i : j + 1] @ y[i : j + 1]) / w[i : j + 1].sum() for j in range(k, 40)) for i in range(k + 1)) for k in range(40)])
    assert set(np.round(level, 9)) == set(np.round(fit, 9))


# language


def test_language_of_held_out_rows(spark):
    rng = random.Random(1)
    stems = {"en": "the of and ing tion er", "fr": "le la que eau ent ç", "de": "der die und ung sch ß", "es": "el los que ción ado ñ"}
    data = [(i, " ".join("".join(rng.choice(stems[g].split()) for _ in range(3)) for _ in range(30)), g) for i in range(600) for g in [rng.choice(list(stems))]]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(5)
    out = rows_of(language.identify(docs))
    truth = {i: g for i, _, g in data}
    held = [k for k, r in out.items() if r.held_out]
    assert set(held) == {i for i in truth if __import__("zlib").crc32(str(i).encode()) % 3 == 1}
    assert np.mean([out[k].lang_pred == truth[k] for k in held]) > 0.97 and all(0 <= r.score <= 1 for r in out.values())
    again = rows_of(language.identify(docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "xx").otherwise(F.col("lang"))).repartition(2)))
    assert {k: r.lang_pred for k, r in again.items()} == {k: r.lang_pred for k, r in out.items()}


def test_language_of_odd_rows(spark):
    out = language.identify(odd(spark)).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(ODD) and all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert by[4].lang_pred != "und" and [r.held_out for r in out if r.doc_id is None] == [True]
    none = language.identify(odd(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"} and language.identify(odd(spark).limit(0)).count() == 0


# pieces


def proto(scores, kinds=None):
    """A unigram model file by hand: (piece, score, type) messages, then trainer and normalizer settings."""

    def varint(n):
        out = b""
        while True:
            n, b = n >> 7, n & 127
            out += bytes([b | (128 if n else 0)])
            if not n:
                return out

    field = lambda k, body: varint(k << 3 | 2) + varint(len(body)) + body
    out = b""
    for i, (piece, score) in enumerate(scores):
        kind = (kinds or {}).get(i, 1)
        out += field(1, field(1, piece.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + varint(3 << 3) + varint(kind))
    trainer = varint(3 << 3) + varint(1) + varint(40 << 3) + varint(0)
    normalizer = field(1, b"identity") + varint(3 << 3) + varint(1) + varint(4 << 3) + varint(0) + varint(5 << 3) + varint(1)
    return out + field(2, trainer) + field(3, normalizer)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    rng = random.Random(3)
    made = [("<unk>", 0.0), ("<s>", 0.0), ("</s>", 0.0)]
    texts = ["▁"] + list("abcd") + ["▁a", "▁b", "ab", "bc", "cd", "abc", "▁ab", "dab", "ca", "▁cab", "bcd"]
    made += [(t, -rng.random() * 6 - 1) for t in texts]
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto(made, {0: 2, 1: 3, 2: 3}))
    return str(path)


def encode_texts(v, texts, n):
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, ids_at, found = pieces.encode_block(v, np.frombuffer(b"".join(raw), dtype=np.uint8), at, n, {})
    return [ids[a:b].tolist() for a, b in zip(ids_at[:-1], ids_at[1:])], found, (ids, ids_at)


def applied(best, edits):
    out, at = [], 0
    for a, k, ids in edits:
        out += best[at:a] + list(ids)
        at = a + k
    return out + best[at:]


def test_n_best_equals_the_library(unigram):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=unigram)
    v = pieces.Vocabulary.load(unigram)
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 14))) for _ in range(200)]
    texts = [" ".join(t.split()) for t in texts if t.split()]
    score = lambda ids: sum(v.scores[i] for i in ids)
    got, found, _ = encode_texts(v, texts, 5)
    for text, best, options in zip(texts, got, found):
        want = sp.nbest_encode_as_ids(text, 5)
        assert abs(score(best) - score(want[0])) < 1e-4
        mine = [applied(best, e) for _, e in options]
        assert len({tuple(m) for m in mine}) == len(mine) == len(want)
        assert np.allclose([score(m) for m in mine], [score(w) for w in want], atol=1e-4)
        assert np.allclose([s for s, _ in options], [score(m) for m in mine], atol=1e-6)
        assert all(sp.decode(m) == text for m in mine)


def brute_n_best(v, codes, n):
    """All paths, by k-best dynamic programming without any cut."""
    chars = "".join(chr(c) if c != pieces.LITERAL else "\0" for c in codes)
    at = defaultdict(list)
    at[0] = [(0.0, ())]
    for i in range(len(codes)):
        edges = [(i + l, v.id_of[chars[i : i + l]], v.scores[v.id_of[chars[i : i + l]]]) for l in range(1, v.longest + 1) if i + l <= len(codes) and chars[i : i + l] in v.id_of]
        if not any(j == i + 1 for j, _, _ in edges):
            edges.append((i + 1, tuple(v.fallback(codes[i])), v.unknown_score))
        for j, k, s in edges:
            at[j] += [(t + s, (*p, *(k if isinstance(k, tuple) else (k,)))) for t, p in at[i]]
            at[j] = heapq.nlargest(n, at[j], key=lambda x: x[0])
    return at[len(codes)]


def test_n_best_of_the_public_model_against_brute_force():
    v = pieces.Vocabulary.load(pieces.default_model())
    texts = ["Hello world", "The cat sat\n on  the mat.", "naïve über façade", "▁odd ▁▁", "日本語 text", "a", "x" * 70, "\x00\x01"]
    got, found, flat = encode_texts(v, texts, 4)
    for text, best, options in zip(texts, got, found):
        codes = [pieces.SPACE, *[pieces.LITERAL if c == "▁" else pieces.SPACE if c == " " else ord(c) for c in text]]
        want = brute_n_best(v, codes, 4)
        assert [s for s, _ in options] == pytest.approx([s for s, _ in want])
        assert sum(v.scores[i] for i in best if i not in v.byte_id.tolist()) <= 0
    back, at = pieces.decode_ids(v, *flat)
    assert [back[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:])] == texts


def test_encoding_of_odd_rows(spark):
    out = pieces.encode(odd(spark))
    rows = out.collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(ODD) and all(r.round_trip for r in rows)
    assert by[1].n_pieces == by[2].n_pieces == 0 and [x.score for x in by[1].n_best] == [0.0]
    assert all(len(r.ids) == r.n_pieces and sorted([x.score for x in r.n_best], reverse=True) == [x.score for x in r.n_best] for r in rows)
    decoded = {r.doc_id: r.text for r in pieces.decode(out).select("doc_id", "text").collect()}
    assert decoded[None] == ODD[-1][1] and decoded[4] == LONG and decoded[1] == ""
    assert pieces.encode(odd(spark).limit(0)).count() == 0


def test_round_trip_on_the_table(spark, sf_dir):
    assert pieces.query(spark, sf_dir).where("NOT round_trip").count() == 0


# neighbours


def exact(ids, x, k):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = x @ q
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_neighbours_recall(spark, sf_dir):
    out = neighbours.query(spark, sf_dir).collect()
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    want = exact(ids, x, 20)
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert set(got) == set(want) and np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) > 0.9
    for q in got:
        assert got[q] == sorted(got[q], key=lambda t: (-t[1], t[0]))


def test_neighbours_over_shards_norms_and_copies(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(900, 12)) * rng.uniform(0.2, 3, size=(900, 1))).astype(np.float32)
    x[300:600] = x[5]  # a third of all rows is one vector
    rows = [(int(i), [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 12), (902, [float("nan")] + [1.0] * 11), (903, [None] + [1.0] * 11), (904, [1.0]), (None, [1.0] * 12), (7, [float(v) for v in x[7]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("v", F.lit(2))
    out = neighbours.search(df, shard_rows=200)
    got = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    want = exact(np.arange(900), x.astype(np.float64), 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) > 0.95
    copies = [i for i in range(300, 600) if i % 20 == 0]
    assert all([a for a, _ in got[q]] == [a for a, _ in want[q]] for q in copies)
    assert neighbours.search(df.limit(0)).count() == 0 and neighbours.search(df.where("vec_id = 20")).count() == 0
    few = neighbours.search(df.where("vec_id IN (20, 3, 4)")).collect()
    assert sorted((r["rank"], r.vec_id in (3, 4)) for r in few) == [(1, True), (2, True)]


# chat


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark, sf_dir):
    got = rows_of(chat.query(spark, sf_dir))
    want = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want[r.conv_id].append((r.role, r.text))
    want[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(got) == set(want)
    for k, turns in want.items():
        assert (got[k].n_turns, got[k].turns_sha256, got[k].loss_chars, got[k].loss_sha256) == (len(turns), *digest(turns))


def test_chat_of_odd_rows(spark):
    rng = random.Random(6)
    bits = [*[c.decode() for c in chat.CONTROL], "\\", "\\\\", "é", "\n", "x", "<", "[", "</s", "s>", "<s", "日"]
    rows = [(rng.randrange(12), i, rng.choice(["user", "assistant", "a\nb", "\\", None, "tool\\\n"]), rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randrange(30)))])) for i in range(400)]
    rows += [(None, None, "user", "lost"), (None, 1, "assistant", "found"), (99, 0, "assistant", LONG), (99, 0, "assistant", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted", "2 AS n_turns")
    formatted = chat.format_chat(df)
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        want[c].append((r or "", x or ""))
    for r in formatted.collect():
        assert chat.parse(r.formatted) == want[r.conv_id]
        inner = "".join(r.formatted[s.start : s.end] for s in r.loss_spans)
        assert not any(c.decode() in inner for c in chat.CONTROL)
        assert "".join(chat.unescape(r.formatted[s.start : s.end]) for s in r.loss_spans) == "".join(t for role, t in want[r.conv_id] if role == "assistant")
    assert chat.digests(formatted).count() == len(want) and chat.format_chat(df.limit(0)).count() == 0


# mixing


def test_schedule_stays_within_one_block():
    rng = random.Random(2)
    for case in range(20):
        weights = {f"s{i}": rng.random() ** 3 + 0.001 for i in range(rng.randrange(1, 30))}
        slots = mixing.shares(weights, 512)
        period = sum(slots.values())
        plan = mixing.schedule(slots)
        assert len(plan) == period and all(plan.count(k) == c for k, c in slots.items())
        given = dict.fromkeys(slots, 0)
        for t, k in enumerate(plan, 1):
            given[k] += 1
            assert all(abs(given[s] - c * t / period) < 1 for s, c in slots.items())
        total = sum(weights.values())
        assert all(abs(c / period - weights[k] / total) < 3 * len(weights) / period for k, c in slots.items())


def test_mixing_places_every_row(spark):
    sizes = {"hot": 900, "b": 300, "c": 40, None: 30, "unwanted": 20}
    data = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))] + [(None, "b")]
    df = spark.createDataFrame(data, "doc_id long, source string").withColumn("text", F.lit("t")).repartition(7)
    weights = {"hot": 2, "b": 1, "c": 1, "": 0.5, "absent": 9}
    out = sorted(mixing.place(df.withColumn("slot", F.lit(1)).withColumn("_source", F.lit(2)), weights, block=4, period=64).select("row.source", "slot", "place").collect(), key=lambda r: r.place)
    assert len(out) == len(data) and len({r.place for r in out}) == len(data)
    assert {r.source for r in out[-20:]} == {"unwanted"}
    wanted, given = mixing.shares({k: w for k, w in weights.items() if k != "absent"}, 64), defaultdict(int)
    blocks = list(dict.fromkeys((r.slot, r.source or "") for r in out))
    last = next(i for i, (slot, _) in enumerate(blocks) if i != slot)  # until a source has run out, slots are full
    for t, (_, s) in enumerate(blocks[:last], 1):
        given[s] += 1
        assert all(abs(given[k] - c * t / 64) < 1 for k, c in wanted.items())
    assert last > 20
    named = df.selectExpr("*", "1 AS place", "2 AS _rank", "3 AS row", "4 AS _slots")
    mixed = mixing.mix(named, weights, block=4)
    assert mixed.columns == named.columns and mixed.count() == len(data)
    assert mixing.place(df.limit(0)).count() == 0 and mixing.mix(df.limit(0)).count() == 0


def test_mixed_order_is_the_order_of_rows(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("source"))
    want = [r.row.doc_id for r in sorted(mixing.place(df).collect(), key=lambda r: r.place)]
    assert [r.doc_id for r in mixing.mix(df).collect()] == want


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1100)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(250)] + [(5, 5)]
    rng.shuffle(edges)
    got = {r.id: r.comp for r in components(Scratch(spark), spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    assert got == {k: find(k) for k in root}
