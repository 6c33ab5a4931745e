"""Near-dedup where ids repeat, ties decide and groups lie below the threshold."""

import random

import numpy as np
import pytest

pytest.importorskip("curastra.llm")
from curastra.llm import components, minhash  # noqa: E402

PLAIN = "doc_id long, text string"


def words(tag, n=60):
    return " ".join(f"{tag}{i}" for i in range(n))


def test_ids_with_several_texts(spark):
    a, b = words("a"), words("b")
    df = spark.createDataFrame([(1, a), (1, b), (2, a + " zz"), (3, b + " zz"), (7, words("c")), (8, words("c") + " q")], PLAIN)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == {(1, 58): (1, True), (2, 59): (1, False), (3, 59): (1, False), (7, 58): (7, True), (8, 59): (7, False)}
    kept = sorted((r.doc_id, r.text[0]) for r in minhash.keep_one(df).collect())
    assert kept == [(1, "a"), (1, "b"), (7, "c")]
    # the smallest id of one text is not the smallest of the other: each group keeps one row
    df = spark.createDataFrame([(5, a), (5, b), (4, b + " zz"), (9, a + " zz")], PLAIN)
    assert sorted((r.doc_id, r.text[0]) for r in minhash.keep_one(df).collect()) == [(4, "b"), (5, "a")]


def test_repeated_rows_keep_one_in_a_defined_order(spark):
    rows = [(1, words("a"), f"s{i}", {"k": i}) for i in range(6)] + [(2, None, "x", None)] * 3 + [(None, "a b", "y", None)] * 2
    schema = "doc_id long, text string, source string, extra map<string,int>"
    kept = [minhash.keep_one(spark.createDataFrame(random.Random(s).sample(rows, len(rows)), schema)).collect() for s in range(2)]
    assert sorted(map(str, kept[0])) == sorted(map(str, kept[1]))
    assert sorted(r.doc_id or 0 for r in kept[0]) == [0, 0, 1, 2]


def test_intersections_against_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, hi, size=n)).astype(np.uint64) for hi in (40, 4000, 10**9) for n in (0, 1, 30, 300, 9000)]
    a, b = sets[::2], sets[1::2] + sets[:3]
    want = [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]
    assert minhash.intersections(a, b).tolist() == want
    assert minhash.intersections([], []).shape == (0, 0)


def test_a_template_below_the_threshold(spark):
    """Texts that share 70 % of their shingles with all others and more with none stay apart; planted pairs are found."""
    rng = random.Random(4)
    frame = [f"t{i}" for i in range(120)]
    made = {i: " ".join(frame) + " " + words(f"x{i}y", 26) for i in range(1500)}
    for i in range(40):
        made[5000 + i] = made[rng.randrange(1500)] + " end"
    want = {k: k for k in made}
    for i in range(40):
        base = made[5000 + i][:-4]
        want[5000 + i] = next(k for k, t in made.items() if t == base)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(list(made.items()), PLAIN)).collect()}
    assert got == want


def test_components_in_rounds_and_in_one_task(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(200)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(250)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    want = {x: find(x) for x in root}
    df = spark.createDataFrame(edges, "a long, b long")
    some = {x for e in edges if e[0] != e[1] for x in e}
    for few in (0, 20, 1 << 19):
        got = dict(map(tuple, components.components(minhash.Scratch(spark), df, few).collect()))
        assert got == {x: want[x] for x in some}
