"""Secrets without digits, short ones and long ones."""

import hashlib
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from curastra.llm import privacy

AKIA = "AKIA" + "IOSFODNN7EXAMPLE"


def test_sure_secrets_of_any_form_are_found_and_masked(spark):
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice(string.ascii_letters) for _ in range(n))
    hidden = {}
    for i in range(30):
        hidden[i] = f"Use {AKIA[:-2]}{letters(2).upper()} here, ", AKIA[:-4]
        hidden[100 + i] = f'then token = "{(x := letters(24))}" is', x
        hidden[200 + i] = f"and the password: {(x := letters(9))}, ok", x
        hidden[300 + i] = f"blob secret_key={(x := letters(700) + '12345')} end", x
        hidden[400 + i] = f"Authorization: Bearer {(x := letters(30))} end", x
    plain = {1000 + i: f"Author: Christopher Smith; tokenizer: sentencepiece; skilful skateboarding {letters(25)} v{i}" for i in range(30)}
    texts = {k: t for k, (t, _) in hidden.items()} | plain
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: [(privacy.KINDS[x.kind], texts[r.doc_id][x.start : x.end]) for x in r.found] for r in privacy.find(df).collect()}
    assert all(len(found[k]) == 1 and found[k][0][0] == "secret" and found[k][0][1].startswith(x) for k, (_, x) in hidden.items())
    assert not any(found[k] for k in plain)
    masked = {r.doc_id: r.text for r in privacy.redact(df.withColumn("n_chars", F.length("text").cast("long"))).collect()}
    assert not any(x in masked[k] for k, (_, x) in hidden.items()) and all(masked[k] == t for k, t in plain.items())


def test_proposals_stay_within_their_text():
    raw = [b"password:", b"abcdef", b"x token", b"= secretvalue", b"sk_", b"", b"=", b":", b"api key: '", b"AKIA"]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    got = privacy.proposals(np.frombuffer(b"".join(raw), dtype=np.uint8), at)
    assert {t: [x[:3] for x in s] for t, s in got.items()} == {4: [(4, 0, 3)], 9: [(4, 0, 4)]}
    assert privacy.proposals(np.zeros(0, dtype=np.uint8), np.array([0, 0])) == {}


def digest(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def test_classifier_beats_the_majority_of_labelers(spark):
    """Forms vote for any long hexadecimal run, so that on bare digests the labelers' majority errs; words before them decide."""
    made, truth = [], {}
    for i in range(400):
        made.append((i, f"commit digest {digest(i)} of the tree"))  # words against it
        made.append((1000 + i, f'the passphrase token = "{digest(1000 + i)}" here'))
    for i in range(60):
        made.append((5000 + i, f"and by a much longer and quite ordinary way round this place the digest {digest(5000 + i)} was seen"))
        made.append((6000 + i, f'and by a much longer and quite ordinary way round this place a passphrase "{digest(6000 + i)}" was seen'))
        truth |= {5000 + i: False, 6000 + i: True}
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = {r.doc_id: r.found for r in privacy.find(df).collect()}
    right = sum(bool(got[k]) == want for k, want in truth.items())
    raw = {k: t for k, t in made}
    majority = 0
    for k, want in truth.items():
        data = np.frombuffer(raw[k].encode(), dtype=np.uint8)
        (_, _, _, votes, _), *_ = privacy.proposals(data, np.array([0, len(data)]))[0]
        each = [votes // 3**p % 3 for p in range(len(privacy.LABELERS))]
        majority += (each.count(privacy.YES) > each.count(privacy.NO)) == want
    assert right > majority and right >= 0.95 * len(truth)
    assert all(privacy.ACCEPT <= x.score <= 1 for r in got.values() for x in r if x.kind == privacy.KINDS.index("secret"))


def brute_addresses(text):
    out = []
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(m.span())
    return out


def test_addresses_in_runs_of_digits_and_dots():
    rng = random.Random(9)
    for _ in range(3000):
        run = "".join(rng.choice(["1", "25", "255", "256", "007", ".", ".", ".", "..", "0"]) for _ in range(rng.randrange(16)))
        assert list(privacy._addresses(run.encode())) == brute_addresses(run), run


def test_a_megabyte_of_digits_is_no_hazard():
    import time

    for text in ("3." + "1415926535" * 100_000, "1." * 500_000, "+1 " * 350_000, "12 " * 350_000, "a@" * 500_000, "x" * 1_000_000 + "1", "(" * 1_000_000):
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        began = time.perf_counter()
        privacy.proposals(data, np.array([0, len(data)]))
        assert time.perf_counter() - began < 10, text[:10]
