"""Near-dedup, licence scan, personal data and quality rules against plain brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

pytest.importorskip("curastra.llm")
from curastra.llm import licences, minhash, privacy, rules  # noqa: E402

DOC = "doc_id long, text string, source string, spare string"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
ODD = [
    (1, None, "a", "x"), (2, "", "a", None), (3, " \n\t ", None, "x"), (4, "one", "a", "x"), (5, "One", "b", "x"), (6, "one two", "b", "x"),
    (7, LONG, "a", "x"), (8, LONG, "a", "x"), (8, LONG, "a", "x"), (9, "naïve café x\u0085y über mail a.b@c.de, 10.0.0.1", "a", "x"), (None, "one", "a", "x"),
]


def rows_of(df):
    return {r[0]: r for r in df.collect()}


def odd(spark):
    # extra columns whose names the operators use themselves
    return spark.createDataFrame(ODD, DOC).selectExpr("*", "1 AS n", "2 AS p", "3 AS host", "4 AS kept", "5 AS lines")


def texts(spark, sf_dir):
    return {r[0]: r[1] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def shingles(text, n):
    w = SPACE.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute_components(docs, n, num, den):
    sets = {k: shingles(t, n) for k, t in docs.items()}
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            if x and y and den * min(len(x), len(y)) >= num * max(len(x), len(y)):
                both = len(x & y)
                if den * both >= num * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {k: (len(sets[k]), find(k)) for k in docs}


def noisy_group(rng, n, edits, base_words=150):
    base = [f"b{rng.randrange(10**6)}" for _ in range(base_words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_near_dedup_on_the_table(spark, sf_dir):
    got = rows_of(minhash.query(spark, sf_dir))
    want = brute_components(texts(spark, sf_dir), 3, 85, 100)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (k == r.component_id) for k, r in got.items())


@pytest.mark.parametrize(("words", "num"), [(3, 85), (5, 80)])
def test_near_dedup_of_noisy_groups(spark, words, num):
    rng = random.Random(5)
    made = noisy_group(rng, 700, 14) + noisy_group(rng, 60, 40) + noisy_group(rng, 30, 6, 20) + ["same text here and there"] * 40
    docs = dict(enumerate(made))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = rows_of(minhash.near_duplicates(df, words=words, num=num))
    want = brute_components(docs, words, num, 100)
    assert {k: (r.n_shingles, r.component_id) for k, r in got.items()} == want


def test_near_dedup_of_odd_rows(spark):
    out = minhash.near_duplicates(odd(spark)).collect()
    assert len(out) == len(ODD)
    by = {r.doc_id: r for r in out}
    assert [by[i].n_shingles for i in (1, 2, 3, 4, 6)] == [0, 0, 0, 1, 1]
    assert by[5].component_id == 4 and not by[5].kept and by[None].component_id == 4 and not by[None].kept
    assert by[8].component_id == 7 and by[2].component_id == 2 and by[2].kept
    assert minhash.near_duplicates(odd(spark).limit(0)).collect() == []
    named = odd(spark).selectExpr("*", "1 AS _lost_id", "2 AS _twice_id", "3 AS id", "4 AS count")
    kept = minhash.keep_one(named)
    assert kept.columns == named.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 9]


def brute_licences(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licences_against_brute_force(spark, sf_dir):
    made = {
        10**6: "MIT-License mit license, xmit license mit licenses CC-BY cc\nby", 10**6 + 1: "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0",
        10**6 + 2: "mit", 10**6 + 3: "license mit license", 10**6 + 4: "Licensed under the MIT OR ISC; no more", 10**6 + 5: "// SPDX-License-Identifier: BSD-3-Clause\nMIT",
    }
    docs = texts(spark, sf_dir) | made | {r[0] or 0: r[1] for r in ODD if r[0] != 8}
    got = rows_of(licences.scan(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive"))
    assert {k: tuple(r)[1:6] for k, r in got.items()} == {k: brute_licences(t) for k, t in docs.items()}
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got.values())
    assert got[10**6 + 1].labels == "apache,gpl,mit" and got[10**6 + 1].permissive is False
    assert got[10**6 + 4].labels == "isc,mit" or got[10**6 + 4].labels == ""
    assert got[10**6 + 5].labels == "bsd" and got[10**6 + 5].permissive
    assert licences.scan(odd(spark)).count() == len(ODD) and licences.scan(odd(spark).limit(0)).count() == 0


def test_licence_expressions():
    read = lambda s: licences.evaluate(licences.postfix(re.findall(r"[\w.+-]+|[()]", s)))
    assert read("MIT OR GPL-3.0-only") == ({"mit", "gpl"}, True)
    assert read("MIT AND GPL-3.0-only") == ({"mit", "gpl"}, False)
    assert read("GPL-2.0 AND MIT OR ISC") == ({"gpl", "mit", "isc"}, True)
    assert read("GPL-2.0 AND (MIT OR ISC)") == ({"gpl", "mit", "isc"}, False)
    assert read("Apache-2.0 WITH LLVM-exception") == ({"apache"}, True)
    for bad in ("MIT OR", "AND MIT", "(MIT", "MIT)", "MIT ISC", "()", ""):
        with pytest.raises(ValueError):
            read(bad)
    assert [licences.family(x) for x in ("CC-BY-4.0", "cc-by-nc-4.0", "LGPL-2.1+", "mitx", "Apache-2.0")] == ["cc-by", "cc-by-nc", "lgpl", None, "apache"]


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for kind, pattern in BASE_PATTERNS.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub(r"\D", "", m.group())
            ok = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and privacy.luhn(digits.encode()), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_against_brute_force(spark, sf_dir):
    rng = random.Random(3)
    cards = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111 1111 1111", "5500005555555559"]
    bits = ["a@b.co", "a@b@c.de.", "é.x@y-z.org.", "x@y", "1.2.3.4.5", "256.1.1.1", "001.002.003.004", "10.0.0.1", *cards, "+1 (555) 123-4567", "+44 20 7946 0958.", "+12", "+", "@", ".", "-", " ", "\n", "é", "9" * 14, "token = \"", "0af3" * 9, '"', "ssn 123-45-6789 ", "call (555) 222-3333 "]
    made = {10**6 + i: "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14))) for i in range(400)}
    docs = texts(spark, sf_dir) | made | {r[0] or 0: r[1] for r in ODD if r[0] != 8}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    df.write.mode("overwrite").parquet(d := f"{minhash.Scratch(spark).root}/in/documents.parquet")
    got = rows_of(privacy.query(spark, d.rpartition("/")[0]))
    for k, t in docs.items():
        want = brute_spans(t)
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(f"{kind}:") for x in want) for kind in BASE_PATTERNS], (k, t)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (k, t)
        assert [x for x in r.spans.split(",") if x.split(":")[0] in BASE_PATTERNS] == want


def test_pii_further_kinds(spark):
    made = [(i, f'Then we set token = "{hashlib.md5(str(i).encode()).hexdigest()}" and went on, page {i}.') for i in range(30)]
    made += [(100 + i, f"Mail to some{i}@mail.example.com now") for i in range(30)] + [(200 + i, f"see commit {hashlib.sha1(str(i).encode()).hexdigest()[:25]}x of v1.2.3 there") for i in range(30)]
    made += [(300 + i, f"my SSN is {200 + i}-12-{3000 + i}.") for i in range(20)]
    got = rows_of(privacy.find(spark.createDataFrame(made, "doc_id long, text string")))
    kinds = {k: {privacy.KINDS[x.kind] for x in r.found} for k, r in got.items()}
    assert all(kinds[i] == {"secret"} for i in range(30)) and all(kinds[100 + i] == {"email"} for i in range(30))
    assert all(not kinds[200 + i] for i in range(30)) and all(kinds[300 + i] == {"national_id"} for i in range(20))


def test_pii_redaction(spark):
    out = privacy.redact(odd(spark).withColumn("n_chars", __import__("pyspark").sql.functions.length("text").cast("long")))
    rows = rows_of(out)
    assert out.columns == [*odd(spark).columns, "n_chars"] and out.count() == len(ODD)
    assert rows[9].text.endswith("mail [EMAIL], [IP]") and rows[9].n_chars == len(rows[9].text) and rows[1].text is None
    assert privacy.find(odd(spark).limit(0)).count() == 0


def test_em_finds_reliable_labelers():
    rng, n = random.Random(1), Counter()
    for _ in range(4000):
        true = rng.random() < 0.4
        code = 0
        for accuracy in (0.95, 0.9, 0.9, 0.55, 0.55):
            yes = true if rng.random() < accuracy else not true
            code = code * 3 + (privacy.YES if yes else privacy.NO)
        n[(4, code)] += 1
    scores = privacy.train([(k, c, v) for (k, c), v in n.items()])
    all_yes, all_no = sum(2 * 3**i for i in range(5)), sum(3**i for i in range(5))
    assert scores[4, all_yes] > 0.9 and scores[4, all_no] < 0.1
    assert privacy.train([]) == {}


def brute_rules(text):
    w = SPACE.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), len(w) < 10 or 100 * len(covered) > 20 * len(w)


def test_rules_against_brute_force(spark, sf_dir):
    rng = random.Random(2)
    made = {10**6 + i: "".join(rng.choice(["a", "b ", "é ", "c\n", "\n", "#", "a b c d e\n", " "]) for _ in range(rng.randrange(60))) for i in range(300)}
    docs = texts(spark, sf_dir) | made | {r[0] or 0: r[1] for r in ODD if r[0] != 8}
    df = spark.createDataFrame([(k, t, "s") for k, t in docs.items()], "doc_id long, text string, source string")
    got = rows_of(rules.judge(df))
    assert {k: tuple(r)[1:7] for k, r in got.items()} == {k: brute_rules(t) for k, t in docs.items()}
    assert not any(r.base_failed and r.kept for r in got.values())


def test_common_lines(spark):
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(40))
    menu = "Home   About Contact Imprint and Terms of this one place on the wide web for you and me "
    data = [(i, menu if i % 2 else f"{menu}\n{own(i)}", "h1") for i in range(100)] + [(1000 + i, f"{own(1000 + i)}\n{menu.upper()}", f"g{i}") for i in range(50)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = rows_of(rules.judge(df))
    kept = {k for k, r in got.items() if r.kept}
    assert kept == {i for i in range(0, 100, 2)} | {1000 + i for i in range(50)}  # a page of nothing but the menu goes
    assert got[0].n_lost_words == 0 and got[2].n_lost_words == 18
    cleaned = rows_of(rules.clean(df))
    assert cleaned[2].text == own(2) and cleaned[0].text == data[0][1] and cleaned[1003].text == data[103][1] and set(cleaned) == kept
    out = rules.judge(odd(spark))
    assert out.count() == len(ODD) and rules.judge(odd(spark).limit(0)).count() == 0
