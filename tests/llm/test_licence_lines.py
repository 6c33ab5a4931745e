"""Licence expressions up to the end of their line."""

from curastra.llm import licences


def labels_of(spark, texts):
    rows = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {r.doc_id: (r.labels, r.score, r.permissive) for r in rows}


def test_long_expressions_are_read_to_the_end_of_the_line(spark):
    many = " AND ".join(["MIT"] * 3_000)
    got = labels_of(spark, [
        f"SPDX-License-Identifier: {many} AND GPL-2.0-only\nSPDX",
        f"SPDX-License-Identifier: ({many} OR Apache-2.0)",
        f"SPDX-License-Identifier: {'(' * 900}MIT OR ISC{')' * 900} AND MPL-2.0",
        f"SPDX-License-Identifier: {' ' * 390} Apache-2.0 AND BSD-3-Clause",
        f"SPDX-License-Identifier: {many}\n AND GPL-2.0-only",
    ])
    assert [got[i][0] for i in range(5)] == ["gpl,mit", "apache,mit", "isc,mit,mpl", "apache,bsd", "mit"]
    assert all(got[i][1] > 0.9 for i in range(5)) and [got[i][2] for i in (0, 1, 4)] == [False, True, True]


def test_prefixes_agree_with_parsing_each_of_them():
    import itertools

    for size in range(1, 6):
        for tokens in itertools.product(["MIT", "ISC", "AND", "WITH", "(", ")"], repeat=size):
            want = (set(), False)
            for k in range(size, 0, -1):
                try:
                    want = licences.evaluate(licences.postfix(list(tokens[:k])))
                    break
                except ValueError:
                    pass
            assert licences.read_expression(" ".join(tokens).encode(), True) == want
