"""All N best paths in the result of the query, against brute force."""

import pytest

from curastra.llm import pieces

from .test_models import applied, brute_n_best

TEXTS = ["Hello world", "The cat sat\n on  the mat.", "naïve über façade", "▁odd ▁▁", "日本語 text", "a", "x" * 70, "\x00\x01", "", None]


def spelled(v, text):
    """(worth, ids) of the four best paths."""
    if not text:
        return [(0.0, ())]
    codes = [pieces.SPACE, *[pieces.LITERAL if c == "▁" else pieces.SPACE if c == " " else ord(c) for c in text]]
    return brute_n_best(v, codes, 4)


def test_query_returns_the_paths_of_brute_force(spark, tmp_path):
    v = pieces.Vocabulary.load(pieces.default_model())
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = pieces.query(spark, str(tmp_path)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        want = spelled(v, TEXTS[r.doc_id])
        got = [(x.score, tuple(applied(list(r.ids), x.edits))) for x in r.n_best]
        assert [s for s, _ in got] == pytest.approx([s for s, _ in want])
        assert got[0][1] == tuple(r.ids) and len({p for _, p in got}) == len(got)
        # paths of one score may stand in any order, and those that tie with the last may be others
        last = want[-1][0]
        inner = lambda paths: {p for s, p in paths if s > last + 1e-6}
        assert inner(got) == inner(want)
        if len({round(s, 6) for s, _ in want}) == len(want) < 4:
            assert {p for _, p in got} == {p for _, p in want}
        byte = set(v.byte_id.tolist())
        for s, path in got:
            if not byte & set(path):
                assert sum(v.scores[i] for i in path) == pytest.approx(s)
