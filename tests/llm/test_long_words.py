"""Long texts without a blank: the flat kernel gives what the other gives, in bounded time."""

import random
import string
import time

import numpy as np
import pytest

pytest.importorskip("curastra.llm")
from curastra.llm import pieces  # noqa: E402

from .test_models import applied, brute_n_best  # noqa: E402


@pytest.fixture(scope="module")
def v():
    return pieces.Vocabulary.load(pieces.default_model())


def encoded(v, text, n=4):
    raw = text.encode()
    ids, at, found = pieces.encode_block(v, np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), n, {})
    back, _ = pieces.decode_ids(v, ids, at)
    assert back.tobytes() == raw
    return ids.tolist(), found[0]


def test_one_long_segment_equals_the_other_kernel(v):
    rng = random.Random(2)
    for alphabet in ("ab", "aé日", string.ascii_letters + string.digits, "the"):
        codes = np.array([ord(rng.choice(alphabet)) for _ in range(300)])
        n = len(codes)
        want = [np.zeros(0, np.int64)], np.zeros(1), np.full(1, np.inf)
        pieces._paths_of(v, codes, np.array([0]), np.array([n]), np.array([0]), want[1], want[2], want[0])
        ids, best, loss = pieces._path_of(v, codes)
        assert ids.tolist() == want[0][0].tolist() and best == want[1][0] and loss == want[2][0]


def test_paths_of_unbroken_texts_against_brute_force(v):
    rng = random.Random(3)
    for text in ["a" * 90, "ab" * 60, "".join(rng.choice(string.ascii_letters + "+/") for _ in range(150)), "the" * 40 + "é" * 20]:
        ids, found = encoded(v, text)
        want = brute_n_best(v, [pieces.SPACE, *map(ord, text)], 4)
        assert [s for s, _ in found] == pytest.approx([s for s, _ in want])
        paths = {tuple(applied(ids, e)) for _, e in found}
        assert len(paths) == len(found) and tuple(ids) in paths


def test_a_megabyte_without_a_blank(v):
    rng = random.Random(4)
    chars = string.ascii_letters + string.digits + "+/"
    for text in ("".join(rng.choices(chars, k=1_000_000)), "a" * 1_000_000, "3." + "1415926535" * 100_000):
        began = time.perf_counter()
        ids, found = encoded(v, text)
        assert time.perf_counter() - began < 10, text[:8]
        # no piece holds two digits, so that they have one path
        assert len(found) == (1 if text[0] == "3" else 4) and all(a[0] >= b[0] for a, b in zip(found[:-1], found[1:]))
