"""Personal data by weak supervision.

Patterns propose spans. Labelers (form, gazetteer, words before, boundaries, shape) vote on each one or abstain; expectation
maximisation over the counts of vote patterns, gathered from the whole corpus, estimates how reliable each labeler is. A
logistic span classifier is then trained on the resulting posteriors. It sees features of its own (length, kinds and variety
of characters, the characters around the span and the word before it) and the gazetteer, not the other votes; its score
decides alone. So it can overrule labelers that err, and judges spans on which all of them abstain.

What reaches the driver is bounded: counts of vote patterns (kinds x 3 ** labelers) and sums of the classifier's size. No row
is left out of either.

Spans of the base kinds (email, ip, card, phone) are defined by their patterns and always stay. The classifier decides
on the further kinds: secret (keys and tokens), national_id and local_phone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, string_columns, summed, table
from .textkernel import blocks

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "national_id", "local_phone")
KINDS = BASE_KINDS + MORE_KINDS
ACCEPT = 0.5
CONTEXT_BYTES = 40
LABELERS = ("form", "gazetteer", "context", "boundary", "shape")
RIDGE = 0.1
#: Most of a kind's proposals that count as personal before any vote; weight of an ordinary labeler's chances in EM;
#: how often at least a labeler is right for each time that it is wrong.
PRIOR, PSEUDO = 0.4, 20.0
ODDS = dict(zip(LABELERS, (2.0, 4.0, 4.0, 2.0, 2.0)))
ABSTAIN, NO, YES = 0, 1, 2


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[np.frombuffer(chars, dtype=np.uint8)] = True
    return out


_DIGITS = b"0123456789"
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_DIGIT = _class(_DIGITS)
_ALNUM = _class(_DIGITS + _LETTERS)
_RUNS = {
    "email": _class(_DIGITS + _LETTERS + b"._%+-@"),
    "ip": _class(_DIGITS + b"."),
    "card": _class(_DIGITS + b" -"),
    "phone": _class(_DIGITS + b"+ ().-"),
    "secret": _class(_DIGITS + _LETTERS + b"_-+/"),
    "local_phone": _class(_DIGITS + b" ().-"),
}
_LOCAL = re.compile(rb"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_NATIONAL = re.compile(rb"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(rb"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")

_HINTS = {
    "email": re.compile(rb"(?i)e-?mail|contact|write to|mailto|correo|courriel"),
    "ip": re.compile(rb"(?i)\bip\b|host|server|address|login|ssh|ping"),
    "card": re.compile(rb"(?i)card|visa|credit|debit|payment|karte|carte|tarjeta"),
    "phone": re.compile(rb"(?i)phone|tel\b|tel[.:]|call|mobile|fax|contact|telefon"),
    "secret": re.compile(rb"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|credential|auth)\w*[\"']?\s*[=:]\s*[\"']?(?:(?:bearer|basic)\s+)?\Z"),
    "national_id": re.compile(rb"(?i)ssn|social security|national id|tax id|identity"),
    "local_phone": re.compile(rb"(?i)phone|tel\b|tel[.:]|call|mobile|fax|contact|telefon"),
}
#: A value after this is proposed as a secret whatever its length and digits; narrower than the hint, so that neither
#: "author:" nor "tokenizer:" proposes the word behind it.
_NAMED = re.compile(
    rb"(?i)(?:tokens?|secrets?|passw(?:or)?ds?|api[_ -]?keys?|access[_ -]?keys?|credentials?|auth(?:entication|ori[sz]ation)?)(?:[_-]\w*|(?-i:[A-Z0-9])\w*)?[\"']?[ \t]*[=:][ \t]*[\"']?(?:(?:bearer|basic)[ \t]+)?\Z"
)
_VALUE = re.compile(rb"(?i)[ \t]*[\"']?(?:(?:bearer|basic)[ \t]+)?")
_KEY = re.compile(rb"(?:sk|pk)[_-]|gh[opsu]_|github_pat_|glpat-|AKIA|ASIA|AIza|hf_|npm_|eyJ|xox[a-z]-")
_KEY_PAIRS = np.array([256 * a + b for a, b in (b"sk", b"pk", b"gh", b"gi", b"gl", b"AK", b"AS", b"AI", b"hf", b"np", b"ey", b"xo")])
_AGAINST = re.compile(rb"(?i)version|release|\bv\Z|section|chapter|isbn|figure|http|commit|sha|uuid")
# Gazetteers: public assignments of names and numbers.
_TOP_DOMAINS = set(
    b"com org net edu gov mil int info biz name io co ai dev app me tv cloud online site shop blog xyz de fr es uk eu it nl be at ch pt se no dk fi pl cz sk hu ro bg gr ie "
    b"lt lv ee si hr rs ua by ru tr il ae sa in pk bd cn jp kr tw hk sg my th vn id ph au nz za ng ke eg ma br ar cl mx pe ve ca us".split()
)
_ISSUERS = re.compile(rb"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[689])|35(?:2[89]|[3-8])|6(?:011|4[4-9]|5)|62|50|5[6-9]|6[37]")
_COUNTRIES = re.compile(rb"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-69][0-9]|3[578][0-9]|42[0-9]|5[09][0-9]|6[7-9][0-9]|8[0578][0-9]|9[679][0-9]")
_RESERVED = re.compile(rb"0\.|127\.|255\.|22[4-9]\.|23[0-9]\.|24[0-9]\.|25[0-5]\.|169\.254\.|192\.0\.2\.|198\.51\.100\.|203\.0\.113\.")
_AREA = re.compile(rb"[2-9](?:[02-8][0-9]|1[02-9])[2-9](?:[02-9][0-9]|1[02-9])")


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = c - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _only_digits(s: bytes) -> bytes:
    return bytes(c for c in s if 48 <= c <= 57)


def _runs(data: np.ndarray, at: np.ndarray, inside: np.ndarray, anchors: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, start, end) of the maximal runs of a character class, within one text, that hold an anchor."""
    if not len(anchors):
        return []
    text = np.searchsorted(at, anchors, side="right") - 1
    stops = np.flatnonzero(~inside[data])
    k = np.searchsorted(stops, anchors)
    padded = np.concatenate([[-1], stops, [len(data)]])
    start, end = np.maximum(padded[k] + 1, at[text]), np.minimum(padded[k + 1], at[text + 1])
    first = np.concatenate([[True], start[1:] != start[:-1]])
    return list(zip(text[first].tolist(), start[first].tolist(), end[first].tolist()))


def _emails(run: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost matches, in one pass over the @ signs."""
    done, p = 0, run.find(b"@")
    while p >= 0:
        start = max(done, run.rfind(b"@", 0, p) + 1)
        if p > start and (m := _DOMAIN.match(run, p + 1)):
            yield start, m.end()
            done = m.end()
        p = run.find(b"@", p + 1)


def _addresses(run: bytes) -> Iterator[tuple[int, int]]:
    """Leftmost matches of four dotted numbers in a run of digits and dots, those with all parts up to 255; linear."""
    parts, place, i = run.split(b"."), 0, 0
    while i + 3 < len(parts):
        four = parts[i : i + 4]
        if all(four):
            end = place + sum(map(len, four)) + 3
            if all(len(x.lstrip(b"0")) <= 3 and int(x.lstrip(b"0") or b"0") <= 255 for x in four):
                yield place, end
            place, i = end + 1, i + 4
        else:
            place, i = place + len(parts[i]) + 1, i + 1


def _sure(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bytes where a run starts that has the prefix of a known kind of key, or a name of secrets before it."""
    inside, raw = _RUNS["secret"][data], data.tobytes()
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    starts[heads] = inside[heads]
    starts = np.flatnonzero(starts)
    two = data[starts].astype(np.int64) * 256 + data[np.minimum(starts + 1, len(data) - 1)]
    out = [p for p in starts[np.isin(two, _KEY_PAIRS)].tolist() if _KEY.match(raw, p)]
    signs = np.flatnonzero((data == 0x3A) | (data == 0x3D))
    text = np.searchsorted(at, signs, side="right") - 1
    for p, lo, hi in zip(signs.tolist(), at[text].tolist(), at[text + 1].tolist()):
        a = _VALUE.match(raw, p + 1, hi).end()
        if a < hi and inside[a] and _NAMED.search(raw[max(lo, a - CONTEXT_BYTES) : a]):
            out.append(a)
    return np.array(sorted(set(out)), dtype=np.int64)


def _found(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(text, kind number, start byte, end byte) of all proposals; base kinds are those whose checks hold."""
    digit = _DIGIT[data]
    places = np.flatnonzero(digit)
    for t, a, b in _runs(data, at, _RUNS["email"], np.flatnonzero(data == 64)):
        for x, y in _emails(data[a:b].tobytes()):
            yield t, 0, a + x, a + y
    for t, a, b in _runs(data, at, _RUNS["secret"], _sure(data, at)):
        yield t, 4, a, b
    if not len(places):
        return
    dots = np.flatnonzero(data == 46)
    dots = dots[(dots > 0) & (dots + 1 < len(data))]
    dots = dots[digit[dots - 1] & digit[np.minimum(dots + 1, len(data) - 1)]]
    for t, a, b in _runs(data, at, _RUNS["ip"], dots):
        for x, y in _addresses(data[a:b].tobytes()):
            yield t, 1, a + x, a + y
    for t, a, b in _runs(data, at, _RUNS["card"], places):
        if b - a >= 11:
            run = data[a:b].tobytes()
            for m in _CARD.finditer(run):
                d = _only_digits(m.group())
                if 13 <= len(d) <= 19 and luhn(d):
                    yield t, 2, a + m.start(), a + m.end()
            for m in _NATIONAL.finditer(run):
                yield t, 5, a + m.start(), a + m.end()
    plus = np.flatnonzero(data == 43)
    for t, a, b in _runs(data, at, _RUNS["phone"], plus):
        for m in _PHONE.finditer(data[a:b].tobytes()):
            if 9 <= len(_only_digits(m.group())) <= 15:
                yield t, 3, a + m.start(), a + m.end()
    for t, a, b in _runs(data, at, _RUNS["local_phone"], places):
        if b - a >= 12:
            for m in _LOCAL_PHONE.finditer(data[a:b].tobytes()):
                x = a + m.start()
                if x == at[t] or (not _ALNUM[data[x - 1]] and data[x - 1] not in b"+-."):
                    yield t, 6, x, a + m.end()
    for t, a, b in _runs(data, at, _RUNS["secret"], places):
        if b - a >= 20 and 4 <= int(digit[a:b].sum()) < b - a:
            yield t, 4, a, b


def _votes(kind: int, span: bytes, before: bytes, left: bool, right: bool) -> int:
    """Votes of all labelers as one number, in base 3; left and right say whether the span stands free there."""
    digits = _only_digits(span) if kind != 4 else b""
    name = KINDS[kind]
    form = {
        "email": lambda: YES if span.find(b"@") <= 64 and span.rsplit(b".", 1)[-1].isalpha() and b".." not in span else NO,
        "ip": lambda: YES if len(span) >= 11 else ABSTAIN,
        "card": lambda: YES if len(digits) in (15, 16) else ABSTAIN,
        "phone": lambda: YES if 10 <= len(digits) <= 13 else ABSTAIN,
        "secret": lambda: YES if re.fullmatch(rb"[0-9a-f]{32,}|[0-9A-F]{32,}", span) else ABSTAIN,
        "national_id": lambda: NO if digits[3:5] == b"00" or digits[5:] == b"0000" else YES,
        "local_phone": lambda: YES if span.startswith(b"(") else ABSTAIN,
    }[name]()
    gazetteer = {
        "email": lambda: YES if span.rsplit(b".", 1)[-1].lower() in _TOP_DOMAINS else ABSTAIN,
        "ip": lambda: NO if _RESERVED.match(span) else ABSTAIN,
        "card": lambda: YES if _ISSUERS.match(digits) else NO,
        "phone": lambda: YES if _COUNTRIES.match(digits) else NO,
        "secret": lambda: YES if _KEY.match(span) else ABSTAIN,
        "national_id": lambda: NO if digits[:3] in (b"000", b"666") or digits[:1] == b"9" else YES,
        "local_phone": lambda: YES if _AREA.match(digits) else NO,
    }[name]()
    context = YES if _HINTS[name].search(before) else NO if _AGAINST.search(before) else ABSTAIN
    boundary = ABSTAIN if left and right else NO
    kinds_of_char = len(set(span))
    shape = NO if kinds_of_char < 4 else YES if name == "secret" and kinds_of_char >= 10 and context == YES else ABSTAIN
    code = 0
    for v in (form, gazetteer, context, boundary, shape):
        code = code * 3 + v
    return code


#: Votes that the classifier sees too: those of the gazetteer, which depend on the span alone.
SEEN = (LABELERS.index("gazetteer"),)
#: Features of a span and their numbers of values; value 0 of each is the one that weights are relative to.
FEATURES = (("length", 7), ("mix", 6), ("joined", 2), ("before", 4), ("after", 4), ("variety", 4), ("word", 32))
_LENGTHS = (12, 16, 20, 32, 40, 64)
_LAST_WORD = re.compile(rb"([A-Za-z\x80-\xff]+)[^A-Za-z\x80-\xff]*\Z")


def _traits(span: bytes, before: bytes, after: bytes) -> int:
    """FEATURES of a span as one number."""
    length = sum(len(span) >= n for n in _LENGTHS)
    plain = bytes(c for c in span if _ALNUM[c])
    upper, lower, digit = plain.upper() == plain, plain.lower() == plain, any(48 <= c <= 57 for c in plain)
    mixed = 0 if plain.isdigit() else (1 if lower else 2 if upper else 3) if digit else 4 if lower or upper else 5
    beside = lambda c, marks: 0 if not c or c.isspace() else 1 if c in b"\"'`" else 2 if c in marks else 3
    kinds_of_char = len(set(span))
    variety = (kinds_of_char >= 4) + (kinds_of_char >= 8) + (kinds_of_char >= 12)
    m = _LAST_WORD.search(before)
    word = 1 + zlib.crc32(m.group(1).lower()) % 31 if m else 0
    code = 0
    for (_, n), v in zip(FEATURES, (length, mixed, int(len(plain) < len(span)), beside(before[-1:], b":="), beside(after, b".,;:!?)"), variety, word)):
        code = code * n + v
    return code


def proposals(data: np.ndarray, at: np.ndarray) -> dict[int, list[tuple[int, int, int, int]]]:
    """Of each text with proposals: (kind, start, end, votes, traits), in code points, by kind and then start."""
    found = sorted(set(_found(data, at)))
    if not found:
        return {}
    points = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    out: dict[int, list] = {}
    for t, kind, a, b in found:
        lo, hi = int(at[t]), int(at[t + 1])
        span, before, after = data[a:b].tobytes(), data[max(lo, a - CONTEXT_BYTES) : a].tobytes(), data[b : min(hi, b + 1)].tobytes()
        votes = _votes(kind, span, before, a == lo or not _ALNUM[data[a - 1]], b == hi or not _ALNUM[data[b]])
        out.setdefault(t, []).append((kind, int(points[a] - points[lo]), int(points[b] - points[lo]), votes, _traits(span, before, after)))
    for t, spans in out.items():
        taken = [x[1:3] for x in spans if x[0] < len(BASE_KINDS)]
        out[t] = sorted(x for x in spans if x[0] < len(BASE_KINDS) or not any(s < x[2] and x[1] < e for s, e in taken))
    return out


_SPAN = "array<struct<kind:int,start:long,end:long,votes:int,traits:int>>"
_FIELDS = [("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("votes", pa.int32()), ("traits", pa.int32())]
_SPAN_TYPE = pa.list_(pa.struct(_FIELDS))


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, at in blocks(batch.column(1)):
            found = proposals(data, at)
            spans = [[dict(zip(("kind", "start", "end", "votes", "traits"), x)) for x in found.get(t, ())] for t in range(j - i)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(spans, _SPAN_TYPE)], names=["doc_id", "found"])


def reliabilities(counts: list[tuple[int, int, int]], rounds: int = 50) -> dict[tuple[int, int], float]:
    """Posterior of each (kind, votes) pattern, by EM over counts of patterns.

    Two hidden classes (personal or not), one prior per kind, and for every labeler the chances of its votes under either
    class. Labelers are taken to be right ODDS times as often as wrong at least, so that the classes can't swap or merge where
    a kind has no counter-examples; an abstention says nothing. The prior stays at PRIOR or below, so that no span is personal without a vote.
    Starts from votes taken at face value; PSEUDO votes of an ordinary labeler smooth the counts.
    """
    if not counts:
        return {}
    kind = np.array([k for k, _, _ in counts])
    code = np.array([c for _, c, _ in counts])
    weight = np.array([n for _, _, n in counts], dtype=float)
    votes = np.stack([code // 3 ** (len(LABELERS) - 1 - i) % 3 for i in range(len(LABELERS))], axis=1)
    post = np.clip(0.25 + 0.3 * (votes == YES).sum(axis=1) - 0.4 * (votes == NO).sum(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        prior = np.array([(1 + (weight * post)[kind == k].sum()) / (2 + weight[kind == k].sum()) for k in range(len(KINDS))])
        prior = np.minimum(prior, PRIOR)
        yes, no = np.log(prior)[kind], np.log(1 - prior)[kind]
        for i in range(len(LABELERS)):
            for v, (if_yes, if_no) in ((YES, (0.6, 0.1)), (NO, (0.05, 0.3))):
                at = votes[:, i] == v
                p = (PSEUDO * if_yes + (weight * post)[at].sum()) / (PSEUDO + (weight * post).sum())
                q = (PSEUDO * if_no + (weight * (1 - post))[at].sum()) / (PSEUDO + (weight * (1 - post)).sum())
                lean = np.log(p / q)
                least = np.log(ODDS[LABELERS[i]])
                yes = yes + at * (max(lean, least) if v == YES else min(lean, -least))
        new = 1 / (1 + np.exp(np.clip(no - yes, -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return {(int(k), int(c)): float(p) for k, c, p in zip(kind, code, post)}


def _features(kind: np.ndarray, code: np.ndarray, traits: np.ndarray) -> np.ndarray:
    cols = [np.ones(len(kind))] + [(kind == k).astype(float) for k in range(len(KINDS))]
    for at in SEEN:
        v = code // 3 ** (len(LABELERS) - 1 - at) % 3
        cols += [((v == vote) & (kind == k)).astype(float) for vote in (NO, YES) for k in range(len(KINDS))]
    for _, n in reversed(FEATURES):
        traits, v = np.divmod(traits, n)
        cols += [(v == k).astype(float) for k in range(1, n)]
    return np.stack(cols, axis=1)


_SIZE = 1 + len(KINDS) + 2 * len(SEEN) * len(KINDS) + sum(n - 1 for _, n in FEATURES)


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _slopes(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Gradient and Hessian of the weighted logistic loss, side by side."""
    p = _chance(x @ w)
    return np.column_stack([x.T @ (weight * (p - y)), (x * (weight * p * (1 - p))[:, None]).T @ x])


def _newton(slopes, rounds: int = 12) -> np.ndarray:
    """Weights of the ridge-damped logistic classifier; ``slopes`` gives the sums over all spans at given weights."""
    w = np.zeros(_SIZE)
    for _ in range(rounds):
        s = slopes(w)
        step = np.linalg.solve(s[:, 1:] + RIDGE * np.eye(_SIZE), s[:, 0] + RIDGE * w)
        w -= step
        if np.abs(step).max() < 1e-3:
            break
    return w


def train(counts: list[tuple[int, int, int]]) -> dict[tuple[int, int], float]:
    """Posterior of each (kind, votes) pattern of labelers as ``reliabilities`` gives it."""
    return reliabilities(counts)


def fit(found: DataFrame) -> np.ndarray | None:
    """Weights of the span classifier: EM over vote patterns, then Newton steps over (kind, votes, traits) patterns, each
    weighted by the logarithm of its count; sums are made where the patterns are. None without any proposal."""
    scratch = Scratch(found.sparkSession)
    patterns = scratch.cut(found.select(F.explode("found").alias("x")).groupBy("x.kind", "x.votes", "x.traits").count())
    rows = patterns.groupBy("kind", "votes").agg(F.sum("count").alias("n")).orderBy("kind", "votes").collect()
    if not rows:
        return None
    post = reliabilities([(r["kind"], r["votes"], r["n"]) for r in rows])

    def slopes(w: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for i in range(0, batch.num_rows, 8192):
                    kind, code, traits, n = (c.to_numpy() for c in batch.slice(i, 8192).columns)
                    y = np.array([post[k, c] for k, c in zip(kind.tolist(), code.tolist())])
                    part = _slopes(_features(kind, code, traits), y, np.log1p(n), w)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

        return summed(patterns.mapInArrow(run, "sums binary"), np.float64).reshape(_SIZE, _SIZE + 1)

    return _newton(slopes)


def scores(w: np.ndarray, kind: np.ndarray, votes: np.ndarray, traits: np.ndarray) -> np.ndarray:
    return _chance(_features(kind, votes, traits) @ w)


_FOUND = "array<struct<kind:int,start:long,end:long,votes:int,traits:int,score:double>>"


def _judged(w: np.ndarray | None):
    """Rows (doc_id, proposals) to (doc_id, spans that stay, with their scores)."""
    kind_of = pa.list_(pa.struct([*_FIELDS, ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            if not len(flat):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[]] * batch.num_rows, kind_of)], names=["doc_id", "found"])
                continue
            fields = [flat.field(i) for i in range(len(_FIELDS))]
            kind, votes, traits = (fields[i].to_numpy() for i in (0, 3, 4))
            s = scores(w, kind, votes, traits)
            keep = (kind < len(BASE_KINDS)) | (s >= ACCEPT)
            sizes = np.diff(lists.offsets.to_numpy())
            text = np.repeat(np.arange(len(lists)), sizes)
            at = np.concatenate([[0], np.cumsum(np.bincount(text[keep], minlength=len(lists)))]).astype(np.int32)
            spans = pa.StructArray.from_arrays([*[f.filter(pa.array(keep)) for f in fields], pa.array(s[keep])], fields=list(kind_of.value_type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(at), spans)], names=["doc_id", "found"])

    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and found of every row: an array of (kind number, start, end, votes, traits, score).

    score is the classifier's; it decides on spans beyond the base kinds. A null or empty text has no spans. Repeated rows
    get equal results; other columns are not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    docs = string_columns(docs, doc_id=id_col, text=text_col).withColumn("text", F.col("text").cast("string"))
    id_type = docs.select("doc_id").schema.simpleString()[7:-1].replace("doc_id:", "doc_id ")
    found = scratch.cut(docs.mapInArrow(_propose, f"{id_type}, found {_SPAN}"))
    return found.mapInArrow(_judged(fit(found)), f"{id_type}, found {_FOUND}")


def _joined(col):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(col, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["kind"] < len(BASE_KINDS))
    of_kind = lambda k: F.filter("found", lambda x: x["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))


def _redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, done = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start < done:
            done = max(done, end)
            continue
        out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The columns of ``docs`` with every span in the text replaced by its kind in brackets; ``length_col``, if it is
    there, is counted anew for texts that changed. All rows stay, null texts too."""
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.lit(0).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = scratch.cut(texts.mapInArrow(_propose, f"doc_id long, found {_SPAN}").where("size(found) > 0"))
    w = fit(found)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_text = names.index(text_col)
        at_length = names.index(length_col) if length_col in names else None
        for batch in batches:
            cols = list(batch.columns)
            for i, j, data, at in blocks(cols[at_text]):
                out = [c.slice(i, j - i) for c in cols]
                found = {}
                for t, spans in proposals(data, at).items():
                    s = scores(w, *(np.array([x[i] for x in spans]) for i in (0, 3, 4)))
                    found[t] = [x[:3] for x, p in zip(spans, s.tolist()) if x[0] < len(BASE_KINDS) or p >= ACCEPT]
                if any(found.values()):
                    values = out[at_text].to_pylist()
                    lengths = out[at_length].to_pylist() if at_length is not None else None
                    for t, spans in found.items():
                        if spans:
                            values[t] = _redacted(values[t], spans)
                            if lengths is not None and lengths[t] is not None:
                                lengths[t] = len(values[t])
                    out[at_text] = pa.array(values, cols[at_text].type)
                    if lengths is not None:
                        out[at_length] = pa.array(lengths, cols[at_length].type)
                yield pa.RecordBatch.from_arrays(out, names=names)

    return docs.mapInArrow(run, docs.schema)
