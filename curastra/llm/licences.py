"""Licence scan: one Aho-Corasick pass finds identifier tags and notice phrases; tagged expressions are parsed.

A whole block of texts becomes one string of words separated by single spaces (a line feed after the last word of a
text), so that the automaton makes one pass and a phrase never spans two texts. Hits count at word boundaries. After an
SPDX tag, or after "licensed under", an expression of licence identifiers with AND, OR, WITH and parentheses is read from
the original line by a shunting-yard parser and evaluated. After the tag and a colon, an identifier of no known family is
an operand like others and a label of its own; in prose only known ones are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import string_columns, table
from .textkernel import LOWER, blocks, split_words

BREAKS = np.ones(256, dtype=bool)
BREAKS[0x30:0x3A] = False
BREAKS[0x61:0x7B] = False
BREAKS[0x41:0x5B] = False  # lower-cased before the split
BREAKS[0x80:] = False
_LOWER_BREAKS = BREAKS.copy()
_LOWER_BREAKS[0x41:0x5B] = True

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Phrases of the method itself, with the weight of each as evidence.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd",
    "isc license": "isc",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution": "cc-by",
    "all rights reserved": "proprietary",
}
TAG, UNDER = "spdx license identifier", "licensed under"
#: Families of licence identifiers, by how an identifier begins.
FAMILIES = {
    "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "apache": "apache", "mit": "mit", "bsd": "bsd", "mpl": "mpl", "epl": "epl", "isc": "isc", "cc0": "cc0",
    "cc-by-nc": "cc-by-nc", "cc-by-sa": "cc-by-sa", "cc-by-nd": "cc-by-nd", "cc-by": "cc-by", "bsl": "bsl", "unlicense": "unlicense", "zlib": "zlib",
}
PERMISSIVE = {"apache", "mit", "bsd", "isc", "cc0", "cc-by", "bsl", "unlicense", "zlib"}
WEIGHT = {"tag": 0.99, "base": 0.9, "more": 0.8}
_TOKEN = re.compile(rb"(?:DocumentRef-[A-Za-z0-9.-]+:)?[A-Za-z0-9.+-]+|[()]")
_LEAD = re.compile(rb"[\"' :]*")
#: What may stand between "licensed under" and the licence.
_FILLER = re.compile(rb"(?i)[\"' :\t]*(?:(?:the|a|an|either|both|terms|conditions|and|of|following|licen[cs]es?)\b[\"' :\t]*)*")
#: Values of a tag that name no licence.
_NO_LICENCE = {"none", "noassertion"}


def family(name: str) -> str | None:
    """The family of a licence identifier, or None if it isn't a known one."""
    name = name.lower().strip(".+")
    for f in sorted(FAMILIES, key=len, reverse=True):
        if name == f or name.startswith(f + "-") and f != "cc-by" or f == "cc-by" and re.fullmatch(r"cc-by(-[0-9.]+)?", name):
            return FAMILIES[f]
    return None


def postfix(tokens: list[str]) -> list[tuple[str, str]]:
    """Shunting-yard: (kind, value) in postfix order; WITH binds closest, then AND, then OR. ValueError if malformed."""
    rank = {"or": 1, "and": 2, "with": 3}
    out: list[tuple[str, str]] = []
    stack: list[str] = []
    operand = False
    for t in tokens:
        low = t.lower()
        if low in rank:
            if not operand:
                raise ValueError("operator without operand")
            while stack and stack[-1] != "(" and rank[stack[-1]] >= rank[low]:
                out.append(("op", stack.pop()))
            stack.append(low)
            operand = False
        elif t == "(":
            if operand:
                raise ValueError("operand before (")
            stack.append(t)
        elif t == ")":
            if not operand:
                raise ValueError("empty parentheses")
            while stack and stack[-1] != "(":
                out.append(("op", stack.pop()))
            if not stack:
                raise ValueError("unbalanced )")
            stack.pop()
        else:
            if operand:
                raise ValueError("two operands")
            out.append(("id", t))
            operand = True
    if not operand or "(" in stack:
        raise ValueError("unfinished expression")
    return out + [("op", x) for x in reversed(stack)]


def evaluate(expression: list[tuple[str, str]], allowed: set[str] = PERMISSIVE) -> tuple[set[str], bool]:
    """Families (of unknown identifiers the identifier) named by a postfix expression, and whether its terms allow use
    under ``allowed`` alone."""
    stack: list[tuple[set[str], bool, bool]] = []
    for kind, value in expression:
        if kind == "id":
            f = family(value)
            stack.append(({f or value.lower()}, f in allowed, f is not None))
            continue
        right, left = stack.pop(), stack.pop()
        if value == "with":  # an exception only widens what the licence allows
            stack.append((left[0], left[1], left[2]))
            continue
        more, less = sorted((left[0], right[0]), key=len, reverse=True)
        more |= less
        stack.append((more, left[1] and right[1] if value == "and" else left[1] or right[1], left[2] and right[2]))
    return stack[0][0], stack[0][1]


def read_expression(line: bytes, known_only: bool, at: int = 0, end: int | None = None) -> tuple[set[str], bool]:
    """The longest well-formed expression that starts line[at:end]; with ``known_only``, of known identifiers alone.

    Otherwise an unknown word is an operand too, but not after an operator in lower case if it is a lower-case word, as in
    prose ("MIT and then"). One pass: reading stops where no longer prefix can be well-formed.
    """
    tokens: list[str] = []
    whole, depth, operand, last = 0, 0, False, at
    for m in _TOKEN.finditer(line, at, len(line) if end is None else end):
        t = m.group().decode("ascii").rstrip(".") or "."
        low = t.lower()
        if line[last : m.start()].strip(b" \t:\"'*/"):
            break  # something else stands between
        if low in ("and", "or", "with"):
            if not operand:
                break
            operand = False
        elif t == "(":
            if operand:
                break
            depth += 1
        elif t == ")":
            if not operand or not depth:
                break
            depth -= 1
        else:
            if operand or low in _NO_LICENCE or not any(c.isalnum() for c in t):
                break
            previous = tokens[-1] if tokens else ""
            prose = previous in ("and", "or") and t.isalpha() and t.islower()
            if (known_only or prose) and previous.lower() != "with" and not family(t):
                break
            operand = True
        tokens.append(t)
        last = m.end()
        if operand and not depth:
            whole = len(tokens)
    return evaluate(postfix(tokens[:whole])) if whole else (set(), False)


_machine: list = []


def machine() -> ahocorasick.Automaton:
    if not _machine:
        a = ahocorasick.Automaton()
        for kind, phrases in (("base", BASE), ("more", MORE), ("tag", {TAG: "", UNDER: ""})):
            for phrase, label in phrases.items():
                a.add_word(phrase, (kind, phrase, label))
        a.make_automaton()
        _machine.append(a)
    return _machine[0]


def scan_block(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, dict[int, list[tuple[str, str, str, int, int]]]]:
    """Words of each text, and of each text with hits: (kind, phrase, label, first word, end byte of the last word)."""
    w = split_words(data, at, BREAKS)
    counts = np.diff(w.first)
    if not len(w.start):
        return counts, {}
    lengths = w.end - w.start
    keep = ~BREAKS[data]
    places = np.concatenate([[0], np.cumsum(lengths + 1)])
    line = np.full(int(places[-1]), 0x20, dtype=np.uint8)
    line[np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)] = LOWER[data[keep]]
    last = w.first[1:][counts > 0] - 1
    line[places[last + 1] - 1] = 0x0A
    text = line.tobytes().decode("latin-1")
    hits: dict[int, list] = {}
    for end, (kind, phrase, label) in machine().iter(text):
        a = end + 1 - len(phrase)
        if (a and text[a - 1] not in " \n") or text[end + 1] not in " \n":
            continue
        k = int(np.searchsorted(places, a, side="right")) - 1
        t = int(np.searchsorted(w.first, k, side="right")) - 1
        n = phrase.count(" ") + 1
        hits.setdefault(t, []).append((kind, phrase, label, k - int(w.first[t]), int(w.end[k + n - 1])))
    return counts, hits


_OUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, permissive boolean"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(x.split()[0] for x in _OUT.split(", "))]
    for batch in batches:
        for i, j, data, at in blocks(batch.column(1)):
            counts, hits = scan_block(data, at)
            raw = data.tobytes() if hits else b""
            rows = {n: [] for n in names[1:]}
            for t in range(j - i):
                base, labels, starts, doubt, terms = set(), set(), [], 1.0, []
                for kind, phrase, label, k, end in hits.get(t, ()):
                    if kind == "base":
                        base.add(label)
                        starts.append(k)
                        doubt *= 1 - WEIGHT["base"]
                    elif kind == "more":
                        labels.add(label)
                        doubt *= 1 - WEIGHT["more"]
                    else:
                        stop = raw.find(b"\n", end, int(at[t + 1]))
                        stop = int(at[t + 1]) if stop < 0 else stop
                        lead = (_FILLER if phrase == UNDER else _LEAD).match(raw, end, stop)
                        found, allowed = read_expression(raw, phrase == UNDER or b":" not in lead.group(), lead.end(), stop)
                        if found:
                            labels |= found
                            terms.append(allowed)
                            doubt *= 1 - WEIGHT["tag"]
                labels |= base
                rows["n_base"].append(len(starts))
                rows["first_word"].append(min(starts) if starts else None)
                rows["last_word"].append(max(starts) if starts else None)
                rows["base_labels"].append(",".join(sorted(base)))
                rows["labels"].append(",".join(sorted(labels)))
                rows["score"].append(1 - doubt)
                rows["permissive"].append(all(terms) and labels <= PERMISSIVE if labels else None)
            kinds = {"score": pa.float64(), "permissive": pa.bool_(), "base_labels": pa.string(), "labels": pa.string()}
            cols = [pa.array(counts) if n == "n_words" else pa.array(rows[n], kinds.get(n, pa.int64())) for n in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *cols], names=names)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the licence findings of every row.

    Words are runs outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. n_base counts the places of base
    phrases, which may overlap; first_word and last_word are their smallest and largest first word, from 0. labels also
    has what the method finds: further phrases, and families or unknown identifiers named by licence expressions. score is the chance that the
    text carries a licence, of independent evidence: 0 without any. permissive is null without labels. A null text is
    an empty one; repeated rows get equal results; other columns are not read; an empty table gives an empty result.
    """
    docs = string_columns(docs, doc_id=id_col, text=text_col)
    docs = docs.withColumn("text", docs.text.cast("string"))
    return docs.mapInArrow(_scan, docs.select("doc_id").schema.simpleString()[7:-1].replace("doc_id:", "doc_id ") + ", " + _OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
