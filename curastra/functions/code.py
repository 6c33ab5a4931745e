"""Code answers: blocks, safety scan, test logs, token counts."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType

from .text import all_matches, col, filled, strip

# Patterns that block a solution, and patterns that only warn.
BANNED = (
    r"\bos\.system\s*\(", r"\bsubprocess\s*\.", r"\bos\.popen\s*\(", r"\bos\.execv\s*\(", r"\bos\.spawn", r"\beval\s*\(", r"\bexec\s*\(", r"\bcompile\s*\(",
    r"__import__\s*\(", r"\bsocket\s*\.", r"\burllib\s*\.", r"\brequests\s*\.", r"\bopen\s*\(.*['\"]w['\"]", r"\bshutil\.rmtree\s*\(", r"\bos\.remove\s*\(",
    r"\bos\.unlink\s*\(", r"shell\s*=\s*True", r"\bimport\s+ctypes\b", r"\bimport\s+pickle\b",
)
WARNINGS = (r"\bimport\s+sys\b", r"\bimport\s+os\b", r"\bgetattr\s*\(", r"\bsetattr\s*\(")
# Lines of a test runner's log, and marks of solution and test blocks.
PASSED, FAILED, ERRORS, SECONDS = r"(\d+) passed", r"(\d+) failed", r"(\d+) error", r"in\s+([\d.]+)s"
FAILED_TEST = r"FAILED\s+test_solution\.py::(test_\w+)"
SOLUTION_BLOCK = r"(?is)<\|Solution Begin\|>(.*?)<\|Solution End\|>"
TEST_BLOCK = r"(?is)<\|Test Begin\|>(.*?)<\|Test End\|>"


def _matching(c: Column, patterns: tuple[str, ...]) -> Column:
    hits = [F.when(c.rlike("(?md)" + p), F.lit(i)) for i, p in enumerate(patterns)]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def violations(c: Column | str) -> Column:
    """Numbers (from 0) of the banned patterns that match."""
    return _matching(F.coalesce(col(c), F.lit("")), BANNED)


def warnings(c: Column | str) -> Column:
    return _matching(F.coalesce(col(c), F.lit("")), WARNINGS)


def safe(c: Column | str) -> Column:
    """One pass over all banned patterns."""
    return ~F.coalesce(col(c), F.lit("")).rlike("(?md)" + "|".join(f"(?:{p})" for p in BANNED))


@F.pandas_udf(BooleanType())
def syntax_valid(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def ok(code: str | None) -> bool:
        try:
            ast.parse(code or "")
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return False
        return True

    for part in parts:
        yield part.map(ok)


def test_log(c: Column | str) -> Column:
    """passed, failed (else errors), seconds and first failed test of a test runner's log."""
    c = F.coalesce(col(c), F.lit(""))
    number = lambda p: filled(F.regexp_extract(c, p, 1)).try_cast("int")
    return F.struct(
        F.coalesce(number(PASSED), F.lit(0)).alias("tests_passed"),
        F.coalesce(number(FAILED), number(ERRORS), F.lit(0)).alias("tests_failed"),
        filled(F.regexp_extract(c, SECONDS, 1)).try_cast("double").alias("seconds"),
        filled(F.regexp_extract(c, FAILED_TEST, 1)).alias("failed_test"),
    )


def log_tail(c: Column | str, n: int = 5) -> Column:
    rows = F.split(F.coalesce(col(c), F.lit("")), "\n")
    return F.when(F.size(rows) > n, F.slice(rows, -n, n)).otherwise(rows)


def _unfenced(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(strip(c), r"^```python\s*", ""), r"```\s*$", ""))


def code_blocks(c: Column | str) -> tuple[Column, Column]:
    """(solution, tests): tagged blocks without fences if both are there, else first and last fenced block."""
    c = col(c)
    sol, test = SOLUTION_BLOCK, TEST_BLOCK
    tagged = c.rlike(sol) & c.rlike(test)
    fenced = all_matches(c, r"(?is)```python(.*?)```")
    solution = F.when(tagged, _unfenced(F.regexp_extract(c, sol, 1))).when(F.size(fenced) > 0, strip(F.get(fenced, F.lit(0)))).otherwise("pass")
    tests = F.when(tagged, _unfenced(F.regexp_extract(c, test, 1))).when(F.size(fenced) > 1, strip(F.get(fenced, F.size(fenced) - 1))).otherwise("")
    return solution, tests


def strict_code_blocks(c: Column | str) -> tuple[Column, Column]:
    """Tagged blocks; else two different fenced blocks of which the first defines solve; else one block that is cut at
    its first test; else two empty strings."""
    c = col(c)
    sol, test = SOLUTION_BLOCK, TEST_BLOCK
    bare = lambda x: strip(F.regexp_replace(_unfenced(x), r"(?md)^```\s*$", ""))
    tagged = c.rlike(sol) & c.rlike(test)
    fenced = F.transform(all_matches(c, r"(?s)```python(.*?)```"), strip)
    n = F.size(fenced)
    first, last = F.get(fenced, F.lit(0)), F.get(fenced, n - 1)
    two = (n >= 2) & (first != last) & F.contains(first, F.lit("def solve"))
    at = F.locate("def test_1", first)
    one = (n == 1) & F.contains(first, F.lit("def solve")) & (at > 0)
    solution = F.when(tagged, bare(F.regexp_extract(c, sol, 1))).when(two, first).when(one, strip(F.substring(first, F.lit(1), at - 1))).otherwise("")
    tests = F.when(tagged, bare(F.regexp_extract(c, test, 1))).when(two, last).when(one, strip(F.substring(first, at, F.length(first)))).otherwise("")
    return solution, tests


def test_pairs(inputs: Column | str, outputs: Column | str, n: int = 5) -> Column:
    """Up to n (input, output) pairs, filled up with the first one; empty if there are none."""
    pairs = F.arrays_zip(col(inputs).alias("input"), col(outputs).alias("output"))
    k = F.least(F.size(col(inputs)), F.size(col(outputs)), F.lit(n))
    pairs = F.slice(pairs, F.lit(1), k)
    return F.when(k > 0, F.concat(pairs, F.array_repeat(F.get(pairs, F.lit(0)), F.lit(n) - k))).otherwise(pairs)


#: Head of a test module: run(text) gives what solve() prints for that standard input.
RUNNER = """import contextlib
import io
import sys

from solution import solve


def run(text):
    printed = io.StringIO()
    sys.stdin = io.StringIO(text)
    try:
        with contextlib.redirect_stdout(printed):
            solve()
    finally:
        sys.stdin = sys.__stdin__
    return printed.getvalue().strip()

"""


@F.pandas_udf(StringType())
def test_source(inputs: pd.Series, outputs: pd.Series) -> pd.Series:
    """Test module of (input, output) pairs; quoting of arbitrary strings is Python's own."""

    def made(i, o):
        pairs = list(zip(i if i is not None else [], o if o is not None else []))
        return RUNNER + "\n".join(f"def test_{k}(): assert run({str(a).strip()!r}) == {str(b).strip()!r}" for k, (a, b) in enumerate(pairs, 1))

    return pd.Series([made(i, o) for i, o in zip(inputs, outputs)], dtype="object")


@F.pandas_udf(ArrayType(StringType()))
def test_inputs(tests: pd.Series) -> pd.Series:
    """The constant texts that a test module hands to run(), in order, each once; none if it doesn't parse."""

    def found(source):
        try:
            tree = ast.parse(source or "")
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return []
        calls = [n for n in ast.walk(tree) if isinstance(n, ast.Call) and isinstance(n.func, ast.Name) and n.func.id == "run" and n.args]
        calls.sort(key=lambda n: (n.lineno, n.col_offset))
        return list(dict.fromkeys(n.args[0].value for n in calls if isinstance(n.args[0], ast.Constant) and isinstance(n.args[0].value, str)))

    return tests.map(found)


def first_user(messages: Column | str) -> Column:
    """Content of the first user message, else of the second message."""
    m = col(messages)
    users = F.filter(m, lambda x: x["role"] == "user")
    return F.coalesce(filled(F.get(users, F.lit(0))["content"]), F.get(m, F.lit(1))["content"], F.lit(""))


def second_content(messages: Column | str, fallback: Column | str) -> Column:
    m = col(messages)
    return F.when(F.size(m) >= 2, F.coalesce(F.get(m, F.lit(1))["content"], F.lit(""))).otherwise(col(fallback))


def messages(system: Column, user: Column) -> Column:
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(turn("system", system), turn("user", user))


def append_turn(m: Column | str, role: str, text: Column) -> Column:
    return F.concat(col(m), F.array(F.struct(F.lit(role).alias("role"), text.alias("content"))))
