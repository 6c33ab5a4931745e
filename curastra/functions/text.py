"""Text primitives as Column expressions: white space, emptiness, counts, keyword scans.

``strip`` and ``words`` follow the rules of strings split at any white space; an empty string and null both count as
missing where ``filled`` is used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What \s matches.
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    Without it an expression that repeats its argument doubles with every step of a cascade.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def apart(value: Column) -> Column:
    """The same value, with its projection kept out of whole-stage code, where a whole chain of projections becomes one method.

    The JVM never compiles a method over 8,000 bytes; outside, Spark splits a projection into small ones.
    """
    return let(value, lambda x: x)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def filled(c: Column | str) -> Column:
    """The string, or null if it is empty."""
    return F.nullif(col(c), F.lit(""))


def filled_once(c: Column) -> Column:
    """The same of a computed string: in a branch, ``filled`` would compute it for the test and again for the value."""
    return let(c, filled)


def filled_strip(c: Column | str) -> Column:
    return filled_once(strip(c))


def first_filled(*cs: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[filled(c) for c in cs])


def collapse(c: Column | str) -> Column:
    """White-space runs become one space, ends are cut; null becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col(c), F.lit("")), r"\s+", " "))


def words(c: Column | str) -> Column:
    return F.filter(F.split(F.coalesce(col(c), F.lit("")), r"\s+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c))


def token_estimate(c: Column | str) -> Column:
    """Words times 1.3, cut to an integer."""
    return (word_count(c).cast("double") * F.lit(1.3)).cast("int")


def chat_tokens(messages: Column | str) -> Column:
    """A quarter of all characters of the contents, plus ten for each message."""
    m = col(messages)
    chars = F.aggregate(m, F.lit(0), lambda a, x: a + F.length(F.coalesce(x["content"], F.lit(""))))
    return F.floor(chars / 4).cast("int") + F.size(m) * 10


def completion_budget(messages: Column | str, window: int = 65536, margin: int = 200, most: int = 8192, least: int = 512) -> Column:
    return F.greatest(F.lit(least), F.least(F.lit(window) - chat_tokens(messages) - margin, F.lit(most)))


def sanitize_question(c: Column | str) -> Column:
    """Without code fences and instruction headers, white space collapsed."""
    out = F.coalesce(col(c), F.lit(""))
    for mark in ("```", "### Instruction:", "### Response:"):
        out = F.replace(out, F.lit(mark), F.lit(" "))
    return collapse(out)


def contains_any(c: Column, needles: Iterable[str]) -> Column:
    """Whether any needle is in the text. Long lists loop over an array: a chain of tests would outgrow generated code."""
    needles = list(needles)
    if len(needles) > 16:
        return let(c, lambda t: F.exists(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(t, n)))
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(c, F.lit(n))
    return out


def occurrences(c: Column, needle: str) -> Column:
    """Non-overlapping places of a plain string."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null where it doesn't match or is empty."""
    return filled_once(F.regexp_extract(col(c), pattern, group))


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null where it doesn't match: in generated code, and once, unlike ``extract``.

    The rest of the text goes to the match, so that there is one at most. ``pattern`` has no | outside of brackets.
    """
    return F.try_element_at(all_matches(c, pattern + "(?s:.*)", group), F.lit(1))


def all_matches(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))


def last_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    return F.try_element_at(all_matches(c, pattern, group), F.lit(-1))


def lines(c: Column | str) -> Column:
    return F.split(F.coalesce(col(c), F.lit("")), r"\r\n|\r|\n")


def full_lines(c: Column | str) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(lines(c), strip), lambda x: x != "")


def slug(c: Column | str) -> Column:
    return F.translate(col(c), "/-", "__")


def prompt_id(source: Column | str, index: Column | str, question: Column | str) -> Column:
    """Source slug, running index of four digits, first four hex digits of the md5 of the first 100 characters."""
    s = F.regexp_replace(F.lower(strip(source)), "[^a-z0-9]", "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), "^_+|_+$", "")
    return F.concat(s, F.lit("_q"), F.format_string("%04d", col(index)), F.lit("_"), F.substring(F.md5(F.substring(col(question), 1, 100)), 1, 4))


def fingerprint(c: Column | str) -> Column:
    """Eight hex digits of the md5 of the whole lower-cased, stripped text."""
    return F.substring(F.md5(strip(F.lower(col(c)))), 1, 8)


def prefix_hash(c: Column | str) -> Column:
    """md5 of the first 100 characters, lower-cased, white space collapsed."""
    return F.md5(F.substring(F.regexp_replace(strip(F.lower(col(c))), r"\s+", " "), 1, 100))


def truncated(c: Column | str, most: int = 2000) -> Column:
    c = col(c)
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def trim_problem(c: Column | str, most: int = 1800, slack: int = 400) -> Column:
    """Texts over ``most`` characters end at the last line feed, else period, of the last ``slack``; a note follows."""
    c = col(c)
    head = F.substring(c, 1, most)
    last = lambda mark: F.lit(most) - F.locate(mark, F.reverse(head))  # noqa: E731  0-based; ``most`` if there is none
    there = lambda mark: F.contains(head, F.lit(mark)) & (last(mark) >= most - slack)
    cut = F.when(there("\n"), last("\n")).when(there("."), last(".")).otherwise(F.lit(most))
    note = "\n[Problem truncated — implement based on the above description]"
    return F.when(F.length(c) > most, F.concat(strip(F.substring(c, F.lit(1), cut + 1)), F.lit(note))).otherwise(c)


def strip_tags(c: Column | str) -> Column:
    return strip(F.regexp_replace(col(c), "<[^>]+>", ""))


def docstring_or_all(c: Column | str) -> Column:
    """The first triple-quoted docstring of over 30 characters, else the whole text, stripped."""
    inner = strip(F.regexp_extract(col(c), '(?s)"""(.*?)"""', 1))
    return F.when(F.length(inner) > 30, inner).otherwise(strip(c))


def json_question(c: Column | str) -> tuple[Column, Column, Column]:
    """Question, test input and test output of a JSON message; a text that isn't JSON is the question itself."""
    c = col(c)
    ok = F.get_json_object(c, "$").isNotNull()
    field = lambda path: F.coalesce(F.get_json_object(c, path), F.lit(""))
    return F.when(ok, strip(field("$.question"))).otherwise(strip(c)), F.when(ok, field("$.test.input")), F.when(ok, field("$.test.output"))


def clean_contest_markup(c: Column | str) -> Column:
    """Dollar-fenced formulas lose their fences; three or more line feeds become two, spaces one."""
    out = F.regexp_replace(col(c), r"\${3}([^$]+)\${3}", "$1")
    out = F.regexp_replace(out, r"\${2,}", "")
    return strip(F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), " {2,}", " "))


def is_model_output(c: Column | str) -> Column:
    s = strip(c)
    head = F.substring(s, 1, 80)
    starts = F.lit(False)
    for p in ("<think>", "Okay,", "Okay let", "Let me"):
        starts = starts | s.startswith(p)
    return starts | F.contains(head, F.lit("I need to solve")) | F.contains(F.lower(head), F.lit("let's figure out"))
