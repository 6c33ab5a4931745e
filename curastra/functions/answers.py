"""Answers: boxed payloads, reference normalisation, cascades over model outputs, comparison."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import apart, col, collapse, contains_any, extract, filled, filled_once, filled_strip, first_match, full_lines, last_match, let, strip, words
from .thinking import after_think, think_block

# Patterns of answers.
BOX = "\\boxed{"
BOX_FLAT = r"\\boxed\{([^}]+)\}"
ANSWER_LABEL = r"(?i)^\s*(final\s+answer|answer|ans)\s*[:\-]\s*"
ANSWER_PHRASE = r"(?i)^\s*(the\s+)?(final\s+)?answer\s+is\s*[:\-]?\s*"
IN_PARENTHESES = r"(?s)\\\((.*?)\\\)"
IN_DOLLARS = r"(?s)\$(.+?)\$"
SAYS_ANSWER = r"(?i)(?:final\s+answer|answer|ans)\s*(?:is|:|=)"
HASHED_NUMBER = r"####\s*([\d,\.]+)"
LAST_NUMBER = r"(-?\b\d+(?:\.\d+)?\b)"
DOTTED_TAG = r"(?s)<\.\.\.>.*?</\.\.\.>"
FIRST_NUMBER = r"\$?\s*(-?\d+(?:[.,]\d+)?(?:/\d+)?)"
STATED_NUMBER = r"(?:[Ff]inal\s+[Aa]nswer|[Tt]he\s+answer\s+is)\s*[:\-=]?\s*\$?\s*(-?\d+(?:\.\d+)?(?:/\d+)?)"
BOLD_NUMBER = r"\*\*\$?(-?[\d,]+\.?\d*)\*\*"
EQUALS_NUMBER = r"=\s*\$?(-?[\d,]+\.?\d*)\s*(?:\.|$|\n)"
FINAL_STRICT = r"(?i)(?:^|\\b)(?:final answer|answer|ans|答案|最終答案)\s*(?:is|:|=|是|為|：)?\s*(.+)$"
FINAL = r"(?i)(?:^|\b)(?:final answer|answer|ans|答案|最終答案)\s*(?:is|:|=|是|為|：)?\s*(.+)$"
PROSE = ("therefore", "because", "explain", "proof")
#: What the pattern of trailing noise may stand before or at: noise, and line ends, before which $ matches too.
ENDS = (" ", ".", ";", ",", "\n", "\r", "\x85", "\u2028", "\u2029")
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?(?:\r?\n|\r)?\z"
AFTER_ANSWER = r"(?i)(?:final\s+)?answer[:\s]+([^\n.]+)"


def boxed_last(c: Column | str) -> Column:
    """Payload of the last \\boxed{...}, by brace depth; null if there is none or it never closes."""

    def visit(a: Column, t: Column) -> Column:
        opens, closes = t == "{", t == "}"
        depth = a["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        grown = F.when(closes & (a["depth"] == 1), 0).otherwise(F.length(t))
        return F.when(a["depth"] == 0, a).otherwise(F.struct(depth.alias("depth"), (a["size"] + grown).alias("size")))

    def payload(text: Column) -> Column:
        return let(
            F.substring_index(text, BOX, -1),
            # only braces matter, so the scan visits the runs between them, not every character
            lambda tail: let(
                F.aggregate(F.regexp_extract_all(tail, F.lit(r"([{}]|[^{}]+)"), F.lit(1)), F.struct(F.lit(1).alias("depth"), F.lit(0).alias("size")), visit),
                lambda end: F.when(end["depth"] == 0, strip(F.substring(tail, F.lit(1), end["size"]))),
            ),
        )

    # a text without a box never enters the scan
    return F.when(F.contains(col(c), F.lit(BOX)), let(col(c), payload))


def boxed_flat_first(c: Column | str) -> Column:
    """First \\boxed{...} up to the first closing brace."""
    return extract(c, BOX_FLAT)


def boxed_flat_last(c: Column | str) -> Column:
    return last_match(c, BOX_FLAT)


def clean_answer(c: Column | str) -> Column:
    """Without back-ticks, answer prefixes and trailing dots."""
    s = strip(F.regexp_replace(strip(c), "^`+|`+$", ""))
    s = F.regexp_replace(s, ANSWER_LABEL, "")
    s = F.regexp_replace(s, ANSWER_PHRASE, "")
    return strip(F.regexp_replace(strip(s), r"\.+$", ""))


def normalise_reference(c: Column | str) -> Column:
    """Last boxed payload, else last \\(...\\), else last $...$, else last full line; cleaned. Null or '' if blank."""

    def of(raw: Column) -> Column:
        paren = filled(clean_answer(last_match(raw, IN_PARENTHESES)))
        dollar = filled(clean_answer(last_match(raw, IN_DOLLARS)))
        line = filled(clean_answer(F.element_at(F.nullif(full_lines(raw), F.array().cast("array<string>")), -1)))
        rest = F.coalesce(paren, dollar, line, F.when(raw != "", clean_answer(raw)))
        return let(filled(boxed_last(raw)), lambda boxed: F.when(boxed.isNotNull(), clean_answer(boxed)).otherwise(rest))

    return let(strip(c), of)


def pick_reference(*cs: Column) -> Column:
    """The first candidate whose normalised form isn't empty; an array column gives its values in order."""
    return F.coalesce(*[filled(normalise_reference(c)) for c in cs])


def pick_reference_of(values: Column | str) -> Column:
    return F.get(F.filter(F.transform(col(values), normalise_reference), lambda x: x.isNotNull() & (x != "")), F.lit(0))


def high_confidence_reference(c: Column | str) -> Column:
    """The normalised answer only where the text signals one: a box, "answer is", or one line of up to six words."""
    raw = strip(c)
    found = filled(normalise_reference(raw))
    rows = full_lines(raw)
    short = (F.size(rows) == 1) & (F.size(words(F.get(rows, F.lit(0)))) <= 6)
    says = raw.rlike(SAYS_ANSWER)
    return F.when(F.contains(raw, F.lit(BOX)) | says | short, found)


def expected_number(c: Column | str) -> Column:
    """The number after ####, else the last number, else the stripped text."""
    c = col(c)
    hashed = F.when(F.contains(c, F.lit("####")), first_match(c, HASHED_NUMBER))
    return F.coalesce(strip(F.replace(hashed, F.lit(","), F.lit(""))), last_match(c, LAST_NUMBER), strip(c))


def eval_answer(after: Column | str, reasoning: Column | str) -> Column:
    """Answer of a generation in seven steps of falling reliability; '' if none applies.

    Arguments are read many times, so that computed ones should be columns. Plain marks go before the patterns that need them.
    """
    after, reasoning = F.coalesce(col(after), F.lit("")), F.coalesce(col(reasoning), F.lit(""))
    full = F.concat(after, F.lit(" "), reasoning)
    either = lambda mark, found: F.when(F.contains(after, F.lit(mark)) | F.contains(reasoning, F.lit(mark)), found)
    bare = lambda x: strip(F.replace(x, F.lit(","), F.lit("")))
    no_commas = lambda x: F.replace(x, F.lit(","), F.lit(""))
    cleaned = strip(F.when(F.contains(after, F.lit("<...>")), F.regexp_replace(after, DOTTED_TAG, "")).otherwise(after))
    marked = lambda x, mark, found: F.when(F.contains(x, F.lit(mark)), found)
    return F.coalesce(
        marked(after, BOX, bare(first_match(after, BOX_FLAT))),
        F.when(after != "", no_commas(first_match(cleaned, FIRST_NUMBER))),
        marked(reasoning, BOX, bare(boxed_flat_last(reasoning))),
        either("nswer", no_commas(first_match(full, STATED_NUMBER))),
        either("**", no_commas(last_match(full, BOLD_NUMBER))),
        marked(reasoning, "=", no_commas(last_match(reasoning, EQUALS_NUMBER))),
        apart(last_match(full, LAST_NUMBER)),
        F.lit(""),
    )


def unwrap_display(c: Column, strict: bool = False) -> Column:
    """One layer of $$, $, \\( \\) or \\[ \\] less; ``strict`` looks for the last two with doubled backslashes."""
    slash = "\\\\" if strict else "\\"

    def of(s: Column) -> Column:
        out = F.when(F.lit(False), s)
        for left, right in (("$$", "$$"), ("$", "$"), (slash + "(", slash + ")"), (slash + "[", slash + "]")):
            inside = F.substring(s, F.lit(len(left) + 1), F.length(s) - len(left) - len(right))
            out = out.when(s.startswith(left) & s.endswith(right) & (F.length(s) > len(left) + len(right)), strip(inside))
        return out.otherwise(s)

    return let(strip(c), of)


def clean_candidate(c: Column | str, strict: bool = False) -> Column:
    """A candidate answer span without wrappers and trailing noise; null if blank or a leftover think tag."""
    # plain marks go before the patterns that need them
    untagged = lambda s: F.when(~F.contains(s, F.lit("<")) | ~contains_any(F.lower(s), ("<think", "</think")), s)
    unticked = lambda s: F.when(F.contains(s, F.lit("`")), F.regexp_replace(s, "^[` ]+|[` ]+$", "")).otherwise(s)
    unended = lambda s: F.when(F.right(s, F.lit(1)).isin(*ENDS), F.regexp_replace(s, r"[ .;,]+$", "")).otherwise(s)
    unpriced = lambda s: F.when(F.contains(s, F.lit("$")), F.regexp_replace(s, r"^\$+|\$+$", "")).otherwise(s)
    unbold = lambda s: F.when(s.startswith("**") & s.endswith("**") & (F.length(s) > 4), strip(F.substring(s, F.lit(3), F.length(s) - 4))).otherwise(s)

    def of(s: Column) -> Column:
        s = F.coalesce(F.when(F.contains(s, F.lit(BOX)), filled_once(boxed_last(s))), s)
        s = let(let(unwrap_display(s, strict), unended), unpriced)
        return let(filled_strip(let(strip(s), unbold)), untagged)

    return let(let(filled_once(let(strip(c), unticked)), untagged), of)


def final_answer_line(c: Column | str, strict: bool = False) -> Column:
    """From the last line that states an answer."""
    pattern = FINAL_STRICT if strict else FINAL
    stated = lambda t: F.regexp_extract(F.try_element_at(F.filter(full_lines(t), lambda x: x.rlike(pattern)), F.lit(-1)), pattern, 1)
    return let(col(c), lambda t: F.when(contains_any(F.lower(t), ("ans", "答案")), clean_candidate(stated(t), strict)))


def _answer_like(x: Column, strict: bool) -> Column:
    slash = r"\\\\" if strict else r"\\"
    prose = let(F.lower(x), lambda low: contains_any(low, PROSE))
    return (F.size(words(x)) <= 18) & ~prose & x.rlike(r"[0-9]|" + slash + r"|=|\^|/|\(|\)|\[|\]|\{|\}|%|π|sqrt")


def tail_line(c: Column | str, strict: bool = False) -> Column:
    """The last line that looks like an answer."""
    like = lambda x: F.when(x.isNotNull() & _answer_like(x, strict), x)
    # lines above the one found are only passed over
    return F.aggregate(F.reverse(full_lines(c)), F.lit(None).cast("string"), lambda found, x: F.when(found.isNotNull(), found).otherwise(let(clean_candidate(x, strict), like)))


def teacher_answer(c: Column | str, strict: bool = False) -> Column:
    """Final answer of a teacher response: box of the tail, stated line, answer-like line, then the same of the rest.

    ``strict`` keeps patterns whose doubled backslashes match literal ones; the default is what they mean.
    """
    clean = lambda *found: F.coalesce(*[clean_candidate(x, strict) for x in found])

    def of(text: Column) -> Column:
        first = let(after_think(text), lambda tail: clean(boxed_last(tail), final_answer_line(tail, strict), tail_line(tail, strict)))
        rest = clean(final_answer_line(text, strict), tail_line(think_block(text), strict), boxed_last(text))
        # without a closing tag the tail is the text, and there is no block
        return F.coalesce(first, F.when(F.contains(F.lower(text), F.lit("</think>")), rest))

    return let(col(c), of)


def normalise_compare(c: Column | str) -> Column:
    """The form in which answers are compared: wrappers, minus sign, comma and blank spacing, right side of the last =."""

    def unwrapped(s: Column, left: str, right: str) -> Column:
        inside = lambda x: F.substring(x, F.lit(len(left) + 1), F.length(x) - len(left) - len(right))
        return let(s, lambda x: F.when(x.startswith(left) & x.endswith(right) & (F.length(x) > len(left) + len(right)), strip(inside(x))).otherwise(x))

    s = strip(c)
    for left, right in (("$$", "$$"), ("$", "$"), ("\\(", "\\)"), ("\\[", "\\]")):
        s = unwrapped(s, left, right)
    s = collapse(F.regexp_replace(F.replace(s, F.lit("−"), F.lit("-")), r"\s*,\s*", ","))

    def of(x: Column) -> Column:
        right = strip(F.substring_index(x, "=", -1))
        return F.when(F.contains(x, F.lit("=")) & ~x.startswith("\\") & (right != ""), right).otherwise(x)

    # collapse() makes '' of null; a missing answer stays missing
    return F.when(col(c).isNotNull(), let(s, of))


_NUMBER = r"^-?\d+(\.\d+)?$"


def numeric_value(c: Column | str) -> Column:
    """Value of an integer, decimal, percent, a/b or \\frac{a}{b}; null for anything else."""
    ratio = r"^(-?)(?:\\[dt]?frac\{(-?\d+)\}\{(\d+)\}|(\d+)\s*/\s*(\d+))$"

    def of(s: Column) -> Column:
        part = lambda k: F.regexp_extract(s, ratio, k)
        top = F.coalesce(filled(part(2)), filled(part(4))).try_cast("double")
        low = F.nullif(F.coalesce(filled(part(3)), filled(part(5))).try_cast("double"), F.lit(0.0))
        sign = F.when(part(1) == "-", F.lit(-1.0)).otherwise(F.lit(1.0))
        percent = F.regexp_extract(s, r"^(-?\d+(?:\.\d+)?)\\?%$", 1)
        return (
            F.when(s.rlike(_NUMBER), s.try_cast("double"))
            .when(s.rlike(ratio), sign * top / low)
            .when(percent != "", filled(percent).try_cast("double") / 100)
        )

    return let(F.replace(strip(c), F.lit(","), F.lit("")), of)


def verify(reference: Column | str, predicted: Column | str, tolerance: float = 1e-6) -> tuple[Column, Column]:
    """(verified, method): true, false or null, by equal normal forms, then by value; null where neither decides."""

    def of(x: Column) -> Column:
        missing, exact = x["ref"].isNull() | x["pred"].isNull(), x["ref"] == x["pred"]
        both = x["rv"].isNotNull() & x["pv"].isNotNull()
        verified = F.when(missing, F.lit(None).cast("boolean")).when(exact, F.lit(True)).when(both, F.abs(x["rv"] - x["pv"]) < tolerance)
        method = F.when(missing, "none").when(exact, "exact_match").when(both, "numeric").otherwise("none")
        return F.struct(verified.alias("verified"), method.alias("method"))

    normal = F.struct(normalise_compare(filled(col(reference))).alias("ref"), normalise_compare(filled(col(predicted))).alias("pred"))
    valued = let(normal, lambda x: F.struct(x["ref"].alias("ref"), x["pred"].alias("pred"), numeric_value(x["ref"]).alias("rv"), numeric_value(x["pred"]).alias("pv")))
    judged = let(valued, of)
    return judged["verified"], judged["method"]


def eval_verify(predicted: Column | str, expected: Column | str, want: Column | str | None = None) -> Column:
    """pass, fail or unknown: numbers by difference under 1e-4, other texts by equality (never fail).

    ``want`` is the expected number, where a column has it already.
    """
    pred, raw = filled(col(predicted)), filled(col(expected))
    # each number is named once, so that nothing has to hold it: '' and what isn't a number become null
    number = lambda s: F.regexp_extract(F.replace(s, F.lit(","), F.lit("")), PLAIN_NUMBER, 0).try_cast("double")

    def judged(given: Column, wanted: Column) -> Column:
        near = F.abs(number(given) - number(wanted)) < 1e-4
        numbers = F.get(F.array(F.lit("fail"), F.lit("pass")), near.cast("int"))
        return F.coalesce(numbers, F.when(given == wanted, "pass").otherwise("unknown"))

    given = strip(col(predicted))
    verdict = let(strip(expected_number(raw)), lambda wanted: judged(given, wanted)) if want is None else judged(given, strip(want))
    return F.when(pred.isNull() | raw.isNull(), "unknown").otherwise(verdict)


def calculator_answer(solution: Column | str) -> Column:
    """First flat box, else what follows "answer" up to a line feed or period."""
    return F.coalesce(filled(strip(boxed_flat_first(solution))), filled_strip(F.regexp_extract(col(solution), AFTER_ANSWER, 1)))

