"""Reasoning traces: splitting think blocks from answers, and putting them together."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, contains_any, filled, strip

# Patterns of reasoning blocks, and the remark in place of a missing one.
THINK_INSIDE = r"(?is)<think>(.*?)</think>"
THINK_WHOLE = r"(?is)(<think>.*?</think>)"
THINK_OPENER = r"(?i)<think[^>]*>"
SOLUTION_START = r"(?i)<\|Solution Begin\|>|```python"
OPENERS = ("<think",)
CLOSERS = ("</think>", "</thinking>", "</thought>")
NO_REASONING = "No reasoning found."


def think_block(c: Column | str) -> Column:
    """Inside of the first <think>...</think>, stripped; '' without one."""
    return strip(F.regexp_extract(col(c), THINK_INSIDE, 1))


def after_think(c: Column | str) -> Column:
    """What follows the last </think>, stripped; the text itself without one."""
    c = col(c)
    low = F.lower(c)
    tail = F.length(F.substring_index(low, "</think>", -1))
    return F.when(F.contains(low, F.lit("</think>")), strip(F.right(c, tail))).otherwise(c)


def think_with_tags(c: Column | str) -> Column:
    """The first block with its tags; without one the whole text in tags, '' if blank."""
    c = col(c)
    found = filled(strip(F.regexp_extract(c, THINK_WHOLE, 1)))
    return F.coalesce(found, F.when(strip(c) != "", F.concat(F.lit("<think>\n"), strip(c), F.lit("\n</think>"))).otherwise(F.lit("")))


def think_or_preamble(c: Column | str) -> Column:
    """The first block, else what stands before the first solution block, else a fixed remark."""
    c = col(c)
    return F.when(c.rlike(THINK_WHOLE), think_block(c)).when(c.rlike(SOLUTION_START), strip(F.split(c, SOLUTION_START, 2)[0])).otherwise(F.lit(NO_REASONING))


def eval_split(c: Column | str) -> tuple[Column, Column]:
    """(reasoning, after): at the first </think>, else </thinking>, else </thought>; openers <think...> are dropped.

    Without any closer, all is reasoning and nothing follows; then openers stay.
    """
    low = F.lower(col(c))
    tag = closer(low)
    return split_at(c, low, tag, F.position(tag, low))


def closer(low: Column | str) -> Column:
    """The closing tag that splits a lower-cased text; null without one."""
    return F.coalesce(*[F.when(F.contains(col(low), F.lit(tag)), tag) for tag in CLOSERS])


def split_at(c: Column | str, low: Column | str, tag: Column | str, at: Column | str) -> tuple[Column, Column]:
    """``eval_split`` where columns have the lower-cased text, its closing tag and that tag's place already."""
    c, tag, at = col(c), col(tag), col(at)
    head = F.substring(c, F.lit(1), at - 1)
    head = F.when(contains_any(col(low), OPENERS), F.regexp_replace(head, THINK_OPENER, "")).otherwise(head)
    reasoning = F.when(tag.isNotNull(), strip(head)).otherwise(strip(c))
    return reasoning, F.when(tag.isNotNull(), strip(F.substring(c, at + F.length(tag), F.length(c)))).otherwise(F.lit(""))


def assemble(reasoning: Column | str, answer: Column | str) -> Column:
    """<think>reasoning</think>, a line feed, the answer; the answer alone without reasoning."""
    r, a = F.coalesce(col(reasoning), F.lit("")), F.coalesce(col(answer), F.lit(""))
    return F.when(r != "", F.concat(F.lit("<think>"), r, F.lit("</think>\n"), a)).otherwise(a)
