"""The several scales of difficulty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, full_lines, let, occurrences, strip, word_count

# Fixed values.
RATE_WORDS = ("percent", "ratio", "fraction", "rate", "total", "average", "per", "each")
ADVANCED = (
    r"(?i)\b(prove|proof|derive|theorem|lemma|corollary|conjecture|generalize|counterfactual|novel|synthesis|framework|"
    r"eigenvalue|determinant|manifold|topology|abstract algebra|number field|galois|analytic|p-adic)\b"
)
INTERMEDIATE = (
    r"(?i)\b(integrate|differentiate|matrix|logarithm|exponential|complex number|polynomial roots|modular arithmetic|"
    r"combinatorics? on words|generating function|recurrence)\b"
)
DOMAIN_BASE = {"pre_algebra": 0, "algebra": 1, "geometry": 1, "number_theory": 2, "intermediate_algebra": 2, "polynomial_roots": 2}
LEVEL_NAMES = {0: "Minimal", 1: "Basic", 2: "Intermediate", 3: "Advanced", 4: "Expert"}
EVAL_NAMES = {0: "Basic", 1: "Elementary", 2: "Intermediate", 3: "Advanced", 4: "Expert"}
SYNTHESIS_NAMES = {1: "Basic", 2: "Elementary", 3: "Intermediate", 4: "Advanced", 5: "Expert"}


def eval_level(c: Column | str) -> Column:
    """0 to 4 from word count, numbers and rate words (as substrings, so that "percent" also counts "per")."""

    def of(t: Column) -> Column:
        rates = sum((occurrences(t, w) for w in RATE_WORDS), F.lit(0))
        length = let(word_count(t), lambda n: F.when(n > 80, 2).when(n > 50, 1).otherwise(0))
        return length + F.when(F.regexp_count(t, F.lit(r"\d+")) > 6, 1).otherwise(0) + F.when(rates > 2, 1).otherwise(0)

    return F.least(let(F.lower(F.coalesce(col(c), F.lit(""))), of), F.lit(4))


def reasoning_level(problem: Column | str, trace: Column | str, domain: Column | str, sample_id: Column | str) -> Column:
    """0 to 4: the higher of domain base and text signal, plus bonuses for trace length and mutation depth.

    4 needs an advanced keyword or a trace of 30 lines.
    """
    p = F.coalesce(col(problem), F.lit(""))
    steps = F.size(full_lines(trace))
    advanced = p.rlike(ADVANCED)
    text = F.when(advanced, 3).when(p.rlike(INTERMEDIATE), 2).otherwise(1)
    base = F.coalesce(F.create_map(*[F.lit(x) for kv in DOMAIN_BASE.items() for x in kv])[F.coalesce(col(domain), F.lit("algebra"))], F.lit(1))
    depth = F.regexp_extract(F.coalesce(col(sample_id), F.lit("")), r"::d(\d+)$", 1)
    bonus = F.when(depth == "", 0).when(depth.try_cast("int") == 1, 0).when(depth.try_cast("int") == 2, 1).otherwise(2)
    raw = F.greatest(base, text) + F.when(steps > 40, 2).when(steps > 20, 1).otherwise(0) + bonus
    return F.least(F.when((raw >= 4) & ~advanced & (steps < 30), 3).otherwise(raw), F.lit(4))


def length_label(c: Column | str) -> Column:
    """Label by word count; an empty text is intermediate."""
    n = word_count(c)
    empty = F.coalesce(col(c), F.lit("")) == ""
    return F.when(empty, "intermediate").when(n < 30, "basic").when(n < 60, "elementary").when(n < 100, "intermediate").when(n < 150, "advanced").otherwise("expert")


def code_level(hint: Column | str, model_says: Column | None = None) -> Column:
    """1 to 4 from a hint (word or contest rating), else the digit a model gives, else 2."""
    h = F.lower(F.coalesce(col(hint), F.lit("")))
    rating = F.when(h.rlike(r"^\d+$"), h.try_cast("long"))
    said = F.lit(None).cast("int") if model_says is None else F.nullif(F.regexp_extract(model_says, "([0-4])", 1), F.lit("")).try_cast("int")
    return (
        F.when(h.isin("easy", "beginner", "0", "1"), 1)
        .when(h.isin("medium", "moderate", "2"), 2)
        .when(h.isin("hard", "difficult", "3"), 3)
        .when(h.isin("expert", "4"), 4)
        .when(rating <= 1000, 1)
        .when(rating <= 1500, 2)
        .when(rating <= 2000, 3)
        .when(rating.isNotNull(), 4)
        .otherwise(F.coalesce(said, F.lit(2)))
    )


def level_name(level: Column | str, names: dict[int, str] = LEVEL_NAMES, lower: bool = True) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in names.items() for x in (k, v.lower() if lower else v)])
    return F.coalesce(table[col(level).cast("int")], F.lit("unknown"))


def stripped_level(c: Column | str) -> Column:
    """A digit 1 to 4 anywhere in a model's reply, or null."""
    return F.nullif(F.regexp_extract(strip(c), "([1-4])", 1), F.lit("")).try_cast("int")
