"""Subject labels from keywords, maps and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, contains_any, strip

# Ordered keyword lists of each source, first hit wins; plain substrings of the lower-cased text.
KEYWORDS: dict[str, list[tuple[str, list[str]]]] = {
    "numina": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "perimeter", "coordinate geometry", "sphere", "cone", "rectangle", "rhombus", "tangent", "arc", "chord"]),
        ("polynomial_roots", ["polynomial", "vieta", "cubic", "quartic", "factor theorem", "zero of", "roots of the polynomial"]),
        ("number_theory", ["prime", "divisib", "modular", "gcd", "lcm", "factorial", "diophantine", "congruence", "digit"]),
        ("intermediate_algebra", ["logarithm", "exponential", "complex number", "arithmetic progression", "geometric progression", "matrix", "determinant"]),
        ("algebra", ["equation", "inequalit", "quadratic", "system of", "simplif"]),
        ("pre_algebra", ["percent", "ratio", "proportion", "decimal", "word problem", "average", "speed", "distance"]),
    ],
    "finemath": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "coordinate geometry", "sphere", "cone", "rhombus"]),
        ("polynomial_roots", ["polynomial", "root", "vieta", "cubic", "quartic", "factor theorem", "zeros of"]),
        ("number_theory", ["prime", "divisib", "modular arithmetic", "gcd", "lcm", "integer", "factorial", "congruence"]),
        ("intermediate_algebra", ["logarithm", "exponential", "complex number", "matrix", "determinant", "arithmetic progression", "geometric progression"]),
        ("algebra", ["equation", "inequalit", "function", "sequence", "series", "quadratic"]),
        ("pre_algebra", ["fraction", "percent", "ratio", "decimal", "word problem", "arithmetic"]),
    ],
    "s1k": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "perimeter", "sphere", "cone", "arc", "chord"]),
        ("polynomial_roots", ["polynomial", "vieta", "cubic", "quartic", "roots of", "zero of"]),
        ("number_theory", ["prime", "divisib", "modular", "gcd", "lcm", "diophantine", "congruence", "digit"]),
        ("intermediate_algebra", ["logarithm", "exponential", "complex number", "matrix", "determinant", "progression"]),
        ("algebra", ["equation", "inequalit", "function", "quadratic", "system of"]),
        ("pre_algebra", ["percent", "ratio", "proportion", "decimal", "average", "speed", "distance"]),
    ],
    "limo": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "perimeter"]),
        ("polynomial_roots", ["polynomial", "vieta", "cubic", "quartic", "roots of"]),
        ("number_theory", ["prime", "divisib", "mod", "gcd", "lcm", "integer", "digit"]),
        ("intermediate_algebra", ["logarithm", "exponential", "complex", "matrix", "determinant"]),
        ("algebra", ["equation", "inequalit", "function", "quadratic", "sequence"]),
    ],
    "theoremqa": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "perimeter"]),
        ("number_theory", ["prime", "divisib", "mod", "integer", "factor"]),
        ("intermediate_algebra", ["log", "exponential", "matrix", "determinant", "probability"]),
        ("algebra", ["equation", "function", "sequence", "polynomial"]),
    ],
    "aime": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "perimeter"]),
        ("number_theory", ["prime", "divisib", "mod", "gcd", "lcm", "integer", "digit"]),
        ("intermediate_algebra", ["log", "exponential", "matrix", "determinant", "complex"]),
        ("algebra", ["equation", "inequalit", "function", "polynomial", "sequence"]),
    ],
    "calculator": [
        ("geometry", ["triangle", "circle", "polygon", "angle", "area", "perimeter", "coordinate", "sphere", "cone", "rectangle", "rhombus", "tangent", "arc", "chord"]),
        ("number_theory", ["prime", "divisib", "modular", "gcd", "lcm", "factorial", "diophantine", "congruence", "digit"]),
        ("intermediate_algebra", ["logarithm", "exponential", "complex", "progression", "matrix", "determinant"]),
        ("pre_algebra", ["percent", "ratio", "proportion", "decimal", "word problem", "average", "speed", "distance"]),
        ("algebra", ["equation", "inequalit", "quadratic", "system", "polynomial"]),
    ],
    "topic": [
        ("calculus", ["integral", "derivative", "limit", "differentiat", "calculus"]),
        ("geometry", ["triangle", "circle", "angle", "area", "perimeter", "geometry", "polygon"]),
        ("number theory", ["prime", "divisib", "modulo", "remainder", "factor", "gcd", "lcm"]),
        ("probability", ["probability", "random", "likely", "chance", "expected"]),
        ("combinatorics", ["combination", "permutation", "arrange", "choose", "select", "ways"]),
        ("sequences and series", ["sequence", "series", "arithmetic", "geometric", "sum of"]),
        ("trigonometry", ["sin", "cos", "tan", "trigon", "angle"]),
    ],
    "external": [
        ("calculus", ["integral", "derivative", "limit", "calculus"]),
        ("geometry", ["triangle", "circle", "angle", "area", "geometry"]),
        ("number_theory", ["prime", "divisib", "modulo", "number theory"]),
        ("probability", ["probability", "random", "expected", "chance"]),
        ("combinatorics", ["combination", "permutation", "counting"]),
        ("sequences_and_series", ["sequence", "series", "arithmetic", "geometric"]),
        ("trigonometry", ["sin", "cos", "tan", "trigon"]),
    ],
    "telemath": [("intermediate_algebra", ["probability", "ber", "snr", "noise", "signal"])],
    "code": [
        ("codeio_tracing", ["output of", "what is printed", "trace", "what does"]),
        ("code_edit_bugfix", ["bug", "error", "fix", "wrong", "incorrect"]),
        ("code_infilling_completion", ["fill", "complete", "missing", "blank"]),
        ("code_comprehension", ["complexity", "understand", "explain", "what does this"]),
    ],
}
# Labels by exact, lower-cased category.
TYPE_LABELS = {
    "prealgebra": "pre_algebra", "algebra": "algebra", "geometry": "geometry", "number theory": "number_theory", "number_theory": "number_theory",
    "intermediate algebra": "intermediate_algebra", "intermediate_algebra": "intermediate_algebra", "counting & probability": "pre_algebra",
    "counting_and_probability": "pre_algebra", "precalculus": "intermediate_algebra",
}
TOPIC_LABELS = {
    "algebra": "algebra", "calculus": "calculus", "number theory": "number_theory", "number_theory": "number_theory", "geometry": "geometry",
    "probability": "probability", "discrete mathematics": "discrete_math", "discrete_mathematics": "discrete_math", "pre-algebra": "pre_algebra",
    "pre_algebra": "pre_algebra", "analysis": "calculus", "combinatorics": "discrete_math", "trigonometry": "geometry",
}
COMPLEMENTS = {
    "algebra": ["geometry", "number_theory", "polynomial_roots"], "geometry": ["algebra", "intermediate_algebra"], "number_theory": ["algebra", "polynomial_roots"],
    "intermediate_algebra": ["algebra", "geometry"], "pre_algebra": ["algebra", "geometry"], "polynomial_roots": ["algebra", "number_theory"],
}
CODE_LABELS = (
    "codeio_tracing", "competitive_programming", "code_comprehension", "causal_reasoning", "counterfactual_generation", "code_edit_bugfix", "code_infilling_completion",
)


def by_keywords(c: Column | str, which: str, default: str | Column = "algebra", first: int | None = None) -> Column:
    """The label of the first list with a keyword in the text (of its first characters only, if ``first`` is given)."""
    text = F.coalesce(col(c), F.lit(""))
    text = F.lower(F.substring(text, 1, first) if first else text)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for label, needles in KEYWORDS[which]:
        out = out.when(contains_any(text, needles), label)
    return out.otherwise(F.lit(default) if isinstance(default, str) else default)


def by_map(c: Column | str, labels: dict[str, str], default: str = "algebra") -> Column:
    if not labels:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(table[F.lower(strip(c))], F.lit(default))


def telemath_domain(question: Column | str, difficulty: Column | str) -> Column:
    advanced = F.lower(strip(difficulty)) == "advanced"
    return F.when(by_keywords(question, "telemath") == "intermediate_algebra", "intermediate_algebra").when(advanced, "intermediate_algebra").otherwise("algebra")


def by_path(path: Column | str) -> Column:
    """Label of a path like "Mathematics -> Algebra -> Other"; else its second part in snake case."""
    p = col(path)
    low = F.lower(p)
    has = lambda *ws: contains_any(low, ws)
    second = F.get(F.split(p, "->"), F.lit(1))
    return (
        F.when(p.isNull() | (p == ""), "algebra")
        .when(has("geometry"), "geometry")
        .when(has("number theory", "number_theory"), "number_theory")
        .when(has("algebra"), "algebra")
        .when(has("combinatorics", "combinatorial"), "combinatorics")
        .when(has("discrete"), "discrete_math")
        .when(has("trigonometry"), "trigonometry")
        .when(has("probability", "statistics"), "probability")
        .when(has("calculus"), "calculus")
        .when(has("logic"), "logic")
        .when(second.isNotNull(), F.replace(F.lower(strip(second)), F.lit(" "), F.lit("_")))
        .otherwise("algebra")
    )


def external_domain(text: Column | str, hint: Column | str | None = None) -> Column:
    """The hint, unless it is missing or names a split; else by keywords."""
    found = by_keywords(text, "external")
    if hint is None:
        return found
    h = col(hint)
    return F.when(h.isNotNull() & ~h.isin("", "train", "test", "None"), h).otherwise(found)


def complement(domain: Column | str) -> Column:
    return by_map(domain, {k: v[0] for k, v in COMPLEMENTS.items()}, "geometry")


def code_domain(question: Column | str, model_says: Column | None = None) -> Column:
    """A label named in the model's reply (in fixed order), else by keywords, else competitive programming."""
    found = by_keywords(question, "code", "competitive_programming")
    if model_says is None:
        return found
    said = F.translate(F.lower(strip(model_says)), " -", "__")
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for label in CODE_LABELS:
        out = out.when(F.contains(said, F.lit(label)), label)
    return out.otherwise(found)
