"""Prompts as Column expressions. The wording is our own; parsers rely only on the markers that it asks for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .domains import complement
from .text import col

_CHANGES = {
    "add_constraint": "Make it harder by adding one meaningful constraint that changes the way to the solution.",
    "replace_numbers": "Make it harder by putting irrational, complex or large-denominator numbers in place of its integers, so that it stays solvable.",
    "shift_type": "Change its type (algebra to geometry, discrete to continuous, computation to proof) and keep its idea.",
    "increase_steps": "Make it need clearly more steps: sub-goals, induction or cases.",
    "combine_problems": "Combine it with ideas from {domain} so that both are needed.",
}


def _say(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def mutation(problem: Column | str, strategy: Column | str, domain: Column | str) -> Column:
    """Asks for a harder version of a problem; null for an unknown strategy."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, change in _CHANGES.items():
        text = F.replace(F.lit(change), F.lit("{domain}"), complement(F.coalesce(col(domain), F.lit("algebra"))))
        out = out.when(col(strategy) == name, _say("Rewrite the following mathematics problem. ", text, " Give only the new problem, without a solution.\n\n", col(problem)))
    return out


def teacher(problem: Column | str) -> Column:
    return _say("Solve the problem. Put your reasoning between <think> and </think>, then give the final answer in \\boxed{}.\n\n", col(problem))


def rewrite_stem(stem: Column | str) -> Column:
    return _say("This stem of a multiple-choice problem has lost its options. Reword it as an open problem and give only that.\n\n", col(stem))


def variant(seed: Column | str, mutation_name: Column | str, scenario: Column | str) -> Column:
    return _say("Write one new programming problem from this seed.\nMutation: ", F.replace(col(mutation_name), F.lit("_"), F.lit(" ")), "\nScenario: ", col(scenario), "\nBegin with PROBLEM:\n\nSeed:\n", col(seed))


def solution_and_tests(problem: Column | str) -> Column:
    return _say(col(problem), "\n\nAnswer with two blocks and nothing else: <|Solution Begin|> a function solve() that reads standard input <|Solution End|> and <|Test Begin|> five tests that call run(input) <|Test End|>.")


def rate_code(problem: Column | str, solution: Column | str) -> Column:
    return _say("Rate the difficulty of this problem and solution from 1 (basic) to 4 (expert). Answer with one digit.\n\n", F.substring(col(problem), 1, 1500), "\n\n", F.substring(col(solution), 1, 1000))


def original(topic: Column | str, level: Column | str) -> Column:
    return _say("Write an original ", col(topic), " problem of difficulty ", col(level).cast("string"), " (1 to 5) with a clean final answer. Use the headings QUESTION:, SOLUTION: and FINAL ANSWER:.")


def from_seed(question: Column | str, level: Column | str) -> Column:
    return _say("Write a new problem of difficulty ", col(level).cast("string"), " (1 to 5) on the idea of this one. Use the headings QUESTION:, SOLUTION: and FINAL ANSWER:.\n\n", col(question))
