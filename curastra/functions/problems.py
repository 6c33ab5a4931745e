"""Problem texts: question-likeness, kinds, open-ended forms, mutations, and the quality of code questions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .domains import complement
from .text import col, collapse, contains_any, full_lines, strip

# Remarks that leak from mutation prompts (lower-cased text), and what a question looks like.
LEAKS = (
    r"\bthe user wants me to rewrite\b", r"\boriginal problem\b", r"\brewrite (it )?to be more difficult\b",
    r"\badd(?:ing)? one meaningful mathematical constraint\b", r"\bdo not solve\b", r"\boutput only\b",
)
LINE_LEAKS = (
    r"the user wants me to rewrite", r"\boriginal problem\b", r"rewrite (it )?to be more difficult",
    r"add(?:ing)? one meaningful mathematical constraint", r"\bdo not solve\b", r"\boutput only\b",
)
QUESTION_VERBS = ("solve", "find", "compute", "evaluate", "determine", "prove", "show that", "let ", "if ", "given")
QUESTION_SIGNS = ("=", "+", "-", "*", "/", "^", "(", ")", "$", "\\")
# Signals of problem kinds.
MCQ_BLOCK = (
    r"(?:^|\n)\s*(?:[A-E][.):]\s*.+?){2,}"
    r"|(?:^|\n)(?:\s*[\(\[]\s*[A-E]\s*[\)\]]\s*.+\n?){2,}"
    r"|(?:^|\n)(?:\s*[A-E]\s*[.):\-]\s+.+\n?){2,}"
)
MCQ_HINT = r"\b(which of the following|select the (?:best|correct)|choose the (?:best|correct)|all of the following|none of the above|each of the following)\b"
PROOF = r"\b(prove(?: that)?|show(?: that)?|demonstrate(?: that)?|verify(?: that)?|establish(?: that)?|disprove|find a proof)\b"
TRUE_FALSE = r"\b(true or false|true\/false|state(?: whether)?.*true or false|determine.*true or false|is the following statement true|is this statement true)\b"
YES_NO = r"\b(answer yes or no|answer with yes or no|does .+ exist|is it (?:true|possible|necessary|sufficient) that|can we|must .+ be)\b[\s\S]{0,80}[?]"


def question_like(c: Column | str) -> Column:
    """At least 8 characters, no leaked prompt, and a verb, question mark or sign of a question."""
    t = strip(F.coalesce(col(c), F.lit("")))
    low = F.lower(t)
    leak = low.rlike("|".join(LEAKS))
    return (F.length(t) >= 8) & ~leak & (contains_any(low, QUESTION_VERBS) | F.contains(t, F.lit("?")) | contains_any(t, QUESTION_SIGNS))


def drop_reason(question: Column | str, answer: Column | str) -> Column:
    """Null for rows to keep; the question is tested before the answer."""
    return F.when(~question_like(question), "bad_question").when(collapse(answer) == "", "empty_answer")


def problem_type(c: Column | str) -> Column:
    """mcq, proof, true_false, yes_no or open, in this order of precedence."""
    c = F.coalesce(col(c), F.lit(""))
    flag = lambda p, flags="(?id)": c.rlike(flags + p)
    return (
        F.when(c == "", "open")
        .when(flag(MCQ_BLOCK, "(?imd)") | flag(MCQ_HINT), "mcq")
        .when(flag(PROOF), "proof")
        .when(flag(TRUE_FALSE), "true_false")
        .when(flag(YES_NO), "yes_no")
        .otherwise("open")
    )


def strip_choices(c: Column | str) -> Column:
    """The text before the first block of choices, without a trailing (A) on any line."""
    c = F.coalesce(col(c), F.lit(""))
    head = F.get(F.split(c, "(?imd)" + MCQ_BLOCK, 2), F.lit(0))
    head = F.when(c.rlike("(?imd)" + MCQ_BLOCK), F.regexp_replace(head, r"\s+$", "")).otherwise(c)
    return strip(F.regexp_replace(head, r"(?md)\s*[\(\[]\s*[A-E]\s*[\)\]]\s*$", ""))


def open_true_false(c: Column | str) -> Column:
    cleaned = strip(F.regexp_replace(col(c), r"(?i)^\s*(?:true or false\s*[:\-]?\s*|state whether the following is true or false\s*[:\-]?\s*)", ""))
    return F.concat(F.lit("Determine whether the following statement is true or false, and provide a full justification:\n\n"), cleaned)


def open_yes_no(c: Column | str) -> Column:
    cleaned = strip(F.regexp_replace(col(c), r"(?i)\s*[\.\,\;]?\s*(?:answer yes or no|answer with yes or no)[\.!]?\s*$", ""))
    return F.concat(F.lit("Determine whether the following is true or false, and justify your answer:\n\n"), cleaned)


def open_ended(c: Column | str, kind: Column | None = None) -> Column:
    """The text as an open problem, by its kind; a missing text is ''."""
    c = F.coalesce(col(c), F.lit(""))
    kind = problem_type(c) if kind is None else kind
    return F.when(kind == "mcq", strip_choices(c)).when(kind == "true_false", open_true_false(c)).when(kind == "yes_no", open_yes_no(c)).otherwise(c)


STRATEGIES = ("add_constraint", "replace_numbers", "shift_type", "increase_steps", "combine_problems")


def mutate_offline(problem: Column | str, strategy: Column | str, domain: Column | str) -> Column:
    """The template mutation of a strategy, without a model; null for an unknown strategy."""
    p, s = col(problem), col(strategy)
    second = F.when(s == "combine_problems", complement(F.coalesce(col(domain), F.lit("algebra")))).otherwise("geometry")
    numbers = p
    for a, b in ((" 1 ", " 2 "), (" 2 ", " 3 "), (" 3 ", " 5 ")):
        numbers = F.replace(numbers, F.lit(a), F.lit(b))
    return (
        F.when(s == "add_constraint", F.concat(p, F.lit("\n\nAdditional constraint: Provide the final answer in simplest exact form.")))
        .when(s == "replace_numbers", numbers)
        .when(s == "shift_type", F.concat(F.lit("Reframe this as a "), second, F.lit(" interpretation of the same core problem:\n"), p))
        .when(s == "increase_steps", F.concat(F.lit("Solve this in three explicit stages and justify each stage:\n"), p))
        .when(s == "combine_problems", F.concat(p, F.lit("\n\nAdditionally, connect your reasoning to one concept from "), second, F.lit(".")))
    )


def clean_mutation(c: Column | str) -> Column:
    """A model's rewrite without fences, headers, prompt echoes and blank lines; '' if under ten characters remain."""
    t = F.coalesce(col(c), F.lit(""))
    t = F.regexp_replace(t, r"(?md)^```+\w*\n?", "")
    t = F.regexp_replace(t, r"(?md)\n?```+$", "")
    t = F.regexp_replace(t, r"(?i)### (Instruction|Response|Rewritten Problem|Original Problem):", "")
    t = F.regexp_replace(t, r"(?imd)^Rewritten Problem:\n?", "")
    leak = "(?i)" + "|".join(LINE_LEAKS)
    kept = F.filter(F.split(t, "\n"), lambda x: (strip(x) != "") & ~x.rlike(leak))
    out = strip(F.array_join(kept, "\n"))
    return F.when(F.length(out) < 10, "").otherwise(out)


def sections(c: Column | str) -> tuple[Column, Column, Column]:
    """Question, solution and the first line of the final answer of a sectioned reply; '' where one is missing."""
    c = col(c)
    question = strip(F.regexp_extract(c, r"(?is)QUESTION:\s*(.*?)(?=SOLUTION:|$)", 1))
    solution = strip(F.regexp_extract(c, r"(?is)SOLUTION:\s*(.*?)(?=FINAL ANSWER:|$)", 1))
    answer = F.coalesce(F.get(full_lines(F.regexp_extract(c, r"(?is)FINAL ANSWER:\s*(.*)$", 1)), F.lit(0)), F.lit(""))
    return question, solution, answer


def invalid_reason(question: Column | str, solution: Column | str, answer: Column | str) -> Column:
    """The first rule that a generated problem breaks, or null."""
    size = lambda x: F.length(F.coalesce(col(x), F.lit("")))
    return F.when(size(question) < 20, "question too short").when(size(solution) < 50, "solution too short").when(size(answer) == 0, "no answer extracted")


def single_problem(c: Column | str) -> Column:
    """What follows PROBLEM: if over 50 characters, else the whole reply if over 100, else ''."""
    inner, whole = strip(F.regexp_extract(col(c), r"(?is)PROBLEM\s*:\s*(.*)", 1)), strip(c)
    return F.when(F.length(inner) > 50, inner).when(F.length(whole) > 100, whole).otherwise("")


# Rules for code questions (lower-cased text).
NOT_CODE = (
    r"\bwhat is (a |an |the )?(ram|rom|cpu|os|operating system|computer)\b", r"\bdefine\b.*\bcomputer\b", r"\bfull form\b", r"\bwhich company\b", r"\bwho invented\b",
    r"\bwhen was\b.*\binvented\b", r"\bwhat does [a-z]+ stand for\b", r"\bfull form of\b", r"\bexpand the abbreviation\b",
)
CODE_WORDS = (
    "function", "algorithm", "array", "list", "string", "output", "code", "program", "implement", "write", "return", "complexity", "data structure",
    "loop", "recursion", "sorting", "searching", "pointer", "class", "object", "def ", "int ", "void ", "print", "input", "variable", "compile",
    "integer", "operation", "element", "sequence", "permutation", "graph", "node", "edge", "tree", "matrix", "query", "minimum", "maximum",
    "constraint", "test case", "output the", "print the", "n integers", "n elements", "subarray", "subsequence", "subset", "binary",
    "number", "numbers", "count", "value", "values", "sum", "total", "path", "cost", "distance", "weight", "digit", "digits",
    "move", "moves", "step", "steps", "round", "turn", "player", "score", "city", "cities", "road", "roads", "friend", "friends",
    "bracket", "brackets", "pair", "pairs", "divisor", "divisors", "prime", "modulo", "remainder", "product", "difference",
    "adjacent", "connected", "visited", "marked", "selected", "answer", "result", "largest", "smallest", "longest", "shortest",
    "increasing", "decreasing", "sorted", "reversed", "rotated", "prefix", "suffix", "palindrome", "anagram", "frequency",
    "swap", "replace", "remove", "insert", "append", "merge", "divide", "split", "partition", "group", "segment", "interval",
    "floor", "ceil", "power", "square", "cube", "factorial", "coins", "bags", "boxes", "items", "objects", "tokens",
    "valid", "invalid", "possible", "impossible", "exist", "n-th", "kth", "k-th", "first", "last", "index",
)
CONTEST_PHRASES = (
    "you are given", "given an array", "given a sequence", "given a string", "given a tree", "given a graph", "given n", "given m", "given two",
    "given a list", "given a set", "given a number", "given integers", "there are n", "there are m", "there is a", "consider an array",
    "consider a sequence", "consider a string", "the first line contains", "the first line of input", "each test contains", "each test case", "each line contains",
    "output a single", "print a single", "output the answer", "print the answer", "print yes", "print no", "the input consists", "input format", "output format",
    "standard input", "standard output", "codeforces", "codechef", "leetcode", "hackerrank", "hackerearth", "atcoder", "spoj", "topcoder",
    "alice and bob", "chef", "vipul", "little elephant", "vasya", "petya", "farmer", "robot", "monk",
    "find the minimum", "find the maximum", "find the number", "find the count", "find the sum", "find the longest", "find the shortest", "find all",
    "determine if", "determine whether", "check if", "check whether", "count the number", "count pairs", "return the minimum", "return the maximum", "return the number",
    "compute the", "calculate the", "1 ≤", "1 <=", "2 ≤", "2 <=", "0 ≤", "0 <=", "n ≤", "n <=", "m ≤", "m <=", "k ≤", "k <=",
    "10^", "10 ^", "1e9", "1e6", "1e5", "time limit", "memory limit",
)


def code_quality(c: Column | str) -> Column:
    """accept, reject or ask (a model decides; without one the question is accepted)."""
    c = F.coalesce(col(c), F.lit(""))
    low = F.lower(c)
    return (
        F.when(F.length(c) < 80, "reject")
        .when(low.rlike("(?d)" + "|".join(NOT_CODE)), "reject")
        .when(contains_any(low, CONTEST_PHRASES), "accept")
        .when(~contains_any(low, CODE_WORDS), "reject")
        .otherwise("ask")
    )


def code_question_ok(c: Column | str) -> Column:
    return code_quality(c) != "reject"
