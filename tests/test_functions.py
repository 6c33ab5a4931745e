"""Hand-derived cases of the text, answer and code functions."""

import pytest
from pyspark.sql import functions as F

from curastra.functions import answers, code, difficulty, domains, problems, text, thinking


@pytest.fixture
def value(spark):
    def of(column):
        return spark.range(1).select(column.alias("x")).first()["x"]

    return of


L = F.lit


@pytest.mark.parametrize(("given", "want"), [
    (r"a \boxed{1} b \boxed{\frac{1}{2}}", r"\frac{1}{2}"), (r"\boxed{a{b}", None), ("no box", None), (r"\boxed{ {x} } \boxed{", None), (r"\boxed{}", ""), (r"\boxed{a}}", "a"), ("", None),
])
def test_boxed_last(value, given, want):
    assert value(answers.boxed_last(L(given))) == want


@pytest.mark.parametrize(("given", "want"), [
    ("The cost $5$ then $7$", "7"), (r"so \(x=3\)", "x=3"), ("Answer: 12.", "12"), ("", None), ("The final answer is: 3..", "3"), ("a\n\n b ", "b"), (r"\boxed{4} and $5$", "4"), ("`x`", "x"),
])
def test_reference(value, given, want):
    assert (value(answers.normalise_reference(L(given))) or None) == want


@pytest.mark.parametrize(("given", "want"), [("x = 33", "33"), ("$x=5$", "5"), ("1 , 2", "1,2"), ("−3", "-3"), (r"\text{a}=2", r"\text{a}=2"), (r"\(7\)", "7"), ("a =", "a ="), ("$$1$$", "1")])
def test_compare_form(value, given, want):
    assert value(answers.normalise_compare(L(given))) == want


@pytest.mark.parametrize(("ref", "pred", "want"), [
    (None, "1", (None, "none")), ("2", "x=2", (True, "exact_match")), ("1/2", "0.5", (True, "numeric")), (r"\frac{13}{6}", "13/6", (True, "numeric")), ("3", "4", (False, "numeric")),
    ("50\\%", "0.5", (True, "numeric")), (r"\sqrt{2}", "1.414", (None, "none")), ("", "1", (None, "none")), ("1/0", "1", (None, "none")),
])
def test_verify(value, ref, pred, want):
    verified, method = answers.verify(L(ref).cast("string"), L(pred).cast("string"))
    assert (value(verified), value(method)) == want


@pytest.mark.parametrize(("pred", "expected", "want"), [("72", "#### 72", "pass"), ("5", "6", "fail"), ("1/2", "0.5", "unknown"), ("", "6", "unknown"), ("seven", "seven", "pass"), ("1,000", "#### 1,000", "pass")])
def test_eval_verify(value, pred, expected, want):
    assert value(answers.eval_verify(L(pred), L(expected))) == want


@pytest.mark.parametrize(("given", "want"), [("so #### 1,234", "1234"), ("#### -5", "-5"), ("1/2", "2"), ("none", "none")])
def test_expected_number(value, given, want):
    assert value(answers.expected_number(L(given))) == want


@pytest.mark.parametrize(("given", "want"), [
    ("<think>x</think> So \\boxed{5}.", "5"), ("<think>x</think>\nFinal answer: $7$.", "7"), ("<think>so 3 + 4 = 7</think>", "so 3 + 4 = 7"), ("Hence the answer: 12", "12"), ("nothing at all", None),
])
def test_teacher_answer(value, given, want):
    assert value(answers.teacher_answer(L(given))) == want


def test_strict_reading_of_patterns(value):
    line = L("<think>words</think>\nHence the answer: yes")
    assert value(answers.final_answer_line(line)) == "yes" and value(answers.final_answer_line(line, strict=True)) is None


def test_thinking(value):
    assert value(thinking.think_block(L("<think>a</think>b</think>c"))) == "a" and value(thinking.after_think(L("<think>a</think>b</think>c"))) == "c"
    assert value(thinking.think_block(L("no tags"))) == "" and value(thinking.after_think(L("no tags"))) == "no tags"
    assert value(thinking.think_with_tags(L(" x "))) == "<think>\nx\n</think>" and value(thinking.think_with_tags(L(" "))) == ""
    reasoning, after = thinking.eval_split(L("<Think a>x</thinking>y</think>z"))
    assert (value(reasoning), value(after)) == ("x</thinking>y", "z")
    assert value(thinking.assemble(L("r"), L("a"))) == "<think>r</think>\na" and value(thinking.assemble(L(""), L("a"))) == "a"


def test_first_match_is_what_extract_finds(value):
    for pattern in (answers.BOX_FLAT, answers.FIRST_NUMBER, answers.STATED_NUMBER, answers.HASHED_NUMBER):
        for given in ("none", "", "$ 7/8 then\n9", "\\boxed{3}\\boxed{4}", "#### 1,2. #### 5", "The answer is\n-3.5, the answer is 4", "\u2028 5\x85 6"):
            assert value(text.first_match(L(given), pattern)) == value(text.extract(L(given), pattern)), (pattern, given)


def test_numbers_in_any_form_are_judged(value):
    for pred, expected, want in (("1e999", "-1e999", "fail"), ("NaN", "NaN", "pass"), ("inf", "5", "unknown"), ("5\u2028", "6", "unknown"), ("5\n,", "6", "fail"), ("5.", "5.00001", "pass"), ("x", "5", "unknown"), ("5", None, "unknown"), ("1d", "1", "unknown")):
        assert value(answers.eval_verify(L(pred), L(expected).cast("string"), L(expected).cast("string"))) == want, pred


def test_flat_box_stops_at_the_first_brace(value):
    assert value(answers.boxed_flat_first(L(r"\boxed{\frac{1}{2}}"))) == r"\frac{1"


def test_words_and_tokens(value):
    assert value(text.word_count(L("a  b\tc\n"))) == 3 and value(text.word_count(L(""))) == 0 and value(text.word_count(L(None).cast("string"))) == 0
    assert [value(text.token_estimate(L("w " * n))) for n in (3, 7, 10)] == [3, 9, 13]


@pytest.mark.parametrize(("given", "want"), [
    ("Which of the following is prime?", "mcq"), ("Prove that 2 is prime.", "proof"), ("True or False: 2 is prime.", "true_false"), ("Is it true that 2 is prime?", "yes_no"), ("Compute 2+2.", "open"),
    ("Find x.\n(A) 1\n(B) 2", "mcq"), ("", "open"), ("go\na - x\nb - y", "mcq"),
])
def test_problem_type(value, given, want):
    assert value(problems.problem_type(L(given))) == want


def test_open_forms(value):
    assert value(problems.strip_choices(L("Find x.\n(A) 1\n(B) 2"))) == "Find x."
    assert value(problems.open_true_false(L("True or false: it rains"))).endswith("\n\nit rains")
    assert value(problems.open_yes_no(L("Can we win? Answer yes or no."))).endswith("\n\nCan we win?")


@pytest.mark.parametrize(("given", "want"), [("2+2=?", False), ("The original problem is: find x", False), ("well-known fact", True), ("Too short", False), ("Let x be 1", True)])
def test_question_like(value, given, want):
    assert value(problems.question_like(L(given))) is want


@pytest.mark.parametrize(("problem", "lines", "domain", "sample", "want"), [
    ("Prove that n is prime", 0, "number_theory", "s", 3), ("Prove that n is prime", 0, "number_theory", "s::d2", 4), ("Compute 2+2", 25, "pre_algebra", "s", 2), ("Compute 2+2", 25, "algebra", "s::d3", 3),
    ("Compute 2+2", 45, "algebra", "s::d3", 4),
])
def test_reasoning_level(value, problem, lines, domain, sample, want):
    assert value(difficulty.reasoning_level(L(problem), L("x\n" * lines), L(domain), L(sample))) == want


@pytest.mark.parametrize(("n", "want"), [(29, "basic"), (30, "elementary"), (60, "intermediate"), (100, "advanced"), (150, "expert"), (0, "intermediate")])
def test_length_label(value, n, want):
    assert value(difficulty.length_label(L("w " * n))) == want


@pytest.mark.parametrize(("hint", "want"), [("easy", 1), ("0", 1), ("3", 3), ("4", 4), ("800", 1), ("1500", 2), ("1501", 3), ("2001", 4), ("", 2), ("odd", 2)])
def test_code_level(value, hint, want):
    assert value(difficulty.code_level(L(hint))) == want


def test_mutations(value):
    mutate = lambda p, s: value(problems.mutate_offline(L(p), L(s), L("geometry")))
    assert mutate("a 1 b", "replace_numbers") == "a 5 b" and mutate("a1b", "replace_numbers") == "a1b" and mutate("p", "combine_problems").endswith("concept from algebra.") and mutate("p", "unheard") is None
    said = L("```text\nRewritten Problem:\nFind x now\n\nDo NOT solve it\nand y too\n```")
    assert value(problems.clean_mutation(said)) == "Find x now\nand y too" and value(problems.clean_mutation(L("short"))) == ""


@pytest.mark.parametrize(("log", "want"), [("1 failed, 4 passed in 0.12s", (4, 1, 0.12)), ("2 error in 0.05s", (0, 2, 0.05)), ("", (0, 0, None))])
def test_logs(value, log, want):
    assert tuple(value(code.test_log(L(log))))[:3] == want


def test_code_blocks(value):
    tagged = L("<|Solution Begin|>\n```python\nx = 1\n```\n<|Solution End|><|Test Begin|>t<|Test End|>")
    s, t = code.code_blocks(tagged)
    assert (value(s), value(t)) == ("x = 1", "t")
    s, t = code.code_blocks(L("none"))
    assert (value(s), value(t)) == ("pass", "")
    s, t = code.strict_code_blocks(L("```python\ndef solve(): pass\ndef test_1(): pass\n```"))
    assert (value(s), value(t)) == ("def solve(): pass", "def test_1(): pass")


def test_safety(value):
    bad = ["os.system('x')", "eval (x)", "open('a', 'w')", "import pickle", "subprocess.run", "f(shell = True)", "__import__('os')"]
    assert not any(value(code.safe(L(b))) for b in bad) and value(code.safe(L("import os\nprint(1)"))) and value(code.safe(L(None).cast("string")))
    assert value(code.violations(L("eval(x)\nexec(y)"))) == [5, 6] and value(code.warnings(L("import os"))) == [1]


def test_pairs_and_test_source(spark):
    df = spark.createDataFrame([(["1", "2"], ["a'", 'b"', "c"]), ([], []), (None, None)], "i array<string>, o array<string>")
    pairs = [r[0] for r in df.select(code.test_pairs("i", "o")).collect()]
    assert [len(p) if p is not None else 0 for p in pairs] == [5, 0, 0] and [tuple(p) for p in pairs[0]][2:] == [("1", "a'")] * 3
    made = df.select(code.test_source("i", "o")).first()[0]
    compile(made, "t", "exec")
    assert 'def test_1(): assert run(\'1\') == "a\'"' in made


def test_domains(value):
    assert value(domains.by_keywords(L("the model of search"), "limo")) == "number_theory" and value(domains.by_keywords(L(""), "limo")) == "algebra"
    assert value(domains.by_path(L("Math -> Data Mining"))) == "data_mining" and value(domains.by_path(L(None).cast("string"))) == "algebra"
    assert value(domains.external_domain(L("a prime"), L("train"))) == "number_theory" and value(domains.external_domain(L("x"), L("mine"))) == "mine"
    assert value(domains.code_domain(L("x"), L("It is Code-Edit bugfix"))) == "code_edit_bugfix"


def test_text_helpers(value):
    assert value(text.fingerprint(L("Abc "))) == value(text.fingerprint(L("abc")))
    assert value(text.clean_contest_markup(L("a $$$n$$$  b\n\n\n\nc $$"))) == "a n b\n\nc" and value(text.truncated(L("x" * 2001))) == "x" * 1997 + "..."
    assert value(text.prompt_id(L(" A/B--c "), L(7), L("q"))).startswith("a_b_c_q0007_")
    q, i, o = text.json_question(L('{"question": " why ", "test": {"input": "1", "output": "2"}}'))
    assert (value(q), value(i), value(o)) == ("why", "1", "2")
    assert value(text.trim_problem(L("a" * 1500 + "\n" + "b" * 900))).startswith("a" * 1500 + "\n[Problem truncated")
    assert value(text.is_model_output(L("  <think>x"))) and not value(text.is_model_output(L("Hello")))
