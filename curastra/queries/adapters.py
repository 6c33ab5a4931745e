"""Curation inputs made from integer columns of the star schema, as SQL that Spark and DuckDB read alike.

The text is the one source of truth for both engines: queries run it in Spark, oracles put it into a CTE. Back-slashes, line
feeds and braces are spelled with chr(), because the two dialects escape them differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread
from ..shipping import importable

BS, NL, LB, RB = "chr(92)", "chr(10)", "chr(123)", "chr(125)"
_BOX = f"{BS} || 'boxed' || {LB}"

SQL = {
    "math_seeds": f"""
SELECT o_orderkey AS ord,
  'seed:' || CAST(o_orderkey % 5000 AS string) AS id,
  CASE o_custkey % 4 WHEN 0 THEN 'numina' WHEN 1 THEN 'limo' WHEN 2 THEN 's1k' ELSE 'aime' END AS source,
  CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'geometry' WHEN 2 THEN 'number_theory' WHEN 3 THEN 'pre_algebra' ELSE 'algebra' END AS domain,
  CASE o_orderkey % 9
    WHEN 0 THEN 'Compute the area of a triangle with base ' || CAST(o_orderkey % 90 + 2 AS string) || ' and height ' || CAST(o_custkey % 50 + 1 AS string) || '.'
    WHEN 1 THEN 'Which of the following is larger than ' || CAST(o_orderkey % 90 + 2 AS string) || '?' || {NL} || '(A) 1' || {NL} || '(B) ' || CAST(o_custkey % 50 + 91 AS string)
    WHEN 2 THEN 'True or False: ' || CAST(o_orderkey % 90 + 2 AS string) || ' is a prime number.'
    WHEN 3 THEN 'Is it possible that ' || CAST(o_orderkey % 90 + 2 AS string) || ' divides ' || CAST(o_custkey % 50 + 1 AS string) || '? Answer yes or no.'
    WHEN 4 THEN 'Prove that the polynomial with roots 1 and ' || CAST(o_custkey % 50 + 1 AS string) || ' is a quadratic.'
    WHEN 5 THEN ''
    WHEN 6 THEN 'The original problem is to find ' || CAST(o_orderkey % 90 + 2 AS string) || ' apples.'
    WHEN 7 THEN 'Add 1 and  2 percent of ' || CAST(o_orderkey % 90 + 2 AS string) || ' to the average speed, then find the ratio of the total for each of the ' || CAST(o_custkey % 50 + 1 AS string) || ' trains'
    ELSE '   hello   world   ' END AS problem,
  CASE o_orderkey % 8
    WHEN 0 THEN 'We add. Thus ' || {_BOX} || '1' || {RB} || ' and ' || {_BOX} || {BS} || 'frac' || {LB} || CAST(o_orderkey % 90 + 2 AS string) || {RB} || {LB} || CAST(o_custkey % 50 + 1 AS string) || {RB} || {RB} || ' holds.'
    WHEN 1 THEN 'First step.' || {NL} || 'The answer is ' || CAST(o_orderkey % 90 + 2 AS string) || '.'
    WHEN 2 THEN 'The cost $' || CAST(o_orderkey % 90 + 2 AS string) || '$ then $' || CAST(o_custkey % 50 + 1 AS string) || '$ is due'
    WHEN 3 THEN 'so ' || {BS} || '(x=' || CAST(o_custkey % 50 + 1 AS string) || {BS} || ')'
    WHEN 4 THEN 'broken ' || {_BOX} || 'a' || {LB} || 'b' || {RB}
    WHEN 5 THEN NULL
    WHEN 6 THEN 'Answer: ' || CAST(o_orderkey % 90 + 2 AS string) || '..'
    ELSE 'a' || {NL} || {NL} || '  b ' || CAST(o_custkey % 50 + 1 AS string) || '  ' END AS solution,
  CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'x = ' || CAST(o_custkey % 50 + 1 AS string) ELSE CAST(o_orderkey % 90 + 2 AS string) END AS answer
FROM __orders__""",
    "generations": f"""
SELECT l_orderkey * 10 + l_linenumber AS ord,
  'model-' || CAST(l_partkey % 3 AS string) AS model_used,
  CASE l_suppkey % 2 WHEN 0 THEN 'LIMO' ELSE 's1K' END AS source,
  'A shop sells ' || CAST(l_partkey % 40 + 3 AS string) || ' boxes, ' || CAST(l_linenumber AS string) || ' per day, at a rate of ' || CAST(l_suppkey % 9 AS string) || ' percent. What is the total for each?' AS problem,
  CASE l_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 'Long text #### ' || CAST(l_partkey % 40 + 3 AS string) WHEN 2 THEN 'seven' ELSE CAST(l_partkey % 40 + 3 AS string) END AS expected_answer,
  CASE (l_orderkey + l_linenumber) % 8
    WHEN 0 THEN '<think>so a+b</think> It is ' || {_BOX} || CAST(l_partkey % 40 + 3 AS string) || {RB}
    WHEN 1 THEN 'long reasoning </thinking> ' || CAST(l_partkey % 40 + 3 AS string)
    WHEN 2 THEN 'No tag here. Final answer: ' || CAST(l_partkey % 40 + 3 AS string)
    WHEN 3 THEN '<think>x = 1</think>' || CAST(l_partkey % 40 + 4 AS string)
    WHEN 4 THEN ''
    WHEN 5 THEN 'thought **' || CAST(l_partkey % 40 + 3 AS string) || '** here'
    WHEN 6 THEN '<THINK a>deep ' || {_BOX} || '1,234' || {RB} || '</THOUGHT>  none'
    ELSE 'nothing to say' END AS generation
FROM __lineitem__""",
    "code_trials": f"""
SELECT 'p' || CAST(p_partkey % 1500 AS string) AS prompt_id, t AS trial_no, p_partkey * 3 + t AS ord, 'trial_' || CAST(t AS string) AS trial,
  CASE (p_partkey + t) % 6 WHEN 1 THEN 'Fail' WHEN 5 THEN 'Error' ELSE 'Pass' END AS result,
  CASE (p_partkey + t) % 6
    WHEN 1 THEN 'FAILED test_solution.py::test_' || CAST(p_size % 5 + 1 AS string) || ' - assert' || {NL} || CAST(p_size % 3 + 1 AS string) || ' failed, ' || CAST(p_size % 5 AS string) || ' passed in 0.12s'
    WHEN 5 THEN CAST(p_size % 3 + 1 AS string) || ' error in 0.05s'
    ELSE CAST(p_size % 5 + 1 AS string) || ' passed in 0.' || CAST(p_size % 10 AS string) || '1s' END AS log,
  CASE (p_partkey + t) % 6
    WHEN 2 THEN 'import os' || {NL} || 'os.system("ls")'
    WHEN 3 THEN 'def solve():' || {NL} || '    f = open("a", "w")'
    WHEN 4 THEN 'import sys' || {NL} || 'def solve():' || {NL} || '    print(' || CAST(p_size AS string) || ')'
    ELSE 'def solve():' || {NL} || '    return ' || CAST(p_size AS string) END AS solution_code,
  'You are given ' || CAST(p_size AS string) || ' cities and the roads between them. Print the length of the shortest path of part ' || p_name AS question,
  CASE p_partkey % 3 WHEN 0 THEN '' ELSE ' We walk the graph of ' || CAST(p_size AS string) || ' nodes. ' END AS think_trace,
  p_size % 5 AS reasoning_level
FROM __part__ CROSS JOIN (VALUES (0), (1), (2)) AS v(t)""",
    "outputs": f"""
SELECT p_partkey AS ord,
  CASE p_partkey % 5
    WHEN 0 THEN '<think>plan</think>' || {NL} || '<|Solution Begin|>' || {NL} || '```python' || {NL} || 'def solve(): pass  # ' || CAST(p_size AS string) || {NL} || '```' || {NL} || '<|Solution End|> and <|Test Begin|>def test_1(): pass<|Test End|>'
    WHEN 1 THEN 'Some preamble ' || CAST(p_size AS string) || ' ```python' || {NL} || 'a = 1' || {NL} || '``` text ```python' || {NL} || 'b = 2' || {NL} || '```'
    WHEN 2 THEN 'Only one ```python' || {NL} || 'c = ' || CAST(p_size AS string) || {NL} || '```'
    WHEN 3 THEN '<think>a</think>b</think>c ' || CAST(p_size AS string)
    ELSE 'no tags at all ' || CAST(p_size AS string) END AS output
FROM __part__""",
    "lookup_rows": """
SELECT l_orderkey * 10 + l_linenumber AS ord, CASE l_linenumber % 3 WHEN 0 THEN 'TACO' WHEN 1 THEN 'apps' ELSE 'other' END AS dataset,
  CASE l_suppkey % 2 WHEN 0 THEN 'train' ELSE 'test' END AS split,
  CASE l_partkey % 10 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL ELSE CAST(l_orderkey AS string) END AS index
FROM __lineitem__""",
    "lookup": """
SELECT CASE o_custkey % 2 WHEN 0 THEN 'taco' ELSE 'apps' END AS dataset, CASE o_orderkey % 2 WHEN 0 THEN 'train' ELSE 'test' END AS split,
  o_orderkey AS position, 'Question number ' || CAST(o_orderkey AS string) AS question
FROM __orders__""",
}
TABLES = ("orders", "lineitem", "part")


def adapter(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The adapter's rows in Spark."""
    importable(spark)
    text = SQL[name]
    used = {t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in TABLES if f"__{t}__" in text}
    for t in used:
        text = text.replace(f"__{t}__", "{" + t + "}")
    return spark.sql(text, **used)


def oracle(body: str, *names: str) -> str:
    """DuckDB SQL with the named adapters as CTEs."""
    ctes = []
    for n in names:
        text = SQL[n]
        for t in TABLES:
            text = text.replace(f"__{t}__", t)
        ctes.append(f"{n} AS ({text})")
    return f"WITH {', '.join(ctes)} {body}" if ctes else body
