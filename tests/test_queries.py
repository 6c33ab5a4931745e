"""Every query that has SQL gives the rows that DuckDB gives."""

import duckdb
import pytest

from curastra.queries import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def shown(v):
    return f"{v:.9g}" if isinstance(v, float) else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_against_sql(name, spark, sf_dir, db):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    result = db.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(name, spark, sf_dir):
    assert catalog.QUERIES[name](spark, sf_dir).count() > 0


NATIVE = ["eval_verify", "math_verify_exact", "boxed_last", "pack_sft", "code_quality", "problem_type", "chunk_contiguous", "evolve_chained", "model_compare"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python_in_their_plan(name, spark, sf_dir):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("EvalPython", "PythonUDF", "InArrow", "InPandas", "CartesianProduct"))


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.schema == __spark_entry__.entry(spark).schema
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


PATTERNS = {"teacher_answers": 260, "eval_verify": 60, "model_summary": 40}


@pytest.mark.parametrize("name", sorted(PATTERNS))
def test_patterns_are_read_once(name, spark, sf_dir):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_") + plan.count("RLIKE(") + plan.count("split(") < PATTERNS[name]


@pytest.mark.parametrize("name", ["model_summary", "model_compare", "eval_verify"])
def test_judging_runs_in_compiled_code(name, spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        execution = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution()
        made = execution.debug().codegenToSeq()
        most = max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # lambdas are interpreted row by row, and the JVM never compiles methods over 8,000 bytes
    assert execution.optimizedPlan().toString().count("lambdafunction(") <= (4 if name == "eval_verify" else 1)
    assert most < 8000
