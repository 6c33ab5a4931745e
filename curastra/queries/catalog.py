"""Every query of the engine outside the corpus operators, with its SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers, code, difficulty, domains, problems, text, thinking
from ..operators import packing, relational as rel, sandbox, semantic
from ..operators.scratch import ensure_checkpoint_dir
from ..plans import evaluation, mathematics
from ..session import spread
from ..sources import registry, sinks
from ..streaming import incremental
from .adapters import adapter, oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, *adapters: str):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = oracle(sql, *adapters)
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# SQL fragments: words, stripped text, and answers, as DuckDB says them
def _words(c: str) -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({c}, ''), '\\s+'), lambda x: x <> ''))"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


def _box(c: str) -> str:
    """Payload of the last box; three levels of braces suffice for the adapters."""
    tail = f"list_extract(string_split({c}, '\\boxed{{'), -1)"
    inner = r"[^{}]|\{(?:[^{}]|\{[^{}]*\})*\}"
    return f"CASE WHEN contains({c}, '\\boxed{{') AND regexp_matches({tail}, '^(?:{inner})*\\}}') THEN {_strip(f'''regexp_extract({tail}, '^((?:{inner})*)\\}}', 1)''')} END"


def _clean(c: str) -> str:
    s = _strip(f"regexp_replace({_strip(c)}, '^`+|`+$', '', 'g')")
    s = f"regexp_replace({s}, '(?i)^\\s*(final\\s+answer|answer|ans)\\s*[:\\-]\\s*', '')"
    s = f"regexp_replace({s}, '(?i)^\\s*(the\\s+)?(final\\s+)?answer\\s+is\\s*[:\\-]?\\s*', '')"
    return _strip(f"regexp_replace({_strip(s)}, '\\.+$', '')")


def _lines(c: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({c}, ''), chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"


def _reference(c: str) -> str:
    raw = _strip(c)
    last = lambda p: f"list_extract(regexp_extract_all({raw}, '{p}', 1), -1)"
    nil = lambda x: f"nullif({x}, '')"
    return (
        f"CASE WHEN {nil(_box(raw))} IS NOT NULL THEN {_clean(_box(raw))} ELSE coalesce("
        + ", ".join([nil(_clean(last(r"(?s)\\\((.*?)\\\)"))), nil(_clean(last(r"(?s)\$(.+?)\$"))), nil(_clean(f"list_extract({_lines(raw)}, -1)")), f"CASE WHEN {raw} <> '' THEN {_clean(raw)} END"])
        + ") END"
    )


def _any(c: str, needles) -> str:
    return "(" + " OR ".join(f"contains({c}, '{n}')" for n in needles) + ")"


def _keywords(c: str, which: str, default: str = "'algebra'", first: int | None = None) -> str:
    low = f"lower(substring(coalesce({c}, ''), 1, {first}))" if first else f"lower(coalesce({c}, ''))"
    return "CASE " + " ".join(f"WHEN {_any(low, ks)} THEN '{label}'" for label, ks in domains.KEYWORDS[which]) + f" ELSE {default} END"


# scans and filters over the corpus tables

_RATES = " + ".join(f"(length(t) - length(replace(t, '{w}', ''))) // {len(w)}" for w in difficulty.RATE_WORDS)
_LEVEL = (
    f"least(CASE WHEN {_words('t')} > 80 THEN 2 WHEN {_words('t')} > 50 THEN 1 ELSE 0 END "
    f"+ CASE WHEN len(regexp_extract_all(t, '\\d+')) > 6 THEN 1 ELSE 0 END + CASE WHEN {_RATES} > 2 THEN 1 ELSE 0 END, 4)::int"
)


@query("doc_difficulty_hist", f"SELECT source, {_LEVEL} AS level, count(*) AS n FROM (SELECT source, lower(text) AS t FROM documents) GROUP BY ALL")
def doc_difficulty_hist(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", difficulty.eval_level("text").alias("level"))
    return docs.groupBy("source", "level").agg(F.count("*").alias("n"))


@query(
    "quality_gate",
    f"SELECT d.doc_id, l.quality, {_words('d.text')}::int AS n_words FROM documents d JOIN labels l USING (doc_id) "
    f"WHERE coalesce(l.quality, 0) >= 1 AND length({_strip('d.text')}) >= 200 AND coalesce(d.lang, 'en') = 'en'",
)
def quality_gate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where((F.coalesce("lang", F.lit("en")) == "en") & (F.length(text.strip("text")) >= 200)).select("doc_id", text.word_count("text").alias("n_words"))
    good = table(spark, sf_dir, "labels").where(F.coalesce("quality", F.lit(0)) >= 1).select("doc_id", "quality")
    return docs.join(good, "doc_id").select("doc_id", "quality", "n_words")


@query("doc_length_label", f"SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'intermediate' WHEN n < 30 THEN 'basic' WHEN n < 60 THEN 'elementary' WHEN n < 100 THEN 'intermediate' WHEN n < 150 THEN 'advanced' ELSE 'expert' END AS label, n::int AS n_words, trunc(n * 1.3::double)::int AS n_tokens FROM (SELECT doc_id, text, {_words('text')} AS n FROM documents)")
def doc_length_label(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", difficulty.length_label("text").alias("label"), text.word_count("text").alias("n_words"), text.token_estimate("text").alias("n_tokens"))


@query("dedup_fingerprint", f"SELECT doc_id, fp FROM (SELECT doc_id, substring(md5({_strip('lower(text)')}), 1, 8) AS fp, row_number() OVER (PARTITION BY substring(md5({_strip('lower(text)')}), 1, 8) ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedup_fingerprint(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.fingerprint("text").alias("fp"))
    return rel.keep_first(docs, ["fp"], ["doc_id"])


_PREFIX = f"md5(substring(regexp_replace({_strip('lower(text)')}, '\\s+', ' ', 'g'), 1, 100))"


@query("dedup_prefix_hash", f"SELECT min(doc_id) AS doc_id, {_PREFIX} AS h, count(*) AS copies FROM documents GROUP BY h")
def dedup_prefix_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", text.prefix_hash("text").alias("h"))
    return docs.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


@query("strip_html_tags", f"SELECT page_id, length({_strip('''regexp_replace(html, '<[^>]+>', '', 'g')''')})::int AS n_chars, md5({_strip('''regexp_replace(html, '<[^>]+>', '', 'g')''')}) AS h FROM pages")
def strip_html_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags("html").alias("t")).select("page_id", F.length("t").alias("n_chars"), F.md5("t").alias("h"))


@query("json_field", "SELECT event_type, sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS total, count(*) AS n FROM events GROUP BY event_type")
def json_field(spark, sf_dir):
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, sf_dir, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.sum("k").alias("total"), F.count("*").alias("n"))


_PROFILE_COLUMNS = (("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"))


@query(
    "schema_profile",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS missing, max(length(CAST({c} AS string)))::int AS longest, min(length(CAST({c} AS string)))::int AS shortest FROM documents" for c, t in _PROFILE_COLUMNS),
)
def schema_profile(spark, sf_dir):
    return registry.profile(table(spark, sf_dir, "documents").select(*[c for c, _ in _PROFILE_COLUMNS]))


@query("raw_question_rows", f"SELECT {_strip('text')} AS question_text, 'team_docs' AS source_name, 'sandbox_verified' AS answer_source FROM documents WHERE length({_strip('text')}) >= 30")
def raw_question_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return registry.raw_questions(docs, "text", "team/docs").select("question_text", "source_name", "answer_source")


# answers


@query("boxed_last", f"SELECT ord, {_box('solution')} AS boxed FROM math_seeds", "math_seeds")
def boxed_last(spark, sf_dir):
    return adapter(spark, sf_dir, "math_seeds").select("ord", answers.boxed_last("solution").alias("boxed"))


@query("boxed_flat", r"SELECT ord, nullif(regexp_extract(solution, '\\boxed\{([^}]+)\}', 1), '') AS first_box, list_extract(regexp_extract_all(solution, '\\boxed\{([^}]+)\}', 1), -1) AS last_box FROM math_seeds", "math_seeds")
def boxed_flat(spark, sf_dir):
    return adapter(spark, sf_dir, "math_seeds").select("ord", answers.boxed_flat_first("solution").alias("first_box"), answers.boxed_flat_last("solution").alias("last_box"))


@query("reference_answer", f"SELECT ord, {_reference('solution')} AS ref, coalesce(nullif({_reference('answer')}, ''), nullif({_reference('solution')}, '')) AS picked FROM math_seeds", "math_seeds")
def reference_answer(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds")
    return rows.select("ord", answers.normalise_reference("solution").alias("ref"), answers.pick_reference(F.col("answer"), F.col("solution")).alias("picked"))


@query(
    "confident_reference",
    f"SELECT ord, CASE WHEN contains(r, '\\boxed{{') OR regexp_matches(r, '(?i)(?:final\\s+answer|answer|ans)\\s*(?:is|:|=)') OR (len({_lines('r')}) = 1 AND {_words(f'list_extract({_lines(chr(114))}, 1)')} <= 6) THEN nullif({_reference('r')}, '') END AS ref FROM (SELECT ord, {_strip('solution')} AS r FROM math_seeds)",
    "math_seeds",
)
def confident_reference(spark, sf_dir):
    return adapter(spark, sf_dir, "math_seeds").select("ord", answers.high_confidence_reference("solution").alias("ref"))


def _normal(c: str) -> str:
    s = _strip(c)
    s = f"CASE WHEN starts_with({s}, '$') AND ends_with({s}, '$') AND length({s}) > 2 THEN {_strip(f'substring({s}, 2, length({s}) - 2)')} ELSE {s} END"
    s = _collapse(f"regexp_replace(replace({s}, '−', '-'), '\\s*,\\s*', ',', 'g')")
    right = _strip(f"list_extract(string_split({s}, '='), -1)")
    return f"CASE WHEN contains({s}, '=') AND NOT starts_with({s}, '\\') AND {right} <> '' THEN {right} ELSE {s} END"


@query("answer_normalise", f"SELECT ord, {_normal('answer')} AS normal FROM math_seeds WHERE answer IS NOT NULL", "math_seeds")
def answer_normalise(spark, sf_dir):
    return adapter(spark, sf_dir, "math_seeds").where("answer IS NOT NULL").select("ord", answers.normalise_compare("answer").alias("normal"))


_EXPECTED = (
    "CASE WHEN regexp_extract({0}, '####\\s*([\\d,\\.]+)', 1) <> '' THEN trim(replace(regexp_extract({0}, '####\\s*([\\d,\\.]+)', 1), ',', '')) "
    "ELSE coalesce(list_extract(regexp_extract_all({0}, '-?\\b\\d+(?:\\.\\d+)?\\b'), -1), trim({0})) END"
)


@query("expected_answer", f"SELECT ord, {_EXPECTED.format('expected_answer')} AS expected FROM generations WHERE expected_answer IS NOT NULL", "generations")
def expected_answer(spark, sf_dir):
    return adapter(spark, sf_dir, "generations").where("expected_answer IS NOT NULL").select("ord", answers.expected_number("expected_answer").alias("expected"))


_SPLIT = """
split AS (SELECT *, lower(generation) AS low, CASE WHEN contains(lower(generation), '</think>') THEN '</think>' WHEN contains(lower(generation), '</thinking>') THEN '</thinking>'
  WHEN contains(lower(generation), '</thought>') THEN '</thought>' END AS tag FROM generations WHERE generation <> ''),
parts AS (SELECT *, CASE WHEN tag IS NULL THEN trim(generation) ELSE trim(regexp_replace(substring(generation, 1, strpos(low, tag) - 1), '(?i)<think[^>]*>', '', 'g')) END AS reasoning,
  CASE WHEN tag IS NULL THEN '' ELSE trim(substring(generation, strpos(low, tag) + length(tag))) END AS after FROM split)
"""
_CASCADE = r"""
coalesce(trim(replace(nullif(regexp_extract(after, '\\boxed\{([^}]+)\}', 1), ''), ',', '')),
  replace(nullif(regexp_extract(after, '\$?\s*(-?\d+(?:[.,]\d+)?(?:/\d+)?)', 1), ''), ',', ''),
  trim(replace(list_extract(regexp_extract_all(why, '\\boxed\{([^}]+)\}', 1), -1), ',', '')),
  replace(nullif(regexp_extract(after || ' ' || why, '(?:[Ff]inal\s+[Aa]nswer|[Tt]he\s+answer\s+is)\s*[:\-=]?\s*\$?\s*(-?\d+(?:\.\d+)?(?:/\d+)?)', 1), ''), ',', ''),
  replace(list_extract(regexp_extract_all(after || ' ' || why, '\*\*\$?(-?[\d,]+\.?\d*)\*\*', 1), -1), ',', ''),
  replace(list_extract(regexp_extract_all(why, '=\s*\$?(-?[\d,]+\.?\d*)\s*(?:\.|$|\n)', 1), -1), ',', ''),
  list_extract(regexp_extract_all(after || ' ' || why, '-?\b\d+(?:\.\d+)?\b'), -1), '')
"""


@query("think_split", f"SELECT ord, reasoning, after FROM parts", "generations")
def think_split(spark, sf_dir):
    reasoning, after = thinking.eval_split("generation")
    return adapter(spark, sf_dir, "generations").where("generation <> ''").select("ord", reasoning.alias("reasoning"), after.alias("after"))


ORACLES["think_split"] = oracle("SELECT ord, reasoning, after FROM parts", "generations").replace(" SELECT ord, reasoning, after FROM parts", f", {_SPLIT} SELECT ord, reasoning, after FROM parts")


def _after_split(body: str) -> str:
    return (f", {_SPLIT}, answered AS (SELECT *, {_CASCADE} AS answer FROM (SELECT *, CASE WHEN tag IS NULL THEN generation ELSE reasoning END AS why FROM parts)), "
        f"judged AS (SELECT *, {_EXPECTED.format('expected_answer')} AS expected FROM answered), "
        "results AS (SELECT *, CASE WHEN coalesce(answer, '') = '' OR coalesce(expected_answer, '') = '' THEN 'unknown' "
        "WHEN regexp_matches(replace(answer, ',', ''), '^[+-]?\\d+(\\.\\d+)?$') AND regexp_matches(replace(expected, ',', ''), '^[+-]?\\d+(\\.\\d+)?$') "
        "THEN CASE WHEN abs(CAST(replace(answer, ',', '') AS DOUBLE) - CAST(replace(expected, ',', '') AS DOUBLE)) < 1e-4 THEN 'pass' ELSE 'fail' END "
        f"WHEN trim(answer) = trim(expected) THEN 'pass' ELSE 'unknown' END AS verification, {_LEVEL.replace('(t,', '(lower(problem),').replace('(t)', '(lower(problem))').replace('coalesce(t,', 'coalesce(lower(problem),')} AS difficulty FROM judged) {body}")  # fmt: skip


def _with_parts(body: str) -> str:
    return oracle("@", "generations").replace(" @", _after_split(body))


def _results(spark, sf_dir):
    return evaluation.results(adapter(spark, sf_dir, "generations"))


@query("eval_answer_cascade")
def eval_answer_cascade(spark, sf_dir):
    return _results(spark, sf_dir).select("ord", "answer")


@query("eval_verify")
def eval_verify(spark, sf_dir):
    return _results(spark, sf_dir).select("ord", "answer", "ground_truth", "verification", "difficulty")


@query("eval_response")
def eval_response(spark, sf_dir):
    return _results(spark, sf_dir).select("ord", "response")


@query("model_summary")
def model_summary(spark, sf_dir):
    return rel.model_summary(_results(spark, sf_dir))


@query("difficulty_breakdown")
def difficulty_breakdown(spark, sf_dir):
    return rel.difficulty_breakdown(_results(spark, sf_dir))


@query("model_compare")
def model_compare(spark, sf_dir):
    return rel.model_comparison(_results(spark, sf_dir), 20)


@query("best_model")
def best_model(spark, sf_dir):
    return rel.best_model(rel.model_comparison(_results(spark, sf_dir), 20))


_COUNTS = "count(*) FILTER (verification = 'pass') AS pass, count(*) FILTER (verification = 'fail') AS fail, count(*) FILTER (verification = 'unknown') AS unknown"
_SUMMARY = f"SELECT model_used AS model, source AS dataset, count(*) AS total, {_COUNTS}, round(100.0::double * count(*) FILTER (verification = 'pass') / count(*), 1) AS pass_pct FROM results GROUP BY ALL"
ORACLES |= {
    "eval_answer_cascade": _with_parts("SELECT ord, answer FROM results"),
    "eval_verify": _with_parts("SELECT ord, answer, CASE WHEN coalesce(expected_answer, '') <> '' THEN expected END AS ground_truth, verification, difficulty FROM results"),
    "eval_response": _with_parts("SELECT ord, '<think>' || reasoning || '</think>' || chr(10) || answer AS response FROM results"),
    "model_summary": _with_parts(_SUMMARY),
    "difficulty_breakdown": _with_parts("SELECT model_used AS model, source AS dataset, difficulty AS level, count(*) AS n FROM results GROUP BY ALL"),
    "model_compare": _with_parts(
        f"SELECT model_used AS model, count(*) AS generated, {_COUNTS}, count(*) AS has_think, (sum(length('<think>' || reasoning || '</think>' || chr(10) || answer)) // count(*))::bigint AS avg_length, "
        "round(100.0::double * count(*) / 20, 0) AS gen_rate, round(100.0::double * count(*) FILTER (verification = 'pass') / count(*), 1) AS pass_rate FROM results GROUP BY ALL"
    ),
    "best_model": _with_parts("SELECT model_used AS model, count(*) FILTER (verification = 'pass') AS pass FROM results GROUP BY ALL ORDER BY pass DESC, model LIMIT 1"),
}


@query("eval_input_rows", "SELECT row_number() OVER (ORDER BY ord) - 1 AS index, problem, 'seeds' AS subdomain, 'team/seeds' AS dataset, coalesce(nullif(answer, ''), nullif(solution, '')) AS expected_answer FROM math_seeds WHERE problem <> ''", "math_seeds")
def eval_input_rows(spark, sf_dir):
    return registry.eval_input(adapter(spark, sf_dir, "math_seeds"), "team/seeds")


@query("resume_anti", "SELECT g.ord FROM generations g ANTI JOIN (SELECT ord FROM generations WHERE ord % 3 = 0) d USING (ord)", "generations")
def resume_anti(spark, sf_dir):
    rows = adapter(spark, sf_dir, "generations").select("ord")
    return rel.resume(rows, rows.where("ord % 3 = 0"), ["ord"])


# mathematics


@query("domain_infer", "SELECT ord, " + ", ".join(f"{_keywords('problem', k, first=800 if k == 'finemath' else None)} AS d_{k}" for k in ("numina", "finemath", "s1k", "limo", "theoremqa", "aime", "calculator", "topic", "external")) + " FROM math_seeds", "math_seeds")
def domain_infer(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds")
    which = ("numina", "finemath", "s1k", "limo", "theoremqa", "aime", "calculator", "topic", "external")
    return rows.select("ord", *[domains.by_keywords("problem", k, first=800 if k == "finemath" else None).alias(f"d_{k}") for k in which])


_MCQ = r"(?im)(?:^|\n)\s*(?:[A-E][.):]\s*.+?){2,}|(?:^|\n)(?:\s*[\(\[]\s*[A-E]\s*[\)\]]\s*.+\n?){2,}|(?:^|\n)(?:\s*[A-E]\s*[.):\-]\s+.+\n?){2,}"
_KIND = (
    f"CASE WHEN coalesce(problem, '') = '' THEN 'open' WHEN regexp_matches(problem, '{_MCQ}') OR regexp_matches(problem, '(?i){problems.MCQ_HINT}') THEN 'mcq' WHEN regexp_matches(problem, '(?i){problems.PROOF}') THEN 'proof' "
    f"WHEN regexp_matches(problem, '(?i){problems.TRUE_FALSE}') THEN 'true_false' WHEN regexp_matches(problem, '(?i){problems.YES_NO}') THEN 'yes_no' ELSE 'open' END"
)


@query("problem_type", f"SELECT ord, {_KIND} AS kind FROM math_seeds", "math_seeds")
def problem_type(spark, sf_dir):
    return adapter(spark, sf_dir, "math_seeds").select("ord", problems.problem_type("problem").alias("kind"))


@query("type_counts", f"SELECT kind, count(*) AS n FROM (SELECT {_KIND} AS kind FROM math_seeds) GROUP BY kind", "math_seeds")
def type_counts(spark, sf_dir):
    return problem_type(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("n"))


_OPEN = (
    f"CASE {_KIND} WHEN 'mcq' THEN {_strip('''CASE WHEN strpos(problem, chr(10) || '(A)') > 0 THEN substring(problem, 1, strpos(problem, chr(10) || '(A)') - 1) ELSE problem END''')} "
    f"WHEN 'true_false' THEN 'Determine whether the following statement is true or false, and provide a full justification:' || chr(10) || chr(10) || {_strip('''regexp_replace(problem, '(?i)^\\s*(?:true or false\\s*[:\\-]?\\s*)', '')''')} "
    f"WHEN 'yes_no' THEN 'Determine whether the following is true or false, and justify your answer:' || chr(10) || chr(10) || {_strip('''regexp_replace(problem, '(?i)\\s*[\\.\\,\\;]?\\s*(?:answer yes or no|answer with yes or no)[\\.!]?\\s*$', '')''')} ELSE coalesce(problem, '') END"
)


@query("open_ended", f"SELECT ord, {_OPEN} AS open_problem FROM math_seeds", "math_seeds")
def open_ended(spark, sf_dir):
    return adapter(spark, sf_dir, "math_seeds").select("ord", problems.open_ended("problem").alias("open_problem"))


_LEAK = "|".join(problems.LEAKS)
_QUESTION = (
    f"(length({_strip('problem')}) >= 8 AND NOT regexp_matches(lower(problem), '{_LEAK}') AND ({_any('lower(problem)', problems.QUESTION_VERBS)} OR contains(problem, '?') OR {_any('problem', problems.QUESTION_SIGNS)}))"
)


@query("question_filter_reasons", f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN NOT {_QUESTION} THEN 'bad_question' WHEN {_collapse('answer')} = '' THEN 'empty_answer' ELSE 'kept' END AS reason FROM math_seeds) GROUP BY reason", "math_seeds")
def question_filter_reasons(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds").select(problems.drop_reason("problem", "answer").alias("reason"))
    return rel.reason_counts(rows, "reason")


@query("dedup_first_id", "SELECT id, ord, problem FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM math_seeds) WHERE rn = 1", "math_seeds")
def dedup_first_id(spark, sf_dir):
    return rel.keep_first(adapter(spark, sf_dir, "math_seeds").select("id", "ord", "problem"), ["id"], ["ord"])


_SECOND = "CASE coalesce(domain, 'algebra') " + " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in domains.COMPLEMENTS.items()) + " ELSE 'geometry' END"
_EVOLVED = (
    "evolved AS (SELECT id || '::evol::' || s || '::d1' AS evolved_id, ord, s AS strategy, problem AS original, CASE s "
    "WHEN 'add_constraint' THEN problem || chr(10) || chr(10) || 'Additional constraint: Provide the final answer in simplest exact form.' "
    "WHEN 'replace_numbers' THEN replace(replace(replace(problem, ' 1 ', ' 2 '), ' 2 ', ' 3 '), ' 3 ', ' 5 ') "
    "WHEN 'shift_type' THEN 'Reframe this as a geometry interpretation of the same core problem:' || chr(10) || problem "
    "WHEN 'increase_steps' THEN 'Solve this in three explicit stages and justify each stage:' || chr(10) || problem "
    f"ELSE problem || chr(10) || chr(10) || 'Additionally, connect your reasoning to one concept from ' || {_SECOND} || '.' END AS problem FROM math_seeds "
    "CROSS JOIN (VALUES " + ", ".join(f"('{s}')" for s in problems.STRATEGIES) + ") AS v(s))"
)


@query("evolve_offline")
def evolve_offline(spark, sf_dir):
    return mathematics.evolve(adapter(spark, sf_dir, "math_seeds"), depth=1).select("evolved_id", "ord", F.col("mutation_strategy").alias("strategy"), "problem")


@query("evolve_chained")
def evolve_chained(spark, sf_dir):
    out = mathematics.evolve(adapter(spark, sf_dir, "math_seeds"), depth=2)
    return out.groupBy("mutation_depth", "mutation_strategy").agg(F.count("*").alias("n"), F.sum(F.length("problem")).alias("chars"))


@query("seed_plus_evolved")
def seed_plus_evolved(spark, sf_dir):
    seeds = adapter(spark, sf_dir, "math_seeds")
    both = rel.union_all(seeds.select(F.col("id").alias("sample_id"), F.lit("seed").alias("source_type"), "problem"), mathematics.evolve(seeds, 1).select(F.col("evolved_id").alias("sample_id"), F.lit("evolved").alias("source_type"), "problem"))
    return both.groupBy("source_type").agg(F.count("*").alias("n"), F.sum(F.length("problem")).alias("chars"))


_D1 = "problem <> '' AND problem <> original"
_CHAIN = (
    "second AS (SELECT e.ord, 2 AS d, s, e.problem AS original, CASE s "
    "WHEN 'add_constraint' THEN e.problem || chr(10) || chr(10) || 'Additional constraint: Provide the final answer in simplest exact form.' "
    "WHEN 'replace_numbers' THEN replace(replace(replace(e.problem, ' 1 ', ' 2 '), ' 2 ', ' 3 '), ' 3 ', ' 5 ') "
    "WHEN 'shift_type' THEN 'Reframe this as a geometry interpretation of the same core problem:' || chr(10) || e.problem "
    "WHEN 'increase_steps' THEN 'Solve this in three explicit stages and justify each stage:' || chr(10) || e.problem "
    f"ELSE e.problem || chr(10) || chr(10) || 'Additionally, connect your reasoning to one concept from ' || {_SECOND.replace('domain', 'm.domain')} || '.' END AS problem "
    "FROM evolved e JOIN math_seeds m USING (ord) CROSS JOIN (VALUES " + ", ".join(f"('{s}')" for s in problems.STRATEGIES) + ") AS v(s) WHERE e.strategy = 'combine_problems')"
)
ORACLES |= {
    "evolve_offline": oracle("@", "math_seeds").replace(" @", f", {_EVOLVED} SELECT evolved_id, ord, strategy, problem FROM evolved WHERE {_D1}"),
    "evolve_chained": oracle("@", "math_seeds").replace(
        " @", f", {_EVOLVED}, {_CHAIN} SELECT 1 AS mutation_depth, strategy AS mutation_strategy, count(*) AS n, sum(length(problem))::bigint AS chars FROM evolved WHERE {_D1} GROUP BY ALL UNION ALL SELECT d, s, count(*), sum(length(problem))::bigint FROM second WHERE {_D1} GROUP BY ALL"
    ),
    "seed_plus_evolved": oracle("@", "math_seeds").replace(
        " @", f", {_EVOLVED} SELECT 'seed' AS source_type, count(*) AS n, sum(length(problem))::bigint AS chars FROM math_seeds UNION ALL SELECT 'evolved', count(*), sum(length(problem))::bigint FROM evolved WHERE {_D1}"
    ),
}


@query("mutation_clean", f"SELECT ord, CASE WHEN length(c) < 10 THEN '' ELSE c END AS cleaned FROM (SELECT ord, {_strip('''list_aggregate(list_filter(string_split(problem || chr(10) || chr(10) || 'Do NOT solve it.', chr(10)), lambda x: trim(x) <> '' AND NOT regexp_matches(x, '(?i)''' + '|'.join(problems.LINE_LEAKS) + '''')), 'string_agg', chr(10))''')} AS c FROM math_seeds)", "math_seeds")
def mutation_clean(spark, sf_dir):
    said = F.concat(F.lit("```text\n### Rewritten Problem:"), F.col("problem"), F.lit("\n\nDo NOT solve it.\n```"))
    return adapter(spark, sf_dir, "math_seeds").select("ord", problems.clean_mutation(said).alias("cleaned"))


ORACLES["mutation_clean"] = ORACLES["mutation_clean"].replace("THEN '' ELSE c END", "OR c IS NULL THEN '' ELSE c END")


@query("math_final_record")
def math_final_record(spark, sf_dir):
    """The curation plan without a teacher: converted, traced from the seeds' own solutions (the fallback path), verified,
    wrong ones rejected, tagged, made records, filtered. ``teacher_answers`` and ``evolve_chained`` cover the other steps."""
    return mathematics.run(adapter(spark, sf_dir, "math_seeds"))


@query("math_verify_exact", f"SELECT verified, method, count(*) AS n FROM (SELECT CASE WHEN coalesce(nullif(a, ''), nullif(r, '')) IS NULL OR nullif(a, '') IS NULL OR nullif(r, '') IS NULL THEN NULL WHEN {_normal('a')} = {_normal('r')} THEN true WHEN regexp_matches({_normal('a')}, '^-?\\d+(\\.\\d+)?$') AND regexp_matches({_normal('r')}, '^-?\\d+(\\.\\d+)?$') THEN abs({_normal('a')}::double - {_normal('r')}::double) < 1e-6 END AS verified, CASE WHEN nullif(a, '') IS NULL OR nullif(r, '') IS NULL THEN 'none' WHEN {_normal('a')} = {_normal('r')} THEN 'exact_match' WHEN regexp_matches({_normal('a')}, '^-?\\d+(\\.\\d+)?$') AND regexp_matches({_normal('r')}, '^-?\\d+(\\.\\d+)?$') THEN 'numeric' ELSE 'none' END AS method FROM (SELECT answer AS r, CASE WHEN ord % 4 = 0 THEN '$' || answer || '$' WHEN ord % 4 = 1 THEN answer || '.0' WHEN ord % 4 = 2 THEN 'y = 7' ELSE 'unclear' END AS a FROM math_seeds)) GROUP BY ALL".replace("~", ""), "math_seeds")
def math_verify_exact(spark, sf_dir):
    k = F.col("ord") % 4
    said = F.when(k == 0, F.concat(F.lit("$"), F.col("answer"), F.lit("$"))).when(k == 1, F.concat(F.col("answer"), F.lit(".0"))).when(k == 2, "y = 7").otherwise("unclear")
    verified, method = answers.verify("answer", said)
    return adapter(spark, sf_dir, "math_seeds").select(verified.alias("verified"), method.alias("method")).groupBy("verified", "method").agg(F.count("*").alias("n"))


_TRI = "CASE ord % 5 WHEN 0 THEN NULL WHEN 1 THEN false ELSE true END"


@query("tri_state_counts", f"SELECT count(*) FILTER (v) AS correct, count(*) FILTER (NOT v) AS wrong, count(*) FILTER (v IS NULL) AS no_ref, count(*) AS total FROM (SELECT {_TRI} AS v FROM math_seeds)", "math_seeds")
def tri_state_counts(spark, sf_dir):
    v = F.when(F.col("ord") % 5 == 1, F.lit(False)).when(F.col("ord") % 5 > 1, F.lit(True))
    return rel.tri_state(adapter(spark, sf_dir, "math_seeds").select(v.alias("v")), "v")


@query("rejection_sample", f"SELECT ord FROM (SELECT ord, {_TRI} AS v FROM math_seeds) WHERE v IS NOT FALSE", "math_seeds")
def rejection_sample(spark, sf_dir):
    v = F.when(F.col("ord") % 5 == 1, F.lit(False)).when(F.col("ord") % 5 > 1, F.lit(True))
    return rel.reject_wrong(adapter(spark, sf_dir, "math_seeds").select("ord", v.alias("v")), "v").select("ord")


_TAG = (
    f"SELECT ord, CASE WHEN raw >= 4 AND NOT adv AND steps < 30 THEN 3 ELSE least(raw, 4) END::int AS level FROM (SELECT *, greatest(base, CASE WHEN adv THEN 3 WHEN mid THEN 2 ELSE 1 END) + CASE WHEN steps > 40 THEN 2 WHEN steps > 20 THEN 1 ELSE 0 END + (ord % 4 > 1)::int * (ord % 4 - 1) AS raw FROM "
    f"(SELECT ord, len({_lines('repeat(' + chr(39) + 'step ' + chr(39) + ' || chr(10), (ord % 50)::int)')}) AS steps, regexp_matches(coalesce(problem, ''), '{difficulty.ADVANCED}') AS adv, regexp_matches(coalesce(problem, ''), '{difficulty.INTERMEDIATE}') AS mid, "
    + "CASE coalesce(domain, 'algebra') " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in difficulty.DOMAIN_BASE.items()) + " ELSE 1 END AS base FROM math_seeds))"
)


def _tagged(spark, sf_dir):
    trace = F.expr("repeat('step \n', int(ord % 50))")
    sample = F.when(F.col("ord") % 4 == 0, F.col("id")).otherwise(F.concat("id", F.lit("::d"), (F.col("ord") % 4).cast("string")))
    return adapter(spark, sf_dir, "math_seeds").select("ord", difficulty.reasoning_level("problem", trace, "domain", sample).alias("level"))


@query("reasoning_tag", _TAG, "math_seeds")
def reasoning_tag(spark, sf_dir):
    return _tagged(spark, sf_dir)


@query("level_hist_zero_filled", f"SELECT l AS level, count(t.ord) AS n FROM (VALUES (0), (1), (2), (3), (4)) AS v(l) LEFT JOIN ({_TAG}) t ON t.level = v.l GROUP BY l", "math_seeds")
def level_hist_zero_filled(spark, sf_dir):
    return rel.filled_histogram(_tagged(spark, sf_dir), "level", range(5))


@query("mode_domain", "SELECT domain, count(*) AS n FROM math_seeds GROUP BY domain ORDER BY n DESC, min(ord) LIMIT 1", "math_seeds")
def mode_domain(spark, sf_dir):
    return rel.mode_first(adapter(spark, sf_dir, "math_seeds"), "domain", "ord")


@query("per_source_model", "SELECT ord, CASE source WHEN 'aime' THEN 'model-a' WHEN 'limo' THEN 'model-l' ELSE 'teacher' END AS model FROM math_seeds", "math_seeds")
def per_source_model(spark, sf_dir):
    config = spark.createDataFrame([("aime", "model-a"), ("limo", "model-l")], "source string, model string")
    return rel.with_config(adapter(spark, sf_dir, "math_seeds").select("ord", "source"), config, "source", "model", "teacher").select("ord", "model")


@query("chunk_contiguous", "SELECT (rn - 1) // ceil(total / 7.0)::bigint AS chunk_id, count(*) AS n, min(ord) AS lo, max(ord) AS hi FROM (SELECT ord, row_number() OVER (ORDER BY ord) AS rn, count(*) OVER () AS total FROM math_seeds) GROUP BY ALL", "math_seeds")
def chunk_contiguous(spark, sf_dir):
    rows = rel.contiguous_chunk(adapter(spark, sf_dir, "math_seeds").select("ord"), ["ord"], 7)
    return rows.groupBy("chunk_id").agg(F.count("*").alias("n"), F.min("ord").alias("lo"), F.max("ord").alias("hi"))


@query("chunk_modulo", "SELECT ord FROM math_seeds WHERE ord % 8 = 3", "math_seeds")
def chunk_modulo(spark, sf_dir):
    return rel.modulo_chunk(adapter(spark, sf_dir, "math_seeds").select("ord"), "ord", 8, 3)


@query("limit_after_filter", "SELECT ord FROM math_seeds WHERE problem <> '' ORDER BY ord LIMIT 100", "math_seeds")
def limit_after_filter(spark, sf_dir):
    return rel.first_n(adapter(spark, sf_dir, "math_seeds").where("problem <> ''").select("ord"), ["ord"], 100)


@query("offset_before_filter", "SELECT ord FROM (SELECT * FROM math_seeds ORDER BY ord LIMIT 100 OFFSET 50) WHERE problem <> ''", "math_seeds")
def offset_before_filter(spark, sf_dir):
    return rel.first_n(adapter(spark, sf_dir, "math_seeds"), ["ord"], 100, 50).where("problem <> ''").select("ord")


@query("flag_batch", "SELECT ord, rn <= 150 AS chosen FROM (SELECT ord, row_number() OVER (ORDER BY ord) AS rn FROM math_seeds)", "math_seeds")
def flag_batch(spark, sf_dir):
    return rel.flag_first(adapter(spark, sf_dir, "math_seeds").select("ord"), ["ord"], 150)


@query("longest_solution", "SELECT ord, CASE WHEN length(a) >= greatest(length(b), length(c)) THEN a WHEN length(b) >= length(c) THEN b ELSE c END AS best FROM (SELECT ord, coalesce(" + _strip("problem") + ", '') AS a, coalesce(" + _strip("solution") + ", '') AS b, coalesce(" + _strip("answer") + ", '') AS c FROM math_seeds) WHERE a || b || c <> ''", "math_seeds")
def longest_solution(spark, sf_dir):
    best = rel.longest(F.array("problem", "solution", "answer"))
    return adapter(spark, sf_dir, "math_seeds").select("ord", best.alias("best")).where("best IS NOT NULL")


@query("conditional_filter", "SELECT 'some' AS which, count(*) AS n FROM math_seeds WHERE source = 'aime' UNION ALL SELECT 'none', count(*) FROM math_seeds", "math_seeds")
def conditional_filter(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds").select("source")
    some, none = (rel.keep_unless_none(rows, F.col("source") == s).agg(F.count("*").alias("n")) for s in ("aime", "nowhere"))
    return some.select(F.lit("some").alias("which"), "n").unionAll(none.select(F.lit("none"), "n"))


@query("sources_registry", "SELECT source, count(*) AS n FROM (SELECT source FROM math_seeds WHERE problem IS NOT NULL AND " + _strip("problem") + " <> '' AND source IN ('numina', 'limo', 'aime') UNION ALL SELECT 's1k' FROM math_seeds WHERE source = 's1k' AND " + _strip("problem") + " <> '' AND ord % 2 = 0) GROUP BY source", "math_seeds")
def sources_registry(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds").withColumn("question", F.col("problem"))
    tables = {k: rows.where(F.col("source") == k) for k in ("numina", "limo", "aime", "s1k")}
    tables["s1k"] = tables["s1k"].withColumn("cot_type", F.when(F.col("ord") % 2 == 0, "math").otherwise("crossword"))
    seeds = registry.load(spark, {"numina": {}, "limo": {"repo_id": "ignored"}, "aime": {}, "s1k": {}, "omni": {"enabled": False}, "unheard": {}}, tables)
    return seeds.groupBy("source").agg(F.count("*").alias("n"))


# code


@query("safety_scan", "SELECT ord, NOT (" + " OR ".join(f"regexp_matches(solution_code, '{p.replace(chr(39), chr(39) * 2)}')" for p in code.BANNED) + ") AS safe, (" + " + ".join(f"regexp_matches(solution_code, '{p}')::int" for p in code.WARNINGS) + ")::int AS n_warnings FROM code_trials", "code_trials")
def safety_scan(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", code.safe("solution_code").alias("safe"), F.size(code.warnings("solution_code")).alias("n_warnings"))


@query("syntax_valid", "SELECT ord, true AS valid FROM code_trials", "code_trials")
def syntax_valid(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", code.syntax_valid("solution_code").alias("valid"))


_LOG = (
    "coalesce(nullif(regexp_extract(log, '(\\d+) passed', 1), '')::int, 0) AS tests_passed, coalesce(nullif(regexp_extract(log, '(\\d+) failed', 1), '')::int, nullif(regexp_extract(log, '(\\d+) error', 1), '')::int, 0) AS tests_failed"
)


@query("pytest_log", f"SELECT ord, {_LOG}, nullif(regexp_extract(log, 'in\\s+([\\d.]+)s', 1), '')::double AS seconds, nullif(regexp_extract(log, 'FAILED\\s+test_solution\\.py::(test_\\w+)', 1), '') AS failed_test FROM code_trials", "code_trials")
def pytest_log(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", code.test_log("log").alias("x")).select("ord", "x.*")


_UNSAFE = "(" + " OR ".join(f"regexp_matches(solution_code, '{p.replace(chr(39), chr(39) * 2)}')" for p in code.BANNED) + ")"
_PACK = f"packed AS (SELECT *, CASE WHEN result <> 'Pass' THEN 'pytest ' || result WHEN {_UNSAFE} THEN 'safety_violation' END AS reason FROM code_trials)"
_PACK_COLUMNS = f"prompt_id, trial, question AS \"Question\", CASE WHEN trim(think_trace) = '' THEN '' ELSE '<think>' || chr(10) || trim(think_trace) || chr(10) || '</think>' END AS \"<Think>\", solution_code AS \"Answer\", reasoning_level AS \"Difficulty level\", trunc({_words('question')} * 1.3::double)::int AS \"Number of tokens in Question\", trunc({_words('solution_code')} * 1.3::double)::int AS \"Number of tokens in Answer\""
_PICK = ("prompt_id", "trial", "Question", "<Think>", "Answer", "Difficulty level", "Number of tokens in Question", "Number of tokens in Answer")


def _packs(body: str) -> str:
    return oracle("@", "code_trials").replace(" @", f", {_PACK} {body}")


@query("pack_rl")
def pack_rl(spark, sf_dir):
    return packing.pack_rl(adapter(spark, sf_dir, "code_trials")).select(*_PICK)


@query("pack_sft")
def pack_sft(spark, sf_dir):
    rows = adapter(spark, sf_dir, "code_trials").withColumn("trial", F.concat_ws("-", "trial", F.lpad(F.col("ord").cast("string"), 12, "0")))
    return packing.pack_sft(rows).select(*_PICK)


@query("pack_rejected")
def pack_rejected(spark, sf_dir):
    return packing.pack_rejected(adapter(spark, sf_dir, "code_trials"))


@query("pack_counts")
def pack_counts(spark, sf_dir):
    return packing.pack_counts(adapter(spark, sf_dir, "code_trials")).drop("pass_rate")


ORACLES |= {
    "pack_rl": _packs(f"SELECT {_PACK_COLUMNS} FROM packed WHERE reason IS NULL"),
    "pack_sft": _packs(
        f"SELECT {_PACK_COLUMNS} FROM (SELECT * REPLACE (trial || '-' || lpad(CAST(ord AS string), 12, '0') AS trial), row_number() OVER (PARTITION BY prompt_id ORDER BY trial || '-' || lpad(CAST(ord AS string), 12, '0')) AS rn FROM packed WHERE reason IS NULL) WHERE rn = 1"
    ),
    "pack_rejected": _packs(f"SELECT prompt_id, trial, reason AS rejection_reason, {_LOG} FROM packed WHERE reason IS NOT NULL"),
    "pack_counts": _packs(f"SELECT count(*) AS total, count(*) FILTER (reason IS NULL) AS accepted, count(*) FILTER (reason IS NOT NULL) AS rejected, count(*) FILTER ({_UNSAFE}) AS safety_blocked, count(DISTINCT prompt_id) FILTER (reason IS NULL) AS sft_unique FROM packed"),
}


@query("run_status", "SELECT count(*) AS total, count(*) FILTER (result = 'Pass') AS passed, count(*) FILTER (result = 'Fail') AS failed, count(*) FILTER (result NOT IN ('Pass', 'Fail')) AS errors, (count(*) FILTER (result = 'Pass') * 100 // count(*))::bigint AS pass_pct FROM code_trials", "code_trials")
def run_status(spark, sf_dir):
    return rel.run_status(adapter(spark, sf_dir, "code_trials"))


@query("log_tail", "SELECT ord, list_aggregate(list_slice(string_split(log, chr(10)), -1, -1), 'string_agg', chr(10)) AS tail FROM code_trials", "code_trials")
def log_tail(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", F.array_join(code.log_tail("log", 1), "\n").alias("tail"))


@query("prompt_ids", "SELECT ord, 'team_2_code_q' || lpad(CAST(row_number() OVER (PARTITION BY result ORDER BY ord) AS string), CASE WHEN row_number() OVER (PARTITION BY result ORDER BY ord) > 9999 THEN length(CAST(row_number() OVER (PARTITION BY result ORDER BY ord) AS string))::int ELSE 4 END, '0') || '_' || substring(md5(substring(question, 1, 100)), 1, 4) AS prompt_id FROM code_trials", "code_trials")
def prompt_ids(spark, sf_dir):
    rows = rel.running_index(adapter(spark, sf_dir, "code_trials"), "result", "ord", "i")
    return rows.select("ord", text.prompt_id(F.lit(" Team/2--Code!"), "i", "question").alias("prompt_id"))


@query("code_quality", f"SELECT ord, CASE WHEN length(question) < 80 THEN 'reject' WHEN regexp_matches(lower(question), '{'|'.join(problems.NOT_CODE)}') THEN 'reject' WHEN {_any('lower(question)', problems.CONTEST_PHRASES)} THEN 'accept' WHEN NOT {_any('lower(question)', problems.CODE_WORDS)} THEN 'reject' ELSE 'ask' END AS verdict FROM code_trials", "code_trials")
def code_quality(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", problems.code_quality("question").alias("verdict"))


@query("code_domain", f"SELECT ord, {_keywords('output', 'code', chr(39) + 'competitive_programming' + chr(39))} AS label FROM outputs", "outputs")
def code_domain(spark, sf_dir):
    return adapter(spark, sf_dir, "outputs").select("ord", domains.code_domain("output").alias("label"))


_HINT = "CASE ord % 7 WHEN 0 THEN 'Easy' WHEN 1 THEN 'moderate' WHEN 2 THEN 'hard' WHEN 3 THEN 'expert' WHEN 4 THEN CAST(ord % 3000 AS string) WHEN 5 THEN '' ELSE NULL END"


@query("difficulty_hint", f"SELECT ord, CASE WHEN h IN ('easy', 'beginner', '0', '1') THEN 1 WHEN h IN ('medium', 'moderate', '2') THEN 2 WHEN h IN ('hard', 'difficult', '3') THEN 3 WHEN h IN ('expert', '4') THEN 4 WHEN regexp_matches(h, '^\\d+$') THEN CASE WHEN h::int <= 1000 THEN 1 WHEN h::int <= 1500 THEN 2 WHEN h::int <= 2000 THEN 3 ELSE 4 END ELSE 2 END::int AS level FROM (SELECT ord, lower({_HINT}) AS h FROM code_trials)", "code_trials")
def difficulty_hint(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", difficulty.code_level(F.expr(_HINT)).alias("level"))


_SOL, _TEST = r"(?is)<\|Solution Begin\|>(.*?)<\|Solution End\|>", r"(?is)<\|Test Begin\|>(.*?)<\|Test End\|>"


def _unfence(c: str) -> str:
    return _strip(f"regexp_replace(regexp_replace({_strip(c)}, '^```python\\s*', ''), '```\\s*$', '')")


_FENCED = "regexp_extract_all(output, '(?is)```python(.*?)```', 1)"


@query("block_extract", f"SELECT ord, CASE WHEN regexp_matches(output, '{_SOL}') AND regexp_matches(output, '{_TEST}') THEN {_unfence(f'''regexp_extract(output, '{_SOL}', 1)''')} WHEN len({_FENCED}) > 0 THEN {_strip(f'list_extract({_FENCED}, 1)')} ELSE 'pass' END AS solution, CASE WHEN regexp_matches(output, '{_SOL}') AND regexp_matches(output, '{_TEST}') THEN {_unfence(f'''regexp_extract(output, '{_TEST}', 1)''')} WHEN len({_FENCED}) > 1 THEN {_strip(f'list_extract({_FENCED}, -1)')} ELSE '' END AS tests FROM outputs", "outputs")
def block_extract(spark, sf_dir):
    solution, tests = code.code_blocks("output")
    return adapter(spark, sf_dir, "outputs").select("ord", solution.alias("solution"), tests.alias("tests"))


@query(
    "think_variants",
    f"SELECT ord, {_strip('''regexp_extract(output, '(?is)<think>(.*?)</think>', 1)''')} AS block, CASE WHEN contains(lower(output), '</think>') THEN {_strip('''list_extract(string_split(output, '</think>'), -1)''')} ELSE output END AS tail, "
    f"CASE WHEN regexp_matches(output, '(?is)<think>.*?</think>') THEN regexp_extract(output, '(?is)(<think>.*?</think>)', 1) ELSE '<think>' || chr(10) || {_strip('output')} || chr(10) || '</think>' END AS tagged, "
    f"CASE WHEN regexp_matches(output, '(?is)<think>.*?</think>') THEN {_strip('''regexp_extract(output, '(?is)<think>(.*?)</think>', 1)''')} WHEN contains(output, '```python') THEN {_strip('''list_extract(string_split(output, '```python'), 1)''')} ELSE 'No reasoning found.' END AS preamble FROM outputs",
    "outputs",
)
def think_variants(spark, sf_dir):
    c = "output"
    return adapter(spark, sf_dir, "outputs").select("ord", thinking.think_block(c).alias("block"), thinking.after_think(c).alias("tail"), thinking.think_with_tags(c).alias("tagged"), thinking.think_or_preamble(c).alias("preamble"))


@query("question_lookup", "SELECT r.ord, l.question FROM lookup_rows r JOIN lookup l ON lower(r.dataset) = l.dataset AND r.split = l.split AND try_cast(r.index AS BIGINT) = l.position", "lookup_rows", "lookup")
def question_lookup(spark, sf_dir):
    return rel.question_lookup(adapter(spark, sf_dir, "lookup_rows"), adapter(spark, sf_dir, "lookup")).select("ord", "question")


@query("deficit_plan", "SELECT t AS topic, d::int AS difficulty, 400 - coalesce(n, 0) AS needed FROM (VALUES ('numina'), ('limo'), ('s1k'), ('aime'), ('empty')) AS a(t) CROSS JOIN (VALUES (1), (2), (3), (4), (5)) AS b(d) LEFT JOIN (SELECT source, (ord % 5 + 1)::int AS k, count(*) AS n FROM math_seeds WHERE ord % 3 > 0 GROUP BY ALL) h ON h.source = t AND h.k = d WHERE 400 - coalesce(n, 0) > 0", "math_seeds")
def deficit_plan(spark, sf_dir):
    have = adapter(spark, sf_dir, "math_seeds").where("ord % 3 > 0").select(F.col("source").alias("topic"), (F.col("ord") % 5 + 1).cast("int").alias("difficulty"))
    topics = spark.createDataFrame([(t,) for t in ("numina", "limo", "s1k", "aime", "empty")], "topic string")
    return rel.deficit(topics, spark.createDataFrame([(i,) for i in range(1, 6)], "difficulty int"), have, 400)


@query("seed_variant_stats", "SELECT prompt_id, count(*) AS problems, count(*) FILTER (result = 'Pass') AS verified, count(*) FILTER (result <> 'Pass') AS rejected, count(*) FILTER (result = 'Pass') / count(*)::double AS accept_rate FROM code_trials GROUP BY prompt_id", "code_trials")
def seed_variant_stats(spark, sf_dir):
    rows = adapter(spark, sf_dir, "code_trials").withColumn("reason", F.when(F.col("result") != "Pass", F.col("result")))
    return rel.seed_stats(rows, "prompt_id", "reason")


# chats


@query("messages_nested", "SELECT conv_id, count(*)::int AS n_messages, string_agg(role || ':' || text, '|' ORDER BY turn) AS joined FROM conversations GROUP BY conv_id")
def messages_nested(spark, sf_dir):
    chats = registry.nest_chats(table(spark, sf_dir, "conversations"))
    return chats.select("conv_id", F.size("messages").alias("n_messages"), F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["role"], m["content"])), "|").alias("joined"))


@query("first_user_turn", "SELECT conv_id, coalesce(arg_min(text, turn) FILTER (role = 'user'), list_extract(list(text ORDER BY turn), 2), '') AS question FROM conversations GROUP BY conv_id")
def first_user_turn(spark, sf_dir):
    return registry.nest_chats(table(spark, sf_dir, "conversations")).select("conv_id", code.first_user("messages").alias("question"))


@query("token_budget", "SELECT conv_id, (sum(length(text)) // 4 + 10 * count(*))::int AS estimate, greatest(512, least(65536 - (sum(length(text)) // 4 + 10 * count(*)) - 200, 8192))::int AS budget FROM conversations GROUP BY conv_id")
def token_budget(spark, sf_dir):
    return registry.nest_chats(table(spark, sf_dir, "conversations")).select("conv_id", text.chat_tokens("messages").alias("estimate"), text.completion_budget("messages").alias("budget"))


@query("calculator_rows", f"SELECT conv_id, {_strip('''regexp_replace(q, '<[^>]+>', '', 'g')''')} AS problem, {_keywords(_strip('q'), 'calculator')} AS domain FROM (SELECT conv_id, arg_min(text, turn) FILTER (role = 'user') AS q FROM conversations GROUP BY conv_id) WHERE q IS NOT NULL AND {_strip('''regexp_replace(q, '<[^>]+>', '', 'g')''')} <> ''")
def calculator_rows(spark, sf_dir):
    chats = registry.nest_chats(table(spark, sf_dir, "conversations")).withColumn("ord", F.col("conv_id"))
    return registry.calculator(chats).select(F.col("ord").alias("conv_id"), "problem", "domain")


# vectors


@query("semantic_dedup")
def semantic_dedup(spark, sf_dir):
    """Greedy removal at a cosine of 0.35: at the usual 0.92 these vectors have no pair at all."""
    return semantic.semantic_dedup(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", 0.35).select("vec_id")


@query("similar_pairs", "SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND list_dot_product(a.embedding::double[], b.embedding::double[]) / (sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) * sqrt(list_dot_product(b.embedding::double[], b.embedding::double[]))) > 0.35")
def similar_pairs(spark, sf_dir):
    return semantic.similar_pairs(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.35)


# further text operators


@query("by_path", "SELECT ord, CASE WHEN contains(lower(p), 'geometry') THEN 'geometry' WHEN contains(lower(p), 'number theory') THEN 'number_theory' WHEN contains(lower(p), 'algebra') THEN 'algebra' ELSE 'data_mining' END AS label FROM (SELECT ord, CASE ord % 4 WHEN 0 THEN 'Mathematics -> Plane Geometry' WHEN 1 THEN 'Mathematics -> Number Theory -> Primes' WHEN 2 THEN 'Mathematics -> Algebra' ELSE 'Mathematics -> Data Mining -> Other' END AS p FROM math_seeds)", "math_seeds")
def by_path(spark, sf_dir):
    p = F.expr("CASE ord % 4 WHEN 0 THEN 'Mathematics -> Plane Geometry' WHEN 1 THEN 'Mathematics -> Number Theory -> Primes' WHEN 2 THEN 'Mathematics -> Algebra' ELSE 'Mathematics -> Data Mining -> Other' END")
    return adapter(spark, sf_dir, "math_seeds").select("ord", domains.by_path(p).alias("label"))


@query("category_maps", "SELECT ord, CASE ord % 4 WHEN 0 THEN 'pre_algebra' WHEN 1 THEN 'number_theory' WHEN 2 THEN 'intermediate_algebra' ELSE 'algebra' END AS by_type, CASE ord % 4 WHEN 0 THEN 'algebra' WHEN 1 THEN 'number_theory' WHEN 2 THEN 'algebra' ELSE 'algebra' END AS by_topic FROM math_seeds", "math_seeds")
def category_maps(spark, sf_dir):
    t = F.expr("CASE ord % 4 WHEN 0 THEN ' Counting & Probability' WHEN 1 THEN 'Number Theory' WHEN 2 THEN 'precalculus ' ELSE NULL END")
    return adapter(spark, sf_dir, "math_seeds").select("ord", domains.by_map(t, domains.TYPE_LABELS).alias("by_type"), domains.by_map(t, domains.TOPIC_LABELS).alias("by_topic"))


@query("domain_hints", f"SELECT ord, CASE WHEN domain IS NOT NULL AND ord % 3 = 0 THEN domain ELSE {_keywords('problem', 'external')} END AS hinted, CASE WHEN {_any(chr(39) + chr(39) + ' || lower(problem)', ['probability', 'ber', 'snr', 'noise', 'signal'])} THEN 'intermediate_algebra' WHEN ord % 5 = 0 THEN 'intermediate_algebra' ELSE 'algebra' END AS tele FROM math_seeds", "math_seeds")
def domain_hints(spark, sf_dir):
    hint = F.when(F.col("ord") % 3 == 0, F.col("domain")).otherwise("train")
    tele = domains.telemath_domain("problem", F.when(F.col("ord") % 5 == 0, " Advanced"))
    return adapter(spark, sf_dir, "math_seeds").select("ord", domains.external_domain("problem", hint).alias("hinted"), tele.alias("tele"))


_SECTIONED = "'Sure.' || chr(10) || 'QUESTION: ' || coalesce(problem, '') || chr(10) || 'Solution:' || chr(10) || repeat('step ', (ord % 20)::int) || chr(10) || 'final answer: ' || coalesce(answer, '') || chr(10) || 'Bye'"


@query(
    "generated_sections",
    f"SELECT ord, q AS question, s AS solution, a AS answer, CASE WHEN length(q) < 20 THEN 'question too short' WHEN length(s) < 50 THEN 'solution too short' WHEN length(a) = 0 THEN 'no answer extracted' END AS reason FROM (SELECT ord, {_strip('''regexp_extract(t, '(?is)QUESTION:\\s*(.*?)(?:SOLUTION:|$)', 1)''')} AS q, {_strip('''regexp_extract(t, '(?is)SOLUTION:\\s*(.*?)(?:FINAL ANSWER:|$)', 1)''')} AS s, coalesce(list_extract({_lines('''regexp_extract(t, '(?is)FINAL ANSWER:\\s*(.*)$', 1)''')}, 1), '') AS a FROM (SELECT ord, {_SECTIONED} AS t FROM math_seeds))",
    "math_seeds",
)
def generated_sections(spark, sf_dir):
    t = F.concat(F.lit("Sure.\nQUESTION: "), F.coalesce("problem", F.lit("")), F.lit("\nSolution:\n"), F.expr("repeat('step ', int(ord % 20))"), F.lit("\nfinal answer: "), F.coalesce("answer", F.lit("")), F.lit("\nBye"))
    q, s, a = problems.sections(t)
    rows = adapter(spark, sf_dir, "math_seeds").select("ord", q.alias("question"), s.alias("solution"), a.alias("answer"))
    return rows.withColumn("reason", problems.invalid_reason("question", "solution", "answer"))


@query("single_problem", f"SELECT ord, CASE WHEN length(p) > 50 THEN p WHEN length(w) > 100 THEN w ELSE '' END AS problem FROM (SELECT ord, {_strip('''regexp_extract(t, '(?is)PROBLEM\\s*:\\s*(.*)', 1)''')} AS p, {_strip('t')} AS w FROM (SELECT ord, repeat('Well. ', (ord % 20)::int) || CASE ord % 3 WHEN 0 THEN '' ELSE 'Problem : ' END || problem AS t FROM math_seeds))", "math_seeds")
def single_problem(spark, sf_dir):
    t = F.concat(F.expr("repeat('Well. ', int(ord % 20))"), F.when(F.col("ord") % 3 == 0, "").otherwise("Problem : "), "problem")
    return adapter(spark, sf_dir, "math_seeds").select("ord", problems.single_problem(t).alias("problem"))


@query("trim_problem", "SELECT doc_id, length(t)::int AS n, md5(t) AS h FROM (SELECT doc_id, CASE WHEN length(text) <= 1800 THEN text ELSE " + _strip("substring(text, 1, CASE WHEN strpos(head, chr(10)) > 0 AND 1800 - strpos(reverse(head), chr(10)) >= 1400 THEN 1800 - strpos(reverse(head), chr(10)) WHEN strpos(head, '.') > 0 AND 1800 - strpos(reverse(head), '.') >= 1400 THEN 1800 - strpos(reverse(head), '.') ELSE 1800 END + 1)") + " || chr(10) || '[Problem truncated — implement based on the above description]' END AS t FROM (SELECT doc_id, text, substring(text, 1, 1800) AS head FROM documents))")
def trim_problem(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.trim_problem("text").alias("t")).select("doc_id", F.length("t").alias("n"), F.md5("t").alias("h"))


@query("sanitized_question", f"SELECT ord, {_collapse('''replace(replace(q, '```', ' '), '### Instruction:', ' ')''')} AS question FROM (SELECT ord, '```### Instruction: ' || coalesce(problem, '') || '```' AS q FROM math_seeds)", "math_seeds")
def sanitized_question(spark, sf_dir):
    q = F.concat(F.lit("```### Instruction: "), F.coalesce("problem", F.lit("")), F.lit("```"))
    return adapter(spark, sf_dir, "math_seeds").select("ord", text.sanitize_question(q).alias("question"))


@query("json_question", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'plain ' || event_type END AS question, CASE WHEN event_id % 2 = 0 THEN '' END AS test_input FROM events")
def json_question(spark, sf_dir):
    raw = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.concat(F.lit(" plain "), F.col("event_type")))
    q, i, _ = text.json_question(raw)
    return table(spark, sf_dir, "events").select("event_id", q.alias("question"), i.alias("test_input"))


@query("docstring", "SELECT ord, CASE WHEN length(q) > 30 THEN q ELSE trim(t) END AS question FROM (SELECT ord, t, trim(regexp_extract(t, '(?s)\"\"\"(.*?)\"\"\"', 1)) AS q FROM (SELECT ord, 'def f(): \"\"\" ' || CASE ord % 2 WHEN 0 THEN question ELSE 'short' END || ' \"\"\" pass' AS t FROM code_trials))", "code_trials")
def docstring(spark, sf_dir):
    t = F.concat(F.lit('def f(): """ '), F.when(F.col("ord") % 2 == 0, F.col("question")).otherwise("short"), F.lit(' """ pass'))
    return adapter(spark, sf_dir, "code_trials").select("ord", text.docstring_or_all(t).alias("question"))


@query("model_output_flag", "SELECT ord, starts_with(trim(output), '<think>') OR starts_with(trim(output), 'Okay,') AS is_output FROM outputs", "outputs")
def model_output_flag(spark, sf_dir):
    return adapter(spark, sf_dir, "outputs").select("ord", text.is_model_output("output").alias("is_output"))


@query("contest_markup", "SELECT ord, trim(regexp_replace(regexp_replace('Let $$$n_' || CAST(ord % 7 AS string) || '$$$ be  given' || chr(10) || chr(10) || chr(10) || 'now $$', '\\${3}([^$]+)\\${3}', '\\1', 'g'), '\\${2,}', '', 'g')) AS t FROM code_trials", "code_trials")
def contest_markup(spark, sf_dir):
    t = F.concat(F.lit("Let $$$n_"), (F.col("ord") % 7).cast("string"), F.lit("$$$ be  given\n\n\nnow $$"))
    return adapter(spark, sf_dir, "code_trials").select("ord", text.clean_contest_markup(t).alias("t"))


ORACLES["contest_markup"] = ORACLES["contest_markup"].replace("be  given' || chr(10) || chr(10) || chr(10)", "be given' || chr(10) || chr(10)")


@query("level_names", "SELECT ord, CASE reasoning_level WHEN 0 THEN 'minimal' WHEN 1 THEN 'basic' WHEN 2 THEN 'intermediate' WHEN 3 THEN 'advanced' ELSE 'expert' END AS name FROM code_trials", "code_trials")
def level_names(spark, sf_dir):
    return adapter(spark, sf_dir, "code_trials").select("ord", difficulty.level_name("reasoning_level").alias("name"))


@query("scored_gate", "SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality >= 1")
def scored_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id").withColumnRenamed("quality", "lm_q1q2_score")
    return registry.scored(rows, 1).select("doc_id")


@query("finemath_gate", f"SELECT doc_id, {_keywords('t', 'finemath', first=800)} AS domain FROM (SELECT doc_id, lang, {_strip('text')} AS t, quality FROM documents LEFT JOIN (SELECT doc_id, quality * 4 AS quality FROM labels) USING (doc_id)) WHERE coalesce(quality, 0) >= 3 AND length(t) >= 200 AND coalesce(lang, 'en') = 'en'")
def finemath_gate(spark, sf_dir):
    score = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * 4).alias("int_score"))
    docs = table(spark, sf_dir, "documents").join(score, "doc_id", "left").select(F.col("doc_id").alias("ord"), "text", F.col("lang").alias("language"), "int_score")
    return registry.finemath(docs).select(F.col("ord").alias("doc_id"), "domain")


@query("theoremqa_fallback", "SELECT 'math' AS which, count(*) AS n FROM math_seeds WHERE " + _strip("coalesce(problem, '')") + " <> '' AND (source = 'aime' OR source = 'limo') UNION ALL SELECT 'none', count(*) FROM math_seeds WHERE " + _strip("coalesce(problem, '')") + " <> ''", "math_seeds")
def theoremqa_fallback(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds").select("ord", F.col("problem").alias("Question"), F.col("answer").alias("Answer"), "source")
    said = rows.withColumn("subject", F.when(F.col("source") == "aime", "Math").when(F.col("source") == "limo", "").otherwise("physics")).drop("source")
    none = rows.withColumn("subject", F.lit("physics")).drop("source")
    out = [registry.theoremqa(x).agg(F.count("*").alias("n")).select(F.lit(k).alias("which"), "n") for k, x in (("math", said), ("none", none))]
    return out[0].unionAll(out[1])


@query("deepmath_chunk", "SELECT ord, CASE WHEN length(trim(coalesce(solution, ''))) >= length(trim(coalesce(answer, ''))) THEN nullif(" + _strip("coalesce(solution, '')") + ", '') ELSE " + _strip("answer") + " END AS solution FROM math_seeds WHERE ord % 5 = 2 AND " + _strip("coalesce(problem, '')") + " <> ''", "math_seeds")
def deepmath_chunk(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds").select("ord", F.col("problem").alias("question"), F.col("answer").alias("final_answer"), F.col("source").alias("topic"), F.array("solution", "answer").alias("r1_solutions"))
    return registry.deepmath(rows, chunk_id=2, total_chunks=5).select("ord", "solution")


@query("external_records", f"SELECT ord, {_strip('problem')} AS question, {_strip('''coalesce(answer, '')''')} AS answer, {_words('answer')}::int AS words_answer, 'team:train:' || CAST(ord AS string) AS sample_id FROM math_seeds WHERE length({_strip('''coalesce(problem, '')''')}) >= 10", "math_seeds")
def external_records(spark, sf_dir):
    from ..plans import coding

    rows = adapter(spark, sf_dir, "math_seeds")
    out = coding.external_records(rows, "team", "train", F.col("problem"), F.col("answer"), F.col("solution"))
    return out.select(F.substring_index("sample_id", ":", -1).cast("long").alias("ord"), "question", "answer", "words_answer", "sample_id")


@query("converted_code", f"SELECT question AS \"Question\", solution_code AS \"Answer\", '<think>' || chr(10) || 'o ' || CAST(ord AS string) || chr(10) || '</think>' AS \"<Think>\", trunc({_words('question')} * 1.3::double)::int AS \"Number of tokens in Question\" FROM code_trials WHERE ord % 4 > 0", "code_trials")
def converted_code(spark, sf_dir):
    from ..plans import coding

    rows = adapter(spark, sf_dir, "code_trials").select("ord", F.when(F.col("ord") % 4 > 0, F.col("question")).alias("question"), F.concat(F.lit(" o "), F.col("ord").cast("string")).alias("output"), F.col("solution_code").alias("solution"))
    return coding.converted(rows, "team").select("Question", "Answer", "<Think>", "Number of tokens in Question")


@query("prepared_seeds")
def prepared_seeds(spark, sf_dir):
    """Raw questions to prepared seeds; messages, levels and ids are held by tests."""
    from ..plans import coding

    rows = adapter(spark, sf_dir, "code_trials").select(
        "ord", F.col("question").alias("question_text"), F.lit("team").alias("source_name"), F.lit("u").alias("source_url"), F.lit("English").alias("language"), F.lit("sandbox_verified").alias("answer_source"),
        F.array().cast("array<string>").alias("options"), F.lit(None).cast("string").alias("correct_answer"), F.to_json(F.struct((F.col("ord") % 3000).cast("string").alias("difficulty"))).alias("extra"),
    )
    return coding.seeds(rows).select("prompt_id", "domain", "reasoning_level", F.size("messages").alias("n_messages"))


@query("offline_generation")
def offline_generation(spark, sf_dir):
    """Evaluation of a deterministic offline model on the seed questions, resumed after a third is done."""
    from ..operators import providers

    inputs = registry.eval_input(adapter(spark, sf_dir, "math_seeds"), "team/seeds")
    done = inputs.where("index % 3 = 0").select("index", "dataset", F.lit("m1").alias("model_used"))
    said = evaluation.generate(inputs, ["m1", "m2"], done, providers.Offline())
    return rel.model_summary(evaluation.results(said.withColumn("source", F.col("subdomain"))))


@query("teacher_answers")
def teacher_answers(spark, sf_dir):
    """Final answers of teacher responses, in the meant and the strict reading of the patterns."""
    rows = adapter(spark, sf_dir, "generations")
    return rows.select("ord", answers.teacher_answer("generation").alias("answer"), answers.teacher_answer("generation", strict=True).alias("answer_strict"))


def _candidate_steps(source: str, *columns: tuple[str, str]) -> str:
    """CTEs that clean candidate answers step by step: (column, its SQL) of ``source``; the last CTE is ``cleaned``."""
    tagged = lambda c: f"CASE WHEN NOT regexp_matches(lower({c}), '</?think') THEN {c} END"
    wrapped = lambda c, a, b: f"WHEN starts_with({c}, '{a}') AND ends_with({c}, '{b}') AND length({c}) > {len(a) + len(b)} THEN {_strip(f'substring({c}, {len(a) + 1}, length({c}) - {len(a) + len(b)})')}"
    wraps = (("$$", "$$"), ("$", "$"), ("\\(", "\\)"), ("\\[", "\\]"))
    steps = [
        lambda c, sql: f"nullif(regexp_replace({_strip(sql)}, '^[` ]+|[` ]+$', '', 'g'), '')",
        lambda c, _: tagged(c),
        lambda c, _: f"coalesce(nullif({_box(c)}, ''), {c})",
        lambda c, _: _strip(c),
        lambda c, _: "CASE " + " ".join(wrapped(c, a, b) for a, b in wraps) + f" ELSE {c} END",
        lambda c, _: _strip(f"regexp_replace(regexp_replace({c}, '[ .;,]+$', '', 'g'), '^\\$+|\\$+$', '', 'g')"),
        lambda c, _: f"CASE {wrapped(c, '**', '**')} ELSE {c} END",
        lambda c, _: f"nullif({_strip(c)}, '')",
        lambda c, _: tagged(c),
    ]
    out, at = [], source
    for k, step in enumerate(steps):
        name = f"candidates{k}" if k + 1 < len(steps) else "cleaned"
        made = ", ".join(f"{step(c, sql)} AS {c}" for c, sql in columns)
        drop = "" if k == 0 else f" EXCLUDE ({', '.join(c for c, _ in columns)})"
        out.append(f"{name} AS (SELECT *{drop}, {made} FROM {at})")
        at = name
    return ", ".join(out)


_NUM = r"'^-?\d+(\.\d+)?$'"
_FINAL_RECORD = (
    f", opened AS (SELECT *, {_OPEN} AS open_problem, {_reference('solution')} AS ref FROM math_seeds), "
    + _candidate_steps("opened", ("from_answer", "answer"), ("from_solution", "ref"))
    + f", traced AS (SELECT *, coalesce(solution, '') AS trace, coalesce(from_answer, from_solution) AS extracted, {_normal('answer')} AS n_ref, {_normal('coalesce(from_answer, from_solution)')} AS n_pred FROM cleaned), "
    "judged AS (SELECT *, CASE WHEN nullif(answer, '') IS NULL OR nullif(extracted, '') IS NULL THEN NULL WHEN n_ref = n_pred THEN true "
    f"WHEN regexp_matches(n_ref, {_NUM}) AND regexp_matches(n_pred, {_NUM}) THEN abs(n_ref::double - n_pred::double) < 1e-6 END AS verified FROM traced), "
    f"levels AS (SELECT *, regexp_matches(open_problem, '{difficulty.ADVANCED}') AS adv, regexp_matches(open_problem, '{difficulty.INTERMEDIATE}') AS mid, len({_lines('trace')}) AS steps, "
    "CASE coalesce(domain, 'algebra') " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in difficulty.DOMAIN_BASE.items()) + " ELSE 1 END AS base FROM judged WHERE verified IS NOT FALSE), "
    "raws AS (SELECT *, greatest(base, CASE WHEN adv THEN 3 WHEN mid THEN 2 ELSE 1 END) + CASE WHEN steps > 40 THEN 2 WHEN steps > 20 THEN 1 ELSE 0 END AS raw FROM levels), "
    f"records AS (SELECT {_collapse('''replace(replace(replace(open_problem, '```', ' '), '### Instruction:', ' '), '### Response:', ' ')''')} AS problem, trace, coalesce(nullif(answer, ''), nullif(extracted, ''), '') AS answer, "
    "CASE WHEN raw >= 4 AND NOT adv AND steps < 30 THEN 3 ELSE least(raw, 4) END AS level, domain, source, id, verified FROM raws) "
    f"SELECT 'Reasoning' AS kind, '{mathematics.SYSTEM_PROMPT}' AS system_prompt, '{mathematics.INSTRUCTION}' AS instruction, problem AS question, trace AS think, answer, "
    "CASE level " + " ".join(f"WHEN {k} THEN '{v.lower()}'" for k, v in difficulty.LEVEL_NAMES.items()) + " ELSE 'unknown' END AS difficulty_level, "
    f"{len(mathematics.INSTRUCTION.split())}::int AS words_instruction, {len(mathematics.SYSTEM_PROMPT.split())}::int AS words_system, {_words('problem')}::int AS words_question, {_words('answer')}::int AS words_answer, 'QA' AS task, "
    "domain, 'English' AS language, source, 'math_pipeline' AS made_by, 'reasoning' AS reasoning_sft, 'unknown' AS model, id AS sample_id, verified "
    f"FROM records WHERE {_QUESTION} AND {_collapse('answer')} <> ''"
)
_RATING = "CASE WHEN d BETWEEN 2 AND 4 THEN d WHEN d <= 1000 THEN 1 WHEN d <= 1500 THEN 2 WHEN d <= 2000 THEN 3 ELSE 4 END"
_VERDICT = f"CASE WHEN length(q) < 80 THEN 'reject' WHEN regexp_matches(lower(q), '{'|'.join(problems.NOT_CODE)}') THEN 'reject' WHEN {_any('lower(q)', problems.CONTEST_PHRASES)} THEN 'accept' WHEN NOT {_any('lower(q)', problems.CODE_WORDS)} THEN 'reject' ELSE 'ask' END"
_OFFLINE = (
    ", inputs AS (SELECT row_number() OVER (ORDER BY ord) - 1 AS index, problem, coalesce(nullif(answer, ''), nullif(solution, '')) AS expected_answer FROM math_seeds WHERE problem <> ''), "
    "asked AS (SELECT *, ('0x' || substring(md5(model_used || '|' || problem), 1, 8))::bigint AS h FROM inputs CROSS JOIN (VALUES ('m1'), ('m2')) AS v(model_used) WHERE NOT (model_used = 'm1' AND index % 3 = 0)), "
    "generations AS (SELECT index AS ord, model_used, 'seeds' AS source, problem, expected_answer, '<think>offline ' || (h % 97)::string || '</think>' || chr(10) || (h % 1000)::string AS generation FROM asked)"
)
ORACLES |= {
    "math_final_record": oracle("@", "math_seeds").replace(" @", _FINAL_RECORD),
    "prepared_seeds": oracle(
        f"SELECT 'team_q' || lpad(i::string, greatest(4, length(i::string))::int, '0') || '_' || substring(md5(substring(q, 1, 100)), 1, 4) AS prompt_id, {_keywords('q', 'code', chr(39) + 'competitive_programming' + chr(39))} AS domain, ({_RATING})::int AS reasoning_level, 2 AS n_messages "
        f"FROM (SELECT *, row_number() OVER (ORDER BY ord) AS i FROM (SELECT ord, ord % 3000 AS d, {_strip('question')} AS q FROM code_trials) WHERE {_VERDICT} <> 'reject')",
        "code_trials",
    ),
    "offline_generation": oracle("@", "math_seeds").replace(" @", _OFFLINE + _after_split(_SUMMARY)),
    "semantic_dedup": (
        "WITH RECURSIVE v AS (SELECT vec_id, embedding::double[] AS e, sqrt(list_dot_product(embedding::double[], embedding::double[])) AS n FROM embeddings), "
        "near AS (SELECT b.vec_id AS v, list(a.vec_id) AS earlier FROM v a JOIN v b ON a.vec_id < b.vec_id AND list_dot_product(a.e, b.e) / (a.n * b.n) > 0.35 GROUP BY b.vec_id), "
        "steps AS (SELECT *, row_number() OVER (ORDER BY v) AS i FROM near), "
        "walk AS (SELECT 0::bigint AS i, []::bigint[] AS gone UNION ALL SELECT s.i, CASE WHEN len(list_filter(s.earlier, lambda x: NOT list_contains(w.gone, x))) > 0 THEN list_append(w.gone, s.v) ELSE w.gone END FROM walk w JOIN steps s ON s.i = w.i + 1) "
        "SELECT vec_id FROM embeddings WHERE NOT list_contains((SELECT arg_max(gone, i) FROM walk), vec_id)"
    ),
}


# sinks, streams and the sandbox, written and read back


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/queries-{uuid.uuid4().hex}"


@query("appended_jsonl", "SELECT id, ord, problem FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM math_seeds) WHERE rn = 1", "math_seeds")
def appended_jsonl(spark, sf_dir):
    """Two overlapping batches appended to one JSON-lines sink; the second brings only new ids."""
    rows, path = adapter(spark, sf_dir, "math_seeds").select("id", "ord", "problem"), _folder(spark)
    sinks.append_jsonl(rows.where("ord % 2 = 0"), path, "id", "ord")
    sinks.append_jsonl(rows, path, "id", "ord")
    return registry.read_jsonl(spark, path, "id string, ord long, problem string")


@query("appended_rows", "SELECT id, ord FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord) AS rn FROM math_seeds WHERE ord % 3 > 0 AND id NOT IN (SELECT id FROM math_seeds WHERE ord % 3 = 0)) WHERE rn = 1", "math_seeds")
def appended_rows(spark, sf_dir):
    rows = adapter(spark, sf_dir, "math_seeds").select("id", "ord")
    return rel.append_new(rows.where("ord % 3 = 0"), rows.where("ord % 3 > 0"), "id", "ord")


@query("checkpointed_step", "SELECT id, ord, domain, problem FROM math_seeds", "math_seeds")
def checkpointed_step(spark, sf_dir):
    """A step's checkpoint, with two key fields and the rest as JSON, read back."""
    folder = _folder(spark)
    sinks.write_step(adapter(spark, sf_dir, "math_seeds").select("id", "ord", "domain", "problem"), folder, 2, "seeds", ["id", "ord"])
    return sinks.read_step(spark, folder, 2, "domain string, problem string").select("id", "ord", "domain", "problem")


@query("step_manifest", "SELECT 3 AS step, 'seeds' AS title, count(*) AS total FROM math_seeds", "math_seeds")
def step_manifest(spark, sf_dir):
    folder = _folder(spark)
    sinks.write_step(adapter(spark, sf_dir, "math_seeds").select("id", "ord"), folder, 3, "seeds", ["id"])
    return spark.read.schema("step int, title string, total long").json(f"{folder}/step3_manifest")


@query("named_dataset", "SELECT source, domain, count(*) AS n, 1 AS n_named FROM math_seeds GROUP BY ALL", "math_seeds")
def named_dataset(spark, sf_dir):
    """A named dataset and the latest one; both are listed, the latest is read."""
    folder = _folder(spark)
    named = sinks.write_dataset(adapter(spark, sf_dir, "math_seeds").select("ord", "source", "domain"), folder, "teacher")
    others = [d for d in sinks.datasets(spark, folder) if d.rpartition("/")[2] == named.rpartition("/")[2]]
    latest = spark.read.parquet(f"{folder}/dataset_latest.parquet")
    return latest.groupBy("source", "domain").agg(F.count("*").alias("n")).withColumn("n_named", F.lit(len(others)))


@query("written_packs", "SELECT result AS bucket, prompt_id, count(*) AS n FROM code_trials GROUP BY ALL", "code_trials")
def written_packs(spark, sf_dir):
    folder = _folder(spark)
    sinks.write_packs(adapter(spark, sf_dir, "code_trials").select(F.col("result").alias("bucket"), "prompt_id"), "bucket", folder)
    return spark.read.schema("prompt_id string, bucket string").parquet(folder).groupBy("bucket", "prompt_id").agg(F.count("*").alias("n"))


@query("written_csv", "SELECT source, count(*)::bigint AS n FROM math_seeds GROUP BY source", "math_seeds")
def written_csv(spark, sf_dir):
    path = _folder(spark)
    sinks.write_csv(adapter(spark, sf_dir, "math_seeds").groupBy("source").agg(F.count("*").alias("n")), path)
    return spark.read.schema("source string, n long").option("header", True).csv(path)


@query("json_lines", "SELECT ord, domain FROM math_seeds WHERE ord % 4 > 1", "math_seeds")
def json_lines(spark, sf_dir):
    """JSON lines among blank and broken ones."""
    path = _folder(spark)
    line = F.when(F.col("ord") % 4 == 0, "").when(F.col("ord") % 4 == 1, F.concat(F.lit("{broken "), F.col("ord").cast("string"))).otherwise(F.to_json(F.struct("ord", "domain")))
    adapter(spark, sf_dir, "math_seeds").select(line.alias("value")).write.text(path)
    return registry.read_jsonl(spark, path, "ord long, domain string")


@query("seed_questions", f"SELECT ord, {_strip('problem')} AS question FROM math_seeds WHERE length({_strip('problem')}) > 20", "math_seeds")
def seed_questions(spark, sf_dir):
    return registry.seed_questions(adapter(spark, sf_dir, "math_seeds"), "problem")


@query("detected_text_field", "SELECT 'text' AS field")
def detected_text_field(spark, sf_dir):
    found = registry.detect_text_field(table(spark, sf_dir, "documents").select("doc_id", "lang", "text", "source"))
    return spark.range(1).select(F.lit(found).alias("field"))


@query("streamed_new_keys", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey")
def streamed_new_keys(spark, sf_dir):
    """The first order of each customer: two streamed runs over a growing folder append it once."""
    folder, orders = _folder(spark), table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    half = orders.agg(F.expr("percentile(o_orderkey, 0.5)").cast("long")).first()[0]
    for part in (orders.where(F.col("o_orderkey") <= half), orders.where(F.col("o_orderkey") > half)):
        part.write.mode("append").parquet(f"{folder}/in")
        stream = incremental.read_stream(spark, f"{folder}/in", orders.schema)
        incremental.append_new_keys(stream, "o_custkey", "o_orderkey", f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("o_custkey", "o_orderkey")


_PROGRAMS = "CASE r_regionkey % 4 WHEN 0 THEN 'def solve():' || chr(10) || '    print(int(input()) * 2)' WHEN 1 THEN 'def solve():' || chr(10) || '    print(int(input()) + 1)' WHEN 2 THEN 'import os' || chr(10) || 'def solve():' || chr(10) || '    os.system(input())' ELSE 'def solve():' || chr(10) || '    while True: pass' END"


@query("sandbox_tests", "SELECT r_regionkey, CASE r_regionkey % 4 WHEN 0 THEN 'Pass' WHEN 2 THEN 'Blocked' ELSE 'Fail' END AS result FROM region")
def sandbox_tests(spark, sf_dir):
    """Fixed programs against a test of doubling: right, wrong, forbidden and endless."""
    test = "import io, sys\nfrom solution import solve\ndef test_1():\n    sys.stdin, sys.stdout = io.StringIO('4'), io.StringIO()\n    solve()\n    said, sys.stdout = sys.stdout.getvalue(), sys.__stdout__\n    assert said.strip() == '8'\n"
    rows = table(spark, sf_dir, "region").select("r_regionkey", F.expr(_PROGRAMS).alias("solution_code"), F.lit(test).alias("test_code"))
    return sandbox.run_tests(rows, seconds=5.0, enabled=True).select("r_regionkey", "result")


@query("sandbox_outputs", "SELECT r_regionkey, CASE r_regionkey % 4 WHEN 0 THEN '2,4,6' WHEN 1 THEN '2,3,4' END AS outputs FROM region")
def sandbox_outputs(spark, sf_dir):
    """What the same programs print for three inputs; null where they don't run through."""
    rows = table(spark, sf_dir, "region").select("r_regionkey", F.expr(_PROGRAMS).alias("solution_code"), F.array(F.lit("1"), F.lit("2"), F.lit("3")).alias("inputs"))
    return sandbox.observed_outputs(rows, seconds=2.0, enabled=True).select("r_regionkey", F.array_join("outputs", ",").alias("outputs"))
