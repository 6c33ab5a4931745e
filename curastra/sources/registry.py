"""Registry of sources: each maps rows of its own schema onto seeds, as a lazy projection.

A source is a function (DataFrame, **options) -> DataFrame of SEED columns. ``load`` reads the configured ones, skips the
disabled and unknown, unites them and keeps the first of each id.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers, domains
from ..functions.text import col, filled, filled_strip, first_filled, is_model_output, strip, strip_tags
from ..operators.relational import keep_first, longest, modulo_chunk, numbered, union_all

LOG = logging.getLogger(__name__)
SEED = ("id", "source", "domain", "problem", "solution", "answer", "raw", "reasoning_level", "ord")
READERS: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    def register(f):
        READERS[name] = f
        return f

    return register


def has(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def first_of(df: DataFrame, *names: str) -> Column:
    """First non-blank value over alternative column names; null where none exists."""
    there = has(df, *names)
    return F.coalesce(*[filled_strip(F.col(f"`{n}`").cast("string")) for n in there]) if there else F.lit(None).cast("string")


def seeds(df: DataFrame, name: str, split: str, problem: Column, solution: Column, answer: Column, domain: Column, limit: int | None = None, where: Column | None = None, **more: Column) -> DataFrame:
    """Seed rows. ``ord`` numbers all source rows (ids hold it); a limit counts kept rows only."""
    if "ord" not in df.columns:
        raise ValueError("a source needs an ordering column named ord")
    raw = F.to_json(F.struct(*[c for c in df.columns if c != "ord"]))
    out = df.select(
        F.concat(F.lit(f"{name}:{split}:"), F.col("ord").cast("string")).alias("id"), F.lit(name).alias("source"), domain.alias("domain"), problem.alias("problem"),
        solution.alias("solution"), answer.alias("answer"), raw.alias("raw"), more.get("level", F.lit(None)).cast("int").alias("reasoning_level"), F.col("ord"),
        (F.lit(True) if where is None else where).alias("_keep"),
    )
    out = out.where(F.col("_keep") & (F.coalesce(F.col("problem"), F.lit("")) != "")).drop("_keep")
    return out.orderBy("ord").limit(limit) if limit is not None else out


# Labels of the collection's own sources.
NUMINA_LABELS = {
    "amc_aime": "number_theory", "aops_forum": "algebra", "cn_k12": "algebra", "gsm8k": "pre_algebra", "math": "intermediate_algebra",
    "olympiads": "algebra", "orca_math": "pre_algebra", "synthetic_amc": "number_theory", "synthetic_math": "intermediate_algebra",
}


@source("numina")
def numina(df: DataFrame, split: str = "train", limit: int | None = None, labels: dict[str, str] = NUMINA_LABELS) -> DataFrame:
    """Answer is the last boxed payload of the solution; the label falls back to one of the row's own source."""
    default = domains.by_map("source", labels, "algebra") if "source" in df.columns else F.lit("algebra")
    return seeds(df, "numina", split, strip("problem"), strip("solution"), answers.boxed_last("solution"), domains.by_keywords("problem", "numina", default), limit)


@source("finemath")
def finemath(df: DataFrame, split: str = "train", limit: int | None = None, min_text_length: int = 200, min_int_score: int = 3) -> DataFrame:
    """Scored web passages; a missing language counts as English."""
    text = strip("text")
    language = F.coalesce(F.col("language"), F.lit("en")) if "language" in df.columns else F.lit("en")
    ok = (F.coalesce(F.col("int_score"), F.lit(0)) >= min_int_score) & (F.length(text) >= min_text_length) & (language == "en")
    none = F.lit(None).cast("string")
    return seeds(df, "finemath", split, text, none, none, domains.by_keywords(text, "finemath", first=800), limit, ok)


@source("s1k")
def s1k(df: DataFrame, split: str = "train", limit: int | None = None) -> DataFrame:
    """Math rows; the solution falls back to the first trajectory, answers need a clear signal."""
    first = F.get("thinking_trajectories", F.lit(0)) if "thinking_trajectories" in df.columns else F.lit(None).cast("string")
    solution = F.coalesce(filled_strip("solution"), filled_strip(first))
    found = F.coalesce(answers.high_confidence_reference("solution"), answers.high_confidence_reference(F.col("attempt")) if "attempt" in df.columns else F.lit(None))
    return seeds(df, "s1k", split, strip("question"), solution, found, domains.by_keywords("question", "s1k"), limit, F.lower(F.col("cot_type")) == "math")


@source("tw_math")
def tw_math(df: DataFrame, split: str = "train", limit: int | None = None, chinese_problem: bool = False, chinese_think: bool = False, english_only: bool = True) -> DataFrame:
    zh = chinese_problem and not english_only
    problem = first_filled(strip("problem_zhtw"), strip("problem")) if zh and "problem_zhtw" in df.columns else strip("problem")
    think = first_of(df, "think")
    solution = F.coalesce(think, filled_strip("solution")) if chinese_think and not english_only else F.coalesce(filled_strip("solution"), think)
    return seeds(df, "tw_math", split, problem, solution, answers.pick_reference(first_of(df, "answer"), filled_strip("solution"), think), domains.by_map("type", domains.TYPE_LABELS), limit)


@source("telemath")
def telemath(df: DataFrame, split: str = "train", limit: int | None = None) -> DataFrame:
    return seeds(df, "telemath", split, strip("question"), F.lit(None).cast("string"), answers.pick_reference(F.col("answer").cast("string")), domains.telemath_domain("question", "difficulty"), limit)


@source("limo")
def limo(df: DataFrame, split: str = "train", limit: int | None = None) -> DataFrame:
    return seeds(df, "limo", split, strip("question"), strip("solution"), answers.pick_reference(col("answer"), col("solution")), domains.by_keywords("question", "limo"), limit)


SUBJECTS = ("subject", "Subject", "field", "category", "domain", "topic")


@source("theoremqa")
def theoremqa(df: DataFrame, split: str = "test", limit: int | None = None, math_only: bool = True) -> DataFrame:
    """With ``math_only``: rows whose subject is math or missing, unless no row says math; then all rows."""
    rows = df
    if math_only and (names := has(df, *SUBJECTS)):
        said = F.lower(strip(F.coalesce(F.col(names[0]).cast("string"), F.lit(""))))
        rows = rows.withColumn("_math", said == "math").withColumn("_open", said.isin("", "math"))
        some = F.broadcast(rows.agg(F.coalesce(F.bool_or("_math"), F.lit(False)).alias("_some")))
        rows = rows.join(some, F.col("_open") | ~F.col("_some")).drop("_math", "_open", "_some")
    return seeds(rows, "theoremqa", split, strip("Question"), F.lit(None).cast("string"), answers.pick_reference(F.col("Answer").cast("string")), domains.by_keywords("Question", "theoremqa"), limit)


@source("aime")
def aime(df: DataFrame, split: str = "train", limit: int | None = None) -> DataFrame:
    problem, solution = first_of(df, "Question", "question", "problem", "prompt"), first_of(df, "reasoning", "solution", "explanation")
    answer = answers.pick_reference(first_of(df, "Answer", "answer", "final_answer"), solution)
    return seeds(df, "aime", split, problem, solution, answer, domains.by_keywords(problem, "aime"), limit)


@source("calculator")
def calculator(df: DataFrame, split: str = "train", limit: int | None = None) -> DataFrame:
    """Chat rows: first user and first assistant message; tags are cut from the problem."""
    first = lambda role: F.get(F.filter("messages", lambda m: m["role"] == role), F.lit(0))["content"]
    problem, solution = strip_tags(first("user")), strip(first("assistant"))
    return seeds(df, "calculator", split, problem, solution, answers.calculator_answer(solution), domains.by_keywords(problem, "calculator"), limit)


@source("omni")
def omni(df: DataFrame, split: str = "test", limit: int | None = None) -> DataFrame:
    answer = answers.pick_reference(F.col("answer"), F.col("solution"))
    return seeds(df, "omni", split, strip("problem"), strip("solution"), answer, domains.by_path(F.get("domain", F.lit(0))), limit)


@source("deepmath")
def deepmath(df: DataFrame, split: str = "train", limit: int | None = None, chunk_id: int | None = None, total_chunks: int | None = None) -> DataFrame:
    """The longest of several solutions; both spellings of the columns are read."""
    rows = modulo_chunk(df, "ord", total_chunks, chunk_id) if total_chunks and chunk_id is not None else df
    problem, answer, topic = first_of(df, "question", "problem"), first_of(df, "final_answer", "answer"), first_of(df, "topic")
    names = has(df, "r1_solutions")
    flat = has(df, "r1_solution_1", "r1_solution_2", "r1_solution_3", "r1_solution")
    solution = longest(names[0]) if names else longest(F.array(*[F.col(c) for c in flat])) if flat else F.lit(None).cast("string")
    return seeds(rows, "deepmath", split, problem, solution, answers.pick_reference(answer), domains.by_map(topic, domains.TOPIC_LABELS), limit)


# Alternative column names.
QUESTION_NAMES = ("question", "Question", "problem", "Problem", "instruction", "prompt", "input", "query", "text", "content")
ANSWER_NAMES = ("answer", "Answer", "solution", "Solution", "output", "response", "target", "label", "gold", "answerKey", "correct_answer")


def eval_input(df: DataFrame, dataset: str, question: str | None = None, answer: str | None = None, limit: int | None = None) -> DataFrame:
    """index (from 0, over kept rows), problem, subdomain, dataset, expected_answer."""
    pick = lambda first, names: F.coalesce(*[filled(F.col(f"`{n}`").cast("string")) for n in has(df, *([first] if first else []), *names)] or [F.lit(None).cast("string")])
    rows = df.select("ord", pick(question, QUESTION_NAMES).alias("problem"), pick(answer, ANSWER_NAMES).alias("expected_answer")).where("problem IS NOT NULL")
    rows = numbered(rows, ["ord"], "_n").select((F.col("_n") - 1).alias("index"), "problem", F.lit(dataset.rsplit("/", 1)[-1]).alias("subdomain"), F.lit(dataset).alias("dataset"), "expected_answer")
    return rows.where(F.col("index") < limit) if limit is not None else rows


def seed_questions(df: DataFrame, field: str, limit: int | None = None, more_than: int = 20) -> DataFrame:
    out = df.select("ord", strip(field).alias("question")).where(F.length("question") > more_than)
    return out.orderBy("ord").limit(limit) if limit is not None else out


def scored(df: DataFrame, min_score: float, column: str = "lm_q1q2_score") -> DataFrame:
    """Rows that reach a score; all rows where the column doesn't exist."""
    return df.where(F.col(column) >= min_score) if column in df.columns else df


def raw_questions(df: DataFrame, text_field: str, dataset: str, language: str = "English", least: int = 30) -> DataFrame:
    """Code questions with all other columns as JSON in ``extra``: lists join by line feeds, maps give their first value."""
    kind = dict(df.dtypes)[text_field]
    c = F.col(f"`{text_field}`")
    text = F.array_join(c.cast("array<string>"), "\n") if kind.startswith("array") else F.get(F.map_values(c), F.lit(0)).cast("string") if kind.startswith("map") else c.cast("string")
    rest = [x for x in df.columns if x != text_field]
    out = df.select(
        strip(F.coalesce(text, F.lit(""))).alias("question_text"), F.array().cast("array<string>").alias("options"), F.lit(None).cast("string").alias("correct_answer"),
        F.lit("sandbox_verified").alias("answer_source"), F.lit(dataset.replace("/", "_").replace("-", "_")).alias("source_name"), F.lit(dataset).alias("source_url"),
        F.lit(language).alias("language"), F.to_json(F.struct(*[F.col(f"`{x}`") for x in rest])).alias("extra"),
    )
    return out.where(F.length("question_text") >= least)


# Text columns of known datasets.
KNOWN_TEXT_FIELDS = {
    "deepmind/code_contests": "description", "codeparrot/apps": "question", "open-r1/codeforces-cots": "description", "LingoIITGN/PythonSaga": "prompt",
    "bennny674/leveled_code_bench": "response_message", "livecodebench/code_generation_lite": "question_content", "bzantium/livecodebench": "question_content",
}


def detect_text_field(df: DataFrame, dataset: str = "", sample: int = 5) -> str | None:
    """The known text column, else the string column whose first rows hold the longest text that isn't a model's output."""
    if KNOWN_TEXT_FIELDS.get(dataset) in df.columns:
        return KNOWN_TEXT_FIELDS[dataset]
    names = [n for n, t in df.dtypes if t == "string"]
    if not names:
        return None
    # the first rows by "ord", or by a hash where there is no order: the same ones every time
    first = df.orderBy("ord" if "ord" in df.columns else F.xxhash64(*[F.col(f"`{n}`") for n in names])).limit(sample)
    sizes = first.agg(*[F.max(F.when(~is_model_output(f"`{n}`"), F.length(F.col(f"`{n}`")))).alias(n) for n in names]).first()
    best = max(names, key=lambda n: (sizes[n] or 0, -names.index(n)))
    return best if sizes[best] else None


def profile(df: DataFrame) -> DataFrame:
    """column, type, rows, missing, longest and shortest text of every column, in one pass."""
    aggs = []
    for i, (n, _) in enumerate(df.dtypes):
        c = F.col(f"`{n}`")
        aggs += [F.count_if(c.isNull()).alias(f"m{i}"), F.max(F.length(c.cast("string"))).alias(f"l{i}"), F.min(F.length(c.cast("string"))).alias(f"s{i}")]
    one = df.agg(F.count("*").alias("rows"), *aggs)
    rows = [F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.col("rows"), F.col(f"m{i}").alias("missing"), F.col(f"l{i}").alias("longest"), F.col(f"s{i}").alias("shortest")) for i, (n, t) in enumerate(df.dtypes)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank and malformed ones are left out."""
    rows = spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.where("_bad IS NULL").drop("_bad")


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial folders <prompt_id>/<trial>/ with test_result.txt and data.json, each read once as a file table."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = F.split("path", "/")
    at = lambda k: F.element_at(parts, -k)
    files = files.select(at(3).alias("prompt_id"), at(2).alias("trial"), at(1).alias("file"), F.decode("content", "UTF-8").alias("text"))
    wide = files.groupBy("prompt_id", "trial").agg(*[F.max(F.when(F.col("file") == f, F.col("text"))).alias(n) for f, n in (("test_result.txt", "result"), ("data.json", "data"), ("test_log.log", "log"))])
    return wide.where("result IS NOT NULL AND data IS NOT NULL").withColumn("result", strip("result"))


def chat_records(df: DataFrame) -> DataFrame:
    """Reasoning chats with an info block: question, thinking and answer, with the fallbacks between the fields."""
    pick = lambda role: F.get(F.filter("messages", lambda m: m["role"] == role), F.lit(0))
    user, said = pick("user"), pick("assistant")
    clean = lambda c: F.when(c == "None", "").otherwise(strip(F.coalesce(c, F.lit(""))))
    think = clean(first_filled(said["info"]["think_content"], said["content"]))
    inside = strip(F.regexp_extract(F.coalesce(said["content"], F.lit("")), r"(?s)<think>(.*?)</think>", 1))
    answer = clean(first_filled(said["info"]["answer_content"], said["info"]["reference_answer"]))
    out = df.select("ord", strip(user["content"]).alias("question"), F.when(think != "", think).otherwise(inside).alias("thinking"), answer.alias("answer"))
    return out.where(F.length("question") >= 10)


def nest_chats(turns: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """One row per conversation with its messages in order."""
    pair = F.struct(F.col(order), F.struct(F.col("role"), F.col("text").alias("content")).alias("m"))
    return turns.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["m"]).alias("messages"))


def load(spark: SparkSession, config: dict[str, dict], tables: dict[str, DataFrame]) -> DataFrame:
    """Seeds of every enabled source of the config; ``tables`` gives the rows of each. First of each id wins."""
    frames = []
    for name, options in config.items():
        if not options.get("enabled", True):
            continue
        if name not in READERS or name not in tables:
            LOG.warning("unknown source %s", name)
            continue
        options = {k: v for k, v in options.items() if k not in ("enabled", "repo_id")}
        frames.append(READERS[name](tables[name], **options).withColumn("_at", F.lit(len(frames))))
    if not frames:
        raise ValueError("no enabled source")
    return keep_first(union_all(*frames), ["id"], ["_at", "ord"]).drop("_at")

