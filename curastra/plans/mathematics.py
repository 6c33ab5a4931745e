"""Mathematics curation: evolve, convert, trace, verify, reject, tag, filter, final record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers, difficulty, problems, prompts, thinking
from ..functions.text import first_filled, sanitize_question, word_count
from ..operators import providers
from ..operators.relational import _small, drop_unchanged, reject_wrong, union_all, where_computed
from ..operators.scratch import cut

# Fixed values of the final record.
SYSTEM_PROMPT = "You are a helpful assistant that solves mathematics problems step by step."
INSTRUCTION = "Solve the following math question. Show your reasoning in <think>...</think> and then provide the final answer clearly."


def evolve(seeds: DataFrame, depth: int = 1, strategies: tuple[str, ...] = problems.STRATEGIES) -> DataFrame:
    """Offline mutations of seeds (id, source, domain, problem, ord), every strategy at every depth.

    The next depth mutates the last success so far, or the seed; unchanged texts are dropped. References aren't inherited.
    """
    current = seeds.select("id", "source", "domain", "ord", F.col("problem").alias("_now"), F.col("problem").alias("original_problem"))
    out = []
    for d in range(1, depth + 1):
        tried = current.select("*", F.posexplode(F.array(*[F.lit(s) for s in strategies])).alias("_k", "mutation_strategy"))
        tried = tried.withColumn("problem", problems.mutate_offline("_now", "mutation_strategy", "domain"))
        good = drop_unchanged(tried, "problem", "_now").withColumn("mutation_depth", F.lit(d))
        out.append(good)
        if d < depth:
            # the last strategy that changed the text, per seed, from the row itself: no shuffle is needed
            texts = [problems.mutate_offline("_now", F.lit(s), "domain") for s in reversed(strategies)]
            changed = [F.when((t != "") & (t != F.col("_now")), t) for t in texts]
            current = current.withColumn("_now", F.coalesce(*changed, F.col("_now")))
    rows = union_all(*out)
    evolved_id = F.concat("id", F.lit("::evol::"), "mutation_strategy", F.lit("::d"), F.col("mutation_depth").cast("string"))
    none = F.lit(None).cast("string")
    return rows.select(F.col("id").alias("parent_id"), evolved_id.alias("evolved_id"), "source", "domain", "mutation_strategy", "mutation_depth", "problem", "original_problem", none.alias("solution"), none.alias("answer"), "ord")


def evolve_with(seeds: DataFrame, provider: providers.Provider, depth: int = 1, strategies: tuple[str, ...] = problems.STRATEGIES) -> DataFrame:
    """Mutations by a model: replies are cleaned, and empty or unchanged ones dropped.

    Each depth is checkpointed, so that no reply is asked for twice; the next one starts from the seed's last success.
    """
    current = seeds.select("id", "source", "domain", "ord", F.col("problem").alias("_now"), F.col("problem").alias("original_problem"))
    out = []
    for d in range(1, depth + 1):
        tried = current.select("*", F.posexplode(F.array(*[F.lit(s) for s in strategies])).alias("_k", "mutation_strategy"))
        said = providers.complete(tried.withColumn("_ask", prompts.mutation("_now", "mutation_strategy", "domain")), provider, "_ask", "_said")
        good = cut(drop_unchanged(said.withColumn("problem", problems.clean_mutation("_said")), "problem", "_now").drop("_ask", "_said").withColumn("mutation_depth", F.lit(d)))
        out.append(good)
        if d < depth:
            last = good.groupBy("id").agg(F.max_by("problem", "_k").alias("_last"))
            current = current.join(last, "id", "left").withColumn("_now", F.coalesce("_last", "_now")).drop("_last")
    evolved_id = F.concat("id", F.lit("::evol::"), "mutation_strategy", F.lit("::d"), F.col("mutation_depth").cast("string"))
    none = F.lit(None).cast("string")
    return union_all(*out).select(F.col("id").alias("parent_id"), evolved_id.alias("evolved_id"), "source", "domain", "mutation_strategy", "mutation_depth", "problem", "original_problem", none.alias("solution"), none.alias("answer"), "ord")


def convert(samples: DataFrame) -> DataFrame:
    """Open-ended problems with their kind; a missing problem becomes an open row with ''."""
    kind = problems.problem_type("problem")
    return (
        samples.withColumn("problem_type", kind)
        .withColumn("was_mcq", F.col("problem_type") == "mcq")
        .withColumn("original_problem", F.col("problem"))
        .withColumn("problem", problems.open_ended("problem", F.col("problem_type")))
    )


def trace(converted: DataFrame, provider: providers.Provider | None = None) -> DataFrame:
    """Think trace, extracted answer and reference; without a reply the existing solution stands in."""
    rows = converted
    if provider is not None:
        rows = providers.complete(rows.withColumn("_ask", prompts.teacher("problem")), provider, "_ask", "full_response").drop("_ask")
    else:
        rows = rows.withColumn("full_response", F.lit(None).cast("string"))
    fallback = F.coalesce(F.col("full_response"), F.lit("")) == ""
    think = F.when(fallback, F.coalesce("solution", F.lit(""))).otherwise(thinking.think_block("full_response"))
    raw = F.when(fallback, F.coalesce("answer", F.lit(""))).otherwise(thinking.after_think("full_response"))
    found = F.when(fallback, F.coalesce(answers.clean_candidate("answer"), answers.clean_candidate(answers.normalise_reference("solution")))).otherwise(answers.teacher_answer("full_response"))
    return rows.withColumn("think_trace", think).withColumn("raw_answer", raw).withColumn("extracted_answer", found).withColumn("reference_answer", F.col("answer")).withColumn("teacher_fallback", fallback)


def verify(traced: DataFrame) -> DataFrame:
    verified, method = answers.verify("reference_answer", "extracted_answer")
    return traced.withColumn("verified", verified).withColumn("verification_method", method)


def tag(verified: DataFrame, sample_id: str = "id") -> DataFrame:
    return verified.withColumn("reasoning_level", difficulty.reasoning_level("problem", "think_trace", "domain", sample_id))


def final_record(tagged: DataFrame, model: str = "unknown", models: DataFrame | None = None) -> DataFrame:
    """The 20 columns of the published record, with snake-case names; ``published`` gives them their long ones."""
    rows = tagged
    if models is not None:
        rows = rows.join(_small(models.select("source", F.col("model_name").alias("_m"))), "source", "left")
    else:
        rows = rows.withColumn("_m", F.lit(None).cast("string"))
    question = sanitize_question("problem")
    think = F.coalesce(first_filled("think_trace", "solution"), F.lit(""))
    answer = F.coalesce(first_filled("raw_answer", "extracted_answer", "answer"), F.lit(""))
    return rows.select(
        F.lit("Reasoning").alias("kind"), F.lit(SYSTEM_PROMPT).alias("system_prompt"), F.lit(INSTRUCTION).alias("instruction"), question.alias("question"), think.alias("think"), answer.alias("answer"),
        difficulty.level_name("reasoning_level").alias("difficulty_level"), word_count(F.lit(INSTRUCTION)).alias("words_instruction"), word_count(F.lit(SYSTEM_PROMPT)).alias("words_system"),
        word_count(question).alias("words_question"), word_count(answer).alias("words_answer"), F.lit("QA").alias("task"), "domain", F.lit("English").alias("language"), "source",
        F.lit("math_pipeline").alias("made_by"), F.lit("reasoning").alias("reasoning_sft"), F.coalesce("_m", F.lit(model)).alias("model"), F.col("id").alias("sample_id"), "verified",
    )


PUBLISHED = {
    "kind": "SFT/Reasoning", "system_prompt": "System prompt", "instruction": "Instruction", "question": "Question", "think": "<Think>", "answer": "Answer", "difficulty_level": "Difficulty level",
    "words_instruction": "Number of words in instruction (preferably no. of tokens)", "words_system": "Number of words in system prompt", "words_question": "Number of words in question",
    "words_answer": "Number of words in answer", "task": "Task", "domain": "Domain", "language": "Language", "source": "Source", "made_by": "Made by", "reasoning_sft": "Reasoning/SFT",
    "model": "Model", "sample_id": "sample_id", "verified": "verified",
}


def published(record: DataFrame) -> DataFrame:
    return record.select(*[F.col(k).alias(v) for k, v in PUBLISHED.items()])


def quality_filter(record: DataFrame) -> DataFrame:
    return where_computed(record, problems.drop_reason("question", "answer").isNull())


STEPS = ("evolve", "convert", "trace", "verify", "tag", "final")


def run(seeds: DataFrame, steps: tuple[str, ...] = STEPS[1:], depth: int = 1, provider: providers.Provider | None = None, model: str = "unknown") -> DataFrame:
    """The chosen steps in order; a step that isn't named is left out, as converted rows can go straight to the end."""
    rows = seeds
    if "evolve" in steps:
        more = evolve(seeds, depth).withColumnRenamed("evolved_id", "id")
        rows = union_all(seeds, more.drop("parent_id", "mutation_strategy", "mutation_depth", "original_problem"))
    if "convert" in steps:
        rows = convert(rows)
    if "trace" in steps:
        rows = trace(rows, provider)
    if "verify" in steps:
        rows = reject_wrong(verify(rows))
    missing = {"think_trace": "string", "raw_answer": "string", "extracted_answer": "string", "verified": "boolean"}
    rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in missing.items() if c not in rows.columns})
    rows = tag(rows) if "tag" in steps else rows.withColumn("reasoning_level", F.lit(None).cast("int"))
    return quality_filter(final_record(rows, model)) if "final" in steps else rows
