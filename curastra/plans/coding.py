"""Code curation: seeds from raw questions, variants, completions, trials; and conversion of external records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import code, difficulty, domains, problems, prompts, text, thinking
from ..functions.text import clean_contest_markup, filled, strip, token_estimate, truncated, word_count
from ..operators import packing, providers, sandbox
from ..operators.relational import running_index
from ..operators.scratch import cut

# The mutation menu, its default level and label, and the domains that are injected.
MUTATION_LEVEL = {
    "data_structure_mutation": 3, "constraint_mutation": 3, "concept_blending": 3, "greedy_counting": 2, "two_pointer_variant": 2, "real_world_application": 2,
    "debugging_variant": 2, "output_tracing": 1,
}
MUTATION_LABEL = {"debugging_variant": "code_edit_bugfix", "output_tracing": "codeio_tracing"}
INJECTED = [
    "space exploration and orbital mechanics", "high-frequency trading and financial markets", "genetics and DNA sequencing", "traffic management in a smart city",
    "cybersecurity and cryptographic protocols", "RPG game mechanics and inventory management", "agriculture and precision farming", "hospital logistics and patient scheduling",
    "social network analysis and recommendation systems", "logistics and supply chain optimization", "climate modelling and weather prediction", "robotics and autonomous vehicle navigation",
    "e-commerce warehouse automation", "competitive esports match statistics", "archaeological site mapping and artifact cataloguing", "submarine sonar signal processing",
    "pharmaceutical drug interaction analysis", "air traffic control and runway scheduling", "music streaming playlist generation", "wildlife conservation and animal tracking",
]
SYSTEM = "You are an expert competitive programmer. Reasoning level: "


def user_message(question: Column | str, extra: Column | None = None, options: Column | None = None, answer: Column | None = None) -> Column:
    """The question with its sections, first example, options and answer, cut to 2000 characters.

    ``extra`` is a JSON text; its examples may be an array or a JSON text of one.
    """
    out = clean_contest_markup(question)
    if extra is not None:
        for name in ("input_format", "output_format", "note"):
            v = F.coalesce(F.get_json_object(extra, f"$.{name}"), F.lit(""))
            out = F.concat(out, F.when(F.length(v) > 5, F.concat(F.lit(f"\n\n{name.replace('_', ' ').title()}:\n"), clean_contest_markup(v))).otherwise(""))
        ex = F.get_json_object(extra, "$.examples")
        part = lambda a, b: F.substring(F.coalesce(filled(F.get_json_object(ex, f"$[0].{a}")), filled(F.get_json_object(ex, f"$[0].{b}"))), 1, 200)
        given, said = part("input", "in"), part("output", "out")
        shown = F.concat(F.lit("\n\nExample:\nInput: "), given, F.lit("\nOutput: "), said)
        out = F.concat(out, F.coalesce(shown, F.lit("")))
    if options is not None:
        out = F.concat(out, F.when(F.size(options) > 0, F.concat(F.lit("\n\nOptions:\n"), F.array_join(options, "\n"))).otherwise(""))
    if answer is not None:
        out = F.concat(out, F.coalesce(F.concat(F.lit("\n\nCorrect answer: "), filled(answer)), F.lit("")))
    return truncated(out)


def seeds(raw: DataFrame, order: str = "ord") -> DataFrame:
    """Prepared seeds of raw questions: quality first, then label, level (from hint or extra), id and messages."""
    rows = raw.withColumn("question_text", strip(F.coalesce("question_text", F.lit("")))).where(problems.code_question_ok("question_text"))
    hint = F.get_json_object("extra", "$.difficulty") if "difficulty_hint" not in raw.columns else F.coalesce(filled("difficulty_hint"), F.get_json_object("extra", "$.difficulty"))
    rows = running_index(rows, "source_name", order, "_i").withColumn("reasoning_level", difficulty.code_level(hint)).withColumn("domain", domains.code_domain("question_text"))
    name = difficulty.level_name("reasoning_level", lower=False)
    rows = rows.withColumn("prompt_id", text.prompt_id("source_name", "_i", "question_text"))
    rows = rows.withColumn("messages", code.messages(F.concat(F.lit(SYSTEM), name), user_message("question_text", F.col("extra"), F.col("options"), F.col("correct_answer"))))
    tests = F.coalesce(F.get_json_object("extra", "$.public_tests"), F.lit("{}"))
    rows = rows.withColumn("public_tests", F.from_json(tests, "input array<string>, output array<string>"))
    return rows.select("prompt_id", "domain", "reasoning_level", F.col("source_name").alias("source"), "source_url", "language", "answer_source", "messages", "public_tests", order)


def variants(seed: DataFrame, n: int, provider: providers.Provider, order: str = "ord", least: int = 100) -> DataFrame:
    """n variants of every seed with a ``reject_reason``: too short, repeated (by fingerprint), or null.

    Mutation and injected domain come from a hash of seed and ordinal, so a run repeats itself.
    """
    rows = seed.withColumn("variant", F.explode(F.sequence(F.lit(1), F.lit(n))))
    rows = rows.withColumn("mutation", providers.seeded_pick(list(MUTATION_LEVEL), "prompt_id", "variant")).withColumn("injected_domain", providers.seeded_pick(INJECTED, "variant", "prompt_id"))
    rows = providers.complete(rows.withColumn("ask", prompts.variant(code.first_user("messages"), "mutation", "injected_domain")), provider, "ask", "said")
    rows = rows.withColumn("problem", problems.single_problem(F.coalesce("said", F.lit(""))))
    long_ = F.length("problem") >= least
    rank = F.struct(order, "variant")
    first = rows.where(long_).groupBy(text.fingerprint("problem").alias("_fp")).agg(F.min(rank).alias("_first"))
    rows = rows.withColumn("_fp", text.fingerprint("problem")).join(first, "_fp", "left")
    reason = F.when(~long_, "too short").when(F.col("_first") != rank, "duplicate")
    return rows.withColumn("reject_reason", reason).drop("_fp", "_first", "ask", "said")


def verified_variants(rows: DataFrame, provider: providers.Provider, enabled: bool = False, least: int = 3) -> DataFrame:
    """Variants with solution, corrected tests, level and the first reason to reject each.

    The solution runs on the inputs of its own tests, and what it prints becomes the expected output; at least ``least`` inputs
    must run. Only variants without an earlier reason are asked about and run.
    """
    open_ = cut(providers.complete(rows.where("reject_reason IS NULL").withColumn("_ask", prompts.solution_and_tests(text.trim_problem("problem"))), provider, "_ask", "_said").drop("_ask"))
    solution, tests = code.strict_code_blocks(F.coalesce("_said", F.lit("")))
    open_ = open_.withColumn("solution_code", solution).withColumn("inputs", code.test_inputs(tests)).drop("_said")
    ran = cut(sandbox.observed_outputs(open_, least=least, enabled=enabled))
    reason = F.when(F.col("solution_code") == "", "no code").when(~code.safe("solution_code"), "unsafe").when(F.col("outputs").isNull(), "not verified")
    ran = ran.withColumn("reject_reason", reason)
    good = providers.complete(ran.where("reject_reason IS NULL").withColumn("_ask", prompts.rate_code("problem", "solution_code")), provider, "_ask", "_rated")
    good = good.withColumn("rated_level", difficulty.stripped_level(F.coalesce("_rated", F.lit("")))).drop("_ask", "_rated")
    pairs = F.filter(F.arrays_zip("inputs", "outputs"), lambda p: p["outputs"].isNotNull())
    good = good.withColumn("test_code", code.test_source(F.transform(pairs, lambda p: p["inputs"]), F.transform(pairs, lambda p: p["outputs"])))
    bad = ran.where("reject_reason IS NOT NULL").unionByName(rows.where("reject_reason IS NOT NULL"), allowMissingColumns=True)
    return good.unionByName(bad, allowMissingColumns=True).drop("inputs", "outputs")


def variant_entries(accepted: DataFrame, order: str = "ord") -> DataFrame:
    """Entries of accepted variants: the rated level if it is 1 to 4, else the mutation's; the text cut to 2000."""
    level = F.coalesce(F.create_map(*[F.lit(x) for kv in MUTATION_LEVEL.items() for x in kv])[F.col("mutation")], F.lit(2))
    label = F.coalesce(F.create_map(*[F.lit(x) for kv in MUTATION_LABEL.items() for x in kv])[F.col("mutation")], F.lit("competitive_programming"))
    rated = F.when(F.col("rated_level").between(1, 4), F.col("rated_level")) if "rated_level" in accepted.columns else F.lit(None).cast("int")
    rows = accepted.withColumn("reasoning_level", F.coalesce(rated, level)).withColumn("domain", label)
    pid = F.concat("source", F.format_string("_seed%03d_var%02d_", F.col(order), F.col("variant")), F.substring(F.md5(F.substring("problem", 1, 100)), 1, 4))
    name = difficulty.level_name("reasoning_level", lower=False)
    return rows.select(pid.alias("prompt_id"), "domain", "reasoning_level", level.alias("mutation_difficulty"), F.lit("synthetic_variant").alias("source"), F.col("source").alias("original_source"),
        F.lit("verified").alias("answer_source"), F.col("mutation").alias("mutation_type"), "injected_domain", code.messages(F.concat(F.lit(SYSTEM), name), truncated(strip("problem"))).alias("messages"))


def completions(entries: DataFrame, k: int, provider: providers.Provider, model: str = "") -> DataFrame:
    """k trials of every entry: the reply as a further assistant turn; failed calls are left out."""
    rows = providers.trials(entries, k).withColumn("_ask", code.first_user("messages")).withColumn("_m", F.lit(model))
    rows = providers.complete(rows, provider, "_ask", "_said", model="_m").where("_said IS NOT NULL")
    return rows.withColumn("messages", code.append_turn("messages", "assistant", F.col("_said"))).drop("_ask", "_m", "_said")


def trial_rows(completed: DataFrame) -> DataFrame:
    """What a trial folder would hold, as columns: prompt, trace, solution, tests."""
    said = F.element_at("messages", -1)["content"]
    solution, tests = code.code_blocks(said)
    rows = completed.withColumn("prompt", code.first_user("messages")).withColumn("think_trace", thinking.think_or_preamble(said)).withColumn("solution_code", solution).withColumn("test_code", tests)
    if "public_tests" in completed.columns:
        pairs = code.test_pairs("public_tests.input", "public_tests.output")
        made = code.test_source(F.transform(pairs, lambda p: p["input"]), F.transform(pairs, lambda p: p["output"]))
        rows = rows.withColumn("test_code", F.when(F.size(pairs) > 0, made).otherwise(F.col("test_code")))
    return rows


def converted(rows: DataFrame, source: str, model: str = "unknown") -> DataFrame:
    """External question, output and solution rows in the packed schema; rows without question or solution go."""
    q, s = F.coalesce("question", F.lit("")), F.coalesce("solution", F.lit(""))
    level = F.coalesce(F.col("difficulty").cast("string"), F.lit("-1")) if "difficulty" in rows.columns else F.lit("-1")
    fixed = {**packing.FIXED, "Source": source}
    return rows.where((q != "") & (s != "")).select(
        F.lit(packing.INSTRUCTION).alias("Instruction"), F.col("question").alias("Question"), thinking.think_with_tags(F.coalesce("output", F.lit(""))).alias("<Think>"), F.col("solution").alias("Answer"),
        level.alias("Difficulty level"), token_estimate(F.lit(packing.INSTRUCTION)).alias("Number of tokens in Instruction"), token_estimate("question").alias("Number of tokens in Question"),
        token_estimate("solution").alias("Number of tokens in Answer"), *[F.lit(v).alias(k) for k, v in fixed.items()], F.lit(model).alias("Model"),
    )


def external_records(rows: DataFrame, source: str, split: str, question: Column, answer: Column, thinking_: Column, hint: Column | None = None, kind: str = "Reasoning", model: str = "unknown") -> DataFrame:
    """Records of an external dataset in the mathematics schema; questions under ten characters go."""
    q = strip(F.coalesce(question, F.lit("")))
    a = strip(F.coalesce(answer, F.lit("")))
    kind_name = "SFT" if kind.upper() == "SFT" else kind.capitalize()
    return rows.where(F.length(q) >= 10).select(
        F.lit(kind_name).alias("kind"), q.alias("question"), strip(F.coalesce(thinking_, F.lit(""))).alias("think"), a.alias("answer"), difficulty.length_label(q).alias("difficulty_level"),
        word_count(q).alias("words_question"), word_count(a).alias("words_answer"), F.lit("QA").alias("task"), domains.external_domain(q, hint).alias("domain"), F.lit("English").alias("language"),
        F.lit(source).alias("source"), F.lit("math_pipeline").alias("made_by"), F.lit(kind).alias("reasoning_sft"), F.lit(model).alias("model"),
        F.concat(F.lit(f"{source}:{split}:"), F.col("ord").cast("string")).alias("sample_id"), F.lit(False).alias("verified"),
    )


def synthetic_records(replies: DataFrame, reasoning: str = "reasoning", content: str = "content", seed: str | None = None) -> DataFrame:
    """Parsed, validated and deduplicated problems of sectioned replies; ``reason`` is null for those to keep."""
    q, s, a = problems.sections(content)
    rows = replies.withColumn("question", q).withColumn("solution", s).withColumn("model_answer", a)
    rows = rows.withColumn("reason", problems.invalid_reason("question", "solution", "model_answer"))
    about = F.concat_ws(" ", F.col(seed), F.col("question")) if seed else F.col("question")
    response = F.when(F.coalesce(F.col(reasoning), F.lit("")) != "", thinking.assemble(reasoning, "solution")).otherwise(F.col("solution"))
    return rows.withColumn("topic_guess", domains.by_keywords(about, "topic")).withColumn("model_response", response).withColumn("h", text.prefix_hash("question"))

