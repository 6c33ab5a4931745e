"""Evaluation of generations: split, extract, verify, rate; and the loop over models and datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers, difficulty, thinking
from ..operators import providers
from ..operators.relational import combine, resume


def results(generations: DataFrame) -> DataFrame:
    """Judged rows of non-empty generations: response, ground_truth, difficulty, domain, verification, answer.

    Without a closing tag the answer is sought in the generation as it is, and the stripped one is the reasoning.
    """
    rows = generations.where(F.coalesce(F.col("generation"), F.lit("")) != "")
    # what later steps read more than once is a column, computed once
    rows = rows.withColumn("_low", F.lower("generation")).withColumn("_tag", thinking.closer("_low")).withColumn("_at", F.position("_tag", "_low"))
    reasoning, after = thinking.split_at("generation", "_low", "_tag", "_at")
    rows = rows.withColumn("reasoning", reasoning).withColumn("after", after)
    rows = rows.withColumn("_why", F.when(F.col("_tag").isNotNull(), F.col("reasoning")).otherwise(F.col("generation")))
    rows = rows.withColumn("answer", answers.eval_answer("after", "_why")).drop("_low", "_tag", "_at", "_why")
    truth = F.when(F.coalesce(F.col("expected_answer"), F.lit("")) != "", answers.expected_number("expected_answer"))
    response = F.concat(F.lit("<think>"), "reasoning", F.lit("</think>\n"), "answer")
    rows = rows.withColumn("ground_truth", truth).withColumn("verification", answers.eval_verify("answer", "expected_answer", "ground_truth"))
    return rows.withColumn("response", response).withColumn("difficulty", difficulty.eval_level("problem")).withColumn("domain", F.lit("math"))


def generate(inputs: DataFrame, models: list[str], done: DataFrame | None, provider: providers.Provider) -> DataFrame:
    """One generation for each input and model that isn't done; a failed call gives ''."""
    todo = combine(inputs, "model_used", models)
    if done is not None:
        todo = resume(todo, done, ["index", "dataset", "model_used"])
    said = providers.complete(todo, provider, "problem", "generation", model="model_used")
    return said.withColumn("generation", F.coalesce("generation", F.lit("")))
