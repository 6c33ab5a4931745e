"""Packing of code trials into supervised, reinforcement and rejected records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import code
from ..functions.text import strip, token_estimate
from .relational import keep_first

# Fixed values of the packed records.
INSTRUCTION = "Solve the given coding problem. Provide a step-by-step reasoning trace inside <think> tags, followed by the complete Python solution."
FIXED = {"Task": "Code Generation", "Domain": "Code", "Language": "English", "Source": "synthetic_data", "Made by": "code_pipeline", "Reasoning/SFT": "Reasoning"}


def scanned(trials: DataFrame) -> DataFrame:
    """Trials with the parsed log, safety, and the reason of rejection (null: accepted)."""
    log = code.test_log("log")
    reason = F.when(F.col("result") != "Pass", F.concat(F.lit("pytest "), F.col("result"))).when(~F.col("safe"), "safety_violation")
    return trials.withColumn("safe", code.safe("solution_code")).withColumn("parsed", log).withColumn("rejection_reason", reason)


def records(accepted: DataFrame, model: str = "unknown") -> DataFrame:
    think = strip(F.coalesce("think_trace", F.lit("")))
    return accepted.select(
        "prompt_id", "trial",
        F.lit(INSTRUCTION).alias("Instruction"), F.col("question").alias("Question"),
        F.when(think != "", F.concat(F.lit("<think>\n"), think, F.lit("\n</think>"))).otherwise("").alias("<Think>"),
        F.col("solution_code").alias("Answer"), F.col("reasoning_level").alias("Difficulty level"),
        token_estimate(F.lit(INSTRUCTION)).alias("Number of tokens in Instruction"), token_estimate("question").alias("Number of tokens in Question"),
        token_estimate("solution_code").alias("Number of tokens in Answer"), *[F.lit(v).alias(k) for k, v in FIXED.items()], F.lit(model).alias("Model"),
    )


def pack_rl(trials: DataFrame, model: str = "unknown") -> DataFrame:
    """All accepted trials."""
    return records(scanned(trials).where("rejection_reason IS NULL"), model)


def pack_sft(trials: DataFrame, model: str = "unknown") -> DataFrame:
    """The first accepted trial of each prompt, by the number at the end of its name."""
    number = F.regexp_extract("trial", r"(\d+)$", 1).try_cast("long")
    return keep_first(pack_rl(trials, model), ["prompt_id"], [number, "trial"])


def pack_rejected(trials: DataFrame) -> DataFrame:
    return scanned(trials).where("rejection_reason IS NOT NULL").select("prompt_id", "trial", "rejection_reason", "parsed.tests_passed", "parsed.tests_failed")


def pack_counts(trials: DataFrame) -> DataFrame:
    s = scanned(trials)
    ok = F.col("rejection_reason").isNull()
    out = s.agg(F.count("*").alias("total"), F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"), F.count_if(~F.col("safe")).alias("safety_blocked"), F.count_distinct(F.when(ok, F.col("prompt_id"))).alias("sft_unique"))
    return out.withColumn("pass_rate", F.when(F.col("total") > 0, F.col("accepted") / F.col("total")).otherwise(0.0))
