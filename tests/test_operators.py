"""Relational, vector, generation, sandbox, source, sink and streaming operators on small tables."""

import datetime
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from curastra.functions import answers
from curastra.operators import packing, providers, relational as rel, sandbox, semantic
from curastra.plans import coding, evaluation, mathematics
from curastra.sources import registry, sinks
from curastra.streaming import incremental


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def test_keep_first_and_resume(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 1), (3, "b", 2), (4, None, 1), (5, None, 2)], "id long, k string, o long")
    assert ids(rel.keep_first(df, ["k"], ["o"])) == [2, 3, 4]
    assert ids(rel.resume(df, df.where("id < 3"), ["id"])) == [3, 4, 5]
    old = spark.createDataFrame([(9, "b", 0)], df.schema)
    assert ids(rel.append_new(old, df, "k", "o")) == [2, 4, 5]
    once = rel.dedup_fingerprint(df.withColumn("t", F.concat("k", F.lit(" "))), "t", "o")
    assert ids(rel.dedup_fingerprint(once, "t", "o")) == ids(once)


@pytest.mark.parametrize(("n", "k", "sizes"), [(10, 3, [4, 4, 2]), (5, 5, [1] * 5), (2, 4, [1, 1]), (0, 3, [])])
def test_chunks_partition_the_rows(spark, n, k, sizes):
    out = rel.contiguous_chunk(spark.range(n), ["id"], k).groupBy("chunk_id").agg(F.count("*").alias("n"), F.min("id").alias("lo")).orderBy("chunk_id").collect()
    assert [r.n for r in out] == sizes and [r.lo for r in out] == sorted(r.lo for r in out)


def test_numbered_is_global_and_ordered(spark):
    out = rel.numbered(spark.range(1000).select((1000 - F.col("id")).alias("v")), ["v"]).collect()
    assert sorted((r.rn, r.v) for r in out) == [(i, i) for i in range(1, 1001)]


def test_longest_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(["ab", "c", "de"],), ([" ", None],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(rel.longest("v")).collect()] == ["ab", None, None]


def test_counts(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (None,)], "v boolean")
    assert tuple(rel.tri_state(df, "v").first()) == (1, 1, 2, 4) and rel.reject_wrong(df, "v").count() == 3
    empty = rel.filled_histogram(spark.range(0).select(F.lit(1).alias("l")), "l", range(5)).orderBy("level").collect()
    assert [(r.level, r.n) for r in empty] == [(i, 0) for i in range(5)]
    assert rel.model_comparison(spark.createDataFrame([], "model_used string, verification string, response string"), 20).count() == 0


def test_deficit(spark):
    topics, levels = spark.createDataFrame([("a",), ("b",)], "topic string"), spark.createDataFrame([(1,), (2,)], "difficulty int")
    have = spark.createDataFrame([("a", 1)] * 3 + [("b", 2)], "topic string, difficulty int")
    needs = rel.deficit(topics, levels, have, 3)
    assert sorted((r.topic, r.difficulty, r.needed) for r in needs.collect()) == [("a", 2, 3), ("b", 1, 3), ("b", 2, 2)]
    assert rel.deficit_rows(needs).count() == 8


def brute_greedy(x, threshold):
    x, kept = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9), []
    for i in range(len(x)):
        if not any(x[i] @ x[j] > threshold for j in kept):
            kept.append(i)
    return kept


def test_semantic_dedup_is_the_greedy_rule(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    for threshold in (0.5, 0.8, 0.92):
        assert ids(semantic.semantic_dedup(df, "id", "v", threshold)) == brute_greedy(x, threshold)
    chain = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.96, 0.28]), (2, [0.8432, 0.5376])], "id long, v array<double>")
    assert ids(semantic.semantic_dedup(chain, "id", "v", 0.92)) == [0, 2]
    assert len(semantic.similar_pairs(df, "id", "v", 0.5, block=64).collect()) == int(np.triu((lambda u: u @ u.T)(x / np.linalg.norm(x, axis=1, keepdims=True)) > 0.5, 1).sum())


def test_similar_pairs_sends_a_row_to_few_blocks(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(1500, None), (1501, [1.0])], "id long, v array<double>")
    sent = {}
    for n in (750, 1500):
        pairs = semantic.similar_pairs(df.where(F.col("id") < n), "id", "v", 0.8, block=8)
        sent[n] = pairs._jdf.queryExecution().toRdd().getNumPartitions()
    assert sent[750] == sent[1500] == semantic.BLOCKS * (semantic.BLOCKS + 1) // 2
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T > 0.8, 1)))}
    got = [(r.a, r.b) for r in semantic.similar_pairs(df, "id", "v", 0.8, block=8).collect()]
    assert set(got) == want and len(got) == len(want)


def test_semantic_dedup_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(semantic, "FIRST", 40)
    monkeypatch.setattr(semantic, "PAIRS", 2)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 6))
    x[300:420] = x[299]  # many copies, some near ones, one without direction
    x[500:520] = x[499] + rng.normal(size=(20, 6)) * 0.01
    x[600] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(700, None)], "id long, v array<double>")
    written, pairs = [], semantic._settled
    monkeypatch.setattr(semantic, "_settled", lambda edges: (written.append(edges.count()), pairs(edges))[1])
    assert ids(semantic.semantic_dedup(df, "id", "v", 0.7)) == [*brute_greedy(x, 0.7), 700]
    assert 3 < len(written) and sum(written) < 0.2 * semantic.similar_pairs(df, "id", "v", 0.7).count()
    twice = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.0, 1.0])], "id long, v array<double>")
    assert ids(semantic.semantic_dedup(twice, "id", "v", 0.9)) == [0, 2]


def test_providers(spark):
    assert providers.parse_chat({"choices": [{"message": {"content": [{"text": "a"}, {"text": "b"}]}}]}) == "ab"
    assert providers.parse_chat({"choices": [{"message": {"content": "x", "reasoning_content": "r"}}]}) == "<think>r</think>\nx" and providers.parse_chat({}) is None
    assert {providers.chat_url(u) for u in ("http://h", "http://h/v1/", "http://h/v1/chat/completions")} == {"http://h/v1/chat/completions"}
    df = spark.range(50).select("id", F.col("id").cast("string").alias("p"))
    a, b = (providers.complete(df.repartition(n), providers.Offline(missing=300), "p", "said").orderBy("id").collect() for n in (2, 5))
    assert a == b and 0 < sum(r.said is None for r in a) < 50
    assert providers.Http("http://127.0.0.1:9", attempts=2, wait=0.01, timeout=1).reply("x", "m") is None
    assert providers.trials(df, 3).count() == 150


def test_generation_resumes(spark):
    inputs = spark.range(10).select(F.col("id").alias("index"), F.lit("d").alias("dataset"), F.col("id").cast("string").alias("problem"), F.lit("1").alias("expected_answer"))
    done = inputs.where("index < 4").select("index", "dataset", F.lit("m").alias("model_used"))
    out = evaluation.generate(inputs, ["m", "n"], done, providers.Offline())
    assert out.count() == 16 and evaluation.results(out).where("verification = 'unknown'").count() == 0


def test_sandbox_runs_only_what_it_may(spark):
    good = "def solve():\n    n = int(input())\n    print(n * 2)"
    rows = [(1, good, ["1", "2", "3"]), (2, "import os\nos.system('ls')\ndef solve(): pass", ["1"] * 3), (3, "def solve():\n    while True: pass", ["1"]), (4, "def solve(): raise ValueError", ["1"] * 4)]
    df = spark.createDataFrame(rows, "id long, solution_code string, inputs array<string>")
    assert all(r.outputs is None for r in sandbox.observed_outputs(df).collect())
    out = {r.id: r.outputs for r in sandbox.observed_outputs(df, seconds=2, enabled=True).collect()}
    assert out == {1: ["2", "4", "6"], 2: None, 3: None, 4: None}
    tests = "from solution import solve\ndef test_1(): assert 1\ndef test_2(): assert {}"
    df = df.where("id < 3").withColumn("test_code", F.lit(tests.format("1 == 1"))).unionByName(df.where("id = 1").withColumn("id", F.lit(5).cast("long")).withColumn("test_code", F.lit(tests.format("1 == 2"))))
    ran = {r.id: (r.result, r.log.strip()) for r in sandbox.run_tests(df.drop("inputs"), enabled=True).collect()}
    assert ran[1] == ("Pass", "2 passed in 0.00s") and ran[2][0] == "Blocked" and ran[5][0] == "Fail" and "FAILED test_solution.py::test_2" in ran[5][1]


def test_sources(spark):
    rows = spark.createDataFrame([(0, " Find the area ", "so \\boxed{3}", "x"), (1, " ", "s", "x"), (2, "Is it prime", None, "y")], "ord long, problem string, solution string, source string")
    out = registry.numina(rows, labels={"y": "geometry"}).orderBy("ord").collect()
    assert [(r.id, r.domain, r.answer) for r in out] == [("numina:train:0", "geometry", "3"), ("numina:train:2", "number_theory", None)] and json.loads(out[0].raw)["source"] == "x"
    chats = spark.createDataFrame([(0, [("user", "<b>Sum</b> it", None), ("assistant", "the answer: 7. ok", ("t", "None", "9"))])], "ord long, messages array<struct<role:string,content:string,info:struct<think_content:string,answer_content:string,reference_answer:string>>>")
    r = registry.calculator(chats.withColumn("messages", F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))))).first()
    assert (r.problem, r.answer) == ("Sum it", "7")
    r = registry.chat_records(chats).first()
    assert (r.question, r.thinking, r.answer) == ("<b>Sum</b> it", "t", "")  # an answer field that says None is empty
    wide = spark.createDataFrame([(0, "", "q text", "A")], "ord long, Question string, prompt string, final_answer string")
    assert registry.aime(wide).first().problem == "q text"
    assert registry.detect_text_field(spark.createDataFrame([("<think>" + "x" * 90, "short", "longer text")], "a string, b string, c string")) == "c"
    assert {r.column: r.missing for r in registry.profile(rows).collect()} == {"ord": 0, "problem": 0, "solution": 1, "source": 0}
    with pytest.raises(ValueError):
        registry.load(spark, {"numina": {"enabled": False}}, {})


def test_s1k_and_tw(spark):
    df = spark.createDataFrame([(0, "Find n", None, "Math", ["The answer is 4"], "long talk without a sign of any kind here", "algebra", "zh", "think")], "ord long, question string, solution string, cot_type string, thinking_trajectories array<string>, attempt string, type string, problem_zhtw string, think string")
    r = registry.s1k(df).first()
    assert (r.solution, r.answer) == ("The answer is 4", None)
    r = registry.tw_math(df.withColumn("problem", F.col("question")), chinese_problem=True, english_only=False).first()
    assert (r.problem, r.solution, r.domain) == ("zh", "think", "algebra")


def test_jsonl_and_trials(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"a": 1}\n\nnot json\n{"a": 2}\n')
    assert ids(registry.read_jsonl(spark, str(tmp_path / "a.jsonl"), "a long"), "a") == [1, 2]
    for p, t, full in (("p1", "trial_0", True), ("p1", "trial_1", False)):
        folder = tmp_path / "box" / p / t
        folder.mkdir(parents=True)
        (folder / "test_result.txt").write_text("Pass\n")
        if full:
            (folder / "data.json").write_text("{}")
    out = registry.read_trials(spark, str(tmp_path / "box")).collect()
    assert [(r.prompt_id, r.trial, r.result) for r in out] == [("p1", "trial_0", "Pass")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x", "s"), (2, "a", "y", "s"), (3, None, "y", "s")], "ord long, k string, domain string, source string")
    for _ in range(2):
        sinks.append_jsonl(df, f"{tmp_path}/out", "k", "ord")
    assert spark.read.json(f"{tmp_path}/out").count() == 3  # the keyed row once, the row without key twice
    path = sinks.write_dataset(df, f"{tmp_path}/sets", "m/1", now=datetime.datetime(2024, 1, 2))
    assert path.endswith("/y_m_1_s_3_20240102_000000.parquet") and len(sinks.datasets(spark, f"{tmp_path}/sets")) == 2
    sinks.write_step(df, f"{tmp_path}/steps", 3, "convert", ["ord", "k"])
    assert sorted(map(tuple, sinks.read_step(spark, f"{tmp_path}/steps", 3, "domain string, source string").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    sinks.clean_steps(spark, f"{tmp_path}/steps")
    assert not sinks.exists(spark, f"{tmp_path}/steps/step3")
    sinks.write_packs(df, "domain", f"{tmp_path}/packs")
    assert spark.read.parquet(f"{tmp_path}/packs/domain=y").count() == 2
    sinks.write_csv(df, f"{tmp_path}/csv")
    sinks.write_summary(spark, {"n": 3}, f"{tmp_path}/summary")
    assert json.loads(spark.read.text(f"{tmp_path}/summary").first()[0]) == {"n": 3}


def test_packing_accounts_for_every_trial(spark):
    rows = [("p", "trial_1", "Pass", "1 passed in 0.1s", "x = 1", "q", "t", 1), ("p", "trial_0", "Pass", "", "x = 2", "q", "", 1), ("q", "trial_0", "Pass", "", "eval(x)", "q", "", 1), ("q", "trial_1", "Fail", "1 failed", "eval(x)", "q", "", 1)]
    df = spark.createDataFrame(rows, "prompt_id string, trial string, result string, log string, solution_code string, question string, think_trace string, reasoning_level int")
    assert [r["Answer"] for r in packing.pack_sft(df).collect()] == ["x = 2"] and packing.pack_rl(df).count() == 2
    assert sorted(r.rejection_reason for r in packing.pack_rejected(df).collect()) == ["pytest Fail", "safety_violation"]
    assert tuple(packing.pack_counts(df).first()) == (4, 2, 2, 2, 1, 0.5)


def test_mathematics_steps(spark):
    df = spark.createDataFrame([(0, "a", "s", None, "Solve x = 2 for 1 apple", "x = 2", "2"), (1, "b", "s", "geometry", "True or false: 1 = 2", None, None), (2, "c", "s", "algebra", None, None, None)], "ord long, id string, source string, domain string, problem string, solution string, answer string")
    out = mathematics.run(df, steps=("evolve", "convert", "trace", "verify", "tag", "final"))
    assert mathematics.published(out).columns[4] == "<Think>" and set(ids(out, "sample_id")) == {"a"}
    deep = mathematics.evolve(df.where("problem IS NOT NULL"), depth=3)
    last = {r.mutation_depth: r.problem for r in deep.where("parent_id = 'a' AND mutation_strategy = 'increase_steps'").collect()}
    assert last[2].count("Additionally") == 1 and last[3].count("Additionally") == 2
    short = mathematics.run(df, steps=("convert", "final"))
    assert ids(short, "sample_id") == ["a"] and short.first().difficulty_level == "unknown"


def test_code_plan(spark):
    extra = json.dumps({"input_format": "one number", "examples": json.dumps([{"input": "1", "output": "2"}]), "public_tests": {"input": ["1"], "output": ["2"]}, "difficulty": "1600"})
    q = "You are given n integers; print the sum of all of them. " * 3
    raw = spark.createDataFrame([(0, q, "a/b", "u", "English", "x", ["A", "B"], "7", extra), (1, "short", "a/b", "u", "English", "x", [], None, "{}")], "ord long, question_text string, source_name string, source_url string, language string, answer_source string, options array<string>, correct_answer string, extra string")
    seed = coding.seeds(raw)
    r = seed.first()
    user = r.messages[1].content
    assert seed.count() == 1 and r.reasoning_level == 3 and r.prompt_id.startswith("a_b_q0001_") and "Input Format:\none number" in user and "Example:\nInput: 1\nOutput: 2" in user and user.endswith("Correct answer: 7")
    var = coding.variants(seed, 4, providers.Echo())
    assert var.count() == 4 and {x.reject_reason for x in var.collect()} <= {None, "duplicate"} and coding.variants(seed, 4, providers.Offline()).where("reject_reason IS NULL").count() == 0
    entries = coding.variant_entries(var.where("reject_reason IS NULL"))
    assert all(1 <= e.reasoning_level <= 3 for e in entries.collect())
    trials = coding.trial_rows(coding.completions(seed, 2, providers.Offline()))
    assert trials.count() == 2 and all("def test_5()" in t.test_code and t.prompt == user for t in trials.collect())
    ext = coding.external_records(raw.withColumn("ord", F.col("ord")), "s", "train", F.col("question_text"), F.col("correct_answer"), F.lit(None), kind="SFT").collect()
    assert [(e.kind, e.sample_id, e.answer) for e in ext] == [("SFT", "s:train:0", "7")]
    syn = coding.synthetic_records(spark.createDataFrame([("why", "QUESTION: " + "Find a prime number p " * 2 + "SOLUTION: " + "step " * 20 + "FINAL ANSWER: 7\nend"), (None, "nothing")], "reasoning string, content string")).collect()
    assert syn[0].reason is None and syn[0].topic_guess == "number theory" and syn[0].model_answer == "7" and syn[0].model_response.startswith("<think>why</think>\n") and syn[1].reason == "question too short"


def test_streams(spark, tmp_path):
    first = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "b", "z")], "ord long, k string, t string")
    first.coalesce(1).write.parquet(f"{tmp_path}/in")
    for more in (None, spark.createDataFrame([(4, "b", "again"), (5, "c", "new")], first.schema)):
        if more is not None:
            more.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.append_new_keys(incremental.read_stream(spark, f"{tmp_path}/in", first.schema), "k", "ord", f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    assert sorted((r.ord, r.k) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(1, "a"), (3, "b"), (5, "c")]


def test_windows_on_streams(spark, tmp_path):
    rows = spark.createDataFrame([(datetime.datetime(2024, 1, 1, h, 5), "a") for h in (0, 0, 1, 5)], "ts timestamp, kind string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = incremental.read_stream(spark, f"{tmp_path}/in", rows.schema)
    counts = incremental.windowed_counts(stream, "ts", ["kind"])
    counts.writeStream.format("memory").queryName("w").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start().awaitTermination()
    assert [r.n for r in spark.table("w").orderBy("start").collect()] == [2, 1]


def test_answers_pick_first_usable(spark):
    df = spark.createDataFrame([([" ", None, "Answer: 5."],), ([],)], "v array<string>")
    assert [r[0] for r in df.select(answers.pick_reference_of("v")).collect()] == ["5", None]


class Coder(providers.Provider):
    """Replies to every prompt of the variant plan."""

    def reply(self, prompt, model):
        if "seed" in prompt and "PROBLEM:" in prompt:
            return "PROBLEM: " + prompt[-90:] + " Given n, print twice n. " + "Mind the limits. " * 6
        if "<|Solution Begin|>" in prompt:
            return "<|Solution Begin|>def solve():\n    print(int(input()) * 2)<|Solution End|><|Test Begin|>" + "\n".join(f'def test_{i}(): assert run("{i}") == "0"' for i in range(1, 6)) + "<|Test End|>"
        return "Level 3" if "Rate" in prompt else "<think>so</think> A harder problem: " + prompt[-30:]


def test_variants_are_run_and_rated(spark):
    q = "You are given n integers; print the sum of all of them. " * 3
    raw = spark.createDataFrame([(0, q, "s", "u", "English", "x", [], None, "{}")], "ord long, question_text string, source_name string, source_url string, language string, answer_source string, options array<string>, correct_answer string, extra string")
    rows = coding.variants(coding.seeds(raw), 3, Coder())
    out = coding.verified_variants(rows, Coder(), enabled=True).collect()
    good = [r for r in out if r.reject_reason is None]
    assert len(out) == 3 and good and all(r.rated_level == 3 and "run('5') == '10'" in r.test_code for r in good)
    off = coding.verified_variants(rows, Coder()).collect()
    assert {r.reject_reason for r in off} <= {"not verified", "duplicate"} and coding.variant_entries(spark.createDataFrame(good, coding.verified_variants(rows, Coder()).schema)).first().reasoning_level == 3


def test_evolution_by_a_model(spark):
    df = spark.createDataFrame([(0, "a", "s", "algebra", "Find x with x + 1 = 2"), (1, "b", "s", None, "")], "ord long, id string, source string, domain string, problem string")
    out = mathematics.evolve_with(df, Coder(), depth=2)
    assert {r.mutation_depth for r in out.collect()} == {1, 2} and out.where("parent_id = 'a'").count() == 10
    assert mathematics.evolve_with(df, providers.Offline(missing=1000)).count() == 0
    traced = mathematics.trace(mathematics.convert(df.withColumn("solution", F.lit(None).cast("string")).withColumn("answer", F.lit("3"))), Coder())
    assert traced.where("NOT teacher_fallback AND think_trace = 'so'").count() == 2
