import pytest
from pyspark.sql import functions as F

from textloom.operators import benchmarks, evaluation, inference
from textloom.operators.inference import StubScorer


def test_accuracy(spark):
    rows = spark.createDataFrame([(True,), (False,)], "is_correct boolean")
    assert evaluation.accuracy(rows).first()["accuracy"] == 0.5
    assert evaluation.accuracy(rows.limit(0)).first()["accuracy"] == 0.0


def test_macro_f1_counts_labels_of_both_sides(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "label string, predicted string")
    row = evaluation.macro_f1(rows).first()
    assert row["num_labels"] == 3 and row["f1"] == pytest.approx((2 / 3 + 0 + 1) / 3)
    assert evaluation.macro_f1(rows.limit(0)).first()["f1"] == 0.0


def test_whole_words_only(spark):
    rows = spark.createDataFrame([(1, "A contractual note"), (2, "the Contract (a+b) ends")], "i int, text string")
    names = spark.createDataFrame([("contract",), ("a+b",)], "term string")
    assert sorted(map(tuple, evaluation.term_matches(rows, names).select("i", "term").collect())) == [(2, "a+b"), (2, "contract")]


def test_retention_limits_are_not_rounded(spark):
    frame = lambda *rows: spark.createDataFrame([(k, n, s) for k, (n, s) in enumerate(rows)], "ord int, name string, score double")
    out = evaluation.compare_results(frame(("a", 0.75), ("b", 0.70), ("gone", 1.0)), frame(("a", 0.1), ("a", 0.70), ("b", 0.65)))
    assert [(r["name"], r["retained"]) for r in out.orderBy("ord").collect()] == [("a", False), ("b", True)]
    assert evaluation.retention_summary(out.limit(0)).first()["all_retained"]
    assert [r["name"] for r in evaluation.missing_results(frame(("gone", 1.0)), frame(("a", 1.0))).collect()] == ["gone"]


@pytest.mark.parametrize(("reply", "label"), [
    ("Governing Law", "governing_law"), ("termination_x", "termination"), ("indem...", "indemnification"), ("", "unknown"), ("?", "unknown"),
])
def test_parse_label(spark, reply, label):
    assert spark.createDataFrame([(reply,)], "r string").select(inference.parse_label(F.col("r"))).first()[0] == label


def test_prompts_and_evaluators(spark):
    rows = spark.createDataFrame([("what is law", ["law is law", "fish"], 0)], "question string, choices array<string>, correct_index int")
    prompt = rows.select(inference.mcq_prompt(F.col("question"), F.col("choices"))).first()[0]
    assert prompt == "Question: what is law\n\nA. law is law\nB. fish\n\nAnswer:"
    assert benchmarks.bar_exam(rows, StubScorer()).first()["passed"]
    overall, by = benchmarks.general_knowledge(rows.withColumn("subset", F.lit("s")), StubScorer())
    assert not overall.first()["passed"] and by.count() == 2
    clauses = spark.createDataFrame([("termination of this contract", "termination")], "text string, label string")
    assert benchmarks.contract_analysis(clauses, StubScorer()).first()["name"] == "contract_analysis"
    prompts = spark.createDataFrame([(0, "explain the tort of trespass")], "ord int, prompt string")
    glossary = spark.createDataFrame([(0, "tort"), (1, "fish")], "rank int, term string")
    row = benchmarks.term_accuracy(prompts, glossary, StubScorer()).first()
    assert (row["score"], row["num_correct"], row["passed"]) == (0.5, 1, True)
    assert benchmarks.sample_results(prompts, glossary, StubScorer()).first()["matched_terms"] == ["tort"]


def test_a_repeated_name_counts_by_its_last_row_at_its_first_place(spark):
    rows = lambda xs: spark.createDataFrame([(k, n, s) for k, (n, s) in enumerate(xs)], "ord long, name string, score double")
    out = evaluation.compare_results(rows([("a", 0.1), ("b", 0.5), ("a", 0.9)]), rows([("b", 0.4), ("a", 0.2), ("a", 0.8)])).orderBy("ord").collect()
    assert [(r["name"], r["base_score"], r["adapted_score"]) for r in out] == [("a", 0.9, 0.8), ("b", 0.5, 0.4)]
