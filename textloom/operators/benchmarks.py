"""Evaluators: examples, prompts, batch inference, parsing and the metric, as one DataFrame pipeline each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import evaluation as ev
from textloom.operators import inference as inf


def mcq_predictions(examples: DataFrame, scorer: inf.Scorer) -> DataFrame:
    """``examples`` (question, choices, correct_index) with predicted, correct, is_correct and confidence."""
    rows = inf.score_choices(examples.withColumn("prompt", inf.mcq_prompt(F.col("question"), F.col("choices"))), scorer)
    return rows.withColumns({
        "predicted": inf.choice_label(F.col("best")), "correct": inf.choice_label(F.col("correct_index")),
        "is_correct": F.col("best") == F.col("correct_index"), "confidence": F.coalesce(F.array_max("scores"), F.lit(0.0)),
    })


def bar_exam(examples: DataFrame, scorer: inf.Scorer, threshold: float = 0.7) -> DataFrame:
    return ev.benchmark_row("bar_exam", "accuracy", ev.accuracy(mcq_predictions(examples, scorer)), "accuracy", threshold)


def general_knowledge(examples: DataFrame, scorer: inf.Scorer, subset_col: str = "subset") -> tuple[DataFrame, DataFrame]:
    """The overall row (accuracy over all rows; never marked passed) and the accuracy by subset."""
    predicted = mcq_predictions(examples, scorer)
    overall = ev.benchmark_row("general_knowledge", "accuracy", ev.accuracy(predicted), "accuracy", 0.0).withColumn("passed", F.lit(False))
    return overall, ev.accuracy_by(predicted, subset_col)


def clause_predictions(examples: DataFrame, scorer: inf.Scorer, labels: tuple[str, ...] = inf.CLAUSE_TYPES, max_new_tokens: int = 32) -> DataFrame:
    rows = inf.generate(examples.withColumn("prompt", inf.classification_prompt(F.col("text"), labels)), scorer, max_new_tokens)
    return rows.withColumn("predicted", inf.parse_label(F.col("generated"), labels))


def contract_analysis(examples: DataFrame, scorer: inf.Scorer, labels: tuple[str, ...] = inf.CLAUSE_TYPES, threshold: float = 0.8) -> DataFrame:
    predicted = clause_predictions(examples, scorer, labels)
    right = ev.accuracy(predicted.withColumn("is_correct", F.col("label") == F.col("predicted")))
    return ev.benchmark_row("contract_analysis", "f1", ev.macro_f1(predicted).crossJoin(right), "f1", threshold)


def term_accuracy(prompts: DataFrame, glossary: DataFrame, scorer: inf.Scorer, top_k: int = 200, threshold: float = 0.3, max_new_tokens: int = 256) -> DataFrame:
    """``glossary``: (rank, term), of which the first ``top_k`` count."""
    terms = glossary.orderBy("rank").limit(top_k).select("term")
    said = inf.generate(prompts, scorer, max_new_tokens)
    found = ev.term_recall(said, terms, "generated", "term", threshold)
    return ev.benchmark_row("term_accuracy", "recall", found, "term_recall", threshold, correct="unique_terms_found")


def sample_results(prompts: DataFrame, glossary: DataFrame, scorer: inf.Scorer, top_k: int = 200, ord_col: str = "ord", first: int = 5) -> DataFrame:
    """(prompt, terms_found, matched_terms) of the first prompts: 80 characters of prompt, ten terms in glossary order."""
    terms = glossary.orderBy("rank").limit(top_k)
    said = inf.generate(prompts.orderBy(ord_col).limit(first), scorer, 256)
    hits = ev.term_matches(said, terms.select("term"), "generated").join(terms, "term")
    listed = hits.groupBy(ord_col).agg(F.count("*").alias("terms_found"), F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))
    out = said.join(listed, ord_col, "left").orderBy(ord_col)
    matched = F.transform(F.slice(F.coalesce("t", F.array().cast("array<struct<rank:int,term:string>>")), 1, 10), lambda x: x["term"])
    return out.select(F.substring("prompt", 1, 80).alias("prompt"), F.coalesce("terms_found", F.lit(0)).alias("terms_found"), matched.alias("matched_terms"))


def strip_reply(reply):
    """Python-style strip of a model's reply."""
    return tx.strip(reply)
