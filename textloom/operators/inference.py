"""Batch inference behind a small protocol, and the prompts and parsers around it."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as tx

#: Contract clause labels.
CLAUSE_TYPES = (
    "termination", "indemnification", "limitation_of_liability", "confidentiality", "non_compete",
    "governing_law", "force_majeure", "assignment", "dispute_resolution", "intellectual_property",
)


class Scorer(Protocol):
    """A model. Objects are pickled to the executors; load weights lazily there."""

    def generate(self, prompts: list[str], max_new_tokens: int) -> list[str]: ...

    def loglik(self, prompts: list[str], continuations: list[str]) -> list[float]:
        """Mean log likelihood of the tokens of prompt and continuation together."""
        ...


class StubScorer:
    """Deterministic stand-in: echoes the prompt's end and prefers continuations that share words with the prompt."""

    def generate(self, prompts: list[str], max_new_tokens: int = 128) -> list[str]:
        return [" ".join(p.split()[-max_new_tokens:]) for p in prompts]

    def loglik(self, prompts: list[str], continuations: list[str]) -> list[float]:
        shared = (len(set(p.lower().split()) & set(c.lower().split())) / (1 + len(c.split())) for p, c in zip(prompts, continuations, strict=True))
        return [s - 1.0 for s in shared]


def generate(rows: DataFrame, scorer: Scorer, max_new_tokens: int = 128, prompt_col: str = "prompt") -> DataFrame:
    """Adds ``generated``, stripped."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(generated=[g.strip() for g in scorer.generate(pdf[prompt_col].tolist(), max_new_tokens)])

    return rows.mapInPandas(run, T.StructType([*rows.schema.fields, T.StructField("generated", T.StringType())]))


def score_choices(rows: DataFrame, scorer: Scorer, prompt_col: str = "prompt", choices_col: str = "choices") -> DataFrame:
    """Adds ``scores``, one a choice for "prompt choice", and ``best``: the index of the first greatest (-1 without choices)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = [len(c) for c in pdf[choices_col]]
            prompts = [p for p, n in zip(pdf[prompt_col], sizes, strict=True) for _ in range(n)]
            flat = iter(scorer.loglik(prompts, [x for c in pdf[choices_col] for x in c]) if prompts else [])
            yield pdf.assign(scores=[[next(flat) for _ in range(n)] for n in sizes])

    scored = rows.mapInPandas(run, T.StructType([*rows.schema.fields, T.StructField("scores", T.ArrayType(T.DoubleType()))]))
    return scored.withColumn("best", first_greatest(F.col("scores")))


def first_greatest(scores: Column) -> Column:
    return F.coalesce(F.array_position(scores, F.array_max(scores)) - 1, F.lit(-1)).cast("int")


def choice_label(index: Column) -> Column:
    """A to D, then the index itself."""
    return F.when(index.between(0, 3), F.substring(F.lit("ABCD"), index + 1, F.lit(1))).otherwise(index.cast("string"))


def mcq_prompt(question: Column, choices: Column) -> Column:
    lines = F.transform(choices, lambda c, i: F.concat(choice_label(i), F.lit(". "), c, F.lit("\n")))
    return F.concat(F.lit("Question: "), question, F.lit("\n\n"), F.array_join(lines, ""), F.lit("\nAnswer:"))


def classification_prompt(clause: Column, labels: tuple[str, ...] = CLAUSE_TYPES) -> Column:
    listed = ", ".join(labels or CLAUSE_TYPES)
    head = f"Classify the following contract clause into one of these categories: {listed}\n\nClause: "
    return F.concat(F.lit(head), clause, F.lit("\n\nCategory:"))


def parse_label(response: Column, labels: tuple[str, ...] = CLAUSE_TYPES) -> Column:
    """The first label found in a reply: as it is, then with spaces for underscores, then by its first four letters."""
    said = tx.strip(F.lower(F.coalesce(response, F.lit(""))))
    first_word = F.coalesce(F.get(tx.words(said), F.lit(0)), F.lit(""))
    tests = [F.contains(said, F.lit(x)) for x in labels]
    tests += [F.contains(said, F.lit(x.replace("_", " "))) for x in labels]
    tests += [F.startswith(first_word, F.lit(x[:4])) for x in labels]
    found = [F.when(t, F.lit(x)) for t, x in zip(tests, [*labels] * 3, strict=True)]
    return F.when(said == "", F.lit("unknown")).otherwise(F.coalesce(*found, F.lit("unknown")))
