"""Quality of generated text: repetition ratios, score, check reason and counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as tx


def repetition_ratio(text: Column, n: int = 3) -> Column:
    """Share of word n-grams that repeat another; 0 under 2n words."""
    shared = lambda t: F.when(F.size(t) >= 2 * n, tx.bound(tx.ngrams(t, n, "\x00"), tx.distinct_share_lost))
    return F.coalesce(tx.bound(tx.words(F.lower(text)), shared), F.lit(0.0))


def _repeated_sentences(said: Column) -> Column:
    share = lambda s: F.when(F.size(s) >= 2, tx.bound(F.transform(s, F.lower), tx.distinct_share_lost))
    return F.coalesce(tx.bound(said, share), F.lit(0.0))


def sentence_repetition_ratio(text: Column) -> Column:
    """Share of sentences, in lower case, that repeat another; 0 under two sentences."""
    return _repeated_sentences(tx.sentences(text))


def _score(text: Column, grams: Column, said: Column, n_sentences: Column) -> Column:
    some = lambda test, weight: F.when(test, F.lit(weight))
    zero = F.lit(0.0)
    score = F.lit(1.0)
    for penalty in (
        some(tx.share_in(text, r"\p{L}") < F.lit(0.5), 0.3),
        some(tx.share_in(text, tx.SPACE) > F.lit(0.4), 0.2),
        some((n_sentences < 2) & (F.length(text) > 200), 0.2),
        some(grams > F.lit(0.3), 0.3).when(grams > F.lit(0.15), F.lit(0.15)),
        some(said > F.lit(0.3), 0.3),
    ):
        score = score - penalty.otherwise(zero)
    return F.when(tx.is_blank(text), zero).otherwise(F.greatest(zero, score))


def synthetic_score(text: Column) -> Column:
    """From 0 to 1: penalties, subtracted in this order, for few letters, white space, no sentences and repetition."""
    return _score(text, repetition_ratio(text), sentence_repetition_ratio(text), F.size(tx.sentences(text)))


def _reason(text: Column, grams: Column, score: Column, min_length: int = 50, max_length: int = 10_000, min_score: float = 0.5, max_repetition: float = 0.4) -> Column:
    return (
        F.when(F.length(text) < min_length, "too_short")
        .when(F.length(text) > max_length, "too_long")
        .when(grams > F.lit(max_repetition), "too_repetitive")
        .when(score < F.lit(min_score), "low_quality")
        .otherwise("passed")
    )


def check(text: Column, **limits) -> Column:
    """``passed``, or the first of ``too_short``, ``too_long``, ``too_repetitive`` and ``low_quality``.

    Limits: ``min_length`` 50, ``max_length`` 10000, ``min_score`` 0.5, ``max_repetition`` 0.4.
    """
    return _reason(text, repetition_ratio(text), synthetic_score(text), **limits)


def with_checks(examples: DataFrame, field: str = "answer", **limits) -> DataFrame:
    """Adds ``_score`` and ``_reason``. Each measure of the text is a column of its own, so it is computed once."""
    text = F.coalesce(F.col(field), F.lit(""))
    rows = examples.withColumns({"_grams": repetition_ratio(text), "_sentences": tx.sentences(text)})
    rows = rows.withColumns({"_said": _repeated_sentences(F.col("_sentences")), "_n": F.size("_sentences")})
    rows = rows.withColumn("_score", _score(text, F.col("_grams"), F.col("_said"), F.col("_n")))
    return rows.withColumn("_reason", _reason(text, F.col("_grams"), F.col("_score"), **limits)).drop("_grams", "_sentences", "_said", "_n")


def filter_examples(examples: DataFrame, field: str = "answer", **limits) -> DataFrame:
    """Examples whose ``field`` passes, with ``quality_score`` replaced by its score."""
    rows = with_checks(examples.drop("quality_score"), field, **limits)
    # a filter on the reason would be pushed below the measures and compute them again
    score = F.explode(F.when(F.col("_reason") == "passed", F.array("_score")).otherwise(F.array().cast("array<double>")))
    return rows.withColumn("quality_score", score).drop("_score", "_reason")


def check_stats(examples: DataFrame, field: str = "answer", **limits) -> DataFrame:
    """One row: total, passed, counts by reason, and pass_rate; add rows of several calls to accumulate."""
    rows = with_checks(examples.select(field), field, **limits).select(F.col("_reason").alias("reason"))
    count = lambda r: F.coalesce(F.sum((F.col("reason") == r).cast("long")), F.lit(0)).cast("long")
    out = rows.agg(F.count("*").alias("total"), *[count(r).alias(r) for r in ("passed", "too_short", "too_long", "too_repetitive", "low_quality")])
    return out.withColumn("pass_rate", F.col("passed").cast("double") / F.greatest(F.col("total"), F.lit(1)))
