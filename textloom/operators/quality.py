"""Corpus quality: score, language guess, drop reason and counters, as columns of one pass over the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as tx

#: Frequent English words of the language guess.
ENGLISH_WORDS = (
    "the", "and", "is", "in", "to", "of", "a", "that", "it", "for",
    "was", "on", "are", "with", "as", "at", "be", "this", "have", "from",
)
SAMPLE_CHARS, ENGLISH_SHARE = 1000, 0.08


def guess_language(text: Column) -> Column:
    """``en`` if over 8 % of the ASCII words among the first 1000 characters are frequent English ones, else ``unknown``."""
    found = F.regexp_extract_all(F.lower(F.substring(text, 1, SAMPLE_CHARS)), F.lit(r"(?U)\b[a-z]+\b"), F.lit(0))
    known = lambda ws: F.size(F.filter(ws, lambda w: w.isin(*ENGLISH_WORDS))).cast("double")
    share = tx.bound(found, lambda ws: known(ws) / F.nullif(F.size(ws), F.lit(0)))
    return F.when(share > F.lit(ENGLISH_SHARE), "en").otherwise("unknown")


def quality_score(text: Column) -> Column:
    """From 0 to 1: penalties, subtracted in this order, for odd characters, repeated lines, short lines and spaces."""

    def penalised(lines: Column, filled: Column) -> Column:
        distinct = F.size(F.array_distinct(F.transform(filled, tx.strip))).cast("double")
        mean_line = tx.array_sum(F.transform(filled, F.length)).cast("double") / F.nullif(F.size(filled), F.lit(0))
        score = F.lit(1.0)
        for test, weight in (
            (tx.share_in(text, r"\p{L}\p{N}" + tx.SPACE) < F.lit(0.7), 0.3),
            ((F.size(lines) > 5) & (distinct / F.size(lines) < F.lit(0.5)), 0.3),
            (mean_line < F.lit(20.0), 0.2),
            (tx.share_in(text, " ") > F.lit(0.4), 0.1),
        ):
            score = score - F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))

    by_line = lambda lines: tx.bound(F.filter(lines, lambda x: ~tx.is_blank(x)), lambda filled: penalised(lines, filled))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0.0)).otherwise(tx.bound(F.split(tx.strip(text), "\n", -1), by_line))


def drop_reason(text: Column, min_length: int = 500, max_length: int = 50_000, language: str = "en", min_score: float = 0.4) -> Column:
    """Why a document goes: ``too_short``, ``too_long``, ``language``, ``quality``; null if it stays.

    The branches are lazy, cheapest first. Only a language that is known and differs drops a document.
    """
    reason = F.when(F.length(text) < min_length, "too_short").when(F.length(text) > max_length, "too_long")
    if language:
        reason = reason.when(~guess_language(text).isin(language, "unknown"), "language")
    return reason.when(quality_score(text) < F.lit(min_score), "quality")


def with_drop_reason(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    return docs.withColumn("drop_reason", drop_reason(F.coalesce(F.col(text_col), F.lit("")), **limits))


def quality_filter(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The documents that pass; works on streams too."""
    return with_drop_reason(docs, text_col, **limits).where(F.col("drop_reason").isNull()).drop("drop_reason")


def filter_stats(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """One row: total, passed, the dropped by reason, and drop_rate."""
    reasons = with_drop_reason(docs, text_col, **limits).select("drop_reason")
    count = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("long")
    reason = F.col("drop_reason")
    out = reasons.agg(
        F.count("*").alias("total"),
        count(reason.isNull()).alias("passed"),
        *[count(reason == r).alias(f"dropped_{r}") for r in ("too_short", "too_long", "language", "quality")],
    )
    rate = F.when(F.col("total") > 0, 1.0 - F.col("passed").cast("double") / F.col("total")).otherwise(F.lit(0.0))
    return out.withColumn("drop_rate", rate)
