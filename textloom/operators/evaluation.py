"""Evaluation: accuracy, macro F1, glossary recall, retention and report roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Prompts that terminology is measured on by default.
TERM_PROMPTS = (
    "Explain the concept of breach of fiduciary duty in corporate law.",
    "What are the key elements of a valid contract under common law?",
    "Describe the difference between actual and constructive notice in property law.",
    "Explain the doctrine of respondeat superior and its limitations.",
    "What constitutes tortious interference with a contractual relationship?",
    "Describe the requirements for establishing standing in federal court.",
    "Explain the parol evidence rule and its exceptions.",
    "What are the key considerations in a motion for summary judgment?",
    "Describe the concept of strict liability in product liability cases.",
    "Explain the differences between express and implied warranties.",
)
#: Subsets of the general-knowledge test.
KNOWLEDGE_SUBSETS = ("abstract_algebra", "college_mathematics", "high_school_us_history", "logical_fallacies", "world_religions")
TERMS_PER_BATCH = 5_000


def accuracy(predictions: DataFrame, correct_col: str = "is_correct") -> DataFrame:
    """One row: num_examples, num_correct, accuracy (0 without rows)."""
    right = F.coalesce(F.col(correct_col), F.lit(False))
    out = predictions.agg(F.count("*").alias("num_examples"), F.coalesce(F.sum(right.cast("long")), F.lit(0)).alias("num_correct"))
    share = F.when(F.col("num_examples") > 0, F.col("num_correct").cast("double") / F.col("num_examples"))
    return out.withColumn("accuracy", share.otherwise(F.lit(0.0)))


def accuracy_by(predictions: DataFrame, group_col: str, correct_col: str = "is_correct") -> DataFrame:
    """Accuracy of each group, and of all rows together in the row whose ``is_total`` is true (one rollup)."""
    right = F.coalesce(F.col(correct_col), F.lit(False)).cast("long")
    out = predictions.rollup(group_col).agg(
        F.grouping(group_col).cast("boolean").alias("is_total"), F.count("*").alias("num_examples"), F.sum(right).alias("num_correct")
    )
    return out.withColumn("accuracy", F.col("num_correct").cast("double") / F.col("num_examples"))


def f1_by_label(pairs: DataFrame, true_col: str = "label", pred_col: str = "predicted") -> DataFrame:
    """(label, tp, fp, fn, precision, recall, f1) over the union of true and predicted labels; 0 for empty denominators."""
    t, p = F.col(true_col), F.col(pred_col)
    same = t.eqNullSafe(p)
    one = lambda label, tp, fp, fn: F.struct(label.alias("label"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    yes, no = F.lit(1), F.lit(0)
    votes = F.when(same, F.array(one(t, yes, no, no))).otherwise(F.array(one(t, no, no, yes), one(p, no, yes, no)))
    sums = pairs.select(F.inline(votes)).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    ratio = lambda a, b: F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))
    sums = sums.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return sums.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def macro_f1(pairs: DataFrame, true_col: str = "label", pred_col: str = "predicted") -> DataFrame:
    """One row: unweighted means of precision, recall and f1 over the labels; zeros without rows."""
    mean = lambda c: F.coalesce(F.avg(c), F.lit(0.0)).alias(c)
    return f1_by_label(pairs, true_col, pred_col).agg(F.count("*").alias("num_labels"), mean("precision"), mean("recall"), mean("f1"))


def _pattern(term: Column) -> Column:
    return F.concat(F.lit(r"(?U)\b\Q"), F.lower(term), F.lit(r"\E\b"))


def term_matches(texts: DataFrame, terms: DataFrame, text_col: str = "text", term_col: str = "term") -> DataFrame:
    """(all columns of ``texts``, term): glossary terms that occur in a text as whole words, case ignored.

    A glossary is a stated query set: it is broadcast when it holds at most TERMS_PER_BATCH terms, and otherwise is
    dealt out in batches of that size, each matched against all texts. A cheap substring test goes before the pattern.
    """
    count = terms.count()
    clashing = term_col in texts.columns
    names = terms.select(F.col(term_col).alias("_term"))
    batches = -(-count // TERMS_PER_BATCH) or 1
    parts = [names] if batches == 1 else [names.where(F.pmod(F.xxhash64("_term"), F.lit(batches)) == k) for k in range(batches)]
    out = None
    for part in parts:
        hit = F.contains(F.lower(F.col(text_col)), F.lower("_term")) & F.rlike(F.lower(F.col(text_col)), _pattern(F.col("_term")))
        one = texts.join(F.broadcast(part), hit)
        out = one if out is None else out.unionByName(one)
    return out.drop(term_col).withColumnRenamed("_term", term_col) if clashing else out.withColumnRenamed("_term", term_col)


def term_recall(texts: DataFrame, terms: DataFrame, text_col: str = "text", term_col: str = "term", threshold: float = 0.3) -> DataFrame:
    """One row: total_terms, num_examples, unique_terms_found, term_recall, avg_terms_per_prompt, passed."""
    hits = term_matches(texts, terms, text_col, term_col).agg(F.count("*").alias("hits"), F.countDistinct(term_col).alias("unique_terms_found"))
    out = hits.crossJoin(terms.agg(F.count("*").alias("total_terms"))).crossJoin(texts.agg(F.count("*").alias("num_examples")))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(0.0))
    out = out.withColumn("term_recall", ratio("unique_terms_found", "total_terms")).withColumn("avg_terms_per_prompt", ratio("hits", "num_examples"))
    return out.withColumn("passed", F.col("term_recall") >= threshold).drop("hits")


def compare_results(base: DataFrame, adapted: DataFrame, max_drop: float = 0.05, ord_col: str = "ord") -> DataFrame:
    """(ord, name, base_score, adapted_score, delta, drop, retained) of tests in both; of a repeated name, on either side, the
    last row's score counts, at the place of the first."""
    last = lambda df, name: df.groupBy("name").agg(F.min(ord_col).alias(ord_col), F.max_by("score", ord_col).alias(name))
    b = last(base, "base_score")
    a = last(adapted, "adapted_score").drop(ord_col)
    out = b.join(a, "name").withColumn("delta", F.col("adapted_score") - F.col("base_score"))
    out = out.withColumn("drop", F.greatest(F.lit(0.0), F.col("base_score") - F.col("adapted_score")))
    return out.withColumn("retained", F.col("drop") <= max_drop)


def missing_results(base: DataFrame, adapted: DataFrame) -> DataFrame:
    """Names of base tests that the adapted model has no result for."""
    return base.select("name").distinct().join(adapted.select("name"), "name", "left_anti")


def retention_summary(compared: DataFrame) -> DataFrame:
    """One row: all_retained (true without rows), worst_drop, average_delta."""
    return compared.agg(
        F.coalesce(F.bool_and("retained"), F.lit(True)).alias("all_retained"),
        F.coalesce(F.max("drop"), F.lit(0.0)).alias("worst_drop"),
        F.coalesce(F.avg("delta"), F.lit(0.0)).alias("average_delta"),
    )


def benchmark_row(name: str, metric: str, scored: DataFrame, score: str, threshold: float, examples: str = "num_examples", correct: str | None = "num_correct") -> DataFrame:
    """(name, metric, score, num_examples, num_correct, passing_threshold, passed) from a one-row metric."""
    return scored.select(
        F.lit(name).alias("name"), F.lit(metric).alias("metric"), F.col(score).cast("double").alias("score"),
        F.col(examples).cast("long").alias("num_examples"), (F.col(correct) if correct else F.lit(0)).cast("long").alias("num_correct"),
        F.lit(threshold).alias("passing_threshold"), (F.col(score) >= threshold).alias("passed"),
    )


def report_summary(benchmarks: DataFrame) -> DataFrame:
    """One row: overall_domain_score (unweighted mean, 0 without rows), all_benchmarks_passed (true without rows)."""
    return benchmarks.agg(
        F.coalesce(F.avg("score"), F.lit(0.0)).alias("overall_domain_score"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_benchmarks_passed"),
    )


def _so_far(ord_col: str, group_col: str | None):
    keys = [group_col] if group_col else []  # ungrouped, the order of all rows is one task's, as any running total's is
    return Window.partitionBy(*keys).orderBy(ord_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_accuracy(predictions: DataFrame, ord_col: str, group_col: str | None = None, correct_col: str = "is_correct") -> DataFrame:
    """Accuracy so far, in order, within each group or, without one, over all rows."""
    return predictions.withColumn("running_accuracy", F.avg(F.col(correct_col).cast("double")).over(_so_far(ord_col, group_col)))


def running_macro_f1(predictions: DataFrame, labels: tuple[str, ...], ord_col: str, group_col: str | None = None, true_col: str = "label", pred_col: str = "predicted") -> DataFrame:
    """Macro F1 so far over those of ``labels`` that were seen or predicted, in order; 0 before any of them."""
    w, t, p = _so_far(ord_col, group_col), F.col(true_col), F.col(pred_col)
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long")).over(w)
    # f1 = 2 tp / (rows of that label + rows predicted so)
    parts = [F.struct(count((t == x) & (p == x)).alias("tp"), (count(t == x) + count(p == x)).alias("n")) for x in labels]
    out = predictions.withColumn("_parts", F.filter(F.array(*parts), lambda x: x["n"] > 0))
    total = F.aggregate("_parts", F.lit(0.0), lambda acc, x: acc + 2.0 * x["tp"] / x["n"])
    return out.withColumn("running_f1", F.when(F.size("_parts") > 0, total / F.size("_parts")).otherwise(F.lit(0.0))).drop("_parts")
