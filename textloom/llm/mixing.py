"""Mixing sources to target weights by hash-threshold histograms.

Every row gets a 48-bit hash of its id. Sizes are summed by source and leading 16 hash bits; the budget's threshold
lies in one bucket of each source, whose rows are set aside and alone summed again by the next 8 bits, until all 48 are
used. Rows below the threshold are taken, rows above are not: thresholds nest, so a larger budget keeps what a smaller takes.
Nothing is sorted by size or hash and no row meets another.

A target above a source's size takes whole passes of it (at most ``max_repeats``) and a threshold's part of one more.
Rows that share the threshold hash itself (one row, barring repeated ids) share what is left of the budget in
proportion to their sizes, so a source's total meets its target to within rounding.

Only DataFrame functions. Sums are partial before each shuffle, tables by source hold one row per source and join
broadcast under a row count, salted beyond it.

Defined cases: null texts have size 0; a null source is a source, last in order; sources whose rows have no words
get target 0; null or repeated ids hash alike and share a threshold in proportion; an empty table gives no rows;
other columns pass through under any name, except ones named as the added columns, which are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import WORD, column, join_small, prefixed, stored, working

#: Hash bits by which the boundary bucket is refined; 48 in all.
LEVEL_BITS = (16, 8, 8, 8, 8)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_hash(doc_id: Column) -> Column:
    """48 bits of the md5 of the id's decimal text, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code point order, null last, take ``weights`` in turn and share the total size by them. A target
    stops at ``max_repeats`` times its source's size and the excess is shared among the others, until none is above:
    in order of size over weight, the capped sources are those whose cap lies under the share left to them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    rows = totals.withColumn("i", F.row_number().over(named) - 1).withColumn("w", weight)
    rows = rows.withColumn("cap", F.col("source_size") * max_repeats)
    full = Window.orderBy(F.col("cap") / F.col("w"), "i")
    before, on = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rows = rows.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    rows = rows.withColumn("left_w", F.sum("w").over(on))
    # capped while cap <= left * w / left_w; the first that is not sets the rate for all after it
    rows = rows.withColumn("open", F.col("cap") * F.col("left_w") > F.col("left") * F.col("w"))
    rate = lambda c: F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), "i", c))).over(everything)[c]
    rows = rows.withColumn("rate_left", rate("left")).withColumn("rate_w", rate("left_w"))
    target = F.when(F.col("open"), F.col("rate_left").cast("double") * F.col("w") / F.col("rate_w")).otherwise(F.col("cap").cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def _bucket(level: int) -> Column:
    """The hash bits up to ``level``'s end."""
    return F.shiftright("hash", sum(LEVEL_BITS[level:]))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_repeats: int = 3, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target and taken: ``taken // size`` whole copies and ``taken % size`` words more."""
    slim = stored(docs.select(column(source_col).alias("source"), id_hash(column(id_col)).alias("hash"), word_count(column(text_col)).alias("size")))
    plan = thresholds(slim, weights, max_repeats)
    added = ["size", "source_size", "target", "taken"]
    kept = [c for c in docs.columns if c not in added]
    rows = docs.select(*[prefixed(c) for c in kept], word_count(column(text_col)).alias("_size"), id_hash(column(id_col)).alias("_hash"), column(source_col).alias("_source"))
    return _taken(rows, plan).select(*[F.col(working(c)).alias(c) for c in kept], *added)


def thresholds(slim: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """By source: source_size, target, passes (whole ones), prefix (the threshold hash), rest (words left at it), tied."""
    plan = source_targets(slim.select("source", "size"), weights, max_repeats)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    size = F.greatest("source_size", F.lit(1))
    plan = plan.withColumn("passes", F.floor(budget / size).cast("long"))
    plan = stored(plan.withColumn("rest", budget - F.col("passes") * F.col("source_size")).withColumns({"prefix": F.lit(0).cast("long"), "tied": F.col("source_size")}))
    inside = slim
    for level in range(1, len(LEVEL_BITS) + 1):
        now = plan.select("source", "prefix", "rest")
        if level > 1:
            inside = stored(join_small(inside, now, "source").where(_bucket(level - 1) == F.col("prefix")).select(inside["source"], "hash", "size"))
        sums = inside.groupBy("source", _bucket(level).alias("bucket")).agg(F.sum("size").alias("words"))
        by = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("upto", F.sum("words").over(by))
        edge = join_small(sums, now, "source").where("rest < upto").groupBy(sums["source"])
        edge = edge.agg(F.min(F.struct("bucket", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"), "words")).alias("edge"))
        plan = join_small(plan.drop("prefix", "tied"), edge.select("source", "edge"), "source", "left").select(
            plan["source"], "source_size", "target", "passes",
            F.coalesce("edge.rest", F.lit(0)).alias("rest"), F.coalesce("edge.bucket", F.lit(0)).alias("prefix"), F.coalesce("edge.words", F.lit(1)).alias("tied"),
        )
        plan = stored(plan)
    return plan


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    plan = plan.withColumnsRenamed({c: f"_plan_{c}" for c in plan.columns if c != "source"})
    out = join_small(rows, plan.withColumnRenamed("source", "_source"), "_source")
    below = F.when(F.col("_hash") < F.col("_plan_prefix"), F.col("_size")).when(
        F.col("_hash") == F.col("_plan_prefix"),
        F.expr("cast(floor(cast(_size as decimal(18,0)) * cast(_plan_rest as decimal(18,0)) / cast(_plan_tied as decimal(18,0))) as bigint)"),
    ).otherwise(F.lit(0).cast("long"))
    out = out.withColumns({
        "size": F.col("_size"), "source_size": F.col("_plan_source_size"), "target": F.col("_plan_target"),
        "taken": F.col("_size") * F.col("_plan_passes") + below,
    })
    return out.drop(*[c for c in out.columns if c.startswith("_plan_")])


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS hash
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS lft,
    (sum(w) OVER (ORDER BY 3 * source_size / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS left_w
  FROM s),
o AS (SELECT *, cap * left_w > lft * w AS open FROM r),
rate AS (SELECT lft AS rl, left_w AS rw FROM o WHERE open ORDER BY cap / w, i LIMIT 1),
t AS (
  SELECT source, source_size, CASE WHEN open THEN rl::DOUBLE * w / rw ELSE cap::DOUBLE END AS target
  FROM o LEFT JOIN rate ON true),
b AS (
  SELECT *, floor(target + 0.5)::BIGINT // greatest(source_size, 1) AS passes,
    floor(target + 0.5)::BIGINT - (floor(target + 0.5)::BIGINT // greatest(source_size, 1)) * source_size AS rest
  FROM t),
h AS (
  SELECT source, hash, sum(size)::BIGINT AS tied,
    (sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) - sum(size))::BIGINT AS before
  FROM d GROUP BY source, hash)
SELECT d.doc_id, d.size, b.source_size, b.target,
  (d.size * b.passes + CASE WHEN h.before + h.tied <= b.rest THEN d.size WHEN h.before >= b.rest THEN 0
    ELSE d.size * (b.rest - h.before) // h.tied END)::BIGINT AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN h ON d.source IS NOT DISTINCT FROM h.source AND d.hash = h.hash
"""
