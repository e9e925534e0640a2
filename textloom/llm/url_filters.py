"""URL filters as a temporal list join.

A block list is a history of dated entries: a host or domain is added or removed on a day. Its entries become
validity intervals [from, until) with a window over each domain's history, and every capture is evaluated as of its
fetch time against the entries then active for its host or any parent domain.

Scale: captures are first reduced to distinct (host, fetch day), which alone meet the list; verdicts then join back.
Both joins broadcast under a counted row limit and are salted beyond it, so one host may hold a third of all captures.

Defined cases: a URL without a host (null, empty, relative) matches nothing; hosts compare in lower case without
port, user or trailing dot; a null fetch time matches nothing; equal entries count once, and of entries for one domain,
category and day the removal stands; an interval starts on its day and ends before the next entry's day; repeated captures
are judged alike, and so are ones with a null id; a fetch time that is no time counts as null; an empty table gives no
rows; other columns of the captures pass through under any name, except the added ones, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.common import column, join_small, prefixed, stored, working

#: A small dated list (domain, category, action, day).
BLOCK_LIST = (
    ("ads-track.example.com", "ads", "add", "2023-11-01"),
    ("ads-track.example.com", "ads", "remove", "2024-05-15"),
    ("ads-track.example.com", "ads", "add", "2024-08-01"),
    ("casino-win.example.com", "gambling", "add", "2024-01-10"),
    ("casino-win.example.net", "gambling", "add", "2024-03-01"),
    ("free-bets.example.net", "gambling", "add", "2024-02-01"),
    ("free-bets.example.net", "gambling", "remove", "2024-11-01"),
    ("adult-x.example.com", "adult", "add", "2023-06-01"),
    ("cheap-pills.example.net", "pharma", "add", "2024-04-20"),
    ("spam-farm.example.org", "spam", "add", "2024-01-01"),
    ("spam-farm.example.org", "spam", "remove", "2024-03-31"),
    ("spam-farm.example.org", "spam", "add", "2024-07-01"),
)
FIRST_DAY, DAYS = "2024-01-01", 366


def host_of(url: Column) -> Column:
    """Lower-case host of an absolute URL; null without one."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)", 1)
    return F.nullif(F.rtrim(found, F.lit(".")), F.lit(""))


def parents_of(host: Column) -> Column:
    """The host and its parent domains of two labels or more."""
    labels = F.split(host, r"\.")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(labels) - 1))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def intervals(entries: DataFrame) -> DataFrame:
    """(domain, category, valid_from, valid_until) from dated entries (domain, category, action, day)."""
    clean = entries.select(F.lower("domain").alias("domain"), "category", "action", F.col("day").try_cast("date").alias("day"))
    clean = clean.where("domain is not null and day is not null").distinct()
    # of one domain, category and day, a removal stands
    ranked = Window.partitionBy("domain", "category", "day").orderBy(F.desc("action"))
    one = clean.withColumn("k", F.row_number().over(ranked)).where("k = 1")
    until = F.lead("day").over(Window.partitionBy("domain", "category").orderBy("day"))
    return one.withColumn("valid_until", until).where("action = 'add'").select("domain", "category", F.col("day").alias("valid_from"), "valid_until")


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", time_col: str = "fetch_time") -> DataFrame:
    """``captures`` with host, blocked and matched (the active entries' domains and categories, in order)."""
    kept = [c for c in captures.columns if c not in ("host", "blocked", "matched")]
    rows = captures.select(*[prefixed(c) for c in kept], host_of(column(url_col)).alias("_host"), column(time_col).try_cast("date").alias("_day"))
    rows = rows.withColumn("_key", F.concat_ws("|", "_host", "_day"))
    asked = rows.where("_host is not null and _day is not null").select("_key", "_host", "_day").distinct()
    spans = stored(intervals(entries))
    candidates = asked.select("_key", "_day", F.explode(parents_of(F.col("_host"))).alias("_domain"))
    listed = join_small(candidates, spans.withColumnRenamed("domain", "_domain"), "_domain")
    active = listed.where("_day >= valid_from and (valid_until is null or _day < valid_until)")
    verdicts = active.groupBy("_key").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "_domain", "category"))), ",").alias("_matched"))
    out = join_small(rows, stored(verdicts), "_key", "left")
    return out.select(*[F.col(working(c)).alias(c) for c in kept], F.col("_host").alias("host"), F.col("_matched").isNotNull().alias("blocked"), F.coalesce("_matched", F.lit("")).alias("matched"))


def fixed_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BLOCK_LIST, "domain string, category string, action string, day string")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures; the table has no fetch time, so a page's id gives its day, through the year in turn."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.col("page_id"), F.lit(DAYS)).cast("int"))
    return pages.select("page_id", "url", day.cast("timestamp_ntz").alias("fetch_time"))


def digest(pages: DataFrame) -> DataFrame:
    out = evaluate(captures_of(pages), fixed_list(pages.sparkSession))
    return out.select("page_id", "host", F.col("fetch_time").cast("date").cast("string").alias("fetch_day"), "blocked", "matched")


_ROWS = ",\n  ".join(f"('{d}', '{c}', '{a}', DATE '{day}')" for d, c, a, day in BLOCK_LIST)
ORACLE = f"""
WITH entries(domain, category, action, day) AS (VALUES
  {_ROWS}),
spans AS (
  SELECT domain, category, action, day AS valid_from, lead(day) OVER (PARTITION BY domain, category ORDER BY day) AS valid_until FROM entries),
captures AS (
  SELECT page_id, nullif(rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)', 1), '.'), '') AS host,
    (DATE '{FIRST_DAY}' + (((page_id % {DAYS}) + {DAYS}) % {DAYS})::INT)::DATE AS day
  FROM pages),
keys AS (SELECT DISTINCT host, day FROM captures),
hits AS (
  SELECT host, k.day, string_agg(DISTINCT domain || ':' || category, ',' ORDER BY domain || ':' || category) AS matched
  FROM keys k JOIN spans s ON (k.host = s.domain OR ends_with(k.host, '.' || s.domain))
    AND s.action = 'add' AND k.day >= s.valid_from AND (s.valid_until IS NULL OR k.day < s.valid_until)
  GROUP BY host, k.day)
SELECT page_id, c.host, c.day::VARCHAR AS fetch_day, h.matched IS NOT NULL AS blocked, coalesce(h.matched, '') AS matched
FROM captures c LEFT JOIN hits h ON c.host = h.host AND c.day = h.day
"""
