"""Scans: JSON lines, mirrors of hosted datasets, unions of sources, and evaluation inputs."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
DOCUMENT = ("text", "doc_id", "source", "metadata")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value): lines with their place in the files, in file and offset order.

    Each file's lines are numbered where they are read: Spark's own line order within a file split is the file's, and
    splits are ordered by (file, offset), so places need one pass for split sizes and no shuffle.
    """
    raw = spark.read.text(path)
    placed = raw.select("value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mono"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.min(F.struct("file", "start")).alias("at")).collect()
    base, seen = [], 0
    for r in sorted(sizes, key=lambda r: r["at"]):
        base.append((r["part"], seen))
        seen += r["n"]
    # one row for each task that read something: as many as the driver has scheduled, so small enough to ship
    offsets = F.broadcast(spark.createDataFrame(base, "part int, offset long"))
    place = (F.col("offset") + F.col("mono").bitwiseAND(F.lit((1 << 33) - 1))).cast("long")
    return placed.join(offsets, "part").select(place.alias("ord"), "value")


def _blank(value: Column) -> Column:
    return ~value.rlike(r"(?U)[^\s\x1C-\x1F]")


def _parsed(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value, v): non-blank lines as variants. Blank ones are null first, as filters may run in any order."""
    rows = _lines(spark, path).where(~_blank(F.col("value")))
    return rows.withColumn("v", F.parse_json(F.when(~_blank(F.col("value")), F.col("value"))))


def read_jsonl_documents(spark: SparkSession, path: str, source_name: str = "local") -> DataFrame:
    """(ord, text, doc_id, source, metadata) from JSON lines.

    Blank lines are skipped but count: a missing doc_id is the line's place. A missing source is ``source_name``.
    ``metadata`` is the line's own, as text to text, with all further keys on top. Malformed JSON fails the query.
    """
    rows = _parsed(spark, path)
    get = lambda key: F.variant_get("v", f"$.{key}", "string")
    flat = F.from_json("value", "map<string,string>")
    inner = F.coalesce(F.from_json(get("metadata"), "map<string,string>"), F.create_map().cast("map<string,string>"))
    extra = F.map_filter(flat, lambda k, _: ~k.isin(*DOCUMENT))
    kept = F.map_filter(inner, lambda k, _: ~F.map_contains_key(extra, k))
    return rows.select(
        "ord", F.coalesce(get("text"), F.lit("")).alias("text"), F.coalesce(get("doc_id"), F.col("ord").cast("string")).alias("doc_id"),
        F.coalesce(get("source"), F.lit(source_name)).alias("source"), F.map_concat(kept, extra).alias("metadata"),
    )


def documents_from_table(rows: DataFrame, source_name: str, text_field: str = "text", ord_col: str | None = None, max_documents: int | None = None) -> DataFrame:
    """Documents from a mirrored dataset's table: the cap counts raw rows, then empty texts go; ids are ``source:place``.

    ``ord_col`` gives the rows' order; without it they are numbered by partition, which is stable for a given layout.
    """
    place = F.col(ord_col) if ord_col else F.monotonically_increasing_id()
    rows = rows.withColumn("_ord", place)
    if max_documents:
        rows = rows.orderBy("_ord").limit(max_documents)
    others = [c for c in rows.columns if c not in (text_field, "_ord")]
    meta = F.map_filter(F.create_map(*[x for c in others for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]), lambda _, v: v.isNotNull()) if others else F.create_map()
    out = rows.where(F.coalesce(F.col(text_field), F.lit("")) != "")
    return out.select(
        F.col("_ord").cast("long").alias("ord"), F.col(text_field).alias("text"), F.concat(F.lit(f"{source_name}:"), F.col("_ord").cast("string")).alias("doc_id"),
        F.lit(source_name).alias("source"), meta.cast("map<string,string>").alias("metadata"),
    )


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_hosted(spark: SparkSession, path: str, source_name: str = "", text_field: str = "text", max_documents: int | None = None, split: str = "train", subset: str | None = None) -> DataFrame:
    """A local mirror of a hosted dataset: a folder of Parquet or JSON lines, or of one such folder by subset and split.

    A named subset must exist. A mirror without a folder for ``split`` counts as one of that split alone.
    """
    root = f"{path}/{subset}" if subset else path
    whole = f"{root}/{split}" if _exists(spark, f"{root}/{split}") else root
    form = "json" if path.endswith((".json", ".jsonl")) else "parquet"
    return documents_from_table(spark.read.format(form).load(whole), source_name or path.rstrip("/").rsplit("/", 1)[-1], text_field, max_documents=max_documents)


def in_categories(categories: Iterable[str] | None) -> Column:
    """Whether a document's metadata category or type is wanted; all are if none is named."""
    wanted = list(categories or ())
    field = lambda k: F.coalesce(F.try_element_at("metadata", F.lit(k)), F.lit(""))
    return (field("category").isin(wanted) | field("type").isin(wanted)) if wanted else F.lit(True)


def read_sources(spark: SparkSession, sources: list[dict], max_documents: int | None = None, categories: Iterable[str] | None = None) -> DataFrame:
    """The union of sources in list order, filtered by category; the cap counts documents let through.

    A source is {type: huggingface, hf, local or jsonl (default huggingface), path, name, ...}. Unknown types, and
    local ones without a path, are skipped with a warning.
    """
    parts = []
    for k, s in enumerate(sources):
        kind, path = s.get("type", "huggingface"), s.get("path")
        if kind in ("local", "jsonl") and path:
            one = read_jsonl_documents(spark, path, s.get("name", "local"))
        elif kind in ("huggingface", "hf") and (path or s.get("name")):
            one = read_hosted(spark, path or s["name"], s.get("name", ""), s.get("text_field", "text"), split=s.get("split", "train"), subset=s.get("subset"))
        else:
            log.warning("source %d of type %r is skipped", k, kind)
            continue
        parts.append(one.withColumn("src", F.lit(k)))
    if not parts:
        return spark.createDataFrame([], "src int, ord long, text string, doc_id string, source string, metadata map<string,string>")
    out = reduce(DataFrame.unionByName, parts).where(in_categories(categories))
    return out.orderBy("src", "ord").limit(max_documents) if max_documents else out


def _field(key: str, kind: str = "string") -> Column:
    return F.variant_get("v", f"$.{key}", kind)


def read_questions(spark: SparkSession, path: str, max_examples: int | None = None) -> DataFrame:
    """(ord, question, choices, correct_index) from JSON lines with ``answer``, else ``correct_index``, else 0."""
    rows = _lines(spark, path).withColumn("v", F.parse_json("value"))
    index = F.coalesce(_field("answer", "int"), _field("correct_index", "int"), F.lit(0))
    out = rows.select("ord", _field("question").alias("question"), _field("choices", "array<string>").alias("choices"), index.alias("correct_index"))
    return out.orderBy("ord").limit(max_examples) if max_examples else out


def read_clauses(spark: SparkSession, path: str, max_examples: int | None = None) -> DataFrame:
    out = _parsed(spark, path).select("ord", *[_field(k).alias(k) for k in ("text", "label", "context")])
    return out.orderBy("ord").limit(max_examples) if max_examples else out


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    return _parsed(spark, path).select("ord", _field("prompt").alias("prompt"), _field("expected_terms", "array<string>").alias("expected_terms"))


def read_qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs that have a question and an answer, with defaults for the rest."""
    rows = _parsed(spark, path).where(_field("question").isNotNull() & _field("answer").isNotNull())
    return rows.select(
        "ord", _field("question").alias("question"), _field("answer").alias("answer"), F.coalesce(_field("source_doc_id"), F.lit("")).alias("source_doc_id"),
        F.coalesce(_field("category"), F.lit("qa")).alias("category"), F.coalesce(_field("quality_score", "double"), F.lit(1.0)).alias("quality_score"),
        F.coalesce(F.from_json(_field("metadata"), "map<string,string>"), F.create_map().cast("map<string,string>")).alias("metadata"),
    )


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """(rank, term) from {"terms": [{"text": ...}]} or a list of strings; entries without text are skipped."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    texts = F.coalesce(
        F.transform(F.try_variant_get("v", "$.terms", "array<struct<text:string>>"), lambda t: t["text"]),
        F.try_variant_get("v", "$", "array<string>"),
    )
    return whole.select(F.posexplode(texts).alias("rank", "term")).where(F.col("term").isNotNull())


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """(ord, name, score, metric, num_examples, num_correct) from a report's ``benchmarks``, else its ``retention``."""
    whole = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    row = "array<struct<name:string,score:double,metric:string,num_examples:bigint,num_correct:bigint>>"
    found = F.coalesce(F.try_variant_get("v", "$.benchmarks", row), F.try_variant_get("v", "$.retention", row))
    out = whole.select(F.posexplode(found).alias("ord", "r"))
    return out.select("ord", F.coalesce("r.name", F.lit("")).alias("name"), F.coalesce("r.score", F.lit(0.0)).alias("score"), F.coalesce("r.metric", F.lit("accuracy")).alias("metric"),
                      F.coalesce("r.num_examples", F.lit(0)).alias("num_examples"), F.coalesce("r.num_correct", F.lit(0)).alias("num_correct"))


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """Training examples with an inferred schema."""
    return spark.read.json(path)
