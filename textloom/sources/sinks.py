"""Writers: JSON lines, chat and raw pairs, term lists and reports."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from textloom.operators.generation import to_chat


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> int:
    """One JSON object a line, nulls left out; returns the number of rows, counted while they are written."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).json(path)
    return seen.get["n"]


def write_corpus(docs: DataFrame, path: str) -> dict[str, int]:
    """{text, doc_id, source, metadata} lines; returns the counts of documents and characters."""
    seen = Observation()
    kept = [c for c in ("text", "doc_id", "source", "metadata") if c in docs.columns]
    out = docs.select(*kept).observe(seen, F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("total_characters"))
    out.write.mode("overwrite").json(path)
    return dict(seen.get)


def write_pairs(pairs: DataFrame, path: str, fmt: str = "chat", system: str = "") -> int:
    """``chat`` writes only messages; any other format writes the pairs as they are."""
    return write_jsonl(to_chat(pairs, system) if fmt == "chat" else pairs, path)


def write_chat(examples: DataFrame, path: str) -> int:
    """Chat examples; an empty doc_id or metadata is left out."""
    cols = [c for c in ("messages", "doc_id", "metadata") if c in examples.columns]
    out = examples.select(*cols)
    if "doc_id" in cols:
        out = out.withColumn("doc_id", F.nullif("doc_id", F.lit("")))
    if "metadata" in cols:
        out = out.withColumn("metadata", F.when(F.size("metadata") > 0, F.col("metadata")))
    return write_jsonl(out, path)


def write_json(spark, value: Any, path: str) -> None:
    """A small driver-side object as one indented JSON file, through Spark's file systems."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(json.dumps(value, indent=2, default=str).encode()))
    finally:
        out.close()


def terms_payload(terms: DataFrame, method: str, min_frequency: int, max_ngram: int, use_ner: bool = False) -> dict:
    """The term list's report: at most the top-k terms asked for, so it fits the driver."""
    rows = [r.asDict() for r in terms.collect()]
    listed = [{"text": r["term"], "frequency": r["frequency"], "document_frequency": r["document_frequency"], "tfidf_score": round(r["tfidf"], 6),
               "pos_tags": r.get("pos_tags") or [], "is_entity": bool(r.get("is_entity")), "entity_label": r.get("entity_label") or ""} for r in rows]
    return {"num_terms": len(listed), "config": {"method": method, "min_frequency": min_frequency, "use_spacy": use_ner, "max_ngram": max_ngram}, "terms": listed}
