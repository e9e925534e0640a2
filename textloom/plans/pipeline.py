"""Runs: build a corpus, mine terms, generate examples, prepare training data, evaluate; and the whole pipeline.

Each run is a plan of operators ended by one write; counters come from the write itself or a one-row aggregate.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import benchmarks, chat, dedup, evaluation, generation, mixing, packing, quality, synthetic_quality, terms
from textloom.operators.inference import Scorer
from textloom.session import materialised
from textloom.sources import readers, sinks

log = logging.getLogger(__name__)
STAGE_NAMES = ("corpus", "terminology", "synthetic", "train", "evaluate")


def _one(df: DataFrame) -> dict[str, Any]:
    return df.first().asDict()


def _rounded(row: dict[str, Any], places: int = 4) -> dict[str, Any]:
    return {k: round(v, places) if isinstance(v, float) else v for k, v in row.items()}


def pick_sources(config: dict | None, local_path: str | None, hosted: str | None, categories=None) -> list[dict]:
    """A local path goes before a named source, and that before the configuration's sources."""
    if local_path:
        return [{"type": "local", "path": local_path, "name": "local"}]
    if hosted:
        return [{"type": "huggingface", "path": hosted, "name": hosted.rstrip("/").rsplit("/", 1)[-1]}]
    return [{"type": "huggingface", "path": s.get("path", s["name"]), "name": s["name"]} for s in (config or {}).get("corpus", {}).get("sources", [])]


def build_corpus(spark: SparkSession, config: dict, out_dir: str, local_path: str | None = None, hosted: str | None = None, max_documents: int | None = None, categories=None, min_score: float = 0.4, skip_filter: bool = False, skip_dedup: bool = False, chat_mode: str | None = None) -> dict[str, Any]:
    """Filters, deduplicates and writes ``corpus.jsonl`` and ``stats.json``, and ``chat.jsonl`` if a mode is given."""
    limits = dict(config["corpus"]["quality_filters"])
    threshold = limits.pop("dedup_threshold")
    docs = readers.read_sources(spark, pick_sources(config, local_path, hosted), max_documents, categories)
    docs = docs.withColumn("rank", F.struct("src", "ord"))
    stats: dict[str, Any] = {"domain": config["name"]}
    kept = docs
    if not skip_filter:
        stats["filter_stats"] = _rounded(_one(quality.filter_stats(docs, min_score=min_score, **limits)))
        kept = quality.quality_filter(docs, min_score=min_score, **limits)
    if not skip_dedup:
        kept = materialised(kept)
        unique = dedup.deduplicate(kept, ord_col="rank", threshold=threshold)
        stats["dedup_stats"] = _rounded(_one(dedup.dedup_stats(kept, unique)))
        kept = unique
    kept = materialised(kept.drop("rank"))
    stats |= sinks.write_corpus(kept, f"{out_dir}/corpus.jsonl")
    if chat_mode:
        titled = kept.withColumns({k: F.try_element_at("metadata", F.lit(k)) for k in ("title", "category", "type")})
        examples = chat.format_chat(titled, chat_mode, config["name"], title_col="title", category_col="category")
        stats["chat_examples"] = sinks.write_chat(examples, f"{out_dir}/chat.jsonl")
    sinks.write_json(spark, stats, f"{out_dir}/stats.json")
    return stats


def extract_terminology(spark: SparkSession, config: dict, corpus_path: str, out_path: str, top_k: int = 5000, max_ngram: int = 3, max_documents: int | None = None, recognise=None) -> dict[str, Any]:
    docs = readers.read_jsonl_documents(spark, corpus_path)
    docs = docs.orderBy("ord").limit(max_documents) if max_documents else docs
    t = config["terminology"]
    found = terms.extract_terms(docs, t["min_frequency"], max_ngram, top_k, recognise, ord_col="ord")
    payload = sinks.terms_payload(found, t["method"], t["min_frequency"], max_ngram, recognise is not None)
    sinks.write_json(spark, payload, out_path)
    return {"num_terms": payload["num_terms"]}


def generate_synthetic(spark: SparkSession, config: dict, corpus_path: str, out_path: str, kind: str = "all", num_samples: int | None = None, max_per_doc: int = 3, terms_path: str | None = None, limits: dict | None = None, fmt: str = "chat", system: str | None = None) -> dict[str, Any]:
    """Writes filtered question-answer and instruction pairs (qa first); ``num_samples`` is split evenly between kinds."""
    docs, domain = readers.read_jsonl_documents(spark, corpus_path), config["name"]
    kinds = ("qa", "instruction") if kind == "all" else (kind,)
    each = num_samples // len(kinds) if num_samples else None
    prompt = chat.system_prompt(domain, system)
    parts, stats = [], {}
    for k in kinds:
        if k == "qa":
            made, answer = generation.qa_pairs(docs, domain, max_per_doc=max_per_doc, max_pairs=each), "answer"
        else:
            made, answer = generation.instruction_pairs(docs, domain, max_per_doc=max_per_doc, max_examples=each), "response"
            if terms_path:
                made = made.unionByName(generation.term_definitions(readers.read_glossary(spark, terms_path), domain))
        stats[k] = _rounded(_one(synthetic_quality.check_stats(made, answer, **(limits or {}))))
        kept = synthetic_quality.filter_examples(made, answer, **(limits or {}))
        parts.append(generation.to_chat(kept, prompt) if fmt == "chat" else kept)
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    stats["total_written"] = sinks.write_jsonl(out, out_path)
    sinks.write_json(spark, stats, f"{out_path}.stats.json")
    return stats


def prepare_training(spark: SparkSession, training: dict, domain_path: str, out_dir: str, general_path: str | None = None, max_samples: int | None = None, tokenizer=None, seed: int = 42) -> dict[str, Any]:
    """The data side of a training run: mixes, renders and, if a tokenizer is given, packs the examples. No model is trained."""
    data = training["data"]
    keyed = lambda df: df.withColumn("_key", F.sha2(F.to_json("messages").cast("binary"), 256))
    domain = keyed(readers.read_examples(spark, domain_path).select("messages"))
    general = keyed(readers.read_examples(spark, general_path).select("messages")) if general_path else None
    mixed = mixing.mix_datasets(domain, general, data["domain_weight"], data["general_weight"], seed, max_samples, "_key")
    rendered = chat.render_for_sft(mixed).select("_key", "text")
    summary = {"num_samples": sinks.write_jsonl(mixing.shuffled(rendered, "_key", seed).select("text"), f"{out_dir}/train.jsonl")}
    if tokenizer is not None:
        tokens = materialised(packing.tokenize(rendered, tokenizer, data["max_length"]))
        packed = packing.pack(tokens, data["max_length"], ord_col="_key", shards=max(1, summary["num_samples"] // 100_000)) if data["packing"] else None
        if packed is not None:
            packed = materialised(packed)
            packed.write.mode("overwrite").parquet(f"{out_dir}/packed")
        summary |= _rounded(_one(packing.token_stats(tokens, data["max_length"], packed)), 1)
    sinks.write_json(spark, training, f"{out_dir}/training_config.json")
    sinks.write_json(spark, summary, f"{out_dir}/summary.json")
    return summary


def evaluate_domain(spark: SparkSession, config: dict, scorer: Scorer, out_path: str, model_name: str = "model", bar_path: str | None = None, contract_path: str | None = None, glossary_path: str | None = None, prompts_path: str | None = None, knowledge: DataFrame | None = None, baseline_path: str | None = None) -> dict[str, Any]:
    """Runs the evaluators whose inputs are given and writes the report."""
    report: dict[str, Any] = {"model_name": model_name, "domain": config["name"], "benchmarks": [], "retention": []}
    row = lambda df: _rounded(_one(df))
    if bar_path:
        report["benchmarks"].append(row(benchmarks.bar_exam(readers.read_questions(spark, bar_path), scorer)))
    if contract_path:
        report["benchmarks"].append(row(benchmarks.contract_analysis(readers.read_clauses(spark, contract_path), scorer)))
    if knowledge is not None:
        overall, by = benchmarks.general_knowledge(knowledge, scorer)
        subsets = {r["subset"]: round(r["accuracy"], 4) for r in by.where("not is_total").collect()}
        report["retention"].append(row(overall) | {"details": {"subsets": subsets}})
    if baseline_path and report["retention"]:
        now = spark.createDataFrame([(k, r["name"], r["score"]) for k, r in enumerate(report["retention"])], "ord int, name string, score double")
        compared = evaluation.compare_results(readers.read_baseline(spark, baseline_path), now, config["evaluation"]["retention"]["max_drop"])
        report["forgetting"] = row(evaluation.retention_summary(compared)) | {"results": [_rounded(r.asDict()) for r in compared.orderBy("ord").collect()]}
    if glossary_path:
        glossary = readers.read_glossary(spark, glossary_path)
        prompts = readers.read_prompts(spark, prompts_path).select("ord", "prompt") if prompts_path else spark.createDataFrame(list(enumerate(evaluation.TERM_PROMPTS)), "ord int, prompt string")
        samples = benchmarks.sample_results(prompts, glossary, scorer).collect()
        report["terminology"] = row(benchmarks.term_accuracy(prompts, glossary, scorer)) | {"sample_results": [r.asDict() for r in samples]}
    scores = [b["score"] for b in report["benchmarks"]]
    report["overall_domain_score"] = round(sum(scores) / len(scores), 4) if scores else 0.0
    report["all_benchmarks_passed"] = all(b["passed"] for b in report["benchmarks"])
    sinks.write_json(spark, report, out_path)
    return report


@dataclass
class PipelineResult:
    """What became of a run, stage by stage."""

    domain: str
    started: str = field(default_factory=lambda: datetime.now().isoformat())
    finished: str = ""
    completed: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    outputs: dict[str, Any] = field(default_factory=dict)

    @property
    def success(self) -> bool:
        return not self.failed

    def to_dict(self) -> dict[str, Any]:
        return self.__dict__ | {"success": self.success}


def run_pipeline(spark: SparkSession, domain: str, stages: dict[str, Callable[[], Any]], skip: set[str] = frozenset(), dry_run: bool = False, timeout_s: float = 7200, result_path: str | None = None) -> PipelineResult:
    """Runs stages in order and stops at the first failure. The result is written in every case.

    A stage that takes longer than ``timeout_s`` counts as failed; a dry run only lists what would run.
    """
    result = PipelineResult(domain)
    try:
        for name, stage in stages.items():
            if name in skip:
                result.skipped.append(name)
                continue
            if dry_run:
                log.info("would run %s", name)
                result.completed.append(name)
                continue
            began = time.monotonic()
            try:
                result.outputs[name] = stage()
            except Exception as error:  # a stage may fail in any way; the result records it
                log.exception("stage %s failed", name)
                result.failed[name] = str(error)
                break
            if time.monotonic() - began > timeout_s:
                result.failed[name] = f"took more than {timeout_s:g} s"
                break
            result.completed.append(name)
    finally:
        result.finished = datetime.now().isoformat()
        if result_path:
            sinks.write_json(spark, json.loads(json.dumps(result.to_dict(), default=str)), result_path)
    return result
