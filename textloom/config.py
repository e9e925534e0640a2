"""Configuration: plain YAML laid over defaults, checked for types and unknown keys.

Keys that nothing reads are accepted, as existing files have them, and reported by :func:`inert_keys`.
"""

from __future__ import annotations

import copy
import logging
from pathlib import Path
from typing import Any

import yaml

log = logging.getLogger(__name__)

DOMAINS = ("legal", "medical", "financial", "scientific")
STAGES = ("lora", "instruction_tune")
#: Defaults of a domain's and a training run's settings.
DOMAIN_DEFAULTS: dict[str, Any] = {
    "name": "legal",
    "description": "",
    "corpus": {
        "sources": [],
        "quality_filters": {"min_length": 500, "max_length": 50000, "language": "en", "dedup_threshold": 0.85},
    },
    "terminology": {"method": "tfidf_ner_hybrid", "min_frequency": 100, "pos_tags": ["NOUN", "PROPN"]},
    "evaluation": {"benchmarks": [], "retention": {"benchmarks": ["mmlu", "hellaswag"], "max_drop": 0.05}},
}
TRAINING_DEFAULTS: dict[str, Any] = {
    "stage": "lora",
    "model": {
        "base_model": "meta-llama/Meta-Llama-3-8B-Instruct", "torch_dtype": "bfloat16", "attn_implementation": "flash_attention_2",
        "gradient_checkpointing": True, "load_in_4bit": True,
    },
    "data": {"domain_weight": 0.8, "general_weight": 0.2, "max_length": 2048, "packing": True},
    "optimizer": {"name": "adamw", "learning_rate": 2e-4, "weight_decay": 0.01, "warmup_ratio": 0.05, "lr_scheduler": "cosine"},
    "lora": {"r": 16, "lora_alpha": 32, "lora_dropout": 0.05, "target_modules": ["q_proj", "k_proj", "v_proj", "o_proj"], "bias": "none", "task_type": "CAUSAL_LM"},
    "training": {"num_epochs": 3, "batch_size": 4, "gradient_accumulation_steps": 4, "max_steps": -1, "save_steps": 500, "logging_steps": 10, "eval_steps": 500},
    "output_dir": "models/output",
    "wandb_project": "domain-adapt",
}
SOURCE_DEFAULTS = {"categories": [], "date_range": []}
BENCHMARK_DEFAULTS = {"weight": 1.0, "passing_threshold": 0.7}
_INERT = (
    "synthetic", "evaluation.terminology", "evaluation.retention.benchmarks", "optimizer.name", "stage",
    "corpus.sources[].date_range", "corpus.sources[].categories", "evaluation.benchmarks[].weight",
)


def load_yaml(path: str | Path) -> dict[str, Any]:
    """A YAML file's mapping; an empty file is an empty mapping."""
    path = Path(path)
    if not path.exists():
        raise FileNotFoundError(f"no configuration file {path}")
    return yaml.safe_load(path.read_text(encoding="utf-8")) or {}


def _laid_over(default: Any, given: Any, where: str) -> Any:
    if isinstance(default, dict):
        if not isinstance(given, dict):
            raise ValueError(f"{where or 'configuration'} must be a mapping")
        return {k: _laid_over(v, given[k], f"{where}.{k}".lstrip(".")) if k in given else copy.deepcopy(v) for k, v in default.items()}
    if isinstance(default, bool) or isinstance(default, str) or isinstance(default, list):
        if not isinstance(given, type(default)):
            raise ValueError(f"{where} must be {type(default).__name__}, not {given!r}")
        return given
    if isinstance(given, bool) or not isinstance(given, (int, float, str)):
        raise ValueError(f"{where} must be a number, not {given!r}")
    number = type(default)(given)
    if isinstance(default, int) and number != float(given):
        raise ValueError(f"{where} must be a whole number, not {given!r}")
    return number


def _entries(rows: list, defaults: dict, needed: tuple[str, ...], where: str) -> list[dict]:
    for r in rows:
        if not isinstance(r, dict) or any(k not in r for k in needed):
            raise ValueError(f"each of {where} needs {', '.join(needed)}")
    return [defaults | {k: r[k] for k in (*needed, *defaults) if k in r} for r in rows]


def domain_config(given: dict[str, Any] | str) -> dict[str, Any]:
    """A checked domain configuration from a mapping, nested under ``domain`` or flat, or from a bare domain name."""
    raw = {"name": given} if isinstance(given, str) else given.get("domain", given)
    raw = {"name": raw} if isinstance(raw, str) else raw
    if "name" not in raw:
        raise ValueError("a domain needs a name")
    out = _laid_over(DOMAIN_DEFAULTS, raw, "")
    if out["name"] not in DOMAINS:
        raise ValueError(f"unknown domain {out['name']!r}")
    out["corpus"]["sources"] = _entries(out["corpus"]["sources"], SOURCE_DEFAULTS, ("name", "type"), "corpus.sources")
    out["evaluation"]["benchmarks"] = _entries(out["evaluation"]["benchmarks"], BENCHMARK_DEFAULTS, ("name",), "evaluation.benchmarks")
    for key in inert_keys(raw):
        log.warning("configuration key %s has no effect", key)
    return out


def training_config(given: dict[str, Any]) -> dict[str, Any]:
    out = _laid_over(TRAINING_DEFAULTS, given, "")
    if out["stage"] not in STAGES:
        raise ValueError(f"unknown training stage {out['stage']!r}")
    return out


def inert_keys(given: dict[str, Any]) -> list[str]:
    """Keys of ``given`` that are read but change nothing, or are not read at all."""

    def holds(node: Any, parts: list[str]) -> bool:
        if not parts:
            return bool(node) or node is False or node == 0
        key = parts[0].removesuffix("[]")
        if not isinstance(node, dict) or key not in node:
            return False
        return any(holds(x, parts[1:]) for x in node[key]) if parts[0].endswith("[]") and isinstance(node[key], list) else holds(node[key], parts[1:])

    return [k for k in _INERT if holds(given, k.split("."))]


def resolve(name: str | Path, root: str | Path) -> Path:
    """A path as given, relative to ``root``, or ``configs/domains/<name>.yaml`` for a bare name."""
    path = Path(name)
    if not path.suffix:
        path = Path("configs/domains") / f"{path}.yaml"
    return path if path.is_absolute() else Path(root) / path


def load_domain_config(name: str | Path, root: str | Path = ".") -> dict[str, Any]:
    return domain_config(load_yaml(resolve(name, root)))


def load_training_config(path: str | Path, root: str | Path = ".") -> dict[str, Any]:
    path = Path(path)
    raw = load_yaml(path if path.is_absolute() else Path(root) / path)
    return training_config(raw.get("training_config", raw))


def load_pipeline_config(domain: str | Path, training: str | Path | None = None, root: str | Path = ".") -> dict[str, Any]:
    return {"domain": load_domain_config(domain, root), "training": load_training_config(training, root) if training else training_config({})}
