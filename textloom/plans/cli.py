"""Command line: ``python -m textloom.plans.cli build|terms|generate|prepare|evaluate|run``."""

from __future__ import annotations

import argparse
import json

from textloom.config import load_domain_config, load_training_config, training_config
from textloom.operators.inference import StubScorer
from textloom.plans import pipeline
from textloom.session import create_session


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="textloom", description="Build, measure and curate text corpora on Spark.")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, **texts: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name, help=texts.pop("help"))
        p.add_argument("--domain", required=True, help="domain name or configuration file")
        p.add_argument("--master", help="Spark master; left to the deployment if not given")
        return p

    build = command("build", help="build a corpus")
    run = command("run", help="build a corpus, mine terms and generate examples")
    for p in (build, run):
        p.add_argument("--local-path")
        p.add_argument("--hosted")
        p.add_argument("--out-dir", required=True)
        p.add_argument("--max-docs", type=int)
        p.add_argument("--min-quality-score", type=float, default=0.4)
        p.add_argument("--skip-filter", action="store_true")
        p.add_argument("--skip-dedup", action="store_true")
        p.add_argument("--chat", choices=("completion", "qa"))
    run.add_argument("--skip", nargs="*", default=[], choices=pipeline.STAGE_NAMES)
    run.add_argument("--dry-run", action="store_true")
    mine = command("terms", help="mine terminology")
    make = command("generate", help="generate question-answer and instruction pairs")
    for p in (mine, make):
        p.add_argument("--corpus", required=True)
        p.add_argument("--out", required=True)
    mine.add_argument("--top-k", type=int, default=5000)
    mine.add_argument("--max-ngram", type=int, default=3)
    mine.add_argument("--max-docs", type=int)
    make.add_argument("--type", choices=("qa", "instruction", "all"), default="all")
    make.add_argument("--num-samples", type=int)
    make.add_argument("--max-per-doc", type=int, default=3)
    make.add_argument("--terminology")
    make.add_argument("--format", choices=("chat", "raw"), default="chat")
    prep = command("prepare", help="mix and render training data")
    prep.add_argument("--data", required=True)
    prep.add_argument("--general")
    prep.add_argument("--training")
    prep.add_argument("--max-samples", type=int)
    prep.add_argument("--out-dir", required=True)
    test = command("evaluate", help="evaluate with the stub model")
    for name in ("--bar-exam", "--contracts", "--glossary", "--prompts", "--baseline"):
        test.add_argument(name)
    test.add_argument("--out", required=True)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    config = load_domain_config(args.domain)
    spark = create_session(args.master)
    build = lambda: pipeline.build_corpus(
        spark, config, args.out_dir, args.local_path, args.hosted, args.max_docs, None, args.min_quality_score, args.skip_filter, args.skip_dedup, args.chat
    )
    if args.command == "build":
        out = build()
    elif args.command == "terms":
        out = pipeline.extract_terminology(spark, config, args.corpus, args.out, args.top_k, args.max_ngram, args.max_docs)
    elif args.command == "generate":
        out = pipeline.generate_synthetic(spark, config, args.corpus, args.out, args.type, args.num_samples, args.max_per_doc, args.terminology, fmt=args.format)
    elif args.command == "prepare":
        training = load_training_config(args.training) if args.training else training_config({})
        out = pipeline.prepare_training(spark, training, args.data, args.out_dir, args.general, args.max_samples)
    elif args.command == "evaluate":
        out = pipeline.evaluate_domain(spark, config, StubScorer(), args.out, "stub", args.bar_exam, args.contracts, args.glossary, args.prompts, None, args.baseline)
    else:
        corpus = f"{args.out_dir}/corpus.jsonl"
        stages = {
            "corpus": build,
            "terminology": lambda: pipeline.extract_terminology(spark, config, corpus, f"{args.out_dir}/terms.json"),
            "synthetic": lambda: pipeline.generate_synthetic(spark, config, corpus, f"{args.out_dir}/synthetic.jsonl"),
        }
        result = pipeline.run_pipeline(spark, config["name"], stages, set(args.skip), args.dry_run, result_path=f"{args.out_dir}/pipeline_result.json")
        print(json.dumps(result.to_dict(), indent=2, default=str))
        return 0 if result.success else 1
    print(json.dumps(out, indent=2, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
