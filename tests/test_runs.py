import json
import logging
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from textloom import config
from textloom.operators.inference import StubScorer
from textloom.operators.packing import ByteTokenizer
from textloom.plans import cli, pipeline
from textloom.sources import readers, sinks
from textloom.streaming.incremental import IncrementalDedup, filtered_stream, reason_counts

GOOD = "The court held that the contract is void and that the party was in breach of duty. " * 10


def lines(path, *rows):
    Path(path).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows), encoding="utf-8")
    return str(path)


@pytest.fixture
def corpus(tmp_path):
    other = "Merger agreements are subject to the approval of the board and of the holders of shares. " * 10
    return lines(tmp_path / "in.jsonl", {"text": GOOD, "doc_id": "a", "category": "opinion"}, {"text": GOOD}, "", {"text": "Short."}, {"text": other, "metadata": {"k": 1, "category": "x"}, "category": "contract"})


def test_jsonl_documents(spark, corpus):
    rows = readers.read_jsonl_documents(spark, corpus).orderBy("ord").collect()
    assert [r["doc_id"] for r in rows] == ["a", "1", "3", "4"]
    assert rows[3]["metadata"] == {"k": "1", "category": "contract"} and rows[0]["source"] == "local"


def test_malformed_json_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|malformed|invalid"):
        readers.read_jsonl_documents(spark, lines(tmp_path / "bad.jsonl", "{oops")).collect()


def test_sources(spark, corpus, caplog):
    with caplog.at_level(logging.WARNING):
        assert readers.read_sources(spark, [{"type": "ftp", "path": "x"}, {"type": "local"}]).count() == 0
    assert len(caplog.records) == 2
    both = [{"type": "local", "path": corpus}] * 2
    assert readers.read_sources(spark, both, categories=["contract"]).count() == 2
    assert readers.read_sources(spark, both, max_documents=3).count() == 3 and readers.read_sources(spark, both, max_documents=0).count() == 8


def test_mirrored_table_counts_raw_rows(spark):
    rows = spark.createDataFrame([(0, "a", "x"), (1, "", "y"), (2, "c", None)], "n long, text string, kind string")
    out = readers.documents_from_table(rows, "s", ord_col="n", max_documents=2).collect()
    assert [r["doc_id"] for r in out] == ["s:0"] and out[0]["metadata"] == {"n": "0", "kind": "x"}


def test_evaluation_inputs(spark, tmp_path):
    q = readers.read_questions(spark, lines(tmp_path / "q", {"question": "a", "choices": ["x", "y"], "answer": 1}, {"question": "b", "choices": [], "correct_index": 2}, {"question": "c", "choices": []}))
    assert [r["correct_index"] for r in q.orderBy("ord").collect()] == [1, 2, 0]
    for k, shape in enumerate(({"terms": [{"text": "tort"}, {"frequency": 1}]}, ["tort"])):
        assert [r["term"] for r in readers.read_glossary(spark, lines(tmp_path / f"g{k}", shape)).collect()] == ["tort"]
    report = {"benchmarks": [{"name": "mmlu", "score": 0.75}], "retention": [{"name": "x", "score": 1}]}
    assert readers.read_baseline(spark, lines(tmp_path / "b", report)).first()["name"] == "mmlu"
    pairs = readers.read_qa_pairs(spark, lines(tmp_path / "p", {"question": "q", "answer": "a"}, {"question": "q"}))
    assert pairs.count() == 1 and pairs.first()["category"] == "qa"
    assert readers.read_prompts(spark, lines(tmp_path / "r", {"prompt": "p"})).first()["prompt"] == "p"
    assert readers.read_clauses(spark, lines(tmp_path / "c", {"text": "t", "label": "l"}, {"text": "u", "label": "l"}), 1).count() == 1


def test_whole_run(spark, corpus, tmp_path):
    settings = config.domain_config({"name": "legal", "terminology": {"min_frequency": 2}, "corpus": {"quality_filters": {"min_length": 50}}})
    out = str(tmp_path / "out")
    stats = pipeline.build_corpus(spark, settings, out, corpus, chat_mode="qa")
    assert stats["documents"] == 2 and stats["filter_stats"]["dropped_too_short"] == 1 and stats["dedup_stats"]["removed"] == 1
    assert json.loads((tmp_path / "out/stats.json").read_text())["documents"] == 2
    terms = pipeline.extract_terminology(spark, settings, f"{out}/corpus.jsonl", f"{out}/terms.json", top_k=10)
    assert terms["num_terms"] == 10
    made = pipeline.generate_synthetic(spark, settings, f"{out}/corpus.jsonl", f"{out}/syn.jsonl", terms_path=f"{out}/terms.json", limits={"max_repetition": 1.0, "min_score": 0.0})
    assert made["total_written"] == made["qa"]["passed"] + made["instruction"]["passed"] > 10
    summary = pipeline.prepare_training(spark, config.training_config({}), f"{out}/syn.jsonl", f"{out}/train", tokenizer=ByteTokenizer())
    assert summary["num_samples"] == made["total_written"] and summary["packed_sequences"] > 0
    bar = lines(tmp_path / "bar.jsonl", {"question": "what is law", "choices": ["law is", "fish"], "answer": 0})
    base = lines(tmp_path / "base.json", {"retention": [{"name": "general_knowledge", "score": 1.0}]})
    know = readers.read_questions(spark, bar).withColumn("subset", F.lit("s"))
    report = pipeline.evaluate_domain(spark, settings, StubScorer(), f"{out}/report.json", bar_path=bar, glossary_path=f"{out}/terms.json", knowledge=know, baseline_path=base)
    assert report["all_benchmarks_passed"] and report["forgetting"]["all_retained"] and report["terminology"]["num_examples"] == 10


def test_pipeline_stops_and_reports(spark, tmp_path):
    def fail():
        raise RuntimeError("broken")

    path = str(tmp_path / "result.json")
    result = pipeline.run_pipeline(spark, "legal", {"corpus": lambda: 1, "terminology": fail, "synthetic": lambda: 2}, result_path=path)
    assert not result.success and result.completed == ["corpus"] and json.loads(Path(path).read_text())["failed"] == {"terminology": "broken"}
    dry = pipeline.run_pipeline(spark, "legal", {"corpus": fail, "train": fail}, {"train"}, dry_run=True)
    assert dry.success and dry.skipped == ["train"]


def test_config(tmp_path, caplog):
    with caplog.at_level(logging.WARNING):
        c = config.domain_config({"domain": {"name": "legal", "synthetic": {"x": 1}, "evaluation": {"benchmarks": [{"name": "bar_exam", "weight": 0.3}]}}})
    assert c["corpus"]["quality_filters"]["min_length"] == 500 and c["evaluation"]["benchmarks"][0]["passing_threshold"] == 0.7
    assert {r.args[0] for r in caplog.records} == {"synthetic", "evaluation.benchmarks[].weight"}
    assert config.domain_config("medical")["name"] == "medical"
    for bad in ({"name": "cooking"}, {"name": "legal", "corpus": 3}, {}, {"name": "legal", "terminology": {"min_frequency": "x"}}):
        with pytest.raises(ValueError):
            config.domain_config(bad)
    folder = tmp_path / "configs/domains"
    folder.mkdir(parents=True)
    (folder / "legal.yaml").write_text("name: legal\ndescription: d\n")
    assert config.load_pipeline_config("legal", root=tmp_path)["domain"]["description"] == "d"
    with pytest.raises(FileNotFoundError):
        config.load_yaml(tmp_path / "none.yaml")
    assert config.training_config({"lora": {"r": 8}})["lora"] == config.TRAINING_DEFAULTS["lora"] | {"r": 8}


def test_cli_help():
    for command in ("build", "terms", "generate", "prepare", "evaluate", "run"):
        with pytest.raises(SystemExit) as end:
            cli.main([command, "--help"])
        assert end.value.code == 0


def test_raw_pairs(spark, tmp_path):
    rows = spark.createDataFrame([("q", "a")], "question string, answer string")
    assert sinks.write_pairs(rows, str(tmp_path / "raw"), "raw") == 1
    assert spark.read.json(str(tmp_path / "raw")).columns == ["answer", "question"]
    assert sinks.write_pairs(rows, str(tmp_path / "chat"), "chat", "s") == 1


def test_streams(spark, tmp_path):
    schema = "doc_id long, text string, at timestamp"
    src = tmp_path / "src"
    for k, rows in enumerate(([(1, GOOD), (2, GOOD), (3, "x")], [(4, GOOD), (5, GOOD.replace("court", "tribunal").replace("contract", "deed").replace("breach", "default"))])):
        spark.createDataFrame(rows, "doc_id long, text string").withColumn("at", F.lit("2024-01-01").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(src / f"d{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src / "d*"))
    dedup = IncrementalDedup(str(tmp_path / "kept"), str(tmp_path / "state"))
    dedup.start(filtered_stream(stream), str(tmp_path / "ck"), availableNow=True).awaitTermination()
    kept = sorted(r[0] for r in spark.read.parquet(str(tmp_path / "kept")).select("doc_id").collect())
    assert len(kept) == 2 and kept[-1] == 5
    counts = reason_counts(stream, "at").writeStream.format("memory").queryName("reasons").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck2")).trigger(availableNow=True).start()
    counts.awaitTermination()
    assert {r["reason"]: r["documents"] for r in spark.table("reasons").collect()} == {"passed": 4, "too_short": 1}
