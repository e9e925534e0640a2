import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.functions import arrow
from textloom.operators import chat, chunking, generation, packing


def test_slices_hold_a_bound_of_bytes_or_one_row():
    batch = pa.RecordBatch.from_pydict({"k": range(7), "t": ["aa", None, "", "é", "x" * 9, "b", "cc"]})
    for given in (batch, batch.slice(2)):
        out = list(arrow.slices([given], "t", 4))
        assert pa.Table.from_batches(out).to_pylist() == given.to_pylist()
        assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column("t").to_pylist()) <= 4 for b in out)
    assert [b.num_rows for b in arrow.slices([batch], "t", 99, 3)] == [3, 3, 1]
    assert list(arrow.slices([batch.slice(0, 0)], "t")) == []


@pytest.fixture
def largest(monkeypatch, tmp_path):
    """The most texts that Python splits at a time, with slices of 40,000 bytes, by a file that workers add to."""
    path = tmp_path / "seen"

    def slices(batches, name, limit=40_000, rows=10_000, path=str(path), f=arrow.slices):
        for b in f(batches, name, limit, rows):
            with open(path, "a") as out:
                print(b.num_rows, file=out)
            yield b

    for module in (chunking, packing):
        monkeypatch.setattr(module, "slices", slices)
    return lambda: max(map(int, path.read_text().split()))


LONG = "A sentence of words that says little about obligations and duties. " * 150  # 10,200 bytes


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(k, LONG, {"a": "b"}) for k in range(60)], "doc_id long, text string, metadata map<string,string>").repartition(1)


def test_format_qa_and_completion_take_texts_by_slices(docs, largest):
    assert chat.format_chat(docs, "qa", category_col="doc_id").count() == 120
    assert chat.format_chat(docs).where("n_chunks = 2").count() == 120
    assert largest() <= 4


def test_chunks_keep_other_columns(docs, largest):
    rows = chunking.chunk(docs, chunking.chat_chunker()).collect()
    assert all(r["metadata"] == {"a": "b"} for r in rows) and sorted({(r["doc_id"], r["chunk_index"]) for r in rows}) == [(k, i) for k in range(60) for i in (0, 1)]
    assert largest() <= 4


def test_question_pairs_take_texts_by_slices(docs, largest):
    assert generation.qa_pairs(docs.drop("metadata")).count() == 300 and largest() <= 4


def test_instruction_pairs_take_texts_by_slices(docs, largest):
    assert generation.instruction_pairs(docs.drop("metadata")).count() == 180 and largest() <= 4


def test_token_stats_take_texts_by_slices(docs, largest):
    row = packing.token_stats(packing.tokenize(docs.select("doc_id", F.col("text")), packing.ByteTokenizer())).first()
    assert (row["total_examples"], row["truncated"]) == (60, 60) and largest() <= 4
