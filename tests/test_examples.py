import pytest

from textloom.operators import chat, chunking, generation, mixing, packing, terms
from textloom.operators.inference import StubScorer

LONG = " ".join(f"Sentence number {i} speaks of obligations and duties." for i in range(200))


def test_tail_inside_the_last_piece_is_given_again():
    c = chunking.chat_chunker()
    assert list(c.spans("x" * 15_700)) == [(0, 8000), (7800, 15_800), (15_600, 23_600)]
    assert len(list(c.spans("x" * 15_600))) == 2


def test_break_must_lie_beyond_the_middle():
    c = chunking.Chunker(100, 10, chunking.latest_stop)
    assert next(c.spans("x" * 50 + "." + "x" * 100)) == (0, 100)
    assert next(c.spans("x" * 51 + "." + "x" * 100)) == (0, 52)


def test_single_pieces():
    assert chunking.chat_chunker().split("  a ") == ["  a "]
    assert chunking.qa_chunker().split("  a ") == ["a"] and chunking.qa_chunker().split("  ") == []


def test_overlap_that_never_ends_is_an_error():
    with pytest.raises(ValueError, match="move on"):
        chunking.Chunker(100, 100, chunking.latest_stop).split("x" * 500)


def test_chat_formats(spark):
    rows = spark.createDataFrame([("a", "short text", "T", "law"), ("b", "y" * 9000, None, None)], "doc_id string, text string, title string, category string")
    done = chat.format_chat(rows, "qa", title_col="title", category_col="category").orderBy("doc_id").collect()
    assert [r["doc_id"] for r in done] == ["a", "b:chunk_0", "b:chunk_1"]
    said = [r["messages"][1]["content"] for r in done]
    assert said[0] == "Explain the following law document: T"
    assert said[1:] == ["Analyze the following legal document.", "Analyze the following legal document. (continued, part 2)"]
    plain = chat.format_chat(rows, custom_prompt="").collect()
    assert all(len(r["messages"]) == 2 for r in plain)


def test_sft_text(spark):
    rows = spark.createDataFrame([([("system", "s"), ("tool", "t"), ("user", "u"), ("assistant", "a")], "x")], "messages array<struct<role:string,content:string>>, doc_id string")
    out = chat.render_for_sft(rows)
    assert out.columns == ["text"] and out.first()["text"] == "System: s\nUser: u\nAssistant: a\n"


def test_pairs_do_not_depend_on_partitions(spark):
    rows = spark.createDataFrame([(i, LONG) for i in range(8)], "doc_id long, text string")
    a = sorted(map(tuple, generation.qa_pairs(rows.repartition(1)).select("question", "source_doc_id").collect()))
    assert a == sorted(map(tuple, generation.qa_pairs(rows.repartition(5)).select("question", "source_doc_id").collect()))
    assert generation.instruction_pairs(rows, max_per_doc=2).count() == 16
    assert generation.qa_pairs(rows, max_pairs=3).count() == 3 and generation.qa_pairs(rows, max_pairs=0).count() == len(a)


def test_own_templates_stay_as_they_are(spark):
    rows = spark.createDataFrame([(1, LONG)], "doc_id long, text string")
    assert "{passage}" in generation.qa_pairs(rows, templates=["Ask {passage}?"]).first()["question"]


def test_model_backed_generation(spark):
    rows = spark.createDataFrame([(1, LONG)], "doc_id long, text string")
    asked = generation.qa_pairs_with_model(rows, StubScorer(), max_new_tokens=5).collect()
    assert asked and all(r["question"].endswith("?") and r["category"] == "qa_model_generated" for r in asked)
    assert generation.instruction_pairs_with_model(rows, StubScorer()).count() == 3
    names = spark.createDataFrame([("estoppel",)], "term string")
    assert generation.term_definitions_with_model(names, StubScorer()).first()["metadata"]["generation_method"] == "llm"
    assert "estoppel" in generation.term_definitions(names).first()["instruction"]


@pytest.mark.parametrize(("counts", "cap", "expected"), [((80, 100), 100, (80, 20)), ((50, 50), 40, (32, 8)), ((100, 5), None, (100, 5))])
def test_mix_counts(counts, cap, expected):
    assert mixing.mix_counts(*counts, max_samples=cap) == expected


def test_mix_without_general(spark):
    rows = spark.range(500).withColumnRenamed("id", "doc_id")
    assert mixing.mix_datasets(rows, max_samples=50).count() == 50 and mixing.mix_datasets(rows).count() == 500


@pytest.mark.parametrize(("sizes", "limit", "bins"), [([3, 3, 3], 20, 1), ([9, 9], 20, 1), ([9, 10], 20, 2), ([30, 3, 3], 20, 2), ([3, 30, 3], 20, 3), ([], 20, 0)])
def test_packing(spark, sizes, limit, bins):
    rows = spark.createDataFrame([(k, [k] * n, [1] * n, None) for k, n in enumerate(sizes)], "ord int, input_ids array<int>, attention_mask array<int>, labels array<int>")
    done = packing.pack(rows, limit, 99).orderBy("sequence").collect()
    assert len(done) == bins
    assert sum(len(r["input_ids"]) for r in done) == sum(sizes) + len(sizes)
    for r in done:
        assert all(y == -100 for x, y in zip(r["input_ids"], r["labels"], strict=True) if x == 99)
        assert len(r["attention_mask"]) == len(r["input_ids"])
    numbers, _ = packing.next_fit(sizes, limit)
    assert len(set(numbers)) == bins


def test_byte_tokens_and_stats(spark):
    rows = spark.createDataFrame([(1, "abc"), (2, None), (3, "é" * 10)], "ord int, text string")
    tokens = packing.tokenize(rows, packing.ByteTokenizer(), 4)
    row = packing.token_stats(tokens, 4).first()
    assert (row["total_examples"], row["total_tokens"], row["truncated"]) == (3, 7, 1)


def test_terms(spark):
    rows = spark.createDataFrame([(1, "co-op law, the law"), (2, "the law of co-op2")], "doc_id long, text string")
    found = {r["term"]: (r["frequency"], r["document_frequency"]) for r in terms.extract_terms(rows, 1).collect()}
    assert found["law"] == (3, 2) and found["co-op"] == (1, 1) and found["the law"] == (2, 2)
    tied = [r["term"] for r in terms.extract_terms(spark.createDataFrame([(1, "beta alpha")], "doc_id long, text string"), 1).collect()]
    assert tied == ["beta", "alpha", "beta alpha"]


def test_entities_join_terms(spark):
    rows = spark.createDataFrame([(1, "law law law")], "doc_id long, text string")
    found = terms.extract_terms(rows, 1, recognise=lambda texts: [[("Acme Corp", "ent", "ORG")] for _ in texts]).collect()
    named = next(r for r in found if r["term"] == "Acme Corp")
    assert named["is_entity"] and named["tfidf"] == 0.0 and named["entity_label"] == "ORG"
