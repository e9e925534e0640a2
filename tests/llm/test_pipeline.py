import helpers as h
import pytest
from test_near_copies import kept_spec

import __spark_entry__
import corpus_pipeline
from textloom.llm import common


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The documents before and after each stage."""
    docs = common.read(spark, sf, "documents")
    out = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, sf))
        out.append(docs.toPandas())
    return out


def test_columns_and_rows(steps):
    assert all(list(s.columns) == list(steps[0].columns) for s in steps[:-1])
    assert len(steps[-1]) > 50 and all(set(b["doc_id"]) <= set(a["doc_id"]) for a, b in zip(steps, steps[1:], strict=False))
    for s in steps[2:-1]:
        assert (s["n_chars"] == s["text"].str.len()).all()


def test_near_copies_leave_one(steps):
    before, after = steps[1], steps[2]
    expected = kept_spec(list(before["text"]))
    assert set(after["doc_id"]) == {before["doc_id"].iloc[k] for k in expected}


def test_no_benchmark_window_is_left(spark, sf, steps):
    items = [(r["item_id"], r["text"]) for r in common.read(spark, sf, "benchmark").collect() if len(h.FOLDED.findall(r["text"])) >= 8]
    left = h.hits_spec(zip(steps[3]["doc_id"], steps[3]["text"], strict=True), items)
    assert not any(x[1] for x in left.values())
    hit = h.hits_spec(zip(steps[2]["doc_id"], steps[2]["text"], strict=True), items)
    same = steps[2].set_index("doc_id")["text"]
    assert all(same[d] == t for d, t in zip(steps[3]["doc_id"], steps[3]["text"], strict=True) if not hit[d][1])


def test_no_personal_data_is_left(steps):
    assert any(h.spans_spec(t) for t in steps[3]["text"])
    assert not any(h.spans_spec(t) for t in steps[4]["text"])
    held = dict(zip(steps[3]["doc_id"], steps[3]["text"], strict=True))
    assert all(held[d] == t or h.spans_spec(held[d]) for d, t in zip(steps[4]["doc_id"], steps[4]["text"], strict=True))


def test_no_personal_data_is_left_in_a_larger_table(spark):
    docs = common.read(spark, "/root/testdata/sf0.1", "documents").where("text rlike '[0-9@]'")
    assert not any(h.spans_spec(r["text"]) for r in corpus_pipeline.sanitise(spark, docs, "").select("text").collect())


def test_quality_stage_keeps_what_the_scores_accept(spark, sf, steps):
    scores = {r["doc_id"]: r["predicted"] for r in __spark_entry__.queries()["op9_quality_classifier"](spark, sf).collect()}
    assert set(steps[1]["doc_id"]) == {d for d, p in scores.items() if p} and len(steps[1]) < len(steps[0])


def test_stages_take_empty_tables_nulls_repeats_and_more_columns(spark, sf):
    given = [(1, "a text of some words " * 9, "en", "s", 5, "x"), (1, "a text of some words " * 9, "en", "s", 5, "x"), (None, "another text altogether " * 9, None, None, None, None), (2, None, None, None, None, "y"), (3, "", "en", "s", 0, "z")]
    docs = spark.createDataFrame(given, h.DOCUMENT + ", _text string")
    for rows in (docs, docs.limit(0)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
            out = stage(spark, rows, sf)
            found = out.collect()
            assert len(found) <= rows.count() and (k == len(corpus_pipeline.STAGES) or out.columns == docs.columns)


def test_mix(steps):
    out = steps[-1]
    assert (out["taken"] > 0).all() and (out["taken"] <= 3 * out["size"]).all()
    assert out["taken"].sum() == pytest.approx(out.groupby("source")["target"].first().sum(), abs=30)


def test_run_equals_its_stages(spark, sf, steps):
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(steps[-1].sort_values("doc_id").reset_index(drop=True)[list(got.columns)])
    assert "pipeline" in __spark_entry__.queries()
