import random

import helpers as h
import numpy as np
import pyarrow as pa
import pytest

from textloom.llm import substrings


def cut(df, **limits):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substrings.remove_repeats(df, **limits).collect()}


@pytest.fixture(scope="module")
def docs(spark):
    return h.frame(spark, h.texts()).repartition(5, "doc_id").select("doc_id", "text").cache()


@pytest.mark.parametrize("limits", [{}, {"group_words": 3_000, "group_anchors": 50}, {"group_words": 200, "group_anchors": 3}, {"group_words": 1, "group_anchors": 1}])
def test_any_memory_bound_gives_the_same_rows(docs, limits):
    expected = h.repeats_spec(enumerate(h.texts()))
    assert cut(docs, **limits) == expected and sum(e[1] for e in expected.values()) > 100


@pytest.mark.parametrize("limits", [{}, {"group_words": 1_500, "group_anchors": 40}])
def test_a_passage_in_a_third_of_all_documents(spark, limits):
    rng = random.Random(5)
    some = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    passage, opening = some(60), some(6)
    values = [" ".join([*some(15), *(passage if k % 3 == 0 else opening + some(25)), *some(10)]) for k in range(120)]
    df = h.frame(spark, values).repartition(30, "doc_id").select("doc_id", "text")
    expected = h.repeats_spec(enumerate(values))
    assert cut(df, **limits) == expected and sum(e[1] for e in expected.values()) >= 39 * 60


def turned(n):
    """The first ``n`` letters of the word in a and b that has no part thrice in a row, and its complement."""
    bits = [k.bit_count() % 2 for k in range(n)]
    return "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)


def test_words_with_equal_polynomial_hashes_are_different(spark):
    one, other = turned(2048)
    rest = [f"r{k}" for k in range(19)]
    values = [" ".join([one, *rest]), " ".join([other, *rest]), " ".join([one, *rest])]
    assert [r[1] for _, r in sorted(cut(h.frame(spark, values)).items())] == [0, 0, 20]


def test_windows_with_equal_hashes_are_compared_by_words(spark, monkeypatch):
    values = h.texts(30)
    monkeypatch.setattr(substrings.xxhash, "xxh64_intdigest", lambda w: len(w) % 3)
    batch = pa.RecordBatch.from_pydict({"_id": list(range(len(values))), "_h": list(range(len(values))), "_text": values})
    found = pa.Table.from_batches(list(substrings._repeated(10**9)(iter(list(substrings._anchors(1, 20, 6)(iter([batch])))))))
    marks = {}
    for own, keys in zip(found["_h"].to_pylist(), found["_keys"].to_pylist(), strict=True):
        if keys is not None:
            marks.setdefault(own, []).append(keys)
    marked = batch.append_column("_marks", pa.array([marks.get(k, []) for k in range(len(values))], pa.list_(pa.binary())))
    leaves = pa.Table.from_batches(list(substrings._leaves(1, 20, 6, [])(iter([marked]))))
    out = {k: np.zeros(0, np.int64) for k in range(len(values))}
    for r in substrings._subtree(20, pa.int64())(leaves).to_pylist():
        out[r["_id"]] = np.append(out[r["_id"]], r["_found"])
    for k, expected in h.repeats_spec(enumerate(values)).items():
        assert substrings._covered(expected[0], out[k], 20).sum() == expected[1]


def test_ids_of_any_type_and_null_ids(spark):
    text, other = " ".join(f"w{i}" for i in range(25)), " ".join(f"v{i}" for i in range(30))
    rows = [("b", text, 1, "x"), ("a", text, 2, "x"), ("a", text, 3, "x"), (None, text, 4, "x"), (None, other, 5, "x"), ("aa", "", 6, None), ("c", None, 7, None)]
    df = spark.createDataFrame(rows, "doc_id string, text string, _id int, _h string")
    out = {r["_id"]: (r["doc_id"], r["_h"], r["n_removed"], r["text"]) for r in substrings.remove_repeats(df).collect()}
    assert out == {1: ("b", "x", 25, ""), 2: ("a", "x", 0, text), 3: ("a", "x", 0, text), 4: (None, "x", 25, ""), 5: (None, "x", 0, other), 6: ("aa", None, 0, ""), 7: ("c", None, 0, None)}


def test_rows_that_repeat_an_id_and_a_start_go_together(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(0, text), (1, text + " one"), (1, text + " two"), (1, text + " two")]
    out = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["text"]) for r in out) == [(0, 0, text), (1, 25, "one"), (1, 25, "two"), (1, 25, "two")]


def test_ranks_names_and_long_words():
    values = np.array([3, 1, 2, 3, 1, 2, 3, 1, 9])
    names = substrings.suffix_names(values, 3)
    assert names[0] == names[3] != names[6] and len(names) == 7
    order = [tuple(values[k : k + 3]) for k in np.argsort(names, kind="stable")]
    assert order == sorted(order)
    assert substrings._ranks(pa.array(["b", None, "a", "b"])).tolist() == [1, 2, 0, 1]
    chunk = substrings.Chunk([b"a  b", None, b"", b" b\ta " + b"x" * 100_000], 2, 1)
    assert chunk.counts.tolist() == [2, 0, 0, 3] and bytes(chunk.text(1, 3)) == b"b b "
    assert substrings._sliding(np.arange(40, dtype=np.uint64), 15, np.minimum).tolist() == list(range(26))
