import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import terms

ALPHABET = "aabbZK09_-' .\né×ßªµ²½…ÿİ̇́ⓐ‍漢𝒳"


def odd_texts(count, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) for _ in range(count)]


def test_tokens_are_those_of_the_expression(spark):
    texts = odd_texts(3000)
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tx.term_tokens(F.col("t"))).collect()
    flat, lengths = terms.split_tokens(texts)
    ends = np.cumsum(lengths)
    for i, expected in rows:
        assert flat[int(ends[i] - lengths[i]) : int(ends[i])].to_pylist() == expected, texts[i]
    assert terms.split_tokens([""])[0].to_pylist() == [] and terms.split_tokens(["", "a", ""])[1].tolist() == [0, 1, 0]


def brute_force(rows, least):
    counts, texts, first = Counter(), defaultdict(set), {}
    for key, text in rows:
        words = [w for w in text.split() if w]
        for n in (1, 2, 3):
            for i in range(len(words) - n + 1):
                term = " ".join(words[i : i + n])
                counts[term] += 1
                if key is not None:
                    texts[term].add(key)
                    first[term] = min(first.get(term, (key, n, i)), (key, n, i))
    return {t: (c, len(texts[t]), first.get(t)) for t, c in counts.items() if c >= least}


def found(frame):
    return {r["term"]: (r["frequency"], r["document_frequency"], None if r["first"] is None else (int(r["first"]) >> 45, int(r["first"]) % (1 << 45) >> 40, int(r["first"]) % (1 << 40))) for r in frame.collect()}


def test_counts_with_and_without_bounds(spark, monkeypatch):
    monkeypatch.setattr(terms, "CHUNK", 300)
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["ab", "c", "de", "f", "g" * rng.randint(1, 9)]) for _ in range(rng.randint(0, 60)))) for k in range(150)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for least in (1, 2, 20):
        assert found(terms.term_counts(docs, min_frequency=least)) == brute_force(rows, least)
    wide = {t: x for t, x in brute_force(rows, 1).items() if x[1] >= 5}
    assert found(terms.term_counts(docs, min_documents=5)) == wide


def test_rows_without_a_key_or_with_another_rows_key(spark):
    rows = [(1, "a b"), (1, "b a"), (None, "a b"), (None, "x"), (2, "a b"), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(terms.term_counts(docs, max_n=1))
    assert {t: x[:2] for t, x in got.items()} == {"a": (4, 2), "b": (4, 2), "x": (2, 1)}


def test_terms_below_the_bound_are_not_shuffled(spark):
    rows = [(k, f"common word w{k} " + " ".join(f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}{'uvwxyz'[j % 6]}{'abcdef'[j // 6]}" for j in range(36))) for k in range(100)]
    frame = spark.createDataFrame(rows, "ord long, text string").repartition(4)
    bits = spark.sparkContext.broadcast(terms._frequent(frame, 3, 20, 1))
    kept = {r["term"] for r in terms._by_chunk(frame, 3, bits).select("term").distinct().collect()}
    assert {"common", "word", "common word"} <= kept and len(kept) < 10


def test_hashes_do_not_depend_on_the_chunk():
    one, two = (terms._Tokens(pa.table({"ord": [1], "text": [t]})) for t in ("a b c", "z a b c"))
    assert all(one.hashes()(n, np.array([0])) == two.hashes()(n, np.array([1])) for n in (1, 2, 3))
