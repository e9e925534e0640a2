import hashlib
import random

import pytest
from pyspark.sql import functions as F

from textloom.operators import dedup


def signature_spec(text, n=5):
    rng = random.Random(42)
    p = (1 << 61) - 1
    a = [rng.randint(1, p - 1) for _ in range(128)]
    b = [rng.randint(0, p - 1) for _ in range(128)]
    t = text.lower().strip()
    grams = {t[i : i + n] for i in range(len(t) - n + 1)} or {t}
    hs = [int.from_bytes(hashlib.md5(g.encode()).digest()[:4], "little") for g in grams]
    return [min(((x * h + y) % p) & 0xFFFFFFFF for h in hs) for x, y in zip(a, b, strict=True)]


TEXTS = ["", "hi", "Hello world, this is a text", "ünïcode café \U0001f600 text text", "x" * 50]


def test_signatures(spark):
    a, b = dedup.permutations()
    assert [s.tolist() for s in dedup.signatures(TEXTS, a, b)] == [signature_spec(t) for t in TEXTS]
    assert [dedup.signature_of(t, a, b) for t in TEXTS] == [signature_spec(t) for t in TEXTS]


def test_shingles_and_their_hash(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").select("i", dedup.shingles(F.col("t"))).collect()
    for i, found in rows:
        t = TEXTS[i].lower().strip()
        assert set(found) == ({t[k : k + 5] for k in range(len(t) - 4)} or {t})
    assert spark.range(1).select(dedup.shingle_hash(F.lit("hello"))).first()[0] == 708854109


def test_first_copy_stays(spark):
    texts = ["A contract about many things. " * 5] * 5 + ["Something else entirely, about fish. " * 5]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r[0] for r in dedup.deduplicate(rows).select("doc_id").collect()) == [0, 5]


def test_near_copy_goes_at_a_lower_threshold(spark):
    base = "This is a long document about commercial law and contracts between parties. " * 4
    rows = spark.createDataFrame([(0, base), (1, base + " Additional minor text here.")], "doc_id long, text string")
    assert [r[0] for r in dedup.deduplicate(rows, threshold=0.7).select("doc_id").collect()] == [0]


def test_greedy_keeps_the_far_end_of_a_chain(spark):
    links = [(k, k + 1) for k in range(1, 7)] + [(10, 12), (11, 12)]
    gone = dedup.removed_by_greedy(spark.createDataFrame(links, "i long, j long"))
    assert sorted(r[0] for r in gone.collect()) == [2, 4, 6, 12]


def test_lengths_must_agree(spark):
    with pytest.raises(Exception, match="differ in length"):
        spark.range(1).select(dedup.jaccard_estimate(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2)))).collect()
    with pytest.raises(ValueError, match="make up"):
        dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string"), num_perm=64)
