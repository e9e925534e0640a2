import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_dedup import TEXTS, signature_spec

from textloom.functions import arrow
from textloom.functions import text as tx
from textloom.operators import dedup

WIDE = "".join(map(chr, range(0x4E00, 0x4E00 + 5000)))  # more characters than five of which make one number


def texts():
    rng = random.Random(5)
    return [*TEXTS, "  ÀB ", "abcd", "abcde", "\u001cab cd ef\u0085", *("".join(rng.choice("abcé 漢\U0001f600") for _ in range(rng.randint(0, 60))) for _ in range(60))]


@pytest.mark.parametrize("more", [[], [WIDE]])
def test_shingles_of_many_texts_at_once(more):
    given = texts() + more
    hashes, own = dedup.shingled(given)
    for t, numbers in zip(given, own, strict=True):
        plain = t.lower().strip()
        assert sorted(hashes[numbers].tolist()) == sorted(dedup.shingle_hashes(plain).tolist())
    assert dedup.shingled([])[1] == [] and len(dedup.shingled([""])[1][0]) == 1


def test_a_shingle_of_several_texts_is_hashed_once(monkeypatch):
    calls = []
    monkeypatch.setattr(dedup, "_md5_head", lambda x, f=dedup._md5_head: calls.append(x) or f(x))
    dedup.shingled(["the same text again and again " * 5] * 50)
    assert len(calls) == len(set(calls)) == 27 + 4  # and four that reach from one text into the next


def test_signatures_with_and_without_held_values():
    a, b = dedup.permutations()
    expected = [signature_spec(t) for t in texts()]
    for options in ({}, {"held": 3}, {"block": 7}, {"held": 3, "block": 7}):
        assert [s.tolist() for s in dedup.signatures(texts(), a, b, **options)] == expected


def test_permutations_at_the_edges():
    a = np.array([1, 2, dedup.PRIME - 1, 1 << 60, (1 << 31) - 1], np.uint64)
    b = np.array([0, dedup.PRIME - 1, 1, 5, dedup.PRIME - 1], np.uint64)
    h = np.array([0, 1, 2, 0xFFFFFFFF, 0x80000000, 0x7FFFFFFF], np.uint64)
    assert dedup.permuted(h, a, b).tolist() == [[((int(x) * int(y) + int(z)) % dedup.PRIME) & 0xFFFFFFFF for x, z in zip(a, b, strict=True)] for y in h]


def test_hashes_are_those_of_the_expressions(spark, monkeypatch):
    monkeypatch.setattr(dedup, "slices", lambda batches, name, limit: arrow.slices(batches, name, 100))
    rows = spark.createDataFrame([*enumerate(texts()), (-1, None)], "i int, t string")
    h = F.transform(dedup.shingles(F.col("t")), dedup.shingle_hash)
    expected = rows.select("i", F.array_min(h), F.array_max(h), tx.array_sum(h)).collect()
    assert sorted(map(tuple, dedup.with_shingle_hashes(rows, text_col="t").collect())) == sorted(map(tuple, expected))
    assert [r["signature"] for r in dedup.with_signatures(rows.where("i >= 0"), text_col="t").orderBy("i").collect()] == [signature_spec(t) for t in texts()]
