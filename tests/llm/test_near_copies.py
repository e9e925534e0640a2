import random

import helpers as h
import numpy as np
import pytest

import corpus_pipeline
from textloom.llm import near_copies


def sets_spec(t):
    w = h.WORD.findall((t or "").translate(h.LOWER))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def kept_spec(values):
    sets = {d: s for d, t in enumerate(values) if (s := sets_spec(t))}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a + 1, len(values)):
            if b in sets and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d for d, t in enumerate(values) if d not in root or root[d] == d}


def edited(rng, words, edits):
    """``words`` with single words replaced: about five shingles less each."""
    out = list(words)
    for k in rng.sample(range(len(out)), edits):
        out[k] = f"z{rng.randrange(10**6)}"
    return " ".join(out)


def near_texts(groups=12, copies=6, length=300):
    rng = random.Random(8)
    out = []
    for g in range(groups):
        words = [f"v{rng.randrange(5000)}" for _ in range(length)]
        out += [" ".join(words)] + [edited(rng, words, e) for e in rng.choices((1, 3, 5, 6, 7, 9, 14), k=copies)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("small_bucket", [64, 2])
def test_stage_equals_brute_force(spark, small_bucket):
    values = near_texts() + h.texts()
    expected = kept_spec(values)
    fps = [h.fingerprint_spec(t) for t in values]
    far = [(a, b) for a in range(80) for b in range(a) if (s := sets_spec(values[a])) and 10 * len(s & sets_spec(values[b])) >= 8 * len(s | sets_spec(values[b])) and (fps[a] ^ fps[b]).bit_count() > 2]
    assert far  # links that fingerprints two bits apart do not give
    got = near_copies.drop_near_copies(h.frame(spark, values), small_bucket=small_bucket).collect()
    assert len(got) == len(expected) and {r["doc_id"] for r in got} == expected
    assert all(r["text"] == values[r["doc_id"]] for r in got)


def test_rows_with_null_and_repeated_ids(spark):
    text, other = "a b c d e f g h", "i j k l m n o p"
    rows = [(None, text), (None, text), (1, text), (1, other), (1, other), (2, text.upper()), (3, None), (4, " ")]
    got = near_copies.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(None, text), (None, text), (1, text), (1, other), (3, None), (4, " ")]))


def test_band_minima_estimate_the_similarity():
    rng = np.random.default_rng(1)
    every = np.unique(rng.integers(0, 1 << 63, 3000).astype(np.uint64))
    a, b = every[: len(every) * 9 // 10], every[len(every) // 10 :]
    assert (near_copies.band_keys(a) == near_copies.band_keys(b)).sum() >= 4
    assert near_copies.shingle_set(b"one two").size == 1 and near_copies.shingle_set(b" \n").size == 0


def test_sketches_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(2)
    for n in (1, 40, 3000):
        every = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        a, b = every[rng.random(len(every)) < 0.8], every[rng.random(len(every)) < 0.9]
        bits = np.unpackbits((near_copies.sketch(a) ^ near_copies.sketch(b)).view(np.uint8)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_pipeline_stage_drops_what_fingerprints_miss(spark, sf):
    values = near_texts()
    got = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, h.frame(spark, values), sf).collect()}
    assert got == kept_spec(values)


def test_a_full_bitmap_changes_no_row(spark, monkeypatch):
    values = near_texts(groups=4)
    monkeypatch.setattr(near_copies, "WORDS", 1)
    got = [r["doc_id"] for r in near_copies.drop_near_copies(h.frame(spark, values * 2)).collect()]
    assert len(got) == len(set(got)) and set(got) == kept_spec(values * 2)


def test_sieve_keeps_every_key_and_passes_each_row_once(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "xxhash64(id) AS _h", "'x' AS text")
    some, rest = near_copies._sieve(rows, rows.where("doc_id % 7 = 0").select("doc_id", "_h"))
    some, rest = ({r["doc_id"] for r in x.collect()} for x in (some, rest))
    assert {k for k in range(3000) if k % 7 == 0} <= some and not some & rest and len(some) + len(rest) == 3000
    assert len(some) < 600


def test_empty_input_gives_no_rows(spark):
    assert near_copies.drop_near_copies(h.frame(spark, ["a b"]).limit(0)).count() == 0


def votes_spec(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in hashes) > len(hashes))


def keys_of(shingles):
    return set(near_copies.band_keys(shingles).tolist()) - {0}


def pair_at(rng, a, b, shared):
    every = rng.integers(0, 1 << 64, a + b - shared, np.uint64)
    return np.sort(every[:a]), np.sort(every[a - shared :])


def test_fingerprints_are_majority_votes_of_sets_and_slices():
    rng = np.random.default_rng(5)
    for n in (4, 5, 70, 1500):
        s = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        assert int(near_copies.whole_fingerprint(s)) == votes_spec(s)
        for level in near_copies.levels(len(s)):
            words, counts = near_copies.part_words(s, level)
            for k, (word, count) in enumerate(zip(words.ravel(), counts.ravel(), strict=True)):
                hashed = [int(x ^ near_copies._FLIPS[k]) * int(near_copies._FACTORS[k]) % (1 << 64) for x in s]
                sampled = [x for x, y in zip(s, hashed, strict=True) if y < 1 << (64 - level)]
                assert (int(word), int(count)) == (votes_spec(sampled), len(sampled))
    long = rng.integers(0, 1 << 64, 150_000, np.uint64)
    ones = ((long[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).sum(axis=0)
    assert int(near_copies.whole_fingerprint(long)) == sum(1 << b for b in range(64) if 2 * int(ones[b]) > len(long))


def test_masks_cover_two_bits_of_the_whole_and_one_word_of_each_part(monkeypatch):
    rng = np.random.default_rng(6)
    s, other = (np.unique(rng.integers(0, 1 << 64, 200, np.uint64)) for _ in range(2))
    common = lambda: keys_of(s) & keys_of(other)
    assert not common()
    whole = near_copies.whole_fingerprint(s)
    for _ in range(40):
        i, j = (np.uint64(x) for x in rng.choice(64, 2, replace=False))
        near = whole ^ (np.uint64(1) << i) ^ (np.uint64(1) << j)
        with monkeypatch.context() as m:
            m.setattr(near_copies, "whole_fingerprint", lambda x, n=near: n if x is other else whole)
            assert common()
    slices = near_copies.part_words
    for k in range(near_copies.WORDS_A_PART):
        def changed(x, level, k=k):
            words, counts = slices(s, level)
            words[1 if x is other else 0 :, k] ^= np.uint64(0xFFFF if x is other else 0)  # all bits of a word may differ
            return words, np.full_like(counts, 1)

        with monkeypatch.context() as m:
            m.setattr(near_copies, "part_words", changed)
            assert len(common()) >= near_copies.PARTS


def test_pairs_at_the_threshold_share_a_key():
    rng = np.random.default_rng(7)
    sizes = [(4, 5, 4), (8, 10, 8), (9, 9, 8), (45, 45, 40), (47, 47, 42), (80, 100, 80), (100, 80, 80), (189, 189, 168), (383, 384, 341), (1530, 1530, 1360)]
    for a, b, shared in sizes:
        assert 10 * shared >= 8 * (a + b - shared)
        for _ in range(150):
            x, y = pair_at(rng, a, b, shared)
            assert keys_of(x) & keys_of(y)


def test_unlike_sets_and_those_without_links_share_no_key():
    rng = np.random.default_rng(8)
    assert all(near_copies.band_keys(np.arange(1, n + 1, dtype=np.uint64)).size == 0 for n in (1, 2, 3))
    keys = [keys_of(np.unique(rng.integers(0, 1 << 64, n, np.uint64))) for n in rng.integers(4, 300, 400)]
    assert sum(len(a & b) for k, a in enumerate(keys) for b in keys[:k]) <= 2
