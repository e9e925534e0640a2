import random

import numpy as np
import pytest

from textloom.operators import packing


def fold(sizes, limit):
    out, used = [], 0
    for n in sizes:
        if not out or (used and used + n + 1 > limit):
            out.append([])
            used = 0
        out[-1].append(n)
        used += n + 1
    return out


@pytest.mark.parametrize("limit", [5, 20, 64])
def test_ranges_compose_to_the_sequential_fold(limit):
    rng = random.Random(limit)
    for _ in range(60):
        sizes = [rng.choice([0, 1, 2, 3, limit - 1, limit, limit + 5, rng.randint(0, limit)]) for _ in range(rng.randint(1, 40))]
        used = number = 0
        cuts = sorted(rng.sample(range(len(sizes) + 1), min(3, len(sizes))))
        for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True):
            if b > a:
                effect = packing._Sizes(np.array(sizes[a:b]), limit).effect()
                number, used = number + int(effect[0, used]), int(effect[1, used])
        expected = fold(sizes, limit)
        assert number == len(expected)
        assert used == min(limit, sum(expected[-1]) + len(expected[-1]))


def test_one_shard_is_packed_in_parts(spark):
    rng = random.Random(3)
    sizes = [rng.choice([0, 1, 5, 30, 31, 32, 80, rng.randint(0, 33)]) for _ in range(1500)]
    rows = [((k // 7, k % 7), [k] * n, [1] * n, None) for k, n in enumerate(sizes)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "ord struct<a:int,b:int>, input_ids array<int>, attention_mask array<int>, labels array<int>").repartition(3)
    packed = packing.pack(frame, 32, -1)
    done = sorted(packed.collect(), key=lambda r: r["sequence"])
    assert [r["sequence"] for r in done] == list(range(len(done))) and {r["shard"] for r in done} == {0}
    k = 0
    for r, own in zip(done, fold(sizes, 32), strict=True):
        assert r["n_examples"] == len(own)
        ids = []
        for n in own:
            ids += [k] * n + [-1]
            k += 1
        assert r["input_ids"] == ids and r["attention_mask"] == [1] * len(ids)
        assert r["labels"] == [-100 if x == -1 else x for x in ids]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would all go to one task
    filled = packing.pack(frame, 32, -1).rdd.mapPartitions(lambda it: [1] if any(True for _ in it) else []).sum()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert filled > 1


def test_shards_and_equal_places(spark):
    rows = [(1, [k] * n, [1] * n, None) for k, n in enumerate([3, 9, 3, 9, 4, 4, 12] * 30)]
    frame = spark.createDataFrame(rows, "ord int, input_ids array<int>, attention_mask array<int>, labels array<int>").repartition(3)
    done = packing.pack(frame, 10).collect()
    assert sum(r["n_examples"] for r in done) == len(rows)
    assert sorted(r["sequence"] for r in done) == list(range(len(fold(sorted(len(r[1]) for r in rows), 10))))
    two = packing.pack(frame.withColumn("ord", frame["input_ids"][0]), 10, shards=2).collect()
    assert {r["shard"] for r in two} == {0, 1} and sum(r["n_examples"] for r in two) == len(rows)
