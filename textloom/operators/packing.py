"""Tokenised examples: tokenisers, truncation, counters and next-fit packing of sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrow import SLICE, lengths, slices
from textloom.session import materialised

TOKENS = T.StructType([T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("input_ids", "attention_mask", "labels")])
IGNORED = -100


class Tokenizer(Protocol):
    def encode(self, texts: list[str]) -> list[list[int]]: ...


class ByteTokenizer:
    """One token a UTF-8 byte."""

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [list(t.encode()) for t in texts]


class FileTokenizer:
    """A tokenizers JSON file, loaded once in each worker; the path must be readable there."""

    def __init__(self, path: str):
        self.path, self._loaded = path, None

    def __getstate__(self) -> dict:
        return {"path": self.path, "_loaded": None}

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self._loaded is None:
            from tokenizers import Tokenizer as Loaded

            self._loaded = Loaded.from_file(self.path)
            self._loaded.encode_special_tokens = True
        return [x.ids for x in self._loaded.encode_batch(texts, add_special_tokens=False)]


def tokenize(rows: DataFrame, tokenizer: Tokenizer, max_length: int = 2048, text_col: str = "text") -> DataFrame:
    """``rows`` with input_ids (cut to ``max_length``), attention_mask and labels in place of the text."""
    others = [f for f in rows.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            ids = [x[:max_length] for x in tokenizer.encode(["" if t is None else t for t in part.column(text_col).to_pylist()])]
            yield part.drop_columns([text_col]).append_column("input_ids", pa.array(ids, pa.list_(pa.int32())))

    cut = rows.mapInArrow(run, T.StructType([*others, TOKENS["input_ids"]]))
    return cut.withColumns({"attention_mask": F.transform("input_ids", lambda _: F.lit(1)), "labels": F.col("input_ids")})


def token_stats(tokenised: DataFrame, max_length: int = 2048, packed: DataFrame | None = None) -> DataFrame:
    """One row: total_examples, total_tokens, truncated (length equal to the limit), packed_sequences, avg_tokens."""
    size = F.size("input_ids")
    out = tokenised.agg(
        F.count("*").alias("total_examples"),
        F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total_tokens"),
        F.coalesce(F.sum((size == max_length).cast("long")), F.lit(0)).alias("truncated"),
    )
    mean = F.when(F.col("total_examples") > 0, F.col("total_tokens").cast("double") / F.col("total_examples")).otherwise(F.lit(0.0))
    out = out.withColumn("avg_tokens", mean)
    counted = packed.agg(F.count("*").alias("packed_sequences")) if packed is not None else None
    return out.crossJoin(counted) if counted is not None else out.withColumn("packed_sequences", F.lit(0).cast("long"))


def next_fit(sizes: list[int], max_length: int, used: int = 0) -> tuple[list[int], int]:
    """Sequence number of each example, and the length of the last sequence. Each example brings a separator."""
    out, bin_no = [], 0
    for n in sizes:
        if used and used + n + 1 > max_length:
            bin_no, used = bin_no + 1, 0
        used += n + 1
        out.append(bin_no)
    return out, used


class _Sizes:
    """The lengths of a range of examples, each with its separator, and where the sequences end that start at each of them."""

    def __init__(self, sizes: np.ndarray, max_length: int):
        self.max_length, self.n = max_length, len(sizes)
        self.sums = np.concatenate([[0], np.cumsum(sizes.astype(np.int64) + 1)])
        ends = np.searchsorted(self.sums, self.sums[:-1] + max_length, "right") - 1
        self.next = np.maximum(ends, np.arange(1, self.n + 1)).tolist()

    def first_start(self, used: int) -> int:
        """The first example that starts a sequence if ``used`` tokens wait in an open one; the range's end if none does."""
        return int(np.searchsorted(self.sums, self.max_length - min(used, self.max_length), "right")) - 1 if used else 0

    def effect(self) -> np.ndarray:
        """For 0 to ``max_length`` tokens used before: the sequences started in the range, and the tokens used after it."""
        started, last = [0] * (self.n + 1), list(range(self.n + 1))
        for i in range(self.n - 1, -1, -1):
            started[i] = 1 + started[self.next[i]]
            last[i] = last[self.next[i]] if self.next[i] < self.n else i
        out = np.empty((2, self.max_length + 1), np.int64)
        for used in range(self.max_length + 1):
            at = self.first_start(used)
            out[:, used] = started[at], self.sums[-1] - self.sums[last[at]] if at < self.n else used + self.sums[-1]
        return np.minimum(out, [[np.iinfo(np.int64).max], [self.max_length]])


def _literal(value, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and value is not None:
        return F.struct(*[_literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields, strict=True)])
    return F.lit(value).cast(kind)


def _starts(keyed: DataFrame, max_length: int) -> tuple[list[Column], list[int]]:
    """Keys at which sequences of the sequential fold start, about one a partition, and the numbers of these sequences.

    A range of the order maps the tokens that wait before it to those that wait after it; these maps are made for all
    ranges at once, composed in the driver, and tell each range the tokens that wait before it.
    """
    spark = keyed.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = materialised(keyed.select("_key"))
    ranges = materialised(sizes.repartitionByRange(parts, "_key").sortWithinPartitions("_key").select("_key", F.col("_key._n").alias("_n")))

    def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b.column("_n").to_numpy() for b in batches]
        if held:
            blob = zlib.compress(_Sizes(np.concatenate(held), max_length).effect().tobytes(), 1)
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "effect": pa.array([blob], pa.binary())})

    used = number = 0
    before: dict[int, tuple[int, int]] = {}
    for r in sorted(ranges.select("_n").mapInArrow(effects, "part int, effect binary").collect()):
        effect = np.frombuffer(zlib.decompress(r["effect"]), np.int64).reshape(2, -1)
        before[r["part"]] = used, number
        number, used = number + int(effect[0, used]), int(effect[1, used])

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            waiting, count = before[TaskContext.get().partitionId()]
            ends = _Sizes(rows.column("_n").to_numpy(), max_length)
            at = ends.first_start(waiting)
            while at < ends.n and at and rows.column("_key")[at] == rows.column("_key")[at - 1]:  # rows of one key are not told apart
                at, count = ends.next[at], count + 1
            if at < ends.n:
                yield from rows.slice(at, 1).select(["_key"]).append_column("sequence", pa.array([count])).to_batches()

    kind = keyed.schema["_key"].dataType
    found = sorted((r["sequence"], r["_key"]) for r in ranges.mapInArrow(starts, T.StructType([keyed.schema["_key"], T.StructField("sequence", T.LongType())])).collect())
    return [_literal(key, kind) for _, key in found], [n for n, _ in found]


def _filled(rows: DataFrame, max_length: int, separator_id: int, first: list[int] | None) -> DataFrame:
    """The fold over each partition of (_part, input_ids, attention_mask, labels), which starts anew with each ``_part``."""
    names = ("input_ids", "attention_mask", "labels")
    gaps = (separator_id, 1, IGNORED)
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("sequence", T.LongType()), T.StructField("n_examples", T.IntegerType()), *TOKENS.fields])

    def batch(done: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([x[k] for x in done], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int32()))]
        for k in range(3):
            values = [np.concatenate([y for x in held for y in (x[k], gaps[k : k + 1])]).astype(np.int32) for *_, held in done]
            ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values))))
        return pa.RecordBatch.from_arrays(columns, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        done: list[tuple] = []
        part, used, at, waiting = None, 0, 0, 0
        for rows in slices(batches, "input_ids"):
            flat = [(c.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *lengths(c)])) for c in map(rows.column, names)]
            for k, own in enumerate(rows.column("_part").to_pylist()):
                row = tuple(values[ends[k] : ends[k + 1]] for values, ends in flat)
                if held and (own != part or used + len(row[0]) + 1 > max_length):
                    done.append((part, at, len(held), held))
                    waiting += used
                    held, used, at = [], 0, at + 1
                if own != part:
                    part, at = own, first[own] if first else 0
                held.append(row)
                used += len(row[0]) + 1
                if waiting > SLICE // 4:
                    yield batch(done)
                    done, waiting = [], 0
        if held:
            done.append((part, at, len(held), held))
        if done:
            yield batch(done)

    return rows.mapInArrow(run, schema)


def pack(tokenised: DataFrame, max_length: int = 2048, separator_id: int = 0, ord_col: str = "ord", shards: int = 1) -> DataFrame:
    """Packs examples in order into sequences: (shard, sequence, n_examples, input_ids, attention_mask, labels).

    A sequence is closed when the next example with its separator would pass ``max_length``; an example that is
    longer makes an over-long sequence of its own. Separators have label -100. Packing is a fold in order by shard, a
    contiguous range of the order: one shard gives exactly the sequential result, more run without a look at the others at
    the price of one partly filled sequence each. One shard is cut where the fold starts a sequence anyway, which the examples'
    lengths tell, and its parts are packed in parallel. Examples of one place in the order go by length and hash.
    """
    key = F.struct(F.col(ord_col).alias("_ord"), F.size("input_ids").alias("_n"), F.xxhash64("input_ids").alias("_h")).alias("_key")
    rows = tokenised.select(key, "input_ids", "attention_mask", F.coalesce("labels", "input_ids").alias("labels"))
    if shards == 1:
        starts, first = _starts(rows, max_length)
        part = F.size(F.filter(F.array(*starts), lambda start: start <= F.col("_key"))) - 1 if starts else F.lit(0)
        rows = rows.withColumn("_part", part.cast("int"))
        rows = rows.repartition("_part").sortWithinPartitions("_part", "_key")
    else:
        first = None
        rows = rows.repartitionByRange(shards, "_key").sortWithinPartitions("_key").withColumn("_part", F.spark_partition_id())
    packed = _filled(rows.drop("_key"), max_length, separator_id, first)
    shard = F.col("_part") if shards > 1 else F.lit(0)
    return packed.select(shard.alias("shard"), "sequence", "n_examples", "input_ids", "attention_mask", "labels")
