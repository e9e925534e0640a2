"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' normalised words are compiled into one automaton per block of items. Training texts are streamed
through it; the automaton's state gives, at each word, the longest run ending there that occurs in any item.
A run of at least ``window`` words is a hit. The items are the stated query set and documents never meet each other.

Memory: items of at most ``block_bytes`` make one automaton, built once in each Python worker, and texts are not shuffled.
More items go in blocks, one after the other: each block is broadcast, finds the texts that it hits, and is released, so
neither the driver nor an executor holds more than one block whatever the items' size. Hits of the blocks are then
joined to the rows by the hash of their text. A stage sends texts through Python once: each such pass has a worker of its own
on every core, with a batch of texts in it. Cutting is therefore done where the hits are found, a few rows at a time.

Defined cases: null or empty texts have no words and no hits; an item without words never matches; an item
shorter than the window matches as a whole; repeated items or item ids count once; repeated rows get the same answer; empty
tables give no rows or no hits; texts of any length are read whole; extra columns of ``docs`` pass through under any name,
but for those that :func:`find_overlaps` is told to add.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.llm.common import column, join_small, prefixed, stored, working

#: Bytes outside words become spaces, A-Z become a-z; bytes from 0x80 belong to words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normalised(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII digits, letters (lower-cased) and all non-ASCII characters."""
    return text.translate(_FOLD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, annotated for matching windows.

    ``window``: length of a match. ``owners[v]``: ids of items containing the ``window``-word string of state
    ``v``; ``shorts[v]``: (length, id) of whole items shorter than ``window`` that end in ``v``'s suffix chain.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            codes = [self.words.setdefault(w, len(self.words)) for w in words]
            coded.append((name, codes))
            last = 0
            for c in codes:
                last = self._extend(last, c)
        self.owners: dict[int, set[str]] = {}
        own_shorts: dict[int, set[tuple[int, str]]] = {}
        for name, codes in coded:
            v = size = 0
            for c in codes:
                v, size = self.step(v, size, c)
                if size >= window:
                    self.owners.setdefault(self._shrink(v, window), set()).add(name)
            if 0 < len(codes) < window:
                own_shorts.setdefault(v, set()).add((len(codes), name))
        self.shorts: list[frozenset] = [frozenset()] * len(self.next)
        for v in sorted(range(len(self.next)), key=self.length.__getitem__):
            inherited = self.shorts[self.link[v]] if v else frozenset()
            self.shorts[v] = inherited | own_shorts[v] if v in own_shorts else inherited
        self.top = [self._shrink(v, window) if n >= window else -1 for v, n in enumerate(self.length)]

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the strings that end through ``p``."""
        clone = self._state(self.length[p] + 1)
        self.next[clone], self.link[clone] = dict(self.next[q]), self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._state(self.length[last] + 1), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def _shrink(self, v: int, size: int) -> int:
        """The state that holds the last ``size`` words of ``v``'s strings."""
        while self.length[self.link[v]] >= size:
            v = self.link[v]
        return v

    def step(self, v: int, size: int, c: int) -> tuple[int, int]:
        """The state and match length after word ``c``."""
        while c not in self.next[v]:
            v = self.link[v]
            if v < 0:
                return 0, 0
            size = self.length[v]
        return self.next[v][c], size + 1

    def match(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged [start, end) word spans covered by matches, and the ids of items matched."""
        spans: list[list[int]] = []
        found: set[str] = set()
        code, nexts, links, lengths, shorts, window = self.words.get, self.next, self.link, self.length, self.shorts, self.window
        v = size = 0
        for i, c in enumerate(map(code, words), 1):
            if c is None:
                v = size = 0
                continue
            while c not in nexts[v]:
                v = links[v]
                if v < 0:
                    break
                size = lengths[v]
            if v < 0:
                v = size = 0
                continue
            v = nexts[v][c]
            size += 1
            hit = 0
            if size >= window:
                hit = window
                u = self.top[v] if self.length[self.link[v]] < window else self._shrink(v, window)
                found |= self.owners[u]
            if shorts[v]:
                for n, name in shorts[v]:
                    if n <= size:
                        hit = max(hit, n)
                        found.add(name)
            if hit:
                start = i - hit
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = i
                else:
                    spans.append([start, i])
        return spans, found


def _blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of at most ``block_bytes`` of text (one item at least), streamed through the driver."""
    block, held = [], 0
    rows = items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("binary").alias("t"))
    for r in rows.where("i is not null and t is not null").toLocalIterator():
        text = bytes(r["t"])
        if block and held + len(text) > block_bytes:
            yield block
            block, held = [], 0
        block.append((r["i"], text))
        held += len(text)
    if block:
        yield block


def _merged(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted([*a, *b]):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


_built: tuple[str, SuffixAutomaton] | None = None


def automaton_of(key: str, block, window: int) -> SuffixAutomaton:
    """The automaton of a broadcast block, kept for the next tasks of this worker until another block comes."""
    global _built
    if _built is None or _built[0] != key:
        _built = None
        _built = key, SuffixAutomaton([(i, normalised(t)) for i, t in block.value], window)
    return _built[1]


_ANSWER = "_n_words bigint, _hits array<struct<s:bigint,e:bigint>>, _items array<string>"
#: Rows of a batch that a cut gives at once.
_ROWS = 512
_HIT_TYPE = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))


def find_overlaps(docs: DataFrame, items: DataFrame, window: int = 8, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = 4_000_000, keep_text: bool = False, added: tuple[str, str, str] = ("n_words", "hits", "items")) -> DataFrame:
    """Adds to each row its number of words, word spans hit (end exclusive) and ids of matching items, named as ``added``.

    ``block_bytes`` bounds the item text compiled at a time. ``keep_text`` keeps the text column in the result.
    """
    kept = [c for c in docs.columns if c not in added and (keep_text or c != text_col)]
    found = _found(docs, items, kept, window, text_col, item_id, item_text, block_bytes)
    return found.select(*[F.col("_text" if c == text_col else working(c)).alias(c) for c in kept], *[F.col(c).alias(n) for c, n in zip(("_n_words", "_hits", "_items"), added, strict=True)])


def _found(docs: DataFrame, items: DataFrame, kept: list[str], window: int, text_col: str, item_id: str, item_text: str, block_bytes: int, answered: Callable | None = None) -> DataFrame:
    """The ``kept`` columns renamed, ``_text``, ``_n_words``, ``_hits`` and ``_items``.

    ``answered`` takes what :func:`_answered` takes and gives batches of the renamed columns and ``_text`` instead.
    """
    schema = (lambda df: df.schema) if answered else _with_answer
    answered = answered or _answered
    spark = docs.sparkSession
    rows = docs.select(column(text_col).alias("_text"), *[prefixed(c) for c in kept if c != text_col])
    blocks = _blocks(items, item_id, item_text, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        return rows.mapInArrow(_matcher(_of_block(spark.sparkContext.broadcast(first), window), answered), schema(rows))
    key = F.struct(F.xxhash64("_text").alias("a"), F.xxhash64(F.lit(1), "_text").alias("b"))
    texts = rows.select(key.alias("_key"), "_text")
    parts = []
    for given in _chained(first, second, blocks):
        block = spark.sparkContext.broadcast(given)
        hit = texts.mapInArrow(_matcher(_of_block(block, window), _answered), _with_answer(texts))
        parts.append(stored(hit.where(F.size("_items") > 0).select("_key", "_hits", "_items").dropDuplicates(["_key"])))
        block.destroy()
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy("_key").agg(F.flatten(F.collect_list("_hits")).alias("_all"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("_names"))
    joined = join_small(rows.withColumn("_key", key), stored(merged), "_key", "left").drop("_key")
    return joined.mapInArrow(_merger(answered), schema(joined.drop("_all", "_names")))


def _chained(first: list, second: list, others: Iterator[list]) -> Iterator[list]:
    yield first
    yield second
    yield from others


def _of_block(block, window: int) -> Callable:
    key = uuid.uuid4().hex

    def match(words: list[bytes]):
        from textloom.llm import decontamination  # the worker's own module, whose cache outlives the task

        return decontamination.automaton_of(key, block, window).match(words)

    return match


def _with_answer(rows: DataFrame):
    return StructType([*rows.schema, *StructType.fromDDL(_ANSWER)])


def _answered(batch: pa.RecordBatch, counts: list, hits: list, names: list) -> Iterator[pa.RecordBatch]:
    cols = {n: batch.column(n) for n in batch.schema.names}
    cols["_n_words"] = pa.array(counts, pa.int64())
    cols["_hits"] = pa.array([[{"s": s, "e": e} for s, e in x] for x in hits], _HIT_TYPE)
    yield pa.RecordBatch.from_pydict(cols | {"_items": pa.array(names, pa.list_(pa.string()))})


def _matcher(match: Callable, answered: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, hits, names = [], [], []
            for text in batch.column("_text"):
                words = normalised(text.as_buffer().to_pybytes()) if text.is_valid else []
                spans, found = match(words)
                counts.append(len(words))
                hits.append(spans)
                names.append(sorted(found))
            yield from answered(batch, counts, hits, names)

    return run


def _merger(answered: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(normalised(t.as_buffer().to_pybytes())) if t.is_valid else 0 for t in batch.column("_text")]
            hits = [_merged([], [[x["s"], x["e"]] for x in h or ()]) for h in batch.column("_all").to_pylist()]
            names = [n or [] for n in batch.column("_names").to_pylist()]
            yield from answered(batch.select([n for n in batch.schema.names if n not in ("_all", "_names")]), counts, hits, names)

    return run


def _without(raw: bytes, spans: list[list[int]]) -> bytes:
    """A text without its words from start to end of each span."""
    folded, at, bounds = raw.translate(_FOLD), 0, []
    for w in folded.split():
        at = folded.index(w, at)
        bounds.append((at, at + len(w)))
        at += len(w)
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at : bounds[s][0]])
        at = bounds[e - 1][1]
    return b"".join([*kept, raw[at:]])


def _cutter(min_span: int, max_coverage: float):
    """Cuts spans of ``min_span`` words or more; leaves out rows of which they cover more than ``max_coverage``."""

    def run(batch: pa.RecordBatch, counts: list, hits: list, _names: list) -> Iterator[pa.RecordBatch]:
        long_hits = [[x for x in h if x[1] - x[0] >= min_span] for h in hits]
        kept = [k for k, h in enumerate(long_hits) if sum(e - s for s, e in h) <= counts[k] * max_coverage]
        for at in range(0, len(kept), _ROWS):
            rows = kept[at : at + _ROWS]
            part = batch.take(pa.array(rows, pa.int64()))
            texts = part.column("_text")
            if any(long_hits[k] for k in rows):
                raw = [t.as_buffer().to_pybytes() if t.is_valid else None for t in texts]
                texts = pa.array([_without(t, long_hits[k]) if long_hits[k] else t for t, k in zip(raw, rows, strict=True)], pa.binary()).cast(texts.type, safe=False)
            yield pa.RecordBatch.from_pydict({n: texts if n == "_text" else part.column(n) for n in part.schema.names})

    return run


def remove_overlaps(docs: DataFrame, items: DataFrame, window: int = 8, max_coverage: float = 0.5, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every matched span of ``window`` words or more cut out of its text.

    A document of which more than ``max_coverage`` of the words lie in such spans is dropped whole. Spans of
    items shorter than the window are reported by :func:`find_overlaps` but not cut: they are ordinary phrases.
    Columns and their order stay; rows without a match are unchanged.
    """
    options = {"item_id": "item_id", "item_text": "text", "block_bytes": 4_000_000} | options
    cut = _found(docs, items, docs.columns, window, text_col, **options, answered=_cutter(window, float(max_coverage)))
    return cut.select(*[F.col("_text" if c == text_col else working(c)).alias(c) for c in docs.columns])


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    found = find_overlaps(docs.select("doc_id", "text"), items.select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, x: a + x["e"] - x["s"]).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")).cast("binary"), 256).alias("items_sha256"),
        (F.size("items") >= 2).alias("contaminated"),
    )


_SQL_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {_SQL_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
wins AS (
  SELECT item, least(len(w), 8) AS n, unnest(list_transform(range(1, greatest(len(w) - 7, 1) + 1), lambda k: array_to_string(w[k:k + 7], ' '))) AS g
  FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS k, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS g
  FROM d, sizes WHERE len(w) >= n),
found AS (SELECT DISTINCT doc_id, k, grams.n, item FROM grams JOIN wins ON grams.g = wins.g AND grams.n = wins.n),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(len(items), 0) >= 2 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
