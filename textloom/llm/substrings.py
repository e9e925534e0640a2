"""Substring deduplication with prefix-partitioned suffix trees over words.

A suffix starts at every word. The suffixes are split into memory-sized groups by a prefix of variable length, and each
group's subtree is built in one task from the words themselves: a suffix array by prefix doubling, whose runs of suffixes
that agree on ``window`` words are the tree's nodes of that depth. A node with two or more leaves is a repeat; its first
leaf (in document order) stays and the others are marked. Marked starts that follow each other make the maximal repeats.

A suffix's path is read from its anchor: of the ``short``-word runs inside its first ``window`` words, the one with the
least hash. Equal windows have equal anchors, and neighbouring suffixes share one, so a group gets stretches of text and not
``window`` words for each suffix. The prefix is the anchor at first, and grows only where it must:

1. *Count.* Each chunk of text sends every anchor once, and anchors are counted by prefix group. Those that stand once in
   the whole corpus hold nothing that repeats and are dropped, which leaves little of unique text.
2. *Split.* An anchor whose suffixes would fill more than a share of ``group_words`` is hot. The suffixes under hot prefixes
   are counted again by 10, then 14 words of their path, and only those still hot grow further.
3. *Build.* Groups are packed by hash to ``group_words`` words at most on average. A prefix that has grown to the whole
   window is one node however many leaves it has: its first leaf is an aggregate, combined before the shuffle.

Hashes decide only where a suffix goes; a clash costs work. What repeats is decided by comparing words.

Scale: texts are read in chunks of bounded bytes. Within a chunk, suffixes that repeat an earlier one of it are settled
at once, so a passage that fills a third of all documents sends a group at most one leaf from each chunk. The number of
groups follows the counted text and repeats, not a setting; hot prefixes are at most the repeats over ``group_words``, so
their list is small enough to ship.

Defined cases: null, empty and word-less texts have no suffixes; shorter texts than a window never lose words; ids
may be of any type that has an order, and null ids come last; rows that repeat an id are one document for the order
(only a strictly smaller (id, start) is earlier, so none of them removes the other's equal start) and are told apart by a
hash of their text; other columns pass through in :func:`remove_repeats` and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import join_small, prefixed, stored, working

#: Text bytes whose suffixes are held at a time.
CHUNK = 4 << 20
#: Words of a prefix before it becomes the whole window.
PREFIXES = (10, 14)
#: Words in a subtree's group, and distinct anchors counted in one group.
GROUP_WORDS, GROUP_ANCHORS = 2_000_000, 200_000
_LABEL_BASE = 0xD6E8FEB86659FD93
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _labels(words: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` word hashes, by doubling; wraps modulo 2**64."""
    run, length, out, done = words, 1, None, 0
    step = _LABEL_BASE
    while size:
        if size & 1:
            part = run if out is None else run[done:]
            if out is None:
                out = part
            else:
                n = min(len(out), len(part))
                out = out[:n] + part[:n] * np.uint64(pow(_LABEL_BASE, done, 1 << 64))
            done += length
        size >>= 1
        if size:
            n = len(run) - length
            run = run[:n] + run[length:] * np.uint64(step) if n > 0 else run[:0]
            step = step * step % (1 << 64)
            length *= 2
    return _mixed(out)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest (``pick``) of each run of ``width`` values."""
    run, length = values, 1
    while length * 2 <= width:
        run, length = pick(run[:-length], run[length:]), length * 2
    extra = width - length
    return pick(run[: len(run) - extra], run[extra:]) if extra else run


def _coded(data: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """Words as codes of equal words; ``data`` holds each word and one space, ``ends`` where the next one starts."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode()


def _ranks(ids: pa.Array) -> np.ndarray:
    """Places of ids in their order; equal ids share one, nulls come last."""
    coded = ids.dictionary_encode()
    place = np.empty(len(coded.dictionary) + 1, np.int64)
    place[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(coded.dictionary))
    place[-1] = len(coded.dictionary)
    return place[coded.indices.fill_null(len(coded.dictionary)).to_numpy()]


class Chunk:
    """Words of some texts in a row, and their windows with the hash of each one's anchor."""

    def __init__(self, texts: list[bytes | None], window: int, short: int):
        self.window, self.width = window, window - short + 1
        sizes = np.array([len(t) + 1 if t else 1 for t in texts], np.int64)
        buf = np.frombuffer(b"\n".join(t or b"" for t in texts) + b"\n", np.uint8)
        word = ~_IS_SPACE[buf]
        after = np.concatenate([[False], word[:-1]])
        self.counts = np.add.reduceat((word & ~after).astype(np.int64), np.cumsum(sizes) - sizes) if len(sizes) else sizes
        kept = word | after
        data, word = buf[kept], word[kept]
        data[~word] = 32
        self.data, self.ends = data, np.nonzero(~word)[0] + 1
        coded = _coded(data, self.ends)
        self.codes = coded.indices.to_numpy()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
        self.hashes = hashes[self.codes] if len(self.codes) else np.zeros(0, np.uint64)
        full = np.maximum(self.counts - window + 1, 0)
        self.rows = np.repeat(np.arange(len(texts)), full)
        self.start = np.arange(len(self.rows)) - np.repeat(np.cumsum(full) - full, full)
        self.at = self.start + np.repeat(np.cumsum(self.counts) - self.counts, full)
        self.grams = _labels(self.hashes, short) if len(self.at) else np.zeros(0, np.uint64)
        self.anchors = _sliding(self.grams, self.width, np.minimum)[self.at] if len(self.at) else self.grams

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash and row of every anchor, and a hash of the words from it on. It is the greatest least of windows around it."""
        if not len(self.at):
            return self.grams, np.empty(0, np.int64), self.grams
        around = np.zeros(len(self.grams) + self.width - 1, np.uint64)
        around[self.at + self.width - 1] = self.anchors
        picked = np.nonzero(_sliding(around, self.width, np.maximum) == self.grams)[0]
        after = _labels(self.hashes, self.window)
        return self.grams[picked], np.repeat(np.arange(len(self.counts)), self.counts)[picked], after[np.minimum(picked, len(after) - 1)]

    def path_keys(self, chosen: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the first ``size`` words of the chosen windows' paths: from the anchor to the end, then before it."""
        at, anchors = self.at[chosen], self.anchors[chosen]
        place = np.full(len(at), -1)
        for k in range(self.width):
            place = np.where((place < 0) & (self.grams[at + k] == anchors), k, place)
        before = np.maximum(0, size - (self.window - place))
        return _mixed(_labels(self.hashes, size)[at + place - before] + place.astype(np.uint64))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the windows at words ``a`` and ``b`` have equal words."""
        out = np.ones(len(a), bool)
        for k in range(self.window):
            out &= self.codes[a + k] == self.codes[b + k]
        return out

    def text(self, first: int, last: int) -> memoryview:
        return memoryview(self.data)[(self.ends[first - 1] if first else 0) : self.ends[last - 1]]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Rows and their texts' bytes, about CHUNK bytes of text at a time."""
    for batch in batches:
        at, held, texts = 0, 0, []
        for k, t in enumerate(batch.column("_text")):
            texts.append(t.as_buffer().to_pybytes() if t.is_valid else None)
            held += len(texts[-1] or b"")
            if held >= CHUNK:
                yield batch.slice(at, k + 1 - at), texts
                at, held, texts = k + 1, 0, []
        if texts:
            yield batch.slice(at), texts


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key and the places where it stands."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    used, first = np.unique(keys[order], return_index=True)
    for key, a, b in zip(used.tolist(), first, [*first[1:], len(order)], strict=True):
        yield key, order[a:b]


_ANCHORS = "_group long, _h long, _keys binary, _rows binary, _weights binary"


def _anchors(groups: int, window: int, short: int):
    """Each chunk's anchors by group with one row that has them; those that repeat in the chunk are settled for their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _chunks(batches):
            keys, rows, after = Chunk(texts, window, short).places()
            if not len(keys):
                continue
            h = batch.column("_h").to_numpy()
            order = np.lexsort((after, keys))
            keys, rows, after = keys[order], rows[order], after[order]
            fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
            first = np.nonzero(fresh)[0]
            count = np.diff(first, append=len(keys))
            # how many different stretches of text follow the anchor; below zero if it repeats in the chunk
            different = np.add.reduceat((fresh | np.concatenate([[True], after[1:] != after[:-1]])).astype(np.int32), first)
            weights = np.where(count > 1, -different, different).astype(np.int32)
            out: list[tuple] = []
            twice = np.nonzero(np.repeat(count, count) > 1)[0]
            for r, part in _split(rows[twice]):
                out.append((int(h[r]) % groups, int(h[r]), np.unique(keys[twice[part]]).tobytes(), None, None))
            for g, part in _split((keys[first] >> np.uint64(20)) % np.uint64(groups)):
                out.append((g, None, keys[first[part]].tobytes(), h[rows[first[part]]].tobytes(), weights[part].tobytes()))
            yield _batch(out, [("_group", pa.int64()), ("_h", pa.int64()), ("_keys", pa.binary()), ("_rows", pa.binary()), ("_weights", pa.binary())])

    return run


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


_REPEATED = "_h long, _keys binary, _n long"


def _repeated(hot: int):
    """From anchors sorted by group: the repeated ones by row; of each group, their leaves and its hot anchors.

    Only distinct anchors of one group are held. A row without ``_keys`` counts: of a hot anchor (``_h``), or of the
    whole group (no ``_h``).
    """
    fields = [("_h", pa.int64()), ("_keys", pa.binary()), ("_n", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, first, count, alone = None, {}, {}, 0

        def counted() -> list[tuple]:
            signed = lambda k: k - (1 << 64) if k >> 63 else k
            hots = [(signed(k), None, n) for k, n in count.items() if n > hot]
            return [*hots, (None, None, sum(count.values()) + alone)]

        for batch in batches:
            out: list[tuple] = []
            for g, own, keys, rows, weights in zip(*(batch.column(n).to_pylist() for n in ("_group", "_h", "_keys", "_rows", "_weights")), strict=True):
                if g != group:
                    out += counted()
                    group, first, count, alone = g, {}, {}, 0
                if rows is None:
                    out.append((own, keys, None))
                    continue
                found: dict[int, list[int]] = {}
                given = (np.frombuffer(x, t).tolist() for x, t in ((keys, np.uint64), (rows, np.int64), (weights, np.int32)))
                for k, h, w in zip(*given, strict=True):
                    if k in count:
                        count[k] += abs(w)
                        found.setdefault(h, []).append(k)
                    elif k in first:
                        before, n = first.pop(k)
                        count[k] = abs(n) + abs(w)
                        alone += min(0, n)
                        found.setdefault(h, []).append(k)
                        found.setdefault(before, []).append(k)
                    else:
                        first[k] = h, w
                        alone -= min(0, w)
                out += [(h, np.array(ks, np.uint64).tobytes(), None) for h, ks in found.items()]
            yield _batch(out, fields)
        yield _batch(counted(), fields)

    return run


class _Deep:
    """The windows of a chunk whose anchor is marked for their row, or is ``among`` these: settled by the chunk, and open."""

    def __init__(self, batch: pa.RecordBatch, texts: list[bytes | None], window: int, short: int, among: np.ndarray | None = None):
        self.chunk = c = Chunk(texts, window, short)
        self.h = batch.column("_h").to_numpy()
        ranks = _ranks(batch.column("_id"))
        if among is None:
            marks = [np.frombuffer(b"".join(m), np.uint64) for m in batch.column("_marks").to_pylist()]
            owner = lambda rows: _mixed(rows.astype(np.uint64) + np.uint64(1))
            known = np.concatenate([m ^ owner(np.full(len(m), r)) for r, m in enumerate(marks)])
            wanted = np.nonzero(np.isin(c.anchors ^ owner(c.rows), known))[0]
        else:
            wanted = np.nonzero(np.isin(c.anchors, among))[0]
        rank, start, rows = ranks[c.rows[wanted]], c.start[wanted], c.rows[wanted]
        self.labels = _labels(c.hashes, window)[c.at[wanted]] if len(wanted) else c.grams[:0]
        order = np.lexsort((start, rank, self.labels))
        wanted, rank, start, rows, labels = wanted[order], rank[order], start[order], rows[order], self.labels[order]
        first = np.concatenate([[True], labels[1:] != labels[:-1]])[: len(labels)]
        node = np.nonzero(first)[0][np.cumsum(first) - 1] if len(labels) else np.zeros(0, np.int64)
        equal = c.same(c.at[wanted], c.at[wanted[node]]) & ~first
        apart = (rank != rank[node]) | (start != start[node])
        again = equal & ~apart & (self.h[rows] == self.h[rows[node]])
        self.settled, self.open = np.sort(wanted[equal & apart]), np.sort(wanted[~(equal & apart) & ~again])


def _under(deep: _Deep, hots: list[np.ndarray], upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Open windows whose prefixes of all lengths before ``upto`` are hot, and their keys by the length there."""
    c, chosen = deep.chunk, deep.open
    chosen = chosen[np.isin(c.anchors[chosen], hots[0])]
    for size, hot in zip(PREFIXES[: upto - 1], hots[1:upto], strict=True):
        chosen = chosen[np.isin(c.path_keys(chosen, size), hot)]
    return chosen, c.path_keys(chosen, PREFIXES[upto - 1]) if upto <= len(PREFIXES) else c.anchors[chosen]


def _counts(window: int, short: int, hots: list[np.ndarray]):
    """How many open windows of each chunk lie under each prefix that is one length longer than the last hot ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _chunks(batches):
            keys, n = np.unique(_under(_Deep(batch, texts, window, short, hots[0]), hots, len(hots))[1], return_counts=True)
            yield pa.RecordBatch.from_pydict({"_key": pa.array(keys.view(np.int64)), "_n": pa.array(n.astype(np.int64))})

    return run


def _packed_leaves(id_type: pa.DataType) -> list[tuple[str, pa.DataType]]:
    return [("_group", pa.int64()), ("_ids", pa.list_(id_type)), ("_hs", pa.binary()), ("_starts", pa.binary()), ("_counts", pa.binary()), ("_words", pa.binary()), ("_late", pa.list_(pa.list_(pa.int32())))]


def _leaves(groups: int, window: int, short: int, hots: list[np.ndarray]):
    """Open windows by group, as stretches of words; settled ones have no words. Windows that are whole prefixes stay out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _chunks(batches):
            deep = _Deep(batch, texts, window, short)
            c, chosen, ids = deep.chunk, deep.open, batch.column("_id")
            keys, whole = c.anchors[chosen], np.zeros(len(chosen), bool)
            for upto in range(1, len(hots) + 1):
                under, longer = _under(deep, hots, upto)
                place = np.searchsorted(chosen, under)
                keys[place] = longer
                whole[place] = upto > len(PREFIXES)
            chosen, keys = chosen[~whole], keys[~whole]
            group = ((keys >> np.uint64(20)) % np.uint64(groups)).astype(np.int64)
            rows, start = c.rows[chosen], c.start[chosen]
            fresh = np.concatenate([[True], (rows[1:] != rows[:-1]) | (start[1:] != start[:-1] + 1) | (group[1:] != group[:-1])])[: len(chosen)]
            a = np.nonzero(fresh)[0]
            b = np.append(a[1:], len(chosen))
            first, counts = c.at[chosen[a]] if len(a) else a, (b - a + window - 1).astype(np.int32)
            out = []
            for g, part in _split(group[a]):
                words = b"".join([c.text(first[k], first[k] + counts[k]) for k in part])
                out.append((g, ids.take(pa.array(rows[a[part]])).to_pylist(), deep.h[rows[a[part]]].tobytes(), start[a[part]].astype(np.int32).tobytes(), counts[part].tobytes(), words, None))
            by_row: dict[int, list[tuple]] = {}
            for r, part in _split(c.rows[deep.settled]):
                by_row.setdefault(int(deep.h[r]) % groups, []).append((ids[r].as_py(), int(deep.h[r]), c.start[deep.settled[part]].tolist()))
            for g, found in by_row.items():
                own, h, starts = zip(*found, strict=True)
                out.append((g, list(own), np.array(h, np.int64).tobytes(), None, None, None, list(starts)))
            yield _batch(out, _packed_leaves(ids.type))

    return run


def _whole_windows(window: int, short: int, hots: list[np.ndarray]):
    """Leaves of the prefixes that are whole windows: where they stand, and the words unless the chunk settles them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _chunks(batches):
            deep = _Deep(batch, texts, window, short, hots[0])
            c, chosen = deep.chunk, _under(deep, hots, len(PREFIXES) + 1)[0]
            words = [bytes(c.text(a, a + window)) for a in c.at[chosen].tolist()] + [None] * len(deep.settled)
            chosen = np.concatenate([chosen, deep.settled])
            yield pa.RecordBatch.from_pydict({
                "_window": pa.array(words, pa.binary()), "_id": batch.column("_id").take(pa.array(c.rows[chosen], pa.int64())),
                "_h": pa.array(deep.h[c.rows[chosen]], pa.int64()), "_start": pa.array(c.start[chosen].astype(np.int32)),
            })

    return run


def suffix_names(codes: np.ndarray, depth: int) -> np.ndarray:
    """By prefix doubling, for every place the rank of its first ``depth`` codes among all: equal ranks, equal codes.

    Sorting by these ranks gives the suffix array to that depth; runs of equal ones are the tree's nodes there.
    """
    run, length, out, done = codes.astype(np.int64), 1, None, 0
    while True:
        if depth & length:
            out = run if out is None else _paired(out, run[done:])
            done += length
        if length * 2 > depth:
            return out
        run, length = _paired(run, run[length:]), length * 2


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = min(len(a), len(b))
    if not n:
        return a[:0]
    return np.unique(a[:n] * (int(b.max()) + 1) + b[:n], return_inverse=True)[1]


def _subtree(window: int, id_type: pa.DataType):
    """Builds a group's tree to the depth of a window and returns, by row, the leaves that are not first of their node."""

    def run(table: pa.Table) -> pa.Table:
        done, still = table.filter(pc.is_null(table["_words"])), table.filter(pc.is_valid(table["_words"]))
        joined = lambda t, name, kind: np.frombuffer(b"".join(t[name].to_pylist()), kind)
        data = np.frombuffer(b"".join(still["_words"].to_pylist()), np.uint8)
        counts, h = joined(still, "_counts", np.int32).astype(np.int64), joined(still, "_hs", np.int64)
        ids, start = _flat(still, "_ids", id_type), joined(still, "_starts", np.int32).astype(np.int64)
        full = counts - window + 1
        rows = np.repeat(np.arange(len(counts)), full)
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(full) - full, full)
        late_rows, late_starts = rows[:0], offset[:0]
        if len(rows):
            coded = _coded(data, np.nonzero(data == 32)[0] + 1)
            order = pc.sort_indices(coded.dictionary).to_numpy()
            rank_of = np.empty(len(order), np.int64)
            rank_of[order] = np.arange(len(order))
            names = suffix_names(rank_of[coded.indices.to_numpy()], window)
            names = names[offset + np.repeat(np.cumsum(counts) - counts, full)]
            rank, starts = _ranks(ids)[rows], start[rows] + offset
            order = np.lexsort((starts, rank, names))
            names, rank, starts, rows = names[order], rank[order], starts[order], rows[order]
            first = np.concatenate([[True], names[1:] != names[:-1]])
            node = np.nonzero(first)[0][np.cumsum(first) - 1]
            late = (rank != rank[node]) | (starts != starts[node])
            late_rows, late_starts = rows[late], starts[late]
        out_ids, out_h, out = _flat(done, "_ids", id_type), joined(done, "_hs", np.int64), [s for x in done["_late"].to_pylist() for s in x]
        _, one, inverse = np.unique(h, return_index=True, return_inverse=True)
        # stretches of one row have one h; rows of other ids with that hash are told apart by their rank
        key = inverse[late_rows] * (len(counts) + 1) + _ranks(ids)[late_rows] if len(late_rows) else late_rows
        picks = []
        for _, part in _split(key):
            picks.append(late_rows[part[0]])
            out.append(late_starts[part].tolist())
        picks = np.array(picks, np.int64)
        return pa.table({
            "_id": pa.concat_arrays([out_ids, ids.take(pa.array(picks))]), "_h": pa.array(np.concatenate([out_h, h[picks]]), pa.int64()),
            "_found": pa.array(out, pa.list_(pa.int32())),
        })

    return run


def _flat(table: pa.Table, name: str, kind: pa.DataType) -> pa.Array:
    parts = [c.flatten() for c in table[name].chunks]
    return pa.concat_arrays([pa.array([], kind), *parts])


def _over(total: int, size: int) -> int:
    return max(1, -(-int(total or 0) // max(1, size)))


def repeat_starts(keyed: DataFrame, window: int = 20, short: int = 6, group_words: int = GROUP_WORDS, group_anchors: int = GROUP_ANCHORS) -> DataFrame:
    """(``_id``, ``_h``, ``_found``) from rows (``_id``, ``_h``, ``_text``): starts of windows that also start earlier, in parts."""
    id_type, arrow_id = keyed.schema["_id"].dataType.simpleString(), _arrow_type(keyed)
    texts = keyed.select("_id", "_h", "_text")
    size = texts.agg(F.sum(F.octet_length("_text"))).first()[0]
    # one word in eight is an anchor, at six bytes a word
    size = size or 0
    groups = _over(size // 48, group_anchors)
    leaf_words = 2 * window - short
    hot = group_words // (4 * leaf_words)
    tasks = min(groups, max(keyed.sparkSession.sparkContext.defaultParallelism, _over(size, 64 << 20)))
    anchors = texts.mapInArrow(_anchors(groups, window, short), _ANCHORS).repartition(tasks, "_group").sortWithinPartitions("_group")
    repeated = stored(anchors.mapInArrow(_repeated(hot), _REPEATED))
    total = repeated.where("_keys is null and _h is null").agg(F.sum("_n")).first()[0]
    groups = _over(2 * leaf_words * (total or 0), group_words)
    marks = repeated.where("_keys is not null").groupBy("_h").agg(F.collect_list("_keys").alias("_marks"))
    marked = keyed.join(marks.withColumnRenamed("_h", "_of"), F.col("_h") == F.col("_of"), "inner").select("_id", "_h", "_text", "_marks")

    first = repeated.where("_keys is null and _h is not null").select(F.col("_h").alias("_key"))
    hots = _hot_keys(first)
    # what lies under hot prefixes is read from the texts where they are: their list goes to them, and nothing is shuffled
    while hots and len(hots) <= len(PREFIXES):
        counted = texts.mapInArrow(_counts(window, short, hots), "_key long, _n long")
        longer = _hot_keys(counted.groupBy("_key").agg(F.sum("_n").alias("_n")).where(F.col("_n") * window * 4 > group_words).select("_key"))
        if not longer:
            hots.append(np.zeros(0, np.uint64))
            break
        hots += longer
    schema = f"_group long, _ids array<{id_type}>, _hs binary, _starts binary, _counts binary, _words binary, _late array<array<int>>"
    leaves = marked.mapInArrow(_leaves(groups, window, short, hots), schema)
    found = leaves.groupBy("_group").applyInArrow(_subtree(window, arrow_id), f"_id {id_type}, _h long, _found array<int>")
    if len(hots) > len(PREFIXES):
        found = found.unionByName(_of_whole_windows(texts.mapInArrow(_whole_windows(window, short, hots), f"_window binary, _id {id_type}, _h long, _start int")))
    return found


def _hot_keys(keys: DataFrame) -> list[np.ndarray]:
    """The keys as one sorted array, or none. There are at most as many as repeats over the hot size."""
    found = np.array([r[0] for r in keys.collect()], np.int64).view(np.uint64)
    return [np.sort(found)] if len(found) else []


def _of_whole_windows(leaves: DataFrame) -> DataFrame:
    leaves = stored(leaves)
    order = F.struct(F.col("_id").isNull(), "_id", "_start")
    still = leaves.where("_window is not null")
    least = stored(still.groupBy("_window").agg(F.min(order).alias("_least")))
    late = join_small(still, least, "_window").where(order > F.col("_least")).select("_id", "_h", "_start")
    late = late.unionByName(leaves.where("_window is null").select("_id", "_h", "_start"))
    return late.groupBy("_id", "_h").agg(F.collect_list("_start").alias("_found"))


def _arrow_type(keyed: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(keyed.schema["_id"].dataType)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` as ``_id``, ``_text``, the row's hash ``_h`` and its other columns renamed."""
    h = F.xxhash64(F.col(id_col), F.col(text_col)).alias("_h")
    others = [prefixed(c) for c in docs.columns if c not in (id_col, text_col)]
    return docs.select(F.col(id_col).alias("_id"), h, F.col(text_col).alias("_text"), *others)


def _covered(n_words: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Mask of the words covered by windows at the starts."""
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, window: int = 20, short: int = 6, id_col: str = "doc_id", text_col: str = "text", added: tuple[str, str, str] = ("n_words", "n_removed", "kept_sha256"), **limits: int) -> DataFrame:
    """``docs`` with later occurrences of repeated windows cut; the ``added`` columns (replaced if they stand) come last.

    The text's kept words are joined by one space; a text that loses nothing keeps its own spacing.
    """
    keyed = _keyed(docs.drop(*added), id_col, text_col)
    found = repeat_starts(keyed, window, short, **limits).groupBy("_h").agg(F.collect_list(F.struct("_id", "_found")).alias("_parts"))
    # both joins deal the same rows by the same key, so the texts are shuffled once and the exchange is used again
    joined = keyed.join(found.withColumnRenamed("_h", "_of"), F.col("_h") == F.col("_of"), "left").drop("_of")
    own = F.filter("_parts", lambda x: x["_id"].eqNullSafe(F.col("_id")))
    joined = joined.withColumn("_parts", F.flatten(F.transform(own, lambda x: x["_found"])))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed, kept = [], [], [], []
            for text, starts in zip(batch.column("_text"), batch.column("_parts"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = left = raw.split()
                if starts.is_valid and len(starts):
                    gone = _covered(len(words), starts.values.to_numpy().astype(np.int64), window)
                    left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
                texts.append(text.as_py() if len(left) == len(words) else b" ".join(left).decode())
            cols = {n: batch.column(n) for n in batch.schema.names if n not in ("_parts", "_h")}
            cols |= {"_text": pa.array(texts, pa.string()), "_n_words": pa.array(n_words, pa.int64())}
            cols |= {"_n_removed": pa.array(n_removed, pa.int64()), "_kept": pa.array(kept, pa.string())}
            yield pa.RecordBatch.from_pydict(cols)

    schema = joined.drop("_parts", "_h").schema.add("_n_words", "long").add("_n_removed", "long").add("_kept", "string")
    out = joined.mapInArrow(cut, schema)
    back = {id_col: F.col("_id"), text_col: F.col("_text")}
    kept_columns: list[Column] = [(back[c] if c in back else F.col(working(c))).alias(c) for c in docs.columns if c not in added]
    return out.select(*kept_columns, *[F.col(c).alias(n) for c, n in zip(("_n_words", "_n_removed", "_kept"), added, strict=True)])


def digest(docs: DataFrame) -> DataFrame:
    """The registered query's columns, one row per document."""
    return remove_repeats(docs.select("doc_id", "text")).drop("text")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
wins AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS k, unnest(list_transform(range(1, len(w) - 18), lambda k: md5(array_to_string(w[k:k + 19], ' ')))) AS g
  FROM d WHERE len(w) >= 20),
later AS (SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, k) AS r FROM wins) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 20)) AS pos FROM later),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM words LEFT JOIN gone USING (doc_id, pos) WHERE gone.pos IS NULL GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
