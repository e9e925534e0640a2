"""Near copies by SimHash: candidates from covering masks, then exact Jaccard similarity of word shingles and components.

Two texts are linked if their sets of distinct shingles (``SIZE`` words, ASCII letters folded) have a similarity of
``SIMILARITY`` or more; links make components. Shingles stand as 64-bit hashes, and equal sets collapse into one class
before anything else, so exact copies cost one row each.

A set's fingerprint is a 64-bit SimHash of the whole set, then ``PARTS`` parts of three words; a word is the 64-bit SimHash
of a slice, the shingles that the slice's own hash samples. Covering masks give the keys: those of radius two over the
bits of the whole (as in ``simhash``), and in each part those of radius one over its words, so that a part agrees under
some mask if one word at most differs, by however many bits. Found for certain, by pigeonhole: pairs whose wholes
differ in two bits or less, or whose parts differ in fewer than two words on average (but for sparse keys, below).
The whole alone does not reach ``SIMILARITY``: at 0.8 about 15 % of its bits differ, 10 of 64, and masks of radius two
find one such pair in five hundred. A slice's word is equal if the few shingles sampled are shared.

The sampling rate is a power of a half and leaves ``SAMPLED`` to twice as many shingles in a slice; a set also has the keys
of the next rate if a set it can be linked to has that. Keys of fewer than two sampled shingles are left out, being no sign
of likeness. A pair at similarity 0.8 is then missed with a chance of 1e-7 at most, and less above it. Sets of up to
three shingles have no links. Every candidate is verified on the whole sets.

Scale: a bucket's classes are first compared with one of them, its pivot, which is linear. Buckets of over
``SMALL_BUCKET`` classes in several components take further rounds with other pivots. What is still in different
components of a bucket is then compared in pairs, by parity sketches inside the join: the bits in which two sketches
differ never outnumber the shingles in which the sets differ, so the sketch drops no link and few other pairs leave the
join. Its comparisons grow with the square of such a bucket, its rows do not. No bucket is gathered in a task.
Of the texts only those that share a bucket, and then those that are dropped or repeated, are shuffled: a bitmap of
hashed keys, at most ``WORDS`` longs, tells the others apart where they are read. A full bitmap lets more texts through
to the exact join that follows it, and changes no result.

Defined cases: null, empty and word-less texts and rows with a null doc_id are kept as they are and link nothing; texts
with fewer words than a shingle count as one shingle; rows that share an id are told apart by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import connected_components, stored
from textloom.llm.simhash import covering_masks

SIZE, SIMILARITY = 5, 0.8
_PERCENT = round(100 * SIMILARITY)  # similarities are compared in whole numbers
PARTS, WORDS_A_PART, SAMPLED = 24, 3, 1.5
SMALL_BUCKET, PIVOT_ROUNDS = 64, 2
SKETCH = 16  # longs
WORDS = 1 << 19  # bounds the broadcast bitmap
_BLOCK = 512
_rng = np.random.default_rng(42)
_SLICES = PARTS * WORDS_A_PART
_FLIPS = _rng.integers(0, 1 << 64, _SLICES, np.uint64)
_FACTORS = _rng.integers(0, 1 << 64, _SLICES, np.uint64) | np.uint64(1)
_PLACES = _rng.integers(0, 1 << 64, max(64, _SLICES), np.uint64) | np.uint64(1)
_WHOLE_MASKS = np.array(covering_masks(2), np.int64).view(np.uint64)
#: The words of a part that each covering mask of radius one keeps: the masks' first positions have all its vectors.
_PART_MASKS = [[k for k in range(WORDS_A_PART) if m >> k & 1] for m in covering_masks(1)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text; one of the whole sequence if it has fewer words."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total += _mixed(hashes[k : len(words) - width + 1 + k] * _PLACES[k])
    return np.unique(_mixed(total))


def _votes(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The SimHash of each run of ``hashes``: bits set in over half of them."""
    ones = np.zeros((len(starts), 64), np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        first = max(0, int(np.searchsorted(starts, at, "right")) - 1)
        last = int(np.searchsorted(starts, at + len(block)))
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[first:last] += np.add.reduceat(bits, np.maximum(starts[first:last] - at, 0), axis=0, dtype=np.int64)
    counts = np.diff(np.append(starts, len(hashes)))
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def whole_fingerprint(shingles: np.ndarray) -> np.uint64:
    """The SimHash of a non-empty set."""
    return _votes(shingles, np.zeros(1, np.int64))[0]


def levels(n: int) -> list[int]:
    """The rates, as powers of a half, at which a set of ``n`` shingles meets sets of its size to the largest alike."""
    return sorted({max(0, int(np.log2(k / SAMPLED))) for k in (n, 100 * n // _PERCENT)})


def part_words(shingles: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """By part and word: the SimHash of the slice (0 if empty), and the number of its shingles."""
    limit = np.uint64(((1 << 64) - 1) >> level)
    rows, slices = [], []
    for at in range(0, len(shingles), _BLOCK):
        row, k = np.nonzero((shingles[at : at + _BLOCK, None] ^ _FLIPS) * _FACTORS <= limit)
        rows.append(row + at)
        slices.append(k)
    rows, slices = np.concatenate(rows), np.concatenate(slices)
    order = np.argsort(slices, kind="stable")
    counts = np.bincount(slices, minlength=_SLICES)
    some = counts > 0
    words = np.zeros(_SLICES, np.uint64)
    if len(rows):
        words[some] = _votes(shingles[rows[order]], (np.cumsum(counts) - counts)[some])
    return words.reshape(PARTS, WORDS_A_PART), counts.reshape(PARTS, WORDS_A_PART)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """The fingerprint of a non-empty set under the covering masks: a key by mask of the whole, and by rate, mask and part.

    A key of fewer than two sampled shingles is 0 and stands for none.
    """
    if len(shingles) <= 3:
        return np.zeros(0, np.int64)
    masks = np.arange(len(_WHOLE_MASKS), dtype=np.uint64)
    keys = [_mixed((whole_fingerprint(shingles) & _WHOLE_MASKS) * _PLACES[: len(masks)] + masks)]
    for level in levels(len(shingles)):
        words, counts = part_words(shingles, level)
        placed = _mixed(words * _PLACES[:_SLICES].reshape(PARTS, WORDS_A_PART))
        for m, kept in enumerate(_PART_MASKS):
            table = (np.arange(PARTS, dtype=np.uint64) * np.uint64(len(_PART_MASKS)) + np.uint64(m + 1)) * np.uint64(64) + np.uint64(level)
            found = _mixed(placed[:, kept].sum(axis=1, dtype=np.uint64) + _mixed(table))
            keys.append(np.where(counts[:, kept].sum(axis=1) > 1, found, np.uint64(0)))
    return np.concatenate(keys).view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of how many shingles fall on each of the sketch's bits."""
    odd = np.bincount((shingles >> np.uint64(7)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _marks(shingles: np.ndarray) -> np.ndarray:
    keys = band_keys(shingles)
    return np.concatenate([sketch(shingles), keys[keys != 0]])


def _class_of(shingles: np.ndarray) -> int:
    at = xxhash.xxh64_intdigest(shingles.tobytes())
    return at - (1 << 64) if at >> 63 else at


def _mapped(docs: DataFrame, text_col: str, make, schema: str) -> DataFrame:
    """A row of ``schema`` for each text with words: its other columns, ``_set``, then what ``make`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, sets, made = batch.column(text_col), [], [], []
            for k, t in enumerate(texts):
                found = shingle_set(t.as_buffer().to_pybytes() if t.is_valid else None)
                if len(found):
                    rows.append(k)
                    sets.append(_class_of(found))
                    made.append(make(found))
            own = batch.select([n for n in batch.schema.names if n != text_col]).take(pa.array(rows, pa.int64()))
            counts = pa.array([n for n, _ in made], pa.int64())
            offsets = pa.array(np.cumsum([0, *(len(x) for _, x in made)]), pa.int32())
            values = pa.array(np.concatenate([x for _, x in made]) if made else np.zeros(0, np.int64), pa.int64())
            cols = {n: own.column(n) for n in own.schema.names}
            yield pa.RecordBatch.from_pydict(cols | {"_set": pa.array(sets, pa.int64()), "_n": counts, "_values": pa.ListArray.from_arrays(offsets, values)})

    return docs.mapInArrow(run, schema)


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose sets are alike enough."""
    left = sets.select(F.col("_set").alias("a"), F.col("_n").alias("_na"), F.col("_values").alias("_va"))
    right = sets.select(F.col("_set").alias("b"), F.col("_n").alias("_nb"), F.col("_values").alias("_vb"))
    both = pairs.distinct().join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_va", "_vb"))
    union = F.col("_na") + F.col("_nb") - shared
    return stored(both.where(100 * shared >= _PERCENT * union).select("a", "b"))


def _sizes_fit(a: str, b: str):
    return 100 * F.least(a, b) >= _PERCENT * F.greatest(a, b)


def links(members: DataFrame, sets: DataFrame, sketches: DataFrame, small_bucket: int = SMALL_BUCKET, pivot_rounds: int = PIVOT_ROUNDS) -> DataFrame:
    """Edges (a, b) whose components are those of all alike classes that share a bucket.

    ``members``: (_set, _n, key, n), n being the classes of the bucket; ``sets``: (_set, _n, _values);
    ``sketches``: (_set, _sketch).
    """
    edges, open_ = None, members.withColumn("root", F.col("_set"))
    for k in range(pivot_rounds):
        order = F.xxhash64("_set", "key", F.lit(k))
        pivots = open_.groupBy("key").agg(F.min(F.struct(order.alias("o"), F.col("_set").alias("p"), F.col("_n").alias("_pn"), F.col("root").alias("_pr"))).alias("x"))
        pivots = pivots.select("key", "x.p", "x._pn", "x._pr")
        pairs = open_.join(pivots, "key").where((F.col("root") != F.col("_pr")) & _sizes_fit("_n", "_pn"))
        found = _verified(pairs.select(F.least("_set", "p").alias("a"), F.greatest("_set", "p").alias("b")), sets)
        edges = found if edges is None else edges.union(found)
        roots = connected_components(edges)
        # a bucket of two is settled by its pivot
        rooted = members.where("n > 2").join(roots, members["_set"] == roots["node"], "left")
        rooted = stored(rooted.select("_set", "_n", "key", "n", F.coalesce("root", "_set").alias("root")))
        several = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
        open_ = stored(rooted.join(several, "key"))
        if open_.where(F.col("n") > small_bucket).isEmpty():
            break
    open_ = stored(open_.join(sketches, "_set"))
    a = open_.select("key", F.col("_set").alias("a"), F.col("_n").alias("_na"), F.col("root").alias("_ra"), F.col("_sketch").alias("_sa"))
    b = open_.select("key", F.col("_set").alias("b"), F.col("_n").alias("_nb"), F.col("root").alias("_rb"), F.col("_sketch").alias("_sb"))
    rest = a.join(b, "key").where((F.col("a") < F.col("b")) & (F.col("_ra") != F.col("_rb")) & _sizes_fit("_na", "_nb"))
    apart = sum((F.bit_count(F.get("_sa", F.lit(i)).bitwiseXOR(F.get("_sb", F.lit(i)))) for i in range(SKETCH)), F.lit(0))
    rest = rest.where((100 + _PERCENT) * apart <= (100 - _PERCENT) * (F.col("_na") + F.col("_nb")))
    return edges.union(_verified(rest.select("a", "b"), sets))


def _sieve(rows: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose (doc_id, _h) may be among ``keys``, and those whose is not; one pass each, without a shuffle."""
    slot = F.pmod(F.xxhash64("doc_id", "_h"), F.lit(64 * WORDS))
    bits = keys.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_word"))
    bits = bits.agg(F.bit_or(F.expr("shiftleft(1L, cast(_slot & 63 as int))")).alias("_bits"))
    marked = rows.join(F.broadcast(stored(bits)), F.shiftright(slot, 6) == F.col("_word"), "left")
    hit = F.coalesce(F.getbit("_bits", slot.bitwiseAND(F.lit(63)).cast("int")) == 1, F.lit(False))
    return marked.where(hit).select(*rows.columns), marked.where(~hit).select(*rows.columns)


def drop_near_copies(docs: DataFrame, text_col: str = "text", small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """One row of each component: one with its least doc_id."""
    keyed_docs = docs.withColumn("_h", F.xxhash64(text_col))
    texts = keyed_docs.where(F.col("doc_id").isNotNull()).select("doc_id", "_h", text_col)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = f"doc_id {id_type}, _h long, _set long, _n long, _values array<long>"
    marked = stored(_mapped(texts, text_col, lambda s: (len(s), _marks(s)), made))
    least = marked.groupBy("_set").agg(F.min(F.struct("doc_id", "_h")).alias("_least"), F.first("_n").alias("_n"), F.first("_values").alias("_marks"))
    classes = stored(least)

    keyed = classes.select("_set", "_n", F.explode(F.slice("_marks", F.lit(SKETCH + 1), F.size("_marks"))).alias("key"))
    sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = stored(keyed.join(sizes, "key"))
    wanted = classes.join(members.select("_set").distinct(), "_set", "left_semi").select("_least.*")
    wanted = stored(wanted)
    some = _sieve(texts, wanted)[0].join(wanted, ["doc_id", "_h"], "left_semi")
    sets = stored(_mapped(some, text_col, lambda s: (len(s), s.view(np.int64)), made).dropDuplicates(["_set"]).select("_set", "_n", "_values"))

    sketches = classes.select("_set", F.slice("_marks", 1, SKETCH).alias("_sketch"))
    roots = connected_components(links(members, sets, sketches, small_bucket))
    rooted = classes.join(roots, classes["_set"] == roots["node"], "left")
    kept = stored(rooted.groupBy(F.coalesce("root", "_set").alias("_root")).agg(F.min("_least").alias("x")).select("x.*"))
    plain = F.col("doc_id").isNull() | ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    seen = marked.select("doc_id", "_h", F.lit(1).alias("_rows"), F.lit(0).alias("_kept"))
    seen = seen.unionByName(kept.select("doc_id", "_h", F.lit(0).alias("_rows"), F.lit(1).alias("_kept")))
    seen = seen.groupBy("doc_id", "_h").agg(F.sum("_rows").alias("_rows"), F.max("_kept").alias("_kept"))
    some, rest = _sieve(keyed_docs.where(~plain), seen.where("_rows > 1 or _kept = 0"))
    once = some.join(kept, ["doc_id", "_h"], "left_semi").dropDuplicates(["doc_id", "_h"])
    return rest.unionByName(once).unionByName(keyed_docs.where(plain)).drop("_h")
