"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has one bit per hash bit: set where over half the shingle hashes have it set. Texts whose
fingerprints differ in at most ``radius`` bits are linked, and links make components.

Candidates come from covering masks (Pagh, 2016): every bit position gets a non-zero vector of F2^(radius+1);
each non-zero vector v yields the mask of positions whose vector has an odd product with v. Any ``radius``
differing positions are orthogonal to some v, so such a pair agrees under that mask: no pair is missed.

Scale: exact copies collapse into one fingerprint first, with map-side combine. Inside a bucket, up to
``small_bucket`` fingerprints are compared directly; a larger bucket is linked through one-bit variants of its
free bits, of which two fingerprints share one exactly when they are at most two bits apart, so the work stays
linear and no bucket is gathered in a task. Both ways are exact.

Defined cases: null, empty and word-less texts have fingerprint zero and link like any other; texts with fewer
words than a shingle hash their whole word sequence; repeated rows give repeated rows out; a null doc_id keeps
its row and takes the component of its class, null if nobody in it has an id; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import column, connected_components, join_small, prefixed, stored, working

BITS = 64


def shingles(text: bytes | None, size: int) -> list[bytes]:
    """Runs of ``size`` words joined by a space, repeats included; the whole sequence of fewer words."""
    words = text.lower().split() if text else []
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)))


def fingerprint(text: bytes | None, size: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text."""
    grams = shingles(text, size)
    if not grams:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, seed) for g in grams), np.uint64, len(grams))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += block.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, size: int = 3, seed: int = 42, text_col: str = "text", added: str = "_fp") -> DataFrame:
    """``docs`` with ``added`` (the fingerprint as a signed long) in place of its text."""
    kept = [c for c in docs.columns if c not in (text_col, added)]
    renamed = docs.select(column(text_col).alias("_text"), *[prefixed(c) for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            found = (fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None, size, seed) for t in texts)
            fps = np.fromiter(found, np.uint64, len(texts)).view(np.int64)
            cols = {n: batch.column(n) for n in batch.schema.names if n != "_text"}
            yield pa.RecordBatch.from_pydict(cols | {"_fp": pa.array(fps, pa.int64())})

    out = renamed.mapInArrow(run, renamed.drop("_text").schema.add("_fp", "long"))
    return out.select(*[F.col(working(c)).alias(c) for c in kept], F.col("_fp").alias(added))


def covering_masks(radius: int = 2) -> list[int]:
    """Signed masks of which any two words at most ``radius`` bits apart agree under at least one."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(BITS)]
    masks = [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_links(fps: DataFrame, radius: int = 2, small_bucket: int = 64) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct ``_fp`` at most ``radius`` bits apart."""
    if radius != 2:
        raise ValueError("large buckets are linked through one-bit variants, which need a radius of two")
    masks = covering_masks(radius)
    keyed = fps.select(
        "_fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(m).alias("mask")) for t, m in enumerate(masks)])).alias("m")
    ).select("_fp", "m.t", "m.mask", F.col("_fp").bitwiseAND(F.col("m.mask")).alias("key"))
    sizes = stored(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1"))
    buckets = stored(keyed.join(sizes, ["t", "key"]))

    small = buckets.where(F.col("n") <= small_bucket).groupBy("t", "key").agg(F.sort_array(F.collect_list("_fp")).alias("all"))
    pairs = small.select("all", F.posexplode("all").alias("i", "a"))
    pairs = pairs.select("a", F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b"))
    pairs = pairs.where(_apart(F.col("a"), F.col("b")) <= radius)

    bits = [1 << i if i < BITS - 1 else -(1 << (BITS - 1)) for i in range(BITS)]
    flips = F.filter(F.array(*[F.lit(b) for b in bits]), lambda b: b.bitwiseAND(F.col("mask")) == 0)
    large = buckets.where(F.col("n") > small_bucket).withColumn("flip", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)))
    large = large.select("t", "_fp", F.col("_fp").bitwiseXOR(F.col("flip")).alias("variant"))
    # at most 1 + 64 fingerprints lie within one bit of a variant, so these groups are bounded
    large = large.groupBy("t", "variant").agg(F.collect_set("_fp").alias("all")).where(F.size("all") > 1)
    stars = large.select(F.array_min("all").alias("b"), F.explode("all").alias("a")).where("a <> b").select("a", "b")
    return pairs.union(stars).distinct()


def near_components(marked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(``_fp``, ``_component``) for every distinct fingerprint: the least id reachable from it."""
    reps = stored(marked.groupBy("_fp").agg(F.min(id_col).alias("_least")))
    roots = connected_components(near_links(reps.select("_fp")))
    rooted = reps.join(roots, reps["_fp"] == roots["node"], "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    rooted = stored(rooted)
    least = stored(rooted.groupBy("_root").agg(F.min("_least").alias("_component")))
    # one root may have a third of all fingerprints
    return stored(join_small(rooted, least, "_root").select("_fp", "_component"))


def simhash_components(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    A fingerprint may stand on a third of all rows, so rows find their class by a broadcast or salted join.
    """
    marked = stored(with_fingerprints(docs.select("doc_id", "text"), size, seed))
    classes = near_components(marked)
    return join_small(marked, classes, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, size: int = 3, seed: int = 42) -> DataFrame:
    """One row of each component: of those with its least doc_id, the one with the least fingerprint and text hash.

    The survivor is chosen by ids, fingerprints and hashes alone; texts are not shuffled. Rows that are equal in all of these
    are copies, and one of them stays. Texts without words are no copies of each other's content: they are kept as they
    are, and so are rows without an id.
    """
    key = F.struct("doc_id", "_fp", "_h")
    marked = docs.select("doc_id", "text", F.xxhash64("text", "doc_id").alias("_h"))
    marked = stored(with_fingerprints(marked.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]")), size, seed))
    classes = near_components(marked)
    joined = join_small(marked, classes, "_fp")
    least = joined.groupBy("_component").agg(F.min(key).alias("_least"))
    kept = stored(least.select(F.col("_least.doc_id").alias("_kept_id"), F.col("_least._h").alias("_kept_h")))
    own = docs.select(*[prefixed(c) for c in docs.columns], F.xxhash64("text", "doc_id").alias("_h"))
    worded = F.coalesce(F.col("_in_text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]") & F.col("_in_doc__id").isNotNull()
    once = own.where(worded).join(kept, (F.col("_in_doc__id") == F.col("_kept_id")) & (F.col("_h") == F.col("_kept_h")), "left_semi").dropDuplicates(["_in_doc__id", "_h"])
    return once.unionByName(own.where(~worded)).select(*[F.col(working(c)).alias(c) for c in docs.columns])
