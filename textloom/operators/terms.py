"""Terminology: n-gram term frequencies, smoothed TF-IDF, entity enrichment and top-k."""

from __future__ import annotations

import functools
import itertools
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as tx

NER_CHARS = 5000
#: Bytes of text whose terms are counted at a time, and terms that a batch holds.
CHUNK, _ROWS = 8 << 20, 1 << 16
#: Categories of characters that words consist of.
_WORD = frozenset(["Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Me", "Nd", "Nl", "Pc"])
#: Segments of the hashes, the most that a count can say, and how many of a segment's 2**21 places share a bit.
_SEGMENTS, _MOST, _FOLD = 2048, 2047, 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[pa.Table]:
    """The rows again, in tables of at most ``limit`` bytes of text; a longer text is a table of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        at = done = 0
        while at < len(ends):
            stop = int(np.searchsorted(ends, done + limit - size, "right"))
            if stop <= at and not held:
                stop = at + 1
            if stop > at:
                held.append(batch.slice(at, stop - at))
                size += int(ends[stop - 1]) - done
                at, done = stop, int(ends[stop - 1])
            if at < len(ends):
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


@functools.cache
def _kinds() -> np.ndarray:
    """By code point, in lower case: 2 for ASCII letters, 3 for other characters of words, 1 for what links words, 0 for the rest.

    Words consist of what Java's (?U)\\w is: Alphabetic, marks, decimal digits, connectors and joiners.
    """
    out = np.array([3 * (unicodedata.category(chr(k)) in _WORD) for k in range(0x110000)], np.uint8)
    for a, b in ((0x200C, 0x200D), (0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189)):
        out[a : b + 1] = 3
    out[97:123] = 2
    out[[*b"-'"]] = 1
    return out


def split_tokens(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The tokens of :func:`tx.term_tokens` of all texts in turn, and their number by text.

    Runs of word characters that are all a-z are linked over hyphens and apostrophes; other runs break.
    """
    texts = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _kinds()[points]
    word = np.zeros(len(kind) + 2, bool)
    word[1:-1] = kind >= 2
    edge = word[1:] != word[:-1]
    starts, ends = np.flatnonzero(edge & word[1:]), np.flatnonzero(edge & word[:-1])
    other, marks = np.flatnonzero(kind == 3), np.flatnonzero(kind == 1)
    good = np.ones(len(starts), bool)
    good[np.searchsorted(ends, other, "right")] = False
    near = np.flatnonzero(good[:-1] & good[1:])
    near = near[kind[ends[near]] == 1]
    near = near[np.searchsorted(marks, starts[near + 1]) - np.searchsorted(marks, ends[near]) == starts[near + 1] - ends[near]]
    linked = np.zeros(len(starts) + 1, bool)
    linked[near + 1] = True
    starts, ends = starts[good & ~linked[:-1]], ends[good & ~linked[1:]]
    inside = np.zeros(len(kind) + 1, np.int8)
    inside[starts] = 1
    inside[ends] = -1
    letters = points[np.cumsum(inside[:-1], dtype=np.int8).view(bool)].astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    tokens = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    return tokens, np.diff(np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)])))


class _Tokens:
    """The tokens of some texts, in order of the texts' keys: ``codes`` into ``words``, and each token's text and its end."""

    def __init__(self, rows: pa.Table):
        rows = rows.take(pc.sort_indices(rows.column("ord")))
        self.ords = rows.column("ord")
        found, lengths = split_tokens(rows.column("text").to_pylist())
        flat = found.dictionary_encode()
        self.words, self.codes = flat.dictionary, flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.text, self.ends = np.repeat(np.arange(len(lengths)), lengths), np.repeat(np.cumsum(lengths), lengths)

    def groups(self, max_n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """By n: the first place, the number and the number of texts of each distinct n-gram.

        An n-gram's key is made of the number of its first n - 1 words among their like, and its last word.
        """
        size, codes, before = len(self.codes), self.codes, self.codes
        bits = size.bit_length()
        for n in range(1, max_n + 1):
            at = np.flatnonzero(np.arange(n, size + n) <= self.ends)
            if not len(at):
                return
            keys = before[at] * len(self.words) + codes[at + n - 1] if n > 1 else codes[at]
            if int(keys.max()).bit_length() + bits < 64:  # key and place in one number sort faster
                keys = (keys << bits) | at
                keys.sort()
                at = keys & ((1 << bits) - 1)
                keys >>= bits
            else:
                order = np.argsort(keys, kind="stable")
                keys, at = keys[order], at[order]
            new = np.concatenate([[True], keys[1:] != keys[:-1]])
            first = np.flatnonzero(new)
            text = self.text[at]
            other = new.copy()
            other[1:] |= text[1:] != text[:-1]
            yield n, at[first], np.diff(np.append(first, len(at))), np.add.reduceat(other.astype(np.int64), first)
            before = np.zeros(size, np.int64)
            before[at] = np.cumsum(new) - 1

    def hashes(self) -> Callable[[int, np.ndarray], np.ndarray]:
        """The 64-bit hashes of the n-grams at given places, the same in every worker."""
        of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words.to_pylist()), np.uint64, len(self.words))

        def run(n: int, at: np.ndarray) -> np.ndarray:
            h = of_word[self.codes[at]]
            for k in range(1, n):
                h = (h ^ (h >> np.uint64(29))) * _ODD + of_word[self.codes[at + k]]
            h = (h ^ (h >> np.uint64(32))) * _ODD
            return h ^ (h >> np.uint64(29))

        return run

    def terms(self, n: int, at: np.ndarray) -> pa.Array:
        parts = [self.words.take(pa.array(self.codes[at + k])) for k in range(n)]
        return pc.binary_join_element_wise(*parts, " ")


def _frequent(rows: DataFrame, max_n: int, min_frequency: int, min_documents: int) -> np.ndarray:
    """Bits that are set for the hashes of all n-grams that reach both bounds, and of few others.

    Counts of n-grams meet by the upper 32 bits of their hash, so that the sum is the count or more. They travel as four bytes a
    distinct n-gram and chunk, 21 bits of the hash and 11 of the count, to 2048 segments; a segment is one array at a time.
    """
    by_text = min_documents >= min_frequency
    bound = min(max(min_frequency, min_documents), _MOST)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            tokens = _Tokens(chunk)
            hashed, found = tokens.hashes(), []
            for n, at, count, texts in tokens.groups(max_n):
                seen = np.minimum(texts if by_text else count, _MOST).astype(np.uint64)
                found.append(((hashed(n, at) >> np.uint64(32)) << np.uint64(11)) | seen)
            if found:
                every = np.sort(np.concatenate(found))
                ends = np.searchsorted(every, np.arange(_SEGMENTS + 1, dtype=np.uint64) << np.uint64(32)).astype(np.int32) * np.int32(4)
                data = every.astype(np.uint32)
                blobs = pa.Array.from_buffers(pa.binary(), _SEGMENTS, [None, pa.py_buffer(ends), pa.py_buffer(data)])
                out = pa.RecordBatch.from_pydict({"part": pa.array(np.arange(_SEGMENTS, dtype=np.int32)), "seen": blobs})
                yield out.filter(pc.greater(pc.binary_length(blobs), 0))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = ((part, blob) for b in batches for part, blob in zip(b.column("part").to_pylist(), b.column("seen"), strict=True))
        for part, own in itertools.groupby(blobs, key=lambda x: x[0]):
            place, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
            while held := list(itertools.islice(own, 1000)):
                seen = np.concatenate([np.frombuffer(blob.as_buffer(), np.uint32) for _, blob in held]).astype(np.int64)
                every = np.sort(np.concatenate([seen, (place << 11) | total]))
                at = every >> 11
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                place, total = at[first], np.minimum(np.add.reduceat(every & _MOST, first), _MOST)
            flags = np.zeros((1 << 21) // _FOLD, bool)
            flags[place[total >= bound] // _FOLD] = True
            bits = np.packbits(flags, bitorder="little")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "bits": pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())})

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = rows.mapInArrow(dealt, "part int, seen binary").repartition(parts, "part").sortWithinPartitions("part")
    out = np.zeros((_SEGMENTS, (1 << 21) // _FOLD // 8), np.uint8)
    for r in segments.mapInArrow(added, "part int, bits binary").collect():
        out[r["part"]] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out.reshape(-1)


def _by_chunk(rows: DataFrame, max_n: int, bits) -> DataFrame:
    """(term, c, df, ord, at) of the n-grams of some texts at a time, without those that ``bits``, if given, rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            tokens = _Tokens(chunk)
            hashed = tokens.hashes() if bits else None
            for n, at, count, texts in tokens.groups(max_n):
                if hashed:
                    place = hashed(n, at) >> np.uint64(32 + _FOLD.bit_length() - 1)
                    may = np.flatnonzero((bits.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
                    at, count, texts = at[may], count[may], texts[may]
                for k in range(0, len(at), _ROWS):
                    some, text = at[k : k + _ROWS], tokens.text[at[k : k + _ROWS]]
                    yield pa.RecordBatch.from_pydict({
                        "term": tokens.terms(n, some), "c": pa.array(count[k : k + _ROWS]), "df": pa.array(texts[k : k + _ROWS]),
                        "ord": tokens.ords.take(pa.array(text)).combine_chunks(), "at": pa.array((n << 40) + some - tokens.starts[text]),
                    })

    kind = T.StructType([T.StructField("term", T.StringType()), *[T.StructField(c, T.LongType()) for c in ("c", "df")], rows.schema["ord"], T.StructField("at", T.LongType())])
    return rows.mapInArrow(run, kind)


def _by_text(rows: DataFrame, max_n: int) -> DataFrame:
    """The same by text, for keys that several rows share or none has, and for keys of other types."""
    rows = rows.select("ord", tx.term_tokens(F.col("text")).alias("tokens"))
    grams = F.concat(*[
        F.transform(tx.ngrams(F.col("tokens"), n), lambda g, i: F.struct(g.alias("term"), (F.lit(n << 40) + i).alias("at"))) for n in range(1, max_n + 1)
    ])
    by_doc = rows.select("ord", F.inline(grams)).groupBy("term", "ord").agg(F.count("*").alias("c"), F.min("at").alias("at"))
    return by_doc.select("term", "c", F.col("ord").isNotNull().cast("long").alias("df"), "ord", "at")


def term_counts(docs: DataFrame, max_n: int = 3, text_col: str = "text", ord_col: str = "doc_id", min_frequency: int = 1, min_documents: int = 1) -> DataFrame:
    """(term, frequency, document_frequency, first) of all n-grams that reach both bounds; ``first`` orders terms as first seen.

    Words become numbers, and counts are taken by sorting these for some texts at a time. With a bound, a first pass adds up
    hashes of n-grams and only those n-grams are written out and shuffled that can reach it; so terms seen once, which are most, stay
    where they are. Where rows share a key, those rows are counted by key first.
    """
    rows = docs.select(F.col(ord_col).alias("ord"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    whole = isinstance(docs.schema[ord_col].dataType, T.IntegralType)
    if whole or isinstance(docs.schema[ord_col].dataType, T.StringType):
        seen = docs.groupBy(F.col(ord_col).alias("ord")).agg(F.count("*").alias("n")).where("n > 1 OR ord IS NULL").select("ord")
        shared = not seen.isEmpty()
        ones = rows.join(seen, rows["ord"].eqNullSafe(seen["ord"]), "left_anti") if shared else rows
        bits = None
        if max(min_frequency, min_documents) > 1 and not shared:
            bits = docs.sparkSession.sparkContext.broadcast(_frequent(ones, max_n, min_frequency, min_documents))
        counted = _by_chunk(ones, max_n, bits)
        if shared:
            counted = counted.unionByName(_by_text(rows.join(seen, rows["ord"].eqNullSafe(seen["ord"]), "left_semi"), max_n))
    else:
        counted = _by_text(rows, max_n)
    # numeric order keys and places are one decimal: hash aggregation cannot hold structs
    place = F.col("ord").cast("decimal(20,0)") * F.lit(1 << 45).cast("decimal(15,0)") + F.col("at") if whole else F.when(F.col("ord").isNotNull(), F.struct("ord", "at"))
    terms = counted.groupBy("term").agg(F.sum("c").alias("frequency"), F.sum("df").alias("document_frequency"), F.min(place).alias("first"))
    return terms.where((F.col("frequency") >= min_frequency) & (F.col("document_frequency") >= min_documents if min_documents > 1 else F.lit(True)))


def tfidf(docs: DataFrame, min_frequency: int = 100, max_n: int = 3, min_length: int = 3, text_col: str = "text", ord_col: str = "doc_id") -> DataFrame:
    """Terms with tfidf = frequency * (ln((N + 1) / (df + 1)) + 1); N counts all documents, token-less ones too."""
    total = docs.agg(F.count("*").alias("n_docs"))
    terms = term_counts(docs, max_n, text_col, ord_col, min_frequency).where(F.length("term") >= min_length)
    idf = F.log((F.col("n_docs") + 1) / (F.col("document_frequency") + 1)) + 1
    return terms.crossJoin(F.broadcast(total)).withColumn("tfidf", F.col("frequency") * idf).drop("n_docs")


def top_terms(terms: DataFrame, k: int = 5000) -> DataFrame:
    """The k best terms; equal scores keep first-seen order. Spark runs this as one top-k, not a full sort."""
    return terms.orderBy(F.desc("tfidf"), "first").limit(k)


def enrich_entities(terms: DataFrame, docs: DataFrame, recognise: Callable[[list[str]], list[list[tuple]]], min_frequency: int = 100, pos_tags: tuple[str, ...] = ("NOUN", "PROPN"), text_col: str = "text") -> DataFrame:
    """Adds is_entity, entity_label and pos_tags by a plug-in over each text's first 5000 characters.

    ``recognise`` maps texts to lists of (term, kind, value): kind ``ent`` with the entity label, or ``pos`` with
    comma-joined tags of a noun chunk. Entities that were no terms join them with tfidf 0; terms stay if they are
    entities, have no tags, or have a wanted one.
    """

    def run(batches):
        for pdf in batches:
            found = recognise(pdf["t"].tolist())
            yield pd.DataFrame([x for one in found for x in one], columns=["term", "kind", "value"])

    texts = docs.select(F.substring(F.coalesce(F.col(text_col), F.lit("")), 1, NER_CHARS).alias("t"))
    found = texts.mapInPandas(run, "term string, kind string, value string").where(F.length("term") >= 3)
    seen = found.groupBy("term").agg(
        F.count(F.when(F.col("kind") == "ent", 1)).alias("ent_frequency"),
        F.max(F.when(F.col("kind") == "ent", F.col("value"))).alias("entity_label"),
        F.max(F.when(F.col("kind") == "pos", F.col("value"))).alias("tags"),
    )
    both = terms.join(seen, "term", "full_outer")
    both = both.withColumns({
        "is_entity": F.coalesce(F.col("ent_frequency") > 0, F.lit(False)),
        "frequency": F.coalesce("frequency", "ent_frequency"),
        "document_frequency": F.coalesce("document_frequency", F.lit(0)),
        "tfidf": F.coalesce("tfidf", F.lit(0.0)),
        "pos_tags": F.when(F.col("tags").isNotNull(), F.split("tags", ",")).otherwise(F.array().cast("array<string>")),
    })
    both = both.where((F.col("first").isNotNull()) | (F.col("is_entity") & (F.col("frequency") >= min_frequency)))
    wanted = F.arrays_overlap("pos_tags", F.array(*map(F.lit, pos_tags)))
    return both.where(F.col("is_entity") | (F.size("pos_tags") == 0) | wanted).drop("tags", "ent_frequency")


def extract_terms(docs: DataFrame, min_frequency: int = 100, max_n: int = 3, top_k: int = 5000, recognise=None, **columns) -> DataFrame:
    """(term, frequency, document_frequency, tfidf): mined, enriched if a recogniser is given, best first."""
    terms = tfidf(docs, min_frequency, max_n, **columns)
    if recognise:
        terms = enrich_entities(terms, docs, recognise, min_frequency, text_col=columns.get("text_col", "text"))
    return top_terms(terms, top_k).drop("first")
