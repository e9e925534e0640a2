"""Splitting texts into overlapping pieces that prefer to end at natural breaks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.arrow import slices

#: Where a piece [start, end) of a text should end instead; ``half`` is half the piece's length.
Break = Callable[[str, int, int, int], int]


def latest_stop(text: str, start: int, end: int, half: int) -> int:
    """After the last full stop or line break, if that lies beyond the middle."""
    at = max(text.rfind(mark, start, end) for mark in ".\n")
    return at + 1 if at > start + half else end


def first_of(*marks: str) -> Break:
    """After the last occurrence, in the second half, of the first mark that occurs there."""

    def find(text: str, start: int, end: int, half: int) -> int:
        for mark in marks:
            at = text.rfind(mark, start + half, end)
            if at > start:
                return at + len(mark)
        return end

    return find


@dataclass(frozen=True)
class Chunker:
    """A way of splitting. ``raw_single``: a text of one piece is returned as it is, even blank.

    ``min_words`` applies to texts of several pieces only. Each piece starts ``overlap`` before the end of the one
    before; where that would not move on, an error is raised instead of looping.
    """

    size: int
    overlap: int
    find_break: Break
    raw_single: bool = False
    min_words: int = 0
    overrun: bool = True

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        start = 0
        while start < len(text):
            end = start + self.size
            if end < len(text):
                end = self.find_break(text, start, end, self.size // 2)
            elif not self.overrun:
                end = len(text)
            yield start, end
            if end - self.overlap <= start:
                raise ValueError(f"an overlap of {self.overlap} does not let pieces of {self.size} move on")
            start = end - self.overlap

    def split(self, text: str) -> list[str]:
        if len(text) <= self.size:
            return [text] if self.raw_single else [p for p in [text.strip()] if p]
        pieces = (text[a:b].strip() for a, b in self.spans(text))
        return [p for p in pieces if p and (not self.min_words or len(p.split()) >= self.min_words)]


def chat_chunker(size: int = 8000, overlap: int = 200) -> Chunker:
    return Chunker(size, overlap, latest_stop, raw_single=True)


def qa_chunker(size: int = 1500, overlap: int = 200) -> Chunker:
    return Chunker(size, overlap, first_of(".\n", ". ", "\n\n", "\n"))


def instruction_chunker(size: int = 1500) -> Chunker:
    return Chunker(size, 0, first_of("\n\n", ".\n", ". ", "\n"), min_words=20, overrun=False)


def chunk(docs: DataFrame, chunker: Chunker, text_col: str = "text") -> DataFrame:
    """One row a piece: ``docs`` without its text, with chunk_index, n_chunks and chunk. Arrow batches, a slice of texts at a time."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            cut = [chunker.split(t or "") for t in part.column("_text").to_pylist()]
            yield part.drop_columns(["_text"]).append_column("_pieces", pa.array(cut, pa.list_(pa.string())))

    rows = docs.select(*others, F.col(text_col).alias("_text"))
    cut = rows.mapInArrow(run, T.StructType([*rows.drop("_text").schema.fields, T.StructField("_pieces", T.ArrayType(T.StringType()))]))
    return cut.select(*others, F.size("_pieces").alias("n_chunks"), F.posexplode("_pieces").alias("chunk_index", "chunk"))
