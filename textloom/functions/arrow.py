"""Arrow batches by bytes: a batch of Spark's may hold 64 MB, and what Python makes of it is several times that."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are turned into Python objects at a time.
SLICE = 2 << 20


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of the texts of a column, or values of its lists; 0 for nulls."""
    measure = pc.list_value_length if pa.types.is_list(column.type) or pa.types.is_large_list(column.type) else pc.binary_length
    return pc.fill_null(measure(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``limit`` bytes of text in the column ``name``, or one row, and of at most ``rows`` rows."""
    for batch in batches:
        ends = np.cumsum(lengths(batch.column(name)))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = min(max(int(np.searchsorted(ends, before + limit, "right")), at + 1), at + rows)
            yield batch.slice(at, stop - at)
            at = stop
