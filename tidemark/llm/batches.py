"""Arrow batches cut by bytes, so that a worker's memory follows no batch of long texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a worker handles at a time; a longer text is handled alone.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of consecutive rows whose strings in ``column`` have about ``most`` bytes together."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    start, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(size):
        yield batch.slice(start)
