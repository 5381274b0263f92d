"""Arrow batches in slices of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], at: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of batches in order, in slices whose texts (strings or bytes) in column at have size bytes at most, or of one row.

    Python objects made of a slice then take memory by its bytes, however many rows a batch has.
    """
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        lo = 0
        while lo < b.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi
