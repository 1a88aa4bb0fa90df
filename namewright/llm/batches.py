"""Arrow batch helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

#: Text bytes handled at a time inside a task; bounds a worker's memory whatever the row lengths.
SLICE_BYTES = 8 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    trim()


def trim() -> None:
    """Give freed memory back to the system: a worker that waits for its next task should not hold the last one's."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def joined_bytes(column: pa.Array):
    """The UTF-8 bytes of a string column's rows end to end, and each row's start and end."""
    import numpy as np
    import pyarrow.compute as pc

    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]
