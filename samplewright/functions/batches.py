"""Arrow batches in small pieces, so that what a task holds as Python objects does not grow with its batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text, or of ids, that are Python objects at once.
PIECE_BYTES = 1 << 20


def pieces(rows: pa.Array, most: int = PIECE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of at most ``most`` bytes of values, one row at least; of no rows an empty one."""
    if pa.types.is_list(rows.type) or pa.types.is_large_list(rows.type):
        sizes = pc.multiply(pc.list_value_length(rows).cast(pa.int64()), rows.type.value_type.bit_width // 8)
    else:
        sizes = pc.binary_length(rows)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends) or not start:
        floor = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, floor + most, side="right")))
        yield rows.slice(start, stop - start)
        start = stop
