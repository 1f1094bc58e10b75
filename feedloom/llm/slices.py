"""Arrow batches worked through in small slices, so that a worker never holds a whole batch as Python values."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa

SLICE_BYTES = 4 << 20


def by_slices(batches: Iterator, compute: Callable, kind: pa.DataType) -> Iterator[pa.Array]:
    """For each batch (an array, or a tuple of them) what `compute` makes of its values, as one array.

    `compute` gets lists of values, of about SLICE_BYTES together, and returns as many values.
    """
    for batch in batches:
        arrays = batch if isinstance(batch, tuple) else (batch,)
        length, size = len(arrays[0]), sum(array.nbytes for array in arrays)
        rows = max(1, SLICE_BYTES * length // max(size, 1))
        parts = []
        for at in range(0, length, rows):
            found = compute(*[array.slice(at, rows).to_pylist() for array in arrays])
            parts.append(found if isinstance(found, pa.Array) else pa.array(found, kind))
        yield pa.concat_arrays(parts) if parts else pa.array([], kind)
