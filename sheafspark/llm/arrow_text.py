"""Text columns inside Arrow functions: whole texts, cut into slices so that memory stays bounded."""

import contextlib
import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a task splits into words at a time.
SLICE_BYTES = 1 << 20
_WHITE = re.compile(rb"[\t-\r ]")


def give_back() -> None:
    """Memory that this process has freed goes back to the system; workers live longer than their tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries keep their own counsel
        ctypes.CDLL(None).malloc_trim(0)


def each(batches: Iterator) -> Iterator:
    """The batches of a task; what Arrow holds and does not need goes back to the system after each.

    What earlier tasks of the worker have left goes back first.
    """
    give_back()
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def byte_column(column: pa.Array) -> pa.Array:
    """The texts as UTF-8 bytes; null becomes empty."""
    return pc.fill_null(column.cast(pa.binary()), b"")


def row_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes, or one row that is longer."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


def white_space_blocks(text: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """Cuts a long text at ASCII white space into blocks of about ``limit`` bytes; no word is cut."""
    start = 0
    while len(text) - start > limit:
        found = _WHITE.search(text, start + limit)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text
