"""Texts of an Arrow batch as codes of their distinct pieces.

Python work is then done once per distinct piece of a slice, and per-document
results are gathered in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 12 << 20  # text handled at a time; one longer text is handled alone


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``size`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def split_codes(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list]:
    """Codes of all pieces, the offsets of the lists in them, and the distinct pieces."""
    pieces = lists.flatten().dictionary_encode()
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pieces.indices.to_numpy(zero_copy_only=False), offsets, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()


def gather(table: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of table[s : s + n] over the given starts and lengths."""
    total = int(lengths.sum())
    if not total:
        return table[:0]
    ends = np.cumsum(lengths)
    return table[np.arange(total) + np.repeat(starts - (ends - lengths), lengths)]
