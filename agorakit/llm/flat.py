"""Whole texts of a batch as one flat array of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on by itself, whole.
MOST_BYTES = 4 << 20


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins, with the end as last. Null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    cuts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]] if cuts[-1] > cuts[0] else np.empty(0, np.uint8)
    return flat, cuts - cuts[0]


def as_strings(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Texts from flat bytes; the reverse of flat_bytes."""
    whole = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    return whole.cast(pa.string())


def parts(batch: pa.RecordBatch, column: int, most: int = MOST_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in parts with at most so many bytes in a column of texts, or items in one of lists, or of one row."""
    of = batch.column(column)
    sizes = (pc.list_value_length if pa.types.is_list(of.type) else pc.binary_length)(of).fill_null(0).to_numpy().astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def sums_before(sizes: np.ndarray) -> np.ndarray:
    """Prefix sums from 0, with the whole as last."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out
