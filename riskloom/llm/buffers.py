"""Arrow text columns as byte buffers: vectorised words, for operators that work on whole texts in tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if sys.platform == "linux":
    # Large arrays are given back to the system as soon as they are freed, so that a worker that goes on
    # to another stage does not keep the peak of the last one. -3 is M_MMAP_THRESHOLD.
    ctypes.CDLL(None).mallopt(-3, 1 << 20)

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds at most ``most`` bytes each, or one row."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    flat = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(flat.type) or pa.types.is_large_binary(flat.type)
    _, offsets, data = flat.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


class Words:
    """The words of a text column. ``data`` holds each word followed by one space where another word of its
    text follows; word ``i`` is ``data[start[i]:end[i]]``, and text ``d`` has words ``first[d]:first[d + 1]``.
    """

    def __init__(self, column: pa.Array, lower: bool = False):
        raw, offs = text_bytes(column)
        solid = ~_BLANK[raw]
        before = np.zeros(len(raw), bool)
        before[1:] = solid[:-1]
        heads = offs[:-1][offs[:-1] < len(raw)]
        before[heads] = False
        kept = solid | before  # one blank after each word stays
        begins = np.flatnonzero(solid & ~before)
        place = np.cumsum(kept, dtype=np.int32) - 1
        self.first = np.searchsorted(begins, offs)
        self.start = place[begins].astype(np.int64)
        del place
        data = raw[kept]
        blank = _BLANK[data]
        data[blank] = 0x20
        stops = np.flatnonzero(blank)
        # A word ends at its blank, or where the next word starts without one between (end of a text).
        limit = np.append(self.start[1:], len(data))
        at = np.searchsorted(stops, self.start)
        nearest = np.append(stops, len(data))[at] if len(self.start) else np.zeros(0, np.int64)
        self.end = np.minimum(nearest, limit)
        self.data = LOWER[data] if lower else data

    def __len__(self) -> int:
        return len(self.start)
