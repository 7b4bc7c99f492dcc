"""Count-min sketches of 64-bit keys: one per batch, merged by segment, never an underestimate.

The merged sketch keeps one bit per cell, "two or more", and has at most ``SKETCH_ROWS * 2**28``
bits (64 MB) whatever the input; a larger input raises the share of false positives only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordgate.llm.common import groups, mix

SEGMENT_BITS = 20
MOST_CELL_BITS = 28
SKETCH_ROWS = 2
SCHEMA = "segment long, cells binary, n int"


def cell_bits(keys_expected: int) -> int:
    return min(MOST_CELL_BITS, max(SEGMENT_BITS, (8 * keys_expected).bit_length()))


def _cells(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(keys ^ np.uint64(0x5851F42D4C957F2D * (r + 1) & (1 << 64) - 1)) >> np.uint64(64 - bits)).astype(np.int64) for r in range(SKETCH_ROWS)]


def sketch(keys: np.ndarray, bits: int) -> pa.RecordBatch:
    """The sketch of one batch, in segments: steps between its cells in order, a cell met again being a step of 0."""
    rows = []
    for r, cell in enumerate(_cells(keys, bits)):
        cell = np.sort(cell)
        # a third occurrence says no more than a second
        cell = cell[np.append(np.ones(min(2, len(cell)), bool), cell[2:] != cell[:-2])]
        segment = cell >> SEGMENT_BITS
        for lo, hi in groups(segment):
            steps = np.diff(cell[lo:hi] & ((1 << SEGMENT_BITS) - 1), prepend=0)
            rows.append(((r << (bits - SEGMENT_BITS)) + int(segment[lo]), steps.astype(np.uint16 if steps.max() < 1 << 16 else np.uint32).tobytes(), hi - lo))
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.int32())], ["segment", "cells", "n"])


def _merge(t: pa.Table) -> pa.Table:
    total = np.zeros(1 << SEGMENT_BITS, np.uint8)
    for cells, n in zip(t.column("cells").to_pylist(), t.column("n").to_pylist(), strict=True):
        at, count = np.unique(np.cumsum(np.frombuffer(cells, np.uint16 if len(cells) == 2 * n else np.uint32).astype(np.int64)), return_counts=True)
        total[at] = np.minimum(total[at] + count, 2)
    return pa.table({"segment": t.column("segment")[:1], "repeated": pa.array([np.packbits(total >= 2).tobytes()], pa.binary())})


def merge(sketches: DataFrame, bits: int):
    """Broadcast variable with the merged sketch of ``sketches`` (rows of SCHEMA)."""
    step = (1 << SEGMENT_BITS) // 8
    out = bytearray(SKETCH_ROWS * (1 << bits) // 8)
    for r in sketches.groupBy("segment").applyInArrow(_merge, "segment long, repeated binary").toLocalIterator():
        out[r["segment"] * step : (r["segment"] + 1) * step] = r["repeated"]
    return sketches.sparkSession.sparkContext.broadcast(bytes(out))


def repeated(merged: bytes, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each key is estimated to occur twice or more."""
    rows = np.frombuffer(merged, np.uint8).reshape(SKETCH_ROWS, -1)
    keep = np.ones(len(keys), bool)
    for r, cell in enumerate(_cells(keys, bits)):
        keep &= (rows[r][cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return keep
