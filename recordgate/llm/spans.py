"""Packed rows that the two substring removers send between stages, and the last stage that cuts documents.

A stage that has found something to remove writes one row per document with its ranges as packed
32-bit pairs; what must be compared elsewhere goes as packed arrays under a bucket number, so a
shuffle moves arrays and not one row per window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordgate.llm.common import runs

#: bucket: where the row must meet others; kind 0: ranges of one document; other kinds: packed arrays.
SCHEMA = "bucket long, kind int, doc_id long, row_key long, a binary, b binary, c binary, d binary, e binary"
ARROW = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("row_key", pa.int64())] + [(x, pa.binary()) for x in "abcde"])


def row(bucket: int, kind: int, doc_id: int = 0, row_key: int = 0, *arrays: np.ndarray) -> tuple:
    data = [x.tobytes() for x in arrays] + [None] * (5 - len(arrays))
    return (bucket, kind, doc_id, row_key, *data)


def batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


def range_rows(doc: np.ndarray, row_key: np.ndarray, start: np.ndarray, stop: np.ndarray, buckets: int) -> list[tuple]:
    """One kind-0 row for each document, with the union of its ranges."""
    out = []
    if not len(doc):
        return out
    order = np.lexsort((start, row_key, doc))
    doc, row_key, start, stop = doc[order], row_key[order], start[order], stop[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (row_key[1:] != row_key[:-1])
    first = np.flatnonzero(new)
    for lo, hi in zip(first, np.append(first[1:], len(doc)), strict=True):
        s, e = runs(start[lo:hi], stop[lo:hi])
        d = int(doc[lo])
        out.append(row(d % buckets, 0, d, int(row_key[lo]), np.stack([s, e], 1).astype(np.int32)))
    return out


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row_key, text. row_key tells rows of one id apart where their texts differ."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("row_key", F.xxhash64("text"))


def with_ranges(source: DataFrame, found: DataFrame) -> DataFrame:
    """``source`` with the list of packed ranges of each document (null: nothing found)."""
    listed = found.filter("kind = 0").groupBy("doc_id", "row_key").agg(F.collect_list("a").alias("ranges"))
    return source.join(listed, ["doc_id", "row_key"], "left").select("doc_id", "text", "ranges")


def unpack_ranges(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(packed), np.int32).reshape(-1, 2).astype(np.int64)
    return runs(pairs[:, 0], pairs[:, 1])


def unpack(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), kind)
