"""Shared helpers of the text operators: shared tables, Arrow chunks and vectorised word hashing.

All hashing is 64-bit, identical in every task and on every machine, and works on whole Arrow
buffers, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LIBC = ctypes.CDLL(None)
_staged: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Where that is unset: below a temporary folder if driver and executors are one local process,
    else below the session's warehouse, which a cluster shares too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        base = "file://" + tempfile.gettempdir()
    elif not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/staged-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_staged(spark: SparkSession) -> int:
    """Removes all intermediate tables of this application (results that read them must be written before); their number."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"drop table if exists {name}")
    jvm = spark.sparkContext._jvm
    for x in paths:
        at = jvm.org.apache.hadoop.fs.Path(x)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """As ``materialise``, in buckets of ``key``: what groups or joins by it reads the table where it lies, without a shuffle.

    The table is registered in the session's catalog under a name of its own.
    """
    spark, name = df.sparkSession, f"staged_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    df.write.format("parquet").option("compression", "zstd").option("path", shared_dir(spark)).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys (16 bytes each, about 100 in a hash relation) that a join may broadcast; beyond it the join shuffles.
BROADCAST_KEYS = 1_000_000


def semi_join_by_size(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys``; the keys are broadcast only after their count was checked."""
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.join(keys, key, "left_semi")


def anti_join_by_size(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``keys`` (null keys stay); broadcast as above."""
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    return df.join(keys, key, "left_anti").select(df.columns)


def join_by_size(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Inner join with ``other`` (one row for each ``key``); broadcast as above, so a frequent key stays where its rows are."""
    if other.count() <= BROADCAST_KEYS:
        other = F.broadcast(other)
    return df.join(other, key)


def left_join_by_size(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """All rows of ``df`` with what ``other`` has for its ``key`` (one row each); broadcast as above."""
    if other.count() <= BROADCAST_KEYS:
        other = F.broadcast(other)
    return df.join(other, key, "left")


# --- memory of Python workers ---


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows from here on in this session: those of documents hold some megabytes, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Returns freed memory of this Python worker to the machine: idle workers stay with their executor for a minute."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def tidy(run):
    """``run`` over Arrow batches, giving freed memory back when its task is done."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


# --- Arrow chunks -------------------------------------------------------------------------------


def text_chunks(batches, id_col: str, text_col: str, max_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of runs of whole documents of up to ``max_bytes`` (one document may exceed it).

    A null text is an empty one.
    """
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index(id_col)).to_numpy(zero_copy_only=False)
        text = batch.column(batch.schema.get_field_index(text_col))
        if isinstance(text, pa.ChunkedArray):
            text = text.combine_chunks()
        if text.null_count:
            text = text.fill_null(b"" if pa.types.is_binary(text.type) else "")
        wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
        _, offs, data = text.buffers()
        offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
            hi = min(hi, len(ids))
            yield ids[lo:hi], data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi


# --- hashing ------------------------------------------------------------------------------------

_rng = np.random.Generator(np.random.PCG64(20240607))
BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ODD = np.uint64(0x9E3779B97F4A7C15)
MASK64 = (1 << 64) - 1

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base & MASK64))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (byte offsets) and document index of each word ``[^\\x20\\x09-\\x0D]+``."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SEPARATOR[buf]
    before = np.empty(len(buf), bool)
    before[0] = False
    before[1:] = inside[:-1]
    bounds = offsets[:-1]
    before[bounds[bounds < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(buf), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = False
    stops = np.flatnonzero(inside & ~after) + 1
    return starts, stops, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: its 8-byte blocks, each mixed with its place, summed and mixed with the length.

    No polynomial: words cannot be built to collide by algebra (as Thue-Morse words do modulo 2**64).
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    wide = np.lib.stride_tricks.as_strided(np.concatenate([buf, np.zeros(8, np.uint8)]).view(np.uint8), (len(buf) + 1, 8), (1, 1))
    lengths = stops - starts
    blocks = (lengths + 7) >> 3
    first = np.cumsum(blocks) - blocks
    step = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    at = np.repeat(starts, blocks) + 8 * step
    block = np.ascontiguousarray(wide[at]).view("<u8")[:, 0]
    left = np.minimum(np.repeat(stops, blocks) - at, 8).astype(np.uint64)
    block &= np.uint64(MASK64) >> ((np.uint64(8) - left) << np.uint64(3))
    value = mix(block ^ mix(step.astype(np.uint64) + ODD))
    return mix(np.add.reduceat(value, first) ^ (lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def then(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a run from the hashes of its two parts, in order."""
    return mix(a * ODD + b)


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbours of ``h``, put together from runs of 1, 2, 4, ... (mixed at each step)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, taken, size, run = None, 0, 1, h
    while True:
        if k & size:
            part = run[taken : taken + n]
            out, taken = (part if out is None else then(out, part)), taken + size
        if taken == k:
            return mix(out ^ np.uint64(k))
        run, size = then(run[:-size], run[size:]), 2 * size


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, in log2(w) passes."""
    size, out = 1, a
    while size * 2 <= w:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < w:
        shift = w - size
        out = np.minimum(out[:-shift], out[shift:])
    return out


def anchors(grams: np.ndarray, w: int) -> np.ndarray:
    """For each run of ``w`` gram hashes the index of its least one (the leftmost of equal ones).

    Equal runs choose the same relative place, whatever surrounds them.
    """
    bits = max(1, int(len(grams)).bit_length())
    low = np.uint64((1 << bits) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    return (sliding_min(key, w) & low).astype(np.int64)


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = 5):
    """Distinct shingle hashes of each document: (document index, hash), sorted by both.

    Words are lower-cased for A-Z. With fewer than ``k`` words the whole sequence is the one
    shingle; without words there is none.
    """
    starts, stops, doc = words(buf, offsets)
    h = word_hashes(LOWER[buf], starts, stops)
    grams = rolling(h, k)
    n = len(grams)
    keep = doc[:n] == doc[k - 1 :] if n else np.zeros(0, bool)
    owner, value = doc[:n][keep], grams[keep]
    counts = np.bincount(doc, minlength=len(offsets) - 1)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = np.searchsorted(doc, short)
        extra = []
        for d, b in zip(short, begin, strict=True):
            c = int(counts[d])
            extra.append(int(rolling(h[b : b + c], c)[0]))
        owner = np.concatenate([owner, short])
        value = np.concatenate([value, mix(np.array(extra, np.uint64) ^ np.uint64(0xA0761D6478BD642F))])
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    if len(owner):
        first = np.ones(len(owner), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        owner, value = owner[first], value[first]
    return owner, value


def groups(keys: np.ndarray) -> list[tuple[int, int]]:
    """(first, past the last) of each run of equal neighbours."""
    if not len(keys):
        return []
    at = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return list(zip([0, *at.tolist()], [*at.tolist(), len(keys)], strict=True))


def runs(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open ranges, as maximal ranges in order."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, top = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > top[:-1]
    first = np.flatnonzero(new)
    return starts[first], top[np.append(first[1:], len(starts)) - 1]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


WORD = re.compile(rb"[^\x20\x09-\x0D]+")
