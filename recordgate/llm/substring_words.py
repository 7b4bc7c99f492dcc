"""Removal of repeated word windows behind a count-min prefilter.

Every window of 50 words names an anchor: the least 16-word run inside it, the same in every copy
of the window. Pass one adds the anchors of each partition to a count-min sketch; merged, the
sketches overestimate how often a window occurs, never under. Pass two keeps the windows estimated
at two or more, groups them by two 64-bit hashes of their words, mixed in different orders (128 bits,
no polynomial), and removes each whose least document is a smaller one. Nothing is lost: a window that repeats has an anchor that repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm import count_min, spans
from recordgate.llm.common import WORD, anchors, groups, mix, rolling, table, text_chunks, then, word_hashes, words

CHUNK = 2 << 20


def _windows(buf, offsets, window: int, gram: int):
    """word document index, word index of each document's first word, window starts, anchor of each, grams, word hashes."""
    starts, stops, doc = words(buf, offsets)
    h = word_hashes(buf, starts, stops)
    n = len(h) - window + 1
    if n <= 0:
        return doc, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), h
    valid = np.flatnonzero(doc[:n] == doc[window - 1 :])
    grams = rolling(h, gram)
    return doc, valid, anchors(grams, window - gram + 1)[valid], grams, h


def _sketch(window: int, gram: int, bits: int):
    def run(batches):
        for b in batches:
            seen = []
            for _, buf, offsets in text_chunks([b], "doc_id", "text", CHUNK):
                _, _, at, grams, _ = _windows(buf, offsets, window, gram)
                seen.append(grams[np.unique(at)])
            yield count_min.sketch(np.concatenate(seen) if seen else np.zeros(0, np.uint64), bits)

    return run


def _probe(window: int, gram: int, bits: int, buckets: int, sketch):
    def run(batches):
        for b in batches:
            row_keys = b.column(b.schema.get_field_index("row_key")).to_numpy()
            at_row, parts = 0, []
            for ids, buf, offsets in text_chunks([b], "doc_id", "text", CHUNK):
                doc, start, at, grams, h = _windows(buf, offsets, window, gram)
                if len(start):
                    anchor = grams[at]
                    keep = count_min.repeated(sketch.value, anchor, bits)
                    start, anchor = start[keep], anchor[keep]
                    owner = doc[start]
                    first_word = np.searchsorted(doc, np.arange(len(ids)))
                    parts.append((rolling(h, window)[start], _second(grams, start, window, gram), ids[owner], row_keys[at_row : at_row + len(ids)][owner], start - first_word[owner], (mix(anchor) % np.uint64(buckets)).astype(np.int64)))
                at_row += len(ids)
            rows = []
            if parts:
                value, other, owner, key, start, bucket = (np.concatenate(x) for x in zip(*parts, strict=True))
                gone = _later(value, other, owner)
                rows += spans.range_rows(owner[gone], key[gone], start[gone], start[gone] + window, buckets)
                value, other, owner, key, start, bucket = (x[~gone] for x in (value, other, owner, key, start, bucket))
                order = np.lexsort((start, owner, bucket))
                for lo, hi in groups(bucket[order]):
                    i = order[lo:hi]
                    rows.append(spans.row(int(bucket[i[0]]), 1, 0, 0, value[i], owner[i], key[i], start[i].astype(np.int32), other[i]))
            yield spans.batch(rows)

    return run


def _second(grams: np.ndarray, start: np.ndarray, window: int, gram: int) -> np.ndarray:
    """A second hash of windows, from the hashes of runs that cover each."""
    out = np.zeros(len(start), np.uint64)
    for at in [*range(0, window - gram, gram), window - gram]:
        out = then(out, grams[start + at])
    return out


def _later(value: np.ndarray, other: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether a row's values have a smaller owner than its own."""
    order = np.lexsort((owner, other, value))
    v, w, o = value[order], other[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    least = np.empty(len(v), o.dtype)
    least[order] = o[np.flatnonzero(new)][np.cumsum(new) - 1] if len(v) else o
    return owner > least


def _resolve(window: int, buckets: int):
    def run(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        known, open_ = t.filter(pa.array(kind == 0)), t.filter(pa.array(kind == 1))
        value, owner, key = unpack_probe(open_)
        start = spans.unpack(open_.column("d"), np.int32).astype(np.int64)
        gone = _later(value, spans.unpack(open_.column("e"), np.uint64), owner)
        rows = spans.range_rows(owner[gone], key[gone], start[gone], start[gone] + window, buckets)
        return pa.concat_tables([known.cast(spans.ARROW), pa.Table.from_batches([spans.batch(rows)])])

    return run


def unpack_probe(t: pa.Table):
    return spans.unpack(t.column("a"), np.uint64), spans.unpack(t.column("b"), np.int64), spans.unpack(t.column("c"), np.int64)


def _cut(batches):
    for b in batches:
        n_words, n_removed, kept = [], [], []
        for text, ranges in zip(b.column(1), b.column(2), strict=True):
            all_words = WORD.findall(text.as_py().encode())
            gone = np.zeros(len(all_words), bool)
            if ranges.is_valid:
                for s, e in zip(*spans.unpack_ranges(ranges.as_py()), strict=True):
                    gone[s:e] = True
            n_words.append(len(all_words))
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(all_words, gone.tolist(), strict=True) if not g] if n_removed[-1] else all_words).decode())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, gram: int = 16) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space), one row per row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts in a document of a
    smaller id. Null text: no words. Null id: the row takes no part and is returned unchanged. Rows
    of one id are one document: they never remove each other. An empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    source = spans.keyed(docs, id_col, text_col)
    part = source.filter("doc_id is not null")
    size = int(part.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    bits = count_min.cell_bits(size // 6 * 2 // (window - gram + 2) + 1)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (8 << 20))
    shared = count_min.merge(part.select("doc_id", "text").mapInArrow(_sketch(window, gram, bits), count_min.SCHEMA), bits)
    found = part.mapInArrow(_probe(window, gram, bits, buckets, shared), spans.SCHEMA).groupBy("bucket").applyInArrow(_resolve(window, buckets), spans.SCHEMA)
    return spans.with_ranges(source, found).mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_windows(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
