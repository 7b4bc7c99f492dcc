"""Removal of repeated 100-byte strings by a hash-compared suffix sort.

Every 100-byte string names an anchor, the least 32-byte gram inside it; neighbouring strings that
share an anchor form one context (the bytes they span). Contexts meet by anchor:

1. Contexts that are equal as a whole are settled by their hashes (anchor and context, 128 bits,
   mixed and no polynomial): all but the first occurrence go. Each batch settles its own first, so a hot passage leaves a
   batch once.
2. Anchors with different contexts (the edges of shared passages) fetch the contexts' bytes. There
   the suffixes that start a 100-byte string are sorted by mergesort; a comparison finds the common
   extension by binary search over prefix polynomial hashes. Neighbours of common extension 100 are
   equal, and their bytes are compared before anything goes.

Anchors with more than ``HOT`` contexts send the 128-bit hashes of their strings, settled per batch
first, to as many buckets as there are strings, so no group is held by one task. Both ways give the
same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm import spans
from recordgate.llm.common import BYTE, anchors, groups, materialise, mix, powers, rolling, semi_join_by_size, table, text_chunks, then

CHUNK = 1 << 20
LENGTH, GRAM = 100, 32
HOT = 4096
_BASE3 = 0x2545F4914F6CDD1D | 1


def _prefix(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values * base**i, and base**-i."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n), out=total[1:])
    return total, powers(pow(base, -1, 1 << 64), n + 1)


def _contexts(buf: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """document, first string start, last string start (in the document), anchor hash, context hash, anchor offset."""
    values = BYTE[buf]
    grams = rolling(values, gram)
    n = len(buf) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    at = anchors(grams, length - gram + 1)
    sizes = np.diff(offsets)
    fits = np.flatnonzero(sizes >= length)
    counts = sizes[fits] - length + 1
    owner = np.repeat(fits, counts)
    valid = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[owner]
    at = at[valid]
    if not len(valid):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    new = np.ones(len(valid), bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(valid)) - 1
    lo, hi, owner, at = valid[first], valid[last], owner[first], at[first]
    span = hi - lo + length
    double = then(grams[:-gram], grams[gram:])
    whole = span.astype(np.uint64)
    for step in range(0, 2 * length - gram, 2 * gram):  # runs that cover the longest context
        whole = then(whole, double[lo + np.minimum(step, span - 2 * gram)])
    return owner, lo - offsets[owner], hi - offsets[owner], grams[at], whole, at - lo


def _probe(length: int, gram: int, buckets: int):
    def run(batches):
        for b in batches:
            row_keys = b.column(b.schema.get_field_index("row_key")).to_numpy()
            at_row, parts = 0, []
            for ids, buf, offsets in text_chunks([b], "doc_id", "text", CHUNK):
                owner, lo, hi, anchor, whole, offset = _contexts(buf, offsets, length, gram)
                parts.append((anchor, whole, ids[owner], row_keys[at_row : at_row + len(ids)][owner], lo.astype(np.int32), ((hi - lo) | (offset << 8)).astype(np.int32)))
                at_row += len(ids)
            rows = []
            if parts:
                anchor, whole, doc, key, lo, shape = (np.concatenate(x) for x in zip(*parts, strict=True))
                gone = _later((whole, anchor), doc, lo)
                rows += spans.range_rows(doc[gone], key[gone], lo[gone].astype(np.int64), lo[gone] + (shape[gone] & 255).astype(np.int64) + length, buckets)
                keep = np.flatnonzero(~gone)
                bucket = (mix(anchor[keep]) % np.uint64(buckets)).astype(np.int64)
                keep = keep[np.argsort(bucket, kind="stable")]
                bucket = np.sort(bucket, kind="stable")
                who = np.stack([doc, key], 1)
                for s, e in groups(bucket):
                    i = keep[s:e]
                    # documents come in order, so their ids are kept once with the number of rows each has
                    cut = np.array(groups(doc[i] * 3 + key[i]), np.int64).reshape(-1, 2)
                    people = np.concatenate([who[i][cut[:, 0]], np.diff(cut, axis=1)], 1)
                    rows.append(spans.row(int(bucket[s]), 1, 0, 0, anchor[i], whole[i], people, lo[i], shape[i]))
            yield spans.batch(rows)

    return run


def _open_rows(t: pa.Table):
    people = spans.unpack(t.column("c"), np.int64).reshape(-1, 3)
    doc, key = np.repeat(people[:, 0], people[:, 2]), np.repeat(people[:, 1], people[:, 2])
    return spans.unpack(t.column("a"), np.uint64), spans.unpack(t.column("b"), np.uint64), doc, key, spans.unpack(t.column("d"), np.int32).astype(np.int64), spans.unpack(t.column("e"), np.int32).astype(np.int64)


def _settle(length: int, buckets: int, hot: int):
    """Whole contexts: ranges (kind 0) and requests for the bytes of differing ones (kind 2; kind 3 if hot)."""

    def run(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        anchor, whole, doc, key, lo, shape = _open_rows(t.filter(pa.array(kind == 1)))
        order = np.lexsort((lo, doc, whole, anchor))
        anchor, whole, doc, key, lo, shape = (x[order] for x in (anchor, whole, doc, key, lo, shape))
        gone = _after_first((anchor[1:] == anchor[:-1]) & (whole[1:] == whole[:-1]), doc, lo)
        rows = spans.range_rows(doc[gone], key[gone], lo[gone], lo[gone] + (shape[gone] & 255) + length, buckets)
        anchor, doc, key, lo, shape = (x[~gone] for x in (anchor, doc, key, lo, shape))
        if len(anchor):
            _, back, count = np.unique(anchor, return_inverse=True, return_counts=True)
            size = count[back]
            for kind_, chosen in ((2, (size > 1) & (size <= hot)), (3, size > hot)):
                i = np.flatnonzero(chosen)
                i = i[np.lexsort((lo[i], key[i], doc[i]))]
                who = np.stack([doc[i], key[i]], 1)
                new = np.ones(len(i), bool)
                new[1:] = (who[1:] != who[:-1]).any(1)
                first = np.flatnonzero(new)
                for s, e in zip(first, np.append(first[1:], len(i)) if len(first) else first, strict=True):
                    j = i[s:e]
                    rows.append(spans.row(0, kind_, int(doc[j[0]]), int(key[j[0]]), anchor[j], lo[j].astype(np.int32), shape[j].astype(np.int32)))
        return pa.concat_tables([t.filter(pa.array(kind == 0)).cast(spans.ARROW), pa.Table.from_batches([spans.batch(rows)])])

    return run


def _fetch(length: int, gram: int, buckets: int):
    """Bytes of the requested contexts (kind 4), or the strings' hashes for hot anchors (kind 5), by bucket."""

    def run(batches):
        for b in batches:
            text = b.column(b.schema.get_field_index("text"))
            ids, keys = b.column(b.schema.get_field_index("doc_id")).to_pylist(), b.column(b.schema.get_field_index("row_key")).to_pylist()
            wanted = b.column(b.schema.get_field_index("wanted")).to_pylist()
            got, hot = [], []
            for i, asked in enumerate(wanted):
                raw = text[i].as_py().encode()
                for w in asked:
                    anchor, lo, shape = np.frombuffer(w["a"], np.uint64), np.frombuffer(w["b"], np.int32), np.frombuffer(w["c"], np.int32)
                    if w["kind"] == 2:
                        got += [(int(a), ids[i], keys[i], int(s), int(x), raw[s : s + (x & 255) + length]) for a, s, x in zip(anchor, lo, shape, strict=True)]
                    else:
                        grams = rolling(BYTE[np.frombuffer(raw, np.uint8)], gram)
                        double = then(grams[:-gram], grams[gram:])
                        for s, x in zip(lo.tolist(), shape.tolist(), strict=True):
                            at = np.arange(s, s + (x & 255) + 1)
                            hot.append((double[at], double[at + length - 2 * gram], np.full(len(at), ids[i]), np.full(len(at), keys[i]), at))
            rows = []
            if got:
                bucket = mix(np.array([g[0] for g in got], np.uint64) ^ np.uint64(0x27D4EB2F165667C5)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                for s, e in groups(bucket[order]):
                    part = [got[j] for j in order[s:e]]
                    rows.append(spans.row(int(bucket[order[s]]), 4, 0, 0, np.array([g[0] for g in part], np.uint64), np.array([g[1:3] for g in part], np.int64), np.array([g[3:5] for g in part], np.int32), np.frombuffer(b"".join(g[5] for g in part), np.uint8)))
            if hot:
                value, other, doc, key, at = (np.concatenate(x) for x in zip(*hot, strict=True))
                gone = _later((value, other), doc, at)
                rows += spans.range_rows(doc[gone], key[gone], at[gone], at[gone] + length, buckets)
                i = np.flatnonzero(~gone)
                bucket = (mix(value[i]) % np.uint64(buckets)).astype(np.int64)
                i = i[np.argsort(bucket, kind="stable")]
                for s, e in groups(np.sort(bucket)):
                    j = i[s:e]
                    rows.append(spans.row(int(mix(value[j[:1]])[0] % np.uint64(buckets)), 5, 0, 0, value[j], np.stack([doc[j], key[j]], 1), at[j].astype(np.int32), other[j]))
            yield spans.batch(rows)

    return run


def _later(values: tuple[np.ndarray, ...], doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether equal values stand in a smaller document or earlier in the same one."""
    order = np.lexsort((at, doc, *values))
    gone = np.zeros(len(order), bool)
    equal = np.ones(max(len(order) - 1, 0), bool)
    for v in values:
        equal &= v[order[1:]] == v[order[:-1]]
    gone[order] = _after_first(equal, doc[order], at[order])
    return gone


def _after_first(equal: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For rows in order: whether a row equals the first of its run (``equal``: to its neighbour) and stands elsewhere.

    A repeated row of the table stands in the same place, so it removes nothing.
    """
    if not len(doc):
        return np.zeros(0, bool)
    new = np.ones(len(doc), bool)
    new[1:] = ~equal
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    return (doc != doc[first]) | (at != at[first])


class SuffixOrder:
    """Suffixes of ``data`` at ``start``, compared on their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.total, self.inverse = _prefix(BYTE[data], _BASE3)

    def _hash(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return (self.total[at + n] - self.total[at]) * self.inverse[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, up to ``length``: binary search over prefix hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length)
        while (low < high).any():
            mid = (low + high + 1) >> 1
            equal = self._hash(a, mid) == self._hash(b, mid)
            low, high = np.where(equal, mid, low), np.where(equal, high, mid - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        n = self.common(a, b)
        full = n >= self.length
        step = np.where(full, 0, n)
        return np.where(full, or_equal, self.data[a + step] < self.data[b + step])

    def sort(self, group: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Order by group, then suffix; equal suffixes keep their order."""
        head = np.zeros(len(start), np.uint64)
        for j in range(8):
            head = (head << np.uint64(8)) | self.data[start + j].astype(np.uint64)
        order = np.lexsort((head, group))
        tied = np.zeros(len(order), bool)
        g, h = group[order], head[order]
        tied[1:] = (g[1:] == g[:-1]) & (h[1:] == h[:-1])
        first = np.flatnonzero(~tied)
        size = np.diff(np.append(first, len(order)))
        run = np.repeat(np.arange(len(first)), size)
        place = np.arange(len(order)) - first[run]
        width = 1
        while len(first) and (active := np.flatnonzero(size[run] > width)).size:
            # each element counts how many of the other half come before it
            half = (place[active] // width) & 1
            other = first[run[active]] + (place[active] // width + np.where(half, -1, 1)) * width
            stop = np.minimum(other + width, first[run[active]] + size[run[active]])
            low, high, mine = np.minimum(other, stop), stop.copy(), start[order[active]]
            high = np.maximum(high, low)
            begin = low.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                mid = (low[open_] + high[open_]) >> 1
                theirs = start[order[mid]]
                before = np.where(half[open_] == 1, self.less(theirs, mine[open_], True), self.less(theirs, mine[open_], False))
                low[open_], high[open_] = np.where(before, mid + 1, low[open_]), np.where(before, high[open_], mid)
            base = place[active] // (2 * width) * (2 * width)
            target = first[run[active]] + base + place[active] % width + (low - begin)
            moved = order[active].copy()
            order[target] = moved
            width *= 2
        return order


def _suffix_ranges(anchor, doc, key, lo, shape, data, length: int, buckets: int) -> list[tuple]:
    """Strings of contexts that share an anchor: sort their suffixes, remove all but the first of equal ones."""
    span = (shape & 255) + length
    begin = np.cumsum(span) - span
    order = np.lexsort((lo, doc, anchor))
    count = (shape & 255)[order] + 1
    context = np.repeat(order, count)
    step = np.arange(len(context)) - np.repeat(np.cumsum(count) - count, count)
    # strings can only be equal where they stand alike to the anchor
    offset = (shape >> 8)[context] - step
    _, group = np.unique(anchor, return_inverse=True)
    group = group[context] * 256 + offset
    start = begin[context] + step
    suffixes = SuffixOrder(data, length)
    by = suffixes.sort(group, start)
    a, b = start[by[:-1]], start[by[1:]]
    equal = np.flatnonzero((group[by[1:]] == group[by[:-1]]) & (suffixes.common(a, b) >= length)) if len(by) > 1 else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else None
    same = np.zeros(max(len(by) - 1, 0), bool)
    for s in range(0, len(equal), 50_000):  # verify the bytes: hashes may collide
        e = equal[s : s + 50_000]
        same[e] = (view[a[e]] == view[b[e]]).all(1)
    gone = np.zeros(len(by), bool)
    gone[by] = _after_first(same, doc[context[by]], (lo[context] + step)[by])
    c, at = context[gone], (lo[context] + step)[gone]
    return spans.range_rows(doc[c], key[c], at, at + length, buckets)


def _compare(length: int, buckets: int):
    def run(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        rows = []
        part = t.filter(pa.array(kind == 4))
        if part.num_rows:
            anchor, who, place = spans.unpack(part.column("a"), np.uint64), spans.unpack(part.column("b"), np.int64).reshape(-1, 2), spans.unpack(part.column("c"), np.int32).reshape(-1, 2).astype(np.int64)
            rows += _suffix_ranges(anchor, who[:, 0], who[:, 1], place[:, 0], place[:, 1], spans.unpack(part.column("d"), np.uint8), length, buckets)
        part = t.filter(pa.array(kind == 5))
        if part.num_rows:
            value, who, at = spans.unpack(part.column("a"), np.uint64), spans.unpack(part.column("b"), np.int64).reshape(-1, 2), spans.unpack(part.column("c"), np.int32).astype(np.int64)
            gone = _later((value, spans.unpack(part.column("d"), np.uint64)), who[:, 0], at)
            rows += spans.range_rows(who[gone, 0], who[gone, 1], at[gone], at[gone] + length, buckets)
        return pa.concat_tables([t.filter(pa.array(kind == 0)).cast(spans.ARROW), pa.Table.from_batches([spans.batch(rows)])])

    return run


def _cut(batches):
    for b in batches:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, ranges in zip(b.column(1), b.column(2), strict=True):
            raw = text.as_py().encode()
            n_bytes.append(len(raw))
            if not ranges.is_valid:
                n_removed.append(0)
                n_spans.append(0)
                kept.append(raw)
                continue
            starts, stops = spans.unpack_ranges(ranges.as_py())
            n_removed.append(int((stops - starts).sum()))
            n_spans.append(len(starts))
            kept.append(b"".join(raw[e:s] for e, s in zip([0, *stops.tolist()], [*starts.tolist(), len(raw)], strict=True)))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeated_strings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary: the bytes left), one row per row of ``docs``.

    A byte goes if a string of ``length`` bytes (at least twice ``gram``, at most 250) that covers it also starts earlier: in
    a document of a smaller id, or before it in the same one. Null text: empty. Null id: the row
    takes no part and is returned unchanged. Rows that repeat an id and its text are cut alike. An
    empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    source = spans.keyed(docs, id_col, text_col)
    part = source.filter("doc_id is not null")
    size = int(part.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (8 << 20))
    settled = materialise(part.mapInArrow(_probe(length, gram, buckets), spans.SCHEMA).groupBy("bucket").applyInArrow(_settle(length, buckets, hot), spans.SCHEMA))
    asked = settled.filter("kind in (2, 3)").groupBy("doc_id", "row_key").agg(F.collect_list(F.struct("kind", "a", "b", "c")).alias("wanted"))
    some = semi_join_by_size(part, settled.filter("kind in (2, 3)").select("doc_id").distinct(), "doc_id")
    fetched = some.join(asked, ["doc_id", "row_key"]).mapInArrow(_fetch(length, gram, buckets), spans.SCHEMA)
    compared = fetched.groupBy("bucket").applyInArrow(_compare(length, buckets), spans.SCHEMA)
    found = settled.filter("kind = 0").unionByName(compared.filter("kind = 0"))
    return spans.with_ranges(source, found).mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
