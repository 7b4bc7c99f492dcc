"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment.

Test items are partitioned by the size of their shingle sets. Each keeps the bottom of its MinHash
order: with size q and threshold t, any document that holds t of the item holds one of its
``q - ceil(t q) + 1`` least hashes, so the search loses nothing, however long the document is. The
items found for a document are verified by exact shingle containment. Items are taken in blocks of
bounded size against all documents, which are read once per block and never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm.common import mix, shingle_sets, small_batches, table, text_chunks, tidy

CHUNK = 2 << 20
#: Shingles of test items in one block (16 MB of hashes and owners).
BLOCK_SHINGLES = 1_000_000
FILTER_BITS = 22


def _item_sets(batches):
    for b in batches:
        for ids, buf, offsets in text_chunks([b], "item_id", "text", CHUNK):
            owner, value = shingle_sets(buf, offsets)
            for i, item in enumerate(ids):
                lo, hi = np.searchsorted(owner, [i, i + 1])
                if hi > lo:
                    yield pa.RecordBatch.from_arrays([pa.array([item], pa.int64()), pa.array([hi - lo], pa.int64()), pa.array([value[lo:hi].tobytes()], pa.binary())], ["item_id", "n_item", "shingles"])


def _bit_filter(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << FILTER_BITS, bool)
    out[hashes >> np.uint64(64 - FILTER_BITS)] = True
    return out


def _search(block, num: int, den: int):
    def run(batches):
        item_ids, sizes, owner_of, value_of = block.value
        need = -(-sizes * num // den)
        starts = np.cumsum(sizes) - sizes
        # bottom of each item's MinHash order
        rank_order = np.lexsort((mix(value_of), owner_of))
        rank = np.empty(len(value_of), np.int64)
        rank[rank_order] = np.arange(len(value_of)) - starts[owner_of[rank_order]]
        bottom = rank < (sizes - need + 1)[owner_of]
        # size classes share a sorted table of their bottom hashes
        size_class = np.frexp(sizes.astype(float))[1]
        by_class = {}
        for c in np.unique(size_class):
            mine = np.flatnonzero(bottom & (size_class[owner_of] == c))
            mine = mine[np.argsort(value_of[mine])]
            by_class[int(c)] = (int(need[size_class == c].min()), value_of[mine], owner_of[mine])
        quick = _bit_filter(value_of[bottom])
        for b in batches:
            found = []
            for ids, buf, offsets in text_chunks([b], "doc_id", "text", CHUNK):
                doc, value = shingle_sets(buf, offsets)
                n_doc = np.bincount(doc, minlength=len(ids))
                some = np.flatnonzero(quick[value >> np.uint64(64 - FILTER_BITS)])
                pairs = []
                for least, hashes, owners in by_class.values():
                    mine = some[n_doc[doc[some]] >= least]
                    lo, hi = np.searchsorted(hashes, value[mine], "left"), np.searchsorted(hashes, value[mine], "right")
                    hit = np.flatnonzero(hi > lo)
                    count = (hi - lo)[hit]
                    at = np.repeat(lo[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    pairs.append(np.stack([np.repeat(doc[mine[hit]], count), owners[at]], 1))
                pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
                first = np.searchsorted(doc, np.arange(len(ids) + 1))
                for d, i in pairs.tolist():
                    mine = value[first[d] : first[d + 1]]
                    wanted = value_of[starts[i] : starts[i] + sizes[i]]
                    at = np.minimum(np.searchsorted(mine, wanted), len(mine) - 1)
                    shared = int((mine[at] == wanted).sum())
                    if shared >= need[i]:
                        found.append((int(ids[d]), int(item_ids[i]), int(sizes[i]), shared))
            columns = list(zip(*found, strict=True)) if found else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "n_item", "n_shared"])

    return run


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", percent: int = 80) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment: each item of which a document holds ``percent`` or more.

    Shingles are distinct runs of five words, A-Z lower-cased; shorter texts are one shingle, which
    only an equally short text holds. Rows with a null id or without words match nothing; repeated
    rows give one pair; empty tables give no pair. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).filter("item_id is not null").distinct()
    sets = wanted.mapInArrow(_item_sets, "item_id long, n_item long, shingles binary")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("doc_id is not null")
    out, block, size = None, [], 0

    def search(block):
        values = [np.frombuffer(r["shingles"], np.uint64) for r in block]
        sizes = np.array([len(v) for v in values], np.int64)
        shared = spark.sparkContext.broadcast((np.array([r["item_id"] for r in block], np.int64), sizes, np.repeat(np.arange(len(block)), sizes), np.concatenate(values)))
        return source.mapInArrow(tidy(_search(shared, percent, 100)), "doc_id long, item_id long, n_item long, n_shared long")

    for r in sets.toLocalIterator():
        if block and size + r["n_item"] > BLOCK_SHINGLES:
            out = search(block) if out is None else out.unionByName(search(block))
            block, size = [], 0
        block.append(r)
        size += r["n_item"]
    if block:
        out = search(block) if out is None else out.unionByName(search(block))
    if out is None:
        out = source.select("doc_id", F.col("doc_id").alias("item_id"), F.lit(0).cast("long").alias("n_item"), F.lit(0).cast("long").alias("n_shared")).filter("false")
    return out.distinct().withColumn("containment", F.col("n_shared") / F.col("n_item"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
