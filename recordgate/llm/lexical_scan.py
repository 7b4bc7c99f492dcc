"""Ranked lexical search without a document index: one Aho-Corasick automaton of all item terms reads every text.

Texts are folded to term bytes with one blank for every other character, and each pattern is a term
between two blanks, so a match is a whole term and its count the term frequency. The automaton's
outputs are term numbers; a table of items by term turns them into item scores. Items come in blocks
whose automaton has a bounded number of terms, so what is broadcast does not grow with the documents;
the documents are scanned once per block and only sparse counts are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.llm.common import LOWER, materialise, small_batches, table, text_chunks, tidy

#: What a term is made of, as a pattern; the letters that are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER_CASE, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Terms of one automaton (some 20 MB); an item whose own terms are more has a block of its own.
BLOCK_TERMS = 50_000
CHUNK = 2 << 20
#: Scores (documents times items) and single additions that a scoring step holds.
STEP_SCORES, STEP_ADDITIONS = 1 << 21, 1 << 22
_BLANK = 0x20
_FOLDED = LOWER.copy()
_FOLDED[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = _BLANK


def terms(text) -> F.Column:
    """All terms of a text, in order, with repeats; none of null."""
    folded = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER_CASE, LOWER_CASE)
    return F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))


def _item_blocks(item_terms: DataFrame, most: int) -> Iterator[tuple[list, dict[str, int], list[tuple[int, int]]]]:
    """(items, number of each term, (term, item) numbers) of successive blocks of whole items."""
    items, numbers, pairs, own = [], {}, [], []

    def add():
        items.append(own[0]["item_id"])
        pairs.extend((numbers.setdefault(r["term"], len(numbers)), len(items) - 1) for r in own)

    for r in item_terms.orderBy("item_id", "term").toLocalIterator():
        if own and own[0]["item_id"] != r["item_id"]:
            add()
            own = []
            if len(numbers) >= most:
                yield items, numbers, pairs
                items, numbers, pairs = [], {}, []
        own.append(r)
        if len(own) + len(numbers) > most and items:
            yield items, numbers, pairs
            items, numbers, pairs = [], {}, []
    if own:
        add()
    if items:
        yield items, numbers, pairs


def _automaton(words) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(words):
        found.add_word(f" {term.encode().decode('latin-1')} ", number)
    found.make_automaton()
    return found


def _scan(shared):
    def run(batches):
        automaton, number = shared.value, itemgetter(1)
        for batch in batches:
            # rows are told apart by their place, so an id may be null
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(1)], ["row", "text"])
            for row, buf, offsets in text_chunks([rows], "row", "text", CHUNK):
                folded = _FOLDED[buf]
                inside = folded != _BLANK
                first = inside.copy()
                first[1:] &= ~inside[:-1]
                starts = offsets[:-1][offsets[:-1] < len(buf)]
                first[starts] = inside[starts]
                n = np.diff(np.append(0, np.cumsum(first))[offsets])
                text, some = folded.tobytes().decode("latin-1"), np.flatnonzero(n)
                numbers, counts = [], []
                for d in some:
                    hits = np.fromiter(map(number, automaton.iter(f" {text[offsets[d] : offsets[d + 1]]} ")), np.int32)
                    which, often = np.unique(hits, return_counts=True)
                    numbers.append(which.astype("<i4").tobytes())
                    counts.append(often.astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[some])), pa.array(n[some]), pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "n", "terms", "counts"])

    return run


def _frequencies(n_terms: int):
    """How many documents of a task hold each term."""

    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i4"), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], ["term", "df"])

    return run


def best_of(group: np.ndarray, score: np.ndarray, who: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` highest scores of each group, ties to smaller ids."""
    order = np.lexsort((who, -score, group))
    group, score, who = group[order], score[order], who[order]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    place = np.arange(len(group)) - np.maximum.accumulate(np.where(new, np.arange(len(group)), 0))
    return group[place < k], score[place < k], who[place < k]


def _score(shared, k: int):
    def run(batches):
        items, weight, item_of, first, n_docs, n_terms = shared.value
        n_items = len(items)
        each = np.diff(first)
        held = [np.zeros(0, np.int64)] * 3
        floor = np.ones(n_items, np.int64)
        for batch in batches:
            doc_id, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            term = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i4").astype(np.int64)
            tf = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4").astype(np.int64)
            size = np.array([len(x) // 4 for x in batch.column(2).to_pylist()], np.int64)
            m = 50 + (50 * n * n_docs) // n_terms
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size)))
            begin = np.append(0, np.cumsum(size))
            additions = np.append(0, np.cumsum(each[term]))[begin]
            lo = 0
            while lo < len(doc_id):
                hi = min(lo + max(1, STEP_SCORES // n_items), int(np.searchsorted(additions, additions[lo] + STEP_ADDITIONS, "right")) - 1, len(doc_id))
                hi = max(hi, lo + 1)
                mine = slice(begin[lo], begin[hi])
                count, of = each[term[mine]], np.repeat(np.arange(hi - lo), size[lo:hi])
                at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[term[mine]], count)
                scores = np.zeros((hi - lo) * n_items, np.int64)
                np.add.at(scores, np.repeat(of, count) * n_items + item_of[at], np.repeat(value[mine], count))
                scores = scores.reshape(-1, n_items)
                # what is below the k-th of this step, or of those before, is no candidate
                least = np.maximum(floor, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k]) if len(scores) >= k else floor
                row, item = np.nonzero(scores >= least)
                held = best_of(*[np.concatenate(x) for x in zip(held, (item, scores[row, item], doc_id[lo + row]), strict=True)], k)
                full, counted = np.unique(held[0], return_counts=True)
                last = np.cumsum(counted) - 1
                floor[full[counted == k]] = held[1][last[counted == k]]
                lo = hi
        yield pa.RecordBatch.from_arrays([pa.array(items[held[0]], pa.int64()), pa.array(held[2], pa.int64()), pa.array(held[1], pa.int64())], ["item_id", "doc_id", "score"])

    return run


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 of each item, ties to smaller ids.

    Every row of ``docs`` is a document: repeated rows count and are ranked each, a row with a null id
    counts in all statistics but is not ranked, null and empty texts have no term and count nowhere.
    Items with a null id or without terms find nothing; rows of one item are one item of all their
    terms. Empty tables give no row. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    wanted = items.filter(F.col(item_col).isNotNull()).select(F.col(item_col).cast("long").alias("item_id"), F.explode(terms(F.col(item_text_col))).alias("term")).distinct()
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text <> ''")
    out, kinds = None, "item_id long, doc_id long, score long"
    for item_ids, numbers, pairs in _item_blocks(materialise(wanted), block_terms):
        automaton = spark.sparkContext.broadcast(_automaton(numbers))
        counted = materialise(source.mapInArrow(tidy(_scan(automaton)), "doc_id long, n long, terms binary, counts binary"))
        automaton.destroy()
        n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(numbers), np.int64)
        for r in counted.select("terms").mapInArrow(_frequencies(len(numbers)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # at most one row a term
            df[r["term"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        pair = np.array(sorted(pairs), np.int64)
        tables = spark.sparkContext.broadcast((np.array(item_ids, np.int64), weight, pair[:, 1], np.searchsorted(pair[:, 0], np.arange(len(numbers) + 1)), n_docs, n_terms))
        found = counted.filter("doc_id is not null").mapInArrow(tidy(_score(tables, k)), kinds)
        place = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
        ranked = materialise(found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
        tables.destroy()
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


def op13_lexical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
