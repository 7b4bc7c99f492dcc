"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction. For a cluster with centre c and widest angle w, a candidate x at
angle t from c scores at most |a| |x| cos(max(0, t - w)) with any member a. Candidates are sorted by
this bound once for each cluster; every member walks that list, a strip at a time, and stops where
the bound falls below its floor: no later candidate can count. Floors are the scores that a member
holds or needs, so the walk is exact.

Candidates stay where they are, in chunks of a task, each with its own list; anchors come in blocks of
a bounded size that are broadcast. A first walk over one row in 64, chosen by hash, gives floors for
the walk over all rows, so that tasks report few rows that others beat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.llm.common import materialise, table, tidy

#: Anchors of one broadcast block and of a cluster on average; components of a block (32 MB).
BLOCK, MEMBERS, BLOCK_NUMBERS = 4096, 64, 4 << 20
#: Candidates of a list and of a strip; components of a chunk (64 MB).
CHUNK, STRIP, CHUNK_NUMBERS = 8192, 1024, 8 << 20
#: One row in so many is walked first.
FIRST = 64
#: Angles are right to about 3e-8; bounds are widened by more.
_SLACK = 1e-7
#: Scaled components from which on a vector is left out: 64 bits do not hold them.
_MOST = float(1 << 62)
_FOUND = "asked int, vec_id long, score long"


def integer_vectors(df: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id, label, v (floor(scale * x)) of the rows that take part."""
    bad = F.exists(F.col(vec_col), lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double") * scale) >= _MOST))
    good = df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).filter(~bad)
    return good.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.transform(F.col(vec_col), lambda e: F.floor(e.cast("double") * scale)).alias("v"))


def integer_matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Rows of 64-bit integers; missing components are zero."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _norms(v: np.ndarray) -> np.ndarray:
    return np.sqrt((v.astype(np.float64) ** 2).sum(1))


def _directions(v: np.ndarray) -> np.ndarray:
    n = _norms(v)
    return v / np.where(n > 0, n, 1)[:, None]


def products(x: np.ndarray, a: np.ndarray, x_norm: np.ndarray, a_norm: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles where no sum reaches 2**53, in 64 bits below 2**62, else in whole numbers of any size; the nearest that 64 bits hold."""
    most = float(a_norm.max(initial=0))
    if most * x_norm.max(initial=0) < 2.0**52:
        return (x.astype(np.float64) @ a.astype(np.float64).T).astype(np.int64)
    out = x @ a.T
    large = np.flatnonzero(x_norm * most >= 2.0**62)
    if len(large):
        limit = np.iinfo(np.int64)
        out[large] = np.clip(x[large].astype(object) @ a.T.astype(object), limit.min, limit.max).astype(np.int64)
    return out


class Block:
    """Anchors in the order of their clusters, with each cluster's centre and widest angle."""

    def __init__(self, rows: list, dim: int) -> None:
        v = np.zeros((len(rows), dim), np.int64)
        for i, r in enumerate(rows):
            v[i, : len(r["v"])] = r["v"]
        unit = _directions(v)
        centre = unit[np.linspace(0, len(rows) - 1, -(-len(rows) // MEMBERS)).astype(int)]
        for _ in range(4):
            of = (unit @ centre.T).argmax(1)
            total = np.zeros_like(centre)
            np.add.at(total, of, unit)
            some = (total != 0).any(1)
            centre[some] = _directions(total[some])
        of = (unit @ centre.T).argmax(1)
        order = np.argsort(of, kind="stable")
        self.ids = np.array([r["vec_id"] for r in rows], np.int64)[order]
        self.labels = np.array([r["label"] for r in rows], np.int64)[order]
        self.v, self.norm, of = v[order], _norms(v)[order], of[order]
        angle = np.arccos(np.clip((unit[order] * centre[of]).sum(1), -1, 1))
        angle[self.norm == 0] = 0  # such a member scores 0, whatever its direction
        self.clusters = [(int(lo), int(hi), centre[of[lo]], float(angle[lo:hi].max())) for lo, hi in zip(*[x.tolist() for x in (np.searchsorted(of, np.unique(of)), np.searchsorted(of, np.unique(of), "right"))], strict=True)]


def kept_of(asked: np.ndarray, score: np.ndarray, who: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` first by score, ties by id, of each that asks; a row that comes twice counts once."""
    order = np.lexsort((who, -score, asked))
    asked, score, who = asked[order], score[order], who[order]
    new = np.ones(len(asked), bool)
    new[1:] = (asked[1:] != asked[:-1]) | (who[1:] != who[:-1]) | (score[1:] != score[:-1])
    asked, score, who = asked[new], score[new], who[new]
    first = np.searchsorted(asked, asked)
    place = np.arange(len(asked)) - first
    return asked[place < k], score[place < k], who[place < k]


def _walk(shared, k: int, dim: int):
    """Rows (asked, vec_id, score): the first ``k`` within [low, high] of each asking pair (anchor, low, high) of a block."""

    def run(batches):
        block, of, low, high, same_label = shared.value
        floor = low.copy()
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        def take(ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
            nonlocal held
            norm, unit = _norms(x), _directions(x)
            for lo, hi, centre, widest in block.clusters:
                mine = np.arange(*np.searchsorted(of, [lo, hi]))
                if not len(mine):
                    continue
                apart = np.maximum(np.arccos(np.clip(unit @ centre, -1, 1)) - widest, 0)
                bound = norm * np.cos(apart) + norm * _SLACK
                listed = np.argsort(-bound, kind="stable")
                for at in range(0, len(listed), STRIP):
                    strip = listed[at : at + STRIP]
                    mine = mine[block.norm[of[mine]] * bound[strip[0]] + 1 >= floor[mine]]
                    if not len(mine):
                        break  # certified: nothing further down can count for any member
                    anchors = np.unique(of[mine])
                    scores = products(x[strip], block.v[anchors], norm[strip], block.norm[anchors])[:, np.searchsorted(anchors, of[mine])]
                    alike = labels[strip][:, None] == block.labels[of[mine]][None]
                    good = (scores >= floor[mine]) & (scores <= high[mine]) & (alike == same_label) & (ids[strip][:, None] != block.ids[of[mine]][None])
                    row, column = np.nonzero(good)
                    if not len(row):
                        continue
                    held = kept_of(*[np.concatenate(z) for z in zip(held, (mine[column], scores[row, column], ids[strip[row]]), strict=True)], k)
                    who, count = np.unique(held[0], return_counts=True)
                    full = count == k
                    floor[who[full]] = held[1][np.cumsum(count) - 1][full]

        rows = max(1, min(CHUNK, CHUNK_NUMBERS // dim))
        waiting, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                part = batch.slice(lo, rows)
                waiting.append((part.column(0).to_numpy(), part.column(1).to_numpy(), integer_matrix(part.column(2), dim)))
                n += part.num_rows
                if n >= rows:
                    take(*[np.concatenate(z) for z in zip(*waiting, strict=True)])
                    waiting, n = [], 0
        if waiting:
            take(*[np.concatenate(z) for z in zip(*waiting, strict=True)])
        yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int32()), pa.array(held[2]), pa.array(held[1])], ["asked", "vec_id", "score"])

    return run


def _blocks(anchors: DataFrame, size: int) -> Iterator[list]:
    block = []
    for r in anchors.orderBy("label", "vec_id", F.xxhash64("v")).toLocalIterator():
        block.append(r)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def _first(found: DataFrame, k: int) -> DataFrame:
    """asked, rank, vec_id, score: the ``k`` first of what all tasks report."""
    place = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)


def _search(vectors: DataFrame, block: Block, dim: int, of: np.ndarray, low: np.ndarray, high: np.ndarray, same_label: bool, k: int) -> DataFrame:
    """asked, rank, vec_id, score of all asking pairs of a block, after a first walk that raises their floors."""
    spark, kept = vectors.sparkSession, None
    for rows in (vectors.filter(F.pmod(F.xxhash64("vec_id"), F.lit(FIRST)) == 0), vectors):
        shared = spark.sparkContext.broadcast((block, of, low, high, same_label))
        kept = materialise(_first(rows.mapInArrow(tidy(_walk(shared, k, dim)), _FOUND), k))
        shared.destroy()
        low = low.copy()
        for r in kept.filter(F.col("rank") == k).select("asked", "score").collect():  # at most one row for each pair of a block
            low[r["asked"]] = r["score"]
    return kept


def hard_negatives(data: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: int = 256, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * x); higher ones come first, ties by id. An anchor's
    positives are its first other rows of its label; each positive has its first rows of another label
    with low * positive <= 100 * score <= high * positive (percent). ``is_anchor`` is a condition on vec_id and label.

    Rows with a null id, label, vector or component, or a non-finite one, take no part, nor those with a scaled component
    from 2**62 on. A product that 64 bits do not hold is the nearest that they do. Missing components of shorter vectors are zero. A row
    equal to another in id, label and vector counts once; an anchor's own id is never among its
    results. Empty tables give no row. Other columns are not read.
    """
    spark = data.sparkSession
    vectors = materialise(integer_vectors(data, id_col, label_col, vec_col, scale))
    dim = vectors.agg(F.max(F.size("v"))).first()[0]
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if dim is None:
        return spark.createDataFrame([], kinds)
    dim, out = max(dim, 1), None
    asking = vectors.filter(is_anchor).dropDuplicates(["vec_id", "label", "v"])
    least, largest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    for rows in _blocks(asking, max(1, min(block, BLOCK_NUMBERS // dim))):
        anchors = Block(rows, dim)
        n = len(anchors.ids)
        near = sorted(_search(vectors, anchors, dim, np.arange(n), np.full(n, least), np.full(n, largest), True, positives).collect(), key=lambda r: (r["asked"], r["rank"]))  # ``positives`` rows an anchor of one block
        near = [r for r in near if r["score"] >= 0]  # below 0 no score lies between
        if not near:
            continue
        of, score = np.array([r["asked"] for r in near], np.int64), [r["score"] for r in near]
        bottom = np.array([-(-low * s // 100) for s in score], np.int64)
        top = np.array([min(high * s // 100, largest) for s in score], np.int64)
        found = _search(vectors, anchors, dim, of, bottom, top, False, negatives)
        pairs = spark.createDataFrame([(i, int(anchors.ids[r["asked"]]), r["vec_id"], r["score"]) for i, r in enumerate(near)], "asked int, anchor_id long, positive_id long, positive_score long")
        mined = found.join(F.broadcast(pairs), "asked").select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = mined if out is None else out.unionByName(mined)
    return out if out is not None else spark.createDataFrame([], kinds)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five negatives of each of the five positives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)
