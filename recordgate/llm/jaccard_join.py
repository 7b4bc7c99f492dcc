"""N-gram Jaccard join in the Jaccard metric space, exact, for the classes of equal shingle sets.

1. Equal sets form a class; its least document stands for it from here on.
2. Coarse cells. In Jaccard space unrelated texts all lie at distance one of every pivot, so pivots
   alone would copy each of them everywhere. Sets of one size class are therefore first cut into
   more pieces (by shingle hash) than two linked sets can differ in: linked sets agree on a whole
   piece. Documents that agree on a piece share a cell; cells connect to coarse components. Only
   pieces that a count-min sketch estimates as repeated are shuffled.
3. Metric join in each coarse component. Pivots make Voronoi regions; a document goes to its nearest
   pivot and, by the triangle inequality, to every pivot within twice the radius of that distance;
   regions join recursively. Documents within the radius of a pivot are linked to it, and regions
   whose members are connected already are not split further. Components too large for a task
   are split by the same rule in Spark rounds, slice by slice; a split must
   cost fewer pairs than it saves, else what lies outside the region's largest connected part is
   compared, in blocks, with all members that share one of its rarest shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordgate.llm import count_min
from recordgate.llm.common import give_back, groups, materialise, mix, semi_join_by_size, shingle_sets, small_batches, table, text_chunks, tidy
from recordgate.llm.components import connected_components

CHUNK = 1 << 20
#: Bytes of keys that a task works on at once.
KEY_CHUNK = 2 << 20
#: Radius of the join as a fraction: links have 100 * intersection >= 80 * union.
PERCENT = 80
RADIUS = 1 - PERCENT / 100
#: Documents of a region that one task joins in memory.
LEAF = 4096
PIVOTS = 8
#: Bytes of shingles of such a region: a few long texts fill a task as well.
LEAF_BYTES = 24 << 20
#: A split must pay: no child with this share of its parent, children of at most this multiple of it in all, and at
#: most this share of its pairs (so all levels together never compare more pairs than the region has).
STUCK, SPREAD, PAIRS = 0.9, 1.5, 0.75
#: Documents and bytes of a slice of a larger region.
SLICE, SLICE_BYTES = 2048, 12 << 20
#: Members beyond which one set is compared with a region by counting its shingles there.
MANY = 64
#: Shingles that a comparison gathers at once.
WORK = 300_000


def _hash(values: np.ndarray, salt: int) -> np.ndarray:
    return mix(values ^ np.uint64(salt))


def _pieces(n: int) -> tuple[int, int]:
    """Size class of ``n`` and whether larger partners reach the next class."""
    c = int(n).bit_length() - 1
    return c, n * 100 // PERCENT >= 1 << (c + 1)


def piece_keys(owner: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, np.ndarray]]]:
    """(size class, need, keys of the nonempty pieces) of each set, for its own size class and, near its end, the next.

    With sizes a and b, linked sets differ in at most (a + b) / 9 shingles, so at most that many
    pieces differ: all nonempty pieces but that number (``need``) have an equal piece elsewhere, or
    the set is linked with nothing. A set that fills no more pieces than that (small ones, by
    chance) also gives each of its shingles as a key; a linked set that shares no piece with it does
    too, and they share at least 0.8 of them.
    """
    out: list[list[tuple[int, int, np.ndarray]]] = [[] for _ in sizes]
    slots, of, classes, differs = [], [], [], []
    for i, n in enumerate(sizes.tolist()):
        if n < 4:  # only an equal set is near enough
            continue
        c, up = _pieces(n)
        for k in (c, c + 1) if up else (c,):
            top = (1 << (k + 1)) - 1
            most = 2 * top // 9
            slots.append(most + most // 2 + 2)
            of.append(i)
            classes.append(k)
            differs.append((n + min(top, n * 100 // PERCENT)) // 9)
    if not of:
        return out
    slots, of = np.array(slots), np.array(of)
    first = np.searchsorted(owner, np.arange(len(sizes) + 1))
    count = np.diff(first)[of]
    which = np.repeat(np.arange(len(of)), count)
    at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[of][which]
    v = value[at]
    base = np.cumsum(slots) - slots
    slot = (_hash(v, 0x1B873593CC9E2D51) % slots[which].astype(np.uint64)).astype(np.int64)
    place = base[which] + slot
    order = np.argsort(place, kind="stable")
    place, which, slot = place[order], which[order], slot[order]
    starts = np.flatnonzero(np.diff(place, prepend=-1))
    content = np.add.reduceat(_hash(v, 0x38B34AE5A1E38B93)[order], starts)
    which, slot = which[starts], slot[starts]
    key = mix(content + (np.array(classes)[which].astype(np.uint64) << np.uint64(40)) * np.uint64(0x9E3779B97F4A7C15) + slot.astype(np.uint64))
    for lo, hi in groups(which):
        e = which[lo]
        out[of[e]].append((classes[e], max(1, hi - lo - differs[e]), key[lo:hi]))
        if hi - lo <= differs[e]:
            mine = value[first[of[e]] : first[of[e] + 1]]
            out[of[e]].append((-classes[e], -(-len(mine) * PERCENT // 100), _hash(mine, 0x61C8864680B583EB + classes[e])))
    return out


FEATURES = "doc_id long, n_shingles long, s1 long, s2 long, keys binary, parts array<int>"
FEATURE_NAMES = ["doc_id", "n_shingles", "s1", "s2", "keys", "parts"]


def _features(batches):
    for ids, buf, offsets in text_chunks(batches, "doc_id", "text", CHUNK):
        owner, value = shingle_sets(buf, offsets)
        first = np.searchsorted(owner, np.arange(len(ids) + 1))
        n = np.diff(first)
        sums = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            total = np.zeros(len(value) + 1, np.uint64)
            np.cumsum(_hash(value, salt), out=total[1:])
            sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
        keys = piece_keys(owner, value, n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *map(pa.array, sums), pa.array([np.concatenate([x[2] for x in k]).tobytes() if k else b"" for k in keys], pa.binary()), pa.array([[y for c, need, x in k for y in (c, need, len(x))] for k in keys], pa.list_(pa.int32()))],
            FEATURE_NAMES,
        )


def _sketch_keys(bits: int):
    def run(batches):
        for _, buf, _ in text_chunks(batches, "doc_id", "keys", KEY_CHUNK):
            yield count_min.sketch(buf.view(np.uint64), bits)

    return run


def _repeated_keys(bits: int, shared):
    """Keys estimated as repeated, of the sets that have as many as a linked set needs."""

    def run(batches):
        for b in batches:
            at, column = 0, b.column(b.schema.get_field_index("parts"))
            for ids, buf, _ in text_chunks([b], "doc_id", "keys", KEY_CHUNK):
                parts = column.slice(at, len(ids)).to_pylist()
                at += len(ids)
                keys = buf.view(np.uint64)
                triples = np.array([x for p in parts for x in p], np.int64).reshape(-1, 3)
                rep = np.repeat(ids, [len(p) // 3 for p in parts])
                which = np.repeat(np.arange(len(triples)), triples[:, 2])
                keep = count_min.repeated(shared.value, keys, bits)
                enough = np.bincount(which[keep], minlength=len(triples)) >= triples[:, 1]
                keep &= enough[which]
                which = which[keep]
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(rep[which], pa.int64()), pa.array(triples[which, 0], pa.int32()), pa.array(triples[which, 1], pa.int32())], ["key", "rep", "size_class", "need"])

    return run


def _held_elsewhere(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.min("rep").alias("dst"), F.max("rep").alias("most")).filter("dst < most").select("key", "dst")


def _with_enough(rows: DataFrame) -> DataFrame:
    """Rows of the sets that share as many keys with others as a linked set must."""
    met = rows.join(_held_elsewhere(rows), "key").groupBy("rep", "size_class").agg(F.count("*").alias("n"), F.max("need").alias("need")).filter("n >= need")
    return materialise(rows.join(met.select("rep", "size_class"), ["rep", "size_class"], "left_semi"))


def _rarest(rows: DataFrame) -> DataFrame:
    """Rows without the ``need - 1`` most frequent keys of each set.

    Two linked sets share ``need`` keys, so one of these is left to both. What frequent passages
    have in common with everything no longer connects what is otherwise apart.
    """
    often = rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    of_set = Window.partitionBy("rep", "size_class")
    ranked = rows.join(often, "key").withColumn("rank", F.row_number().over(of_set.orderBy("n", "key"))).withColumn("total", F.count("*").over(of_set))
    return materialise(ranked.filter("rank <= total - need + 1").select("key", "rep"))


def _sets(batches):
    for b in batches:
        at, regions = 0, b.column(b.schema.get_field_index("region"))
        for ids, buf, offsets in text_chunks([b], "doc_id", "text", CHUNK):
            owner, value = shingle_sets(buf, offsets)
            first = np.searchsorted(owner, np.arange(len(ids) + 1))
            yield pa.RecordBatch.from_arrays([regions.slice(at, len(ids)), pa.array(ids, pa.int64()), pa.array([value[first[i] : first[i + 1]].tobytes() for i in range(len(ids))], pa.binary())], ["region", "rep", "shingles"])
            at += len(ids)


# --- the metric join of one region --------------------------------------------------------------


class _Sets:
    def __init__(self, packed: list[bytes]):
        self.size = np.array([len(p) // 8 for p in packed], np.int64)
        self.value = np.frombuffer(b"".join(packed), np.uint64)
        self.start = np.cumsum(self.size) - self.size
        self.compared = 0

    def common(self, one: np.ndarray, members: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of the set ``one`` with each member, some members at a time."""
        stop = np.cumsum(self.size[members])
        if len(members) > 1 and stop[-1] > WORK:
            cut = min(max(1, int(np.searchsorted(stop, WORK, "right"))), len(members) - 1)
            parts = []
            while len(members):
                parts.append(self.common(one, members[:cut]))
                members = members[cut:]
                cut = max(1, int(np.searchsorted(np.cumsum(self.size[members]), WORK, "right")))
            return np.concatenate(parts)
        count = self.size[members]
        at = np.arange(count.sum()) + np.repeat(self.start[members] - (np.cumsum(count) - count), count)
        v = self.value[at]
        place = np.minimum(np.searchsorted(one, v), len(one) - 1)
        hit = np.concatenate([[0], np.cumsum(one[place] == v)])
        stop = np.cumsum(count)
        return hit[stop] - hit[stop - count]

    def of(self, i: int) -> np.ndarray:
        return self.value[self.start[i] : self.start[i] + self.size[i]]

    def compare(self, i: int, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distance of each member to set ``i``, and whether it is linked."""
        self.compared += len(members)
        both = self.common(self.of(i), members)
        union = self.size[i] + self.size[members] - both
        return 1 - both / union, 100 * both >= PERCENT * union


class _Union:
    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: int, members: np.ndarray) -> None:
        labels = np.unique(np.append(self.label[members], self.label[i]))
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def connected(self, members: np.ndarray) -> bool:
        return len(np.unique(self.label[members])) < 2


def pays(children: np.ndarray, parent: int) -> bool:
    """Whether child regions of these sizes are less work than their parent."""
    return children.max() < STUCK * parent and children.sum() <= SPREAD * parent and (children.astype(float) ** 2).sum() <= PAIRS * float(parent) ** 2


def metric_components(packed: list[bytes], pivots: int = PIVOTS, leaf: int = 128) -> np.ndarray:
    """Label of each set: the least index it is linked with, directly or through others."""
    return join_region(packed, pivots, leaf)[0]


def join_region(packed: list[bytes], pivots: int = PIVOTS, leaf: int = 128) -> tuple[np.ndarray, int]:
    """As ``metric_components``, and the number of distances computed."""
    sets, union = _Sets(packed), _Union(len(packed))
    stack = [(np.arange(len(packed)), 0)]
    while stack:
        members, depth = stack.pop()
        if len(members) < 2 or union.connected(members):
            continue
        if len(members) <= leaf:
            _all_pairs(sets, union, members)
            continue
        # one pivot of each part that is still apart, largest parts first, then members at random
        order = np.argsort(mix(members.astype(np.uint64) + np.uint64(depth * 7919)))
        shuffled = members[order]
        _, apart = np.unique(union.label[shuffled], return_index=True)
        chosen = shuffled[np.sort(apart)[:pivots]]
        chosen = np.unique(np.concatenate([chosen, shuffled[: max(0, pivots - len(chosen))]]))
        far = np.empty((len(chosen), len(members)))
        for k, p in enumerate(chosen):
            far[k], linked = sets.compare(p, members)
            union.join(p, members[linked])
        if union.connected(members):
            continue
        nearest = far.min(0)
        inside = far <= nearest + 2 * RADIUS + 1e-9
        if pays(inside.sum(1), len(members)):
            stack += [(members[near], depth + 1) for near in inside]
        else:
            _rest_against_all(sets, union, members)
    return union.label, sets.compared


def _all_pairs(sets: _Sets, union: _Union, members: np.ndarray) -> None:
    for at, i in enumerate(members[:-1]):
        rest = members[at + 1 :]
        rest = rest[(union.label[rest] != union.label[i]) & (100 * np.minimum(sets.size[rest], sets.size[i]) >= PERCENT * np.maximum(sets.size[rest], sets.size[i]))]
        if len(rest):
            _, linked = sets.compare(i, rest)
            union.join(i, rest[linked])


def _rest_against_all(sets: _Sets, union: _Union, members: np.ndarray) -> None:
    """A region that pivots do not split: its members outside the largest part against all others."""
    labels, count = np.unique(union.label[members], return_counts=True)
    largest = labels[count.argmax()]
    _some_against_all(sets, union, members[union.label[members] != largest], members)


def _some_against_all(sets: _Sets, union: _Union, some: np.ndarray, members: np.ndarray) -> None:
    """Links between ``some`` and ``members`` that join parts.

    Linked sets share a shingle among the first ``n - ceil(0.8 n) + 1`` of each in any common
    order; in the order of rarity among ``members`` few others do. Only those are compared.
    """
    if not len(some) or not len(members):
        return
    held, counted = _Prefixes(sets, members), None
    done = np.zeros(len(sets.size), bool)
    for i in some:
        at = held.near(sets.of(i))
        # of two that are both in ``some``, the first meets the second
        at = at[~done[members[at]] & (union.label[members[at]] != union.label[i])]
        done[i] = True
        other = members[at]
        fit = 100 * np.minimum(sets.size[other], sets.size[i]) >= PERCENT * np.maximum(sets.size[other], sets.size[i])
        at, other = at[fit], other[fit]
        if len(other) > MANY:  # its rarest shingles are frequent ones: count all its shingles in one pass
            counted = counted or _Postings(sets, members)
            both = counted.common(sets.of(i))[at]
            sets.compared += len(other)
            union.join(i, other[100 * both >= PERCENT * (sets.size[i] + sets.size[other] - both)])
        elif len(other):
            _, linked = sets.compare(i, other)
            union.join(i, other[linked])


def _prefix_sizes(n: np.ndarray) -> np.ndarray:
    return n - -(-n * PERCENT // 100) + 1


class _Prefixes:
    """Members of a region by the rarest shingles of each."""

    def __init__(self, sets: _Sets, members: np.ndarray):
        count = sets.size[members]
        at = np.arange(count.sum()) + np.repeat(sets.start[members] - (np.cumsum(count) - count), count)
        value = sets.value[at]
        self.known, back, often = np.unique(value, return_inverse=True, return_counts=True)
        # the place of each shingle in the common order: the rarest first, ties by hash
        self.place = np.empty(len(often), np.int64)
        self.place[np.argsort(often, kind="stable")] = np.arange(len(often))
        who = np.repeat(np.arange(len(members)), count)
        place = self.place[back]
        order = np.lexsort((place, who))
        step = np.arange(len(order)) - np.repeat(np.cumsum(count) - count, count)
        first = step < np.repeat(_prefix_sizes(count), count)
        who, place = who[order][first], place[order][first]
        by = np.argsort(place, kind="stable")
        self.place_of, self.who = place[by], who[by]

    def near(self, one: np.ndarray) -> np.ndarray:
        """Indices of the members whose rarest shingles meet those of the set ``one``."""
        at = np.minimum(np.searchsorted(self.known, one), len(self.known) - 1)
        # shingles that no member has come before all others
        place = np.sort(np.where(self.known[at] == one, self.place[at], -1))[: int(_prefix_sizes(np.array([len(one)]))[0])]
        place = place[place >= 0]
        lo, hi = np.searchsorted(self.place_of, place, "left"), np.searchsorted(self.place_of, place, "right")
        return np.unique(np.concatenate([self.who[a:b] for a, b in zip(lo, hi, strict=True)])) if len(place) else np.zeros(0, np.int64)


class _Postings:
    """Members of a region by shingle, for comparisons with very many of them."""

    def __init__(self, sets: _Sets, members: np.ndarray):
        count = sets.size[members]
        at = np.arange(count.sum()) + np.repeat(sets.start[members] - (np.cumsum(count) - count), count)
        order = np.argsort(sets.value[at], kind="stable")
        self.value = sets.value[at][order]
        self.who = np.repeat(np.arange(len(members), dtype=np.int32), count)[order]
        self.n = len(members)

    def common(self, one: np.ndarray) -> np.ndarray:
        """Size of the intersection of the set ``one`` with each member."""
        lo = np.searchsorted(self.value, one, "left")
        count = np.searchsorted(self.value, one, "right") - lo
        stop = np.cumsum(count)
        total, first = np.zeros(self.n, np.int64), 0
        while first < len(one):
            done = stop[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(stop, done + WORK, "right")))
            c = count[first:last]
            at = np.arange(c.sum()) + np.repeat(lo[first:last] - (np.cumsum(c) - c), c)
            total += np.bincount(self.who[at], minlength=self.n)
            first = last
        return total


EDGES = "src long, dst long"


def _leaf(t: pa.Table) -> pa.Table:
    rep = t.column("rep").to_numpy()
    order = np.argsort(rep, kind="stable")
    packed = t.column("shingles").to_pylist()
    label = metric_components([packed[i] for i in order])
    rep = rep[order]
    linked = label != np.arange(len(label))
    if t.nbytes > LEAF_BYTES // 8:
        give_back()
    return pa.table({"src": pa.array(rep[linked], pa.int64()), "dst": pa.array(rep[label[linked]], pa.int64())})


# --- regions beyond one task --------------------------------------------------------------------


def _assign(members: pa.Table, pivots: pa.Table) -> pa.Table:
    """Links of one slice of a region to its pivots, and the regions that its members go to."""
    src, dst, region, rep = [], [], [], []
    if members.num_rows and pivots.num_rows:
        home, of_pivot = members.column("region")[0].as_py(), pivots.column("rep").to_pylist()
        ids = members.column("rep").to_numpy()
        sets = _Sets(members.column("shingles").to_pylist())
        far, everyone = np.empty((len(of_pivot), len(ids))), np.arange(len(ids))
        for k, packed in enumerate(pivots.column("shingles").to_pylist()):
            one = np.frombuffer(packed, np.uint64)
            both = sets.common(one, everyone)
            union = len(one) + sets.size - both
            far[k] = 1 - both / union
            linked = ids[100 * both >= PERCENT * union]
            src.append(linked)
            dst.append(np.full(len(linked), of_pivot[k]))
        for k, near in enumerate(far <= far.min(0) + 2 * RADIUS + 1e-9):
            region += [f"{home}/{of_pivot[k]}"] * int(near.sum())
            rep.append(ids[near])
    src, dst, rep = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (src, dst, rep))
    n, m = len(src), len(rep)
    home = members.column("region")[0].as_py() if members.num_rows else None
    return pa.table(
        {"parent": pa.array([home] * (n + m), pa.string()), "region": pa.array([None] * n + region, pa.string()), "rep": pa.array(np.concatenate([src, rep])), "dst": pa.array([*dst.tolist(), *[None] * m], pa.int64())}
    )


def _rest_with_slice(rest: pa.Table, members: pa.Table) -> pa.Table:
    """Links between some members of a region and one slice of it, but for those that are connected already."""
    n = rest.num_rows
    rep = np.concatenate([rest.column("rep").to_numpy(), members.column("rep").to_numpy()])
    label = np.concatenate([rest.column("component").to_numpy(), members.column("component").to_numpy()])
    sets, union = _Sets(rest.column("shingles").to_pylist() + members.column("shingles").to_pylist()), _Union(len(rep))
    _, first, which = np.unique(label, return_index=True, return_inverse=True)
    union.label = first[which]
    known = union.label.copy()
    _some_against_all(sets, union, np.arange(n), np.arange(n, len(rep)))
    # one link for each part that was joined to another
    new = np.unique(known[union.label != known])
    return pa.table({"src": pa.array(rep[new], pa.int64()), "dst": pa.array(rep[union.label[new]], pa.int64())})


def _n_slices(count: str, n_bytes: str):
    return F.greatest(F.ceil(F.col(count) / SLICE), F.ceil(F.col(n_bytes) / SLICE_BYTES), F.lit(1)).cast("int")


def _each(n):
    return F.explode(F.sequence(F.lit(0), n - 1))


def _dealt(n):
    return F.pmod(F.xxhash64("rep", F.lit(7)), n).cast("int")


def _grouped(rows: DataFrame, keys: list[str], columns: list[str]):
    """Groups of ``rows`` under attributes of their own, so that two sides with one source can meet."""
    return rows.select(*[F.col(c).alias(c) for c in [*keys, *columns]]).groupBy(*keys)


def _union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def _unsplit(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Links of regions that no pivot splits: what lies outside a region's largest part, in blocks, against all its slices."""
    known = materialise(members.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    of_part = known.groupBy("region", "component").agg(F.count("*").alias("n"), F.sum(F.octet_length("shingles")).alias("b"))
    shape = of_part.groupBy("region").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("count"), F.sum("b").alias("n_bytes"), F.max(F.struct("n", "component", "b")).alias("most"))
    shape = shape.select("region", "largest", _n_slices("count", "n_bytes").alias("n_slices"), (F.col("count") - F.col("most.n")).alias("rest"), (F.col("n_bytes") - F.col("most.b")).alias("rest_bytes"))
    shape = shape.filter("rest > 0").select("region", "largest", "n_slices", _n_slices("rest", "rest_bytes").alias("n_blocks"))
    known = known.join(shape, "region").select("region", "rep", "component", "shingles", "largest", "n_slices", "n_blocks")
    rest = known.filter("component <> largest").withColumn("block", _dealt(F.col("n_blocks"))).withColumn("slice", _each(F.col("n_slices")))
    every = known.withColumn("slice", _dealt(F.col("n_slices"))).withColumn("block", _each(F.col("n_blocks")))
    at, columns = ["region", "slice", "block"], ["rep", "component", "shingles"]
    return materialise(_grouped(rest, at, columns).cogroup(_grouped(every, at, columns)).applyInArrow(_rest_with_slice, EDGES))


def _split(members: DataFrame, leaf: int, rounds: int = 6) -> tuple[DataFrame, list[DataFrame]]:
    """Regions that a task can hold, and the links found on the way. Rounds run only while some region is larger."""
    links: list[DataFrame] = []
    small: list[DataFrame] = []
    for depth in range(rounds + 1):
        sizes = members.groupBy("region").agg(F.count("*").alias("count"), F.sum(F.octet_length("shingles")).alias("n_bytes"))
        large = materialise(sizes.filter((F.col("count") > leaf) | ((F.col("count") > 1) & (F.col("n_bytes") > LEAF_BYTES))).withColumn("n_slices", _n_slices("count", "n_bytes")))
        if not large.count():
            small.append(members)
            break
        small.append(members.join(large, "region", "left_anti"))
        mine = members.join(large, "region")
        share = F.pmod(F.xxhash64("rep", F.lit(depth)), F.col("count")) < 2 * PIVOTS
        least = mine.groupBy("region").agg(F.min("rep").alias("rep")).withColumn("least", F.lit(True))
        pivots = mine.join(least, ["region", "rep"], "left").filter(share | F.col("least").isNotNull()).withColumn("slice", _each(F.col("n_slices")))
        at, columns = ["region", "slice"], ["rep", "shingles"]
        sliced = _grouped(mine.withColumn("slice", _dealt(F.col("n_slices"))), at, columns)
        assigned = materialise(sliced.cogroup(_grouped(pivots, at, columns)).applyInArrow(_assign, "parent string, region string, rep long, dst long"))
        links.append(assigned.filter("region is null and rep <> dst").select(F.col("rep").alias("src"), "dst"))
        labels = connected_components(_union_all(links)).withColumnRenamed("node", "rep")
        children = assigned.filter("region is not null").select("parent", "region", "rep")
        shares = children.groupBy("parent", "region").agg(F.count("*").cast("double").alias("n")).groupBy(F.col("parent").alias("region"))
        widest = shares.agg(F.max("n").alias("widest"), F.sum("n").alias("spread"), F.sum(F.col("n") * F.col("n")).alias("pairs"))
        no_gain = (F.col("widest") >= STUCK * F.col("count")) | (F.col("spread") > SPREAD * F.col("count")) | (F.col("pairs") > PAIRS * F.col("count") * F.col("count"))
        judged = materialise(large.join(widest, "region").select("region", (F.lit(depth == rounds) | no_gain).alias("stuck")))
        links.append(_unsplit(members.join(judged.filter("stuck").select("region"), "region", "left_semi"), labels))
        going = children.join(judged.filter("not stuck").select(F.col("region").alias("parent")), "parent", "left_semi")
        labelled = going.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
        apart = labelled.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("region")
        kept = labelled.join(apart, "region", "left_semi").select("parent", "region", "rep").distinct()
        members = materialise(kept.join(members.select(F.col("region").alias("parent"), "rep", "shingles"), ["parent", "rep"]).select("region", "rep", "shingles"))
    return _union_all(small), links


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per row of ``docs``.

    component_id is the least id reachable by links of similarity 0.8 or more. Texts without words
    (null, empty) have no shingles and link with nothing. A null id takes no part: its component is
    null. Repeated rows are one document. Rows that share an id but not a text are judged by row.
    Empty tables give empty results; other columns are not read.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = source.filter("doc_id is not null")
    features = materialise(known.mapInArrow(tidy(_features), FEATURES))
    classes = features.filter("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = materialise(classes)
    reps = classes.filter("n_shingles >= 4").select(F.col("rep").alias("doc_id"))
    keyed = semi_join_by_size(features.select("doc_id", "keys", "parts"), reps, "doc_id")
    n_keys = keyed.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // 8
    bits = count_min.cell_bits(n_keys)
    shared = count_min.merge(keyed.select("doc_id", "keys").mapInArrow(tidy(_sketch_keys(bits)), count_min.SCHEMA), bits)
    rows = materialise(keyed.mapInArrow(tidy(_repeated_keys(bits, shared)), "key long, rep long, size_class int, need int"))
    shared.unpersist()
    rows = _rarest(_with_enough(rows))
    cells = rows.join(_held_elsewhere(rows), "key").filter("rep <> dst").select(F.col("rep").alias("src"), "dst").distinct()
    coarse = connected_components(cells)
    inside = coarse.select(F.col("node").alias("doc_id"), F.col("component").cast("string").alias("region"))
    texts = semi_join_by_size(known, inside.select("doc_id"), "doc_id")
    members = materialise(texts.join(inside, "doc_id").select("region", "doc_id", "text").mapInArrow(tidy(_sets), "region string, rep long, shingles binary"))
    regions, links = _split(members, leaf)
    edges = regions.groupBy("region").applyInArrow(_leaf, EDGES)
    labels = connected_components(_union_all([edges, *links]))
    of_class = classes.join(labels, F.col("rep") == F.col("node"), "left").select("s1", "s2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    judged = features.select("doc_id", "n_shingles", "s1", "s2").join(of_class, ["s1", "s2", "n_shingles"], "left")
    out = judged.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    unknown = source.filter("doc_id is null").select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "text").mapInArrow(_features, FEATURES)
    return out.unionByName(unknown.select(F.lit(None).cast("long").alias("doc_id"), "n_shingles", F.lit(None).cast("long").alias("component_id")))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
