"""Exact top-k by inner product with a paged M-tree, best first.

Inner products become distances by one more coordinate: with M the greatest norm, x' = (x,
sqrt(M^2 - |x|^2)) and q' = (q, 0), |q' - x'|^2 = |q|^2 + M^2 - 2 q.x. The tree has three levels: a root
over shards, shards over pages, pages over vectors. Every node has a routing vector, a covering
radius and its distance to its parent; a stored distance lets a search skip a node or a vector
without computing a distance, by the triangle inequality.

Shards are Spark groups of a bounded size: vectors go to their nearest routing vector, and a crowded
one (a third of all vectors may be equal) is salted into several shards. A query first searches its
nearest shard; its k-th score then excludes shards whose bound is lower, and only the others get it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.llm.common import materialise, table
from recordgate.llm.hard_negatives import integer_matrix, products

#: Vectors of a shard and of a page; routing vectors are a sample of at most MOST_ROUTES rows.
SHARD, PAGE, MOST_ROUTES = 4096, 128, 4096
#: Queries that one task searches together; pages of a query's list that are opened at once, after one, two and four of them.
QUERY_BLOCK, OPENED = 512, 8
#: Distances are right to about 2e-8 of the greatest norm; bounds are widened by more.
_SLACK = 1e-6
#: Scaled components from which on a vector is left out: 64 bits do not hold them.
_MOST = float(1 << 62)


def squared_norm(v) -> F.Column:
    return F.aggregate(v, F.lit(0.0), lambda a, e: a + F.pow(e.cast("double"), 2))


def clean_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """vec_id, v (array<long>: floor(scale * x)); vectors with null or non-finite components, or scaled ones from 2**62 on, are left out."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double") * scale) >= _MOST))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    good = df.filter(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(~bad)
    return good.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def _matrix(column, dim: int) -> np.ndarray:
    return integer_matrix(column, dim).astype(np.float64)


def _lift(v: np.ndarray, top: float) -> np.ndarray:
    """The metric form of data vectors."""
    return np.concatenate([v, np.sqrt(np.maximum(top - (v**2).sum(1), 0))[:, None]], 1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0))


def _route(routes: np.ndarray, names: np.ndarray, top: float, of_query: bool):
    """The nearest route of each vector, by name, and its distance."""
    dim = routes.shape[1] - 1

    def run(batches):
        for b in batches:
            v = _matrix(b.column(1), dim)
            lifted = np.concatenate([v, np.zeros((len(v), 1))], 1) if of_query else _lift(v, top)
            far = _distances(lifted, routes) if len(v) else np.zeros((0, len(routes)))
            near = far.argmin(1) if len(v) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names[near], pa.int64()), pa.array(far[np.arange(len(v)), near], pa.float64())], ["vec_id", "v", "route", "far"])

    return run


def _pages(routes: np.ndarray, top: float):
    """Pages of one shard: vectors in the order of a few routing vectors, cut into pages of bounded size."""

    def build(t: pa.Table) -> pa.Table:
        ids, whole = t.column("vec_id").to_numpy(), integer_matrix(t.column("v"), routes.shape[1] - 1)
        v = whole.astype(np.float64)
        parent = routes[t.column("route")[0].as_py()]
        lifted = _lift(v, top)
        parts, pages = [np.arange(len(ids))], []
        while parts:
            part = parts.pop()
            if len(part) <= PAGE:
                pages.append(part)
                continue
            # two far members route a split; equal members are cut in halves
            a = part[_distances(lifted[part], lifted[part[:1]])[:, 0].argmax()]
            b = part[_distances(lifted[part], lifted[a : a + 1])[:, 0].argmax()]
            d = _distances(lifted[part], lifted[[a, b]])
            side = d[:, 0] - d[:, 1]
            order = part[np.argsort(side, kind="stable")]
            cut = int((side < 0).sum())
            cut = cut if len(part) // 8 <= cut <= len(part) - len(part) // 8 else len(part) // 2
            parts += [order[:cut], order[cut:]]
        rows = []
        for n, page in enumerate(pages):
            router = lifted[page].mean(0)
            far = _distances(lifted[page], router[None])[:, 0]
            page, far = page[np.argsort(far)], np.sort(far)
            rows.append((t.column("shard")[0].as_py(), n, router.tobytes(), float(far[-1]), float(np.linalg.norm(router - parent)), ids[page].tobytes(), whole[page].tobytes(), far.tobytes()))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _NODE, strict=True)], schema=_NODE)

    return build


_NODE = pa.schema([("shard", pa.string()), ("page", pa.int32()), ("router", pa.binary()), ("radius", pa.float64()), ("to_parent", pa.float64()), ("ids", pa.binary()), ("vectors", pa.binary()), ("to_router", pa.binary())])
NODE = "shard string, page int, router binary, radius double, to_parent double, ids binary, vectors binary, to_router binary"


def _search(routes: np.ndarray, top: float, k: int):
    """Best-first search of one shard for a block of queries: up to k (query, vector, score) each."""

    def run(nodes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[np.ndarray, ...]] = []
        if not len(nodes) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        dim = len(np.frombuffer(nodes["router"].iloc[0])) - 1
        routers = np.stack([np.frombuffer(x) for x in nodes["router"]])
        ids, vectors, to_router = (np.frombuffer(b"".join(nodes[c]), k) for c, k in (("ids", np.int64), ("vectors", np.int64), ("to_router", np.float64)))
        vectors = vectors.reshape(-1, dim)
        doubles = vectors.astype(np.float64)
        norms = np.sqrt((doubles**2).sum(1))
        longest = norms.max(initial=0)
        size = np.array([len(x) // 8 for x in nodes["ids"]])
        rows_of = np.split(np.arange(len(ids)), np.cumsum(size)[:-1])
        radius, to_parent = nodes["radius"].to_numpy(), nodes["to_parent"].to_numpy()
        parent = routes[int(str(nodes["shard"].iloc[0]).split("/")[0])]
        for qid, q, floor in zip(queries["vec_id"], queries["v"], queries["floor"], strict=True):
            whole = np.zeros(dim, np.int64)
            whole[: len(q)] = q
            q = whole.astype(np.float64)
            lifted = np.append(q, 0.0)
            square = float(q @ q)
            norm, length = square + top, np.sqrt([square])
            slack = _SLACK * max(1.0, np.sqrt(norm))
            best_score, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
            least = None if floor is None or np.isnan(floor) else int(floor)

            def reach(least=least, norm=norm, slack=slack):
                return np.sqrt(max(norm - 2.0 * least, 0)) + slack if least is not None else np.inf

            from_parent = np.linalg.norm(lifted - parent)
            # stored distances first: no distance is computed for a page that they exclude
            open_ = np.flatnonzero(abs(from_parent - to_parent) - radius <= reach(least))
            to_page = np.linalg.norm(routers[open_] - lifted, axis=1)
            bound = np.maximum(to_page - radius[open_], 0)
            # doubles hold a product where no sum reaches 2**53
            small = length[0] * longest < 2.0**52
            listed, at, some = np.argsort(bound, kind="stable"), 0, 1
            while at < len(listed):
                limit = reach(least)
                opened = listed[at : at + some]
                opened = opened[bound[opened] <= limit]
                if not len(opened):
                    break
                at, some = at + some, min(2 * some, OPENED)
                pages = open_[opened]
                near = np.concatenate([rows_of[p] for p in pages])
                near = near[abs(np.repeat(to_page[opened], size[pages]) - to_router[near]) <= limit]
                score = (doubles[near] @ q).astype(np.int64) if small else products(vectors[near], whole[None], norms[near], length)[:, 0]
                good = ids[near] != qid if least is None else (score >= least) & (ids[near] != qid)
                best_score, best_id = np.concatenate([best_score, score[good]]), np.concatenate([best_id, ids[near[good]]])
                if len(best_score) > k:
                    order = np.lexsort((best_id, -best_score))[:k]
                    best_score, best_id = best_score[order], best_id[order]
                if len(best_score) >= k:
                    least = int(best_score.min()) if least is None else max(least, int(best_score.min()))
            out.append((np.full(len(best_id), qid), best_id, best_score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns, strict=True))).astype("int64")

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_FOUND = "query_id long, vec_id long, score long"


def top_k(data: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` greatest inner products of each query, ties to smaller ids.

    A query is never its own candidate. Null and empty vectors, those with null or non-finite components, and those
    with a scaled component from 2**62 on take no part; a product that 64 bits do not hold is the nearest that
    they do; missing components of shorter vectors are zero. Repeated queries ask once. Empty tables give empty results. Other columns are not read.
    """
    spark = data.sparkSession
    vectors = materialise(clean_vectors(data, id_col, vec_col, scale))
    dim, n, top = vectors.agg(F.max(F.size("v")), F.count("*"), F.max(squared_norm(F.col("v")))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    asked = clean_vectors(queries, id_col, vec_col, scale).withColumn("v", F.slice("v", 1, dim)).dropDuplicates(["vec_id", "v"])
    top = float(top) * (1 + 1e-12)
    n_routes = max(1, min(MOST_ROUTES, n // shard))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_routes).collect()
    first = np.zeros((len(sample), dim), np.int64)
    for i, r in enumerate(sample):
        first[i, : len(r["v"])] = r["v"]
    routes = np.unique(_lift(first.astype(np.float64), top), axis=0)
    kinds = "vec_id long, v array<long>, route long, far double"
    routed = materialise(vectors.mapInArrow(_route(routes, np.arange(len(routes)), top, False), kinds))
    shards = routed.groupBy("route").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()  # at most MOST_ROUTES rows
    names = np.array([r["route"] for r in shards], np.int64)
    salts = F.broadcast(spark.createDataFrame([(r["route"], -(-r["n"] // max(shard, n // MOST_ROUTES))) for r in shards], "route long, salts int"))
    salted = routed.join(salts, "route").withColumn("shard", F.concat_ws("/", "route", F.pmod(F.xxhash64("vec_id"), F.col("salts"))))
    nodes = materialise(salted.select("vec_id", "v", "route", "shard").groupBy("shard").applyInArrow(_pages(routes, top), NODE))
    homes = materialise(asked.mapInArrow(_route(routes[names], names, top, True), kinds))

    def search(wanted: DataFrame) -> DataFrame:
        """``wanted``: vec_id, v, floor, route. Blocks of queries meet the shards of their route."""
        blocks = max(1, -(-asked_count // QUERY_BLOCK))
        left = wanted.join(salts, "route").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        left = materialise(left.select("vec_id", "v", "floor", F.concat_ws("/", "route", "salt").alias("shard"), F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")))
        pairs = left.select(F.col("shard").alias("of"), F.col("block").alias("block_of")).distinct()
        met = nodes.join(pairs, F.col("shard") == F.col("of")).select(*nodes.columns, F.col("block_of").alias("block"))
        return met.groupBy("shard", "block").cogroup(left.groupBy("shard", "block")).applyInPandas(_search(routes, top, k), _FOUND)

    asked_count = homes.count()
    first = materialise(_best(search(homes.select("vec_id", "v", F.lit(None).cast("double").alias("floor"), "route")), k))
    # a floor that a double cannot hold is rounded down
    floors = first.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), F.when(F.abs("least") < 1 << 53, F.col("least").cast("double")).otherwise(F.col("least").cast("double") - F.abs("least").cast("double") * 1e-15).alias("floor"))
    rest = homes.join(floors, "vec_id", "left").mapInArrow(_others(routes[names], names, [r["radius"] for r in shards], top), "vec_id long, v array<long>, floor double, route long")
    second = search(rest)
    return _best(first.select("query_id", "vec_id", "score").unionByName(second), k)


def _others(at: np.ndarray, names: list[int], radius: list[float], top: float):
    """The routes, other than a query's own, whose covering radius may hold a score as high as its floor."""
    radius_, names_, dim = np.array(radius), np.array(names), at.shape[1] - 1

    def run(batches):
        for b in batches:
            ids, v = b.column(b.schema.get_field_index("vec_id")), b.column(b.schema.get_field_index("v"))
            floor, own = b.column(b.schema.get_field_index("floor")), b.column(b.schema.get_field_index("route")).to_numpy()
            q = _matrix(v, dim)
            least = np.nan_to_num(floor.to_numpy(zero_copy_only=False).astype(float), nan=-np.inf)
            lifted = np.concatenate([q, np.zeros((len(q), 1))], 1)
            norm = (q**2).sum(1)[:, None] + top
            bound = np.maximum(_distances(lifted, at) - radius_ - _SLACK * np.sqrt(norm), 0)
            highest = (norm - bound**2) / 2
            row, which = np.nonzero((highest + 1e-3 + 1e-12 * norm >= least[:, None]) & (own[:, None] != names_[None]))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), v.take(pa.array(row)), floor.take(pa.array(row)), pa.array(names_[which], pa.int64())], ["vec_id", "v", "floor", "route"])

    return run


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)
