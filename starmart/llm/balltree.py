"""Exact top-k inner-product search with ball trees (operator 9).

Vectors go to the nearest of a few pivots, the regions are cut into shards of bounded
size, and each shard becomes a ball tree. Queries travel in blocks of one home shard. A
first wave searches each block at home; the k-th score it finds is shared with the
second wave. There the upper bound of each shard's root ball (inner product with the
centre plus query norm times radius) is compared first, and only queries whose bound
reaches their k-th score are sent to the shard, where its tree is searched, best
bound first, in the same way.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.session import materialize

SCALE = 256
SHARD_ROWS = 8192
QUERY_BLOCK = 256
LEAF_ROWS = 64
PIVOTS = 256  # at most: a sample that only decides which rows share a shard
ROOT_PAGE = 256  # root balls compared with a block at once
PILE_BLOCKS = 16  # blocks whose queries are sent to a shard together
#: Sums of products below this are exact in double precision.
EXACT = 2.0**53


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as held:
        return {k: held[k] for k in held.files}


def quantised(vectors: pd.Series, dims: int) -> np.ndarray:
    """floor(256 * x) of each component, shorter vectors filled with zeros."""
    out = np.zeros((len(vectors), dims))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    out = np.floor(SCALE * out)
    if np.abs(out).max(initial=0) >= 2.0**62:
        raise ValueError("a component is too large for an integer inner product")
    return out.astype(np.int64)


def build_tree(ids: np.ndarray, points: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes cover slices of the reordered points; balls split between two far points, half and half."""
    order = np.arange(len(ids))
    real = points.astype(np.float64)
    nodes: list[list] = []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        lo, hi, parent, side = todo.pop()
        part = real[order[lo:hi]]
        centre = part.mean(axis=0)
        far = np.sqrt(((part - centre) ** 2).sum(axis=1))
        k = len(nodes)
        nodes.append([lo, hi, -1, -1, far.max(), centre])
        if parent >= 0:
            nodes[parent][2 + side] = k
        if hi - lo > LEAF_ROWS and far.max() > 0:
            a = part[far.argmax()]
            b = part[((part - a) ** 2).sum(axis=1).argmax()]
            order[lo:hi] = order[lo:hi][np.argsort(part @ (a - b), kind="stable")]
            middle = (lo + hi) // 2
            todo += [(lo, middle, k, 0), (middle, hi, k, 1)]
    lo, hi, left, right, radius, centre = zip(*nodes, strict=True)
    return {"ids": ids[order], "points": points[order], "span": np.array([lo, hi]).T, "child": np.array([left, right]).T, "radius": np.array(radius), "centre": np.array(centre)}


def upper_bounds(queries: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each query (row) and ball (column) a number that no inner product with the ball's points exceeds.

    Rounding never hides a ball: with n components each product and the radius err by less than n + 16 roundings of
    |query| * (|centre| + radius), however much the terms cancel.
    """
    norm = np.sqrt((queries**2).sum(axis=1))
    reach = np.sqrt((centre**2).sum(axis=1)) + radius
    return queries @ centre.T + norm[:, None] * (radius + (queries.shape[1] + 16) * 2.0**-51 * reach)[None, :]


def search_tree(tree: dict, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, smaller id first) of each query in the tree that reach its floor; missing ones have score -inf."""
    points = tree["points"]
    small = float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * points.shape[1] < EXACT
    bound = upper_bounds(queries.astype(np.float64), tree["centre"], tree["radius"])
    kind = np.float64 if small else object
    best = np.full((len(ids), k), -math.inf, kind)
    names = np.full((len(ids), k), np.iinfo(np.int64).max)
    left, right = points.astype(kind), queries.astype(kind)
    heap = [(-bound[:, 0].max(initial=-math.inf), 0)]
    while heap:
        _, node = heapq.heappop(heap)
        least = np.maximum(best[:, -1].astype(np.float64), floor)
        active = np.flatnonzero(bound[:, node] >= least)
        if not len(active):
            continue
        if tree["child"][node, 0] >= 0:
            for child in tree["child"][node]:
                heapq.heappush(heap, (-bound[active, child].max(), int(child)))
            continue
        lo, hi = tree["span"][node]
        scores = right[active] @ left[lo:hi].T
        own = ids[active, None] == tree["ids"][None, lo:hi]
        scores = np.where(own, -math.inf, scores)
        who = np.broadcast_to(tree["ids"][None, lo:hi], scores.shape)
        scores, who = np.hstack([best[active], scores]), np.hstack([names[active], who])
        top = np.lexsort((who, -scores), axis=-1)[:, :k] if small else np.array([sorted(range(s.size), key=lambda i, s=s, w=w: (-s[i], w[i]))[:k] for s, w in zip(scores, who, strict=True)])
        best[active], names[active] = np.take_along_axis(scores, top, 1), np.take_along_axis(who, top, 1)
    return names, best


def usable(vector: Column) -> Column:
    """Not null and without null, NaN or infinite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def in_shards(rows: DataFrame, n: int, dims: int) -> tuple[DataFrame, int]:
    """``rows`` (vec_id, v) with their shard, and the number of shards.

    Pivots are the vectors with the smallest hashes of their ids, at most ``PIVOTS`` and one a shard needed. A region
    with more than ``SHARD_ROWS`` rows is cut by hash, so a cluster that holds a third of all rows gets many shards.
    """
    wanted = max(1, math.ceil(n / SHARD_ROWS))
    if wanted == 1:
        return rows.withColumn("shard", F.lit(0)), 1
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(wanted, PIVOTS)).toPandas()
    pivots = quantised(sample["v"], dims).astype(np.float64)

    @F.pandas_udf("int")
    def nearest(v: pd.Series) -> pd.Series:
        points = quantised(v, dims).astype(np.float64)
        return pd.Series(((pivots**2).sum(axis=1) - 2 * points @ pivots.T).argmin(axis=1).astype(np.int32))

    near = materialize(rows.withColumn("region", nearest("v")), "regions")
    held = {r["region"]: r["count"] for r in near.groupBy("region").count().collect()}  # at most PIVOTS rows
    pieces = [math.ceil(held.get(k, 0) / SHARD_ROWS) for k in range(len(pivots))]
    before = np.cumsum([0, *pieces]).tolist()
    of_region = lambda numbers: F.get(F.array(*[F.lit(x) for x in numbers]), "region")
    piece = F.pmod(F.xxhash64("vec_id"), of_region(pieces))
    return near.select("vec_id", "v", (of_region(before) + piece).cast("int").alias("shard")), before[-1]


def grown(placed: DataFrame, dims: int) -> DataFrame:
    """A row a shard: its ball tree, and its root ball by itself."""

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = build_tree(pdf["vec_id"].to_numpy(np.int64), quantised(pdf["v"], dims))
        root = pack(centre=tree["centre"][:1], radius=tree["radius"][:1])
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "tree": [pack(**tree)], "root": [root]})

    return placed.groupBy("shard").applyInPandas(grow, "shard int, tree binary, root binary")


def homed(asked: DataFrame) -> DataFrame:
    """Queries (vec_id, v, shard) with their home shard and the part of its queries they are asked with."""
    parts = asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", F.lit("part")), F.col("parts")).cast("int")
    return asked.join(parts, "shard").select("vec_id", "v", F.col("shard").alias("home"), part.alias("part"))


def blocked(asked: DataFrame, dims: int) -> DataFrame:
    """Queries with floors as a row (home, part, queries) a block."""

    def block_up(pdf: pd.DataFrame) -> pd.DataFrame:
        held = pack(ids=pdf["vec_id"].to_numpy(np.int64), points=quantised(pdf["v"], dims), floor=pdf["floor"].to_numpy(np.float64))
        return pd.DataFrame({"home": [int(pdf["home"].iloc[0])], "part": [int(pdf["part"].iloc[0])], "queries": [held]})

    return asked.groupBy("home", "part").applyInPandas(block_up, "home int, part int, queries binary")


def reaching(blocks: DataFrame, trees: DataFrame, shards: int) -> DataFrame:
    """Rows (shard, queries): the queries whose bound for the shard's root ball reaches their floor, their home left out.

    Every block is compared with every root ball, a page of them at a time; queries for one shard travel in piles of
    about ``PILE_BLOCKS`` blocks.
    """
    piles, pages = math.ceil(blocks.count() / PILE_BLOCKS) or 1, math.ceil(shards / ROOT_PAGE)

    def page_up(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("shard")
        roots = [unpack(r) for r in pdf["root"]]
        held = pack(shard=pdf["shard"].to_numpy(np.int64), centre=np.concatenate([r["centre"] for r in roots]), radius=np.concatenate([r["radius"] for r in roots]))
        return pd.DataFrame({"page": [int(pdf["page"].iloc[0])], "roots": [held]})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for home, pile, queries, roots in zip(pdf["home"], pdf["pile"], pdf["queries"], pdf["roots"], strict=True):
                q, r = unpack(queries), unpack(roots)
                reach = upper_bounds(q["points"].astype(np.float64), r["centre"], r["radius"]) >= q["floor"][:, None]
                for column in np.flatnonzero(reach.any(axis=0) & (r["shard"] != home)):
                    kept = {name: array[reach[:, column]] for name, array in q.items()}
                    yield pd.DataFrame({"shard": [int(r["shard"][column])], "pile": [int(pile)], "queries": [pack(**kept)]})

    def pile_up(pdf: pd.DataFrame) -> pd.DataFrame:
        held = [unpack(q) for q in pdf["queries"]]
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "queries": [pack(**{name: np.concatenate([h[name] for h in held]) for name in held[0]})]})

    roots = trees.select((F.col("shard") / ROOT_PAGE).cast("int").alias("page"), "shard", "root").groupBy("page").applyInPandas(page_up, "page int, roots binary")
    paged = blocks.withColumn("pile", F.pmod(F.xxhash64("home", "part"), F.lit(piles)).cast("int")).withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    pairs = paged.join(roots, "page").select("home", "pile", "queries", "roots").mapInPandas(compare, "shard int, pile int, queries binary")
    return pairs.groupBy("shard", "pile").applyInPandas(pile_up, "shard int, queries binary")


def searched(sent: DataFrame, trees: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the best rows that the shards of ``sent`` (shard, queries) have for its queries."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, tree = None, {}
        for pdf in batches:
            for at, data, block in zip(pdf["shard"], pdf["tree"], pdf["queries"], strict=True):
                if at != shard:
                    shard, tree = at, unpack(data)
                q = unpack(block)
                names, scores = search_tree(tree, q["ids"], q["points"], q["floor"], k)
                rounded = scores.astype(np.float64)
                i, j = np.nonzero((rounded > -math.inf) & (rounded >= q["floor"][:, None]))
                yield pd.DataFrame({"query_id": q["ids"][i], "vec_id": names[i, j], "score": [int(x) for x in scores[i, j]]})

    return sent.join(trees, "shard").select("shard", "tree", "queries").mapInPandas(search, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best other rows by integer inner product.

    Ties go to the smaller id. Rows whose id is null, or whose vector is null or
    holds null or non-finite components, take no part; of rows with equal ids the
    one with the smallest vector counts; shorter vectors are filled with zeros. A
    query with fewer than ``k`` other rows returns all of them; without queries
    or rows the result is empty. A score that leaves the range of long raises. A vector
    may have any length that fits a row. Other columns of ``vectors``, whatever their names, play no part.
    """
    usable_rows = vectors.where(F.col(id_col).isNotNull()).where(usable(F.col(vector_col)))
    rows = usable_rows.groupBy(F.col(id_col).cast("long").alias("vec_id")).agg(F.min(F.col(vector_col).cast("array<double>")).alias("v"))
    query = usable_rows.where(is_query).select(F.col(id_col).cast("long").alias("vec_id")).distinct()
    rows = materialize(rows, "vectors")
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    placed, shards = in_shards(rows, n, dims or 0)
    trees, asked = materialize(grown(placed, dims or 0), "trees"), materialize(homed(placed.join(query, "vec_id", "left_semi")), "queries")

    none = asked.withColumn("floor", F.lit(-math.inf))
    first = materialize(searched(blocked(none, dims or 0).withColumnRenamed("home", "shard"), trees, k), "first-wave")
    kth = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) == k, F.min("score").cast("double")).alias("floor"))
    found = first
    if shards > 1:
        floors = asked.join(kth, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-math.inf)))
        sent = reaching(materialize(blocked(floors, dims or 0), "blocks"), trees, shards)
        found = first.unionByName(searched(sent, trees, k))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
