"""Top-k against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import balltree

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, is_query, k):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, v), v)
    asked = {i for i, v in rows if i is not None and is_query(i) and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = {i: [math.floor(256 * x) for x in v] for i, v in kept.items()}
    out = []
    for q in asked:
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, step, k=5):
    df = balltree.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % step == 0, k)
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shard,block,leaf", [(60, 7, 8), (8192, 256, 64)])
def test_random_vectors_with_ties(spark, monkeypatch, shard, block, leaf):
    monkeypatch.setattr(balltree, "SHARD_ROWS", shard)
    monkeypatch.setattr(balltree, "QUERY_BLOCK", block)
    monkeypatch.setattr(balltree, "LEAF_ROWS", leaf)
    rng = random.Random(shard)
    rows = [(i, [rng.choice([-0.1, 0.0, 0.1, rng.gauss(0, 0.2)]) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.25] * 6) for i in range(150)]  # one common vector
    assert run(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0, 5)


def test_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.5, -1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [9.0, 9.0]), (5, [3.0]), (50, [0.5, -1.0]), (50, [0.25, 7.0]), (100, None), (-50, [1.0, 1.0]), (6, [])]
    assert run(spark, rows, 50) == brute(rows, lambda i: i % 50 == 0, 5)
    assert run(spark, rows[:0], 50) == [] and run(spark, [(1, [1.0])], 50) == [] and run(spark, [(0, [1.0])], 50) == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**20 + i), float(2**21 - i), 1.0]) for i in range(0, 120)]
    assert run(spark, rows, 50) == brute(rows, lambda i: i % 50 == 0, 5)
    with pytest.raises(Exception, match="too large"):
        run(spark, [(0, [1e300]), (1, [1.0])], 50)


@pytest.mark.parametrize("seed", range(6))
def test_cancelling_components_keep_ties_exact(spark, monkeypatch, seed):
    """Nearly orthogonal vectors of about 2^30: scores are small differences of large products, and many tie."""
    monkeypatch.setattr(balltree, "SHARD_ROWS", 200)
    monkeypatch.setattr(balltree, "LEAF_ROWS", 8)
    rng = random.Random(seed)
    a, b = (rng.randrange(2**29, 2**31) / 256 for _ in range(2))
    rows = [(0, [a, b]), (50, [a, -b])]
    rows += [(i, [b + rng.choice([0, 1, 2]) / 256, rng.choice([-1, 1]) * a + rng.choice([0, 1]) / 256]) for i in rng.sample(range(51, 4000), 600) if i % 50]
    assert run(spark, rows, 50) == brute(rows, lambda i: i % 50 == 0, 5)


def test_search_prunes_balls():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 300, (40, 8))
    points = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(0, 3, (4000, 8))).astype(np.int64)
    tree = balltree.build_tree(np.arange(4000), points)
    asked = points[::400]
    names, scores = balltree.search_tree(tree, np.arange(0, 4000, 400), asked, np.full(10, -np.inf), 5)
    every = (asked @ points.T).astype(float)
    every[np.arange(10), np.arange(0, 4000, 400)] = -np.inf
    assert (np.sort(every, axis=1)[:, ::-1][:, :5] == scores).all()
    leaves = tree["child"][:, 0] < 0
    bound = asked @ tree["centre"][leaves].T + np.linalg.norm(asked, axis=1)[:, None] * tree["radius"][leaves]
    assert (bound >= scores[:, -1:]).mean() < 0.3


def test_queries_are_sent_only_to_shards_in_reach(spark, monkeypatch):
    """Separate clusters: a block goes to few other shards, and the rows found stay those of brute force."""
    monkeypatch.setattr(balltree, "SHARD_ROWS", 60)
    monkeypatch.setattr(balltree, "QUERY_BLOCK", 4)
    monkeypatch.setattr(balltree, "ROOT_PAGE", 3)
    monkeypatch.setattr(balltree, "PILE_BLOCKS", 2)
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 3, (12, 8))
    rows = [(i, (centres[i % 12 if i % 3 else 0] + rng.normal(0, 0.02, 8)).tolist()) for i in range(720)]  # a third in one cluster
    assert run(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0, 5)

    vectors = spark.createDataFrame(rows, "vec_id long, v array<double>")
    placed, shards = balltree.in_shards(vectors, len(rows), 8)
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert sum(sizes) == len(rows) and shards >= 12 and max(sizes) <= 2 * 60
    asked = balltree.homed(placed.where("vec_id % 10 = 0"))
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows}
    kth = [(i, float(np.sort([whole[i] @ whole[j] for j, _ in rows if j != i])[-5])) for i, _ in rows if i % 10 == 0]
    floors = asked.join(spark.createDataFrame(kth, "vec_id long, floor double"), "vec_id")
    sent = balltree.reaching(balltree.blocked(floors, 8), balltree.grown(placed, 8), shards).collect()
    queries = sum(len(balltree.unpack(r["queries"])["ids"]) for r in sent)
    assert 0 < queries < 0.5 * len(kth) * (shards - 1)
