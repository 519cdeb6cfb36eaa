"""Golay keys, components and near-duplicate classes against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from starmart.llm import simhash
from starmart.llm.components import components


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(rows):
    """(id, fingerprint) pairs; the smallest id reachable over links of two bits."""
    prints = sorted({f for _, f in rows})
    parent = {f: f for f in prints}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    have = set(prints)
    flips = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i, j in itertools.combinations(range(64), 2)]
    for f in prints:
        for x in flips:
            if f ^ x in have:
                parent[top(f)] = top(f ^ x)
    least = {}
    for i, f in rows:
        if i is not None:
            least[top(f)] = min(i, least.get(top(f), i))
    return {(i, f, least.get(top(f))) for i, f in rows}


def test_golay_code_is_perfect_and_keys_meet():
    code, leader, seven = simhash.golay()
    assert len(set(code.tolist())) == 4096 and len(seven) == 253
    assert np.bitwise_count(code[1:].astype(np.uint32)).min() == 7
    assert np.bitwise_count(leader.astype(np.uint32)).max() == 3
    rng = np.random.default_rng(7)
    words = rng.integers(0, 1 << 23, 500)
    for i, j in ((0, 0), (0, 1), (3, 17), (22, 8)):
        other = words ^ (1 << i) ^ ((1 << j) if i != j else 0)
        for a, b in zip(simhash.near_codewords(words), simhash.near_codewords(other)):
            assert set(a.tolist()) & set(b.tolist())


@pytest.mark.parametrize("count", [40, 400])
def test_links_connect_what_brute_force_connects(spark, count):
    rng = random.Random(count)
    base = [rng.getrandbits(64) for _ in range(8)]
    prints = {0, (1 << 64) - 1, *base}
    while len(prints) < count:
        f = rng.choice(base)  # crowded: most are within a few bits of a few words
        for _ in range(rng.randint(1, 4)):
            f ^= 1 << rng.randrange(64)
        prints.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    edges = simhash.fingerprint_links(spark.createDataFrame(signed, "fp long"))
    assert edges.where(~simhash.linked(F.col("a"), F.col("b"))).count() == 0
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    got = {}
    for (s,) in signed:
        got.setdefault(roots.get(s, s), set()).add(s % (1 << 64))
    want = {}
    for i, f, c in brute_components([(f, f) for f in prints]):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_paths_stars_and_no_edges(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 180)]
    got = {}
    for r in components(spark.createDataFrame(path + star + [(500, 500)], "a long, b long")).collect():
        got.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, got.values())) == [61, 80]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


TEXTS = ["", None, "one", "One two", "one two three", "ONE two three", "a b c d e f g", "a b c d e f g", "x y z", "é É ß words here now", " ".join(f"w{i}" for i in range(30000))]


def test_near_duplicates_edge_cases(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "One two"), (None, "a b c d e f g"), (None, "lonely words of a null id only")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = brute_components([(i, brute_print(t)) for i, t in rows])
    out = [(r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got.collect()]
    assert len(out) == len(rows) and set(out) == want


def test_near_duplicates_on_documents(spark, sf):
    from starmart.llm.queries import QUERIES

    got = {(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in QUERIES["op6_golay_simhash"](spark, sf).collect()}
    rows = [(r["doc_id"], brute_print(r["text"])) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got == brute_components(rows)


def test_drop_keeps_one_row_of_each_group(spark):
    rows = [(5, "a b c d e", "x"), (2, "a b c d e", "y"), (2, "a b c d e", "y"), (2, "a b c d e", "z"), (None, "q r s t u v", None), (None, "q r s t u v", None), (9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    out = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert out == sorted([(2, "a b c d e"), (None, "q r s t u v"), (9, None)], key=str)
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
