"""Periodic runs against brute force; the transform against direct sums."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from starmart.llm import periodic, queries


def brute(words):
    """(start, length, period) of all runs: each period tried at each place, the smallest of a stretch kept."""
    found = {}
    numbers = np.array([hash(w) for w in words], np.int64)
    for q in range(1, len(words) // 4 + 1):
        same = np.concatenate([[False], numbers[q:] == numbers[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        for i, j in edges[edges[:, 1] - edges[:, 0] + q >= max(6, 4 * q)].tolist():
            found.setdefault((i, j + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return [w for w in (text or "").split(" ") if w]


def random_words(rng):
    kind = rng.random()
    if kind < 0.3:
        return [rng.choice("ab") for _ in range(rng.randint(0, 200))]
    if kind < 0.5:
        return [str(rng.randint(0, 50)) for _ in range(rng.randint(0, 200))]
    out = []
    for _ in range(rng.randint(1, 5)):
        piece = [rng.choice("abcdefg") for _ in range(rng.randint(1, rng.choice([2, 5, 40])))]
        out += (piece * rng.randint(1, 9))[: rng.randint(1, 1000)]
    return out


@pytest.mark.parametrize("block, cells", [(1024, 1 << 16), (1024, 16), (16, 1 << 16), (4, 16), (1, 64)])
def test_runs_of_random_words(monkeypatch, block, cells):
    """Blocks longer than the transform and chunks of few blocks give the same runs."""
    monkeypatch.setattr(periodic, "LONGEST_BLOCK", block)
    monkeypatch.setattr(periodic, "CHUNK_CELLS", cells)
    monkeypatch.setattr(periodic, "COMPARED_CELLS", 1 << 6)
    rng = random.Random(block)
    texts = [random_words(rng) for _ in range(150)]
    ids = [periodic.number_words(w) for w in texts]
    runs = periodic.find_runs(np.concatenate(ids), np.array([len(w) for w in texts]))
    got = [[] for _ in texts]
    for d, *run in runs.tolist():
        got[d].append(tuple(run))
    assert got == [brute(w) for w in texts]


@pytest.mark.parametrize("size", [2, 4, 32, 64, 2048])
def test_transform_is_exact(size):
    rng = np.random.default_rng(size)
    x = rng.integers(0, 50, (size, 3)).astype(float)
    z = periodic.spectrum(x.copy())
    assert np.array_equal(np.rint(periodic.inverse(z.copy())), x)
    y = rng.integers(0, 50, (size, 3)).astype(float)
    product = z[periodic.mirrored(size)] * periodic.spectrum(y.copy())
    want = np.array([[sum(int(x[k, c] * y[(k + i) % size, c]) for k in range(size)) for c in range(3)] for i in range(size)])
    assert np.array_equal(periodic.inverse(periodic.residues(product)) % periodic.PRIME, want % periodic.PRIME)


def test_sums_stay_below_the_prime():
    for width in (1, 2, 64, 1024, 1 << 19):
        c = periodic.codes(np.arange(5000), width)
        assert c.min() >= 0 and width * (c.max() - c.min()) ** 2 < periodic.PRIME


def test_long_texts():
    one = ["a"] * 30000
    assert periodic.find_runs(periodic.number_words(one), np.array([30000])).tolist() == [[0, 0, 30000, 1]]
    wide = [str(i % 9000) for i in range(60000)]
    assert periodic.find_runs(periodic.number_words(wide), np.array([60000])).tolist() == [[0, 0, 60000, 9000]]
    distinct = [str(i) for i in range(60000)]
    assert len(periodic.find_runs(periodic.number_words(distinct), np.array([60000]))) == 0


def test_odd_rows_and_clashing_names(spark):
    texts = [None, "", " \n\t ", "x", "a " * 5, "a " * 6, "é\x0bé " * 3, "a a " * 6, "ab cd " * 4, "ab cd " * 3, "z " * 5000 + "y x " * 5000]
    rows = [Row(doc_id=i if i % 3 else None, text=t, periodic="mine", n_words=7) for i, t in enumerate(texts + texts[3:6])]
    df = spark.createDataFrame(rows, "doc_id long, text string, periodic string, n_words int")
    got = periodic.periodic_runs(df).collect()
    assert len(got) == len(rows) and all(r["periodic"] == "mine" and r["n_words"] == 7 for r in got)
    for r in got:
        w = split(r["text"])
        runs = brute(w)
        assert r["periodic_"]["n_words"] == len(w)
        assert [tuple(x) for x in r["periodic_"]["runs"]] == runs
        assert r["periodic_"]["collapsed"] == collapsed(w, runs)
    assert periodic.periodic_runs(df.limit(0)).collect() == []


def test_query_equals_brute_force(spark, sf):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    with_runs = 0
    for doc, text in docs:
        words, h = split(text), zlib.crc32(str(doc).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        with_runs += bool(runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want = (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(words, runs))]
        r = got[doc]
        assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert [r["runs_sha256"], r["collapsed_sha256"]] == digests
    assert with_runs > 5
