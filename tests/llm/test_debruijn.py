"""Repeated windows against brute force."""

import hashlib
import random

import numpy as np
import pytest

from starmart.llm import debruijn


def words_of(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return [w for w in (text or "").split(" ") if w]


def brute(rows):
    first = {}
    for i, t in rows:
        w = words_of(t)
        for k in range(len(w) - 12):
            if i is not None:
                key = tuple(w[k : k + 13])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - 12):
            if i is not None and first[tuple(w[k : k + 13])] < i:
                gone |= set(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = debruijn.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [60, 1 << 21])
def test_random_texts_of_few_words(spark, monkeypatch, block):
    """Few different words make branching nodes, repeats inside a document and chains over documents."""
    monkeypatch.setattr(debruijn, "BLOCK_WORDS", block)
    rng = random.Random(block)
    pieces = [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 30))) for _ in range(12)]
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choice(pieces) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 700}é" for i in range(20000))
    base = " ".join(f"x{i}" for i in range(13))
    rows = [
        (1, None), (2, ""), (3, "one two"), (4, base), (4, base), (4, base + " tail"), (5, base + " other"), (6, "lead " + base), (7, base), (8, " ".join(base.split()[:12])),
        (None, base), (None, long), (9, long), (10, long), (11, "before " + long + " after"), (12, "a b c " * 9), (0, "q " * 40), (13, "q " * 13 + "end"),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []
    assert run(spark, [(None, None), (3, "x y")]) == brute([(None, None), (3, "x y")])


def test_spans_follow_their_source(spark):
    a = [f"a{i}" for i in range(40)]
    b = [f"b{i}" for i in range(40)]
    docs = spark.createDataFrame([(0, 10, " ".join(a + b)), (1, 11, " ".join(["x"] + a)), (2, 12, " ".join(b + ["y"] + a[:20]))], "tid long, doc_id long, text string")
    spans = debruijn.repeated_spans(docs, debruijn.candidates(docs, 200)).collect()
    later = sorted((r["doc_id"], r["start"], r["windows"], r["source_doc"], r["source_start"]) for r in spans if r["doc_id"] > 10)
    covered = {}
    for doc, start, windows, source, at in later:
        assert source == 10
        covered.setdefault(doc, []).append((start, start + windows + 12, at))
    assert covered[11][0][0] == 1 and max(e for _, e, _ in covered[11]) == 41
    assert all(at == start - 1 for start, _, at in covered[11])
    assert {start for start, _, at in covered[12] if at >= 40} and (41, 61, 0) in covered[12]


def test_number_planes_round_trip():
    x = np.array([0, 1, 255, 256, 70000, 2**31], np.uint32)
    assert (debruijn.unplanes(memoryview(debruijn.planes(x))) == x).all()
