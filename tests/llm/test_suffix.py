"""Induced suffix order and repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from starmart.llm import induced, suffix
from starmart.llm.queries import QUERIES


@pytest.mark.parametrize("depth,limit", [(3, 200), (8, 200), (20, 1 << 20)])
def test_suffix_order_and_common_prefixes(depth, limit):
    rng = random.Random(depth)
    for trial in range(40):
        alphabet = b"ab" if trial % 2 else b"abcxyz\xff\x00"
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) * (1 + trial % 3) for _ in range(rng.randint(1, 10))]
        places, lcp, starts = induced.suffix_order(strings, depth, limit)
        text = [x for s in strings for x in [*(b + 2 for b in s), 1]] + [0]
        assert sorted(places.tolist()) in (list(range(len(text))), list(range(len(text) - 1)))
        keys = [tuple(text[i : i + depth]) for i in places.tolist()]
        assert keys == sorted(keys)
        for k in range(1, len(keys)):
            same = next((i for i, (x, y) in enumerate(zip(keys[k - 1], keys[k])) if x != y), min(map(len, keys[k - 1 : k + 1])))
            assert lcp[k] == same
        assert [text[a : a + len(s)] for a, s in zip(starts, strings)] == [[b + 2 for b in s] for s in strings]


def test_queue_spills_and_keeps_order():
    queue = induced.BucketQueue(100)
    for k in range(50):
        entries = np.zeros(4, induced.ENTRY)
        entries["at"] = np.arange(4) + 4 * k
        queue.push(np.array([7, 3, 7, 9]), entries)
    assert queue.file is not None
    assert queue.take(7)["at"].tolist() == [x for k in range(50) for x in (4 * k, 4 * k + 2)]
    assert len(queue.take(7)) == 0 and len(queue.take(3)) == 50


def brute(rows):
    least, own = {}, {}
    for n, (i, t) in enumerate(rows):
        b = (t or "").encode()
        for k in range(len(b) - 99):
            if i is not None:
                s = b[k : k + 100]
                least[s] = min(i, least.get(s, i))
                own.setdefault((n, s), k)
    out = []
    for n, (i, t) in enumerate(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if i is not None and (least[b[k : k + 100]] < i or own[n, b[k : k + 100]] < k):
                gone[k : k + 100] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone.tolist()) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_passages(spark, seed, monkeypatch):
    monkeypatch.setattr(suffix, "BLOCK_ANCHORS", 50 if seed == 1 else 1 << 19)
    rng = random.Random(seed)
    piece = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.choice([40, 99, 100, 101, 150, 300])))
    pieces = [piece() for _ in range(15)]
    rows = []
    for i in range(60):
        text = "".join(rng.choice(pieces) if rng.random() < 0.6 else piece() for _ in range(rng.randint(0, 6)))
        if text and rng.random() < 0.3:
            k = rng.randrange(len(text))
            text = text[:k] + "X" + text[k + 1 :]
        rows.append((i, text))
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    base = "".join(chr(97 + i * 7 % 26) for i in range(100))
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    rows = [
        (1, None), (2, ""), (3, "short"), (4, base), (4, base), (4, base + "tail"), (5, "x" + base), (6, base), (7, base[:99]), (8, "a" * 350), (9, "a" * 120 + "b"),
        (10, "ab" * 200), (11, base * 4), (None, base), (None, base * 2), (12, long), (13, "y" + long[:60_000]), (13, long[70_000:] + "z"), (14, "é" * 51), (15, "xé" + "é" * 52),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []


def test_one_passage_in_many_contexts(spark, monkeypatch):
    """A passage, a line of 40 bytes and a row of dashes between different words: no shard grows with them."""
    monkeypatch.setattr(suffix, "ANCHOR_STRINGS", 16)
    sort = suffix.repeats_of

    def bounded(table):
        if table.num_rows > 16 * 16:
            raise ValueError(f"{table.num_rows} runs in one shard")
        return sort(table)

    monkeypatch.setattr(suffix, "repeats_of", bounded)
    rng = random.Random(12)
    words = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, line = words(160), words(40)
    rows = []
    for i in range(900):
        common = (passage, line, "-" * 90)[i % 3]
        rows.append((i // 2 if i < 60 else i, words(70 + i % 50) + common + words(60 + i % 40) + (common + words(50) if i % 7 == 0 else "")))
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_cut_runs_keep_equal_windows_together():
    """Windows of one passage in different contexts: equal ones have equal keys, and no window is lost."""
    import pyarrow as pa

    rng = random.Random(5)
    passage = bytes(rng.choice(b"abcdef") for _ in range(180))
    rows = []
    for n in range(60):
        raw = bytes(rng.choice(b"xyz") for _ in range(90)) + passage + bytes(rng.choice(b"xyz") for _ in range(90))
        for h, p, b, e in zip(*suffix.anchors(raw), strict=True):
            rows.append((n, n, int(b), int(p - b), raw[b : e + 100], int(h)))
    batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))], names=["tid", "doc_id", "start", "lead", "run"])
    keys, seen = {}, {}
    for out in suffix.cut_runs([batch]):
        for r in out.to_pylist():
            for k in range(len(r["run"]) - 99):
                assert (r["tid"], r["start"] + k) not in seen
                seen[r["tid"], r["start"] + k] = r["key"]
                assert keys.setdefault(r["run"][k : k + 100], r["key"]) == r["key"]
    assert len(seen) == sum(len(r[4]) - 99 for r in rows)


def test_anchors_belong_to_content(monkeypatch):
    rng = random.Random(4)
    passage = bytes(rng.choice(b"abcdef") for _ in range(400))
    owners = []
    for lead in (b"", b"zz" * 77, b"q" * 1000):
        h, at, lo, hi = suffix.anchors(lead + passage + b"end")
        assert lo[0] == 0 and (lo[1:] == hi[:-1] + 1).all() and hi[-1] == len(lead) + 400 + 3 - 100
        n = len(lead)
        owners.append({s - n: a - n for a, b, e in zip(at, lo, hi) for s in range(max(b, n), min(e, n + 300) + 1)})
    assert owners[0] == owners[1] == owners[2]
    monkeypatch.setattr(suffix, "CHUNK", 64)
    h, at, lo, hi = suffix.anchors(passage)
    assert {s: a for a, b, e in zip(at, lo, hi) for s in range(b, e + 1)} == {k: v for k, v in owners[0].items() if k <= 300}


def test_query_on_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op7_induced_suffixes"](spark, sf).collect()), key=str) == brute(rows)
