"""Window hits against a direct search."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from starmart.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [(m[0], m.start(), m.end()) for m in WORD.finditer(low)]


def brute(docs, items):
    wins = {}
    for i, t in items:
        w = tuple(x for x, _, _ in words(t))
        for k in range(max(len(w) - 12, 1 if w else 0)):
            wins.setdefault(w[k : k + 13], set()).add("null" if i is None else str(i))
    out = []
    for i, t in docs:
        w = words(t)
        plain = tuple(x for x, _, _ in w)
        hit, found = set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if plain[k : k + n] in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[plain[k : k + n]]
        spans, last = [], None
        for k in sorted(hit):
            if last == k - 1:
                spans[-1] = (spans[-1][0], w[k][2])
            else:
                spans.append((w[k][1], w[k][2]))
            last = k
        out.append((i, len(w), len(hit), sorted(found), spans))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.with_hits(d, b, "h").collect()
    return sorted(((r["doc_id"], r["h"]["n_words"], r["h"]["n_hit"], r["h"]["items"], [(s["start"], s["end"]) for s in r["h"]["spans"]]) for r in rows), key=str)


ITEMS = [
    (1, "The quick, brown fox; jumps over the lazy dog and then runs back home again today"),
    (2, "Short item"), (2, "Short item"), (3, ""), (4, None), (5, "¿Qué es ésto? ñandú Ñandú"), (None, "an item without id"),
    (11, " ".join(f"w{i}" for i in range(40))), (12, " ".join(f"w{i}" for i in range(20, 60))), (13, "go go go"),
]
DOCS = [
    (1, "x THE QUICK brown\n\nfox jumps over the lazy dog and then runs — back home again today."),
    (2, "the quick brown fox jumps over the lazy dog and then runs"), (3, "A short item, a SHORT-ITEM, shorts item"), (4, None), (5, ""), (6, "..."),
    (7, "𝄞 dice: ¿qué es ésto ñandú Ñandú y nada"), (8, "pre " + " ".join(f"w{i}" for i in range(10, 50)) + " post"), (9, "go go go go go no"),
    (9, "this is an item without id"), (None, "short item"), (10, "filler word " * 30000 + "short item " + "é " * 9),
]


def test_hits_items_and_offsets(spark):
    assert run(spark, DOCS, ITEMS) == brute(DOCS, ITEMS)


def test_several_automata_find_the_same(spark, monkeypatch):
    """A long item and the others in blocks of their own, each with a pass: nothing is lost, copies are marked alike."""
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(decontam, "BATCH_ROWS", 7)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    stored, blocks = decontam.stored_windows(items, "item_id", "text")
    sizes = [sum(map(len, decontam.block_of(stored, k)["windows"])) for k in range(blocks)]
    assert blocks > 1 and max(sizes) < 2 * 1000
    docs = DOCS + [DOCS[0], (99, DOCS[7][1])]
    assert run(spark, docs, ITEMS) == brute(docs, ITEMS)
    clash = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as _digest", "2 as _ranges", "3 as found")
    assert decontam.decontaminate(clash, items).columns == clash.columns


def test_random_overlaps(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i, text(rng.randint(1, 18))) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(25)]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables_and_filter(spark):
    assert run(spark, DOCS[:2], [(1, None)][:0] or [(1, None)]) == brute(DOCS[:2], [])
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("_hits", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns
    want = [i for i, n, h, _, _ in brute(DOCS, ITEMS) if not (h > 0 and 20 * h >= n)]
    assert sorted(map(str, want)) == sorted(str(r["doc_id"]) for r in kept.collect())
    assert decontam.decontaminate(docs.limit(0), items).count() == 0
    assert decontam.decontaminate(docs, items.limit(0)).count() == len(DOCS)


def test_query_digest(spark, sf):
    from starmart.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = sorted(((i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0 and 20 * h >= n) for i, n, h, x, _ in brute(docs, items)), key=str)
    assert sorted((tuple(r) for r in QUERIES["op5_decontaminate"](spark, sf).collect()), key=str) == want
