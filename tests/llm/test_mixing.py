"""Targets and copies against a direct computation."""

import hashlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from starmart.llm import mixing
from starmart.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string"


def words(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return len([w for w in (text or "").split(" ") if w])


def targets(sizes):
    """Water filling in exact fractions: {source: size} in rank order to {source: target}."""
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sizes)}
    done, open_, rest = {}, dict(sizes), Fraction(sum(sizes.values()))
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] >= 3 * open_[s]]
        if not full:
            return done | {s: level * weight[s] for s in open_}
        for s in full:
            done[s] = Fraction(3 * open_.pop(s))
            rest -= done[s]
    return done


def brute(rows):
    names = sorted({s for _, _, s in rows if s is not None}) + ([None] if any(s is None for _, _, s in rows) else [])
    sizes = {n: sum(words(t) for _, t, s in rows if s == n) for n in names}
    goal = targets(sizes)
    out = []
    for i, t, s in rows:
        rate = float(goal[s]) / sizes[s] if sizes[s] else 0.0
        u = int(hashlib.md5(f"42:{'null' if i is None else i}".encode()).hexdigest()[:12], 16) / 16**12
        out.append((i, words(t), sizes[s], pytest.approx(float(goal[s])), int(rate) + (u < rate - int(rate))))
    return sorted(out, key=lambda r: (str(r[0]), r[1], r[4]))


def run(spark, rows):
    plan = mixing.mix_plan(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "mix.*").collect()
    return sorted((tuple(r) for r in plan), key=lambda r: (str(r[0]), r[1], r[4]))


ROWS = [(i, "w " * (i % 7 + 1), f"s{i % 4}") for i in range(80)] + [
    (100, "big " * 900, "a"), (101, None, "a"), (102, "", None), (103, "x\ty\nz", None), (104, None, "empty"), (None, "no id here", "s1"), (5, "w w", "s1"), (5, "w w", "s1"), (105, "é ü", "\U0001d11e"), (106, "tiny", "￮"),
]


def test_targets_and_copies(spark):
    assert run(spark, ROWS) == brute(ROWS)
    assert run(spark, ROWS[:0]) == []
    assert run(spark, [(1, None, None), (2, "", "a")]) == brute([(1, None, None), (2, "", "a")])


def test_emitted_rows_follow_the_plan(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).withColumn("_mix", F.lit(1)).withColumn("_copy", F.lit("c"))
    plan = mixing.mix_plan(docs)
    assert plan.columns == [*docs.columns, "mix"]
    want = plan.groupBy("doc_id").agg(F.sum("mix.copies").alias("n")).where("n > 0")
    got = mixing.emit_mix(docs)
    assert got.columns == docs.columns
    counts = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert counts(got.groupBy("doc_id").agg(F.count("*").alias("n"))) == counts(want)


def test_query_comes_near_its_targets(spark):
    rows = QUERIES["op8_mix_sources"](spark, "/root/testdata/sf0.01").collect()
    assert sum(r["size"] for r in rows) == pytest.approx(sum({r["source_size"]: r["target"] for r in rows}.values()), rel=0.2)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    assert sum(r["taken"] for r in rows) == pytest.approx(sum(r["size"] for r in rows), rel=0.1)
