"""Curve, cells and shard law."""

import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from starmart.llm import sharding
from starmart.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, lang string"


def test_curve_visits_neighbours_in_turn():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims))).T
        index = sharding.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(1 << (bits * dims)))
        path = cells[:, np.argsort(index)]
        assert (np.abs(np.diff(path, axis=1)).sum(axis=0) == 1).all()


def check(rows, texts, shards=40):
    """The contract: every row once, sizes and checksums right, counts even, slots gapless, order along the curve."""
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted((str(i), 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in texts)
    counts = [0] * shards
    for r in rows:
        counts[r["shard"]] += 1
    assert max(counts) - min(counts) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    placed = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    order = [(r["curve"], r["text_crc32"], -1 if r["doc_id"] is None else r["doc_id"]) for r in placed]
    assert order == sorted(order)


def shards_of(spark, rows):
    done = sharding.hilbert_shards(spark.createDataFrame(rows, SCHEMA))
    return done.select("doc_id", "shard.*").collect()


def test_query(spark):
    rows = QUERIES["op1_hilbert_shards"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs])
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_edge_cases(spark):
    rows = [(i, "same text", "hot", "en") for i in range(200)] + [(i, f"t{i} é" * (i % 90), f"s{i % 5}", None) for i in range(200, 290)]
    rows += [(None, None, None, None), (None, "", None, "de"), (7, "x" * 3_000_000, "hot", "en"), (7, "same text", "hot", "en"), (-(1 << 62), "low", "s", "x"), (1 << 62, "high", "s", "x")]
    got = shards_of(spark, rows)
    check(got, [(r[0], r[1]) for r in rows])
    few = shards_of(spark, rows[:3])
    check(few, [(r[0], r[1]) for r in rows[:3]])
    assert shards_of(spark, rows[:0]) == []


def test_shards_are_narrow_in_every_dimension(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    zones = sharding.zone_map(sharding.hilbert_shards(docs, keep=docs.columns), ["source", "lang", "doc_id"]).collect()
    assert sum(z["rows"] for z in zones) == docs.count()
    assert sum(z["min_lang"] <= "de" <= z["max_lang"] for z in zones) < 30
    names = {z["min_source"] for z in zones} | {z["max_source"] for z in zones}
    assert len(names) > 5


def test_clashing_names_pass_through(spark):
    docs = spark.createDataFrame([(1, "a", "s", "en", "x"), (2, "b", None, None, None)], SCHEMA + ", _curve string")
    done = sharding.hilbert_shards(docs.withColumn("_row", F.lit(3)), keep=["doc_id", "_curve", "_row"])
    assert sorted(tuple(r)[:3] for r in done.select("doc_id", "_curve", "_row").collect()) == [(1, "x", 3), (2, None, 3)]
