"""The pipeline against a direct computation of every stage, and its handling of odd rows."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from starmart.llm import langid

from . import test_decontam, test_mixing, test_sharding, test_simhash


def identified(rows):
    """Rows that language ID keeps, with a model counted here: (doc_id, text, lang, source)."""
    import zlib

    counts = {}
    for i, t, lang, _ in rows:
        if i is not None and t is not None and lang is not None and zlib.crc32(str(i).encode()) % 5:
            used, n = langid.trigrams(t)
            counts.setdefault(lang, np.full(langid.BUCKETS, langid.SMOOTHING))[used] += n
    langs = sorted(counts)
    p = np.array([counts[x] / counts[x].sum() for x in langs], np.float32)
    model = {"langs": langs, "p": p}
    found = [langid.language_of(t, model) for _, t, _, _ in rows]
    return [r for r, f in zip(rows, found) if f["lang"] != "und" and f["score"] >= 0.5]


def deduplicated(rows):
    out, seen = [], set()
    classes = {(i, f): c for i, f, c in test_simhash.brute_components([(i, test_simhash.brute_print(t)) for i, t, _, _ in rows])}
    for r in rows:
        c = classes[r[0], test_simhash.brute_print(r[1])]
        if r[0] == c and c not in seen:
            seen.add(c)
            out.append(r)
    return out


def clean(rows, items):
    hit = {i: h > 0 and 20 * h >= n for i, n, h, _, _ in test_decontam.brute([r[:2] for r in rows], items)}
    return [r for r in rows if not hit[r[0]]]


def mixed(rows):
    copies = {r[0]: r[4] for r in test_mixing.brute([(i, t, s) for i, t, _, s in rows])}
    return [r for r in rows for _ in range(copies[r[0]])]


def test_run_equals_brute_force(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got.columns[: len(docs.columns)] == docs.columns
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = mixed(clean(deduplicated(identified(rows)), items))
    out = got.collect()
    assert Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in out) == Counter(want)
    test_sharding.check(out, [r[:2] for r in want])


ODD = [
    (1, "the cat and the dog sat on the mat and then went home again", "en", "a"), (1, "the cat and the dog sat on the mat and then went home again", "en", "a"),
    (2, None, "en", None), (3, "", None, "a"), (None, "le chat et le chien sont dans la maison avec nous", "fr", "b"), (None, None, None, None),
    (4, "12 34", "en", "a"), (5, "word " * 50_000, "en", "b"), (6, "der hund und die katze sind im haus", "de", None),
]


def test_every_stage_takes_odd_rows_and_clashing_columns(spark, sf):
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("_language", "_row", "_hits", "_mix", "_copy", "_place", "size", "shard", "_size"):
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf)
            assert out.columns[: len(docs.columns)] == docs.columns, name
            if name != "sharding":
                assert out.columns == docs.columns, name
            assert all(r["_size"] == "own _size" for r in out.select("_size").collect())


def test_clean_documents_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, sf)
    assert kept.count() >= 0.97 * docs.where(F.length("text") > 0).count()


def test_every_document_with_letters_stays(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(corpus_pipeline.language_id(spark, docs, sf)) == ids(docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()))
