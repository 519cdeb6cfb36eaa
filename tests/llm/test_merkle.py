"""The manifest against trees built in one list."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from starmart.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, **changed):
    values = [changed.get(f, row[f]) for f in merkle.FIELDS]
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def beside(levels, i):
    return [(level[(i >> k) ^ 1], (i >> k) & 1) if (i >> k) ^ 1 < len(level) else (None, 0) for k, level in enumerate(levels[:-1])]


def brute(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) a row."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = []
    for lang in order:
        members = sorted(trees[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        made.append((members, levels_of([leaf_of(r) for r in members])))
    top = levels_of([levels[-1][0] for _, levels in made])
    out = []
    for t, (members, levels) in enumerate(made):
        for i, r in enumerate(members):
            path = beside(levels, i) + beside(top, t)
            node = leaf_of(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None:
                node = leaf_of(r, n_chars=r["n_chars"] + 1)
            for s, right in path:
                node = H(*([node] if s is None else [s, node] if right else [node, s]))
            out.append((r["doc_id"], levels[0][i], levels[-1][0], top[-1][0], H(*[s for s, _ in path if s]), node, node == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(rng, n, langs):
    return [Row(doc_id=i, source=rng.choice(["a", None]), lang=rng.choice(langs), n_chars=rng.choice([3, 7, None]), text=rng.choice(["é" * 5, "", None, "x" * i])) for i in rng.sample(range(5 * n), n)]


@pytest.mark.parametrize("span", [1, 2, 8])
def test_proofs_of_any_span(spark, span):
    """Trees of one leaf, of full and of broken subtrees, over one to three stored levels."""
    rng = random.Random(span)
    rows = rows_of(rng, 90, [None, "a", "a", "a", "é", "zz"]) + [Row(doc_id=1, source="s", lang="one", n_chars=0, text="")]
    docs = spark.createDataFrame(rows, SCHEMA)
    done = merkle.proofs(merkle.build(docs, keep={"doc_id": F.col("doc_id")}, span=span), span)
    got = done.withColumn("over", merkle.folded("digest", "idx", "n", "tree", "trees", "proof")).collect()
    want = brute(rows)
    assert sorted(((r["kept_doc_id"], r["digest"].hex(), r["subroot"].hex(), r["root"].hex(), hashlib.sha256(r["proof"].hex().encode()).hexdigest()) for r in got), key=str) == [w[:5] for w in want]
    assert all(r["over"] == r["root"] for r in got)


def test_only_some_levels_are_stored(spark):
    docs = spark.range(70).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("l").alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    made = merkle.build(docs, span=3)
    assert [lv.count() for lv in made.levels] == [70, 9, 2, 1] and [lv.count() for lv in made.top] == [1]


def test_odd_rows(spark):
    """Nulls in every column, repeated rows and ids, one row, very long texts, no rows, more columns."""
    rng = random.Random(3)
    rows = rows_of(rng, 20, [None, "b"])
    rows += rows[:5] + [Row(doc_id=None, source=None, lang=None, n_chars=None, text=None)] * 2
    rows += [Row(doc_id=rows[0]["doc_id"], source="other", lang=rows[0]["lang"], n_chars=1, text="é" * 300_000)]
    for part in (rows, rows[:1]):
        docs = spark.createDataFrame(part, SCHEMA).select("*", F.lit(1).alias("tree"), F.lit(2).alias("digest"), F.lit(3).alias("place"))
        done = merkle.proofs(merkle.build(docs, keep={"doc_id": F.col("doc_id")})).collect()
        assert sorted(((r["kept_doc_id"], r["digest"].hex(), r["root"].hex()) for r in done), key=str) == [(w[0], w[1], w[3]) for w in brute(part)]
    empty = merkle.build(docs.limit(0))
    assert merkle.proofs(empty).collect() == [] and empty.root().collect() == []


def test_proof_must_fit():
    with pytest.raises(ValueError):
        merkle.fold(b"x" * 32, [(0, 1)], b"y" * 32)


def test_query_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert sorted((tuple(r) for r in queries.op13_merkle_manifest(spark, sf).collect()), key=str) == brute(rows)
    assert {w[-1] for w in brute(rows)} == {True, False}
