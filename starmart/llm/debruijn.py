"""Substring dedup by De Bruijn compaction (operator 4).

Every window of 13 words is an edge between two nodes of 12 words. Equal texts
are collapsed first. A filter then finds the windows that may repeat: each block
of documents sends 32 bits of each distinct window to the bucket of its other bits,
and only windows met in two documents come back. These few become the graph:
edges with their first source coordinates, node degrees, and paths through nodes
with one way in and one way out, compacted by joins and numbered along the source.
Occurrences whose coordinates run in step with the source's form spans, and the
words of spans whose source is a document with a smaller id are removed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import materialize

from .common import discard, ranked, release, shuffle_partitions, text_digest

WIDTH = 13  # words of a window
BLOCK_WORDS = 1 << 21  # words hashed together on the sending side
BATCH_ROWS = 100_000
BUCKET_WORDS = 1 << 22  # windows compared together on the receiving side
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """A 64-bit number for each run of ``width`` words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        h = h * base + words[k : k + n]
    return mixed(h)


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers byte by byte, so that high bytes, mostly zero, compress away."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplanes(data: memoryview) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def sent(buckets: int):
    """Blocks of documents to rows (bucket, tid, n, pos, hash); bucket -1 holds windows known to repeat in the block.

    Of the documents of a block that hold a window only the first goes to the
    bucket, so a bucket gets a very common window once a block.
    """
    schema = pa.schema([("bucket", pa.int32()), ("tid", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("pos", pa.binary()), ("hash", pa.binary())])

    def rows(tids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc = np.repeat(np.arange(len(tids)), sizes)
        pos = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        leader = doc[order][first][np.cumsum(first) - 1]
        later = np.empty(len(hashes), bool)
        later[order] = doc[order] != leader
        many = np.zeros(int(first.sum()), bool)
        np.logical_or.at(many, (np.cumsum(first) - 1)[doc[order] != leader], True)
        repeats = np.empty(len(hashes), bool)
        repeats[order] = many[np.cumsum(first) - 1]
        to = (hashes % np.uint64(buckets)).astype(np.int32)
        part = np.where(repeats, -1, to)
        out = []
        for target, chosen in ((to, ~later), (part, repeats)):
            at = np.flatnonzero(chosen)
            at = at[np.argsort(target[at], kind="stable")]
            for group in np.split(at, np.flatnonzero(np.diff(target[at])) + 1):
                if len(group):
                    edges = np.flatnonzero(np.diff(doc[group], prepend=-1))
                    bits = (hashes[group] // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
                    n = np.diff(edges, append=len(group))
                    own = target is part
                    out.append((int(target[group[0]]), tids[doc[group[edges]]], n, planes(pos[group]), b"" if own else bits.astype("<u4").tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tids, sizes, hashes, held = [], [], [], 0
        for batch in batches:
            for tid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = window_hashes(word_hashes(text.as_buffer().to_pybytes().split()), WIDTH, BASES[0])
                if len(found):
                    tids.append(tid)
                    sizes.append(len(found))
                    hashes.append(found)
                    held += len(found)
                if held >= BLOCK_WORDS:
                    yield from rows(np.array(tids), np.array(sizes), np.concatenate(hashes))
                    tids, sizes, hashes, held = [], [], [], 0
        if held:
            yield from rows(np.array(tids), np.array(sizes), np.concatenate(hashes))

    return send


PLACES = pa.schema([("tid", pa.int64()), ("pos", pa.list_(pa.int32()))])


def listed(tid: np.ndarray, pos: np.ndarray) -> pa.Table:
    """A row (tid, places) for each document; ``tid`` is grouped."""
    edges = np.flatnonzero(np.concatenate([[True], tid[1:] != tid[:-1]])) if len(tid) else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(edges, len(tid)), pa.int32()), pa.array(pos, pa.int32()))
    return pa.Table.from_arrays([pa.array(tid[edges], pa.int64()), lists], schema=PLACES)


def unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Document and place of each window in rows of ``sent``."""
    tid = np.concatenate([np.repeat(np.array(t, np.int64), n) for t, n in zip(table["tid"].to_pylist(), table["n"].to_pylist(), strict=True)])
    return tid, np.concatenate([unplanes(x.as_buffer()) for x in table["pos"]])


PACKED = pa.schema([("part", pa.int32()), ("tid", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("pos", pa.binary())])
PACKED_ROWS = "part int, tid array<long>, n array<int>, pos binary"


def packed(tid: np.ndarray, pos: np.ndarray, parts: int) -> pa.Table:
    """Places dealt by document into ``parts``: a row a part, whatever the number of documents."""
    order = np.lexsort((pos, tid, tid % parts))
    tid, pos = tid[order], pos[order]
    rows = []
    for at in np.split(np.arange(len(tid)), np.flatnonzero(np.diff(tid % parts)) + 1):
        if len(at):
            edges = np.flatnonzero(np.diff(tid[at], prepend=-1))
            rows.append((int(tid[at[0]] % parts), tid[at[edges]], np.diff(edges, append=len(at)), planes(pos[at])))
    columns = zip(*rows, strict=True) if rows else ([] for _ in PACKED)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, PACKED, strict=True)], schema=PACKED)


def met(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Of the windows of a bucket, document and place of those that more than one document sent."""
    tid, pos = unpacked(table)
    bits = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table["hash"]])
    order = np.lexsort((tid, bits))
    bits, tid, pos = bits[order], tid[order], pos[order]
    first = np.concatenate([[True], bits[1:] != bits[:-1]])
    group = np.cumsum(first) - 1
    last = np.append(np.flatnonzero(first)[1:] - 1, len(bits) - 1)
    several = (tid[np.flatnonzero(first)] != tid[last])[group]
    return tid[several], pos[several]


def gathered(table: pa.Table) -> pa.Table:
    """All places of the documents of a part, a row a document."""
    tid, pos = unpacked(table)
    order = np.lexsort((pos, tid))
    return listed(tid[order], pos[order])


def graph_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of candidate edges: two hashes of the edge, its two nodes, and whether it is the document's first."""
    held: list[list[np.ndarray]] = []
    rows = 0

    def batch_of() -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], OCCURRENCE)

    for batch in batches:
        for tid, doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            words = word_hashes(text.as_buffer().to_pybytes().split())
            at = np.unique(places.values.to_numpy())
            edge, nodes = window_hashes(words, WIDTH, BASES[0])[at], window_hashes(words, WIDTH - 1, BASES[0])
            check = window_hashes(mixed(words), WIDTH, BASES[1])[at]
            first = np.zeros(len(at), bool)
            first[np.unique(edge, return_index=True)[1]] = True
            held.append([np.full(len(at), tid), np.full(len(at), doc), at.astype(np.int32), edge.view(np.int64), check.astype(np.uint32).view(np.int32), nodes[at].view(np.int64), nodes[at + 1].view(np.int64), first])
            rows += len(at)
            if rows >= BATCH_ROWS:
                yield batch_of()
                held, rows = [], 0
    if held:
        yield batch_of()


OCCURRENCE = ["tid", "doc_id", "pos", "edge", "check", "left", "right", "first"]
OCCURRENCE_ROWS = "tid long, doc_id long, pos int, edge long, check int, left long, right long, first boolean"


@F.arrow_udf(T.StructType().add("n_words", "long").add("sha256", "string"))
def word_stats(texts: pa.Array) -> pa.Array:
    """Number of words and SHA-256 of the words joined by one space; null has none."""
    words = [(raw or b"").split() for raw in texts.cast(pa.large_binary()).to_pylist()]
    return pa.array([{"n_words": len(w), "sha256": hashlib.sha256(b" ".join(w)).hexdigest()} for w in words], STATS)


@F.arrow_udf(T.StructType().add("n_removed", "long").add("sha256", "string"))
def removal(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Words covered by spans (start, number of windows) and SHA-256 of the others."""
    out = []
    for text, ranges in zip(texts, spans.to_pylist(), strict=True):
        words = text.as_buffer().to_pybytes().split()
        keep = np.ones(len(words), bool)
        for s in ranges:
            keep[s["start"] : s["start"] + s["windows"] + WIDTH - 1] = False
        kept = b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])
        out.append({"n_removed": int((~keep).sum()), "sha256": hashlib.sha256(kept).hexdigest()})
    return pa.array(out, REMOVED)


STATS = pa.struct([("n_words", pa.int64()), ("sha256", pa.string())])
REMOVED = pa.struct([("n_removed", pa.int64()), ("sha256", pa.string())])


def distinct_texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Statistics of every row, and one row (digest, doc_id, tid) for each distinct text with a window.

    ``doc_id`` is the smallest id that has the text; ``tid`` numbers texts in its order.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), word_stats(F.col(text_col)).alias("words"))
    stats = materialize(rows.select("doc_id", "digest", "words.*"), "documents")
    texts = stats.where((F.col("n_words") >= WIDTH) & F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
    return stats, ranked(texts, [F.col("doc_id"), F.col("digest")], "tid", "texts")


def candidates(texts: DataFrame, words: int) -> DataFrame:
    """``tid``, ``pos``: places of all windows that may stand in two texts (``texts``: tid, text); a row a text."""
    spark = texts.sparkSession
    buckets = max(shuffle_partitions(spark), math.ceil(words / BUCKET_WORDS))
    rows = "bucket int, tid array<long>, n array<int>, pos binary, hash binary"
    blocks = texts.select("tid", "text").mapInArrow(sent(buckets), "bucket int, tid array<long>, n array<int>, pos binary, hash binary")
    key = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64(F.col("tid")[0], "pos"), F.lit(buckets))).otherwise(F.col("bucket"))

    def split(table: pa.Table) -> pa.Table:
        return packed(*(met(table) if table["bucket"][0].as_py() >= 0 else unpacked(table)), buckets)

    parts = blocks.withColumn("key", key).groupBy("key").applyInArrow(split, PACKED_ROWS)
    return materialize(parts.groupBy("part").applyInArrow(gathered, "tid long, pos array<int>"), "candidates")


def repeated_spans(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """tid, doc_id, start, windows, source_tid, source_doc, source_start, path of every span repeated from another text.

    ``docs``: tid, doc_id, text; ``texts``: tid, pos as ``candidates`` gives them. A path is a maximal run of edges through nodes
    with one repeated edge in and one out whose first sources follow each other.
    """
    spark = docs.sparkSession
    places = texts.select("tid", F.col("pos").alias("places"))
    found = materialize(docs.join(places, "tid").select("tid", "doc_id", "text", "places").mapInArrow(graph_edges, OCCURRENCE_ROWS), "occurrences")
    release(spark)
    firsts = F.when(F.col("first"), F.col("tid"))
    edges = found.groupBy("edge", "check").agg(
        F.min("tid").alias("source_tid"),
        F.min_by("pos", firsts).alias("source_start"),
        F.min("doc_id").alias("source_doc"),
        F.max("doc_id").alias("last_doc"),
        F.min("left").alias("left"),
        F.min("right").alias("right"),
    )
    edges = materialize(edges.where("source_doc < last_doc").drop("last_doc"), "edges")
    release(spark)
    ends = F.explode(F.array(F.struct(F.col("left").alias("node"), F.lit(0).alias("into"), F.lit(1).alias("out")), F.struct(F.col("right").alias("node"), F.lit(1).alias("into"), F.lit(0).alias("out"))))
    through = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.into").alias("into"), F.sum("e.out").alias("out")).where("into = 1 and out = 1").select(F.col("node").alias("left"), F.lit(True).alias("plain"))
    along = Window.partitionBy("source_tid").orderBy("source_start")
    opens = F.coalesce(~F.col("plain"), F.lit(True)) | (F.coalesce(F.lag("source_start").over(along), F.lit(-2)) != F.col("source_start") - 1)
    paths = edges.join(through, "left", "left").withColumn("opens", opens)
    paths = paths.withColumn("path", F.max(F.when(F.col("opens"), F.col("source_start"))).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    paths = materialize(paths.select("edge", "check", "source_tid", "source_doc", "source_start", "path"), "paths")
    discard(edges)
    release(spark)
    on = found.select("tid", "doc_id", "pos", "edge", "check").join(paths, ["edge", "check"]).where("tid <> source_tid").drop("edge", "check")
    line = Window.partitionBy("tid").orderBy("pos")
    same = [F.lag(c).over(line).eqNullSafe(F.col(c) - step) for c, step in (("pos", 1), ("source_start", 1), ("source_tid", 0), ("path", 0))]
    stepped = on.withColumn("new", (~(same[0] & same[1] & same[2] & same[3])).cast("int"))
    numbered = stepped.withColumn("span", F.sum("new").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    spans = numbered.groupBy("tid", "span").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("pos").alias("start"),
        F.count(F.lit(1)).cast("int").alias("windows"),
        F.min("source_tid").alias("source_tid"),
        F.min("source_doc").alias("source_doc"),
        F.min("source_start").alias("source_start"),
        F.min("path").alias("path"),
    )
    spans = materialize(spans.drop("span"), "spans")
    discard(found, paths)
    release(spark)
    return spans


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_words, n_removed, kept_sha256.

    A word goes if a window of 13 words that covers it also starts in a document
    with a smaller id; documents with equal ids, repeated rows among them, remove
    nothing from each other. A null text has no words; a row with a null id keeps
    all its words and removes none elsewhere. Texts of fewer than 13 words are
    kept whole, texts of any length taken whole. Other columns of ``docs``, whatever
    their names, play no part and are not returned. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stats, numbered = distinct_texts(docs, id_col, text_col)
    words = numbered.agg(F.sum("n_words")).first()[0] or 0
    numbered = materialize(numbered.select("digest", "doc_id", "tid"), "numbered")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("digest", text_digest(F.col("text"))).join(numbered, ["digest", "doc_id"]).select("tid", "doc_id", "text")
    places = candidates(rows, words)
    release(spark)
    spans = repeated_spans(rows, places)
    taken = spans.where("source_doc < doc_id").groupBy("tid").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))  # at most a document's length
    cut = rows.join(taken, "tid").select("tid", removal("text", "spans").alias("cut")).select("tid", "cut.*")
    cut = materialize(cut.dropDuplicates(["tid"]).withColumnRenamed("sha256", "rest"), "cut")
    release(spark)
    texts = numbered.join(cut, "tid", "left").select("digest", F.col("doc_id").alias("first_doc"), "n_removed", "rest")
    copy = F.col("doc_id") > F.col("first_doc")
    removed = F.when(copy, F.col("n_words")).when(F.col("doc_id").isNotNull(), F.col("n_removed"))
    kept = F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).when(F.col("doc_id").isNotNull(), F.col("rest"))
    return stats.join(texts, "digest", "left").select(
        F.col("doc_id").alias(id_col), "n_words", F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"), F.coalesce(kept, "sha256").alias("kept_sha256")
    )
