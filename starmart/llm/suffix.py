"""Byte-substring dedup by external induced suffix sorting (operator 7).

Two equal strings of 100 bytes have the same least-hashed 32-byte piece at the
same place (their anchor), so every window belongs to one anchor and equal windows
have equal anchors. Anchors met once need no sorting. Around the others, each run
of windows with the same anchor leaves as one short string; strings of one anchor
meet in one shard, equal ones are collapsed, and the different ones are suffix
sorted by induction (``induced``): neighbours with 100 bytes in common are equal
windows, of which all but the earliest are removed. Anchors with many different
runs (one passage in many contexts) are not sorted: their windows are compared by
digest, first inside a batch and then over all batches, so no shard grows with them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import materialize

from .common import ranked, release, shuffle_partitions, text_digest
from .debruijn import listed, mixed, planes, unplanes
from .induced import suffix_order

WIDTH = 100  # bytes of a window
PIECE = 32  # bytes of an anchor, a power of two
SLIDE = WIDTH - PIECE + 1  # pieces in a window
CHUNK = 1 << 19  # windows of a text looked at together
PLACE_BITS = 20
BLOCK_ANCHORS = 1 << 19  # anchors sent together
BUCKET_ANCHORS = 1 << 22
SHARD_STRINGS = 1 << 14  # of up to WIDTH + SLIDE bytes
SHARD_PARTS = 16  # anchors of a shard are first counted in so many parts
ANCHOR_STRINGS = 1 << 11  # an anchor with more different runs is not sorted
GROW = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


def piece_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit number for each run of ``PIECE`` bytes, built from halves."""
    h, size = mixed(data.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D)), 1
    for g in GROW:
        h = h[:-size] * np.uint64(g) + h[size:]
        size *= 2
    return mixed(h)


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` numbers."""
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[: len(v) - (width - size)], v[width - size :]) if width > size else v


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each anchor of a text, and the first and last start of the windows it owns.

    Of equally small pieces the first is the anchor; runs are in text order.
    """
    data = np.frombuffer(raw, np.uint8)
    windows = len(data) - WIDTH + 1
    out = []
    for at in range(0, max(windows, 0), CHUNK):
        part = data[at : min(at + CHUNK, windows) + WIDTH - 1]
        h = piece_hashes(part)
        low = np.uint64((1 << PLACE_BITS) - 1)
        owner = (sliding_least((h & ~low) | np.arange(len(h), dtype=np.uint64), SLIDE) & low).astype(np.int64)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        last = np.append(first[1:], len(owner)) - 1
        out.append((h[owner[first]], owner[first] + at, first + at, last + at))
    if not out:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def sent(buckets: int):
    """Blocks of documents to rows (bucket, tid, n, pos, hash): each anchor hash once a block.

    Bucket -1 holds the anchors met more than once in a block.
    """
    schema = pa.schema([("bucket", pa.int32()), ("tid", pa.list_(pa.int64())), ("n", pa.list_(pa.int32())), ("pos", pa.binary()), ("hash", pa.binary())])

    def rows(tids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc = np.repeat(np.arange(len(tids)), sizes)
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        count = np.diff(np.append(np.flatnonzero(first), len(ordered)))
        leads, again = np.empty(len(hashes), bool), np.empty(len(hashes), bool)
        leads[order], again[order] = first, np.repeat(count > 1, count)
        to = (hashes % np.uint64(buckets)).astype(np.int32)
        out = []
        for chosen, target in ((leads, to), (again, np.full(len(hashes), -1, np.int32))):
            at = np.flatnonzero(chosen)
            at = at[np.argsort(target[at], kind="stable")]
            for group in np.split(at, np.flatnonzero(np.diff(target[at])) + 1):
                if len(group):
                    edges = np.flatnonzero(np.diff(doc[group], prepend=-1))
                    bits = (hashes[group] // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
                    n = np.diff(edges, append=len(group))
                    out.append((int(target[group[0]]), tids[doc[group[edges]]], n, planes(pos[group]), bits.astype("<u4").tobytes() if chosen is leads else b""))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tids, sizes, hashes, places, held = [], [], [], [], 0
        for batch in batches:
            for tid, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found, at, _, _ = anchors(text.as_buffer().to_pybytes())
                if len(found):
                    tids.append(tid)
                    sizes.append(len(found))
                    hashes.append(found)
                    places.append(at)
                    held += len(found)
                if held >= BLOCK_ANCHORS:
                    yield from rows(np.array(tids), np.array(sizes), np.concatenate(hashes), np.concatenate(places))
                    tids, sizes, hashes, places, held = [], [], [], [], 0
        if held:
            yield from rows(np.array(tids), np.array(sizes), np.concatenate(hashes), np.concatenate(places))

    return send


def met(table: pa.Table) -> pa.Table:
    """Places of the anchors of a bucket that were sent more than once, or that repeat inside a block."""
    tid = np.concatenate([np.repeat(np.array(t, np.int64), n) for t, n in zip(table["tid"].to_pylist(), table["n"].to_pylist(), strict=True)])
    pos = np.concatenate([unplanes(x.as_buffer()) for x in table["pos"]])
    if table["bucket"][0].as_py() >= 0:
        bits = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in table["hash"]])
        _, group, count = np.unique(bits, return_inverse=True, return_counts=True)
        again = count[group] > 1
        tid, pos = tid[again], pos[again]
    order = np.lexsort((pos, tid))
    return listed(tid[order], pos[order])


RUN = pa.schema([("anchor", pa.int64()), ("tid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("lead", pa.int32()), ("run", pa.binary())])
RUN_ROWS = "anchor long, tid long, doc_id long, start long, windows long, lead int, run binary"
BATCH_ROWS = 30_000
BATCH_WINDOWS = 1 << 18  # of runs whose windows are compared together


def collapsed(rows: list[list]) -> pa.RecordBatch:
    """Rows of ``RUN``; those with an equal earlier run among them go without its bytes."""
    seen: dict[tuple, list[int]] = {}
    for k, row in enumerate(rows):
        seen.setdefault((row[5], row[6]), []).append(k)
    place = lambda k: (rows[k][2], rows[k][1], rows[k][3])  # noqa: E731  doc_id, tid, start
    for same in seen.values():
        same.sort(key=place)
        own = same[0]  # the first of its text
        for k in same[1:]:
            own = own if rows[k][1] == rows[own][1] else k
            if rows[k][2] > rows[same[0]][2] or rows[k][3] > rows[own][3]:
                rows[k][6] = None
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), RUN, strict=True)], schema=RUN)


def anchored_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each repeated anchor: rows (anchor hash, tid, doc_id, start, windows, lead, run).

    ``run`` holds the bytes of the windows and ``lead`` the anchor's place in it. Of
    equal runs handled together the later ones go without bytes (they are removed
    whatever else is found), so common runs stay few.
    """
    rows: list[list] = []
    for batch in batches:
        for tid, doc, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
            raw = text.as_buffer().to_pybytes()
            h, at, lo, hi = anchors(raw)
            chosen = np.isin(at, places.values.to_numpy())
            for a, p, b, e in zip(h[chosen].view(np.int64).tolist(), at[chosen].tolist(), lo[chosen].tolist(), hi[chosen].tolist(), strict=True):
                rows.append([a, tid, doc, b, e - b + 1, p - b, raw[b : e + WIDTH]])
                if len(rows) >= BATCH_ROWS:
                    yield collapsed(rows)
                    rows = []
    if rows:
        yield collapsed(rows)


REPEATS = pa.schema([("tid", pa.int64()), ("start", pa.int64()), ("windows", pa.int64())])
REPEAT_ROWS = "tid long, start long, windows long"


def later(group: np.ndarray, doc: np.ndarray, tid: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether an equal window (same group) starts in a document with a smaller id, or earlier in the same text."""
    order = np.lexsort((start, tid, doc, group))
    g, d, t, s = group[order], doc[order], tid[order], start[order]
    first = np.concatenate([[True], g[1:] != g[:-1]])
    least = d[first][np.cumsum(first) - 1]
    own = first | np.concatenate([[True], t[1:] != t[:-1]])
    out = np.empty(len(group), bool)
    out[order] = (d > least) | (s > s[own][np.cumsum(own) - 1])
    return out


def equal_windows(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """String, place and class of each window; equal windows have equal classes."""
    places, lcp, starts = suffix_order(strings, WIDTH)
    klass = np.cumsum(lcp < WIDTH)
    which = np.searchsorted(starts, places, "right") - 1
    place = places - starts[which]
    inside = place + WIDTH <= np.array([len(s) for s in strings])[which]
    return which[inside], place[inside], klass[inside]


def consecutive(tid: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows in order, those that follow one another joined."""
    order = np.lexsort((start, tid))
    t, a, n = tid[order], start[order], windows[order]
    joined = np.concatenate([[True], (t[1:] != t[:-1]) | (a[1:] != a[:-1] + n[:-1])]) if len(t) else np.zeros(0, bool)
    heads = np.flatnonzero(joined)
    return t[heads], a[heads], np.add.reduceat(n, heads) if len(heads) else n


def repeats_of(table: pa.Table) -> pa.Table:
    """Windows of a shard's runs that also start earlier, as (tid, start, windows) with consecutive starts joined."""
    anchor, tid, doc, start, lead = (table[c].to_numpy() for c in ("anchor", "tid", "doc_id", "start", "lead"))
    runs = table["run"].to_pylist()
    names: dict[tuple, int] = {}
    name = np.array([names.setdefault((int(p), r), len(names)) for p, r in zip(lead, runs, strict=True)])
    size = np.array([len(r) - WIDTH + 1 for r in runs])
    whole = later(name, doc, tid, start)
    found = [(tid[whole], start[whole], size[whole])]

    own = np.zeros(len(names), np.int64)
    own[name] = anchor
    _, group, count = np.unique(own, return_inverse=True, return_counts=True)
    mixed_names = np.flatnonzero(count[group] > 1)  # different runs around one anchor
    if len(mixed_names):
        strings = [r for _, r in names]
        which, place, klass = equal_windows([strings[k] for k in mixed_names.tolist()])
        rank = np.full(len(names), -1)
        rank[mixed_names] = np.arange(len(mixed_names))
        rest = np.flatnonzero((rank[name] >= 0) & ~whole)
        by_name = rest[np.argsort(rank[name[rest]], kind="stable")]
        bounds = np.searchsorted(rank[name[by_name]], np.arange(len(mixed_names) + 1))
        times = np.diff(bounds)[which]  # rows that hold the window's string and are not removed already
        row = by_name[np.repeat(bounds[which], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
        at = start[row] + np.repeat(place, times)
        gone = later(np.repeat(klass, times), doc[row], tid[row], at)
        found.append((tid[row][gone], at[gone], np.ones(int(gone.sum()), np.int64)))
    return pa.Table.from_arrays([pa.array(c) for c in consecutive(*(np.concatenate(c) for c in zip(*found, strict=True)))], schema=REPEATS)


CUT_RUN = pa.schema([("key", pa.int64()), ("tid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("run", pa.binary())])
CUT_ROWS = "key long, tid long, doc_id long, start long, run binary"


def cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (tid, doc_id, start, lead, run) cut where the next-least piece of their windows changes; the key stands
    for both pieces and their distance, so equal windows have equal keys."""
    low = np.uint64((1 << PLACE_BITS) - 1)
    rows: list[tuple] = []
    for batch in batches:
        for tid, doc, start, lead, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            h = piece_hashes(np.frombuffer(raw, np.uint8))
            v = (h & ~low) | np.arange(len(h), dtype=np.uint64)
            v[lead] = np.uint64(2**64 - 1)
            second = (sliding_least(v, SLIDE) & low).astype(np.int64)
            first = np.flatnonzero(np.diff(second, prepend=-1))
            last = np.append(first[1:], len(second)) - 1
            at = second[first]
            keys = mixed(h[lead] * np.uint64(GROW[0]) + h[at] * np.uint64(GROW[1]) + (at - lead).astype(np.uint64)).view(np.int64)
            rows += [(k, tid, doc, start + a, raw[a : b + WIDTH]) for k, a, b in zip(keys.tolist(), first.tolist(), last.tolist(), strict=True)]
            if len(rows) >= BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), CUT_RUN, strict=True)], schema=CUT_RUN)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), CUT_RUN, strict=True)], schema=CUT_RUN)


WINDOW = pa.schema([("tid", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("windows", pa.int64()), ("key", pa.binary())])
WINDOW_ROWS = "tid long, doc_id long, start long, windows long, key binary"


def first_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs to rows of ``WINDOW``: with ``key``, a digest, the windows that start first among those handled
    together, in the least document or in their text; without, the others, which are removed, by runs."""

    def rows(tids: list, docs: list, starts: list, runs: list[bytes]) -> pa.RecordBatch:
        size = np.array([len(r) - WIDTH + 1 for r in runs])
        run = np.repeat(np.arange(len(runs)), size)
        inside = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        known: dict[bytes, int] = {}
        group = np.array([known.setdefault(r[k : k + WIDTH], len(known)) for r in runs for k in range(len(r) - WIDTH + 1)])
        tid, doc, start = np.array(tids)[run], np.array(docs)[run], np.array(starts)[run] + inside
        gone = later(group, doc, tid, start)
        t, a, n = consecutive(tid[gone], start[gone], np.ones(int(gone.sum()), np.int64))
        d = np.zeros(len(t), np.int64)  # not needed for removed windows
        keys = np.array([hashlib.blake2b(w, digest_size=16).digest() for w in known], object)[group[~gone]].tolist()
        columns = [(t, tid[~gone]), (d, doc[~gone]), (a, start[~gone]), (n, np.ones(len(keys), np.int64))]
        return pa.RecordBatch.from_arrays([*(pa.array(np.concatenate(c)) for c in columns), pa.array([None] * len(t) + keys, pa.binary())], schema=WINDOW)

    held: tuple[list, list, list, list] = ([], [], [], [])
    for batch in batches:
        for k in range(batch.num_rows):
            for column, values in zip(held, batch.columns, strict=True):
                column.append(values[k].as_py())
            if len(held[0]) >= BATCH_WINDOWS // SLIDE:
                yield rows(*held)
                held = ([], [], [], [])
    if held[0]:
        yield rows(*held)


def compared_windows(runs: DataFrame) -> DataFrame:
    """``repeats_of`` for any number of different runs around one anchor: no window meets more than one row a batch.

    Equal windows are found by 128-bit digests; a window's rows (one a batch, or one a text where
    texts share the least id) pass through a sort that spills.
    """
    cut = materialize(runs.select("tid", "doc_id", "start", "lead", "run").mapInArrow(cut_runs, CUT_ROWS), "cut-runs")
    again = cut.groupBy("key").count().where("count > 1").select("key")
    shared = cut.join(again, "key", "left_semi")
    windows = materialize(shared.select("tid", "doc_id", "start", "run").mapInArrow(first_windows, WINDOW_ROWS), "windows")
    least = F.min("doc_id").over(Window.partitionBy("key"))
    own = F.min("start").over(Window.partitionBy("key", "tid"))
    met = windows.where("key IS NOT NULL").withColumn("own", own).withColumn("least", least)
    gone = met.where("doc_id > least OR start > own").unionByName(windows.where("key IS NULL"), allowMissingColumns=True)
    return gone.select("tid", "start", "windows")


CUT = T.StructType().add("n_removed", "long").add("n_spans", "long").add("sha256", "string")


@F.arrow_udf(CUT)
def removal(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Bytes covered by repeated windows, their maximal runs, and SHA-256 of the bytes left."""
    out = []
    for text, ranges in zip(texts, spans.to_pylist(), strict=True):
        raw = np.frombuffer(text.as_buffer(), np.uint8)
        edge = np.zeros(len(raw) + 1, np.int64)
        for s in ranges:
            edge[s["start"]] += 1
            edge[s["start"] + s["windows"] + WIDTH - 1] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        runs = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        out.append({"n_removed": int(gone.sum()), "n_spans": runs, "sha256": hashlib.sha256(raw[~gone].tobytes()).hexdigest()})
    return pa.array(out, pa.struct([("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha256", pa.string())]))


def repeated_windows(texts: DataFrame, n_bytes: int) -> DataFrame:
    """``tid``, ``start``, ``windows``: starts of all 100-byte windows that also start earlier, by runs.

    ``texts``: tid, doc_id, text, with tids in the order of doc_id.
    """
    spark = texts.sparkSession
    buckets = max(shuffle_partitions(spark), math.ceil(2 * n_bytes / SLIDE / BUCKET_ANCHORS))
    packed = texts.select("tid", "text").mapInArrow(sent(buckets), "bucket int, tid array<long>, n array<int>, pos binary, hash binary")
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64(F.col("tid")[0], "pos"), F.lit(buckets))).otherwise(F.col("bucket"))
    places = materialize(packed.withColumn("key", spread).groupBy("key").applyInArrow(met, "tid long, pos array<int>"), "anchors")
    release(spark)
    held = places.groupBy("tid").agg(F.flatten(F.collect_list("pos")).alias("places"))  # at most a document's length
    rows = texts.join(held, "tid").select("tid", "doc_id", "text", "places").mapInArrow(anchored_runs, RUN_ROWS)
    rows = materialize(rows, "runs")
    release(spark)
    routed = rows.where("run IS NOT NULL")
    shards = max(shuffle_partitions(spark), math.ceil(routed.count() / SHARD_STRINGS))
    routed = routed.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(SHARD_PARTS * shards)))
    parts = routed.groupBy("part").count().where(F.col("count") > ANCHOR_STRINGS).select("part")
    crowded = routed.join(parts, "part", "left_semi").groupBy("anchor").count().where(F.col("count") > ANCHOR_STRINGS)
    crowded = materialize(crowded.select("anchor"), "crowded")
    sorted_runs, others = routed, []
    if not crowded.isEmpty():
        sorted_runs = routed.join(crowded, "anchor", "left_anti")
        others = [compared_windows(routed.join(crowded, "anchor", "left_semi"))]
    found = sorted_runs.withColumn("shard", F.pmod("part", F.lit(shards))).groupBy("shard").applyInArrow(repeats_of, REPEAT_ROWS)
    known = rows.where("run IS NULL").select("tid", "start", "windows")
    found = materialize(reduce(DataFrame.unionByName, [known, *others], found), "repeats")
    release(spark)
    return found


@F.arrow_udf(T.StringType())
def sha256(texts: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(raw or b"").hexdigest() for raw in texts.cast(pa.large_binary()).to_pylist()])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of 100 bytes that covers it also starts in a document
    with a smaller id or earlier in the same text; documents with equal ids,
    repeated rows among them, remove nothing from each other. A null text is empty;
    a row with a null id keeps all its bytes and removes none elsewhere. Texts of
    fewer than 100 bytes are kept whole, texts of any length taken whole. Other columns
    of ``docs``, whatever their names, play no part and are not returned. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("digest", text_digest(F.col("text")))
    stats = materialize(rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")), "documents")
    firsts = stats.where((F.col("n_bytes") >= WIDTH) & F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"))
    numbered = ranked(firsts, [F.col("doc_id"), F.col("digest")], "tid", "texts")
    n_bytes = numbered.agg(F.sum("n_bytes")).first()[0] or 0
    numbered = materialize(numbered.select("digest", "doc_id", "tid"), "numbered")
    texts = rows.join(numbered, ["digest", "doc_id"]).select("tid", "doc_id", "text")
    spans = repeated_windows(texts, n_bytes)
    taken = spans.groupBy("tid").agg(F.collect_list(F.struct("start", "windows")).alias("spans"))  # at most a document's length
    cut = texts.join(taken, "tid").select("tid", removal("text", "spans").alias("cut")).select("tid", "cut.n_removed", "cut.n_spans", F.col("cut.sha256").alias("rest"))
    cut = materialize(cut.dropDuplicates(["tid"]), "cut")
    release(spark)
    of = numbered.join(cut, "tid", "left").select("digest", F.col("doc_id").alias("first_doc"), "n_removed", "n_spans", "rest")
    copy, known = F.col("doc_id") > F.col("first_doc"), F.col("doc_id").isNotNull()
    pick = lambda whole, part: F.when(copy, whole).when(known, part)
    return stats.join(of, "digest", "left").select(
        F.col("doc_id").alias(id_col),
        "n_bytes",
        F.coalesce(pick(F.col("n_bytes"), F.col("n_removed")), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(pick(F.lit(1), F.col("n_spans")), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(pick(F.lit(hashlib.sha256(b"").hexdigest()), F.col("rest")), "sha256").alias("kept_sha256"),
    )
