"""Benchmark decontamination with one Aho-Corasick automaton (operator 5).

Spark normalises test questions and answers to words, cuts them into windows and stores
each distinct window once with its items. The windows are put into one automaton; each
document is normalised the same way and scanned once. Matches are mapped back to
word numbers and to character offsets of the original text. The windows travel as a
broadcast of about ``BLOCK_BYTES``. A larger benchmark is cut by hash into blocks of that size,
each with an automaton and a pass over the documents of its own; the passes' ranges are stored
and united, so driver and tasks hold one block at a time and no window is left out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialize

from .common import free_names, text_digest

WINDOW = 13  # words
BLOCK_BYTES = 32 << 20  # of windows and item ids in one automaton
BATCH_ROWS = 10_000  # windows cut from an item at a time
#: A document is contaminated if hit words times this reach its words.
HIT_SHARE = 20
#: Bytes of a word stay (A-Z lower-cased, bytes of non-ASCII characters as they are), all others become a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
RANGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
FOUND = pa.struct([("ranges", RANGES), ("items", pa.list_(pa.string()))])
FOUND_TYPE = "ranges array<struct<start:int,end:int>>, items array<string>"
RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", RANGES)])
RESULT_TYPE = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items (id, text) to rows (window, item): normalised windows with a space before and after."""
    for batch in batches:
        for item, text in zip(*batch.columns, strict=True):
            words = text.as_buffer().to_pybytes().translate(FOLD).split()
            n = max(len(words) - WINDOW + 1, 1 if words else 0)
            for at in range(0, n, BATCH_ROWS):
                found = [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(at, min(at + BATCH_ROWS, n))]
                yield pa.record_batch([pa.array(found, pa.binary()), pa.array([item.as_py()] * len(found), pa.string())], ["window", "item"])


def stored_windows(items: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows (window, items, block) of the distinct windows, and the number of blocks they take."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(text_col), F.lit("")))
    stored = materialize(rows.mapInArrow(cut, "window binary, item string").groupBy("window").agg(F.collect_set("item").alias("items")), "windows")
    held = stored.agg(F.sum(F.length("window") + F.length(F.array_join("items", ",")))).first()[0] or 0
    blocks = max(1, math.ceil(held / BLOCK_BYTES))
    return stored.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)).cast("int")), blocks


def block_of(stored: DataFrame, number: int) -> dict:
    """One block's windows with their items."""
    got = stored.where(F.col("block") == number).select("window", "items").toArrow()
    return {"windows": dict(zip(got["window"].to_pylist(), map(tuple, got["items"].to_pylist()), strict=True))}


def automaton(block: dict) -> ahocorasick.Automaton | None:
    """The block's automaton, kept in the broadcast value for the worker's later tasks."""
    if "automaton" not in block:
        made = ahocorasick.Automaton()
        for w, items in block["windows"].items():
            made.add_word(w.decode("latin-1"), (w.count(b" ") - 1, items))
        made.make_automaton()
        block["automaton"] = made if block["windows"] else None
    return block["automaton"]


def runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of maximal runs of true values, and the places after their last."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


class Words:
    """Normalised words of one text."""

    def __init__(self, raw: bytes):
        self.folded = raw.translate(FOLD)
        self.words = self.folded.split()

    def covered(self, ranges: list[tuple[int, int]]) -> np.ndarray:
        mark = np.zeros(len(self.words) + 1, np.int64)
        if ranges:
            first, after = np.array(ranges).T
            np.add.at(mark, first, 1)
            np.add.at(mark, after, -1)
        return np.cumsum(mark)[:-1] > 0

    def found(self, machine: ahocorasick.Automaton | None) -> tuple[list[tuple[int, int]], list[str]]:
        """Runs of words covered by windows of the automaton, and its items found, sorted."""
        line = b" " + b" ".join(self.words) + b" "
        matches = list(machine.iter(line.decode("latin-1"))) if machine and self.words else []
        if not matches:
            return [], []
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        ends = np.searchsorted(gaps, [end for end, _ in matches]).tolist()
        hit = self.covered([(end - width, end) for end, (_, (width, _)) in zip(ends, matches, strict=True)])
        items = {i for held in {held for _, (_, held) in matches} for i in held}
        return list(zip(*(x.tolist() for x in runs(hit)), strict=True)), sorted(items)

    def result(self, ranges: list[tuple[int, int]], items: list[str]) -> dict:
        hit = self.covered(ranges)
        first, after = runs(hit)
        spans = []
        if len(first):
            data = np.frombuffer(self.folded, np.uint8)
            begins, ends = runs(data != 32)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(chars[begins[first]], chars[ends[after - 1]], strict=True)]
        return {"n_words": len(self.words), "n_hit": int(hit.sum()), "items": items, "spans": spans}


def words_in(text: pa.Scalar) -> Words:
    return Words(text.as_buffer().to_pybytes() if text.is_valid else b"")


def scanning(shared) -> tuple[Callable[[Column], Column], Callable[[Column], Column]]:
    """Functions of a text for the block in the broadcast ``shared``: its whole result, and only what was found."""

    @F.arrow_udf(RESULT_TYPE)
    def whole(texts: pa.Array) -> pa.Array:
        machine = automaton(shared.value)
        return pa.array([w.result(*w.found(machine)) for w in map(words_in, texts)], RESULT)

    @F.arrow_udf(FOUND_TYPE)
    def part(texts: pa.Array) -> pa.Array:
        machine = automaton(shared.value)
        found = (words_in(t).found(machine) for t in texts)
        return pa.array([{"ranges": [{"start": a, "end": b} for a, b in ranges], "items": items} for ranges, items in found], FOUND)

    return whole, part


def united(texts: pa.Array, ranges: pa.Array, items: pa.Array) -> pa.Array:
    """The result of a text from the ranges and items of all passes."""
    rows = zip(texts, ranges.to_pylist(), items.to_pylist(), strict=True)
    return pa.array([words_in(t).result([(r["start"], r["end"]) for r in held or ()], sorted(names or ())) for t, held, names in rows], RESULT)


def with_hits(docs: DataFrame, items: DataFrame, out: str, text_col: str = "text", id_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_hit, items (ids as strings, sorted) and spans.

    A window is 13 consecutive words of an item, or all its words if it has fewer;
    spans are maximal runs of hit words as character offsets of the original text.
    Null and empty texts have no words, items without words have no window, an
    item id that is null counts as the item ``null``, repeated items count once,
    and an empty benchmark hits nothing. Repeated rows are marked one by one, texts of any length scanned whole;
    other columns, whatever their names, pass through.
    """
    context = docs.sparkSession.sparkContext
    stored, blocks = stored_windows(items, id_col, item_text)
    if blocks == 1:
        whole, _ = scanning(context.broadcast(block_of(stored, 0)))
        return docs.withColumn(out, whole(F.col(text_col)))
    digest, ranges, names = free_names([*docs.columns, out], "_digest", "_ranges", "_items")
    key = text_digest(F.coalesce(F.col(text_col), F.lit(""))).alias(digest)
    passes = []
    for number in range(blocks):
        shared = context.broadcast(block_of(stored, number))
        found = docs.select(key, scanning(shared)[1](F.col(text_col)).alias("found")).where(F.size("found.ranges") > 0)
        passes.append(materialize(found.groupBy(digest).agg(F.any_value("found").alias("found")), "pass"))
        shared.destroy()
    every = passes[0]
    for one in passes[1:]:
        every = every.unionByName(one)
    # at most a row a pass for each text
    held = every.groupBy(digest).agg(F.flatten(F.collect_list("found.ranges")).alias(ranges), F.array_distinct(F.flatten(F.collect_list("found.items"))).alias(names))
    marked = docs.withColumn(digest, key).join(held, digest, "left")
    unite = F.arrow_udf(united, RESULT_TYPE)
    return marked.withColumn(out, unite(F.col(text_col), F.col(ranges), F.col(names))).select(*docs.columns, out)


def contaminated(hits: Column) -> Column:
    return (hits["n_hit"] > 0) & (hits["n_hit"] * HIT_SHARE >= hits["n_words"])


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; all columns pass through, documents without words stay."""
    (hits,) = free_names(docs, "_hits")
    marked = with_hits(docs, items, hits, text_col)
    return marked.where(~contaminated(F.col(hits))).select(*docs.columns)
