"""Periodic runs of words by block convolution (operator 11).

A run is a longest stretch of words with smallest period q and at least
``max(6, 4 * q)`` words. A run whose period is in [Q, 2Q) holds a whole aligned
block of Q words together with the block's copy q words on, so at each power of
two Q every aligned block is compared with the window of words that follows it:
words get small integer codes, and a number-theoretic transform gives, exactly,
the sum of squared differences of block and window at every distance. Where it
is zero the words themselves are compared, and the distance is extended both ways
as far as words that far apart are equal.

Transforms of all blocks of many documents are taken at once: a transform is a
few small matrix products over residues, held in doubles that stay below 2^53.
The transform of a block serves as block, as first and as second half of a window.
Documents are independent, so nothing is shuffled; a task holds one slice of
documents and, at a scale, a bounded number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names

LEAST = 6  # words of a run at least
EXPONENT = 4  # periods of a run at least
PRIME = 7 * (1 << 20) + 1  # 3 generates its residues
LONGEST_BLOCK = 1 << 10  # words of a block that are transformed; all of a longer block are compared afterwards
RADIX = 5  # bits of the transform done by one matrix product
SLICE_WORDS = 1 << 17  # words of the documents taken together
CHUNK_CELLS = 1 << 16  # cells transformed together
COMPARED_CELLS = 1 << 20  # words compared together


def residues(x: np.ndarray) -> np.ndarray:
    """Each whole number's residue nearest to 0, in place; multiples of the prime give 0 and only they do."""
    x -= np.rint(x * (1.0 / PRIME)) * PRIME
    return x


@lru_cache(maxsize=64)
def powers(size: int, sign: int) -> np.ndarray:
    """w^0 .. w^(size-1) for a root w of order ``size``."""
    w, out = pow(3, (PRIME - 1) // size * sign % (PRIME - 1), PRIME), np.ones(1, np.int64)
    while len(out) < size:
        out = np.concatenate([out, out * pow(w, len(out), PRIME) % PRIME])
    return residues(out.astype(np.float64))


@lru_cache(maxsize=64)
def steps(size: int) -> list[tuple[int, int, int]]:
    """(groups, radix, rest) of the steps that make a transform."""
    out, lead = [], 1
    while size > 1:
        radix = min(size, 1 << RADIX)
        size //= radix
        out.append((lead, radix, size))
        lead *= radix
    return out


@lru_cache(maxsize=256)
def matrix(radix: int, sign: int, scale: int = 1) -> np.ndarray:
    """The transform of ``radix`` numbers, divided by ``scale``."""
    k = np.arange(radix)
    return residues(powers(radix, sign)[np.outer(k, k) % radix] * float(pow(scale, -1, PRIME)))


@lru_cache(maxsize=64)
def twiddles(radix: int, rest: int, sign: int) -> np.ndarray:
    return powers(radix * rest, sign)[np.outer(np.arange(radix), np.arange(rest))][None, :, :, None]


@lru_cache(maxsize=32)
def frequencies(size: int) -> np.ndarray:
    """The frequency at each place of a spectrum; the digits of steps stand first digit first."""
    out = np.zeros(1, np.int64)
    for lead, radix, _ in steps(size):
        out = (out[:, None] + lead * np.arange(radix)).ravel()
    return out


@lru_cache(maxsize=32)
def mirrored(size: int) -> np.ndarray:
    """Place of the opposite frequency."""
    f = frequencies(size)
    place = np.empty(size, np.int64)
    place[f] = np.arange(size)
    return place[-f % size]


def spectrum(x: np.ndarray) -> np.ndarray:
    """Transform of each column of ``x`` (size, columns), frequencies in the order of ``frequencies``."""
    size, m = x.shape
    for lead, radix, rest in steps(size):
        x = residues(np.matmul(matrix(radix, 1), x.reshape(lead, radix, rest * m)))
        if rest > 1:
            x = residues(x.reshape(lead, radix, rest, m) * twiddles(radix, rest, 1))
    return x.reshape(size, m)


def inverse(x: np.ndarray) -> np.ndarray:
    """The columns whose ``spectrum`` is ``x``."""
    size, m = x.shape
    for lead, radix, rest in reversed(steps(size)):
        if rest > 1:
            x = residues(x.reshape(lead, radix, rest, m) * twiddles(radix, rest, -1))
        x = residues(np.matmul(matrix(radix, -1, size if lead == 1 else 1), x.reshape(lead, radix, rest * m)))
    return x.reshape(size, m)


def zero_distances(rows: np.ndarray, every: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block, distance) of all zero sums of squared differences, ``rows`` (codes of rows of one length) taken as blocks.

    Each ``every``-th row is a block; distances go from ``every`` to below 2 * ``every`` rows.
    """
    n, width = rows.shape
    step = max(1, CHUNK_CELLS // (2 * width * every)) * every
    odd = 1.0 - 2.0 * (frequencies(2 * width) & 1)[:, None]
    for at in range(0, n, step):
        part = rows[at : at + step + 2 * every + 1].T
        x = np.zeros((2 * width, max(part.shape[1], 2 * every + 2)))
        x[:width, : part.shape[1]] = part
        z = spectrum(x)
        blocks = np.arange(0, min(step, n - at), every)
        blocks = blocks[blocks + every < n - at]
        opposite = z[mirrored(2 * width)][:, blocks]
        squares = np.zeros((width + 1, x.shape[1]))
        np.cumsum(x[:width] ** 2, axis=0, out=squares[1:])
        for t in range(every, 2 * every):
            use = blocks + t + 1 < x.shape[1]
            b = blocks[use]
            product = opposite[:, use] * (z[:, b + t] + odd * z[:, b + t + 1])
            sums = squares[-1, b] + squares[-1, b + t] - squares[:-1, b + t] + squares[:-1, b + t + 1]
            sums -= 2 * inverse(residues(product))[:width]
            where, block = np.nonzero(residues(sums) == 0)
            if len(block):
                yield at + b[block], t * width + where


def codes(ids: np.ndarray, width: int) -> np.ndarray:
    """Words as integers from 0, so small that ``width`` squared differences sum to less than the prime."""
    most = int(((PRIME - 1) // width) ** 0.5)
    h = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((h ^ (h >> np.uint64(31))) % np.uint64(most + 1)).astype(np.float64)


def equal_for(ids: np.ndarray, at: np.ndarray, far: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on (``way`` 1) or back (-1), at most ``room``, equal those ``far`` on."""
    out = np.zeros(len(at), np.int64)
    open_, width = np.flatnonzero(room > 0), 16
    while len(open_):
        left = []
        share = max(1, COMPARED_CELLS // width)
        for k in range(0, len(open_), share):
            c = open_[k : k + share]
            step = out[c][:, None] + np.arange(width)
            inside = step < room[c][:, None]
            i = np.where(inside, at[c][:, None] + way * step, 0)
            same = inside & (ids[i] == ids[np.where(inside, i + far[c][:, None], 0)])
            n = np.where(same.all(1), width, same.argmin(1))
            out[c] += n
            left.append(c[n == width])
        open_ = np.concatenate(left)
        width = min(2 * width, COMPARED_CELLS)
    return out


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs (document, start, length, period), sorted, of documents of ``sizes`` words whose words have numbers ``ids``.

    Starts count from the document's word 0; numbers of different documents are not compared.
    """
    ends = np.cumsum(sizes)
    begins = ends - sizes
    found: list[tuple[int, int, int]] = []  # start and end among all words, period
    known: dict[tuple[int, int], int] = {}  # period by start and end
    holder = np.full(len(ids), -1, np.int32)  # of each word the longest run found that has it
    held = np.zeros(len(ids), np.int64)  # and that run's length
    scale = 1
    while scale == 1 or len(sizes) and sizes.max() >= EXPONENT * scale:
        chosen = np.flatnonzero(sizes >= max(LEAST, EXPONENT * scale))
        if not len(chosen):
            break
        width = min(scale, LONGEST_BLOCK)
        rows_of = -(-sizes[chosen] // scale) * (scale // width)
        first = np.cumsum(rows_of) - rows_of
        cells = np.zeros((int(rows_of.sum()), width))
        into = np.repeat(first * width - begins[chosen], sizes[chosen])
        words = np.arange(len(into)) + np.repeat(begins[chosen] - (np.cumsum(sizes[chosen]) - sizes[chosen]), sizes[chosen])
        cells.ravel()[words + into] = codes(ids[words], width)
        hits = list(zero_distances(cells, scale // width))
        if hits:
            block, far = (np.concatenate(c) for c in zip(*hits, strict=True))
            doc = np.searchsorted(first, block, "right") - 1
            at = begins[chosen][doc] + (block - first[doc]) * width
            end = ends[chosen][doc]
            keep = at + far + scale <= end
            block, far, doc, at, end = (c[keep] for c in (block, far, doc, at, end))
            if found:  # blocks inside a known run whose period divides the distance say nothing new
                runs = np.array(found)
                h = holder[at]
                start, stop, period = runs[h].T
                new = (h < 0) | (at < start) | (at + far + scale > stop) | (far % period != 0)
                far, doc, at, end = (c[new] for c in (far, doc, at, end))
            same = equal_for(ids, at, far, np.full(len(at), scale), 1) == scale
            order = np.lexsort((at, far))
            order = order[same[order]]
            far, doc, at, end = (c[order] for c in (far, doc, at, end))
            opens = np.ones(len(at), bool)  # blocks that follow each other at one distance are one stretch
            opens[1:] = (far[1:] != far[:-1]) | (doc[1:] != doc[:-1]) | (at[1:] != at[:-1] + scale)
            heads = np.flatnonzero(opens)
            tails = np.append(heads[1:], len(at))[: len(heads)] - 1
            far, low, end = far[heads], begins[chosen][doc[heads]], end[heads]
            start = at[heads] - equal_for(ids, at[heads] - 1, far, at[heads] - low, -1)
            stop = at[tails] + scale
            stop = stop + equal_for(ids, stop, far, end - far - stop, 1) + far
            long = stop - start >= np.maximum(LEAST, EXPONENT * far)
            for s, e, q in sorted(zip(start[long].tolist(), stop[long].tolist(), far[long].tolist(), strict=True), key=lambda r: r[2]):
                if (s, e) not in known:  # otherwise its smallest period is known
                    known[s, e] = q
                    shorter = held[s:e] < e - s
                    holder[s:e][shorter], held[s:e][shorter] = len(found), e - s
                    found.append((s, e, q))
        scale *= 2
    start, stop, period = np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3).T
    doc = np.searchsorted(ends, start, "right")
    return np.column_stack([doc, start - np.append(begins, 0)[doc], stop - start, period])


def number_words(words: list[bytes]) -> np.ndarray:
    """The place of each word's first occurrence."""
    first: dict[bytes, int] = {}
    return np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))


RUNS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUNS)), ("collapsed", pa.string())])
RUN_TYPE = T.StructType().add("start", "long").add("length", "long").add("period", "long")
FOUND_TYPE = T.StructType().add("n_words", "long").add("runs", T.ArrayType(RUN_TYPE)).add("collapsed", "string")


def collapse(texts: list[bytes]) -> list[dict]:
    """For each text its number of words, its runs and its words without those a run repeats, joined by one space."""
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    ids = np.concatenate([number_words(w) for w in words]) if words else np.zeros(0, np.int64)
    runs = find_runs(ids, sizes)
    out = [{"n_words": len(w), "runs": [], "collapsed": b""} for w in words]
    drop: dict[int, np.ndarray] = {}
    for d, start, length, period in runs.tolist():
        out[d]["runs"].append({"start": start, "length": length, "period": period})
        drop.setdefault(d, np.zeros(sizes[d], bool))[start + period : start + length] = True
    for d, w in enumerate(words):
        out[d]["collapsed"] = b" ".join([x for x, gone in zip(w, drop[d].tolist(), strict=True) if not gone] if d in drop else w)
    return out


@F.arrow_udf(FOUND_TYPE)
def collapsed_runs(texts: pa.Array) -> pa.Array:
    done, held, words = [], [], 0
    for raw in texts.cast(pa.large_binary()):
        held.append(raw.as_py() or b"")
        words += len(held[-1]) // 4 + 1
        if words >= SLICE_WORDS:
            done += collapse(held)
            held, words = [], 0
    done += collapse(held)
    runs = pa.array([d["runs"] for d in done], FOUND.field("runs").type)
    text = pa.array([d["collapsed"] for d in done], pa.binary()).view(pa.string())
    return pa.StructArray.from_arrays([pa.array([d["n_words"] for d in done], pa.int64()), runs, text], fields=list(FOUND))


def periodic_runs(docs: DataFrame, text_col: str = "text", out: str = "periodic") -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: n_words, runs (start, length, period; by start, then period), collapsed.

    Words are separated by space and the ASCII controls tab to carriage return and compared byte by byte. ``collapsed``
    holds, joined by one space, the words that no run contains after its first period.
    Runs may overlap; two runs of one start differ in their period. Null and empty texts
    have no words, no runs and an empty ``collapsed``. Texts of any length are taken whole: a task's memory grows with
    its longest text. Repeated rows and null ids each keep their own row, columns of ``docs`` stay as they are and
    ``out`` gets underscores if it is taken. An empty table gives no rows.
    """
    return docs.withColumn(free_names(docs, out)[0], collapsed_runs(F.coalesce(F.col(text_col), F.lit(""))))
