"""Induced suffix sorting with common prefixes, over bucket queues that spill to disk.

Suffixes are S (smaller than their successor) or L; the leftmost S suffixes of
each run are sorted first, by naming the substrings between them and naming pairs
of names again until every name is unique or stands for ``depth`` characters.
All others are induced: a queue yields suffixes in order, each puts the suffix
before it into the bucket of that suffix's first character, and arrival order is
sorted order. Entries carry the common prefix with their predecessor in the
bucket, which is one more than the least value seen since that predecessor's
source. Only ``depth`` characters matter here, so values stop there.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

ALPHABET = 258  # end of text 0, end of a string 1, bytes from 2
QUEUE_BYTES = 64 << 20  # held in memory before a queue spills
ENTRY = np.dtype([("at", "<i8"), ("lcp", "<i4")])
COMPARED = 1 << 14  # pairs of suffixes compared at once


class BucketQueue:
    """First in, first out, by character; the fullest buckets move to an unnamed file when memory is short."""

    def __init__(self, limit: int = QUEUE_BYTES):
        self.parts: list[list] = [[] for _ in range(ALPHABET)]
        self.held = np.zeros(ALPHABET, np.int64)
        self.limit, self.file = limit, None

    def push(self, chars: np.ndarray, entries: np.ndarray) -> None:
        order = np.argsort(chars.astype(np.uint16), kind="stable")  # a radix sort
        chars, entries = chars[order], entries[order]
        starts = np.flatnonzero(np.diff(chars, prepend=-1))
        for part in np.split(entries, starts[1:]):
            if len(part):
                c = int(chars[starts[0]])
                starts = starts[1:]
                self.parts[c].append(part.copy())
                self.held[c] += part.nbytes
        while self.held.sum() > self.limit:
            self.spill(int(self.held.argmax()))

    def spill(self, c: int) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for k, part in enumerate(self.parts[c]):
            if isinstance(part, np.ndarray):
                at = self.file.seek(0, 2)
                self.file.write(part.tobytes())
                self.parts[c][k] = (at, part.nbytes)
        self.held[c] = 0

    def take(self, c: int) -> np.ndarray:
        """All entries of a bucket in order of arrival; the bucket is empty afterwards."""
        out = []
        for part in self.parts[c]:
            if not isinstance(part, np.ndarray):
                self.file.seek(part[0])
                part = np.frombuffer(self.file.read(part[1]), ENTRY)
            out.append(part)
        self.parts[c], self.held[c] = [], 0
        return np.concatenate(out) if out else np.zeros(0, ENTRY)


def s_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; equal characters take the type of what follows."""
    step = np.sign(text[:-1].astype(np.int32) - text[1:])
    step = np.append(step, -1)
    known = np.where(step != 0, np.arange(len(text)), len(text))
    following = np.minimum.accumulate(known[::-1])[::-1]
    return step[following] < 0


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of suffix pairs, up to ``depth``; the text ends with ``depth`` fill characters."""
    view = np.lib.stride_tricks.sliding_window_view(text, depth)
    out = np.empty(len(a), np.int32)
    for k in range(0, len(a), COMPARED):
        differ = view[a[k : k + COMPARED]] != view[b[k : k + COMPARED]]
        out[k : k + COMPARED] = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
    return out


def carried(lcp: np.ndarray, chars: np.ndarray, least: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each entry's predecessor suffix with the one before it in its bucket.

    ``lcp`` holds the entries' own values, ``least`` for each character the least
    value since its bucket's last entry; it is brought up to date.
    """
    n = len(lcp)
    order = np.argsort(chars.astype(np.uint16), kind="stable")
    ordered = chars[order]
    first = np.diff(ordered, prepend=-1) != 0
    start = np.where(first, 0, np.concatenate([[0], order[:-1] + 1]))
    bounds = np.empty(2 * n, np.int64)
    bounds[::2], bounds[1::2] = start, order + 1
    padded = np.append(lcp, depth)  # an index of n is allowed only with an entry there
    low = np.minimum.reduceat(padded, bounds)[::2]
    low = np.where(first, np.minimum(low, least[ordered]), low)
    out = np.empty(n, np.int32)
    out[order] = np.minimum(low + 1, depth)
    ends = order[np.append(np.flatnonzero(first)[1:] - 1, n - 1)] if n else order
    np.minimum(least, lcp.min(initial=depth), out=least)
    if n:
        tails = np.minimum.accumulate(padded[::-1])[::-1]  # least value from each place on
        least[ordered[first]] = tails[ends + 1]
    return out


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, depth: int, limit: int, values: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (suffixes, common prefixes) of each first character, from sorted leftmost S suffixes."""
    seed_chars = text[seeds]
    cuts = np.searchsorted(seed_chars, np.arange(ALPHABET + 1))
    large = BucketQueue(limit)
    least = np.zeros(ALPHABET, np.int32)  # a bucket's first entry has nothing in common with what lies before

    def feed(queue: BucketQueue, entries: np.ndarray, want_small: bool) -> None:
        at = entries["at"]
        chars = text[at - 1].astype(np.int64)
        chosen = (at > 0) & (small[at - 1] == want_small)
        new = np.empty(int(chosen.sum()), ENTRY)
        new["at"] = at[chosen] - 1
        if values:
            found = carried(entries["lcp"], np.where(chosen, chars, ALPHABET - 1 + 1), least, depth)
            new["lcp"] = found[chosen]
        else:
            new["lcp"] = 0
        queue.push(chars[chosen], new)

    least = np.zeros(ALPHABET + 1, np.int32)
    sorted_large = BucketQueue(limit)
    for c in range(ALPHABET):
        last, begun = -1, False
        while len(batch := large.take(c)):
            if not begun:
                batch = batch.copy()
                batch["lcp"][0] = 0
                begun = True
            sorted_large.push(np.full(len(batch), c), batch)
            last = batch["at"][-1]
            feed(large, batch, False)
        group = np.zeros(cuts[c + 1] - cuts[c], ENTRY)
        if len(group):
            group["at"], group["lcp"] = seeds[cuts[c] : cuts[c + 1]], seed_lcp[cuts[c] : cuts[c + 1]]
            group["lcp"][0] = common(text, np.array([last]), group["at"][:1], depth)[0] if values and last >= 0 else 0
            feed(large, group, False)

    least[:] = 0
    below = BucketQueue(limit)
    for c in range(ALPHABET - 1, -1, -1):
        falling, last = [], -1
        while len(batch := below.take(c)):
            if not falling:
                batch = batch.copy()
                batch["lcp"][0] = 0
            falling.append(batch)
            last = batch["at"][-1]
            feed(below, batch, True)
        rising = sorted_large.take(c)
        if len(rising):
            back = np.empty(len(rising), ENTRY)
            back["at"] = rising["at"][::-1]
            seam = common(text, rising["at"][-1:], np.array([last]), depth)[0] if values and last >= 0 else 0
            back["lcp"][0], back["lcp"][1:] = seam, rising["lcp"][:0:-1]
            feed(below, back, True)
        down = np.concatenate(falling) if falling else np.zeros(0, ENTRY)
        up = down["at"][::-1]
        up_lcp = np.concatenate([[0], down["lcp"][:0:-1]]) if len(down) else np.zeros(0, np.int32)
        if len(up) and len(rising):
            up_lcp[0] = common(text, rising["at"][-1:], up[:1], depth)[0] if values else 0
        yield np.concatenate([rising["at"], up]), np.concatenate([rising["lcp"], up_lcp]).astype(np.int32)


def sorted_seeds(text: np.ndarray, small: np.ndarray, depth: int, limit: int) -> np.ndarray:
    """Leftmost S suffixes in the order of their first ``depth`` characters."""
    places = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    by_char = places[np.argsort(text[places], kind="stable")]
    is_seed = np.zeros(len(text), bool)
    is_seed[places] = True
    order = np.concatenate([at[is_seed[at]] for at, _ in induce(text, small, by_char, np.zeros(len(by_char), np.int32), depth, limit, False)][::-1])
    if len(order) < len(places):  # the end of the text is induced by nothing
        rest = is_seed.copy()
        rest[order] = False
        order = np.concatenate([np.flatnonzero(rest), order])
    index = np.empty(len(text), np.int64)
    index[places] = np.arange(len(places))
    size = np.diff(np.append(places, places[-1])) + 1  # to the next one, inclusive
    power = np.cumprod(np.full(max(int(size.max()), len(text) - int(places[-1])), 0x9E3779B97F4A7C15, np.uint64))
    covered = text[places[0] :]
    inner = np.arange(len(covered)) - np.repeat(places - places[0], np.diff(np.append(places, len(text))))
    spread = (np.arange(ALPHABET, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    term = (spread ^ (spread >> np.uint64(29)))[covered] * power[inner]
    key = np.add.reduceat(term, places - places[0]) + text[np.append(places[1:], places[-1])].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    ranked = index[order]
    new = np.concatenate([[True], (key[ranked][1:] != key[ranked][:-1]) | (size[ranked][1:] != size[ranked][:-1])])
    name = np.empty(len(places), np.int64)
    name[ranked] = np.cumsum(new)
    span = 1  # substrings a name stands for; each has two characters of its own at least
    while name.max(initial=0) < len(places) and 2 * span < depth:
        after = np.append(name[span:], np.zeros(min(span, len(name)), np.int64))[: len(name)]
        pair = np.argsort(name * (len(name) + 1) + after, kind="stable")
        new = np.concatenate([[True], (name[pair][1:] != name[pair][:-1]) | (after[pair][1:] != after[pair][:-1])])
        fresh = np.empty(len(places), np.int64)
        fresh[pair] = np.cumsum(new)
        name, span = fresh, 2 * span
    return places[np.argsort(name, kind="stable")]


def suffix_order(strings: list[bytes], depth: int, limit: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of all strings in the order of their first ``depth`` bytes, each one's common prefix with the one before, and the strings' starts.

    Places count in the text of the strings, each followed by one end character.
    """
    sizes = np.array([len(s) for s in strings])
    starts = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.uint16) + 2
    data[starts + sizes] = 1
    text = np.append(data, np.uint16(0))
    small = s_types(text)
    filled = np.concatenate([text, np.zeros(depth, np.uint16)])
    seeds = sorted_seeds(filled[: len(text)], small, depth, limit)
    lcp = np.zeros(len(seeds), np.int32)
    lcp[1:] = common(filled, seeds[:-1], seeds[1:], depth)
    groups = list(induce(filled, np.append(small, np.ones(depth, bool)), seeds, lcp, depth, limit, True))[::-1]
    return np.concatenate([g[0] for g in groups]), np.concatenate([g[1] for g in groups]), starts
