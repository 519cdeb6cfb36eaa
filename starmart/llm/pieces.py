"""SentencePiece encoding with source offsets, and decoding (operator 12).

A model file is read as it stands: pieces with their scores, byte pieces and the
normaliser with its compiled character map, a double-array trie. Normalisation takes
the longest key of the map at each place and notes for every character it writes the
byte of the text that it comes from. Byte-pair merges then join the pair of neighbours
that makes the piece of highest score, the leftmost first; characters without a piece
become byte pieces. The lengths of a text's pieces, summed up, are places in the
normalised text, and its noted bytes give every piece its span of the original text.

A cut between two characters that no piece has side by side can't change a merge, so
texts are merged in such parts, and a bounded table keeps the parts met before. Texts
are independent; nothing is shuffled. The model's bytes, bounded by ``MODEL_BYTES``, are broadcast.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_names

MODEL_BYTES = 64 << 20  # a larger model is refused
SLICE_CHARS = 1 << 19  # characters of the texts taken together
SLICE_IDS = 1 << 17  # ids of the texts decoded together
KEPT_PARTS = 1 << 18  # parts whose pieces are kept
KEPT_CHARS = 64  # longer parts are not kept
HEAP_CHARS = 48  # longer parts are merged with a heap
SPACE = "▁"

# Field numbers and piece types of the model's format.
PIECES, TRAINER, NORMALIZER, DENORMALIZER = 1, 2, 3, 5
MODEL_TYPE, SUFFIX_SPACE, BYTE_FALLBACK, UNKNOWN_SURFACE = 3, 24, 35, 44
CHAR_MAP, DUMMY_PREFIX, FEWER_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2


def replaced_bytewise(error: UnicodeError) -> tuple[str, int]:
    """One replacement character for the first byte of what can't be decoded."""
    return "�", error.start + 1


codecs.register_error("starmart-bytewise", replaced_bytewise)


def shown(raw: bytes) -> bytes:
    """UTF-8 with each byte replaced that makes no character."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        raw = raw.decode("utf-8", "starmart-bytewise").encode()
    return raw


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message in protocol buffer form."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield field, message[at : at + size]
            at += size


def char_map(compiled: bytes) -> dict[str, str]:
    """Keys and replacements of a compiled map: size of the trie, its 32-bit cells, then replacements ended by zero."""
    if not compiled:
        return {}
    size = struct.unpack_from("<I", compiled)[0]
    cells = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
    texts = compiled[4 + size :]
    child = lambda cell: (cell >> 10) << ((cell >> 6) & 8)
    out, open_ = {}, [(child(cells[0]), b"")]
    while open_:
        base, prefix = open_.pop()
        for byte in range(1, 256):
            at = base ^ byte
            if at < len(cells) and cells[at] & 0x800000FF == byte:
                key, below = prefix + bytes([byte]), at ^ child(cells[at])
                if cells[at] >> 8 & 1:
                    start = cells[below] & 0x7FFFFFFF
                    out[key.decode()] = texts[start : texts.index(b"\0", start)].decode()
                open_.append((below, key))
    return out


class Model:
    """A model with byte pieces, byte-pair merges and neither user-defined nor unused pieces."""

    def __init__(self, raw: bytes):
        spec = {TRAINER: {}, NORMALIZER: {}, DENORMALIZER: {}}
        self.pieces: list[tuple[str, float, int]] = []
        for field, value in fields(raw):
            if field == PIECES:
                p = dict(fields(value))
                score = struct.unpack("<f", p[2])[0] if 2 in p else 0.0
                self.pieces.append((p[1].decode(), score, p.get(3, NORMAL)))
            elif field in spec:
                spec[field] = dict(fields(value))
        trainer, norm = spec[TRAINER], spec[NORMALIZER]
        kinds = {t for *_, t in self.pieces}
        if trainer.get(MODEL_TYPE, 1) != BPE or not trainer.get(BYTE_FALLBACK, 0) or trainer.get(SUFFIX_SPACE, 0) or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE} or spec[DENORMALIZER].get(CHAR_MAP):
            raise ValueError("only byte-pair models with byte pieces and plain decoding are known")
        self.map = char_map(norm.get(CHAR_MAP, b""))
        self.starts = {k[0] for k in self.map}
        self.longest = max(map(len, self.map), default=0)
        self.prefix, self.fewer, self.escape = (bool(norm.get(f, 1)) for f in (DUMMY_PREFIX, FEWER_SPACES, ESCAPE_SPACES))
        normal = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == NORMAL}
        self.ids = normal
        order = {s: r for r, s in enumerate(sorted({self.pieces[i][1] for i in normal.values()}, reverse=True))}
        self.rank = {p: order[self.pieces[i][1]] for p, i in normal.items()}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        surface = trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode())
        self.surface = [surface if t == UNKNOWN else b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else p.replace(SPACE, " ").encode() for p, _, t in self.pieces]
        self.spaced = [t == NORMAL and p.startswith(SPACE) for p, _, t in self.pieces]
        self.marks = {i for i, (*_, t) in enumerate(self.pieces) if t in (UNKNOWN, CONTROL)}
        self.part = self.cut()
        self.prepare()
        self.forget()

    def cut(self) -> re.Pattern:
        """Parts between which no piece reaches: spaces with what follows of one class; classes are characters that pieces join."""
        leader: dict[str, str] = {}

        def of(c: str) -> str:
            while leader.setdefault(c, c) != c:
                leader[c] = c = leader[leader[c]]
            return c

        for p in self.ids:
            body = p.lstrip(SPACE) or p
            for a, b in zip(body, body[1:] or body, strict=False):
                leader[of(a)] = of(b)
        classes: dict[str, str] = {}
        for c in sorted(leader):
            classes[of(c)] = classes.get(of(c), "") + c
        alone = "".join(c for c in classes.values() if len(c) == 1 and c != SPACE)
        runs = [f"[{re.escape(c)}]+" for c in sorted(classes.values(), key=len, reverse=True) if len(c) > 1]
        runs = "|".join(runs + [f"[{re.escape(alone)}]+"] * bool(alone))
        if any(SPACE in c and c != SPACE for c in classes.values()):  # spaces inside of pieces
            return re.compile(f"{runs}|.", re.S)
        return re.compile(f"{SPACE}*(?:{runs})|{SPACE}+|." if runs else f"{SPACE}+|.", re.S)

    def prepare(self) -> None:
        """Tables for merging many parts at once: a number for each symbol, and for each two that join their piece and its rank."""
        symbols = {p: i for p, i in self.ids.items()}
        for c in sorted({c for p in self.ids for c in p} - symbols.keys()):
            symbols[c] = len(self.pieces) + len(symbols)
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        self.wide = max(symbols.values(), default=0) + 2
        pairs = [(symbols[p[:k]], symbols[p[k:]], self.rank[p], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols]
        left, right, rank, piece = np.array(pairs, np.int64).reshape(-1, 4).T
        keys = (left + 1) * self.wide + right + 1
        order = np.argsort(keys)
        self.none = len(self.rank)
        self.pairs = np.append(keys[order], -1)
        self.pair_rank, self.pair_piece = np.append(rank[order], self.none).astype(np.int32), np.append(piece[order], -1).astype(np.int32)
        bounds = np.cumsum([0, *map(len, self.surface)])
        self.surface_at, self.surface_size = bounds[:-1], np.diff(bounds)
        self.surface_bytes = np.frombuffer(b"".join(self.surface), np.uint8)
        self.is_spaced, self.is_mark = np.array(self.spaced, bool), np.isin(np.arange(len(self.pieces)), list(self.marks))

    def forget(self) -> None:
        """Start the table of parts anew."""
        self.known: dict[str, int] = {}
        self.many, self.flat, self.sizes = (Growing() for _ in range(3))

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and, for each of its characters and its end, the byte of ``text`` it comes from."""
        if text.isascii():
            byte = np.arange(len(text) + 1)
        else:
            raw = np.frombuffer(text.encode(), np.uint8)
            byte = np.append(np.flatnonzero(raw & 0xC0 != 0x80), len(raw))
        if not text:
            return "", byte
        if not self.map and not self.fewer:
            out = text.replace(" ", SPACE) if self.escape else text
            return (SPACE + out, np.insert(byte, 0, 0)) if self.prefix else (out, byte)
        out: list[str] = []
        source: list[int] = []
        after_space, at = self.fewer, 0
        while at < len(text):
            n = 1
            new = text[at]
            if new in self.starts:
                for size in range(min(self.longest, len(text) - at), 0, -1):
                    if text[at : at + size] in self.map:
                        n, new = size, self.map[text[at : at + size]]
                        break
            if after_space:
                new = new.lstrip(" ")
            if new:
                after_space = self.fewer and new.endswith(" ")
                if self.prefix and not out:
                    out.append(SPACE)
                    source.append(at)
                out += new.replace(" ", SPACE) if self.escape else new
                source += [at] * len(new)
            at += n
        end = len(text)
        while self.fewer and out and out[-1] == (SPACE if self.escape else " "):
            out.pop()
            end = source.pop()
        return "".join(out), byte[[*source, end]]

    def merged(self, part: str) -> list[str]:
        """Pieces of a part: the neighbours that make the best piece are joined, the leftmost first."""
        if len(part) > HEAP_CHARS:
            return self.merged_by_heap(part)
        rank, symbols, none = self.rank.get, list(part), len(self.rank)
        ranks = [rank(part[i : i + 2], none) for i in range(len(part) - 1)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            piece = symbols[i] + symbols.pop(i + 1)
            symbols[i] = piece
            del ranks[i]
            if i:
                ranks[i - 1] = rank(symbols[i - 1] + piece, none)
            if i < len(ranks):
                ranks[i] = rank(piece + symbols[i + 1], none)
        return symbols

    def merged_by_heap(self, part: str) -> list[str]:
        """``merged`` in n log n steps."""
        symbols, rank = list(part), self.rank
        right, left = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        heap: list[tuple[int, int, str]] = []

        def offer(i: int, j: int) -> None:
            r = rank.get(symbols[i] + symbols[j])
            if r is not None:
                heapq.heappush(heap, (r, i, symbols[i] + symbols[j]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = right[i]
            if j >= len(part) or not symbols[i] or symbols[i] + symbols[j] != piece:
                continue
            symbols[i], symbols[j], right[i] = piece, "", right[j]
            if right[i] < len(part):
                left[right[i]] = i
                offer(i, right[i])
            if left[i] >= 0:
                offer(left[i], i)
        return [s for s in symbols if s]

    def pieces_of(self, part: str) -> tuple[list[int], list[int]]:
        """Ids of a part's pieces, and characters of each; of a character's byte pieces the last one has it."""
        symbols = self.merged(part)
        ids = list(map(self.ids.get, symbols))
        if None not in ids:
            return ids, list(map(len, symbols))
        found, ids, sizes = ids, [], []
        for s, i in zip(symbols, found, strict=True):
            if i is not None:
                ids.append(i)
                sizes.append(len(s))
            else:
                raw = s.encode()
                ids += [self.bytes[b] for b in raw]
                sizes += [0] * (len(raw) - 1) + [1]
        return ids, sizes

    def joined(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each two symbols."""
        keys = (left.astype(np.int64) + 1) * self.wide + right + 1
        at = np.searchsorted(self.pairs[:-1], keys)
        at[self.pairs[at] != keys] = -1
        return self.pair_rank[at], self.pair_piece[at]

    def merged_many(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``merged`` for a row of symbols each, the first ``lengths`` of them: symbols left, characters of each, and how many."""
        rows, wide = symbols.shape
        chars = (np.arange(wide) < lengths[:, None]).astype(np.int32)
        out = symbols.copy(), chars.copy(), lengths.copy()
        live, column = np.arange(rows), np.arange(wide)
        rank, piece = self.joined(symbols[:, :-1], symbols[:, 1:])
        while len(live):
            best = rank.min(1, initial=self.none)
            done = best == self.none
            if done.any():
                for whole, part in zip(out, (symbols, chars, lengths), strict=True):
                    whole[live[done]] = part[done]
                live, symbols, chars, lengths, rank, piece = (x[~done] for x in (live, symbols, chars, lengths, rank, piece))
                if not len(live):
                    break
            at, row = rank.argmin(1), np.arange(len(live))
            symbols[row, at] = piece[row, at]
            chars[row, at] += chars[row, at + 1]
            rest = np.minimum(column + (column > at[:, None]), wide - 1)
            symbols, chars = np.take_along_axis(symbols, rest, 1), np.take_along_axis(chars, rest, 1)
            symbols[:, -1], chars[:, -1] = -1, 0
            rest = np.minimum(column[:-1] + (column[:-1] >= at[:, None]), wide - 2)
            rank, piece = np.take_along_axis(rank, rest, 1), np.take_along_axis(piece, rest, 1)
            rank[:, -1] = self.none
            for side in (at - 1, at):
                use = np.flatnonzero((side >= 0) & (side < wide - 1))
                k = side[use]
                rank[use, k], piece[use, k] = self.joined(symbols[use, k], symbols[use, k + 1])
            lengths = lengths - 1
        return out

    def learn(self, parts: list[str]) -> None:
        """Store the pieces of new parts of at most ``KEPT_CHARS`` characters."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.cumsum(sizes) - sizes
        chars = self.of_char[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
        low = 1
        for wide in (8, 12, 20, KEPT_CHARS + 1):
            rows = np.flatnonzero((sizes >= low) & (sizes < wide))
            low = wide
            if not len(rows):
                continue
            column = np.arange(wide)
            inside = column < sizes[rows][:, None]
            symbols = np.where(inside, chars[np.where(inside, begins[rows][:, None] + column, 0)], -1)
            symbols, counts, left = self.merged_many(symbols, sizes[rows])
            inside = column < left[:, None]
            strange = (inside & ((symbols < 0) | (symbols >= len(self.pieces)))).any(1)
            for r in rows[strange].tolist():
                ids, n = self.pieces_of(parts[r])
                self.keep([parts[r]], np.array([len(ids)]), np.array(ids), np.array(n))
            inside &= ~strange[:, None]
            self.keep([parts[r] for r in rows[~strange].tolist()], left[~strange], symbols[inside], counts[inside])

    def keep(self, parts: list[str], many: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts)), strict=True))
        self.many.add(many)
        self.flat.add(ids)
        self.sizes.add(sizes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of each text; of all of them the ids, and where each begins and ends among its text's UTF-8 bytes."""
        parts: list[str] = []
        sources, counts = [], []
        for text in texts:
            norm, source = self.normalised(text)
            found = self.part.findall(norm)
            parts += found
            counts.append(len(found))
            sources.append(source)
        if len(self.known) > KEPT_PARTS:
            self.forget()
        numbers = list(map(self.known.get, parts))
        long: dict[int, str] = {}
        if None in numbers:
            new = [i for i, k in enumerate(numbers) if k is None]
            self.learn(list({parts[i]: None for i in new if len(parts[i]) <= KEPT_CHARS}))
            for i in new:
                numbers[i] = self.known.get(parts[i], -1)
                if numbers[i] < 0:
                    long[i] = parts[i]
        k = np.array(numbers, np.int64)
        of_part = self.many.held()
        first = np.cumsum(of_part) - of_part
        many = np.where(k >= 0, of_part[k], 0) if len(of_part) else np.zeros(len(k), np.int64)
        ends = np.cumsum(many)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat((first[k] if len(first) else k) - (ends - many), many)
        ids, sizes = self.flat.held()[at], self.sizes.held()[at]
        for i in reversed(long):  # parts too long to be kept go in where they stand
            new_ids, new_sizes = self.pieces_of(long[i])
            place = ends[i]
            ids, sizes = (np.concatenate([x[:place], y, x[place:]]) for x, y in ((ids, new_ids), (sizes, new_sizes)))
            many[i] = len(new_ids)
        text_of = np.repeat(np.arange(len(texts)), counts)
        n = np.bincount(text_of, many, len(texts)).astype(np.int64)
        # a text's sources are one more than its characters
        source = np.concatenate(sources) if sources else np.zeros(0, np.int64)
        stop = np.cumsum(sizes) + np.repeat(np.arange(len(texts)), n)
        return n, ids, source[stop - sizes], source[stop]

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the text that pieces stand for; the space before the first goes (all first pieces of one space, where the model writes fewer spaces), bytes that make no character are replaced one by one."""
        runs, at = [], 0
        for i in [k for k, x in enumerate(ids) if x in self.marks]:
            runs += [ids[at:i], ids[i : i + 1]]
            at = i + 1
        runs.append(ids[at:])
        out = b"".join([shown(b"".join(map(self.surface.__getitem__, run))) for run in runs])
        spaces = 0
        for i in ids if self.prefix or self.fewer else ():
            spaces += self.spaced[i]
            if self.surface[i] and not (self.fewer and self.spaced[i] and len(self.surface[i]) == 1):
                break
        return out[spaces:]

    def decode_many(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """``decode`` for texts of ``counts`` ids each."""
        sizes = self.surface_size[ids]
        ends = np.cumsum(sizes)
        raw = self.surface_bytes[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.surface_at[ids] - (ends - sizes), sizes)].tobytes()
        bounds, last = np.append(0, ends), np.cumsum(counts)
        marks = np.append(0, np.cumsum(self.is_mark[ids]))
        out = []
        for a, b in zip((last - counts).tolist(), last.tolist(), strict=True):
            if self.fewer or marks[a] != marks[b]:
                out.append(self.decode(ids[a:b].tolist()))
            else:
                skip = int(b > a and self.prefix and self.is_spaced[ids[a]])
                out.append(shown(raw[bounds[a] + skip : bounds[b]]))
        return out


class Growing:
    """Numbers that are added to; doubles its room."""

    def __init__(self):
        self.room, self.used = np.zeros(1024, np.int32), 0

    def add(self, numbers: np.ndarray) -> None:
        while self.used + len(numbers) > len(self.room):
            self.room = np.concatenate([self.room, np.zeros_like(self.room)])
        self.room[self.used : self.used + len(numbers)] = numbers
        self.used += len(numbers)

    def held(self) -> np.ndarray:
        return self.room[: self.used]


@lru_cache(maxsize=2)
def load(raw: bytes) -> Model:
    return Model(raw)


INTS = T.ArrayType(T.IntegerType())
ENCODED_TYPE = T.StructType().add("ids", INTS).add("starts", INTS).add("ends", INTS)


def shared_model(docs: DataFrame, path: str):
    """The model's bytes, read by the driver and broadcast."""
    with open(path, "rb") as f:
        raw = f.read(MODEL_BYTES + 1)
    if len(raw) > MODEL_BYTES:
        raise ValueError(f"a model of more than {MODEL_BYTES} bytes")
    load(raw)  # refuses models of other kinds here
    return docs.sparkSession.sparkContext.broadcast(raw)


def encode(docs: DataFrame, model: str, text_col: str = "text", out: str = "pieces", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all without it) and a struct ``out`` of equally long arrays: ids, starts, ends.

    ``starts`` and ``ends`` bound each piece's bytes in the original text. A character's byte pieces have no bytes but the
    last, which has all of it; so do the pieces of what the character map puts in place of one key: the last ends where
    the next key begins. Null and empty texts have no pieces. Texts of any
    length are taken whole. Repeated rows and null ids each keep their row; other columns stay as they are, and ``out``
    gets underscores if it is taken. An empty table gives no rows. Results leave a task in batches of about ``SLICE_CHARS``.
    """
    shared = shared_model(docs, model)
    kept = list(docs.columns if keep is None else keep)
    text, name = free_names(kept, "_text", out)[0], free_names(docs, out)[0]
    rows = docs.select(*kept, F.coalesce(F.col(text_col), F.lit("")).alias(text))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(name, ENCODED_TYPE)])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = load(shared.value)
        for batch in batches:
            held, chars, first = [], 0, 0
            texts = batch.column(len(kept)).cast(pa.large_binary())
            for i, raw in enumerate(texts):
                text = raw.as_py().decode("utf-8", "starmart-bytewise")
                held.append(text)
                chars += len(text)
                if chars >= SLICE_CHARS or i + 1 == len(texts):
                    part = batch.slice(first, i + 1 - first)
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], structs(*found.encode(held))], names=schema.names)
                    held, chars, first = [], 0, i + 1

    return rows.mapInArrow(pieces, schema)


def structs(counts: np.ndarray, *columns: np.ndarray) -> pa.Array:
    """Lists of ``counts`` numbers of each column, as one column."""
    offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in columns]
    return pa.StructArray.from_arrays(lists, names=ENCODED_TYPE.names)


def decode(docs: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and the text ``out`` that the array of ids stands for; null ids give null."""
    shared = shared_model(docs, model)

    @F.arrow_udf(T.StringType())
    def text(ids: pa.Array) -> pa.Array:
        found = load(shared.value)
        counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        flat, ends = ids.flatten().to_numpy(), np.append(0, np.cumsum(counts, dtype=np.int64))
        texts: list[bytes] = []
        while len(texts) < len(counts):  # slices of about SLICE_IDS, and at least one text
            first = len(texts)
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_IDS, "right")) - 1)
            texts += found.decode_many(flat[ends[first] : ends[last]], counts[first:last])
        return pa.array(texts, pa.binary(), mask=ids.is_null().to_numpy(False)).view(pa.string())

    return docs.withColumn(free_names(docs, out)[0], text(F.col(ids_col)))
