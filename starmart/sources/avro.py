"""Avro container files as a Spark data source, read in splits and written a file a task.

    register(spark)
    spark.read.format("starmart_avro").schema(schema).load(root)
    df.write.format("starmart_avro").option("partitionBy", "year,month").mode("append").save(root)

A container file is a header with the writer's schema and a random marker, then
blocks of records, each followed by the marker. A split is a byte range of a
file: its task looks for the first marker in the range and reads the blocks whose
preceding marker starts in it, so every block is read once and a file of any size is
shared by many tasks. Small files are packed into one task. Records are resolved from the
writer's schema to the declared one by name: fields that are not declared are
skipped over, declared ones that are missing are null. ``key=value`` folders below the
root give the partition columns. Rows reach Spark as Arrow batches.

Files are opened by ``pyarrow.fs`` (local paths, HDFS, S3, GCS), which executors can use without a JVM.
"""

from __future__ import annotations

import bz2
import datetime as dt
import decimal
import json
import lzma
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

NAME = "starmart_avro"
SPLIT_BYTES = 128 << 20
OPEN_COST = 4 << 20  # bytes that opening a file counts for when files are packed
LEAST_BYTES = 64 << 10  # of a split that is cut for a number of tasks, and what opening a file counts for then
PIECE = 1 << 20  # bytes read at a time while looking for a marker
BATCH_ROWS = 10_000
BLOCK_BYTES = 64 << 10  # of an uncompressed block written
EPOCH = dt.date(1970, 1, 1)
BYTES = pa.large_binary()

# Fixed values of the container format.
MAGIC = b"Obj\x01"
MARKER = 16
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

#: Reads a value at a place of a block: (value, next place).
Reader = Callable[[bytes, int], tuple[object, int]]


# ---------------------------------------------------------------------------
# Values
# ---------------------------------------------------------------------------

def read_long(b: bytes, i: int) -> tuple[int, int]:
    c = b[i]
    i += 1
    if c < 128:
        return (c >> 1) ^ -(c & 1), i
    n, shift = c & 127, 7
    while c > 127:
        c = b[i]
        i += 1
        n |= (c & 127) << shift
        shift += 7
    return (n >> 1) ^ -(n & 1), i


def long_bytes(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_bytes(b: bytes, i: int) -> tuple[bytes, int]:
    n, i = read_long(b, i)
    return b[i : i + n], i + n


def read_string(b: bytes, i: int) -> tuple[str, int]:
    n = b[i]
    if n < 128 and not n & 1:  # most lengths take a byte
        i += 1
        end = i + (n >> 1)
    else:
        n, i = read_long(b, i)
        end = i + n
    return b[i:end].decode("utf-8", "replace"), end


def pass_over(b: bytes, i: int) -> tuple[None, int]:
    """Go past bytes or a string that nobody wants."""
    n, i = read_long(b, i)
    return None, i + n


def fixed(size: int) -> Reader:
    return lambda b, i: (b[i : i + size], i + size)


def unpacked(code: str) -> Reader:
    s = struct.Struct(code)
    return lambda b, i: (s.unpack_from(b, i)[0], i + s.size)


PRIMITIVES: dict[str, Reader] = {
    "null": lambda b, i: (None, i),
    "boolean": lambda b, i: (b[i] == 1, i + 1),
    "int": read_long,
    "long": read_long,
    "float": unpacked("<f"),
    "double": unpacked("<d"),
    "bytes": read_bytes,
    "string": read_string,
}


def items(read: Reader, each: Callable[[Reader, bytes, int, list], int]) -> Reader:
    """Blocks of items, each with its count first; a negative count is followed by the block's size."""

    def run(b: bytes, i: int) -> tuple[list, int]:
        out: list = []
        while True:
            n, i = read_long(b, i)
            if n == 0:
                return out, i
            if n < 0:
                n, (_, i) = -n, read_long(b, i)
            for _ in range(n):
                i = each(read, b, i, out)

    return run


def one_item(read: Reader, b: bytes, i: int, out: list) -> int:
    value, i = read(b, i)
    out.append(value)
    return i


def one_entry(read: Reader, b: bytes, i: int, out: list) -> int:
    key, i = read_string(b, i)
    value, i = read(b, i)
    out.append((key, value))
    return i


def converted(read: Reader, change: Callable) -> Reader:
    def run(b: bytes, i: int) -> tuple[object, int]:
        value, i = read(b, i)
        return (None if value is None else change(value)), i

    return run


def to_type(schema: dict | str, want: T.DataType) -> Callable | None:
    """What turns a value of a writer's type into one of the declared type; None if nothing has to be done."""
    kind = schema["type"] if isinstance(schema, dict) else schema
    logical = schema.get("logicalType") if isinstance(schema, dict) else None
    if isinstance(want, T.DecimalType):
        if logical == "decimal":
            scale = schema.get("scale", 0)
            return lambda v: decimal.Decimal(int.from_bytes(v, "big", signed=True)).scaleb(-scale)
        return decimal.Decimal
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        return (lambda v: v * 1000) if (logical or "").endswith("timestamp-millis") else None
    if isinstance(want, (T.FloatType, T.DoubleType)):
        return float if kind in ("int", "long") else None
    if isinstance(want, T.StringType) and kind in ("bytes", "fixed"):
        return lambda v: v.decode("utf-8", "replace")
    if isinstance(want, T.BinaryType) and kind == "string":
        return str.encode
    known = {
        T.BooleanType: ("boolean",), T.ByteType: ("int",), T.ShortType: ("int",), T.IntegerType: ("int",), T.LongType: ("int", "long"), T.DateType: ("int",), T.StringType: ("string", "enum"), T.BinaryType: ("bytes", "fixed"),
    }
    if kind not in known.get(type(want), ()):
        raise ValueError(f"Avro {kind} can't be read as {want.simpleString()}")
    return None


def reader_of(schema, want: T.DataType | None, named: dict | None = None) -> Reader:
    """Reads a writer's value as ``want``; with None it is only passed over."""
    named = {} if named is None else named
    if isinstance(schema, str) and schema in named:
        schema = named[schema]
        if schema is None:
            raise ValueError("recursive Avro types are not known")
    if isinstance(schema, list):
        branches = [PRIMITIVES["null"] if s == "null" else reader_of(s, want, named) for s in schema]
        if len(schema) == 2 and "null" in schema:  # the usual case, without a call for a null
            none = b"\0\2"[schema.index("null")]
            other, whole = 2 - none, branches[1 - schema.index("null")]

            def nullable(b: bytes, i: int) -> tuple[object, int]:
                c = b[i]
                if c == none:
                    return None, i + 1
                if c != other:
                    raise IndexError("no such branch of an Avro union")
                return whole(b, i + 1)

            return nullable

        def union(b: bytes, i: int) -> tuple[object, int]:
            n, i = read_long(b, i)
            return branches[n](b, i)

        return union
    kind = schema["type"] if isinstance(schema, dict) else schema
    if isinstance(kind, (list, dict)):
        return reader_of(kind, want, named)
    if kind in ("record", "enum", "fixed"):
        named[schema["name"]] = None
        read = record(schema, want, named) if kind == "record" else symbol(schema) if kind == "enum" else fixed(schema["size"])
        named[schema["name"]] = schema
        if kind == "record":
            return read
    elif kind == "array":
        return items(reader_of(schema["items"], want.elementType if want is not None else None, named), one_item)
    elif kind == "map":
        return items(reader_of(schema["values"], want.valueType if want is not None else None, named), one_entry)
    else:
        read = pass_over if want is None and kind in ("bytes", "string") else PRIMITIVES[kind]
    change = to_type(schema, want) if want is not None and kind != "null" else None
    return converted(read, change) if change else read


def symbol(schema: dict) -> Reader:
    symbols = schema["symbols"]

    def run(b: bytes, i: int) -> tuple[str, int]:
        n, i = read_long(b, i)
        return symbols[n], i

    return run


def steps_of(schema: dict, want: T.StructType | None, named: dict) -> list[tuple[str | None, Reader]]:
    """A record's fields in the writer's order: the declared name (None: passed over) and the reader."""
    wanted = {f.name.lower(): f for f in want.fields} if want is not None else {}
    steps = []
    for f in schema["fields"]:
        target = wanted.get(f["name"].lower())
        steps.append((target.name if target else None, reader_of(f["type"], target.dataType if target else None, named)))
    return steps


def record(schema: dict, want: T.DataType | None, named: dict) -> Reader:
    if want is not None and not isinstance(want, T.StructType):
        raise ValueError(f"an Avro record can't be read as {want.simpleString()}")
    wanted = want.names if want is not None else []
    steps = steps_of(schema, want, named)
    blank = dict.fromkeys(wanted)

    def run(b: bytes, i: int) -> tuple[dict, int]:
        out = blank.copy()
        for name, read in steps:
            value, i = read(b, i)
            if name is not None:
                out[name] = value
        return out, i

    return run


# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

AVRO_OF = {T.BooleanType: "boolean", T.ByteType: "int", T.ShortType: "int", T.IntegerType: "int", T.LongType: "long", T.FloatType: "float", T.DoubleType: "double", T.StringType: "string", T.BinaryType: "bytes"}
SPARK_OF = {"boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "enum": T.StringType(), "bytes": T.BinaryType(), "fixed": T.BinaryType(), "null": T.NullType()}
LOGICAL = {"date": T.DateType(), "timestamp-millis": T.TimestampType(), "timestamp-micros": T.TimestampType(), "local-timestamp-millis": T.TimestampNTZType(), "local-timestamp-micros": T.TimestampNTZType()}


def avro_schema(kind: T.DataType, name: str = "row"):
    """A writer's schema for a Spark type; every value may be null."""
    if isinstance(kind, T.StructType):
        return {"type": "record", "name": name, "fields": [{"name": f.name, "type": ["null", avro_schema(f.dataType, f"{name}_{f.name}")], "default": None} for f in kind.fields]}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": ["null", avro_schema(kind.elementType, name)]}
    if isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType):
        return {"type": "map", "values": ["null", avro_schema(kind.valueType, name)]}
    if isinstance(kind, T.DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}
    if isinstance(kind, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(kind, T.TimestampType):
        return {"type": "long", "logicalType": "timestamp-micros"}
    if isinstance(kind, T.TimestampNTZType):
        return {"type": "long", "logicalType": "local-timestamp-micros"}
    if type(kind) not in AVRO_OF:
        raise ValueError(f"{kind.simpleString()} has no Avro form here")
    return AVRO_OF[type(kind)]


def qualified(schema, space: str = ""):
    """A schema whose named types and references to them have their full names."""
    if isinstance(schema, list):
        return [qualified(s, space) for s in schema]
    if isinstance(schema, str):
        return schema if schema in PRIMITIVES or "." in schema or not space else f"{space}.{schema}"
    out = dict(schema)
    if "name" in out and out["type"] in ("record", "enum", "fixed"):
        own = out.pop("namespace", space)
        out["name"] = out["name"] if "." in out["name"] or not own else f"{own}.{out['name']}"
        space = out["name"].rpartition(".")[0]
    for part in ("items", "values"):
        if part in out:
            out[part] = qualified(out[part], space)
    if isinstance(out.get("type"), (list, dict)):
        out["type"] = qualified(out["type"], space)
    if "fields" in out:
        out["fields"] = [f | {"type": qualified(f["type"], space)} for f in out["fields"]]
    return out


def spark_type(schema, named: dict | None = None) -> T.DataType:
    """The Spark type of a writer's schema."""
    named = {} if named is None else named
    if isinstance(schema, list):
        whole = [s for s in schema if s != "null"]
        if len(whole) != 1:
            raise ValueError("a union of several types needs a declared schema")
        return spark_type(whole[0], named)
    if isinstance(schema, str):
        return named[schema] if schema in named else SPARK_OF[schema]
    kind = schema["type"]
    if schema.get("logicalType") in LOGICAL:
        return LOGICAL[schema["logicalType"]]
    if schema.get("logicalType") == "decimal":
        return T.DecimalType(schema["precision"], schema.get("scale", 0))
    if kind == "record":
        out: T.DataType = T.StructType([T.StructField(f["name"], spark_type(f["type"], named)) for f in schema["fields"]])
    elif kind == "array":
        return T.ArrayType(spark_type(schema["items"], named))
    elif kind == "map":
        return T.MapType(T.StringType(), spark_type(schema["values"], named))
    else:
        out = spark_type(kind, named)
    if "name" in schema:
        named[schema["name"]] = out
    return out


def encoder_of(kind: T.DataType) -> Callable[[object], bytes]:
    """Writes a value that may be null as ``avro_schema`` says."""
    some = b"\x02"
    if isinstance(kind, T.StructType):
        each = [(f.name, encoder_of(f.dataType)) for f in kind.fields]
        body = lambda v: b"".join([put(v[name]) for name, put in each])
    elif isinstance(kind, T.ArrayType):
        put_item = encoder_of(kind.elementType)
        body = lambda v: (long_bytes(len(v)) + b"".join(map(put_item, v)) if v else b"") + b"\0"
    elif isinstance(kind, T.MapType):
        put_value = encoder_of(kind.valueType)
        body = lambda v: (long_bytes(len(v)) + b"".join(sized(k.encode()) + put_value(x) for k, x in v) if v else b"") + b"\0"
    elif isinstance(kind, T.StringType):
        body = lambda v: sized(v.encode())
    elif isinstance(kind, T.BinaryType):
        body = lambda v: sized(bytes(v))
    elif isinstance(kind, T.BooleanType):
        body = lambda v: b"\x01" if v else b"\0"
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        body = struct.Struct("<f" if isinstance(kind, T.FloatType) else "<d").pack
    elif isinstance(kind, T.DateType):
        body = lambda v: long_bytes((v - EPOCH).days)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zero = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc if isinstance(kind, T.TimestampType) else None)
        body = lambda v: long_bytes((v - zero) // dt.timedelta(microseconds=1))
    elif isinstance(kind, T.DecimalType):
        scale = kind.scale

        def body(v: decimal.Decimal) -> bytes:
            n = int(v.scaleb(scale))
            return sized(n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True))

    else:
        body = long_bytes
    return lambda v: b"\0" if v is None else some + body(v)


def sized(raw: bytes) -> bytes:
    return long_bytes(len(raw)) + raw


def joined(*parts: pa.Array) -> pa.Array:
    """The parts of each row, end to end."""
    return pc.binary_join_element_wise(*parts, pa.scalar(b"", BYTES))


def once_each(column: pa.Array, put: Callable[[object], bytes]) -> pa.Array:
    """``put`` of every value, called once for those that are equal."""
    d = column.dictionary_encode()
    made = [put(v) for v in d.dictionary.to_pylist()] + [put(None)]
    return pa.array(made, BYTES).take(pc.fill_null(d.indices, len(made) - 1))


def encoded(column: pa.Array, kind: T.DataType) -> pa.Array:
    """What :func:`encoder_of` writes for each value, made for a whole column at once."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = column.cast(BYTES)
        body = joined(once_each(pc.binary_length(raw), lambda n: b"\2" + long_bytes(n or 0)), raw)
    elif isinstance(kind, T.StructType):
        body = joined(pa.repeat(pa.scalar(b"\2", BYTES), len(column)), *[encoded(c, f.dataType) for c, f in zip(column.flatten(), kind.fields, strict=True)])
    elif isinstance(kind, T.ArrayType):
        n = pc.fill_null(pc.list_value_length(column), 0)
        ends = np.concatenate([[0], np.cumsum(n.to_numpy(zero_copy_only=False), dtype=np.int64)])
        items_ = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), encoded(column.flatten(), kind.elementType)), pa.scalar(b"", BYTES))
        body = joined(once_each(n, lambda v: b"\2" + (long_bytes(v) if v else b"")), items_, pa.repeat(pa.scalar(b"\0", BYTES), len(column)))
    elif isinstance(kind, (T.MapType, T.FloatType, T.DoubleType)):
        return pa.array([*map(encoder_of(kind), column.to_pylist())], BYTES)
    else:
        return once_each(column, encoder_of(kind))
    return pc.if_else(column.is_valid(), body, pa.scalar(b"\0", BYTES))


def stretches(keys: Sequence[pa.Array], n: int) -> list[tuple[int, int]]:
    """(start, end) of the rows that follow each other with equal keys."""
    new = np.zeros(max(n - 1, 0), bool)
    for k in keys:
        at = pc.fill_null(k.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        new |= at[1:] != at[:-1]
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), n]
    return [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


# ---------------------------------------------------------------------------
# Container files
# ---------------------------------------------------------------------------

def inflated(codec: str, data: bytes) -> bytes:
    if codec == "null":
        return data
    if codec == "deflate":
        return zlib.decompress(data, -15)
    if codec == "snappy":  # raw, then the CRC of what comes out, whose length stands first
        n = shift = at = 0
        while True:
            n |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                break
        out = pa.Codec("snappy").decompress(data[:-4], n, asbytes=True)
        if zlib.crc32(out) != int.from_bytes(data[-4:], "big"):
            raise ValueError("damaged Avro block")
        return out
    if codec == "bzip2":
        return bz2.decompress(data)
    if codec == "xz":
        return lzma.decompress(data)
    if codec == "zstandard":
        import zstandard

        return zstandard.ZstdDecompressor().decompressobj().decompress(data)
    raise ValueError(f"unknown Avro codec {codec}")


@dataclass(frozen=True)
class Header:
    schema: object
    codec: str
    marker: bytes
    size: int


class Scanner:
    """Reads a file from a place on, a piece at a time."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def more(self, least: int) -> bool:
        """Hold at least ``least`` bytes, if the file has them."""
        while len(self.held) < least:
            piece = self.file.read(max(PIECE, least - len(self.held)))
            if not piece:
                return False
            self.held += piece
        return True

    def take(self, n: int) -> bytes:
        if not self.more(n):
            raise EOFError("an Avro file ends inside a block")
        out, self.held = self.held[:n], self.held[n:]
        self.at += n
        return out

    def long(self) -> int:
        self.more(10)
        value, n = read_long(self.held, 0)
        self.take(n)
        return value

    def find(self, marker: bytes, end: int) -> bool:
        """Go to the next marker that starts before ``end``; False if there is none."""
        while self.at < end and self.more(MARKER):
            k = self.held.find(marker)
            if k >= 0:
                self.take(k)
                return self.at < end
            self.take(len(self.held) - MARKER + 1)
        return False


def header_of(file) -> Header:
    s = Scanner(file, 0)
    if s.take(4) != MAGIC:
        raise ValueError("not an Avro container file")
    meta = {}
    while n := s.long():
        if n < 0:
            n = -n
            s.long()
        for _ in range(n):
            key = s.take(s.long()).decode()
            meta[key] = s.take(s.long())
    marker = s.take(MARKER)
    return Header(qualified(json.loads(meta["avro.schema"])), meta.get("avro.codec", b"null").decode(), marker, s.at)


def blocks(file, header: Header, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(records, bytes) of the blocks whose preceding marker starts in the range."""
    s = Scanner(file, max(start, header.size - MARKER))
    if not s.find(header.marker, end):
        return
    while s.at < end:
        s.take(MARKER)
        if not s.more(1):
            return
        n = s.long()
        data = s.take(s.long())
        if not s.more(MARKER) or s.held[:MARKER] != header.marker:
            raise ValueError("damaged Avro file: no marker after a block")
        yield n, inflated(header.codec, data)


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


@dataclass
class Split(InputPartition):
    """Byte ranges (path, start, end) that one task reads."""

    ranges: Sequence[tuple[str, int, int]]


def packed(files: Sequence[tuple[str, int]], size: int, open_cost: int = OPEN_COST) -> list[Split]:
    """Ranges of at most ``size`` bytes; small files share a split."""
    out, held, filled = [], [], 0
    for path, n in files:
        for start in range(0, n, size):
            part = min(size, n - start)
            if held and filled + part > size:
                out.append(Split(tuple(held)))
                held, filled = [], 0
            held.append((path, start, start + part))
            filled += part + open_cost
    return out + [Split(tuple(held))] * bool(held)


def folder_values(path: str, base: str = "") -> dict[str, str | None]:
    """The ``key=value`` folders of a path below ``base``, keys in lower case."""
    parts = [p.partition("=") for p in path.removeprefix(base).split("/")[:-1]]
    return {k.lower(): None if v == NULL_FOLDER else unquote(v) for k, eq, v in parts if eq}


class AvroReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.schema, self.options = schema, dict(options)
        self.base = self.options.get("basepath", self.options.get("path", "")).rstrip("/")

    def files(self) -> list[tuple[str, int]]:
        roots = json.loads(self.options["folders"]) if "folders" in self.options else [self.options["path"]]
        out = []
        for root in (r.rstrip("/") for r in roots):
            fs, path = opened(root)
            prefix = root[: len(root) - len(path)] if root.endswith(path) else ""
            whole = fs.get_file_info(path)
            infos = [whole] if whole.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
            hidden = lambda p: any(x[:1] in "._" for x in p[len(path) :].split("/") if x)
            out += [(prefix + i.path, i.size) for i in infos if i.type == pafs.FileType.File and (i is whole or not hidden(i.path))]
        return sorted(out)

    def partitions(self) -> list[Split]:
        files = self.files()
        if "splitbytes" in self.options or "tasks" not in self.options:
            return packed(files, int(self.options.get("splitbytes", SPLIT_BYTES))) or [Split(())]
        share = -(-sum(n + LEAST_BYTES for _, n in files) // int(self.options["tasks"]))  # decoding costs far more than opening
        return packed(files, min(SPLIT_BYTES, max(LEAST_BYTES, share)), LEAST_BYTES) or [Split(())]

    def read(self, partition: Split) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        names = self.schema.names
        for path, start, end in partition.ranges:
            fs, inner = opened(path)
            given = folder_values(path, self.base)
            own = T.StructType([f for f in self.schema.fields if f.name.lower() not in given])
            with fs.open_input_file(inner) as file:
                header = header_of(file)
                if not isinstance(header.schema, dict) or header.schema["type"] != "record":
                    raise ValueError("an Avro file's rows are records")
                steps = steps_of(header.schema, own, {header.schema["name"]: None})
                count, values = 0, {name: [] for name, _ in steps if name is not None}
                each = [(read, None if name is None else values[name].append) for name, read in steps]
                for n, data in blocks(file, header, start, end):
                    at = 0
                    for _ in range(n):
                        for read, put in each:
                            value, at = read(data, at)
                            if put is not None:
                                put(value)
                    count += n
                    if count >= BATCH_ROWS:
                        yield self.batch(values, count, names, arrow, given)
                        count = 0
                        for held in values.values():
                            held.clear()
                if count:
                    yield self.batch(values, count, names, arrow, given)

    def batch(self, values: dict[str, list], count: int, names: list[str], arrow: pa.Schema, given: dict) -> pa.RecordBatch:
        columns = []
        for name, field in zip(names, arrow, strict=True):
            if name.lower() in given:
                value = pa.scalar(given[name.lower()], pa.string())
                columns.append(pa.repeat(value, count).cast(field.type))
            else:
                columns.append(pa.array(values[name], field.type) if name in values else pa.nulls(count, field.type))
        return pa.RecordBatch.from_arrays(columns, schema=arrow)


@dataclass
class Written(WriterCommitMessage):
    """Files a task wrote, under their temporary and their final names."""

    files: list[tuple[str, str]]


class AvroWriter(DataSourceArrowWriter):
    """A file a task and partition folder, written hidden and renamed when all tasks are done.

    Rows of a task that belong to one folder should stand together: a file is closed when another folder begins.
    """

    def __init__(self, schema: T.StructType, options, overwrite: bool):
        if overwrite:
            raise ValueError("append only")
        self.path, self.codec = options["path"], options.get("codec", "deflate")
        self.keys = [k for k in options.get("partitionby", "").split(",") if k]
        self.block = int(options.get("blockbytes", BLOCK_BYTES))
        self.own = T.StructType([f for f in schema.fields if f.name not in self.keys])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        if self.codec not in ("deflate", "null"):
            raise ValueError(f"can't write codec {self.codec}")
        fs, root = opened(self.path)
        files, folder, out, held, rows, size = [], None, None, [], 0, 0
        marker = os.urandom(MARKER)

        def flush() -> None:
            nonlocal held, rows, size
            if rows:
                data = b"".join(held)
                data = data if self.codec == "null" else zlib.compress(data, wbits=-15)
                out.write(long_bytes(rows) + sized(data) + marker)
                held, rows, size = [], 0, 0

        try:
            for batch in iterator:
                keys = [batch.column(k).cast(pa.string()) for k in self.keys]
                made = joined(pa.repeat(pa.scalar(b"", BYTES), batch.num_rows), *[encoded(batch.column(f.name), f.dataType) for f in self.own.fields])
                at, data = np.frombuffer(made.buffers()[1], np.int64)[made.offset : made.offset + len(made) + 1], memoryview(made.buffers()[2] or b"")
                for first, last in stretches(keys, batch.num_rows):
                    values = [k[first].as_py() for k in keys]
                    here = "/".join([root, *[f"{k}={NULL_FOLDER if v is None else quote(v, safe=' ')}" for k, v in zip(self.keys, values, strict=True)]])
                    if here != folder:
                        if out is not None:
                            flush()
                            out.close()
                        folder, name = here, f"part-{uuid.uuid4().hex}.avro"
                        fs.create_dir(folder, recursive=True)
                        files.append((f"{folder}/.{name}", f"{folder}/{name}"))
                        out = fs.open_output_stream(files[-1][0])
                        meta = {"avro.schema": json.dumps(avro_schema(self.own)).encode(), "avro.codec": self.codec.encode()}
                        out.write(MAGIC + long_bytes(len(meta)) + b"".join(sized(k.encode()) + sized(v) for k, v in meta.items()) + b"\0" + marker)
                    while first < last:  # up to the row that fills the block
                        upto = min(max(int(np.searchsorted(at, at[first] + self.block - size)), first + 1), last)
                        held.append(data[at[first] : at[upto]])
                        rows += upto - first
                        size += int(at[upto] - at[first])
                        first = upto
                        if size >= self.block:
                            flush()
            if out is not None:
                flush()
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.path)
        for hidden, final in (f for m in messages if m for f in m.files):
            fs.move(hidden, final)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.path)
        for hidden, _final in (f for m in messages if m for f in m.files):
            fs.delete_file(hidden)


class AvroSource(DataSource):
    """Options: path; folders (a JSON list, in place of the whole path); basePath (folders above it are no columns); splitBytes, or tasks (so many at least, if there are bytes for them); for writing partitionBy, codec and blockBytes."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        """The first file's fields and its folders, as strings."""
        reader = AvroReader(T.StructType(), self.options)
        files = reader.files()
        if not files:
            raise ValueError("no Avro file to take a schema from")
        fs, inner = opened(files[0][0])
        with fs.open_input_file(inner) as file:
            own = spark_type(header_of(file).schema)
        keys = [p.partition("=")[0] for p in files[0][0].removeprefix(reader.base).split("/")[:-1] if "=" in p]
        return T.StructType([*own.fields, *[T.StructField(k, T.StringType()) for k in keys]])

    def reader(self, schema: T.StructType) -> AvroReader:
        return AvroReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> AvroWriter:
        return AvroWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> str:
    """Make the source known to a session; returns its name."""
    spark.dataSource.register(AvroSource)
    return NAME
