"""The Avro source on files written here by hand, in other codecs and schemas, and on trees written by the source."""

import datetime as dt
import json
import os
import random
import struct
import zlib
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import fixtures
from starmart.plans import catalog as C
from starmart.schemas import PEOPLE_SNAPSHOT
from starmart.session import new_scratch_dir
from starmart.sources import avro
from starmart.sources.snapshots import scan_snapshots
from tests.conftest import rows


def varint(n):
    n = (n << 1) ^ (n >> 63)
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def text(s):
    return varint(len(s.encode())) + s.encode()


def snappy(raw):
    size, n = b"", len(raw)
    while n > 127:
        size, n = size + bytes([n & 127 | 128]), n >> 7
    body = pa.Codec("snappy").compress(raw, asbytes=True)
    return body + zlib.crc32(raw).to_bytes(4, "big")


def zstandard(raw):
    return __import__("zstandard").ZstdCompressor().compress(raw)


CODECS = {
    "null": lambda raw: raw, "deflate": lambda raw: zlib.compress(raw)[2:-4], "snappy": snappy, "zstandard": zstandard,
    "bzip2": lambda raw: __import__("bz2").compress(raw), "xz": lambda raw: __import__("lzma").compress(raw),
}


def container(schema, records, codec="null", block=10, marker=b"0123456789abcdef"):
    """A container file of encoded records."""
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    out = b"Obj\x01" + varint(len(meta)) + b"".join(text(k) + varint(len(v)) + v for k, v in meta.items()) + varint(0) + marker
    for i in range(0, len(records), block):
        part = records[i : i + block]
        data = CODECS[codec](b"".join(part))
        out += varint(len(part)) + varint(len(data)) + data + marker
    return out


def local(folder):
    return folder.removeprefix("file://").removeprefix("file:")


def stored(spark, files):
    root = new_scratch_dir(spark, "test-avro")
    for name, data in files.items():
        path = f"{local(root)}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.write(data)
    return root


def read(spark, root, schema=None, **options):
    reader = spark.read.format(avro.register(spark)).options(**options)
    return (reader.schema(schema) if schema else reader).load(root)


EVERY = {
    "type": "record", "name": "all", "namespace": "n", "fields": [
        {"name": "b", "type": "boolean"}, {"name": "i", "type": "int"}, {"name": "l", "type": ["null", "long"]}, {"name": "f", "type": "float"}, {"name": "d", "type": "double"},
        {"name": "s", "type": ["string", "null"]}, {"name": "y", "type": "bytes"}, {"name": "x", "type": {"type": "fixed", "name": "two", "size": 2}}, {"name": "e", "type": {"type": "enum", "name": "col", "symbols": ["R", "G"]}},
        {"name": "day", "type": {"type": "int", "logicalType": "date"}}, {"name": "ms", "type": {"type": "long", "logicalType": "timestamp-millis"}}, {"name": "us", "type": {"type": "long", "logicalType": "local-timestamp-micros"}},
        {"name": "dec", "type": {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 2}}, {"name": "a", "type": {"type": "array", "items": ["null", "n.col"]}}, {"name": "m", "type": {"type": "map", "values": "int"}},
        {"name": "r", "type": ["null", {"type": "record", "name": "in", "fields": [{"name": "p", "type": "string"}, {"name": "q", "type": {"type": "array", "items": "long"}}]}]},
    ],
}


def every(k):
    """Encoded record ``k`` and its row."""
    ms = 1_600_000_000_000 + k
    array = b"" if k % 3 == 0 else varint(-2) + varint(4) + varint(1) + varint(k % 2) + varint(0) if k % 3 == 1 else varint(1) + varint(0) + varint(1) + varint(1) + varint(1)
    value = [["G" if k % 2 else "R", None], [None, "G"]][k % 3 - 1] if k % 3 else []
    raw = b"".join([
        bytes([k % 2]), varint(-k), varint(0) if k % 4 == 0 else varint(1) + varint(k << 40), struct.pack("<f", k / 4), struct.pack("<d", k / 3),
        varint(1) if k % 5 == 0 else varint(0) + text(f"é{k}" * (k % 7)), varint(2) + b"\0\xff", b"xy", varint(k % 2),
        varint(k - 50), varint(ms), varint(k * 1_000_001), varint(2) + (-k).to_bytes(2, "big", signed=True), array + varint(0),
        (varint(1) + text("k") + varint(k) if k % 2 else b"") + varint(0), varint(0) if k % 3 == 0 else varint(1) + text("p") + varint(2) + varint(k) + varint(-1) + varint(0),
    ])
    row = (
        k % 2 == 1, -k, None if k % 4 == 0 else k << 40, k / 4, k / 3, None if k % 5 == 0 else f"é{k}" * (k % 7), bytearray(b"\0\xff"), bytearray(b"xy"), "G" if k % 2 else "R",
        dt.date(1970, 1, 1) + dt.timedelta(k - 50), ms, dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=k * 1_000_001), Decimal(-k) / 100, value, {"k": k} if k % 2 else {}, None if k % 3 == 0 else ("p", [k, -1]),
    )
    return raw, row


@pytest.mark.parametrize("codec", sorted(CODECS))
def test_every_type_and_codec_in_one_and_in_many_splits(spark, codec):
    made = [every(k) for k in range(1, 400)]
    root = stored(spark, {"a.avro": container(EVERY, [r for r, _ in made], codec), "_hidden.avro": b"no", "sub/.b.avro": b"no"})
    for size in (1 << 27, 700):
        df = read(spark, root, splitBytes=size).withColumn("ms", F.unix_millis("ms"))
        got = sorted((tuple(r) for r in df.collect()), key=lambda r: -r[1])
        assert [tuple(r[:12]) + (r[12].normalize(),) + tuple(r[13:]) for r in got] == [w[:12] + (w[12].normalize(),) + w[13:] for _, w in made]
        assert df.rdd.getNumPartitions() == (1 if size > 1000 else -(-os.path.getsize(f"{local(root)}/a.avro") // 700))


def test_splits_of_any_size_read_every_block_once(spark):
    schema = {"type": "record", "name": "t", "fields": [{"name": "n", "type": "long"}]}
    data = container(schema, [varint(k) for k in range(200)], block=3)
    header = avro.header_of(pa.BufferReader(data))
    rng = random.Random(1)
    for size in [1, 7, 16, 17, len(data), *[rng.randint(1, len(data)) for _ in range(20)]]:
        for piece in (1 << 20, 5):
            avro.PIECE, kept = piece, avro.PIECE
            try:
                found = [b for at in range(0, len(data), size) for b in avro.blocks(pa.BufferReader(data), header, at, min(at + size, len(data)))]
            finally:
                avro.PIECE = kept
            assert b"".join(d for _, d in found) == b"".join(varint(k) for k in range(200))


def test_declared_schema_is_resolved_by_name(spark):
    schema = {"type": "record", "name": "t", "fields": [{"name": "gone", "type": {"type": "map", "values": "string"}}, {"name": "Num", "type": "int"}, {"name": "s", "type": "string"}]}
    record = varint(1) + text("k") + text("v") + varint(0) + varint(7) + text("x")
    root = stored(spark, {"y=2024/z=a%20b/f.avro": container(schema, [record]), "y=2025/z=__HIVE_DEFAULT_PARTITION__/f.avro": container(schema, [record])})
    want = T._parse_datatype_string("num double, new string, s binary, y int, z string")
    assert rows(read(spark, root, want)) == [(7.0, None, bytearray(b"x"), 2024, "a b"), (7.0, None, bytearray(b"x"), 2025, None)]
    assert read(spark, root).columns == ["gone", "Num", "s", "y", "z"]
    assert rows(read(spark, root, want, folders=json.dumps([f"{root}/y=2025"])), "y") == [(2025,)]
    with pytest.raises(Exception, match="can't be read as"):
        read(spark, root, T.StructType().add("s", "date")).collect()


def test_damaged_files_raise(spark):
    schema = {"type": "record", "name": "t", "fields": [{"name": "n", "type": "long"}]}
    data = container(schema, [varint(k) for k in range(9)])
    for bad in (b"junk" + data, data[:-20], data[:-16] + b"x" * 16):
        with pytest.raises(Exception, match="Avro"):
            read(spark, stored(spark, {"f.avro": bad}), T.StructType().add("n", "long")).collect()


def test_empty_file_and_folder(spark):
    schema = {"type": "record", "name": "t", "fields": [{"name": "n", "type": "long"}]}
    want = T.StructType().add("n", "long")
    assert read(spark, stored(spark, {"f.avro": container(schema, [])}), want).collect() == []
    assert read(spark, stored(spark, {"x/_f": b""}), want).collect() == []


def test_written_tree_reads_back(spark, sf):
    root = fixtures.people_snapshot_tree(spark, sf, "avro")
    scanned = scan_snapshots(spark, root, fmt="avro")
    plain = spark.read.schema(PEOPLE_SNAPSHOT).parquet(fixtures.people_snapshot_tree(spark, sf))
    assert scanned.schema == plain.schema
    key = F.struct(*[F.col(c) for c in plain.columns]).alias("row")
    text_of = lambda df: sorted(r[0] for r in df.select(F.to_json(key)).collect())
    assert text_of(scanned) == text_of(plain)


def test_load_reads_only_chosen_folders(spark, sf):
    df = C._loaded(spark, sf, since=C.WATERMARK_PATH, fmt="avro")
    plan = df._jdf.queryExecution().toString()
    assert "starmart_avro" in plan
    assert rows(C._load_cols(df)) == rows(C.load_missing(spark, sf))


def test_writer_takes_all_types(spark):
    root = new_scratch_dir(spark, "test-avro-write")
    df = spark.range(50).selectExpr(
        "id", "cast(id as int) i", "cast(id as short) h", "id % 2 = 0 b", "cast(id / 3 as float) f", "id / 7 d", "if(id % 5 = 0, null, concat('é', id)) s", "cast(s as binary) y", "date_add(date'1960-01-01', i * 400) day",
        "timestamp_micros(id * 1234567 - 20000000) ts", "cast(timestamp_micros(id) as timestamp_ntz) ntz", "cast(-id / 100 as decimal(12,3)) dec", "if(id % 3 = 0, null, array(i, null)) a", "map('k', struct(i as v)) m", "if(id % 2 = 0, null, struct(s, array(struct(id)) as z)) r", "id % 3 as p",
    )
    df.repartition(3).sortWithinPartitions("p").write.format(avro.register(spark)).option("partitionBy", "p").option("blockBytes", "200").mode("append").save(root)
    back = read(spark, root, df.schema, splitBytes=500)
    shown = lambda x: sorted(r[0] for r in x.select(F.to_json(F.struct(*df.columns))).collect())
    assert shown(back) == shown(df)


def test_columns_are_encoded_as_their_values(spark):
    kinds = T.StructType.fromDDL("n long, s string, y binary, f double, day date, b boolean, a array<struct<s:string,n:int>>, m map<string,int>, r struct<a:array<string>,r:struct<d:decimal(9,2)>>")
    deep = [[], None, [None], [{"s": "é" * 70, "n": None}, {"s": "", "n": -1}]]
    inner = [None, {"a": None, "r": None}, {"a": ["", None, "x"], "r": {"d": Decimal("-1.50")}}]
    made = [
        {"n": [None, 0, -1, 2**62][i % 4], "s": [None, "", "a" * i, "é" * 9000][i % 4], "y": [b"\0", None][i % 2], "f": [0.0, -0.0, None, 1.5][i % 4], "day": [None, dt.date(1950, 1, i + 1)][i % 2], "b": [True, None, False][i % 3], "a": deep[i % 4], "m": [None, [], [("k", None)]][i % 3], "r": inner[i % 3]}
        for i in range(24)
    ]
    batch = pa.RecordBatch.from_pylist(made, schema=avro.to_arrow_schema(kinds)).slice(5, 17)
    for f in kinds.fields:
        column = batch.column(f.name)
        assert avro.encoded(column, f.dataType).to_pylist() == [*map(avro.encoder_of(f.dataType), column.to_pylist())], f.name
    calls = []
    avro.once_each(pa.array(["x", None] * 500), lambda v: calls.append(v) or b"")
    assert calls == ["x", None]  # not a call a row


def test_one_small_file_is_shared_by_tasks():
    reader = avro.AvroReader(T.StructType(), {"path": "/x", "tasks": "12"})
    reader.files = lambda: [("/x/f.avro", 20 << 20), ("/x/g.avro", 10)]
    ranges = [r for s in reader.partitions() for r in s.ranges]
    assert len(reader.partitions()) >= 12  # one, when only 128 MB made a split
    cuts = [r[1:] for r in ranges if r[0] == "/x/f.avro"]
    assert cuts[0][0] == 0 and cuts[-1][1] == 20 << 20 and all(x[1] == y[0] for x, y in zip(cuts, cuts[1:], strict=False))
    assert [r for r in ranges if r[0] == "/x/g.avro"] == [("/x/g.avro", 0, 10)]
    reader.options["splitbytes"] = str(128 << 20)
    assert len(reader.partitions()) == 1


def test_full_load_decodes_only_what_it_returns(spark, sf):
    df = C.load_all_avro(spark, sf)
    scan = next(line for line in df._jdf.queryExecution().analyzed().toString().splitlines() if "starmart_avro" in line)
    assert "id#" in scan and "etlid#" in scan
    assert "managers_hierarchy" not in scan and "employee_name" not in scan
    assert rows(df) == rows(C.load_all(spark, sf))
