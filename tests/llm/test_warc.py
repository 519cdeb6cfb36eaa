"""Archives: exact round trip, revisits, chunks, damage."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from starmart.llm import warc

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    """Rows as the contract says them."""
    owner = {}
    for p, _, h in rows:
        h = h or ""
        if p is not None:
            owner[h] = max(p, owner.get(h, p))
    out = []
    for p, _, h in rows:
        h = h or ""
        data, o = h.encode(), owner.get(h)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        response = o is None or p == o
        out.append((p, len(data), digest, "response" if response else "revisit", None if response else o))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


ROWS = [
    (1, "http://a", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, None, None), (4, "x y\r\nz", ""), (5, "u", "a\r\n\r\nb\r\n\r\n"),
    (6, "u", "é" * 5000), (7, "u", "é" * 5000), (7, "u", "é" * 5000), (8, "u", "WARC/1.1\r\nContent-Length: 9\r\n\r\n" * 90), (None, "u", "no id"), (None, "u", "é" * 5000), (9, "u", "𝄞x" * 3000),
]


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 16])
def test_round_trip(spark, chunk):
    assert got(warc.round_trip(spark.createDataFrame(ROWS, SCHEMA), chunk)) == expected(ROWS)


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunks_rebuild_payloads_and_carry_prefix_digests(spark, tmp_path):
    path = f"file://{tmp_path}/w"
    warc.write_archives(spark.createDataFrame([(1, "u", "ab€" * 4000)], SCHEMA), path, 1024)
    rows = sorted(warc.read_chunks(spark, path).collect(), key=lambda r: r["chunk"])
    assert len(rows) > 15 and max(len(r["block"]) for r in rows) <= 1024
    data = b""
    for r in rows:
        data += r["block"]
        assert r["prefix_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert data == ("ab€" * 4000).encode()


def test_damage_is_found(spark, tmp_path):
    path = f"{tmp_path}/w"
    warc.write_archives(spark.createDataFrame([(1, "u", "abcdef" * 100)], SCHEMA), f"file://{path}", 64)
    chunks = warc.read_chunks(spark, f"file://{path}")
    for bad in (chunks.where("chunk <> 3"), chunks.withColumn("block", F.when(F.col("chunk") == 2, F.lit(b"x" * 64)).otherwise(F.col("block")))):
        sorted_rows = bad.coalesce(1).sortWithinPartitions("record_id", "chunk")
        with pytest.raises(Exception, match="DamagedArchive"):
            sorted_rows.mapInArrow(warc.checked_records, warc.RECORD_ROWS).collect()
    records = list(warc.parsed(iter([gzip.compress(b"")[:0] + b"WARC/1.1\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"])))
    assert records[0][1] == b"ab"
    with pytest.raises(warc.DamagedArchive):
        list(warc.parsed(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nab"])))


def test_query_on_pages(spark, sf):
    from starmart.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got(QUERIES["op3_warc_chunks"](spark, sf)) == expected(rows)
