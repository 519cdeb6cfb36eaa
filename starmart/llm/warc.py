"""WARC archives over a chunked record table (operator 3).

Writing: payload digests are taken first, equal payloads become one response and
revisits of it, and every payload leaves as rows of (record id, chunk number)
that carry the digest of the payload up to the chunk's end. A chunk is one WARC
record; chunks after the first are ``continuation`` records as the format
defines them for segmented payloads. Spark's text writer stores them, with the
empty line that ends a record as its line separator, so any file system Spark
knows will do.

Reading: archives are inflated and parsed in small pieces. Whole payloads are
checked on the spot; chunks of larger ones are dealt by record id, sorted by chunk
number and run through one digest, so no task ever holds a whole payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import materialize, new_scratch_dir

CHUNK_BYTES = 64 << 10
FILE_RECORDS = 2048  # so an archive holds at most this many chunks
PIECE_BYTES = 256 << 10  # inflated at a time
BATCH_BYTES = 4 << 20
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
#: Rows of the chunked record table.
CHUNK_ROWS = "record_id string, chunk int, chunks int, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, prefix_digest string, block binary"
CHUNK_SCHEMA = pa.schema([("record_id", pa.string()), ("chunk", pa.int32()), ("chunks", pa.int32()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("prefix_digest", pa.string()), ("block", pa.binary())])
RECORD_ROWS = "record_id string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
RECORD_SCHEMA = pa.schema([CHUNK_SCHEMA.field(x.split()[0]) for x in RECORD_ROWS.split(", ")])


class DamagedArchive(ValueError):
    """A digest, a length or the order of chunks doesn't fit."""


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}').urn}>"


def cuts(payload: memoryview, size: int) -> Iterator[tuple[int, int]]:
    """Chunk bounds of at most ``size`` bytes that part no UTF-8 character."""
    at, n = 0, len(payload)
    while at < n or at == 0:
        end = min(at + size, n)
        while end < n and end > at + 1 and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield at, end
        at = max(end, at + 1)


def header(**fields) -> bytes:
    lines = [f"{k.replace('_', '-')}: {v}" for k, v in fields.items() if v is not None]
    return "\r\n".join(["WARC/1.1", *lines]).encode("utf-8", "surrogatepass") + END


def record_chunks(page_id: int | None, url: str | None, payload: memoryview, digest: str, owner: int | None, size: int) -> Iterator[bytes]:
    """The WARC records of a page without their ending: one for a revisit, one a chunk for a response."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else None
    common = {"WARC_Date": DATE, "WARC_Target_URI": url, "X_Page_ID": page_id, "X_Payload_Length": len(payload), "WARC_Payload_Digest": f"sha1:{digest}"}
    own = record_id(page_id, digest)
    if owner is not None and owner != page_id:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield header(WARC_Type="revisit", WARC_Record_ID=own, **common, WARC_Profile=profile, WARC_Refers_To=record_id(owner, digest), X_Refers_To_Page=owner, Content_Length=0)
        return
    bounds = list(cuts(payload, size))
    running = hashlib.sha1()
    for k, (a, b) in enumerate(bounds):
        running.update(payload[a:b])
        segment = {"WARC_Segment_Number": k + 1, "X_Segments": len(bounds)} if len(bounds) > 1 else {}
        if k:
            segment |= {"WARC_Segment_Origin_ID": own}
        part = own if k == 0 else f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}:{k}').urn}>"
        yield header(WARC_Type="continuation" if k else "response", WARC_Record_ID=part, **common, **segment, X_Prefix_Digest=f"sha1:{base32(running.digest())}", Content_Type="text/html", Content_Length=b - a) + payload[a:b]


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) as gzip WARC files under ``path``.

    Of rows with equal payloads those with the largest page_id are responses and
    the others revisit it. A null html is an empty payload, a null url has no
    target field; rows with a null page_id revisit like others, and are all
    responses where no row of their payload has an id. Repeated rows of the
    largest id are all written as responses. An empty table writes no record.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    groups = keyed.groupBy("sha1").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("owner")).where("n > 1").drop("n")
    rows = keyed.join(groups, "sha1", "left").select("page_id", "url", "html", "sha1", "owner")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [header(WARC_Type="warcinfo", WARC_Record_ID=f"<{uuid.uuid5(uuid.NAMESPACE_URL, 'warcinfo').urn}>", WARC_Date=DATE, Content_Type="application/warc-fields", Content_Length=0)], 0
        for batch in batches:
            page, url, text, sha1, owner = batch.columns
            for p, u, t, d, o in zip(page.to_pylist(), url.to_pylist(), text, sha1.to_pylist(), owner.to_pylist(), strict=True):
                for block in record_chunks(p, u, memoryview(t.as_buffer()), base32(bytes.fromhex(d)), o, chunk_bytes):
                    out.append(block)
                    held += len(block)
                    if held >= BATCH_BYTES:
                        yield pa.record_batch([pa.array(out, pa.binary()).view(pa.string())], ["value"])
                        out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary()).view(pa.string())], ["value"])

    blocks = rows.mapInArrow(archive, "value string")
    blocks.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def inflated(data: memoryview) -> Iterator[bytes]:
    """Pieces of a gzip file of one or more members."""
    at, machine = 0, zlib.decompressobj(31)
    while at < len(data):
        piece, at = machine.decompress(data[at : at + PIECE_BYTES], PIECE_BYTES), at + PIECE_BYTES
        while piece or machine.unconsumed_tail:
            yield piece
            piece = machine.decompress(machine.unconsumed_tail, PIECE_BYTES)
        if machine.eof:
            at -= len(machine.unused_data)
            machine = zlib.decompressobj(31)


def parsed(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record; a block is one chunk."""
    buffer = bytearray()

    def more(size: int) -> bool:
        while len(buffer) < size:
            piece = next(pieces, None)
            if piece is None:
                return False
            buffer.extend(piece)
        return True

    while more(1):
        seen = 0
        while (end := buffer.find(END, max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not more(seen + 1):
                raise DamagedArchive("a header does not end")
        fields = dict(line.split(": ", 1) for line in buffer[:end].decode("utf-8", "surrogatepass").split("\r\n")[1:])
        size = int(fields["Content-Length"])
        start = end + len(END)
        if not more(start + size + len(END)) or buffer[start + size : start + size + len(END)] != END:
            raise DamagedArchive(f"the record {fields.get('WARC-Record-ID')} is cut off")
        block = bytes(buffer[start : start + size])
        del buffer[: start + size + len(END)]
        yield fields, block


def chunk_row(fields: dict[str, str], block: bytes) -> tuple:
    """A row of the chunked record table; the block is kept only where the payload has several chunks."""
    number = lambda k: int(fields[k]) if k in fields else None
    chunks, chunk = number("X-Segments") or 1, (number("WARC-Segment-Number") or 1) - 1
    kind = "revisit" if fields["WARC-Type"] == "revisit" else "response"
    prefix = fields.get("X-Prefix-Digest", "").removeprefix("sha1:") or None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and chunks == 1:
        if base32(hashlib.sha1(block).digest()) != digest or len(block) != number("X-Payload-Length"):
            raise DamagedArchive(f"the payload of {fields['WARC-Record-ID']} does not fit its digest")
        block = None
    own = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
    return own, chunk, chunks, number("X-Page-ID"), kind, number("X-Refers-To-Page"), number("X-Payload-Length"), digest, prefix, block


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of the archives under ``path``."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for fields, block in parsed(inflated(memoryview(content.as_buffer()))):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    rows.append(chunk_row(fields, block))
                    held += 500 + len(rows[-1][-1] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CHUNK_SCHEMA, strict=True)], schema=CHUNK_SCHEMA)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), CHUNK_SCHEMA, strict=True)], schema=CHUNK_SCHEMA)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(chunks, CHUNK_ROWS)


def checked_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of several chunks from rows sorted by record and chunk; one running digest is all that is held.

    Repeated rows of a page give each chunk as many times as the page; the first
    copy is digested and the record is returned that many times.
    """
    own, running, length, at, copies, last = None, hashlib.sha1(), 0, -1, 0, None

    def closed() -> list[dict]:
        if own is None:
            return []
        if at + 1 != last["chunks"] or length != last["payload_bytes"] or base32(running.digest()) != last["payload_digest"]:
            raise DamagedArchive(f"the payload of {own} does not fit its digest")
        return [{f.name: last[f.name] for f in RECORD_SCHEMA}] * copies

    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
            if row["record_id"] != own:
                out += closed()
                own, running, length, at, copies = row["record_id"], hashlib.sha1(), 0, -1, 0
            if row["chunk"] == at:
                copies += at == 0
                continue
            if row["chunk"] != at + 1:
                raise DamagedArchive(f"{own} lacks chunk {at + 1}")
            running.update(row["block"])
            at, length, copies, last = at + 1, length + len(row["block"]), copies + (at < 0), row
            if base32(running.digest()) != row["prefix_digest"]:
                raise DamagedArchive(f"chunk {at} of {own} does not fit its digest")
        yield pa.RecordBatch.from_pylist(out, RECORD_SCHEMA)
    yield pa.RecordBatch.from_pylist(closed(), RECORD_SCHEMA)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One verified row a page: record_id, page_id, record_type, refers_to, payload_bytes, payload_digest."""
    chunks = materialize(read_chunks(spark, path), "chunks")
    whole = chunks.where("chunks = 1").select(*RECORD_SCHEMA.names)
    parts = chunks.where("chunks > 1").repartition("record_id").sortWithinPartitions("record_id", "chunk")
    return whole.unionByName(parts.mapInArrow(checked_records, RECORD_ROWS))


def round_trip(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    path = new_scratch_dir(pages.sparkSession, "warc")
    write_archives(pages, path, chunk_bytes)
    return read_records(pages.sparkSession, path)
