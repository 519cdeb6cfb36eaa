"""SimHash near-duplicates by Golay-code fuzzy hashing (operator 6).

A fingerprint of 64 bits is cut into three segments, the last one padded to the
23 bits of the binary Golay code. If two fingerprints differ in at most two bits,
one segment is equal and, of the two others, one differs in at most one bit. A
23-bit word has one codeword within distance three and, if it lies at distance
three, five more at distance four; words at distance two or less always share
one of these. So each ordered pair of segments gives the keys (first segment
as it is, index of each near codeword of the second), and linked fingerprints
share a key. Keys are joined and the bit distance is verified.

Buckets of more than ``BUCKET`` fingerprints are not paired: two words at distance
two or less have a common word within one flip of both, so the members of such
buckets are grouped by themselves and their 64 one-bit flips, where all members
of a group are linked and one star of edges says so. Both ways are exact.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import materialize

from .common import free_names
from .components import components

SHINGLE = 3  # words
DISTANCE = 2  # bits
SEED = 42
BITS = 64
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, bits
BUCKET = 32
CODE, DATA = 23, 12
#: Generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
LOWERED = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint_of(raw: bytes) -> int:
    """SimHash over the XXH64 of the 3-word shingles of a text's bytes."""
    words = raw.translate(LOWERED).split()  # bytes.split parts at tab to carriage return and space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = (ends - [len(w) + 1 for w in words])[: 1 - SHINGLE].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > len(hashes)).tolist())


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """Fingerprint as a signed long; null and wordless texts have fingerprint 0."""
    prints = [fingerprint_of(raw or b"") for raw in texts.cast(pa.large_binary()).to_pylist()]
    return pa.array(np.array(prints, np.uint64).view(np.int64))


@functools.cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codewords by data word, error pattern by syndrome, and the weight-7 codewords' places by error pattern are derived from the generator."""
    data = np.arange(1 << DATA, dtype=np.int64)
    code = data << (CODE - DATA)
    rest = syndrome(code)
    code ^= rest
    one = 1 << np.arange(CODE, dtype=np.int64)
    two = (one[:, None] | one[None, :]).ravel()
    three = (two[:, None] | one[None, :]).ravel()
    errors = np.unique(np.concatenate([[0], one, two, three]))
    leader = np.zeros(1 << (CODE - DATA), np.int64)
    leader[syndrome(errors)] = errors
    seven = code[np.bitwise_count(code.astype(np.uint32)) == 7]
    return code, leader, seven


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of division by the generator polynomial."""
    rest = words.astype(np.int64).copy()
    for bit in range(CODE - 1, CODE - DATA - 1, -1):
        rest = np.where(rest >> bit & 1 == 1, rest ^ (GENERATOR << (bit - (CODE - DATA))), rest)
    return rest


def near_codewords(words: np.ndarray) -> list[np.ndarray]:
    """For each word the data indices of the codewords within distance four: one, or six if the word lies at distance three."""
    _, leader, seven = golay()
    error = leader[syndrome(words)]
    home = words ^ error
    deep = np.bitwise_count(error.astype(np.uint32)) == 3
    out = [home[i : i + 1] >> (CODE - DATA) for i in range(len(words))]
    patterns, where = np.unique(error[deep], return_inverse=True)
    around = [seven[seven & p == p] for p in patterns]  # five weight-7 codewords hold any three places
    for i, k in zip(np.flatnonzero(deep).tolist(), where.tolist(), strict=True):
        out[i] = np.concatenate([out[i], (home[i] ^ around[k]) >> (CODE - DATA)])
    return out


@F.arrow_udf(T.ArrayType(T.LongType()))
def golay_keys(prints: pa.Array) -> pa.Array:
    """Keys of a fingerprint: segment pair, first segment exactly, codeword index near the second."""
    fp = prints.to_numpy(zero_copy_only=False).view(np.uint64)
    seg = [(fp >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    near = [near_codewords(s) for s in seg]
    pairs = [(i, j) for i in range(len(seg)) for j in range(len(seg)) if i != j]
    rows = [np.concatenate([(p << (CODE + DATA)) | (seg[i][r] << DATA) | near[j][r] for p, (i, j) in enumerate(pairs)]) for r in range(len(fp))]
    return pa.array(rows, pa.list_(pa.int64()))


def linked(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= DISTANCE


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (column fp, distinct) at distance two or less."""
    keyed = materialize(prints.select("fp", F.explode(golay_keys("fp")).alias("key")), "golay-keys")
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    buckets = materialize(buckets, "buckets")
    pairs = buckets.where("n = 2").where(linked(F.col("a"), F.col("b"))).select("a", "b")

    several = materialize(keyed.join(buckets.where("n > 2").select("key", "n"), "key"), "shared-keys")
    members = several.where(F.col("n") <= BUCKET).groupBy("key").agg(F.collect_list("fp").alias("m"))
    partners = F.filter(F.transform(F.col("m"), lambda x, i: F.struct(x.alias("a"), F.filter(F.slice("m", i + 2, BUCKET), lambda y: linked(x, y)).alias("bs"))), lambda s: F.size(s["bs"]) > 0)
    small = members.select(F.explode(partners).alias("s")).select(F.col("s.a").alias("a"), F.explode("s.bs").alias("b"))

    flips = F.array(F.lit(0), *[F.lit((1 << i) - (1 << BITS) if i == BITS - 1 else 1 << i) for i in range(BITS)])
    crowd = several.where(F.col("n") > BUCKET).select("fp").distinct()
    around = materialize(crowd.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word")), "flips")
    centre = around.groupBy("word").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("word", "b")
    stars = around.join(centre, "word").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.unionByName(small).unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, fp (signed long), component_id.

    ``component_id`` is the smallest id reachable over links of at most two bits;
    nulls are ignored, and a component of null ids only has a null one. Null and
    wordless texts have fingerprint zero and are linked like any other. Repeated
    rows each give a row, and texts of any length are taken whole. Other columns of ``docs``,
    whatever their names, play no part and are not returned. An empty table gives none.
    """
    hashed = materialize(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp")), "fingerprints")
    groups = materialize(hashed.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    roots = components(fingerprint_links(groups.select("fp"))).select(F.col("node").alias("fp"), "root")
    named = groups.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = materialize(named, "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    members = materialize(named.join(least, "root").select("fp", "component_id"), "components")
    return hashed.join(members, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    If several rows hold that id, or all ids of the component are null, the row
    with the least hash over all columns stays, and of wholly equal rows one. All columns
    pass through, whatever their names.
    """
    (row,) = free_names(docs, "_row")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), whole.alias("hash"))
    found = near_duplicates(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text")
    kept = found.select(F.col("component_id.hash").alias(row)).distinct()
    rows = docs.withColumn(row, whole).join(kept, row, "left_semi")
    return rows.dropDuplicates([row, id_col]).select(*docs.columns)  # the join has dealt the rows by this hash
