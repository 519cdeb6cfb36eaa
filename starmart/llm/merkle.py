"""Merkle manifest of a dataset with checkpointed levels (operator 13).

Every row becomes a leaf, a SHA-256 of its fields. The leaves of a group, in the
order of a key, are hashed two by two, level by level, to the group's subroot, and
the subroots of all groups likewise to the root. Only every ``SPAN``-th level of a tree
is stored. To prove rows, the stored nodes below each stored node are gathered (at
most 2^SPAN of them), the levels between are hashed again, the siblings of each are
emitted and the rest is thrown away; siblings further up come, once for each such
subtree, from the same step one stored level higher. So no task holds more than one
subtree, and hot groups are split like all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import materialize

from .common import ranked

SPAN = 8  # levels of a subtree between stored ones
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Columns of a stored level: the tree, the node's place in the level, the level's number of nodes, its digest.
NODE = ("tree", "idx", "n", "digest")


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests written as lower-case hex one after another."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def height(n: int) -> int:
    """Levels from ``n`` nodes to one."""
    return max(n - 1, 0).bit_length()


def hashed(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and the levels above them, every two neighbours one node; a last one alone is hashed alone."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(levels: list[list[bytes]], at: int) -> bytes:
    """Digests beside the path from node ``at`` of the lowest level up, one after another."""
    beside = ((level, (at >> k) ^ 1) for k, level in enumerate(levels[:-1]))
    return b"".join(level[j] for level, j in beside if j < len(level))


def fold(node: bytes, places: Sequence[tuple[int, int]], proof: bytes) -> bytes:
    """The root over ``node``; ``places`` are its place and the number of nodes in each tree it climbs, lowest first."""
    used = 0
    for idx, n in places:
        while n > 1:
            parts = [node]
            if idx ^ 1 < n:
                parts.insert(idx & 1 ^ 1, proof[used : used + 32])
                used += 32
            node, idx, n = digest(*parts), idx >> 1, (n + 1) // 2
    if used != len(proof):
        raise ValueError("proof doesn't fit the place")
    return node


@F.arrow_udf(T.BinaryType())
def folded(node: pa.Array, idx: pa.Array, n: pa.Array, tree: pa.Array, trees: pa.Array, proof: pa.Array) -> pa.Array:
    """Root over a row's digest, its proof taken as given; null without a digest."""
    rows = zip(*(c.to_pylist() for c in (node, idx, n, tree, trees, proof)), strict=True)
    return pa.array([None if d is None else fold(d, [(i, size), (t, many)], p) for d, i, size, t, many, p in rows], pa.binary())


def leaf(*fields: Column) -> Column:
    """SHA-256 of fields: ``-`` for null, else number of UTF-8 bytes, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]).cast("binary"), 256))


@dataclass(frozen=True)
class Manifest:
    """Stored levels of the groups' trees and of the tree over their subroots, lowest first; ``groups`` has each tree's value."""

    levels: list[DataFrame]
    top: list[DataFrame]
    groups: DataFrame

    def root(self) -> DataFrame:
        """One row ``digest``; none for an empty dataset."""
        return self.top[-1].select("digest")


def climb(nodes: DataFrame, span: int) -> list[DataFrame]:
    """The stored levels over ``nodes`` (a stored table), up to the one where every tree has one node."""
    out, most = [nodes], nodes.agg(F.max("n")).first()[0] or 1

    @F.arrow_udf(T.BinaryType())
    def subroot(below: pa.Array, n: pa.Array) -> pa.Array:
        return pa.array([hashed([x["digest"] for x in b], min(span, height(m)))[-1][0] for b, m in zip(below.to_pylist(), n.to_pylist(), strict=True)], pa.binary())

    while most > 1:
        above = F.shiftright("idx", span)
        grouped = out[-1].groupBy("tree", above.alias("idx")).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("below"))  # at most 2^span
        size = F.ceil(F.col("n") / (1 << span)).cast("long")
        out.append(materialize(grouped.select("tree", "idx", size.alias("n"), subroot("below", "n").alias("digest")), "merkle"))
        most = -(-most >> span)
    return out


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, tree_col: str = "lang", order_col: str = "doc_id", keep: dict[str, Column] | None = None, span: int = SPAN) -> Manifest:
    """Hash all rows of ``docs`` and store every ``span``-th level.

    ``keep`` are more columns, by name, that the leaves carry on; their names start with none of this table's. Rows of a group stand by
    ``order_col``, null first, equal ones by their leaf, so repeated rows are leaves of their own. Null makes a group that
    stands first. Texts of any length are hashed by Spark's own function. An empty table has no node and no root.
    """
    kept = {f"kept_{k}": c for k, c in (keep or {}).items()}
    rows = docs.select(F.col(tree_col).cast("string").alias("value"), F.col(order_col).alias("place"), leaf(*[F.col(f) for f in fields]).alias("digest"), *[c.alias(k) for k, c in kept.items()])
    order = [F.col("value").asc_nulls_first(), F.col("place").asc_nulls_first(), F.col("digest")]
    leaves = ranked(materialize(rows, "leaves"), order, "at", "ordered")
    sizes = leaves.groupBy("value").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = ranked(sizes, [F.col("value").asc_nulls_first()], "tree", "groups")
    placed = leaves.join(groups.withColumnRenamed("value", "group"), F.col("value").eqNullSafe(F.col("group")))
    levels = climb(materialize(placed.select("tree", (F.col("at") - F.col("first")).alias("idx"), "n", "digest", *kept), "merkle"), span)
    many = groups.count()
    subroots = levels[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(many).cast("long").alias("n"), "digest")
    return Manifest(levels, climb(materialize(subroots, "merkle"), span), groups)


def extracted(nodes: DataFrame, above: DataFrame, span: int) -> DataFrame:
    """``nodes`` with ``proof``: their siblings in their subtree, then the proof of the subtree's root in ``above``; its other columns are handed down."""
    handed = [f for f in above.schema.fields if f.name not in (*NODE, "proof")]
    own = nodes.schema.fields
    schema = T.StructType([*own, T.StructField("proof", T.BinaryType()), *handed])

    def emit(below: pa.Table, root: pa.Table) -> pa.Table:
        below = below.sort_by("idx")
        levels = hashed(below["digest"].to_pylist(), min(span, height(below["n"][0].as_py())))
        up = root.to_pylist()[0]
        out = [below[f.name] for f in own]
        out.append(pa.array([siblings(levels, i) + up["proof"] for i in range(len(below))], pa.binary()))
        out += [pa.repeat(pa.scalar(up[f.name], root.schema.field(f.name).type), len(below)) for f in handed]
        return pa.table(dict(zip(schema.names, out, strict=True)))

    subtrees = nodes.groupBy("tree", F.shiftright("idx", span).alias("subtree"))
    return subtrees.cogroup(above.groupBy("tree", "idx")).applyInArrow(emit, schema)


def proofs(manifest: Manifest, span: int = SPAN) -> DataFrame:
    """A row a leaf: its node, what ``build`` kept, proof (siblings from the leaf's level to the root), subroot, root and the number of trees.

    ``span`` must be the one the manifest was built with.
    """
    tip = manifest.top[-1]
    above = tip.select("tree", "idx", F.lit(b"").alias("proof"), F.col("digest").alias("root"))
    for level in reversed(manifest.top[:-1]):
        above = extracted(level, above, span)
    if len(manifest.top) == 1:
        above = tip.select(*NODE, F.lit(b"").alias("proof"), F.col("digest").alias("root"))
    above = above.select(F.col("idx").alias("tree"), F.lit(0).cast("long").alias("idx"), "proof", "root", F.col("digest").alias("subroot"), F.col("n").alias("trees"))
    if len(manifest.levels) == 1:
        return manifest.levels[0].join(above.drop("idx"), "tree")
    for level in reversed(manifest.levels[:-1]):
        above = extracted(level, above, span)
    return above
