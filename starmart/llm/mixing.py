"""Mixing sources to target weights (operator 8).

Sizes are aggregated per source, targets follow from weights by water filling,
and each document is emitted floor(rate) times plus one more time when a number
hashed from the seed and its doc_id falls below the rate's fraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialize

from .common import free_names, ranked, word_count

WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = 42
HEX_DIGITS = 12  # of the md5 that make a number in [0, 1)


def unit_hash(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the seed and the key; the same on every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    number = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("long")
    return number.cast("double") / F.lit(float(16**HEX_DIGITS))


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """One row a source: ``source``, ``source_size``, ``target`` (double).

    Sources rank by code point, null last, and take the weights in turn. A target
    stops at ``max_repeat`` times the source's size and the rest is shared again by
    weight until none is above; each round is one sum over the table of sources.
    """
    per_source = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    order = ranked(per_source, [F.col("source").asc_nulls_last()], "place", "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * max_repeat).cast("decimal(38,0)")
    stored = materialize(order.select("source", "source_size", weight.cast("long").alias("weight")), "weights")

    total, shares = stored.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, open_weight, capped = int(total or 0), int(shares or 1), -1
    while True:
        full = cap * F.lit(open_weight) <= F.lit(rest).cast("decimal(38,0)") * F.col("weight")
        n, held, left = stored.agg(
            F.count(F.when(full, 1)), F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        if n == capped or not left:
            break
        rest, open_weight, capped = int(total) - int(held or 0), int(left), n
    share = (F.lit(rest).cast("decimal(38,0)") * F.col("weight")).cast("double") / F.lit(float(open_weight))
    target = F.when(full, (F.col("source_size") * max_repeat).cast("double")).otherwise(share)
    return stored.select("source", "source_size", target.alias("target"))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: int = SEED,
    out: str = "mix",
) -> DataFrame:
    """``docs`` with a struct ``out``: size, source_size, target, copies.

    A null or empty text has size 0. A null source is a source of its own, ranked
    last. Rows with equal ids draw the same number, so repeated rows get the same
    copies. A source of size 0 has target 0 and none of its rows is emitted.
    An empty table gives an empty result. Columns of any other name pass through.
    """
    size, key, gone, joined = free_names([*docs.columns, out], "_size", "_source", "_null", "_targets")
    sized = docs.withColumn(size, word_count(F.col(text_col)))
    targets = source_targets(docs.select(source_col, word_count(F.col(text_col)).alias(size)), source_col, size, weights, max_repeat)
    targets = targets.select(
        F.coalesce("source", F.lit("")).alias(key),
        F.col("source").isNull().alias(gone),
        F.struct("source_size", "target").alias(joined),
    )
    sized = sized.withColumn(key, F.coalesce(F.col(source_col), F.lit(""))).withColumn(gone, F.col(source_col).isNull())
    of = F.col(joined)
    rate = F.when(of["source_size"] > 0, of["target"] / of["source_size"]).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    copies = whole + F.when(unit_hash(F.col(id_col), seed) < rate - whole, 1).otherwise(0)
    result = F.struct(F.col(size).alias("size"), of["source_size"].alias("source_size"), of["target"].alias("target"), copies.cast("long").alias("copies"))
    return sized.join(targets, [key, gone]).select(*[c for c in docs.columns if c != out], result.alias(out))


def emit_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows themselves: each document as often as its plan says, with the columns of ``docs``."""
    plan, n = free_names(docs, "_mix", "_copy")
    planned = mix_plan(docs, out=plan, **options)
    copies = F.explode(F.sequence(F.lit(1), F.col(plan)["copies"]))
    return planned.where(F.col(plan)["copies"] > 0).withColumn(n, copies).select(*docs.columns)
