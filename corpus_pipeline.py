"""A corpus from raw documents: identify, deduplicate, decontaminate, mix, shard.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
its result is written as Parquet and read again as the next stage's input. Every stage
takes whole texts of any length, passes all columns of ``docs`` through whatever their
names, and gives no rows for none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontam, langid, mixing, sharding, simhash
from starmart.llm.common import free_names, table
from starmart.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or none with half of the text, go.

    Null texts and texts without letters have none. Repeated rows share their fate, also with null ids.
    Only ``doc_id``, ``text`` and ``lang`` are read; the model learns from rows with an id and a language.
    """
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    Rows of that id, or of a group without ids, leave one row: that of the least hash over all columns.
    Null and empty texts have fingerprint zero and make a group like others (language ID has dropped them before).
    """
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows in a twentieth of their words go.

    Null texts have no words and stay, as does every document where the benchmark is empty. Rows are judged one by one,
    repeated ones alike.
    """
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks.

    A null source is a source of its own. Null and empty texts have size zero, and their source's rate like others.
    Rows with equal ids get the same draw.
    """
    return mixing.emit_mix(docs)


def sharding_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in shards of the curve order, with their shard and slot.

    Nulls have cells of their own; equal rows stand side by side. The added columns get underscores where ``docs`` has their names.
    """
    names = ["size", "text_crc32", "curve", "shard", "slot"]
    place, *own = free_names(docs, "_place", *names)
    done = sharding.hilbert_shards(docs, keep=docs.columns, out=place)
    return done.select(*docs.columns, *[done[place][n].alias(o) for n, o in zip(names, own, strict=True)])


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("sharding", sharding_order),
]
#: Crc32, XXH64 and the fitted language model have no DuckDB form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
