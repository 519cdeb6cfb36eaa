"""Where dimensions, facts and the detail table live: Parquet, JDBC or CSV.

Every warehouse offers the same calls: ``exists``, ``read``, ``write``, ``write_fact``,
``clear_days``, ``refresh`` and ``unique``. A table is absent only if the store says it is not there;
any other failure raises, so an outage never looks like a first publish. Read
options and write options are kept apart (a dimension read never receives write
options such as ``truncate``). ``assigns_keys`` says that the store numbers
dimension members itself (identity columns): merges then append attributes only.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage

FACT_PARTITION = "DayKey"
STATES = "_states"  # folder of the numbered states of a Parquet warehouse
VERSION = "version"  # folder key of what one write stored


def _merged(base: Mapping[str, str] | None, extra: Mapping[str, str] | None) -> dict[str, str]:
    out = dict(base or {})
    out.update(extra or {})
    return out


def _clustered(df: DataFrame) -> DataFrame:
    """Fact rows dealt by day in tasks of the advised size: AQE splits a large day and joins small ones."""
    return df.hint("rebalance", FACT_PARTITION)


class Conflict(RuntimeError):
    """Another publisher changed a table that a refresh had read."""


@dataclass
class Edit:
    """A change of one table: folders that come, and what goes (all, or the facts' days ``gone``).

    ``days`` are those that a fact's folder holds.
    """

    name: str
    folders: list[str] = field(default_factory=list)
    days: list[int] | None = None
    gone: set[int] = field(default_factory=set)
    whole: bool = False
    schema: str | None = None
    unique: bool | None = None

    def apply(self, tables: dict[str, dict]) -> None:
        old = tables.get(self.name, {"folders": [], "days": {}, "schema": None, "unique": None})
        days = {f: d if self.gone.isdisjoint(d["live"]) else {"live": [x for x in d["live"] if x not in self.gone], "cut": True} for f, d in old["days"].items()}
        dead = {f for f, d in days.items() if not d["live"]} | {f"{FACT_PARTITION}={d}" for d in self.gone}
        kept = [] if self.whole else [f for f in old["folders"] if f not in dead]
        if self.days is not None:
            days |= {f: {"live": self.days, "cut": False} for f in self.folders}
        folders = kept + self.folders
        unique = old["unique"] if self.unique is None else self.unique
        tables[self.name] = {"folders": folders, "days": {f: d for f, d in days.items() if f in folders}, "schema": self.schema or old["schema"], "unique": unique}


class ParquetWarehouse:
    """Tables as Parquet folders under one root, changed together.

    A write stores a new folder ``<table>/version=<id>``. What a table consists of stands in
    the latest of the numbered files in ``_states``: the folders of each table, of a fact's the
    days that count, and its schema. A refresh stores all its folders first and then creates the next
    state, so readers see all of a refresh or nothing, and one that dies leaves the state as it
    was. States are created only if absent. Whoever finds its number taken puts its changes on
    top of the newer state, unless a table it had to rely on has changed (``Conflict``).

    A run replaces the days of a fact that it holds. Its folder has files of the advised size, sorted by day,
    and not a file or more a day, as a day's aggregated rows are few; the files' statistics skip
    the days a reader doesn't want. Of a folder with days that a later run has replaced, the others are read. A table that
    others put there as a plain folder is read as it stands and taken over by the first write.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        read_options: Mapping[str, str] | None = None,
        write_options: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.read_options = dict(read_options or {})
        self.write_options = dict(write_options or {})
        self._seen: tuple[int, dict[str, dict]] = (0, {})
        self._edits: list[Edit] | None = None  # of the refresh that is open
        self._began: tuple[int, dict[str, dict]] = (0, {})

    assigns_keys = False
    versioned = True

    def location(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- states -----------------------------------------------------------

    def state(self) -> tuple[int, dict[str, dict]]:
        """Number and tables of the latest state; 0 and none before the first."""
        found = [n for n in storage.children(self.spark, f"{self.root}/{STATES}") if n.endswith(".json")]
        if not found:
            return 0, {}
        number = int(found[-1].partition(".")[0])
        if number != self._seen[0]:
            self._seen = number, json.loads(storage.read_text(self.spark, f"{self.root}/{STATES}/{found[-1]}"))
        return self._seen

    def _tables(self) -> dict[str, dict]:
        """The tables as this warehouse sees them now: in a refresh, those it began with and its own changes."""
        if self._edits is None:
            return self.state()[1]
        tables = dict(self._began[1])
        for edit in self._edits:
            edit.apply(tables)
        return tables

    @contextmanager
    def refresh(self, rely_on: Sequence[str] = ()) -> Iterator[None]:
        """All writes inside become visible together at the end, or none of them.

        Raises ``Conflict`` if another publisher meanwhile changed a table of ``rely_on``.
        A refresh inside another one is part of it.
        """
        if self._edits is not None:
            yield
            return
        self._began, self._edits = self.state(), []
        try:
            yield
            if self._edits:
                self._commit(rely_on)
        finally:
            self._edits = None

    def _commit(self, rely_on: Sequence[str]) -> None:
        while True:
            number, now = self.state()
            changed = [n for n in rely_on if now.get(n) != self._began[1].get(n)]
            if changed:
                raise Conflict(f"changed by another publisher: {', '.join(changed)}")
            tables = dict(now)
            for edit in self._edits or ():
                edit.apply(tables)
            if storage.create_new(self.spark, f"{self.root}/{STATES}/{number + 1:012d}.json", json.dumps(tables)):
                return

    def _change(self, edit: Edit) -> None:
        with self.refresh():
            if edit.name not in self._tables() and (plain := self._plain(edit.name)):
                self._edits.append(Edit(edit.name, plain))
            self._edits.append(edit)

    def _plain(self, name: str) -> list[str]:
        """What a table consists of that no state knows."""
        return [c for c in storage.children(self.spark, self.location(name)) if not c.startswith(f"{VERSION}=")]

    def vacuum(self) -> int:
        """Remove the folders that the latest state doesn't name (replaced ones and those of refreshes that died); returns how many.

        Not while a publisher or a reader of an older state is at work.
        """
        removed = 0
        for name, table in self.state()[1].items():
            for version in storage.children(self.spark, self.location(name)):
                if version.startswith(f"{VERSION}=") and version not in table["folders"]:
                    storage.remove(self.spark, f"{self.location(name)}/{version}")
                    removed += 1
        return removed

    # -- tables -----------------------------------------------------------

    def exists(self, name: str) -> bool:
        return name in self._tables() or bool(self._plain(name))

    def unique(self, name: str) -> bool:
        """Whether all merges into the table kept one row a folded value."""
        return bool(self._tables().get(name, {}).get("unique"))

    def read(self, name: str, schema: T.StructType | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
        """Read a table as its state says; with ``schema`` a missing table reads as empty."""
        table = self._tables().get(name)
        reader = self.spark.read.options(**_merged(self.read_options, options))
        if table is None:
            if schema is not None and not self.exists(name):
                return self.spark.createDataFrame([], schema)
            return (reader.schema(schema) if schema is not None else reader).parquet(self.location(name))
        if schema is None and table["schema"]:
            schema = T.StructType.fromJson(json.loads(table["schema"]))
        if not table["folders"] and schema is not None:
            return self.spark.createDataFrame([], schema)
        if schema is not None:
            reader = reader.schema(schema)
        reader = reader.option("basePath", self.location(name))
        cut = [f for f in table["folders"] if table["days"].get(f, {}).get("cut")]
        own = [f for f in table["folders"] if f.startswith(f"{VERSION}=") and f not in cut]
        plain = [f for f in table["folders"] if not f.startswith(f"{VERSION}=")]  # taken over; has no version folders to infer
        found = [reader.parquet(*[f"{self.location(name)}/{f}" for f in part]).drop(VERSION) for part in (own, plain) if part]
        for f in cut:
            found.append(reader.parquet(f"{self.location(name)}/{f}").drop(VERSION).where(F.col(FACT_PARTITION).isin(table["days"][f]["live"])))
        names = schema.names if schema is not None else found[0].columns
        return functools.reduce(lambda a, b: a.unionByName(b), [f.select(*names) for f in found])

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "append",
        options: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),
        unique: bool | None = None,
    ) -> None:
        """Append to a table or overwrite it; ``unique`` notes whether it has one row a folded value."""
        folder = self._store(df, name, options, partition_by)
        self._change(Edit(name, [folder], whole=mode == "overwrite", schema=df.schema.json(), unique=unique))

    def _store(self, df: DataFrame, name: str, options: Mapping[str, str] | None, partition_by: Sequence[str] = ()) -> str:
        version = f"{VERSION}={uuid.uuid4().hex}"
        writer = df.write.options(**_merged(self.write_options, options))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.location(name)}/{version}")
        return version

    def write_fact(self, df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> dict[int, int]:
        """Replace the days of ``df``, keep the others; returns the rows of each day written, counted from the stored files."""
        folder = self._store(_clustered(df).sortWithinPartitions(FACT_PARTITION), name, options)
        stored = self.spark.read.schema(df.schema).parquet(f"{self.location(name)}/{folder}")
        rows = {r[FACT_PARTITION]: r["count"] for r in stored.groupBy(FACT_PARTITION).count().collect()}  # calendar days
        self._change(Edit(name, [folder] if rows else [], sorted(rows), gone=set(rows), schema=df.schema.json()))
        return rows

    def clear_days(self, name: str, keys: Sequence[int]) -> list[int]:
        """Take out days that a refresh covered and left without rows."""
        table = self._tables().get(name) or {"folders": self._plain(name), "days": {}}
        held = {d for v in table["days"].values() for d in v["live"]}
        held |= {int(f.rpartition("=")[2]) for f in table["folders"] if f.startswith(f"{FACT_PARTITION}=")}
        gone = [k for k in keys if k in held]
        if gone:
            self._change(Edit(name, gone=set(gone)))
        return gone


class _Direct:
    """Stores whose writes are visible one by one."""

    versioned = False

    @contextmanager
    def refresh(self, rely_on: Sequence[str] = ()) -> Iterator[None]:  # noqa: ARG002 - nothing is held back
        yield

    def unique(self, name: str) -> bool:  # noqa: ARG002 - not known
        return False


class JdbcWarehouse(_Direct):
    """Tables in a database reached over JDBC.

    ``properties`` are connection properties (user, password, driver class).
    For large tables pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` as read options so the read runs in parallel; filters on
    the result are pushed into the database by Spark.
    """

    def __init__(
        self,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str] | None = None,
        read_options: Mapping[str, str] | None = None,
        write_options: Mapping[str, str] | None = None,
        assigns_keys: bool = False,
        tables: str = "information_schema.tables",
    ) -> None:
        self.spark = spark
        self.url = url
        self.assigns_keys = assigns_keys
        self.tables = tables
        self.properties = dict(properties or {})
        self.read_options = dict(read_options or {})
        self.write_options = dict(write_options or {})

    def exists(self, name: str) -> bool:
        """Whether the database's catalogue lists the table; connection and login errors raise."""
        schema, _, bare = name.rpartition(".")
        quoted = lambda x: "'" + x.lower().replace("'", "''") + "'"
        where = f"lower(table_name) = {quoted(bare)}"
        if schema:
            where += f" AND lower(table_schema) = {quoted(schema)}"
        query = f"(SELECT table_name FROM {self.tables} WHERE {where}) listed"
        return not self.spark.read.jdbc(self.url, query, properties=dict(self.properties)).isEmpty()

    def read(self, name: str, schema: T.StructType | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
        if schema is not None and not self.exists(name):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.options(**_merged(self.read_options, options))
        return reader.jdbc(self.url, name, properties=dict(self.properties))

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "append",
        options: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),  # noqa: ARG002 - not applicable to JDBC
        unique: bool | None = None,  # noqa: ARG002 - not kept
    ) -> None:
        writer = df.write.mode(mode).options(**_merged(self.write_options, options))
        writer.jdbc(self.url, name, properties=dict(self.properties))

    def write_fact(self, df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> None:
        # The database owns idempotence here: facts are appended.
        self.write(_clustered(df), name, mode="append", options=options)

    def clear_days(self, name: str, keys: Sequence[int]) -> list[int]:  # noqa: ARG002 - appended facts are kept
        return []


class CsvWarehouse(_Direct):
    """Flat tables as CSV folders (``<root>/<table>``), header on."""

    assigns_keys = False

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        read_options: Mapping[str, str] | None = None,
        write_options: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.read_options = _merged({"header": "true"}, read_options)
        self.write_options = _merged({"header": "true"}, write_options)

    def location(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return bool(storage.children(self.spark, self.location(name)))

    def read(self, name: str, schema: T.StructType | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
        reader = self.spark.read.options(**_merged(self.read_options, options))
        if schema is not None:
            if not self.exists(name):
                return self.spark.createDataFrame([], schema)
            reader = reader.schema(schema)
        return reader.csv(self.location(name))

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "append",
        options: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),
        unique: bool | None = None,  # noqa: ARG002 - not kept
    ) -> None:
        writer = df.write.mode(mode).options(**_merged(self.write_options, options))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.csv(self.location(name))

    def write_fact(self, df: DataFrame, name: str, options: Mapping[str, str] | None = None) -> None:
        """Replaces the days of ``df`` and keeps the others, like the Parquet form."""
        opts = _merged({"partitionOverwriteMode": "dynamic"}, options)
        self.write(_clustered(df), name, mode="overwrite", options=opts, partition_by=(FACT_PARTITION,))

    def clear_days(self, name: str, keys: Sequence[int]) -> list[int]:
        held = set(storage.children(self.spark, self.location(name)))
        gone = [k for k in keys if f"{FACT_PARTITION}={k}" in held]
        for k in gone:
            storage.remove(self.spark, f"{self.location(name)}/{FACT_PARTITION}={k}")
        return gone
