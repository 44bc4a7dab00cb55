"""Warehouse state as versioned Parquet tables.

Parquet tables cannot be changed in place, so a load writes new files and then one
commit that lists, for every table, the folders that now make it up. Each try of a load has
folders of its own and commits are numbered, so a load that fails before its commit leaves
nothing visible and can be run again with the same load time.

Large tables are kept in parts: facts by ranges of their key, satellites by the load that
wrote a row. A load reads and rewrites the parts that its delta can change and lists the
others again. Append-only tables (hubs, links, key registries, the journal) get one more
folder with the new rows.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions.dates import timestamp
from siltstone.plans.common import State
from siltstone.schemas import columns, reset

_PART = "_part"
_COMMIT = "load_ts timestamp_ntz, table_name string, part bigint, folder string, width bigint"
KEYS_PER_RANGE = 50_000_000

# Which tables are kept in parts, and by which column: a key in ranges, or a load date.
PARTED = {
    "core.fact_payment": "payment_id", "core.fact_rental": "rental_id",
    "ods.payment": "payment_id", "ods.rental": "rental_id",
    "integ.payment": "payment_id", "integ.rental": "rental_id",
    "dds.fact_payment": "payment_id", "dds.fact_rental": "rental_id",
    **{f"edw.sat_{n}": "load_date" for n in ("film_static", "film_dynamic", "film_inventory", "inventory", "rental_inventory",
                                             "rental_static", "rental_dynamic")},
}


class WarehouseStore:
    """`state()` gives the tables of the last commit; `load()` starts a load on top of it.

    keys_per_range holds for tables that are written for the first time; the commits remember
    it, and another one is refused for a table that has one.
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str], keys_per_range: int | None = None,
                 parted: dict[str, str] | None = None):
        self.spark, self.root, self.tables, self.keys_per_range = spark, root.rstrip("/"), tables, keys_per_range
        self.parted = {t: k for t, k in (PARTED if parted is None else parted).items() if t in tables}

    def _files(self, path: str):
        context = self.spark.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(context._jsc.hadoopConfiguration())

    def folders(self, path: str) -> list[str]:
        """Names of the folders below a path; none if there is no such path."""
        where, files = self._files(path)
        return [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()] if files.exists(where) else []

    def commit_numbers(self) -> list[int]:
        """The numbers of all tries of a commit, newest first."""
        return sorted(map(int, self.folders(f"{self.root}/_commits")), reverse=True)

    def newest(self) -> list:
        """The rows of the newest whole commit: one per folder, so they are few next to the data."""
        for number in self.commit_numbers():
            path = f"{self.root}/_commits/{number:012d}"
            where, files = self._files(f"{path}/_SUCCESS")
            if files.exists(where):
                return self.spark.read.schema(_COMMIT).parquet(path).collect()
        return []

    def last_commit(self) -> dict[str, dict[int | None, str]]:
        """Table → part → folder."""
        parts: dict[str, dict[int | None, str]] = {}
        for row in self.newest():
            parts.setdefault(row.table_name, {})[row.part] = row.folder
        return parts

    def moment(self, load_ts: str) -> datetime.datetime:
        """A load time as a value, whatever way it is written."""
        return self.spark.range(1).select(timestamp(load_ts)).first()[0]

    def is_loaded(self, load_ts: str) -> bool:
        """Whether a load with this or a later time is committed."""
        rows = self.newest()
        return bool(rows) and self.moment(load_ts) <= rows[0].load_ts

    def clean(self) -> int:
        """Delete what the newest commit doesn't list: failed tries and replaced versions. Not while a load or a
        reader of an older state runs. Returns the number of folders that went."""
        listed = {f.split("/_part=")[0] for parts in self.last_commit().values() for f in parts.values()}
        gone = 0
        for table in self.tables:
            for name in self.folders(f"{self.root}/{table.replace('.', '/')}"):
                folder = f"{table.replace('.', '/')}/{name}"
                if folder not in listed:
                    where, files = self._files(f"{self.root}/{folder}")
                    gone += bool(files.delete(where, True))
        return gone

    def read(self, table: str, folders: list[str]) -> DataFrame:
        schema = StructType.fromDDL(", ".join(f"{c} {t}" for c, t in columns(self.tables, table).items()))
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def state(self) -> State:
        parts = self.last_commit()
        state = reset(self.spark, self.tables, tables=[t for t in self.tables if not parts.get(t)])
        return state | {t: self.read(t, list(p.values())) for t, p in parts.items() if p}

    def load(self, load_ts: str) -> Load:
        return Load(self, load_ts)


class Load:
    """A `save` for the pipelines. Call `commit` when the load is complete."""

    def __init__(self, store: WarehouseStore, load_ts: str):
        if store.is_loaded(load_ts):
            raise ValueError(f"load time {load_ts} is not after the last load")
        self.store, self.load_ts = store, load_ts
        newest = store.newest()
        self.parts: dict[str, dict[int | None, str]] = {}
        for row in newest:
            self.parts.setdefault(row.table_name, {})[row.part] = row.folder
        self.widths = {row.table_name: row.width for row in newest if row.width}
        for table, width in self.widths.items():
            if store.keys_per_range not in (None, width):
                raise ValueError(f"{table} is kept in ranges of {width} keys, not {store.keys_per_range}")
        self.number = max([0, *store.commit_numbers()]) + 1
        self.attempt = f"{self.number}-{uuid.uuid4().hex[:12]}"
        self._touched: dict[str, set[int]] = {}

    def _ranged(self, table: str) -> bool:
        return table in self.store.parted and columns(self.store.tables, table)[self.store.parted[table]] != "timestamp_ntz"

    def _part_of(self, table: str) -> Column:
        """The number of the part a row belongs to: a range of keys, or the microsecond of the load that wrote it."""
        column = self.store.parted[table]
        if not self._ranged(table):
            return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', {column})")
        width = self.widths.setdefault(table, self.store.keys_per_range or KEYS_PER_RANGE)
        return F.floor(F.col(column) / width).cast("bigint")

    def _read(self, table: str, folders: list[str]) -> DataFrame:
        if folders:
            return self.store.read(table, folders)
        return reset(self.store.spark, self.store.tables, tables=[table])[table]

    def narrow(self, target: DataFrame, table: str, delta: DataFrame) -> DataFrame:
        """The parts of a target that a delta can change. The next save of the table replaces
        just these. At most one value per part passes the driver."""
        if table not in self.store.parted:
            return target
        touched = {r[0] for r in delta.select(self._part_of(table)).distinct().collect()}
        self._touched[table] = touched
        return self._read(table, [f for p, f in self.parts.get(table, {}).items() if p in touched])

    def _folder(self, table: str) -> str:
        if table not in self.store.tables:
            raise KeyError(f"{table} is not a declared table")
        return f"{table.replace('.', '/')}/{self.attempt}"

    def __call__(self, df: DataFrame, table: str) -> DataFrame:
        folder = self._folder(table)
        path, rows = f"{self.store.root}/{folder}", df.select(*columns(self.store.tables, table))
        if table in self.store.parted:
            rows.withColumn(_PART, self._part_of(table)).hint("rebalance", _PART).write.partitionBy(_PART).parquet(path)
            written = {int(f.split("=")[1]) for f in self.store.folders(path) if f.startswith(f"{_PART}=")}
            touched = self._touched.pop(table, set(self.parts.get(table, {})))
            kept = {p: f for p, f in self.parts.get(table, {}).items() if p not in touched}
            if kept.keys() & written:
                raise ValueError(f"{table}: this load writes parts that it has not read")
            self.parts[table] = kept | {p: f"{folder}/{_PART}={p}" for p in written}
        else:
            rows.write.parquet(path)
            self.parts[table] = {None: folder}
        return self._read(table, list(self.parts[table].values()))

    def append(self, added: DataFrame, table: str) -> DataFrame:
        """An append-only table with one more folder."""
        folder = self._folder(table)
        added.select(*columns(self.store.tables, table)).write.parquet(f"{self.store.root}/{folder}")
        self.parts[table] = self.parts.get(table, {}) | {self.number: folder}
        return self._read(table, list(self.parts[table].values()))

    def commit(self) -> None:
        moment = self.store.moment(self.load_ts)
        rows = [(moment, t, p, f, self.widths.get(t) if self._ranged(t) else None) for t, parts in self.parts.items() for p, f in parts.items()]
        self.store.spark.createDataFrame(rows, _COMMIT).coalesce(1).write.parquet(
            f"{self.store.root}/_commits/{self.number:012d}")
