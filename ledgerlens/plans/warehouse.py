"""SNK-1/2/4/6, EXT-3, EXT-17: tables, runs and their publication.

A table is a folder of immutable versions. Every write is a new folder
``version=<id>`` (split by date for dated entities) and a new state file that names the
folders that make the table. A *manifest*, numbered, names the state of every table and the
run, code version and date that made it; the greatest one is what readers see. A manifest
is created under a number that does not exist yet, so of two writers one comes second: it
starts again from the newer manifest, or gets a :class:`Conflict` if both changed one
table. Nothing is lost without a word, and an aborted job leaves no trace in any manifest.

``Warehouse.run`` opens a run: everything it writes is staged, seen by itself alone, and
published by one manifest (write, audit, publish) or abandoned. ``at`` gives the tables as
one run published them, so figures of an earlier run come back whole and a reader never
sees parts of two runs.

A keyed upsert writes the incoming rows plus the existing rows of the touched dates whose
key is not incoming (``left_anti``); a row missing from a rerun survives (ledger Q1) unless
``snapshot`` is asked for. The touched dates are the incoming ones, and only their folders
are read: the incoming rows are computed and dealt out once, into the new folder, and what
survives is then found against the files of that folder and added to it. Append-only tables
(events) get a folder with the keys not yet present; split by month, only the months that
arrive are looked through.

Tables of one row or few per arrangement are written in buckets of ``arrangement_key``,
allocations in buckets of both their keys (:data:`BUCKETED`);
:meth:`Warehouse.read_dated` reads a date so that Spark knows them, and joins of such tables
need no exchange, nor does an upsert for the rows that are there. Surrogate keys cross an
exchange as bytes, half as long as their text.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import packed_key, unpacked_key
from ledgerlens.plans.mapping import Mapping, lineage_frame
from ledgerlens.schemas import LINEAGE_KEY, LINEAGE_SCHEMA, LOAD_LOG_KEY, LOAD_LOG_SCHEMA


def keyed_upsert(existing: DataFrame | None, incoming: DataFrame,
                 keys: list[str] | tuple[str, ...]) -> DataFrame:
    """SNK-1 as a pure DataFrame operator: incoming wins on equal keys.

    ``incoming`` must be unique on ``keys`` (checked by CHK-2); nothing is
    deleted. Null key parts never match, as in SQL.
    """
    if existing is None:
        return incoming
    keep = existing.join(incoming.select(*keys), on=list(keys), how="left_anti")
    return incoming.unionByName(keep.select(*incoming.columns))


#: Tables whose rows never change once written (events).
APPEND_ONLY = ("canon.trade_event",)


def dedupe_on_keys(df: DataFrame, keys: list[str], order_cols: list[str],
                   keep: str = "last") -> DataFrame:
    """Deterministic de-duplication: one row per key, the greatest (``keep="last"``)
    or smallest (``"first"``) by ``order_cols``, remaining columns breaking ties.

    An aggregate of a struct rather than a window: it is combined partially
    before the shuffle, so a key holding a large share of the rows is never
    sorted whole in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    if not rest and not order_cols:
        return df.distinct()
    row = F.struct(*[F.col(c) for c in order_cols + rest])
    pick = F.max(row) if keep == "last" else F.min(row)
    return (df.groupBy(*keys).agg(pick.alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in order_cols + rest])
            .select(*df.columns))


def keys_packed(df: DataFrame, cols: list[str] | tuple[str, ...] | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with its surrogate keys (those among ``cols``) as bytes, and which these are."""
    names = [f.name for f in df.schema.fields if f.name.endswith("_key") and f.dataType == T.StringType()
             and (cols is None or f.name in cols)]
    return df.withColumns({c: packed_key(c) for c in names}), names


def unique_on_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """:func:`dedupe_on_keys` of whole rows, with the keys exchanged as bytes."""
    packed, names = keys_packed(df, keys)
    return dedupe_on_keys(packed, list(keys), []).withColumns({c: unpacked_key(c) for c in names})


#: Tables in buckets of key columns, of which a date holds few rows for their values each.
BUCKETED = {f"canon.{t}": ("arrangement_key",) for t in (
    "arrangement", "position", "arrangement_party_role", "classification")} | {
    "canon.collateral_allocation": ("collateral_key", "arrangement_key"), "stg.inception_dates": ("arrangement_key",)}

#: What Spark calls the folder of the rows without a date.
UNDATED = "__HIVE_DEFAULT_PARTITION__"

#: Keys are text without repetition: zstd keeps them in half the space that snappy needs.
CODEC = "zstd"

#: Hidden column by which append-only tables are split, and the expression it holds.
MONTHLY = {"canon.trade_event": "date_format(economic_event_date, 'yyyy-MM')"}


class Conflict(RuntimeError):
    """Another writer has published the same table since this one read it."""


class Warehouse:
    """Parquet tables under ``root``: ``<root>/<namespace>/<table>``.

    The object itself sees the newest manifest and publishes each write at once;
    :meth:`run` and :meth:`at` give views of the same root.
    """

    _creating = threading.Lock()  # local file systems rename in two steps

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.run_id: str | None = None
        self.code_version: str | None = None
        self.as_of_date: str | None = None
        self._pinned: dict | None = None            # the manifest a view stands on
        self._staged: dict[str, str] | None = None  # table -> state file, of an open run

    def path(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    # ------------------------------------------------------------- small files
    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _put(self, path: str, text: str) -> None:
        """Write a small file under a name of its own."""
        fs, p = self._hadoop(path)
        out = fs.create(p, False)
        out.write(bytearray(text, "utf-8"))
        out.close()

    def _create(self, path: str, text: str) -> bool:
        """Write a small file whole, or not at all if there is one; says which."""
        aside = f"{path}-{uuid.uuid4().hex}"
        self._put(aside, text)
        fs, p = self._hadoop(aside)
        with Warehouse._creating:
            _, target = self._hadoop(path)
            if not fs.exists(target) and fs.rename(p, target):
                return True
        fs.delete(p, False)
        return False

    def _get(self, path: str) -> str:
        fs, p = self._hadoop(path)
        stream = fs.open(p)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    # ------------------------------------------------------------- manifests
    def _numbers(self) -> list[int]:
        fs, p = self._hadoop(f"{self.root}/_manifests")
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def _manifest(self, n: int) -> dict:
        return json.loads(self._get(f"{self.root}/_manifests/{n:010d}"))

    def _newest(self) -> dict:
        numbers = self._numbers()
        return self._manifest(numbers[-1]) if numbers else {"number": 0, "tables": {}}

    def _commit(self, changed: dict[str, str], base: dict) -> int:
        """Publish the states ``changed``, which were built on the manifest ``base``."""
        while True:
            newest = self._newest()
            for table in changed:
                if newest["tables"].get(table) != base["tables"].get(table):
                    raise Conflict(f"{table} was published by run {newest.get('run_id')} meanwhile")
            n = newest["number"] + 1
            manifest = {"number": n, "run_id": self.run_id or f"write-{n}", "code_version": self.code_version,
                        "as_of_date": self.as_of_date, "changed": sorted(changed), "tables": newest["tables"] | changed}
            if self._create(f"{self.root}/_manifests/{n:010d}", json.dumps(manifest)):
                return n

    # ------------------------------------------------------------- runs
    def _view(self, pinned: dict) -> "Warehouse":
        view = Warehouse(self.spark, self.root, self.buckets)
        view._pinned = pinned
        return view

    def run(self, run_id: str, code_version: str, as_of_date: str | None = None) -> "Warehouse":
        """Open a run on the newest manifest: what it writes is staged until
        :meth:`publish`; reads see its own writes, else that manifest."""
        if any(r["run_id"] == run_id for r in self.runs()):
            raise ValueError(f"run {run_id} is published; a run is never published again")
        view = self._view(self._newest())
        view.run_id, view.code_version, view.as_of_date, view._staged = run_id, code_version, as_of_date, {}
        return view

    def publish(self, only: list[str] | None = None) -> int:
        """Publish the run's tables (or ``only`` some, abandoning the rest) by one manifest."""
        if self._staged is None:
            raise ValueError("no open run")
        self.abandon([t for t in self._staged if only is not None and t not in only])
        n = self._commit(self._staged, self._pinned)
        self._pinned, self._staged = self._manifest(n), None
        return n

    def abandon(self, tables: list[str] | None = None) -> None:
        """Delete what the run has staged (for some tables)."""
        for table in list(self._staged) if tables is None else tables:
            before = {s[0] for s in self._segments(self._pinned["tables"].get(table), table)}
            for version in {s[0] for s in self._segments(self._staged.pop(table), table)} - before:
                fs, p = self._hadoop(f"{self.path(table)}/version={version}")
                fs.delete(p, True)

    def at(self, run_id: str | None = None) -> "Warehouse":
        """The tables as ``run_id`` published them (None: the newest run), for reading."""
        for n in reversed(self._numbers()):
            found = self._manifest(n)
            if run_id is None or found["run_id"] == run_id:
                return self._view(found)
        raise KeyError(f"no published run {run_id}")

    def runs(self) -> list[dict]:
        """Every publication, oldest first: number, run, code version, date, tables changed."""
        return [{k: m.get(k) for k in ("number", "run_id", "code_version", "as_of_date", "changed")}
                for m in map(self._manifest, self._numbers())]

    # ------------------------------------------------------------- states
    def _tables(self) -> dict[str, str]:
        seen = self._pinned if self._pinned is not None else self._newest()
        return seen["tables"] | (self._staged or {})

    @property
    def staged(self) -> list[str]:
        """The tables that the open run has written."""
        return sorted(self._staged or ())

    def exists(self, table: str) -> bool:
        return table in self._tables()

    def _state(self, table: str, state: int | None = None) -> dict:
        """The table's state, or an earlier one by its number."""
        found = json.loads(self._get(f"{self.path(table)}/_states/{self._tables()[table]}"))
        while state is not None and found["state"] != state:
            if not found["previous"] or found["state"] < state:
                raise KeyError(f"{table} has no state {state}")
            found = json.loads(self._get(f"{self.path(table)}/_states/{found['previous']}"))
        return found

    def _segments(self, file: str | None, table: str) -> list[list]:
        return json.loads(self._get(f"{self.path(table)}/_states/{file}"))["segments"] if file else []

    def current(self, table: str) -> int:
        """The number of the table's state; 0 before the first."""
        return self._state(table)["state"] if self.exists(table) else 0

    def _publish(self, table: str, schema: T.StructType, partition_col: str | None,
                 segments: list[list], base: dict, bucketed: list | None = None) -> None:
        """``segments``: (version, folder or None, run, code version, bucketing or None) of every
        folder of the table, which was built on the tables of the manifest ``base``."""
        if self._pinned is not None and self._staged is None:
            raise ValueError("this view is for reading")
        was = (self._staged or {}).get(table, base["tables"].get(table))
        before = json.loads(self._get(f"{self.path(table)}/_states/{was}")) if was else {"state": 0}
        published = base["tables"].get(table)
        n = before["state"] + (0 if self._staged and table in self._staged else 1)
        file = uuid.uuid4().hex
        self._put(f"{self.path(table)}/_states/{file}", json.dumps({
            "state": n, "previous": published, "schema": schema.jsonValue(), "partition_col": partition_col,
            "bucketed": bucketed, "segments": segments}))
        if self._staged is not None:
            self._staged[table] = file
        else:
            self._commit({table: file}, base)

    def _base(self) -> dict:
        return self._pinned if self._pinned is not None else self._newest()

    def _retried(self, write) -> None:
        """Run ``write(base)``; outside a run, once more on the newer tables after a conflict."""
        while True:
            base = self._base()
            try:
                return write(base)
            except Conflict:
                if self._staged is not None:
                    raise

    def _read(self, table: str, schema: T.StructType, segments: list[list]) -> DataFrame:
        base = self.path(table)
        paths = [f"{base}/version={s[0]}" + (f"/{s[1]}" if s[1] else "") for s in segments]
        if not paths:
            return self.spark.createDataFrame([], schema)
        hidden = [T.StructField("version", T.StringType()), T.StructField("_month", T.StringType())]
        stored = T.StructType([*schema.fields, *hidden])
        return self.spark.read.option("basePath", base).schema(stored).parquet(*paths).select(*schema.names)

    def read(self, table: str, state: int | None = None, stamped: bool = False) -> DataFrame:
        """The table, or an earlier state of it. ``stamped``: with the columns ``run_id`` and
        ``code_version`` of the run that wrote each row's folder."""
        found = self._state(table, state)
        schema = T.StructType.fromJson(found["schema"])
        if not stamped:
            return self._read(table, schema, found["segments"])
        by_run: dict[tuple, list] = {}
        for s in found["segments"]:
            by_run.setdefault((s[2], s[3]), []).append(s)
        parts = [self._read(table, schema, segments).withColumns({"run_id": F.lit(r), "code_version": F.lit(c)})
                 for (r, c), segments in (by_run or {(None, None): []}).items()]
        return reduce(DataFrame.unionByName, parts).withColumns(
            {c: F.col(c).cast("string") for c in ("run_id", "code_version")})

    def written(self, table: str) -> DataFrame:
        """What the open run has written of ``table``: the folders no earlier run has."""
        found = self._state(table)
        before = {tuple(s[:2]) for s in self._segments(self._pinned["tables"].get(table), table)}
        return self._read(table, T.StructType.fromJson(found["schema"]),
                          [s for s in found["segments"] if tuple(s[:2]) not in before])

    def unshared(self, table: str, other: "Warehouse") -> DataFrame:
        """The rows in folders of ``table`` that ``other``'s state of it does not have."""
        found = self._state(table)
        theirs = {tuple(s[:2]) for s in other._segments(other._tables().get(table), table)}
        return self._read(table, T.StructType.fromJson(found["schema"]),
                          [s for s in found["segments"] if tuple(s[:2]) not in theirs])

    def read_dated(self, table: str, as_of: str) -> DataFrame:
        """The rows of one date. A date of a bucketed table is read as a bucketed Spark
        table over its folder, so that joins and aggregates on the key need no exchange."""
        found = self._state(table)
        schema, col = T.StructType.fromJson(found["schema"]), found["partition_col"]
        here = [s for s in found["segments"] if col and s[1] == f"{col}={as_of}"]
        if not found["bucketed"] or (col and len(here) != 1) or (not col and len(found["segments"]) != 1):
            df = self.read(table)
            return df.where(F.col(col) == F.lit(as_of).cast("date")) if col else df
        version, part = (here or found["segments"])[0][:2]
        folder = f"{self.path(table)}/version={version}" + (f"/{part}" if part else "")
        key, n = found["bucketed"]
        name = f"ledgerlens_{hashlib.md5(folder.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != col)
        self.spark.sql(f"create table if not exists {name} ({columns}) using parquet clustered by ({key}) "
                       f"sorted by ({key}) into {n} buckets location '{folder}'")
        df = self.spark.table(name)
        if col:
            df = df.withColumn(col, F.lit(as_of).cast(schema[col].dataType))
        return df.select(*schema.names)

    def _dealt(self, table: str, df: DataFrame, among: tuple[str, ...]) -> tuple[DataFrame, bool]:
        """``df`` dealt out by the table's buckets, if its bucket columns are ``among`` these:
        what then groups by them all stays where it is, and is written from there."""
        cols = BUCKETED.get(table, ())
        dealt = bool(cols) and set(cols) <= set(among) & set(df.columns)
        return (self._by_bucket(df, cols) if dealt else df), dealt

    def _by_bucket(self, df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
        """``df`` dealt out by ``cols``, its surrogate keys as bytes on the way."""
        packed, names = keys_packed(df)
        text = {c: unpacked_key(c) for c in names}
        return packed.repartition(self.buckets, *[text.get(c, F.col(c)) for c in cols]).withColumns(text)

    def _write(self, table: str, df: DataFrame, partition_col: str | None,
               dealt: bool = False) -> tuple[list[list], list | None]:
        """Write a new version; its segments, and its bucketing (columns, number) if any.
        ``dealt``: its rows lie by bucket already and are not dealt out again."""
        version = uuid.uuid4().hex
        path = f"{self.path(table)}/version={version}"
        cols = BUCKETED.get(table, ())
        bucketed = [", ".join(cols), self.buckets] if cols and set(cols) <= set(df.columns) else None
        writer = (self._by_bucket(df, cols) if bucketed and not dealt else df).write.option("compression", CODEC)
        if partition_col:
            writer = writer.partitionBy(partition_col)
        if bucketed:  # Spark writes buckets through a table; dropping it leaves the files
            name = f"ledgerlens_{version}"
            writer.bucketBy(self.buckets, *cols).sortBy(*cols).option("path", path).format("parquet").saveAsTable(name)
            self.spark.sql(f"drop table {name}")
        else:
            writer.parquet(path)
        return self._folders(table, version, partition_col, bucketed), bucketed

    def _folders(self, table: str, version: str, partition_col: str | None, bucketed: list | None) -> list[list]:
        """The segments of a version that this view has written."""
        stamp = [self.run_id, self.code_version, bucketed]
        if not partition_col:
            return [[version, None, *stamp]]
        fs, p = self._hadoop(f"{self.path(table)}/version={version}")
        return [[version, st.getPath().getName(), *stamp] for st in fs.listStatus(p) if st.isDirectory()]

    @contextmanager
    def _as_table(self, table: str, schema: T.StructType, segments: list[list], partition_col: str | None):
        """The name of a bucketed Spark table over ``segments``, one a date, while it is in use.
        Folders without a date are no part of it."""
        folder = lambda s: f"{self.path(table)}/version={s[0]}"
        name, (key, n) = f"ledgerlens_{uuid.uuid4().hex}", segments[0][4]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        split = f"partitioned by (`{partition_col}`) " if partition_col else ""
        self.spark.sql(f"create table {name} ({columns}) using parquet options (compression '{CODEC}') {split}clustered by ({key}) "
                       f"sorted by ({key}) into {n} buckets location '{folder(segments[0])}'")
        try:
            dated = [s for s in segments if partition_col and not s[1].endswith(f"={UNDATED}")]
            if dated:
                self.spark.sql(f"alter table {name} add " + " ".join(
                    f"partition (`{partition_col}` = '{s[1].split('=', 1)[1]}') location '{folder(s)}/{s[1]}'" for s in dated))
            yield name
        finally:
            self.spark.sql(f"drop table {name}")

    def _keep(self, table: str, keys: tuple[str, ...], partition_col: str | None, old: list[list], was: T.StructType,
              new: list[list], schema: T.StructType) -> None:
        """Add to the version just written (``new``) the rows of the folders ``old`` whose keys it
        does not have.

        Buckets of one number meet without an exchange: the join is on the bucket columns, whose
        values few rows share, and tells the other keys by a condition."""
        def written(existing: DataFrame, fresh: DataFrame, on: list[str]) -> DataFrame:
            o, n = existing.alias("o"), fresh.select(*keys).alias("n")
            same = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in on] + [
                F.col(f"o.{k}").between(F.col(f"n.{k}"), F.col(f"n.{k}")) for k in keys if k not in on]
            return o.join(n, reduce(lambda x, y: x & y, same), "left_anti").select(
                *[F.col(f.name).cast(f.dataType) for f in schema.fields])

        bucketed, folders = new[0][4], [s[1] for s in old]
        if not bucketed:
            kept = written(self._read(table, was, old), self._read(table, schema, new), list(keys))
            writer = kept.write.mode("append").option("compression", CODEC)
            (writer.partitionBy(partition_col) if partition_col else writer).parquet(f"{self.path(table)}/version={new[0][0]}")
            return
        cols = bucketed[0].split(", ")
        with self._as_table(table, schema, new, partition_col) as fresh:
            put = lambda df: df.select(*self.spark.table(fresh).columns).write.insertInto(fresh)
            if (set(cols) <= set(keys) and (not partition_col or partition_col in keys and schema[partition_col].dataType == T.DateType())
                    and len(folders) == len(set(folders)) and all(s[4:5] == [bucketed] for s in old)):
                with self._as_table(table, was, old, partition_col) as stored:
                    put(written(self.spark.table(stored), self.spark.table(fresh), cols))
            else:
                put(written(self._read(table, was, old), self._read(table, schema, new), list(keys)))

    # ------------------------------------------------------------- writes
    def replace(self, table: str, df: DataFrame) -> None:
        """SNK-2: create or replace the whole table."""
        def write(base: dict) -> None:
            segments, bucketed = self._write(table, df, None)
            self._publish(table, df.schema, None, segments, base, bucketed)
        self._retried(write)

    def upsert(self, table: str, incoming: DataFrame, keys: tuple[str, ...],
               partition_col: str | None = "as_of_date", snapshot: bool = False) -> None:
        """SNK-1: keyed upsert; only the partitions present in ``incoming`` are read and written.

        Of incoming rows with one key the greatest, column by column, is taken. With
        ``snapshot`` the incoming dates (or the table) are replaced: rows missing go.
        """
        def write(base: dict) -> None:
            df, dealt = self._dealt(table, incoming, keys)  # one exchange serves the keys and the buckets
            unique = dedupe_on_keys(df, list(keys), []) if dealt else unique_on_keys(df, keys)
            new, bucketed = self._write(table, unique, partition_col, dealt)
            kept: list[list] = []
            if self.exists(table):
                found = self._state(table)
                touched = found["segments"]
                if partition_col:  # the folders of the incoming dates
                    dates = {s[1] for s in new}
                    if partition_col in keys and not snapshot:  # rows without a date match none
                        dates.discard(f"{partition_col}={UNDATED}")
                    kept = [s for s in touched if s[1] not in dates]
                    touched = [s for s in touched if s[1] in dates]
                if touched and not snapshot:
                    self._keep(table, keys, partition_col, touched, T.StructType.fromJson(found["schema"]), new, incoming.schema)
            if not new and kept and not bucketed:
                bucketed = self._state(table)["bucketed"]
            self._publish(table, incoming.schema, partition_col, new + kept, base, bucketed)
        self._retried(write)

    def append(self, table: str, incoming: DataFrame, keys: tuple[str, ...], month: str | None = None) -> None:
        """Add the rows of an append-only table whose keys it does not have yet.

        ``month`` (by default :data:`MONTHLY`) is an expression that never changes for a
        key: the table is split by it, and only the months that arrive are searched."""
        month = month or MONTHLY.get(table)
        dated = incoming.withColumn("_month", F.coalesce(F.expr(month), F.lit("none"))) if month else incoming
        packed, names = keys_packed(dated, keys)
        unique = dedupe_on_keys(packed, list(keys), [])
        part = "_month" if month else None

        def write(base: dict) -> None:
            kept: list[list] = []
            fresh, held = unique, False
            if self.exists(table):
                found = self._state(table)
                kept = searched = found["segments"]
                if month:
                    held = bool(unique.persist())
                    months = {f"_month={r[0]}" for r in unique.select("_month").distinct().collect()}
                    searched = [s for s in kept if s[1] in months or not s[1]]
                if searched:
                    stored, _ = keys_packed(self._read(table, T.StructType.fromJson(found["schema"]), searched).select(*keys), keys)
                    fresh = unique.join(stored, list(keys), "left_anti").select(*unique.columns)
            try:
                new, _ = self._write(table, fresh.withColumns({c: unpacked_key(c) for c in names}), part)
            finally:
                if held:
                    unique.unpersist()
            self._publish(table, incoming.schema, None, kept + new, base)
        self._retried(write)

    def compact(self, table: str, most: int = 64) -> None:
        """Rewrite an append-only table whose state names more than ``most`` folders of one
        month (or at all), month by month, so that states stay short."""
        def write(base: dict) -> None:
            found = self._state(table)
            groups: dict[str | None, list] = {}
            for s in found["segments"]:
                groups.setdefault(s[1], []).append(s)
            schema, segments = T.StructType.fromJson(found["schema"]), []
            for part, group in groups.items():
                if len(group) > most:
                    df = self._read(table, schema, group)
                    if part:
                        df = df.withColumn("_month", F.lit(part.split("=", 1)[1]))
                    group = self._write(table, df, "_month" if part else None)[0]
                segments += group
            if segments != found["segments"]:
                self._publish(table, schema, found["partition_col"], segments, base, found["bucketed"])
        self._retried(write)

    def fold(self, table: str, keys: tuple[str, ...], by: str, below: int, most: int = 64) -> None:
        """Where a table split by the number ``by`` has more than ``most`` folders under
        ``below``, make them one: of each key the row with the greatest number, filed under
        the greatest of them. Folders from ``below`` on are not touched."""
        def write(base: dict) -> None:
            found = self._state(table)
            number = {s[1]: int(s[1].split("=", 1)[1]) for s in found["segments"]}
            old = [s for s in found["segments"] if number[s[1]] < below]
            if len(old) <= most:
                return
            schema = T.StructType.fromJson(found["schema"])
            df = dedupe_on_keys(self._read(table, schema, old), list(keys), [by]).withColumn(
                by, F.lit(max(number[s[1]] for s in old)).cast(schema[by].dataType))
            kept = [s for s in found["segments"] if number[s[1]] >= below]
            self._publish(table, schema, by, self._write(table, df, by)[0] + kept, base)
        if self.exists(table):
            self._retried(write)

    def forget(self, table: str, states: int = 2) -> None:
        """Delete the versions that only states before the last ``states`` use. Runs before
        can then no longer be read for this table."""
        found, used, files, n = self._state(table), set(), [], states
        while True:
            if n > 0:
                used |= {s[0] for s in found["segments"]}
            else:
                files.append(found["segments"])
            n -= 1
            if not found["previous"]:
                break
            fs, p = self._hadoop(f"{self.path(table)}/_states/{found['previous']}")
            if not fs.exists(p):
                break
            if n <= 0:
                name = found["previous"]
                found = json.loads(self._get(f"{self.path(table)}/_states/{name}"))
                fs.delete(p, False)
            else:
                found = json.loads(self._get(f"{self.path(table)}/_states/{found['previous']}"))
        for version in {s[0] for segments in files for s in segments} - used:
            fs, p = self._hadoop(f"{self.path(table)}/version={version}")
            fs.delete(p, True)

    def write_mappings(self, parts: list[tuple[Mapping, DataFrame]],
                       keys: tuple[str, ...] | None = None,
                       partition_col: str | None = None) -> dict[str, int]:
        """Write one target from one or more mappings in a single job.

        With ``keys`` the target is upserted (SNK-1), otherwise replaced
        (SNK-2). Rows per mapping (ledger Q2: rows this mapping wrote, not the
        table size) are counted by an observation on the same job.
        """
        from pyspark.sql import Observation
        target = parts[0][0].target
        tagged = None
        for i, (m, df) in enumerate(parts):
            t = df.withColumn("_part", F.lit(i))
            tagged = t if tagged is None else tagged.unionByName(t)
        obs = Observation(f"rows_{uuid.uuid4().hex[:12]}")
        observed = tagged.observe(obs, *[F.count_if(F.col("_part") == i).alias(f"p{i}")
                                         for i in range(len(parts))]).drop("_part")
        if keys:
            self._merge(target, observed, keys, partition_col)
        else:
            self.replace(target, observed)
        got = obs.get
        return {f"{m.rule_id} {target}": int(got[f"p{i}"]) for i, (m, _) in enumerate(parts)}

    def _merge(self, target: str, df: DataFrame, keys: tuple[str, ...], partition_col: str | None) -> None:
        if target in APPEND_ONLY:
            self.append(target, df, keys)
        else:
            self.upsert(target, df, keys, partition_col=partition_col)

    def quarantine(self, table: str, good: DataFrame, held: DataFrame, keys: tuple[str, ...]) -> None:
        """In a run: the rows of ``table`` that this run wrote become ``good``; ``held`` are
        the rows taken out, kept in ``quar.<table>`` by their keys and dates. Both are read from
        the files that hold them by bucket."""
        found = self._state(table)
        before = {tuple(s[:2]) for s in self._segments(self._pinned["tables"].get(table), table)}
        kept = [s for s in found["segments"] if tuple(s[:2]) in before]
        col = found["partition_col"]
        self.upsert(f"quar.{table.split('.', 1)[1]}", held, keys, partition_col=col, snapshot=True)
        new, bucketed = self._write(table, good, col, dealt=True)
        self._publish(table, T.StructType.fromJson(found["schema"]), col, new + kept, self._pinned, bucketed)

    def record(self, mappings: list[Mapping], counts: dict[str, int], as_of_date: str) -> None:
        """SNK-4 + SNK-5: lineage of the mappings and one load-log row each."""
        self.upsert("meta.lineage", lineage_frame(self.spark, mappings), LINEAGE_KEY,
                    partition_col=None)
        rows = [(m.rule_id, m.target, None, counts.get(f"{m.rule_id} {m.target}"))
                for m in mappings]
        log = self.spark.createDataFrame(rows, LOAD_LOG_SCHEMA) \
            .withColumn("as_of_date", F.lit(as_of_date).cast("date"))
        self.upsert("meta.load_log", log, LOAD_LOG_KEY, partition_col=None)

    def apply(self, mapping: Mapping, data: DataFrame, keys: tuple[str, ...] | None,
              as_of_date: str | None, mode: str = "insert",
              partition_col: str | None = "as_of_date") -> int:
        """MAP-3 for one mapping: write its data, then its lineage and load-log row."""
        got = self.write_mappings([(mapping, data)], keys if mode != "replace" else None,
                                  partition_col=partition_col)
        self.record([mapping], got, as_of_date)
        return next(iter(got.values()))

    def tables(self, namespace: str) -> list[str]:
        """Published tables of a namespace (SRC-3 over a built warehouse)."""
        return sorted(t.split(".", 1)[1] for t in self._tables() if t.startswith(f"{namespace}."))

    def catalog(self) -> DataFrame:
        """Catalog DataFrame of the canonical and reporting layers, from the
        written tables' schemas (footers only, no data scanned)."""
        from ledgerlens.sources.catalog import catalog_from_schemas
        layers = {"CANONICAL": "canon", "REPORTING": "rpt"}
        return catalog_from_schemas(self.spark, {
            layer: {t: self.read(f"{ns}.{t}").schema for t in self.tables(ns)}
            for layer, ns in layers.items()})

    def lineage(self) -> DataFrame:
        if not self.exists("meta.lineage"):
            return self.spark.createDataFrame([], LINEAGE_SCHEMA)
        return self.read("meta.lineage")

    def load_log(self) -> DataFrame:
        if not self.exists("meta.load_log"):
            return self.spark.createDataFrame([], LOAD_LOG_SCHEMA)
        return self.read("meta.load_log")


def write_findings_json(findings: DataFrame, path: str) -> None:
    """SNK-6: findings as JSON lines."""
    findings.write.mode("overwrite").json(path)
