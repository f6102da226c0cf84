"""Tables of the warehouse: versions in folders of their own, and one log that says which are current.

A table is never written in place. Every write goes to a new folder, `<layer>/<table>/table_version=<version>`, and
becomes visible with the release that names it: one file added to the log `_releases`, in one rename. A
build that dies before leaves the tables as they were; frames of an earlier release keep their files until
`drop_old_versions`.

Tables stored by month consist of the newest folder of each month, so an incremental release writes the
months it touches and no others.

`publish` offers the current tables to SQL as `<layer>.<table>`, in schemas of the session's catalog. A
schema belongs to the first warehouse that publishes into it; another warehouse of the same session gets
schemas marked with its own tag, so neither hides the other.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halala.functions.casts import as_column
from halala.operators.lookup import known_size, measured_write, remember_size
from halala.schemas import DOCUMENT_FEEDS, LEDGER_FEED, RAW_DOCUMENT, RAW_LEDGER
from halala.session import STORED

RAW, STAGING, ANALYTICS = "raw", "staging", "analytics"
DEFAULT_LAYER = "main"

# The ledger and its fact are stored by month, so a late rate rewrites only the months it reaches.
MONTH = "month_key"
# RAW tables hold each load in a folder of its own.
BATCH = "load_batch"

_VERSION = "table_version"
_LOG = "_releases"
# `part` is the month's folder below the version's; empty for the version as a whole, which replaces all before it.
_ENTRY = "release bigint, layer string, name string, version string, part string, columns string, by_month boolean, n_rows bigint, n_bytes bigint"
_NULL_MONTH = f"{MONTH}=__HIVE_DEFAULT_PARTITION__"

# Rows that a task sorts by month before it writes them: some hundred MB.
WRITER_ROWS = 1_000_000


def layer_name(custom: str | None) -> str:
    """A layer keeps exactly the name it is given."""
    return custom.strip() if custom else DEFAULT_LAYER


def month_of(day_key: Column | str) -> Column:
    """YYYYMM of a YYYYMMDD key."""
    return F.floor(as_column(day_key) / 100).cast("int")


def in_partitions(stored: DataFrame, partition: str, wanted: DataFrame) -> DataFrame:
    """Rows of the partitions named in `wanted`, by a filter that prunes the others at planning.

    Only distinct partition values reach the driver, which lists the table's partitions anyway.
    """
    values = [row[partition] for row in wanted.select(partition).distinct().collect()]
    named = F.col(partition).isin([v for v in values if v is not None])
    return stored.where(named | F.col(partition).isNull() if None in values else named)


def month_folder(month: int | None) -> str:
    return _NULL_MONTH if month is None else f"{MONTH}={month}"


def month_of_folder(part: str) -> int | None:
    return None if part == _NULL_MONTH else int(part.split("=")[1])


@dataclass(frozen=True)
class TableState:
    """What a table consists of: its columns, its folders below the table's, and its size."""

    columns: T.StructType
    by_month: bool
    parts: dict[str, str]  # month folder (or "" for the whole table) -> version
    n_rows: int
    n_bytes: int


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer_name(layer)}/{table}"

    # ---- what is current --------------------------------------------------------------------

    def _log(self) -> list:
        """The log's entries, oldest first: a few for each table and release."""
        try:
            log = self.spark.read.schema(_ENTRY).parquet(f"{self.root.rstrip('/')}/{_LOG}")
            return sorted(log.collect(), key=lambda e: (e["release"], e["part"]))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def states(self, log: Iterable | None = None) -> dict[tuple[str, str], TableState]:
        """Current tables by (layer, name), after the entries of the log."""
        found: dict[tuple[str, str], TableState] = {}
        for e in self._log() if log is None else log:
            key = (e["layer"], e["name"])
            before = found.get(key)
            columns = T.StructType.fromJson(json.loads(e["columns"]))
            whole = not e["part"]
            parts = {} if whole or before is None else dict(before.parts)
            if not whole or not e["by_month"]:
                parts[e["part"]] = e["version"]
            n_rows, n_bytes = (e["n_rows"], e["n_bytes"]) if whole or before is None else (before.n_rows + e["n_rows"], before.n_bytes + e["n_bytes"])
            found[key] = TableState(columns, e["by_month"], parts, n_rows, n_bytes)
        return found

    def frame(self, layer: str, table: str, state: TableState, months: list[str] | None = None) -> DataFrame:
        """The rows of a state, or of some of its month folders; other folders are not even listed."""
        base = self.path(layer, table)
        parts = {p: v for p, v in state.parts.items() if months is None or p in months}
        if not parts:
            return remember_size(self.spark.createDataFrame([], state.columns), 0, 0)
        if not state.by_month:
            (version,) = parts.values()
            rows = self.spark.read.schema(state.columns).parquet(f"{base}/{_VERSION}={version}")
        else:
            stored = T.StructType([*state.columns.fields, T.StructField(MONTH, T.IntegerType()), T.StructField(_VERSION, T.StringType())])
            folders = [f"{base}/{_VERSION}={version}/{part}" for part, version in sorted(parts.items())]
            rows = self.spark.read.schema(stored).option("basePath", base).parquet(*folders)
            if months is not None:
                # what the folders say already, so that the plan tells it
                named = [month_of_folder(part) for part in parts]
                of_months = F.col(MONTH).isin([m for m in named if m is not None])
                rows = rows.where(of_months | F.col(MONTH).isNull() if None in named else of_months)
            rows = rows.drop(MONTH, _VERSION)
        # sums of what was written: at least the rows of the state
        return remember_size(rows, state.n_rows, state.n_bytes)

    def read(self, layer: str, table: str) -> DataFrame:
        """The current rows of a table; of RAW tables, which loads append to, all batches."""
        state = self.states().get((layer_name(layer), table))
        if state is None:
            return self.spark.read.parquet(self.path(layer, table)).drop(MONTH, BATCH)
        return self.frame(layer, table, state)

    def read_months(self, layer: str, table: str, months: DataFrame) -> DataFrame:
        """Rows of the given months (one column, MONTH); the other folders are not read."""
        state = self.states()[(layer_name(layer), table)]
        # one row per month reaches the driver, which knows the months anyway
        return self.frame(layer, table, state, [month_folder(r[MONTH]) for r in months.select(MONTH).distinct().collect()])

    # ---- writing ----------------------------------------------------------------------------

    def release(self) -> Release:
        return Release(self)

    def rebuild(self, layer: str, table: str, rows: DataFrame) -> DataFrame:
        """Full rebuild, released at once."""
        with self.release() as release:
            return release.rebuild(layer, table, rows)

    def rebuild_by_month(self, layer: str, table: str, rows: DataFrame, month: Column) -> DataFrame:
        with self.release() as release:
            return release.rebuild_by_month(layer, table, rows, month)

    def folders(self, path: str) -> list[str]:
        """Names of what lies in a folder."""
        jvm = self.spark._jvm
        base = jvm.org.apache.hadoop.fs.Path(path)
        files = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(status.getPath().getName() for status in files.listStatus(base))

    def replace_months(self, layer: str, table: str, rows: DataFrame, month: Column) -> DataFrame:
        """Replace only the months that occur in `rows`, which must hold them whole."""
        with self.release() as release:
            return release.replace_months(layer, table, rows, month)

    def replace_changed_months(self, layer: str, table: str, rows: DataFrame, month: Column) -> list[int]:
        """Replace only the months whose rows differ from the current ones; returns them.

        `rows` is the whole table as it should be, settled, with rows in every stored month.
        """
        with self.release() as release:
            return release.replace_changed_months(layer, table, rows, month)[1]

    def create_if_missing(self, layer: str, table: str, schema: T.StructType) -> None:
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("ignore").parquet(self.path(layer, table))

    def drop_old_versions(self) -> list[str]:
        """Delete folders of past releases and of builds that died; returns them.

        Folders of the current tables, and of a build that is newer than the last release, stay.
        """
        log = self._log()
        last = max((e["release"] for e in log), default=0)
        jvm = self.spark._jvm
        dropped = []
        for (layer, table), state in self.states().items():
            base = jvm.org.apache.hadoop.fs.Path(self.path(layer, table))
            files = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
            held = {f"{_VERSION}={version}" for version in state.parts.values()}
            for status in files.listStatus(base):
                name = status.getPath().getName()
                number = name.removeprefix(f"{_VERSION}=").split("-")[0]
                if name.startswith(f"{_VERSION}=") and name not in held and number.isdigit() and int(number) <= last:
                    files.delete(status.getPath(), True)
                    dropped.append(f"{self.path(layer, table)}/{name}")
        return sorted(dropped)

    # ---- SQL --------------------------------------------------------------------------------

    def schema(self, layer: str) -> str:
        """Name of the catalog schema of a layer: the layer's, or with a tag where another warehouse has it."""
        mark = f"warehouse at {self.root.rstrip('/')}"
        plain = layer_name(layer)
        for name in (plain, f"{plain}_{hashlib.sha256(mark.encode()).hexdigest()[:8]}"):
            if not self.spark.catalog.databaseExists(name):
                self.spark.sql(f"CREATE SCHEMA `{name}` COMMENT '{mark}'")
            if self.spark.catalog.getDatabase(name).description == mark:
                return name
        raise RuntimeError(f"schema {plain} belongs to others")

    def publish(self, layer: str, *tables: str) -> dict[str, str]:
        """Offer current tables to SQL as `<schema>.<table>`; returns the names.

        Each name is a view, replaced in one step, over an external table of the current folders. Where the
        schema has the layer's own name, a temporary view `<layer>_<table>` is made too.
        """
        spark, schema = self.spark, self.schema(layer)
        files = self.schema(f"{layer_name(layer)}_files")
        states, names = self.states(), {}
        for table in tables:
            state = states[(layer_name(layer), table)]
            own = f"`{files}`.`{table}_{uuid.uuid4().hex[:8]}`"
            columns = ", ".join(f"`{c.name}` {c.dataType.simpleString()}" for c in state.columns)
            base = self.path(layer, table)
            if state.by_month:
                spark.sql(f"CREATE TABLE {own} ({columns}, `{MONTH}` int) USING parquet PARTITIONED BY (`{MONTH}`) LOCATION '{base}'")
                places = [
                    f"PARTITION ({MONTH}={'null' if part == _NULL_MONTH else part.split('=')[1]}) LOCATION '{base}/{_VERSION}={version}/{part}'"
                    for part, version in sorted(state.parts.items())
                ]
                if places:
                    spark.sql(f"ALTER TABLE {own} ADD {' '.join(places)}")
            else:
                spark.sql(f"CREATE TABLE {own} ({columns}) USING parquet LOCATION '{base}/{_VERSION}={state.parts['']}'")
            picked = ", ".join(f"`{c.name}`" for c in state.columns)
            spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{table}` AS SELECT {picked} FROM {own}")
            for other in spark.catalog.listTables(files, f"{table}_????????".replace("?", ".")):
                if f"`{files}`.`{other.name}`" != own and other.name[: -len("_00000000")] == table:
                    spark.sql(f"DROP TABLE `{files}`.`{other.name}`")  # external: the folders stay
            if schema == layer_name(layer):
                spark.table(f"`{schema}`.`{table}`").createOrReplaceTempView(f"{schema}_{table}")
            names[table] = f"{schema}.{table}"
        return names


@dataclass
class Release:
    """New versions of tables that become current together, when the release is committed.

    As a context it commits at its end, and not when an error ends it.
    """

    warehouse: Warehouse
    entries: list[dict] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.before = self.warehouse._log()  # read once: a release is the only writer
        self.number = max((e["release"] for e in self.before), default=0) + 1

    def __enter__(self) -> Release:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.commit()

    def _gathered(self, rows: DataFrame, about: int | None) -> DataFrame:
        """The rows in no more tasks than about so many rows need: each of them writes a file for every month it has."""
        about = about if about is not None else (known_size(rows) or (None,))[0]
        if about is None:
            return rows
        return rows.coalesce(max(self.warehouse.spark.sparkContext.defaultParallelism, -(-about // WRITER_ROWS)))

    def _write(self, layer: str, table: str, rows: DataFrame, month: Column | None, whole: bool, about: int | None = None) -> DataFrame:
        version = f"{self.number:06d}-{uuid.uuid4().hex[:8]}"
        folder = f"{self.warehouse.path(layer, table)}/{_VERSION}={version}"
        entry = {"release": self.number, "layer": layer_name(layer), "name": table, "version": version, "columns": rows.schema.json(), "by_month": month is not None}
        if month is None:
            size = measured_write(rows, lambda df: df.write.options(**STORED).parquet(folder))
            self.entries.append({**entry, "part": "", **size})
        else:
            # every task writes its rows of each month: no shuffle of whole rows, at most tasks x months files
            dated = self._gathered(rows, about).withColumn(MONTH, month)
            size = measured_write(dated, lambda df: df.write.partitionBy(MONTH).options(**STORED).parquet(folder))
            found = [part for part in self.warehouse.folders(folder) if part.startswith(f"{MONTH}=")]
            none = {"n_rows": 0, "n_bytes": 0}
            if whole:
                self.entries.append({**entry, "part": "", **size})
            for i, part in enumerate(found):
                self.entries.append({**entry, "part": part, **(size if not whole and i == 0 else none)})
        return self.frame(layer, table)

    def state(self, layer: str, table: str) -> TableState:
        """What the table will consist of after the release."""
        return self.warehouse.states([*self.before, *self.entries])[(layer_name(layer), table)]

    def frame(self, layer: str, table: str) -> DataFrame:
        """The table as it will be after the release."""
        return self.warehouse.frame(layer, table, self.state(layer, table))

    def rebuild(self, layer: str, table: str, rows: DataFrame) -> DataFrame:
        return self._write(layer, table, rows, None, whole=True)

    def rebuild_by_month(self, layer: str, table: str, rows: DataFrame, month: Column, about: int | None = None) -> DataFrame:
        """`about`: how many rows are to be expected, where that is known."""
        return self._write(layer, table, rows, month, True, about)

    def replace_months(self, layer: str, table: str, rows: DataFrame, month: Column, about: int | None = None) -> DataFrame:
        state = self.state(layer, table)
        return self._write(layer, table, rows.select(*state.columns.names), month, False, about)

    def about(self, layer: str, table: str, months: int) -> int:
        """Rows to be expected in so many months of a table."""
        state = self.state(layer, table)
        return -(-state.n_rows * months // max(1, len(state.parts)))

    def replace_changed_months(self, layer: str, table: str, rows: DataFrame, month: Column) -> tuple[DataFrame, list[int]]:
        dated = rows.withColumn(MONTH, month)

        def digests(df: DataFrame) -> DataFrame:
            line = F.xxhash64(*rows.columns).cast("decimal(38,0)")
            return df.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n"), F.sum(line).alias("digest"))

        stored = self.frame(layer, table).withColumn(MONTH, month)
        # one row per month reaches the driver, which lists the months anyway
        differing = [r[MONTH] for r in digests(dated).join(digests(stored), [MONTH, "n", "digest"], "left_anti").collect()]
        known = sorted(m for m in differing if m is not None)
        if not differing:
            return self.frame(layer, table), known
        # rows without a month are one partition, written whenever there are any
        return self.replace_months(layer, table, rows.where(month.isin(known) | month.isNull()), month), known

    def commit(self) -> None:
        """Make the new versions current: one file in one rename."""
        if self.entries:
            names = [c.strip().split()[0] for c in _ENTRY.split(",")]
            rows = self.warehouse.spark.createDataFrame([tuple(e[n] for n in names) for e in self.entries], _ENTRY)
            rows.coalesce(1).write.mode("append").parquet(f"{self.warehouse.root.rstrip('/')}/{_LOG}")
            self.entries = []


def create_raw_tables(warehouse: Warehouse) -> None:
    """RAW tables without rows, so that a feed that never delivered reads as empty."""
    for table in DOCUMENT_FEEDS.values():
        warehouse.create_if_missing(RAW, f"{table}/{BATCH}=created", RAW_DOCUMENT)
    warehouse.create_if_missing(RAW, f"{LEDGER_FEED[1]}/{BATCH}=created", RAW_LEDGER)
