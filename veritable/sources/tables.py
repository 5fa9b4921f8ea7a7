"""Layered tables (raw, staging, governance) and report files.

Each table is a Parquet folder ``<root>/<layer>/<name>``, by default also registered in the
catalog as ``<layer>.<name>``. A table is replaced by a folder that was written in full, so a job
that fails leaves the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritable.operators.rules import Rule, view_name
from veritable.sources.schemas import ENTITIES

LAYERS = ("raw", "staging", "governance")
#: Good rows and rejects leave one job, hence as files with all columns; these belong to rejects.
REJECT = "_reject_"
_OLD = "_old-"
#: Folder of the statements that made tables and views, one file each, and what parts them.
_CATALOG, _THEN = "_catalog", "\n;\n"
#: Buckets of stored keys. A table keeps its number, so choose it for the size that it will have.
KEY_BUCKETS = 64


def _file_system(spark: SparkSession, path: str):
    """``path`` as Spark's file system sees it, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _aside(spark: SparkSession, path: str):
    """Where the old folder waits while a new one takes its place."""
    folder = _file_system(spark, path)[1]
    return _file_system(spark, f"{folder.getParent().toString()}/{_OLD}{folder.getName()}")[1]


def recover_folder(spark: SparkSession, path: str) -> None:
    """Finish or undo a replacement whose driver was lost between its two renames."""
    files, target = _file_system(spark, path)
    aside = _aside(spark, path)
    if not files.exists(aside):
        return
    if files.exists(target):
        files.delete(aside, True)
    elif not files.rename(aside, target):
        raise OSError(f"cannot move {aside} back to {path}")


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old one goes last.

    These are two renames. Where a rename is one step of the file system (HDFS, local disks), a driver
    lost between them leaves the old table beside its place, and ``Store.recover`` or the next
    replacement puts it back; until then the table is missing, never mixed. On object stores a rename
    copies, so readers may meet a part of a table while it is replaced.
    """
    recover_folder(spark, path)
    files, target = _file_system(spark, path)
    fresh, aside = _file_system(spark, new)[1], _aside(spark, path)
    existed = files.exists(target)
    if existed and not files.rename(target, aside):
        raise OSError(f"cannot replace {path}")
    if not files.rename(fresh, target):
        if existed:
            files.rename(aside, target)
        raise OSError(f"cannot move {new} to {path}")
    if existed:
        files.delete(aside, True)


_OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def open_writers(spark: SparkSession, folders: int) -> Iterator[None]:
    """Let a task keep a file open in each of a few folders, instead of sorting its rows by folder."""
    before = spark.conf.get(_OPEN_WRITERS, None)
    spark.conf.set(_OPEN_WRITERS, folders)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_OPEN_WRITERS)
        else:
            spark.conf.set(_OPEN_WRITERS, before)


def observed(df: DataFrame, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """``df``, with aggregates that the job which writes it computes on its way."""
    watch = Observation()
    return df.observe(watch, *[c.alias(name) for name, c in metrics.items()]), watch


def _in_files(fault: T.StructType) -> T.StructType:
    """The columns of reject files: a fault's, then the folders' table and load."""
    parts = [T.StructField(c, T.StringType()) for c in ("table_name", "load")]
    return T.StructType([T.StructField(REJECT + f.name, f.dataType) for f in fault] + parts)


class TooManyRejects(ValueError):
    """A load rejected more rows than it may. Its rejects are stored, its target is as it was."""

    def __init__(self, told: str, counts: dict[str, int]) -> None:
        super().__init__(told)
        self.counts = counts


@dataclass(frozen=True)
class Split:
    """What a split write left: stored rows, stored rejects, and the counts of its one job."""

    accepted: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str
    register: bool = True
    #: Where the bucketed keys are known; their files are in the governance layer.
    database: str = "governance"

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def create_layers(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")

    # --- what outlives the session's catalog ------------------------------------------

    def recover(self) -> None:
        """Put back tables whose replacement was cut off."""
        for layer in LAYERS:
            files, folder = _file_system(self.spark, f"{self.root.rstrip('/')}/{layer}")
            if files.exists(folder):
                for status in files.listStatus(folder):
                    name = status.getPath().getName()
                    if name.startswith(_OLD):
                        recover_folder(self.spark, self.path(layer, name.removeprefix(_OLD)))

    def _remember(self, name: str, *statements: str) -> None:
        """Keep the statements that made a table or view next to the tables."""
        files, file = _file_system(self.spark, self.path("governance", f"{_CATALOG}/{name}.sql"))
        out = files.create(file, True)
        out.write(bytearray(_THEN.join(statements).encode()))
        out.close()

    def remember_views(self, names: Iterable[str]) -> None:
        """Keep stored views that users made by SQL, so that later sessions have them, too."""
        for name in names:
            if "." in name:
                told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'")
                self._remember(name, f"CREATE OR REPLACE VIEW {name} AS {told.first()[1]}")

    def restore(self) -> None:
        """Databases, tables and views as earlier sessions left them, for one whose catalog has none.

        Tables and views that the catalog knows are left alone. Views may build on other views, in any
        order.
        """
        self.create_layers()
        files, folder = _file_system(self.spark, self.path("governance", _CATALOG))
        if not files.exists(folder):
            return
        kept = self.spark.read.text(folder.toString(), wholetext=True).select(
            F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.sql$", 1).alias("name"), "value")
        left = {r.name: r.value for r in kept.collect() if not self.spark.catalog.tableExists(r.name)}
        while left:
            failed = {}
            for name, text in left.items():
                try:
                    for statement in text.split(_THEN):
                        self.spark.sql(statement)
                except AnalysisException as error:
                    failed[name] = error
            if len(failed) == len(left):
                raise next(iter(failed.values()))
            left = {name: left[name] for name in failed}

    def write(
        self, df: DataFrame, layer: str, name: str,
        mode: str = "overwrite", partition_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        path = self.path(layer, name)
        replaces = mode == "overwrite"
        new = self.path(layer, f"_{name}-{uuid.uuid4().hex}") if replaces else path
        writer = df.write.mode("error" if replaces else mode).options(**(options or {}))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        try:
            writer.parquet(new)
            if replaces:
                replace_folder(self.spark, new, path)
        finally:
            if replaces:
                files, folder = _file_system(self.spark, new)
                files.delete(folder, True)
        if self.register:
            self._register(layer, name, df.schema, partition_by)
        return self.read(layer, name, df.schema)

    def write_counted(
        self, df: DataFrame, layer: str, name: str, metrics: Mapping[str, Column], **how,
    ) -> tuple[DataFrame, dict]:
        """``write``, and the values of ``metrics`` over the rows written, from the same job."""
        counted, watch = observed(df, metrics)
        return self.write(counted, layer, name, **how), watch.get

    def write_split(
        self, rows: DataFrame, layer: str, name: str, faults: Column, rejects: str,
        columns: Mapping[str, Column] | None = None, max_rejected: float | None = 0,
        mode: str = "overwrite", load: str | None = None,
        metrics: Mapping[str, Column] | None = None,
    ) -> Split:
        """Store the rows without a fault as a table, and the faults of the others, in one pass.

        ``faults`` is an array of structs, empty for a good row; each struct of a bad one is a row of
        ``governance.<rejects>``, which keeps them by table and load. ``columns`` are what a good row
        is stored as. More than ``max_rejected`` bad rows (a share of all rows if below 1, any number
        if None) raise ``TooManyRejects`` before the table is touched. A replacing load also replaces
        the table's rejects; an appending one adds its own.
        """
        columns = columns or {c: F.col(c) for c in rows.columns}
        load = load or f"load-{uuid.uuid4().hex}"
        marked = rows.withColumn("_faults", faults)
        bad = F.size("_faults") > 0
        marked, watch = observed(marked, {
            **(metrics or {}), "rows": F.count(F.lit(1)), "rejected": F.count_if(bad)})
        fault = marked.schema["_faults"].dataType.elementType
        flat = marked.select(
            (~bad).alias("_accepted"), *[F.when(~bad, c).alias(n) for n, c in columns.items()],
            F.explode_outer("_faults").alias("_fault")).select(
            "_accepted", *columns, *[F.col(f"_fault.{f}").alias(REJECT + f) for f in fault.names])
        schema = T.StructType([flat.schema[c] for c in columns])

        new = self.path(layer, f"_{name}-{load}")
        reject_path = f"{self.path('governance', rejects)}/table_name={name}"
        files, folder = _file_system(self.spark, new)
        try:
            with open_writers(self.spark, 2):
                flat.write.partitionBy("_accepted").parquet(new)
            counts = watch.get
            good, bad_path = f"{new}/_accepted=true", f"{new}/_accepted=false"
            self._publish_rejects(bad_path, reject_path, load, mode == "overwrite")
            allowed = counts["rejected"] if max_rejected is None else (
                max_rejected if max_rejected >= 1 else max_rejected * counts["rows"])
            if counts["rejected"] > allowed:
                raise TooManyRejects(
                    f"{name}: {counts['rejected']} of {counts['rows']} rows are rejected, see "
                    f"{reject_path}: {self._examples(reject_path, fault)}", counts)
            if not files.exists(_file_system(self.spark, good)[1]):
                self.spark.createDataFrame([], schema).write.parquet(good)
            self._publish(good, self.path(layer, name), mode == "overwrite")
        finally:
            files.delete(folder, True)
        if self.register:
            self._register(layer, name, schema, ())
            self._register_rejects(rejects, fault)
        stored = self.rejects(rejects, fault).where(
            (F.col("table_name") == name) & (F.col("load") == load))
        return Split(self.read(layer, name, schema), stored, counts)

    def rejects(self, name: str, fault: T.StructType) -> DataFrame:
        """All stored rejects of a kind, with the table and the load that they are from."""
        read = self.spark.read.schema(_in_files(fault)).parquet(self.path("governance", name))
        return read.select("table_name", "load", *[F.col(REJECT + f).alias(f) for f in fault.names])

    def _register_rejects(self, name: str, fault: T.StructType) -> None:
        """The files as ``<name>_files``, and a view of them with plain names."""
        self._register("governance", f"{name}_files", _in_files(fault), ("table_name", "load"),
                       self.path("governance", name))
        columns = ", ".join(f"`{REJECT}{f}` AS `{f}`" for f in fault.names)
        self._create_view(f"governance.{name}",
                          f"SELECT table_name, load, {columns} FROM governance.{name}_files")

    def _create_view(self, name: str, text: str) -> None:
        made = f"CREATE OR REPLACE VIEW {name} AS {text}"
        self.spark.sql(made)
        self._remember(name, made)

    def _publish(self, new: str, path: str, replaces: bool) -> None:
        """Put a written folder in the place of a table, or its files next to the table's own."""
        files, target = _file_system(self.spark, path)
        if replaces or not files.exists(target):
            files.mkdirs(target.getParent())
            replace_folder(self.spark, new, path)
            return
        for status in files.listStatus(_file_system(self.spark, new)[1]):
            file = status.getPath()
            if not files.rename(file, _file_system(self.spark, f"{path}/{file.getName()}")[1]):
                raise OSError(f"cannot move {file} to {path}")

    def _publish_rejects(self, new: str, path: str, load: str, replaces: bool) -> None:
        files, folder = _file_system(self.spark, path)
        if replaces:
            files.delete(folder, True)
        files.mkdirs(folder)
        source = _file_system(self.spark, new)[1]
        if files.exists(source) and not files.rename(
                source, _file_system(self.spark, f"{path}/load={load}")[1]):
            raise OSError(f"cannot move {new} to {path}")

    def _examples(self, path: str, fault: T.StructType) -> str:
        found = self.spark.read.schema(_in_files(fault)).parquet(path).select(
            *[REJECT + f for f in fault.names]).limit(3).collect()
        return "; ".join(", ".join(str(v) for v in r) for r in found)

    def _register(
        self, layer: str, name: str, schema: T.StructType, partition_by: Sequence[str],
        path: str | None = None,
    ) -> None:
        """Point the catalog at the folder, if it does not already. Dropping leaves the files alone.

        The files are written first and by path: saving through a catalog that does not know
        the table would replace what an earlier job appended.
        """
        table, path = f"{layer}.{name}", path or self.path(layer, name)
        if self._registered(table, path, schema):
            self.spark.sql(f"REFRESH TABLE {table}")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            parts = f"PARTITIONED BY ({', '.join(partition_by)}) " if partition_by else ""
            made = [f"CREATE TABLE {table} ({columns}) USING parquet {parts}LOCATION '{path}'"]
            if partition_by:
                made.append(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
            self.spark.sql(made[0])
            self._remember(table, *made)
        if partition_by:
            self.spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")

    def _registered(self, table: str, path: str, schema: T.StructType) -> bool:
        """The catalog has the table with this folder and these columns."""
        if not self.spark.catalog.tableExists(table):
            return False
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
        files, folder = _file_system(self.spark, path)
        return told.first()[1] == files.makeQualified(folder).toString() and {
            (f.name, f.dataType) for f in self.spark.table(table).schema
        } == {(f.name, f.dataType) for f in schema}

    def read(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """Read by folder, so that a later job needs no catalog that outlives a session."""
        if schema is not None:
            return self.spark.read.schema(schema).parquet(self.path(layer, name))
        df = self.spark.read.parquet(self.path(layer, name))
        return df.drop(*[c for c in df.columns if c.startswith(REJECT)])

    def reset_raw(self) -> None:
        """Empty every raw table, keeping its schema."""
        for entity in ENTITIES.values():
            self.write(self.spark.createDataFrame([], entity.raw_schema), "raw", entity.name)

    def write_raw(self, frames: Mapping[str, DataFrame], mode: str = "overwrite") -> DataFrame:
        """Store the raw tables and return how many rows each one holds.

        ``append`` adds to what is there, so a second run doubles the data unless
        ``reset_raw`` comes first; the default replaces it. Rows are counted by the job that writes
        them; what was there before is read from file footers.
        """
        rows = {}
        for name, df in frames.items():
            before = self.stored_rows("raw", name) if mode == "append" else 0
            _, counts = self.write_counted(
                df, "raw", name, {"rows": F.count(F.lit(1))}, mode=mode)
            rows[name] = before + counts["rows"]
        return self.row_counts(rows)

    def stored_rows(self, layer: str, name: str) -> int:
        """Rows of a stored table, 0 if there is none. A count reads no column of its files."""
        files, folder = _file_system(self.spark, self.path(layer, name))
        return self.read(layer, name).count() if files.exists(folder) else 0

    def row_counts(self, rows: Mapping[str, int]) -> DataFrame:
        return self.spark.createDataFrame(list(rows.items()), "table_name string, row_count long")

    def write_log(self, log: DataFrame, name: str = "violations_log") -> DataFrame:
        """Store the violations log, one folder per table and dimension.

        The rebalance brings the rows of a folder together, so that not every task writes to
        every folder, and splits a folder that holds most rows over several tasks. Rows are sorted by
        record, and files carry Bloom filters of the records, so that one record is found without
        reading its folder (``record_violations``).
        """
        folders = ("table_name", "dimension")
        placed = log.hint("rebalance", *folders).sortWithinPartitions(*folders, "record_id")
        return self.write(placed, "governance", name, partition_by=folders, options={
            "parquet.bloom.filter.enabled#record_id": "true",
            "parquet.bloom.filter.adaptive.enabled": "true"})

    # --- keys of earlier loads --------------------------------------------------------

    def key_table(self, name: str, fresh: DataFrame, buckets: int) -> DataFrame:
        """The stored keys of a table, by bucket. Any session finds the files by their folder."""
        table, keys = f"{self.database}.keys_{name}", fresh.columns
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh.schema)
            by = ", ".join(f"`{k}`" for k in keys)
            made = (f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) "
                    f"INTO {buckets} BUCKETS LOCATION '{self.path('governance', f'keys_{name}')}'")
            self.spark.sql(made)
            self._remember(table, made)
        return self.spark.table(table)

    def known_keys(
        self, fresh: DataFrame, name: str, keys: Sequence[str], buckets: int = KEY_BUCKETS,
    ) -> DataFrame:
        """Keys of ``fresh`` that an earlier load has.

        Only the new keys move: they are dealt into the buckets in which the stored ones lie. Keys with
        a NULL are no keys and never clash.
        """
        mine = fresh.select(*keys).na.drop().repartition(buckets, *keys).distinct()
        return mine.join(self.key_table(name, mine, buckets), list(keys), "left_semi")

    def assert_new_keys(
        self, fresh: DataFrame, name: str, keys: Sequence[str], buckets: int = KEY_BUCKETS,
    ) -> None:
        """Raise when a load has one key twice, or one that an earlier load has."""
        twice = fresh.na.drop(subset=list(keys)).groupBy(*keys).count().where("count > 1").drop("count")
        for told, bad in (("occur twice", twice),
                          ("are stored already", self.known_keys(fresh, name, keys, buckets))):
            if found := bad.limit(5).collect():
                raise ValueError(f"keys of {name} {told}: {[tuple(r) for r in found]}")

    def append_keys(
        self, fresh: DataFrame, name: str, keys: Sequence[str], buckets: int = KEY_BUCKETS,
    ) -> None:
        mine = fresh.select(*keys).na.drop().repartition(buckets, *keys).sortWithinPartitions(*keys)
        self.key_table(name, mine, buckets)
        mine.write.insertInto(f"{self.database}.keys_{name}")

    def replace_keys(
        self, rows: DataFrame, name: str, keys: Sequence[str], buckets: int = KEY_BUCKETS,
    ) -> None:
        """Take the keys of the rows that are stored now, as after a load that replaced the table."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.keys_{name}")
        files, folder = _file_system(self.spark, self.path("governance", f"keys_{name}"))
        files.delete(folder, True)
        self.append_keys(rows, name, keys, buckets)

    def create_rule_views(self, rules: Sequence[Rule]) -> None:
        """Stored views ``governance.v_...``: each rule's part of the stored log."""
        for rule in rules:
            self._create_view(
                f"governance.{view_name(rule)}",
                "SELECT record_id, table_name, dimension, rule_name, detail "
                f"FROM governance.violations_log WHERE table_name = '{rule.table}' "
                f"AND dimension = '{rule.dimension}' AND rule_name = '{rule.name}'")

    def append_history(self, snapshot: DataFrame) -> DataFrame:
        """Add a scorecard snapshot: one row per table and dimension, hence one file.

        Snapshots are kept by run, which is their time. A run that is repeated, or retried after it
        failed, replaces its own snapshot and no other.
        """
        runs = snapshot.withColumn("run", F.unix_micros("measured_at")).coalesce(1)
        return self.write_parts(runs, "governance", "quality_scorecard_history", ["run"]).drop("run")

    def write_parts(
        self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str],
    ) -> DataFrame:
        """Replace the folders that ``df`` has rows for, and leave the others of the table."""
        path = self.path(layer, name)
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *partition_by).parquet(path)
        if self.register:
            self._register(layer, name, df.schema, partition_by)
        return self.read(layer, name, df.schema)


def write_csv(df: DataFrame, path: str) -> None:
    """A report as a folder of CSV files with headers; NULL is an empty cell.

    Spaces around a value are part of it; Spark's writer would drop them by default.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

