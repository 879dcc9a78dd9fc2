"""Tables as Parquet folders with one small JSON record per version.

A load reads version n, runs one plan that writes a new folder, and commits
version n+1 by creating its record. A version is a list of folders, so an append
adds one and a merge replaces only those that hold a touched row; readers of an
older version are not disturbed. This is a publishing convention over Spark's
own Parquet source, with one writer per table at a time: a second writer fails
when it tries to create the same record.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.columns import conform, require_values
from siltstone.session import hadoop_path

FOLDER = "__folder"  # column that tells in which folder of the table a row lies


def _no_table() -> dict:
    return {"version": 0, "dropped": True, "folders": [], "batches": {}, "properties": {}}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._last: dict[str, int] = {}
        self._records: dict[tuple[str, int], str] = {}

    # -- names and records ------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def create_namespace(self, name: str) -> None:
        fs, target = hadoop_path(self.spark, self.path(name))
        fs.mkdirs(target)

    def _record_file(self, name: str, version: int):
        return hadoop_path(self.spark, f"{self.path(name)}/_commits/{version:08d}.json")

    def _newest(self, name: str) -> int:
        """Highest version number in use: listed once, then followed upwards."""
        if name not in self._last:
            fs, folder = hadoop_path(self.spark, f"{self.path(name)}/_commits")
            files = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
            numbers = (int(f.removesuffix(".json")) for f in files if f.endswith(".json"))
            self._last[name] = max(numbers, default=0)
        newest = self._last[name]
        while True:
            fs, file = self._record_file(name, newest + 1)
            if not fs.exists(file):
                self._last[name] = newest
                return newest
            newest += 1

    def _load_record(self, name: str, version: int) -> dict | None:
        """A version's record, None where there is none; a record never changes once written."""
        if (name, version) not in self._records:
            fs, file = self._record_file(name, version)
            if not fs.exists(file):
                return None
            stream = fs.open(file)
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if not text.endswith("}\n"):
                return None  # its writer died between creating and filling it
            self._records[name, version] = text
        return json.loads(self._records[name, version])

    def record(self, name: str, version: int | None = None) -> dict:
        """The given or the newest version's record; an empty one for an unknown table."""
        if version is not None:
            found = self._load_record(name, version)
            if found is None:
                raise ValueError(f"table {name} has no version {version}")
            return found
        for number in range(self._newest(name), 0, -1):
            found = self._load_record(name, number)
            if found:
                return found
        return _no_table()

    def _existing(self, name: str, version: int | None = None) -> dict:
        rec = self.record(name, version)
        if rec["dropped"]:
            raise ValueError(f"table {name} does not exist")
        return rec

    def exists(self, name: str) -> bool:
        return not self.record(name)["dropped"]

    def version(self, name: str) -> int:
        return self.record(name)["version"]

    def properties(self, name: str) -> dict[str, str]:
        return self.record(name)["properties"]

    def batch(self, name: str, batch_id: str | None) -> dict | None:
        """What was noted with a batch already committed to the table, else None."""
        return self.record(name)["batches"].get(batch_id) if batch_id is not None else None

    # -- reading ----------------------------------------------------------

    def schema(self, name: str, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self._existing(name, version)["schema"])

    def read(
        self,
        name: str,
        version: int | None = None,
        folders: Collection[str] | None = None,
        internal: bool = False,
        with_folder: bool = False,
    ) -> DataFrame:
        """Rows of a version, or of some of its folders.

        ``internal`` keeps the columns starting with ``__`` that only lay out the
        files; ``with_folder`` adds the folder each row lies in.
        """
        rec = self._existing(name, version)
        schema = T.StructType.fromJson(rec["schema"])
        columns = [c for c in schema.names if internal or not c.startswith("__")]
        wanted = rec["folders"] if folders is None else sorted(folders)
        if not wanted:
            empty = self.spark.createDataFrame([], schema).select(*columns)
            return empty.withColumn(FOLDER, F.lit("")) if with_folder else empty
        base = self.path(name)
        df = (
            self.spark.read.schema(schema)
            .option("basePath", base)
            .parquet(*(f"{base}/{folder}" for folder in wanted))
        )
        if not with_folder:
            return df.select(*columns)
        below_load = F.split_part(F.col("_metadata.file_path"), F.lit("/__load="), F.lit(2))
        folder = F.substring_index(below_load, "/", 1 + len(rec["partition_by"]))
        return df.select(*columns, folder.alias(FOLDER))

    def register_view(self, name: str, view: str | None = None, version: int | None = None) -> str:
        """Session view of a version for SQL; a dotted name becomes one with underscores."""
        view = view or name.replace(".", "_")
        self.read(name, version).createOrReplaceTempView(view)
        return view

    def touched_folders(self, rows: DataFrame) -> set[str]:
        """Distinct folders of some rows read ``with_folder``: at most one per folder listed."""
        return {self.folder(r[0]) for r in rows.select(FOLDER).distinct().collect()}

    @staticmethod
    def folder(value: str) -> str:
        """Folder as the record lists it, from a value of the ``FOLDER`` column."""
        return f"__load={unquote(value)}"

    # -- writing ----------------------------------------------------------

    def _write(self, name: str, df: DataFrame, partition_by: Sequence[str], rebalance: bool) -> list[str]:
        load = f"__load={uuid.uuid4().hex[:12]}"
        path = f"{self.path(name)}/{load}"
        if partition_by and rebalance:
            # One task per partition value or, for a big one, several of the advisory size.
            df = df.hint("rebalance", *partition_by)
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
        found = [load]
        for _ in partition_by:
            found = [
                f"{parent}/{status.getPath().getName()}"
                for parent in found
                for status in self._list(f"{self.path(name)}/{parent}")
                if status.isDirectory()
            ]
        return found

    def _without_empty(self, name: str, folders: list[str], schema: T.StructType) -> list[str]:
        """No folder at all where a write produced no row; stops at the first row found."""
        paths = [f"{self.path(name)}/{folder}" for folder in folders]
        if not paths or self.spark.read.schema(schema).parquet(*paths).isEmpty():
            return []
        return folders

    def _list(self, path: str):
        fs, folder = hadoop_path(self.spark, path)
        return fs.listStatus(folder)

    def _commit(self, name: str, rec: dict) -> int:
        newest = self._newest(name)
        if rec["version"] < newest and self._load_record(name, newest):
            raise RuntimeError(f"table {name} got version {newest} while this load was running")
        number = rec["version"] = newest + 1
        fs, file = self._record_file(name, number)
        out = fs.create(file, False)  # fails when another writer was first
        try:
            out.write((json.dumps(rec) + "\n").encode())
        finally:
            out.close()
        return number

    def replace(
        self,
        name: str,
        df: DataFrame | None,
        dropped_folders: Collection[str],
        batch_id: str | None = None,
        note: Mapping[str, str] | None = None,
        properties: Mapping[str, str] | None = None,
        schema: T.StructType | None = None,
        rebalance: bool = True,
        skip_empty: bool = False,
    ) -> int:
        """Commit a version without ``dropped_folders`` and with the rows of ``df``.

        With ``skip_empty`` a change that neither drops nor adds a row makes no
        version, unless a batch or property has to be noted.
        """
        rec = self.record(name)
        if schema is not None:
            rec["schema"] = schema.jsonValue()
        target = T.StructType.fromJson(rec["schema"])
        kept = [f for f in rec["folders"] if f not in dropped_folders]
        added = []
        if df is not None:
            ready = require_values(conform(df, target), target)
            added = self._write(name, ready, rec["partition_by"], rebalance)
            if skip_empty and not dropped_folders:
                added = self._without_empty(name, added, target)
        if skip_empty and not (dropped_folders or added or properties or batch_id is not None):
            return rec["version"]
        rec["folders"] = kept + added
        rec["properties"] = {**rec["properties"], **(properties or {})}
        if batch_id is not None:
            rec["batches"][batch_id] = dict(note or {})
        return self._commit(name, rec)

    def publish(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        properties: Mapping[str, str] | None = None,
        merge_schema: bool = False,
        batch_id: str | None = None,
        note: Mapping[str, str] | None = None,
        rebalance: bool = True,
    ) -> int:
        """Replace the whole content, creating the table where it is absent.

        An existing table keeps its declared types; other columns are accepted
        only with ``merge_schema``, which adds them.
        """
        rec = self.record(name)
        if rec["dropped"]:
            self._check_partitioning(df.schema, partition_by)
            if batch_id is not None:
                rec["batches"] = {batch_id: dict(note or {})}
            schema = _relaxed(df.schema)
            folders = self._write(name, conform(df, schema), partition_by, rebalance)
            rec.update(
                dropped=False,
                schema=schema.jsonValue(),
                partition_by=list(partition_by),
                folders=folders,
                properties=dict(properties or {}),
            )
            return self._commit(name, rec)
        schema = self._widened(rec, df, merge_schema)
        return self.replace(name, df, rec["folders"], batch_id, note, properties, schema, rebalance)

    def replace_landing(self, df: DataFrame, name: str) -> int:
        """Truncate and insert: the new rows are committed, then every other folder of the table is deleted.

        A landing table holds one batch and no history: its older versions can no longer be read. What a run that died
        left behind goes with the next run.
        """
        version = self.publish(df, name, merge_schema=True)
        listed = {folder.split("/")[0] for folder in self.record(name)["folders"]}
        fs, _ = hadoop_path(self.spark, self.root)
        for status in self._list(self.path(name)):
            folder = status.getPath()
            if folder.getName().startswith("__load=") and folder.getName() not in listed:
                fs.delete(folder, True)
        return version

    def append(
        self,
        df: DataFrame,
        name: str,
        batch_id: str | None = None,
        note: Mapping[str, str] | None = None,
        merge_schema: bool = False,
        properties: Mapping[str, str] | None = None,
        partition_by: Sequence[str] = (),
    ) -> int:
        """Add rows without touching the stored ones; a batch already committed is not added again."""
        if self.batch(name, batch_id) is not None:
            return self.version(name)
        rec = self.record(name)
        if rec["dropped"]:
            return self.publish(df, name, partition_by, properties, batch_id=batch_id, note=note)
        schema = self._widened(rec, df, merge_schema)
        return self.replace(name, df, (), batch_id, note, properties, schema)

    def create_if_absent(
        self,
        name: str,
        schema: T.StructType,
        partition_by: Sequence[str] = (),
        properties: Mapping[str, str] | None = None,
    ) -> int:
        """Empty typed table; NOT NULL columns are checked by every later write."""
        rec = self.record(name)
        if not rec["dropped"]:
            return rec["version"]
        self._check_partitioning(schema, partition_by)
        rec.update(
            dropped=False,
            schema=schema.jsonValue(),
            partition_by=list(partition_by),
            folders=[],
            properties=dict(properties or {}),
        )
        return self._commit(name, rec)

    def set_properties(self, name: str, properties: Mapping[str, str]) -> int:
        return self.replace(name, None, (), properties=properties)

    def clone(self, source: str, target: str) -> int:
        """Full copy of the current rows, only where the target is absent."""
        if self.exists(target):
            return self.version(target)
        rec = self.record(source)
        return self.publish(
            self.read(source, internal=True), target, rec["partition_by"], rec["properties"]
        )

    def drop(self, name: str) -> int:
        """Commit the end of the table; older versions stay readable by number."""
        return self._commit(name, {**_no_table(), "version": self.version(name)})

    def delete_where(self, name: str, predicate: Column) -> int:
        """Delete matching rows, rewriting only the folders that hold one."""
        hit = self.touched_folders(self.read(name, with_folder=True).filter(predicate))
        if not hit:
            return self.version(name)
        rows = self.read(name, folders=hit, internal=True)
        return self.replace(name, rows.filter(~F.coalesce(predicate, F.lit(False))), hit)

    def update_where(
        self,
        name: str,
        predicate: Column,
        values: Mapping[str, Column],
        properties: Mapping[str, str] | None = None,
    ) -> int:
        """Set columns of matching rows, rewriting only the folders that hold one; properties go along."""
        hit = self.touched_folders(self.read(name, with_folder=True).filter(predicate))
        if not hit:
            return self.version(name)
        rows = self.read(name, folders=hit, internal=True)
        return self.replace(
            name,
            rows.select(
                *(
                    F.when(predicate, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
                    for c in rows.columns
                )
            ),
            hit,
            properties=properties,
        )

    @staticmethod
    def _check_partitioning(schema: T.StructType, partition_by: Sequence[str]) -> None:
        missing = [c for c in partition_by if c not in schema.names]
        if missing:
            raise ValueError(f"partition columns not in the schema: {missing}")

    @staticmethod
    def _widened(rec: dict, df: DataFrame, merge_schema: bool) -> T.StructType:
        schema = T.StructType.fromJson(rec["schema"])
        if not merge_schema:
            return schema
        extra = [f for f in df.schema.fields if f.name not in schema.names]
        return T.StructType(schema.fields + _relaxed(T.StructType(extra)).fields)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a warehouse table addressed by its path."""
    root, name = path.rstrip("/").rsplit("/", 1)
    return Warehouse(spark, root).read(name, version)


def _relaxed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])
