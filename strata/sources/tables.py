"""Tables with a log: schema versions, the list of data folders, one atomic pointer.

A table is a folder. ``data/`` holds one folder of parquet files for each load, which
are never changed; ``_log/`` holds one small JSON file for each version, naming the
table's schema and its data folders with the schema each was written in. The newest
log file is the table: a version appears by one rename of a finished file, so a job
that fails anywhere leaves the version before it, whole and readable.

* A load whose columns are new or wider changes the schema in the log; stored files
  stay as they are and are read under the new schema.
* A refresh names only the new folder; readers of the old version keep their files.
* A load may carry an id: a second load of the same id is a no-op.

The rename must fail if the version exists and must not copy: HDFS and local disks
do; on an object store without such a rename, give every table one writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.schema import SchemaChange, align, reconcile

JOURNAL = "version long, operation string, load_id string, rows long, parts int, changes string"


class ConcurrentCommit(RuntimeError):
    """Another writer made the version first."""


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    parts: tuple[dict, ...]  # path below the table, rows, schema as JSON
    operation: str
    load_id: str | None
    loads: tuple[str, ...]  # ids of all loads that the parts hold
    rows: int
    changes: tuple[str, ...] = field(default=())

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()}, ensure_ascii=False)

    @staticmethod
    def from_json(raw: str) -> Version:
        held = json.loads(raw)
        sequences = {k: tuple(held[k]) for k in ("parts", "loads", "changes")}
        return Version(**{**held, **sequences, "schema": T.StructType.fromJson(held["schema"])})


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop(self.path).getFileSystem(self._conf)

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    # -- log ---------------------------------------------------------------

    def _log_files(self) -> list[tuple[int, str]]:
        log = self._hadoop(f"{self.path}/_log")
        if not self._fs.exists(log):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(log)]
        return sorted((int(n[:-5]), n) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, name: str) -> Version:
        stream = self._fs.open(self._hadoop(f"{self.path}/_log/{name}"))
        try:
            return Version.from_json(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def current(self) -> Version | None:
        files = self._log_files()
        return self._read(files[-1][1]) if files else None

    def versions(self) -> list[Version]:
        return [self._read(name) for _, name in self._log_files()]

    def _commit(self, version: Version) -> Version:
        draft = self._hadoop(f"{self.path}/_log/.draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(version.to_json().encode("utf-8")))
        finally:
            out.close()
        target = self._hadoop(f"{self.path}/_log/{version.number:020d}.json")
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), options)
        except Exception as exc:  # noqa: BLE001 - py4j wraps the Java exception
            self._fs.delete(draft, False)
            if self._fs.exists(target):
                raise ConcurrentCommit(f"{self.path}: version {version.number} exists") from exc
            raise
        return version

    # -- writes ------------------------------------------------------------

    def _write(self, df: DataFrame) -> dict:
        """``df`` as a new data folder, which no version names yet."""
        name = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{name}")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}").count()  # from the footers
        return {"path": name, "rows": rows, "schema": df.schema.json()}

    def append(self, df: DataFrame, load_id: str | None = None) -> list[SchemaChange]:
        """Add a load; its new or wider columns evolve the schema, no stored file is
        rewritten. Returns the changes (all columns for a new table); none if
        ``load_id`` is in the table."""
        now = self.current()
        if now is None:
            self._first(df, load_id, "append")
            return [SchemaChange(f.name, "add", f.dataType.simpleString()) for f in df.schema.fields]
        if load_id is not None and load_id in now.loads:
            return []
        schema, changes = reconcile(now.schema, df.schema)
        part = self._write(df)
        said = tuple(f"{c.action} {c.column} {c.data_type}" for c in changes)
        loads = now.loads + ((load_id,) if load_id is not None else ())
        self._commit(Version(now.number + 1, schema, (*now.parts, part), "append", load_id, loads, part["rows"], said))
        return changes

    def replace(self, df: DataFrame, load_id: str | None = None) -> bool:
        """Full refresh: the table is the rows of ``df``, which may read the table
        itself. False (and nothing done) if the latest refresh has ``load_id``."""
        now = self.current()
        if now is not None and load_id is not None and now.operation == "replace" and now.load_id == load_id:
            return False
        self._first(df, load_id, "replace", 0 if now is None else now.number + 1)
        return True

    def _first(self, df: DataFrame, load_id: str | None, operation: str, number: int = 0) -> None:
        part = self._write(df)
        loads = (load_id,) if load_id is not None else ()
        self._commit(Version(number, df.schema, (part,), operation, load_id, loads, part["rows"]))

    def vacuum(self, keep: int = 1) -> int:
        """Delete data folders that none of the last ``keep`` versions names, also
        those of failed loads, and older log files. Only while nobody writes."""
        held = self._log_files()
        kept = [self._read(name) for _, name in held[-keep:]]
        named = {p["path"].split("/")[-1] for v in kept for p in v.parts}
        data, gone = self._hadoop(f"{self.path}/data"), 0
        for s in self._fs.listStatus(data) if self._fs.exists(data) else []:
            if s.getPath().getName() not in named:
                gone += bool(self._fs.delete(s.getPath(), True))
        for _, name in held[:-keep]:
            self._fs.delete(self._hadoop(f"{self.path}/_log/{name}"), False)
        return gone

    # -- reads -------------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of the newest version, or of ``number``: one scan for each schema
        that its folders were written in, each read under the version's schema."""
        version = self.current() if number is None else next((v for v in self.versions() if v.number == number), None)
        if version is None:
            return None
        by_schema: dict[str, list[str]] = {}
        for part in version.parts:
            by_schema.setdefault(part["schema"], []).append(f"{self.path}/{part['path']}")
        frames = [
            align(self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*paths), version.schema) for schema, paths in by_schema.items()
        ]
        return reduce(DataFrame.unionByName, frames)

    def journal(self) -> DataFrame:
        """One row for each version: what it did, its load's id and rows, and the
        schema changes."""
        rows = [(v.number, v.operation, v.load_id, v.rows, len(v.parts), "; ".join(v.changes)) for v in self.versions()]
        return self.spark.createDataFrame(rows, JOURNAL)

