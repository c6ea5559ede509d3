"""A lakehouse-style table: data and delete folders under a log of snapshots."""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.partition import Transform, parse
from millrace.plans.schema_map import merge_schema

SEQ = "_seq"


class CommitConflict(RuntimeError):
    """Another writer took the version that this commit was for."""


class Store:
    """Small files of a folder, by Spark's own file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a new file whole, or raise CommitConflict if it exists.

        The text is staged under another name and renamed, so no reader sees a part.
        """
        staged = self.path(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(staged, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(self.path(name)) or not self._fs.rename(staged, self.path(name)):
            self._fs.delete(staged, False)
            raise CommitConflict(name)

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


@dataclass
class Snapshot:
    """The state of a table at a version; ``data`` and ``deletes`` are its live folders."""

    version: int
    operation: str
    schema: T.StructType
    keys: list[str]
    sort: list[str] = field(default_factory=list)
    partition: list[Transform] = field(default_factory=list)
    format: str = "parquet"
    data: list[str] = field(default_factory=list)
    deletes: list[str] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    committed_ms: int = 0
    properties: dict[str, str] = field(default_factory=dict)
    #: Bytes of a delete folder's rows in memory; entries of older logs lack it.
    delete_bytes: dict[str, int] = field(default_factory=dict)

    def dump(self) -> str:
        out = self.__dict__ | {"schema": self.schema.jsonValue(), "partition": list(map(str, self.partition))}
        return json.dumps(out)

    @classmethod
    def load(cls, text: str) -> Snapshot:
        raw = json.loads(text)
        return cls(**raw | {"schema": T.StructType.fromJson(raw["schema"]), "partition": list(map(parse, raw["partition"]))})


def _counted(batch_id: str) -> tuple[str, int | None]:
    """``source#number`` as the source (with the sign) and the number; another id as it is."""
    source, sign, number = batch_id.rpartition("#")
    return (source + sign, int(number)) if sign and number.isdecimal() else (batch_id, None)


def _physical(f: T.StructField) -> str:
    return f.metadata.get("physical", f.name)


class Table:
    """Rows with keys in a folder.

    A commit writes its files first, then one log entry, whose creation decides. Data
    and delete rows carry the commit's number; a row is visible unless a delete of its
    key has a greater number. Readers see one entry, so commits are atomic; files of a
    commit that failed are never listed. A batch id is committed once: of ids that end in
    ``#`` and a number, which a source counts up, the highest is remembered; of
    others, all.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.store = spark, folder.rstrip("/"), Store(spark, folder)

    # --- log

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.store.names("_log") if n.endswith(".json")]

    def exists(self) -> bool:
        return bool(self.versions())

    def snapshot(self, version: int | None = None, as_of_ms: int | None = None) -> Snapshot:
        """The latest snapshot, that of a version, or the last one of a time."""
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no table at {self.folder}")
        if as_of_ms is not None:
            past = [s for v in known if (s := self.snapshot(v)).committed_ms <= as_of_ms]
            if not past:
                raise ValueError("the table is younger than that")
            return past[-1]
        return Snapshot.load(self.store.read(f"_log/{known[-1] if version is None else version:010d}.json"))

    def _commit(self, new: Snapshot) -> Snapshot:
        new.committed_ms = int(time.time() * 1000)
        self.store.create(f"_log/{new.version:010d}.json", new.dump())
        return new

    @classmethod
    def create(
        cls, spark: SparkSession, folder: str, schema: T.StructType, keys: list[str] = (), sort: list[str] = (),
        partition: list[Transform] = (), format: str = "parquet", properties: dict[str, str] | None = None,
    ) -> Table:
        """A new table; one that exists is left as it is."""
        table = cls(spark, folder)
        if not table.exists():
            start = Snapshot(0, "create", schema, list(keys), list(sort), list(partition), format, properties=properties or {})
            try:
                table._commit(start)
            except CommitConflict:  # another one was first
                pass
        return table

    def _next(self, operation: str, batch_id: str | None = None, **changes) -> Snapshot:
        now = self.snapshot()
        new = Snapshot(**now.__dict__ | {"operation": operation, "version": now.version + 1, "batches": dict(now.batches)} | changes)
        if batch_id is not None:
            source, number = _counted(batch_id)
            new.batches[source] = new.version if number is None else number
        return new

    def committed(self, batch_id: str | None) -> bool:
        if batch_id is None:
            return False
        (source, number), known = _counted(batch_id), self.snapshot().batches
        return source in known and (number is None or number <= known[source])

    # --- schema

    def evolve(self, schema: T.StructType) -> Snapshot:
        """Add and widen columns; nothing is committed where nothing changes."""
        now = self.snapshot()
        merged = merge_schema(now.schema, schema)
        taken = {_physical(f) for f in now.schema.fields}
        fresh = []
        for f in merged.fields:
            if f.name not in now.schema.names and f.name in taken:
                f = T.StructField(f.name, f.dataType, f.nullable, f.metadata | {"physical": f"{f.name}_{now.version + 1}"})
            fresh.append(f)
        merged = T.StructType(fresh)
        if merged.jsonValue() == now.schema.jsonValue():
            return now
        same = [(f.name, f.dataType) for f in merged.fields] == [(f.name, f.dataType) for f in now.schema.fields]
        return now if same else self._commit(self._next("schema", schema=merged))

    def rename_column(self, old: str, new: str) -> Snapshot:
        """Rename in the schema alone; files keep the name they were written with."""
        now = self.snapshot()
        if new in now.schema.names or old not in now.schema.names:
            raise ValueError(f"can't rename {old} to {new}")
        fields = [
            T.StructField(new, f.dataType, f.nullable, f.metadata | {"physical": _physical(f)}) if f.name == old else f
            for f in now.schema.fields
        ]
        keys = [new if k == old else k for k in now.keys]
        sort = [new if k == old else k for k in now.sort]
        return self._commit(self._next("schema", schema=T.StructType(fields), keys=keys, sort=sort))

    # --- writing

    def _write(self, rows: DataFrame, kind: str, state: Snapshot, columns: list[T.StructField], rows_per_file: int = 0) -> str:
        name = f"{kind}/commit={state.version:010d}-{uuid.uuid4().hex}"
        out = rows.select(*(F.col(f.name).cast(f.dataType).alias(_physical(f)) for f in columns), F.lit(state.version).cast("bigint").alias(SEQ))
        by = []
        if kind == "data":
            kinds = {f.name: f for f in state.schema.fields}
            for t in state.partition:
                f = kinds[t.column]
                out = out.withColumn(t.name, t.value(F.col(_physical(f)), f.dataType))
                by.append(t.name)
            if state.sort or by:
                out = out.sortWithinPartitions(*by, *(_physical(kinds[k]) for k in state.sort))
        writer = out.write.format(state.format)
        if rows_per_file:
            writer = writer.option("maxRecordsPerFile", rows_per_file)
        try:
            (writer.partitionBy(*by) if by else writer).save(f"{self.folder}/{name}")
        except Exception:
            self.store.delete(name)
            raise
        return name

    def _row_bytes(self, state: Snapshot, folder: str, keys: list[T.StructField]) -> int:
        """About the bytes that a delete folder's rows take in memory: a word for each column and the row, and the keys' text."""
        texts = [F.coalesce(F.octet_length(F.col(_physical(f)).cast("string")), F.lit(0)) for f in keys if not isinstance(f.dataType, T.NumericType)]
        width = sum(texts, F.lit(8 * (len(keys) + 2)).cast("bigint"))
        return self._stored(state, [folder], keys, hidden=False).agg(F.sum(width)).first()[0] or 0

    def append(self, rows: DataFrame, batch_id: str | None = None, rows_per_file: int = 0) -> bool:
        """Add rows as a snapshot; False if the batch was committed before."""
        return self._attempt("append", batch_id, rows, None, rows_per_file)

    def row_delta(self, rows: DataFrame, deleted_keys: DataFrame, batch_id: str | None = None, rows_per_file: int = 0) -> bool:
        """Delete keys of earlier snapshots and add rows, as one snapshot."""
        return self._attempt("overwrite", batch_id, rows, deleted_keys, rows_per_file)

    def overwrite(self, rows: DataFrame, batch_id: str | None = None) -> bool:
        """Replace all rows."""
        return self._attempt("replace", batch_id, rows, None, 0, clear=True)

    def _attempt(self, operation, batch_id, rows, deleted, rows_per_file, clear=False, tries: int = 5) -> bool:
        for _ in range(tries):
            if self.committed(batch_id):
                return False
            state = self._next(operation, batch_id)
            data, deletes, sizes = ([], [], {}) if clear else (list(state.data), list(state.deletes), dict(state.delete_bytes))
            made = []
            try:
                if rows is not None:
                    made.append(self._write(rows, "data", state, state.schema.fields, rows_per_file))
                    data.append(made[-1])
                if deleted is not None:
                    keys = [f for f in state.schema.fields if f.name in state.keys]
                    made.append(self._write(deleted, "deletes", state, keys))
                    deletes.append(made[-1])
                    sizes[made[-1]] = self._row_bytes(state, made[-1], keys)
                state.data, state.deletes, state.delete_bytes = data, deletes, sizes
                self._commit(state)
                return True
            except CommitConflict:  # written anew under the next number
                for name in made:
                    self.store.delete(name)
            except Exception:
                for name in made:
                    self.store.delete(name)
                raise
        raise CommitConflict(f"{self.folder}: gave up after {tries} tries")

    # --- reading

    def _stored(self, state: Snapshot, folders: list[str], fields: list[T.StructField], hidden: bool) -> DataFrame:
        schema = T.StructType([T.StructField(_physical(f), f.dataType, True) for f in fields] + [T.StructField(SEQ, T.LongType())])
        if hidden:
            kinds = {f.name: f.dataType for f in state.schema.fields}
            for t in state.partition:
                probe = self.spark.range(0).select(F.lit(None).cast(kinds[t.column]).alias("c"))
                schema.add(T.StructField(t.name, probe.select(t.value(F.col("c"), kinds[t.column]).alias("p")).schema[0].dataType))
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).format(state.format).option("basePath", f"{self.folder}/{folders[0].split('/')[0]}")
        return reader.load([f"{self.folder}/{f}" for f in folders])

    def _broadcastable(self, state: Snapshot) -> bool:
        """Whether the rows of all deletes are known to fit the threshold of a broadcast."""
        sizes = [state.delete_bytes.get(f) for f in state.deletes]
        return None not in sizes and sum(sizes) <= self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()

    def read(
        self, version: int | None = None, as_of_ms: int | None = None, where: Column | str | None = None,
        between: dict[str, tuple] | None = None, with_file: bool = False,
    ) -> DataFrame:
        """The rows of a snapshot.

        ``between``: column to (low, high), either None; it filters rows and prunes
        partitions by their hidden columns. Deletes are combined to the last of each
        key. Where their rows fit the threshold of a broadcast, the optimizer picks the
        join; else they are merged, as it goes by the files' size, and ORC has dense
        keys in a byte each.
        """
        state = self.snapshot(version, as_of_ms)
        rows = self._stored(state, state.data, state.schema.fields, hidden=True)
        kinds = {f.name: f for f in state.schema.fields}
        for name, (low, high) in (between or {}).items():
            for t in state.partition:
                if t.column == name and (p := t.prunes(kinds[name].dataType, low, high)) is not None:
                    rows = rows.where(p)
            for bound, op in ((low, "__ge__"), (high, "__le__")):
                if bound is not None:
                    rows = rows.where(getattr(F.col(_physical(kinds[name])), op)(F.lit(bound)))
        if state.deletes:
            keys = [kinds[k] for k in state.keys]
            gone = self._stored(state, state.deletes, keys, hidden=False)
            gone = gone.groupBy(*(F.col(_physical(k)).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.max(SEQ).alias("__gone"))
            match = F.lit(True)
            for i, k in enumerate(keys):
                match = match & F.col(_physical(k)).eqNullSafe(F.col(f"__k{i}"))
            gone = gone if self._broadcastable(state) else gone.hint("merge")
            rows = rows.join(gone, match & (F.col("__gone") > F.col(SEQ)), "left_anti")
        file = [F.col("_metadata.file_path").alias("file_path")] if with_file and not state.deletes else []
        out = rows.select(*(F.col(_physical(f)).alias(f.name) for f in state.schema.fields), *file)
        return out.where(where) if where is not None else out

    def snapshots(self) -> DataFrame:
        """(version, committed_at, operation, data_folders, delete_folders) of every commit."""
        rows = [(s.version, s.committed_ms, s.operation, len(s.data), len(s.deletes)) for s in map(self.snapshot, self.versions())]
        raw = self.spark.createDataFrame(rows, "version bigint, ms bigint, operation string, data_folders int, delete_folders int")
        return raw.select("version", F.timestamp_millis("ms").alias("committed_at"), "operation", "data_folders", "delete_folders")

    def history(self) -> DataFrame:
        """(made_current_at, version, parent_version, is_current)."""
        rows = self.snapshots()
        last = max(self.versions())
        return rows.select(
            F.col("committed_at").alias("made_current_at"), "version",
            F.when(F.col("version") > 0, F.col("version") - 1).alias("parent_version"), (F.col("version") == last).alias("is_current"),
        )

    def compact(self) -> None:
        """Rewrite the visible rows as one folder and drop the deletes; older snapshots stay readable."""
        self._attempt("compact", None, self.read(), None, 0, clear=True)


def load_namespace(spark: SparkSession, warehouse: str, namespace: str) -> list[str]:
    """Tables of a namespace (dots are levels)."""
    where = f"{warehouse.rstrip('/')}/{namespace.replace('.', '/')}"
    store = Store(spark, where)
    return [n for n in store.names("") if store.names(f"{n}/_log")]


def table_folder(warehouse: str, namespace: str, name: str) -> str:
    return f"{warehouse.rstrip('/')}/{namespace.replace('.', '/')}/{name}"
