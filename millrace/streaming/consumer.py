"""Batches of change events to tables: the engine's main path."""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from threading import Event

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import partition
from millrace.operators.route import table_name, without_heartbeats
from millrace.operators.transform import chain
from millrace.operators.writer import ARRIVAL, write_batch
from millrace.options import Options
from millrace.plans.schema_map import Mapped, map_schema
from millrace.sources.envelope import decode, decode_typed, project_json, project_typed, unwrapped_schema
from millrace.sources.table import Store, Table, table_folder

#: The columns that order the rows of files: time, path, and where a split begins.
FILE_ORDER = ("__file_time", "__file_path", "__file_start")
_LOG = logging.getLogger(__name__)

_WAITS: dict[str, type] = {}


def register_wait(cls: type) -> type:
    """Make a batch-wait strategy known by its class name; a second one is an error."""
    if cls.__name__ in _WAITS:
        raise ValueError(f"there are two wait strategies named {cls.__name__}")
    _WAITS[cls.__name__] = cls
    return cls


@register_wait
class NoBatchSizeWait:
    def __init__(self, options: Options):
        pass

    def keep_waiting(self, queued: int, waited_ms: int, snapshotting: bool = False) -> bool:
        return False


@register_wait
class MaxBatchSizeWait:
    """Wait until a batch is full, or the longest wait is over; never during a snapshot."""

    def __init__(self, options: Options):
        self.options = options

    def keep_waiting(self, queued: int, waited_ms: int, snapshotting: bool = False) -> bool:
        full = queued >= self.options.max_batch_size
        return not (snapshotting or full or waited_ms >= self.options.batch_size_wait_max_wait_ms)


def wait_strategy(options: Options):
    if options.batch_size_wait not in _WAITS:
        raise ValueError(f"no wait strategy named {options.batch_size_wait}")
    return _WAITS[options.batch_size_wait](options)


def arrival(events: DataFrame, upsert: bool) -> DataFrame:
    """``events`` with their order of arrival.

    A column of that name is taken as it is. Rows of files are ordered by the file's
    time, its path, and their place in it, as a batch's partitions hold files by size;
    records of a log by their offset, in which a key keeps to one partition. Other
    events have no order, so they can't be upserts.
    """
    if ARRIVAL in events.columns:
        return events
    place = F.monotonically_increasing_id()
    if set(FILE_ORDER) <= set(events.columns):
        return events.withColumn(ARRIVAL, F.struct(*FILE_ORDER, place.alias("place"))).drop(*FILE_ORDER)
    if {"partition", "offset"} <= set(events.columns):
        return events.withColumn(ARRIVAL, F.struct("offset", "partition"))
    if upsert:
        raise ValueError(f"an upsert needs the order of arrival: a column {ARRIVAL}, or a source of files or of log offsets")
    return events.withColumn(ARRIVAL, place)


class Consumer:
    """Writes batches of raw events (destination, key, value) to the tables of a warehouse."""

    def __init__(
        self, spark: SparkSession, options: Options, lineage: Callable[[dict], None] | None = None,
        snapshotting: Callable[[], bool] = lambda: False,
    ):
        if not options.warehouse:
            raise ValueError("the option warehouse is required")
        self.spark, self.options, self.lineage, self.snapshotting = spark, options, lineage, snapshotting
        self.run_id = uuid.uuid4().hex
        #: What was done since the start, and whether the last batch succeeded.
        self.metrics = {"batches": 0, "events": 0, "commits": 0, "last_commit_ms": 0, "healthy": True}
        self._logged = 0.0
        self._rows = 0

    def table(self, name: str) -> Table:
        return Table(self.spark, table_folder(self.options.warehouse, self.options.table_namespace, name))

    def handle_batch(self, events: DataFrame, batch_id: int | str) -> dict[str, bool]:
        """Commit a batch; table name to whether it was committed now.

        Each table takes one snapshot under the batch id, so a batch that is replayed
        after a failure is written once to each. All destinations that map to one
        table are one group, deduplicated together. Events are decoded once; the
        driver sees a row for each table and schema.
        """
        try:
            done = self._handled(events, f"{batch_id}")
        except Exception:
            self.metrics["healthy"] = False
            raise
        self.metrics["healthy"] = True
        self.metrics["batches"] += 1
        self.metrics["commits"] += sum(done.values())
        self.metrics["last_commit_ms"] = int(time.time() * 1000)
        return done

    def _handled(self, events: DataFrame, batch_id: str) -> dict[str, bool]:
        options = self.options
        events = chain(without_heartbeats(arrival(events, options.upsert), options), options)
        rows = decode(events) if options.format_value == "json" else decode_typed(events)
        rows = rows.withColumns(
            {"__table": table_name(F.col("destination"), options), "__schema": F.xxhash64("value_schema", "key_schema")}
        )
        kept = ["__table", "__schema", "destination", "value_schema", "key_schema", "value_payload", "key_payload", ARRIVAL]
        rows = rows.select(*kept).persist()
        try:
            found = rows.groupBy("__table", "__schema").agg(
                F.min("destination").alias("destination"), F.first("value_schema").alias("value_schema"), F.first("key_schema").alias("key_schema"),
                F.min(ARRIVAL).alias("first"), F.count("*").alias("events"),
            )
            groups: dict[str, list] = {}
            for r in found.orderBy("__table", "first").collect():
                groups.setdefault(r["__table"], []).append(r)
            n = sum(r["events"] for g in groups.values() for r in g)
            self.metrics["events"] += n
            if line := self.progress(n):
                _LOG.info(line)

            def one(name: str) -> bool:
                return self._process(name, groups[name], rows.where(F.col("__table") == name), batch_id)

            if options.concurrent_uploads <= 1:
                return {name: one(name) for name in groups}
            return self._together(list(groups), one)
        finally:
            rows.unpersist()

    def _together(self, names: list[str], one: Callable[[str], bool]) -> dict[str, bool]:
        """Tables written side by side; the first failure, or the time limit, ends the batch and its jobs."""
        context, tag = self.spark.sparkContext, f"batch-{uuid.uuid4().hex}"

        def tagged(name: str) -> bool:
            context.setJobGroup(tag, f"table {name}", True)
            return one(name)

        pool = ThreadPoolExecutor(self.options.concurrent_uploads)
        jobs = {name: pool.submit(inheritable_thread_target(self.spark)(tagged), name) for name in names}
        done, open_ = wait(jobs.values(), self.options.concurrent_uploads_timeout_minutes * 60, FIRST_EXCEPTION)
        pool.shutdown(wait=not open_, cancel_futures=True)
        if open_:
            context.cancelJobGroup(tag)
        for job in done:
            job.result()  # the first failure fails the batch
        if open_:
            raise TimeoutError(f"{len(open_)} tables weren't written in time")
        return {name: job.result() for name, job in jobs.items()}

    def _process(self, name: str, groups: list, rows: DataFrame, batch_id: str) -> bool:
        options = self.options
        wires, mapped = {}, {}
        for r in groups:
            if r["value_schema"] is not None:
                value = json.loads(r["value_schema"])
                flat = unwrapped_schema(value, options)
                wires[r["__schema"]] = flat is not None
                mapped[r["__schema"]] = map_schema(flat or value, r["key_schema"], options)
        table = self.table(name)
        if not table.exists():
            if not mapped:
                raise ValueError(f"{name}: no event has a schema, so the table can't be created")
            self._create(name, groups[0]["destination"], next(iter(mapped.values())))
        if options.allow_field_addition:
            for m in mapped.values():
                table.evolve(m.schema)
        now = table.snapshot().schema
        project = project_json if options.format_value == "json" else project_typed
        parts = []
        for r in groups:
            key = r["__schema"]
            own = {f.name: f for f in (mapped[key].schema if key in mapped else now).fields}
            target = T.StructType([T.StructField(f.name, f.dataType, True, own[f.name].metadata if f.name in own else f.metadata) for f in now.fields])
            parts.append(project(rows.where(F.col("__schema") == key), target, options, "value_payload", (ARRIVAL,), wires.get(key, False)))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        done = write_batch(table, every, options, batch_id)
        self._emit(name, table, batch_id, sum(r["events"] for r in groups))
        return done

    def _create(self, name: str, destination: str, mapped: Mapped) -> Table:
        options = self.options
        entries, strict = options.partition_spec(destination)
        return Table.create(
            self.spark,
            table_folder(options.warehouse, options.table_namespace, name),
            mapped.schema,
            mapped.keys,
            mapped.sort,
            partition.spec(entries, mapped.schema, strict),
            options.write_format_default,
            {"format_version": "3" if options.nested_as_variant else str(options.format_version)},
        )

    def _emit(self, name: str, table: Table, batch_id: str, events: int) -> None:
        """Tell the lineage callback what was written; its failures don't matter."""
        if self.options.lineage_enabled and self.lineage:
            try:
                now = table.snapshot()
                fields = [{"name": f.name, "type": f.dataType.simpleString()} for f in now.schema.fields]
                about = {"run": {"id": self.run_id, "batch": batch_id}, "job": {"namespace": self.options.table_namespace, "name": self.options.catalog_name}}
                self.lineage({"table": name, "fields": fields, "version": now.version, "events": events, **about})
            except Exception:
                pass

    def progress(self, rows: int, every_s: int = 900) -> str | None:
        """A line about the rows since the last line, at most every ``every_s`` seconds."""
        self._rows += rows
        now = time.monotonic()
        if now - self._logged < every_s and self._logged:
            return None
        self._logged, n = now, self._rows
        self._rows = 0
        return f"received {n} events"

    def start(self, stream: DataFrame, checkpoint: str, available_now: bool = False):
        """Run as a streaming query. A batch is acknowledged after all its tables are committed.

        Batch numbers begin anew with each checkpoint, so the checkpoint is part of the id.
        """
        writer = with_file_order(stream).writeStream.option("checkpointLocation", checkpoint)
        writer = writer.foreachBatch(lambda df, i: self.handle_batch(df, f"{checkpoint}#{i}") and None)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def follow(self, folder: str, checkpoint: str, stopped: Event, rounds: int | None = None) -> int:
        """Consume a folder of change-log files as they arrive, until ``stopped`` is set; the batches run.

        Before each batch the wait strategy is asked, every wait interval, whether to go
        on waiting for more events; what waits is counted from files not seen so far.
        """
        strategy, options, done = wait_strategy(self.options), self.options, 0
        pause = options.batch_size_wait_wait_interval_ms / 1000
        seen: set[str] = set()
        while not stopped.is_set() and (rounds is None or done < rounds):
            queued, start = 0, time.monotonic()
            while True:
                files = {p for p in Store(self.spark, folder).names("") if not p.startswith(("_", "."))} - seen
                seen |= files
                if files:
                    queued += self.spark.read.text([f"{folder.rstrip('/')}/{p}" for p in sorted(files)]).count()
                waited = int((time.monotonic() - start) * 1000)
                if stopped.is_set() or (queued and not strategy.keep_waiting(queued, waited, self.snapshotting())):
                    break
                if stopped.wait(pause):
                    break
            if queued:
                self.start(event_stream(self.spark, folder), checkpoint, available_now=True).awaitTermination()
                done += 1
        return done


def with_file_order(stream: DataFrame) -> DataFrame:
    """A stream of files with the columns that order its rows; others as they are."""
    if ARRIVAL in stream.columns:
        return stream
    try:
        return stream.select(
            "*", F.col("_metadata.file_modification_time").alias(FILE_ORDER[0]), F.col("_metadata.file_path").alias(FILE_ORDER[1]),
            F.col("_metadata.file_block_start").alias(FILE_ORDER[2]),
        )
    except AnalysisException:  # not a source of files
        return stream


def event_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of change-log files: JSON lines of destination, key, value."""
    reader = spark.readStream.schema("destination string, key string, value string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)
