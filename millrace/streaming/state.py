"""State tables: offsets and schema history; and the archive of raw events."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.partition import Transform
from millrace.options import Options
from millrace.sources.envelope import as_text
from millrace.sources.table import Table, table_folder

_STATE = "id string, {} string, record_insert_ts timestamp"


def _now() -> datetime:
    return datetime.now(timezone.utc)


def resolve_config(config: dict[str, str], prefix: str, sink_prefix: str) -> dict[str, str]:
    """A store's own entries, and the sink's where it has none."""
    own = {k[len(prefix) :]: v for k, v in config.items() if k.startswith(prefix)}
    return {k[len(sink_prefix) :]: v for k, v in config.items() if k.startswith(sink_prefix)} | own


class OffsetStore:
    """Source offsets, as one row of JSON that each save replaces."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.schema = spark.createDataFrame([], _STATE.format("offset_data")).schema
        self.table = Table.create(spark, folder, self.schema)
        self.data: dict[str, str | None] = self.load()

    def load(self) -> dict[str, str | None]:
        rows = self.table.read().limit(2).collect()
        if len(rows) > 1:
            raise ValueError("the offset table has more than one row")
        return json.loads(rows[0]["offset_data"]) if rows else {}

    def set(self, offsets: dict[str | None, str | None]) -> None:
        """Merge and save; null keys are skipped, null values stay."""
        self.data |= {k: v for k, v in offsets.items() if k is not None}
        row = (str(uuid.uuid4()), json.dumps(self.data, sort_keys=True), _now())
        self.table.overwrite(self.spark.createDataFrame([row], self.schema))

    def get(self, keys: list[str]) -> dict[str, str | None]:
        return {k: self.data.get(k) for k in keys}

    def import_file(self, path: str) -> None:
        """Offsets of a JSON map in a text file, if none are stored yet."""
        if not self.data:
            text = "\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect())
            self.set(json.loads(text))


class SchemaHistory:
    """Schema-change records, appended one by one and recovered in order."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.schema = spark.createDataFrame([], _STATE.format("history_data")).schema
        self.table = Table(spark, folder)
        self.running = True

    def initialize(self) -> None:
        Table.create(self.spark, self.folder, self.schema)

    def storage_exists(self) -> bool:
        return self.table.exists()

    def exists(self) -> bool:
        return self.storage_exists() and not self.table.read().limit(1).isEmpty()

    def record(self, document: dict | None) -> None:
        if document is None:
            return
        if not self.running:
            raise RuntimeError("the history is stopped")
        row = (str(uuid.uuid4()), json.dumps(document), _now())
        self.table.append(self.spark.createDataFrame([row], self.schema))

    def recover(self) -> Iterator[dict]:
        """All documents in order of insertion, up to the first null; empty ones are skipped."""
        for row in self.table.read().orderBy("record_insert_ts").toLocalIterator():
            if row["history_data"] is None:
                return
            if row["history_data"]:
                yield json.loads(row["history_data"])

    def import_file(self, path: str) -> None:
        """Documents of a file with one on each line."""
        lines = self.spark.read.text(path).where("trim(value) <> ''")
        self.initialize()
        rows = lines.select(F.expr("uuid()").alias("id"), F.col("value").alias("history_data"), F.lit(_now()).alias("record_insert_ts"))
        self.table.append(rows)


_STORES: dict[tuple[str, str], type] = {("offset", "table"): OffsetStore, ("history", "table"): SchemaHistory}


def register_store(role: str, name: str):
    """Make a store class known for ``offset`` or ``history``; a second one of that name is an error."""

    def add(cls: type) -> type:
        if (role, name) in _STORES:
            raise ValueError(f"there are two {role} stores named {name}")
        _STORES[role, name] = cls
        return cls

    return add


def open_store(spark: SparkSession, role: str, options: Options):
    """The offset or history store that the options name, over the table they name in the warehouse."""
    name, table = (options.offset_store, options.offset_table) if role == "offset" else (options.history_store, options.history_table)
    if (role, name) not in _STORES:
        raise ValueError(f"no {role} store named {name}")
    return _STORES[role, name](spark, table_folder(options.warehouse, options.table_namespace, table))


ARCHIVE = (
    "event_destination string, event_key_schema string, event_key_payload string, event_value_schema string, "
    "event_value_payload string, event_sink_epoch_ms bigint, event_sink_timestamptz timestamp"
)


def archive_rows(events: DataFrame, batch_seconds: int) -> DataFrame:
    """Raw events as archive rows; an absent schema or payload is the text null.

    The field named epoch_ms holds seconds, as readers of such archives expect.
    """

    def part(column: str, name: str):
        return F.coalesce(F.get_json_object(as_text(events, column), f"$.{name}"), F.lit("null"))

    return events.select(
        F.col("destination").alias("event_destination"),
        part("key", "schema").alias("event_key_schema"),
        part("key", "payload").alias("event_key_payload"),
        part("value", "schema").alias("event_value_schema"),
        part("value", "payload").alias("event_value_payload"),
        F.lit(batch_seconds).cast("bigint").alias("event_sink_epoch_ms"),
        F.timestamp_seconds(F.lit(batch_seconds)).alias("event_sink_timestamptz"),
    )


class Archive:
    """A table of raw events, partitioned by destination and hour."""

    def __init__(self, spark: SparkSession, folder: str):
        schema = spark.createDataFrame([], ARCHIVE).schema
        by = [Transform("identity", "event_destination"), Transform("hours", "event_sink_timestamptz")]
        self.table = Table.create(spark, folder, schema, partition=by)

    def handle_batch(self, events: DataFrame, batch_id: int | str, at: datetime | None = None) -> bool:
        return self.table.append(archive_rows(events, int((at or _now()).timestamp())), f"{batch_id}")
