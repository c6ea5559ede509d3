"""More registered queries: the consumer's paths, typed values, and what the engine refuses or keeps.

They add to the tables of ``catalogue``; a query whose answer doesn't depend on the
data compares with the values it must give.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import coerce
from millrace.operators.partition import parse, spec
from millrace.operators.writer import ARRIVAL
from millrace.options import Options, config_subset, mask_secrets
from millrace.plans.catalogue import _ORDER, _ORDER_KEY, _ORDER_SQL, SQL, order_events, query, read
from millrace.plans.schema_map import field_ids, is_schema_change, map_schema, rooted_keys, struct_schema
from millrace.sources.envelope import has_key, unwrapped_schema
from millrace.sources.table import Table, load_namespace
from millrace.sources.workspace import workspace
from millrace.streaming.consumer import Consumer, event_stream, wait_strategy
from millrace.streaming.state import Archive, open_store, resolve_config


def _values(columns: str, *rows: tuple) -> str:
    """The SQL of a few rows."""

    def one(x) -> str:
        return "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) t({columns})"


def _seventh():
    return (F.col("o_orderkey") % 7).cast("int")


def _json(spark, **more) -> Options:
    return Options(warehouse=workspace(spark, "warehouse"), format_key="json", format_value="json", **more)


def _refused(spark, *cases) -> DataFrame:
    """(case, refused) for functions that must raise."""
    rows = []
    for name, f in cases:
        try:
            f()
            rows.append((name, False))
        except Exception:
            rows.append((name, True))
    return spark.createDataFrame(rows, "what string, refused boolean")


# --- the consumer


@query("stream_file_order", "SELECT o_orderkey, o_orderstatus, 'u' AS __op FROM orders")
def stream_file_order(spark, sf_dir):
    """Two files in one micro-batch, the later one larger: its rows win."""
    base = workspace(spark, "file-order")
    orders = read(spark, sf_dir, "orders")
    for status, op, pad in ((F.lit("old"), "c", 0), (F.col("o_orderstatus"), "u", 400)):
        payload = F.struct("o_orderkey", status.alias("o_orderstatus"), F.lit(op).alias("__op"), F.lit("x" * pad).alias("pad"))
        fields = [f for f in _ORDER["fields"] if f["field"] in ("o_orderkey", "o_orderstatus", "__op")]
        text = F.concat(F.lit('{"schema": ' + json.dumps({"type": "struct", "fields": fields}) + ', "payload": '), F.to_json(payload), F.lit("}"))
        key = F.concat(F.lit('{"schema": ' + json.dumps(_ORDER_KEY) + ', "payload": '), F.to_json(F.struct("o_orderkey")), F.lit("}"))
        orders.select(F.lit("a").alias("destination"), key.alias("key"), text.alias("value")).coalesce(1).write.mode("append").json(f"{base}/in")
    consumer = Consumer(spark, _json(spark, upsert=True))
    consumer.start(event_stream(spark, f"{base}/in"), f"{base}/checkpoint", available_now=True).awaitTermination()
    return consumer.table("a").read()


def _row_fields():
    return [f for f in _ORDER["fields"] if not f["field"].startswith("__")]


_ENVELOPE = {
    "type": "struct",
    "fields": [
        {"field": "before", "type": "struct", "fields": _row_fields()}, {"field": "after", "type": "struct", "fields": _row_fields()},
        {"field": "source", "type": "struct", "fields": [{"field": "table", "type": "string"}, {"field": "ts_ms", "type": "int64"}]},
        {"field": "op", "type": "string"}, {"field": "ts_ms", "type": "int64"},
    ],
}


def _changes(spark, sf_dir) -> DataFrame:
    """orders as (o_orderkey, before, after, source, op, ts_ms): all created, every fifth deleted."""
    rows = read(spark, sf_dir, "orders").withColumn("o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp")))
    row = F.struct(*(f["field"] for f in _row_fields()))
    made = rows.select("o_orderkey", F.when(F.lit(False), row).alias("before"), row.alias("after"), F.lit("c").alias("op"), F.lit(0).alias("at"))
    gone = rows.where("o_orderkey % 5 = 0").select("o_orderkey", row.alias("before"), F.when(F.lit(False), row).alias("after"), F.lit("d").alias("op"), F.lit(1).alias("at"))
    source = F.struct(F.lit("orders").alias("table"), (F.col("o_orderkey") * 1000).alias("ts_ms"))
    return made.unionByName(gone).withColumns(
        {"source": source, "ts_ms": F.col("o_orderkey") * 1000 + 1, ARRIVAL: F.col("at") * 10_000_000_000 + F.col("o_orderkey")}
    )


def _enveloped(spark, sf_dir) -> DataFrame:
    """The same as raw JSON events, a tombstone after each delete."""

    def text(schema, body):
        return F.concat(F.lit('{"schema": ' + json.dumps(schema) + ', "payload": '), F.to_json(body), F.lit("}"))

    changes = _changes(spark, sf_dir)
    value = text(_ENVELOPE, F.struct("before", "after", "source", "op", "ts_ms"))
    events = changes.select(F.lit("e").alias("destination"), text(_ORDER_KEY, F.struct("o_orderkey")).alias("key"), value.alias("value"), ARRIVAL, "op")
    tombs = events.where("op = 'd'").select("destination", "key", F.lit(None).cast("string").alias("value"), (F.col(ARRIVAL) + 5_000_000_000).alias(ARRIVAL))
    return events.drop("op").unionByName(tombs)


_UNWRAPPED = _ORDER_SQL.format(
    "CASE WHEN o_orderkey % 5 = 0 THEN 'd' ELSE 'c' END AS __op, 'orders' AS __table, make_timestamp(o_orderkey * 1000000) AS __source_ts_ms, o_orderkey % 5 = 0 AS __deleted", "{}"
)


def _zoned_as_utc(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


@query("consume_unwrap", _UNWRAPPED.format(""))
def consume_unwrap(spark, sf_dir):
    consumer = Consumer(spark, _json(spark, upsert=True, add_fields=["op", "table", "source.ts_ms"]))
    consumer.handle_batch(_enveloped(spark, sf_dir), 1)
    return _zoned_as_utc(consumer.table("e").read(), "__source_ts_ms")


@query("consume_unwrap_delete_drop", "SELECT o_orderkey, 'c' AS __op FROM orders")
def consume_unwrap_delete_drop(spark, sf_dir):
    consumer = Consumer(spark, _json(spark, upsert=True, delete_mode="drop", add_fields=["op"]))
    consumer.handle_batch(_enveloped(spark, sf_dir), 1)
    return consumer.table("e").read().select("o_orderkey", "__op")


@query("consume_nested", "SELECT o_orderkey, 'c' AS op, o_orderkey * 1000 AS at FROM orders UNION ALL SELECT o_orderkey, 'd', o_orderkey * 1000 FROM orders WHERE o_orderkey % 5 = 0")
def consume_nested(spark, sf_dir):
    """Envelopes that aren't unwrapped: nested columns, no keys."""
    consumer = Consumer(spark, _json(spark, unwrap=False, create_identifier_fields=False))
    consumer.handle_batch(_enveloped(spark, sf_dir).where("value IS NOT NULL"), 1)
    return consumer.table("e").read().select(F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey"), "op", F.col("source.ts_ms").alias("at"))


@query("consume_connect", _UNWRAPPED.format("").replace("o_orderdate::TIMESTAMP AS o_orderdate", "epoch_us(o_orderdate::TIMESTAMP) AS o_orderdate"))
def consume_connect(spark, sf_dir):
    """The same changes as typed records: key and value are structs."""
    events = _changes(spark, sf_dir).select(
        F.lit("e").alias("destination"), F.struct("o_orderkey").alias("key"), F.struct("before", "after", "source", "op", "ts_ms").alias("value"), ARRIVAL
    )
    options = Options(warehouse=workspace(spark, "warehouse"), upsert=True, add_fields=["op", "table", "source.ts_ms"])
    consumer = Consumer(spark, options)
    consumer.handle_batch(events, 1)
    return _zoned_as_utc(consumer.table("e").read(), "__source_ts_ms")


@query("connect_typed_values", "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, o_orderdate::TIMESTAMP AS at, o_orderstatus AS first_tag, o_custkey AS in_map, CAST(o_orderkey % 7 AS INTEGER) AS in_struct FROM orders")
def connect_typed_values(spark, sf_dir):
    """Decimals, zoned times, lists, maps and structs of typed records, through the consumer."""
    orders = read(spark, sf_dir, "orders")
    value = F.struct(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price"), F.col("o_orderdate").cast("timestamp_ntz").cast("timestamp").alias("at"),
        F.array("o_orderstatus", F.lit(None)).alias("tags"), F.create_map(F.lit("c"), "o_custkey").alias("m"), F.struct(_seventh().alias("seventh")).alias("s"),
    )
    consumer = Consumer(spark, Options(warehouse=workspace(spark, "warehouse")))
    consumer.handle_batch(orders.select(F.lit("t").alias("destination"), F.struct("o_orderkey").alias("key"), value.alias("value")), 1)
    rows = consumer.table("t").read()
    return rows.select("o_orderkey", F.col("price").cast("double").alias("price"), F.col("at").cast("timestamp_ntz").alias("at"), F.col("tags")[0].alias("first_tag"), F.col("m")["c"].alias("in_map"), F.col("s.seventh").alias("in_struct"))


@query("consume_transforms", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def consume_transforms(spark, sf_dir):
    config = {
        "transforms": "unwrap,route,some", "transforms.unwrap.type": "x.ExtractNewRecordState", "transforms.route.type": "x.RegexRouter",
        "transforms.route.regex": r"srv\.sales\.(.*)", "transforms.route.replacement": "$1", "transforms.some.type": "Filter",
        "transforms.some.condition": "__arrival % 2 = 0 AND __arrival < 10000000000", "format_key": "json", "format_value": "json", "warehouse": workspace(spark, "warehouse"),
    }
    consumer = Consumer(spark, Options.from_properties(config))
    consumer.handle_batch(order_events(spark, sf_dir), 1)
    return consumer.table("orders").read().select("o_orderkey")


@query("consume_concurrent", "SELECT 's_' || lower(o_orderstatus) AS name, count(*) AS n FROM orders GROUP BY 1")
def consume_concurrent(spark, sf_dir):
    """A table a status, written side by side."""
    status = F.get_json_object("value", "$.payload.o_orderstatus")
    events = order_events(spark, sf_dir).withColumn("destination", F.concat(F.lit("s."), status))
    consumer = Consumer(spark, _json(spark, upsert=True, concurrent_uploads=4, destination_lowercase_table_names=True))
    out = None
    for name in sorted(consumer.handle_batch(events, 1)):
        n = consumer.table(name).read().agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


@query("consume_two_schemas", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 7 AS INTEGER) + 1 END AS extra FROM orders")
def consume_two_schemas(spark, sf_dir):
    """Events of two schemas in one batch: the table takes the union, each event its own fields."""
    out = None
    for more, condition in ((False, "o_orderkey % 3 <> 0"), (True, "o_orderkey % 3 = 0")):
        extra = [{"field": "extra", "type": "int32", "optional": True}] if more else []
        schema = {"type": "struct", "fields": _ORDER["fields"][:1] + extra}
        body = F.to_json(F.struct("o_orderkey", *([(_seventh() + 1).alias("extra")] if more else [])))
        rows = read(spark, sf_dir, "orders").where(condition)
        events = rows.select(F.lit("t").alias("destination"), F.lit(None).cast("string").alias("key"), F.concat(F.lit('{"schema": ' + json.dumps(schema) + ', "payload": '), body, F.lit("}")).alias("value"))
        out = events if out is None else out.unionByName(events)
    consumer = Consumer(spark, _json(spark))
    consumer.handle_batch(out, 1)
    return consumer.table("t").read().select("o_orderkey", "extra")


@query("consume_field_addition_off", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 <> 0")
def consume_field_addition_off(spark, sf_dir):
    """The option: columns that a later schema adds are left out."""
    options = _json(spark, upsert=True, upsert_keep_deletes=False, allow_field_addition=False)
    narrow = _json(spark, excluded_columns=["o_orderstatus", "o_totalprice", "o_orderdate"])
    options.warehouse = narrow.warehouse
    Consumer(spark, narrow).handle_batch(order_events(spark, sf_dir).where("__arrival < 0"), 0)
    consumer = Consumer(spark, narrow)
    consumer.handle_batch(order_events(spark, sf_dir).where("__arrival < 10"), 1)
    wide = Consumer(spark, options)
    wide.handle_batch(order_events(spark, sf_dir), 2)
    return wide.table("srv_sales_orders").read().select("o_orderkey", "o_custkey")


@query("partition_by_table", "SELECT year(o_orderdate) - 1970 AS p, count(*) AS n FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1")
def partition_by_table(spark, sf_dir):
    """A destination's own partitions, as its files are laid out."""
    options = _json(spark, upsert=True, upsert_keep_deletes=False, partition_by_table={"srv.sales.orders": ["year(o_orderdate)"]})
    consumer = Consumer(spark, options)
    consumer.handle_batch(order_events(spark, sf_dir), 1)
    table = consumer.table("srv_sales_orders")
    state = table.snapshot()
    hidden = state.partition[0].name
    return table._stored(state, state.data, state.schema.fields, hidden=True).groupBy(F.col(hidden).alias("p")).agg(F.count("*").alias("n"))


@query("lineage_and_metrics", "SELECT 'srv_sales_orders' AS name, 7 AS fields, count(*) + count(*) FILTER (o_orderkey % 5 = 0) AS events, 1 AS commits, true AS healthy FROM orders")
def lineage_and_metrics(spark, sf_dir):
    told = []
    consumer = Consumer(spark, _json(spark, lineage_enabled=True), told.append)
    consumer.handle_batch(order_events(spark, sf_dir), 1)
    row = (told[0]["table"], len(told[0]["fields"]), told[0]["events"], consumer.metrics["commits"], consumer.metrics["healthy"])
    return spark.createDataFrame([row], "name string, fields int, events bigint, commits int, healthy boolean")


# --- typed and JSON values


@query("typed_numbers", "SELECT CAST(o_orderkey AS BIGINT) AS a, o_totalprice AS b, o_orderstatus = 'F' AS c, CAST(o_custkey AS VARCHAR) AS d, CAST(o_orderkey % 7 AS INTEGER) AS e FROM orders")
def typed_numbers(spark, sf_dir):
    """Numbers, booleans and texts of typed records, from texts and numbers."""
    rows = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("a"), F.col("o_totalprice").cast("string").alias("b"),
        F.when(F.col("o_orderstatus") == "F", "TRUE").otherwise("no").alias("c"), F.col("o_custkey").alias("d"), _seventh().cast("bigint").alias("e"),
    )
    kinds = {"a": T.LongType(), "b": T.DoubleType(), "c": T.BooleanType(), "d": T.StringType(), "e": T.IntegerType()}
    return rows.select(*(coerce.from_typed(F.col(n), rows.schema[n].dataType, k, {}, Options(), n).alias(n) for n, k in kinds.items()))


@query("temporal_zoned", "SELECT o_orderkey, o_orderdate::TIMESTAMP - INTERVAL 2 HOUR AS a, make_timestamp(o_orderkey * 1000000) AS __ts_ms FROM orders")
def temporal_zoned(spark, sf_dir):
    """Zoned ISO texts, and the epoch milliseconds of ``__ts_ms``, from JSON."""
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.parse_json(F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("a"), (F.col("o_orderkey") * 1000).alias("__ts_ms")))).alias("doc"),
    )

    def value(name, wire):
        return coerce.from_json(coerce.member(F.col("doc"), name), T.TimestampType(), wire, Options(), name).cast("timestamp_ntz").alias(name)

    return rows.select("o_orderkey", value("a", {"name": "time.ZonedTimestamp"}), value("__ts_ms", {}))


@query("json_nested_values", "SELECT o_orderkey, o_custkey AS item, o_orderstatus AS in_map, CAST(o_orderkey % 7 AS INTEGER) AS in_struct, CAST(2 AS INTEGER) AS n FROM orders")
def json_nested_values(spark, sf_dir):
    """Lists, maps and structs of JSON documents."""
    body = F.struct(F.array("o_custkey", F.lit(None)).alias("l"), F.create_map(F.lit("k"), "o_orderstatus").alias("m"), F.struct(_seventh().alias("seventh")).alias("s"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.parse_json(F.to_json(body)).alias("doc"))
    kinds = {"l": T.ArrayType(T.LongType()), "m": T.MapType(T.StringType(), T.StringType()), "s": T.StructType([T.StructField("seventh", T.IntegerType())])}
    out = rows.select("o_orderkey", *(coerce.from_json(coerce.member(F.col("doc"), n), k, {}, Options(), n).alias(n) for n, k in kinds.items()))
    return out.select("o_orderkey", F.col("l")[0].alias("item"), F.col("m")["k"].alias("in_map"), F.col("s.seventh").alias("in_struct"), F.size("l").alias("n"))


@query("struct_to_variant", "SELECT o_orderkey, o_custkey, o_orderstatus AS status FROM orders")
def struct_to_variant(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", F.struct("o_custkey", F.struct("o_orderstatus").alias("s")).alias("r"))
    v = rows.select("o_orderkey", coerce.from_typed(F.col("r"), rows.schema["r"].dataType, T.VariantType(), {}, Options()).alias("v"))
    return v.select("o_orderkey", F.variant_get("v", "$.o_custkey", "bigint").alias("o_custkey"), F.variant_get("v", "$.s.o_orderstatus", "string").alias("status"))


@query("offset_text", _values("v", ("a é",)))
def offset_text(spark, sf_dir):
    return spark.createDataFrame([(bytearray("a é".encode()),)], "b binary").select(coerce.text_of(F.col("b")).alias("v"))


# --- schemas


@query("connect_schema", _values("column_name, type", ("a", "bigint"), ("b", "decimal(10,3)"), ("c", "date"), ("d", "timestamp"), ("e", "timestamp_ntz"), ("f", "array<struct<x:int>>"), ("g", "map<string,double>"), ("h", "binary")))
def connect_schema(spark, sf_dir):
    kinds = "a bigint, b decimal(10,3), c date, d timestamp, e timestamp_ntz, f array<struct<x:int>>, g map<string,double>, h binary"
    schema = map_schema(struct_schema(spark.createDataFrame([], kinds).schema), None, Options()).schema
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "column_name string, type string")


@query("rooted_key_paths", _values("event, path", ("flat", "o_orderkey"), ("nested", "after.o_orderkey")))
def rooted_key_paths(spark, sf_dir):
    rows = [(n, p) for n, v in (("flat", _ORDER), ("nested", _ENVELOPE)) for p in rooted_keys(v, _ORDER_KEY)]
    return spark.createDataFrame(rows, "event string, path string")


@query("field_id_order", _values("path, id", ("a", 1), ("b", 2), ("b.x", 3), ("c", 4), ("c.element.y", 6), ("c.element", 7), ("d", 8)))
def field_id_order(spark, sf_dir):
    value = {"fields": [{"field": "a", "type": "int32"}, {"field": "b", "type": "struct", "fields": [{"field": "x", "type": "int32"}]}, {"field": "c", "type": "array", "items": {"type": "struct", "fields": [{"field": "y", "type": "int32"}]}}, {"field": "d", "type": "string"}]}
    return spark.createDataFrame(list(field_ids(value).items()), "path string, id int")


@query("unwrapped_columns", _values("name", *(((f["field"],) for f in _row_fields())), ("__op",), ("__source_ts_ms",), ("__deleted",)))
def unwrapped_columns(spark, sf_dir):
    fields = unwrapped_schema(_ENVELOPE, Options(add_fields=["op", "source.ts_ms", "nothing"]))["fields"]
    return spark.createDataFrame([(f["field"],) for f in fields], "name string")


@query("schema_change_events", _values("event, is_change", ("row", False), ("ddl", True)))
def schema_change_events(spark, sf_dir):
    ddl = {"fields": [{"field": n, "type": "string"} for n in ("source", "databaseName", "ddl", "tableChanges")]}
    return spark.createDataFrame([("row", is_schema_change(_ORDER)), ("ddl", is_schema_change(ddl))], "event string, is_change boolean")


@query("sort_order", _values("name", ("o_orderkey",)))
def sort_order(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in map_schema(_ORDER, _ORDER_KEY, Options()).sort], "name string")


@query("has_key_data", "SELECT count(*) AS with_key, 1 AS without FROM region")
def has_key_data(spark, sf_dir):
    keys = read(spark, sf_dir, "region").select(F.col("r_name").alias("key_payload")).unionByName(spark.createDataFrame([(None,)], "key_payload string"))
    return keys.agg(F.count_if(has_key()).alias("with_key"), F.count_if(~has_key()).cast("int").alias("without"))


# --- options, refusals


@query("config_entries", _values("k, v", ("a", "1"), ("b.c", "2")))
def config_entries(spark, sf_dir):
    return spark.createDataFrame(list(config_subset({"x.a": "1", "x.b.c": "2", "y.a": "3"}, "x.").items()), "k string, v string")


@query("config_fallback", _values("k, v", ("x", "1"), ("y", "3")))
def config_fallback(spark, sf_dir):
    found = resolve_config({"own.x": "1", "sink.x": "2", "sink.y": "3"}, "own.", "sink.")
    return spark.createDataFrame(sorted(found.items()), "k string, v string")


@query("masked_options", _values("k, v", ("db.password", "*****"), ("s3.secret-access-key", "*****"), ("warehouse", "w")))
def masked_options(spark, sf_dir):
    shown = mask_secrets({"db.password": "p", "s3.secret-access-key": "k", "warehouse": "w"})
    return spark.createDataFrame(list(shown.items()), "k string, v string")


@query("refused_partitions", _values("what, refused", ("no width", True), ("unknown", True), ("missing column", True), ("missing column, shared", False)))
def refused_partitions(spark, sf_dir):
    schema = read(spark, sf_dir, "region").schema
    return _refused(
        spark, ("no width", lambda: parse("bucket(a)")), ("unknown", lambda: parse("weeks(a)")),
        ("missing column", lambda: spec(["nothing"], schema, True)), ("missing column, shared", lambda: spec(["nothing"], schema, False)),
    )


@query("refused_options", _values("what, refused", ("mixed formats", True), ("avro", True), ("adaptive times", True), ("wait interval", True), ("no such wait", True), ("defaults", False)))
def refused_options(spark, sf_dir):
    return _refused(
        spark, ("mixed formats", lambda: Options(format_key="json")), ("avro", lambda: Options(write_format_default="avro")),
        ("adaptive times", lambda: Options(time_precision_mode="adaptive")), ("wait interval", lambda: Options(batch_size_wait_wait_interval_ms=300_000)),
        ("no such wait", lambda: wait_strategy(Options(batch_size_wait="Nothing"))), ("defaults", Options),
    )


@query("refused_events", _values("what, refused", ("null key of an upsert", True), ("unknown operation", True), ("null value", True), ("text as connect", True), ("no order of an upsert", True), ("no schema for a new table", True)))
def refused_events(spark, sf_dir):
    """What a batch may not hold; none of them is committed."""

    def batch(key='{"id": 1}', op="c", value="{}", **options):
        fields = [{"field": "id", "type": "int32"}, {"field": "__op", "type": "string"}]
        body = value if value is None else json.dumps({"schema": {"type": "struct", "fields": fields}, "payload": {"id": json.loads(key)["id"], "__op": op}})
        keys = json.dumps({"schema": {"type": "struct", "fields": fields[:1]}, "payload": json.loads(key)})
        rows = spark.createDataFrame([("t", keys, body, 1)], f"destination string, key string, value string, {ARRIVAL} bigint")
        drop = options.pop("without_order", False)
        form = options.pop("form", "json")
        Consumer(spark, Options(warehouse=workspace(spark, "refused"), format_key=form, format_value=form, upsert=True, **options)).handle_batch(rows.drop(ARRIVAL) if drop else rows, 1)

    return _refused(
        spark, ("null key of an upsert", lambda: batch('{"id": null}')), ("unknown operation", lambda: batch(op="x")),
        ("null value", lambda: batch(value=None, drop_tombstones=False)), ("text as connect", lambda: batch(form="connect")),
        ("no order of an upsert", lambda: batch(without_order=True)), ("no schema for a new table", lambda: batch(value=None)),
    )


@query("aborted_append", "SELECT count(*) AS n, 0 AS folders FROM region")
def aborted_append(spark, sf_dir):
    """A write that fails leaves no folder, and the table as it was."""
    rows = read(spark, sf_dir, "region")
    table = Table.create(spark, workspace(spark, "aborted"), rows.schema)
    try:
        table.append(rows.withColumn("r_name", F.when(F.col("r_regionkey") >= 0, F.raise_error(F.lit("no"))).otherwise(F.col("r_name"))))
    except Exception:
        pass
    left = len(table.store.names("data"))
    table.append(rows)
    return table.read().agg(F.count("*").alias("n"), F.lit(left).alias("folders"))


# --- state tables, namespaces, files


@query("offset_import", _values("k, v", ("a", "1"), ("b", "2")))
def offset_import(spark, sf_dir):
    """A JSON map of offsets fills an empty store, and one that holds offsets stays."""
    folder = workspace(spark, "import")
    for i, body in enumerate(('{"a": "1", "b": "2"}', '{"a": "9"}')):
        spark.createDataFrame([(body,)], "value string").coalesce(1).write.text(f"{folder}/{i}")
    store = open_store(spark, "offset", Options(warehouse=folder))
    for i in range(2):
        store.import_file(f"{folder}/{i}")
    return store.table.read().select(F.explode(F.from_json("offset_data", "map<string,string>")).alias("k", "v"))


@query("history_recovered", _values("n", (0,), (1,)))
def history_recovered(spark, sf_dir):
    """Documents of a file and one more, recovered in order; nothing is there before."""
    options = Options(warehouse=workspace(spark, "history"))
    history = open_store(spark, "history", options)
    assert not history.exists() and not history.storage_exists()
    spark.createDataFrame([('{"n": 0}',), ("",)], "value string").coalesce(1).write.text(f"{options.warehouse}/old")
    history.import_file(f"{options.warehouse}/old")
    history.record({"n": 1})
    return spark.createDataFrame([(d["n"],) for d in history.recover()], "n int")


@query("default_state_tables", _values("name", ("_offset_storage",), ("_schema_history_storage",)))
def default_state_tables(spark, sf_dir):
    options = Options(warehouse=workspace(spark, "stores"), table_namespace="a.b")
    open_store(spark, "offset", options)
    open_store(spark, "history", options).initialize()
    return spark.createDataFrame([(n,) for n in load_namespace(spark, options.warehouse, "a.b")], "name string")


@query("archive_files", "SELECT count(*) AS n, count(DISTINCT event_type) AS folders FROM events")
def archive_files(spark, sf_dir):
    """Raw events lie in a folder a destination and hour."""
    archive = Archive(spark, workspace(spark, "archive"))
    rows = read(spark, sf_dir, "events").select(F.col("event_type").alias("destination"), F.lit(None).cast("string").alias("key"), F.to_json(F.struct(F.struct("event_id").alias("payload"))).alias("value"))
    archive.handle_batch(rows.repartition("destination"), 1)
    folder = F.regexp_replace("file_path", "/[^/]*$", "")
    return archive.table.read(with_file=True).agg(F.count("*").alias("n"), F.count_distinct(folder).alias("folders"))


@query("commit_files", "SELECT 3 AS commits, true AS one_file_each")
def commit_files(spark, sf_dir):
    """Every commit's files lie in a folder that its number begins, so names never clash."""
    rows = read(spark, sf_dir, "region").coalesce(1)
    table = Table.create(spark, workspace(spark, "files"), rows.schema)
    for i in range(3):
        table.append(rows, f"source#{i}")
    table.append(rows, "source#1")  # a replay of a batch long ago
    files = table.read(with_file=True).select("file_path", F.regexp_extract("file_path", "commit=([0-9]+)-", 1).alias("c")).distinct()
    return files.groupBy("c").count().agg(F.count("*").cast("int").alias("commits"), (F.max("count") == 1).alias("one_file_each"))


# --- bucket partitions: Murmur3 of a long, with the seed 42


def _murmur_sql() -> str:
    m = 4294967296

    def rotated(x: str, by: int) -> str:
        return f"((({x} << {by}) % {m}) | ({x} >> {32 - by}))"

    steps = ["SELECT CAST(o_custkey AS UBIGINT) AS v, CAST(42 AS UBIGINT) AS h FROM orders"]
    for half in (f"v % {m}", f"v // {m}"):
        steps.append(f"SELECT v, h, ({half}) * 3432918353 % {m} AS k FROM ({{}})")
        steps.append(f"SELECT v, h, {rotated('k', 15)} * 461845907 % {m} AS k FROM ({{}})")
        steps.append("SELECT v, xor(h, k) AS h FROM ({})")
        steps.append(f"SELECT v, ({rotated('h', 13)} * 5 + 3864292196) % {m} AS h FROM ({{}})")
    steps.append("SELECT xor(h, 8::UBIGINT) AS h FROM ({})")
    for shift, by in ((16, 2246822507), (13, 3266489909)):
        steps.append(f"SELECT xor(h, h >> {shift}) * {by} % {m} AS h FROM ({{}})")
    steps.append("SELECT xor(h, h >> 16) AS h FROM ({})")
    out = steps[0]
    for s in steps[1:]:
        out = s.format(out)
    return f"SELECT CAST(h % 8 AS INTEGER) AS p, count(*) AS n FROM ({out}) GROUP BY 1"


SQL["partition_bucket"] = _murmur_sql()
