"""Queries over the driver's tables that apply the engine's operators, and their SQL equivalents.

The table ``events`` serves as a change log: its type is the operation, its user the
key, its id the order of arrival, the day of its time the column that ties.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import coerce
from millrace.operators import flatten as fl
from millrace.operators.dedup import deduplicate, priority
from millrace.operators.partition import parse, spec
from millrace.operators.route import register_mapper, table_name, without_heartbeats
from millrace.operators.writer import table_state, write_batch
from millrace.options import Options
from millrace.plans.schema_map import map_schema, merge_schema
from millrace.sources.table import Table
from millrace.sources.workspace import workspace
from millrace.streaming.consumer import Consumer
from millrace.streaming.state import Archive, OffsetStore, SchemaHistory, archive_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"
_LOG = f"""log AS (
  SELECT user_id AS k, event_id AS seq, {_OP} AS op, date_trunc('day', ts)::TIMESTAMP AS t, value, event_type,
         event_id % 4 AS batch, event_id // 1000 AS batch_no FROM events
), ranked AS (SELECT *, CASE op WHEN 'c' THEN 1 WHEN 'r' THEN 2 WHEN 'u' THEN 3 WHEN 'd' THEN 4 END AS prio FROM log)"""


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as (k, seq, __op, t, value, event_type, batch, batch_no)."""
    op = F.expr(_OP)
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("k"),
        F.col("event_id").alias("seq"),
        op.alias("__op"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("t"),
        "value",
        "event_type",
        (F.col("event_id") % 4).alias("batch"),
        F.expr("event_id div 1000").alias("batch_no"),
    )


def _last(order: str, extra: str = "", keys: str = "k", cols: str = "k, op, seq, value") -> str:
    return f"WITH {_LOG} SELECT {cols} FROM ranked QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1{extra}"


# --- append, deduplication


@query("append_log", f"WITH {_LOG} SELECT k, seq, op, value FROM log")
def append_log(spark, sf_dir):
    rows = change_log(spark, sf_dir).select("k", "seq", F.col("__op").alias("op"), "value")
    table = Table.create(spark, workspace(spark, "append"), rows.schema)
    for i in range(2):
        table.append(rows.where(F.col("seq") % 2 == i), f"batch-{i}")
    table.append(rows.where("seq % 2 = 0"), "batch-0")  # a replay changes nothing
    return table.read()


def _deduped(spark, sf_dir, by=None):
    return deduplicate(change_log(spark, sf_dir), ["k"], "seq", by=by).select("k", F.col("__op").alias("op"), "seq", "value", "__new_key")


@query("dedup_arrival", _last("seq DESC"))
def dedup_arrival(spark, sf_dir):
    return _deduped(spark, sf_dir).drop("__new_key")


@query("dedup_ts_priority", _last("t DESC, prio DESC, seq DESC"))
def dedup_ts_priority(spark, sf_dir):
    return _deduped(spark, sf_dir, "t").drop("__new_key")


@query("dedup_new_key", f"WITH {_LOG} SELECT k, arg_min(op, seq) = 'c' AS new_key FROM log GROUP BY k")
def dedup_new_key(spark, sf_dir):
    return _deduped(spark, sf_dir).select("k", F.col("__new_key").alias("new_key"))


@query("dedup_new_key_column", _last("t DESC, prio DESC, seq DESC", cols="k, op = 'c' AS new_key"))
def dedup_new_key_column(spark, sf_dir):
    return _deduped(spark, sf_dir, "t").select("k", F.col("__new_key").alias("new_key"))


@query("op_priority", f"WITH {_LOG} SELECT DISTINCT op, prio FROM ranked")
def op_priority(spark, sf_dir):
    return change_log(spark, sf_dir).select(F.col("__op").alias("op"), priority(F.col("__op")).alias("prio")).distinct()


# --- table state after all batches


def _state(name, order, by, keep, keys=("k",), batch="batch_no"):
    cols = "k, event_type, op, seq, value" if len(keys) > 1 else "k, op, seq, value"
    sql = _last(f"{batch} DESC, {order}", keys=", ".join(keys), cols=cols)
    if not keep:
        sql = f"SELECT * FROM ({sql}) WHERE op <> 'd'"

    @query(name, sql)
    def run(spark, sf_dir):
        out = table_state(change_log(spark, sf_dir), list(keys), batch, "seq", by=by, keep_deletes=keep)
        extra = ["event_type"] if len(keys) > 1 else []
        return out.select("k", *extra, F.col("__op").alias("op"), "seq", "value")


_state("upsert_soft", "seq DESC", None, True)
_state("upsert_hard", "seq DESC", None, False)
_state("upsert_soft_ts", "t DESC, prio DESC, seq DESC", "t", True)
_state("upsert_hard_ts", "t DESC, prio DESC, seq DESC", "t", False)
_state("upsert_composite_key", "seq DESC", None, False, ("k", "event_type"))
_state("cross_batch_late_overwrite", "t DESC, prio DESC, seq DESC", "t", True, batch="batch")


def _merged(spark, sf_dir, options, keys=("k",), where=None) -> Table:
    log = change_log(spark, sf_dir).select("k", "event_type", "__op", "seq", "t", "value", "batch")
    rows = log.drop("batch")
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name not in keys) for f in rows.schema.fields])
    table = Table.create(spark, workspace(spark, "upsert"), schema, list(keys), list(keys), spec(where or [], schema, True))
    for i in range(4):
        part = log.where(F.col("batch") == i).drop("batch").withColumn("__arrival", F.col("seq"))
        write_batch(table, part, options, f"batch-{i}")
    return table


def _merge_on_read(name, options, order, keep, compact=False, where=None):
    sql = _last(f"batch DESC, {order}")
    if not keep:
        sql = f"SELECT * FROM ({sql}) WHERE op <> 'd'"

    @query(name, sql)
    def run(spark, sf_dir):
        table = _merged(spark, sf_dir, options(), where=where)
        if compact:
            table.compact()
        return table.read().select("k", F.col("__op").alias("op"), "seq", "value")


_merge_on_read("merge_on_read_soft", lambda: Options(upsert=True), "seq DESC", True)
_merge_on_read("merge_on_read_hard", lambda: Options(upsert=True, upsert_keep_deletes=False), "seq DESC", False)
_merge_on_read(
    "merge_on_read_hard_ts", lambda: Options(upsert=True, upsert_keep_deletes=False, upsert_dedup_column="t"),
    "t DESC, prio DESC, seq DESC", False,
)
_merge_on_read("compacted_hard", lambda: Options(upsert=True, upsert_keep_deletes=False), "seq DESC", False, compact=True)
_merge_on_read("partitioned_hard", lambda: Options(upsert=True, upsert_keep_deletes=False), "seq DESC", False, where=["bucket(k, 4)"])


@query("upsert_nokey_fallback", f"WITH {_LOG} SELECT k, op, seq FROM log")
def upsert_nokey_fallback(spark, sf_dir):
    return _merged(spark, sf_dir, Options(upsert=True), keys=()).read().select("k", F.col("__op").alias("op"), "seq")


@query("time_travel", f"WITH {_LOG} SELECT k, op, seq FROM log WHERE batch < 2 QUALIFY row_number() OVER (PARTITION BY k ORDER BY batch DESC, seq DESC) = 1")
def time_travel(spark, sf_dir):
    table = _merged(spark, sf_dir, Options(upsert=True))
    return table.read(version=2).select("k", F.col("__op").alias("op"), "seq")


@query("snapshot_log", "SELECT * FROM (VALUES (0, 'create', 0), (1, 'overwrite', 1), (2, 'overwrite', 2), (3, 'overwrite', 3), (4, 'overwrite', 4)) t(version, operation, data_folders)")
def snapshot_log(spark, sf_dir):
    return _merged(spark, sf_dir, Options(upsert=True)).snapshots().select(F.col("version").cast("int").alias("version"), "operation", "data_folders")


@query("soft_deleted_view", f"SELECT k, seq FROM ({_last('batch_no DESC, seq DESC')}) WHERE op <> 'd'")
def soft_deleted_view(spark, sf_dir):
    rows = table_state(change_log(spark, sf_dir), ["k"], "batch_no", "seq").withColumn("__deleted", F.col("__op") == "d")
    return rows.where("NOT __deleted").select("k", "seq")


@query("op_counts", f"WITH {_LOG} SELECT op, count(*) AS n FROM log GROUP BY op")
def op_counts(spark, sf_dir):
    return change_log(spark, sf_dir).groupBy(F.col("__op").alias("op")).agg(F.count("*").alias("n"))


# --- routing, projection


def _destinations(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("Srv.Inventory."), "event_type", (F.col("user_id") % 7).cast("string")).alias("destination"))


_DEST = "SELECT event_id, 'Srv.Inventory.' || event_type || CAST(user_id % 7 AS VARCHAR) AS destination FROM events"


@query("route_table_names", f"SELECT DISTINCT destination, lower('Cdc_' || replace(regexp_replace(destination, '\\d', '', 'g'), '.', '_')) AS table_name FROM ({_DEST})")
def route_table_names(spark, sf_dir):
    options = Options(destination_regexp=r"\d", table_prefix="Cdc_", destination_lowercase_table_names=True)
    return _destinations(spark, sf_dir).select("destination", table_name(F.col("destination"), options).alias("table_name")).distinct()


@query("route_merge_destinations", f"SELECT upper(replace(regexp_replace(destination, '(view|click)\\d+', 'seen', 'g'), '.', '_')) AS table_name, count(*) AS n FROM ({_DEST}) GROUP BY 1")
def route_merge_destinations(spark, sf_dir):
    options = Options(destination_regexp=r"(view|click)\d+", destination_regexp_replace="seen", destination_uppercase_table_names=True)
    return _destinations(spark, sf_dir).groupBy(table_name(F.col("destination"), options).alias("table_name")).agg(F.count("*").alias("n"))


@register_mapper("last-part")
def _last_part(destination, options):
    return F.concat(F.lit("custom_mapper_"), F.element_at(F.split(destination, r"\."), -1))


@query("route_custom_mapper", f"SELECT DISTINCT 'custom_mapper_' || split_part(destination, '.', 3) AS table_name FROM ({_DEST})")
def route_custom_mapper(spark, sf_dir):
    return _destinations(spark, sf_dir).select(table_name(F.col("destination"), Options(table_mapper="last-part")).alias("table_name")).distinct()


@query("heartbeat_filter", "SELECT event_id FROM events WHERE event_type <> 'error'")
def heartbeat_filter(spark, sf_dir):
    topic = F.when(F.col("event_type") == "error", "__cdc-heartbeat.srv").otherwise(F.col("event_type"))
    rows = read(spark, sf_dir, "events").select("event_id", topic.alias("destination"))
    return without_heartbeats(rows, Options()).select("event_id")


@query("excluded_columns", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def excluded_columns(spark, sf_dir):
    return fl.without_columns(read(spark, sf_dir, "orders"), ["o_totalprice", "o_orderdate", "o_orderpriority", "not_there"])


def _envelopes(spark, sf_dir):
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    op = F.element_at(F.array(*map(F.lit, "crud")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return read(spark, sf_dir, "orders").select(op.alias("op"), row.alias("row")).select(
        F.when(F.col("op").isin("u", "d"), F.col("row")).alias("before"),
        F.when(F.col("op") != "d", F.col("row")).alias("after"),
        "op",
        F.struct(F.lit("orders").alias("table"), (F.col("row.o_orderkey") * 1000).alias("ts_ms")).alias("source"),
    )


@query("flatten_envelope", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, op AS __op, 'orders' AS __table, o_orderkey * 1000 AS __source_ts_ms, op = 'd' AS __deleted
FROM (SELECT *, substr('crud', CAST(o_orderkey % 4 + 1 AS INTEGER), 1) AS op FROM orders)""")
def flatten_envelope(spark, sf_dir):
    return fl.flatten(_envelopes(spark, sf_dir))


@query("rename_key", "SELECT c_custkey AS _id, c_name FROM customer")
def rename_key(spark, sf_dir):
    return fl.rename_key(read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name"), "id", "_id")


@query("key_projection", "SELECT o_orderkey AS after_o_orderkey, substr('crud', CAST(o_orderkey % 4 + 1 AS INTEGER), 1) AS op FROM orders WHERE o_orderkey % 4 <> 3")
def key_projection(spark, sf_dir):
    return fl.keys_of(_envelopes(spark, sf_dir).where("op <> 'd'"), ["after.o_orderkey", "op"])


# --- values


def _json(spark, sf_dir):
    """Documents that hold a number as number, text, boolean, fraction, object, null, or not at all."""
    n = F.get_json_object("props", "$.k")
    shape = F.col("event_id") % 7
    value = (
        F.when(shape == 0, n).when(shape == 1, F.concat(F.lit('"'), n, F.lit('"'))).when(shape == 2, "true")
        .when(shape == 3, F.concat(n, F.lit(".9"))).when(shape == 4, '"word"').when(shape == 5, "null")
    )
    doc = F.when(value.isNull(), "{}").otherwise(F.concat(F.lit('{"v": '), value, F.lit("}")))
    return read(spark, sf_dir, "events").select("event_id", F.parse_json(doc).alias("doc"))


def _json_case(number, text, true, fraction, word):
    return f"""SELECT event_id, CASE event_id % 7 WHEN 0 THEN {number} WHEN 1 THEN {text} WHEN 2 THEN {true} WHEN 3 THEN {fraction} WHEN 4 THEN {word} END AS v
    FROM (SELECT event_id, json_extract_string(props, '$.k') AS s FROM events)"""


def _json_query(name, f, sql):
    @query(name, sql)
    def run(spark, sf_dir):
        return _json(spark, sf_dir).select("event_id", f(coerce.member(F.col("doc"), "v")).alias("v"))


_json_query("json_coerce_int", coerce.json_int, _json_case("CAST(s AS BIGINT)", "CAST(s AS BIGINT)", "1", "CAST(s AS BIGINT)", "0"))
_json_query("json_coerce_double", coerce.json_double, _json_case("CAST(s AS DOUBLE)", "CAST(s AS DOUBLE)", "1.0::DOUBLE", "CAST(s || '.9' AS DOUBLE)", "0.0::DOUBLE"))
_json_query("json_coerce_boolean", lambda v: coerce.json_boolean(v).cast("string"), _json_case("CAST(s <> '0' AS VARCHAR)", "'false'", "'true'", "'false'", "'false'"))
_json_query("json_coerce_string", coerce.json_string, _json_case("NULL", "s", "NULL", "NULL", "'word'"))


@query("variant_get", "SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_number FROM events")
def variant_get(spark, sf_dir):
    doc = F.parse_json("props")
    return read(spark, sf_dir, "events").select("event_id", F.try_variant_get(doc, "$.k", "string").alias("k_text"), F.try_variant_get(doc, "$.k", "bigint").alias("k_number"))


@query("decimal_rescale_half_up", "SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,3)) AS DECIMAL(12,1)) AS VARCHAR) AS price FROM lineitem")
def decimal_rescale_half_up(spark, sf_dir):
    exact = F.col("l_extendedprice").cast("decimal(18,3)")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", coerce.decimal_of(exact, 12, 1).cast("string").alias("price"))


@query("decimal_from_bytes", "SELECT o_orderkey, CAST(CAST((CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END) * o_orderkey * 977 AS DECIMAL(18,0)) / 1000 AS DECIMAL(18,3))::VARCHAR AS v FROM orders")
def decimal_from_bytes(spark, sf_dir):
    n = F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(-1) * F.col("o_orderkey") * 977
    raw = F.unhex(F.lpad(F.hex(n.cast("bigint")), 16, "0"))
    return read(spark, sf_dir, "orders").select("o_orderkey", coerce.decimal_of_bytes(raw, 18, 3).cast("string").alias("v"))


def _temporal(name, expr, sql):
    @query(name, sql)
    def run(spark, sf_dir):
        return read(spark, sf_dir, "orders").select("o_orderkey", expr().alias("v"))


_temporal("temporal_millis", lambda: coerce.timestamp_ntz_of(F.col("o_orderkey") * 86_400_123, "millis"), "SELECT o_orderkey, make_timestamp(o_orderkey * 86400123 * 1000) AS v FROM orders")
_temporal("temporal_micros", lambda: coerce.timestamp_ntz_of(F.col("o_orderkey") * 86_400_123_457, "micros"), "SELECT o_orderkey, make_timestamp(o_orderkey * 86400123457) AS v FROM orders")
_temporal("temporal_nanos", lambda: coerce.timestamp_ntz_of(F.col("o_orderkey").cast("decimal(20,0)") * 86_400_123_456_789, "nanos"), "SELECT o_orderkey, make_timestamp(o_orderkey * 86400123456789 // 1000) AS v FROM orders")
_temporal("temporal_date", lambda: coerce.date_of_days(F.col("o_orderkey") % 20000).cast("string"), "SELECT o_orderkey, CAST(DATE '1970-01-01' + CAST(o_orderkey % 20000 AS INTEGER) AS VARCHAR) AS v FROM orders")
_temporal("temporal_date_text", lambda: coerce.date_of_text(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("Z"))).cast("string"), "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS v FROM orders")
_temporal("temporal_iso_text", lambda: coerce.timestamp_ntz_of_text(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))), "SELECT o_orderkey, date_trunc('second', o_orderdate)::TIMESTAMP AS v FROM orders")
_temporal("temporal_time", lambda: coerce.time_of((F.col("o_orderkey") * 7919) % 86_400_000, "millis"), "SELECT o_orderkey, strftime(make_timestamp((o_orderkey * 7919) % 86400000 * 1000), '%H:%M:%S.%f') AS v FROM orders")
_temporal("binary_base64", lambda: F.hex(coerce.binary_of(F.base64(F.col("o_orderstatus").cast("binary")))), "SELECT o_orderkey, hex(o_orderstatus) AS v FROM orders")
_temporal("uuid_parse", lambda: coerce.uuid_of(F.regexp_replace(F.upper(F.md5(F.col("o_orderkey").cast("string"))), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")), "SELECT o_orderkey, regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5') AS v FROM orders")


# --- schemas


@query("field_addition_union", "SELECT c_custkey, c_name, NULL::BIGINT AS c_nation, NULL::VARCHAR AS c_mktsegment FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 2 = 1")
def field_addition_union(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    old = rows.where("c_custkey % 2 = 0").select("c_custkey", "c_name")
    new = rows.where("c_custkey % 2 = 1").select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("c_nation"), "c_mktsegment")
    table = Table.create(spark, workspace(spark, "evolve"), old.schema)
    table.append(old)
    table.evolve(new.schema)
    table.append(new)
    return table.read()


@query("type_widening", "SELECT p_partkey, CAST(p_size AS BIGINT) + CASE WHEN p_partkey % 2 = 1 THEN 10000000000 ELSE 0 END AS size, CAST(p_size AS DOUBLE) AS ratio FROM part")
def type_widening(spark, sf_dir):
    rows = read(spark, sf_dir, "part")
    old = rows.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_size").alias("size"), F.col("p_size").cast("float").alias("ratio"))
    new = rows.where("p_partkey % 2 = 1").select("p_partkey", (F.col("p_size") + F.lit(10_000_000_000)).alias("size"), F.col("p_size").cast("double").alias("ratio"))
    table = Table.create(spark, workspace(spark, "widen"), old.schema)
    table.append(old)
    table.evolve(new.schema)
    table.append(new)
    return table.read()


@query("field_addition_off", "SELECT c_custkey, c_name FROM customer")
def field_addition_off(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    table = Table.create(spark, workspace(spark, "fixed"), rows.select("c_custkey", "c_name").schema)
    table.append(rows)
    return table.read()


@query("rename_readd_column", "SELECT p_partkey, p_name AS name_legacy, p_brand AS name FROM part WHERE p_partkey % 2 = 1 UNION ALL SELECT p_partkey, p_name, NULL FROM part WHERE p_partkey % 2 = 0")
def rename_readd_column(spark, sf_dir):
    rows = read(spark, sf_dir, "part")
    old = rows.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_name").alias("name"))
    new = rows.where("p_partkey % 2 = 1").select("p_partkey", F.col("p_name").alias("name_legacy"), F.col("p_brand").alias("name"))
    table = Table.create(spark, workspace(spark, "rename"), old.schema)
    table.append(old)
    table.rename_column("name", "name_legacy")
    table.evolve(new.schema)
    table.append(new)
    return table.read()


@query("migration_coalesce", "SELECT o_orderkey, make_timestamp(o_orderkey * 1000000) AS at FROM orders")
def migration_coalesce(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") * 1000).alias("a_legacy"),
        F.when(F.col("o_orderkey") % 2 == 1, F.timestamp_seconds("o_orderkey").cast("timestamp_ntz")).alias("a"),
    )
    return rows.select("o_orderkey", F.coalesce(coerce.timestamp_ntz_of(F.col("a_legacy"), "millis"), F.col("a")).alias("at"))


# --- partitions


def _partition(name, entry, table, sql):
    @query(f"partition_{name}", sql)
    def run(spark, sf_dir):
        rows = read(spark, sf_dir, table)
        t = parse(entry)
        return rows.groupBy(t.value(F.col(t.column), rows.schema[t.column].dataType).alias("p")).agg(F.count("*").alias("n"))


_partition("identity", "event_type", "events", "SELECT event_type AS p, count(*) AS n FROM events GROUP BY 1")
_partition("year", "year(l_shipdate)", "lineitem", "SELECT year(l_shipdate) - 1970 AS p, count(*) AS n FROM lineitem GROUP BY 1")
_partition("month", "months(l_shipdate)", "lineitem", "SELECT (year(l_shipdate) - 1970) * 12 + month(l_shipdate) - 1 AS p, count(*) AS n FROM lineitem GROUP BY 1")
_partition("day", "day(ts)", "events", "SELECT date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS p, count(*) AS n FROM events GROUP BY 1")
_partition("hour", "hours(ts)", "events", "SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS p, count(*) AS n FROM events GROUP BY 1")
_partition("truncate", "truncate(o_orderkey, 100)", "orders", "SELECT o_orderkey - ((o_orderkey % 100) + 100) % 100 AS p, count(*) AS n FROM orders GROUP BY 1")
_partition("truncate_text", "truncate(c_mktsegment, 3)", "customer", "SELECT substring(c_mktsegment, 1, 3) AS p, count(*) AS n FROM customer GROUP BY 1")
_partition("bucket", "bucket(o_custkey, 8)", "orders", None)


@query("partition_pruned_read", "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-09' AND event_type = 'view'")
def partition_pruned_read(spark, sf_dir):
    rows = read(spark, sf_dir, "events")
    table = Table.create(spark, workspace(spark, "pruned"), rows.schema, partition=spec(["event_type", "day(ts)"], rows.schema, True))
    table.append(rows.repartition("event_type"))
    low, high = (F.lit(f"2024-01-0{d}").cast("timestamp_ntz") for d in (5, 9))
    found = table.read(between={"event_type": ("view", "view")}).where((F.col("ts") >= low) & (F.col("ts") <= high))
    return found.select("event_id", "event_type")


# --- state tables, archive


def _raw(spark, sf_dir):
    key = F.to_json(F.struct(F.lit("k").alias("schema"), F.struct("event_id").alias("payload")))
    return read(spark, sf_dir, "events").select(F.col("event_type").alias("destination"), key.alias("key"), F.col("props").alias("value"))


@query("archive_events", "SELECT event_type AS event_destination, 'k' AS event_key_schema, '{\"event_id\":' || event_id || '}' AS event_key_payload, 'null' AS event_value_schema, 'null' AS event_value_payload, CAST(1700000000 AS BIGINT) AS event_sink_epoch_ms FROM events")
def archive_events(spark, sf_dir):
    return archive_rows(_raw(spark, sf_dir), 1_700_000_000).drop("event_sink_timestamptz")


@query("archive_destinations", "SELECT count(DISTINCT event_type) AS n FROM events")
def archive_destinations(spark, sf_dir):
    archive = Archive(spark, workspace(spark, "archive"))
    archive.handle_batch(_raw(spark, sf_dir).repartition("destination"), 1)
    return archive.table.read().agg(F.count_distinct("event_destination").alias("n"))


@query("offset_overwrite", "SELECT 'a' AS k, '2' AS v UNION ALL SELECT 'b', NULL UNION ALL SELECT 'c', '3'")
def offset_overwrite(spark, sf_dir):
    folder = workspace(spark, "offsets")
    store = OffsetStore(spark, folder)
    store.set({"a": "1", "b": None})
    store.set({"a": "2", "c": "3", None: "x"})
    pairs = F.explode(F.from_json("offset_data", "map<string,string>")).alias("k", "v")
    return OffsetStore(spark, folder).table.read().select(pairs)


@query("history_ilike", "SELECT count(*) AS n FROM region")
def history_ilike(spark, sf_dir):
    history = SchemaHistory(spark, workspace(spark, "history"))
    history.initialize()
    ddl = read(spark, sf_dir, "region").select(
        F.expr("uuid()").alias("id"), F.concat(F.lit("{'ddl': 'create TABLE "), "r_name", F.lit("'}")).alias("history_data"), F.timestamp_seconds("r_regionkey").alias("record_insert_ts"),
    )
    history.table.append(ddl)
    history.record({"ddl": "DROP TABLE x"})
    return history.table.read().where("history_data ILIKE '%CREATE%TABLE%'").agg(F.count("*").alias("n"))


# --- from raw events to tables


def _field(name, kind, sem=None, optional=True):
    return {"field": name, "type": kind, "optional": optional} | ({"name": sem} if sem else {})


_ORDER = {
    "type": "struct",
    "fields": [
        _field("o_orderkey", "int64", optional=False), _field("o_custkey", "int64"), _field("o_orderstatus", "string"),
        _field("o_totalprice", "double"), _field("o_orderdate", "int64", "any.time.MicroTimestamp"), _field("__op", "string"), _field("__deleted", "boolean"),
    ],
}
_ORDER_KEY = {"type": "struct", "fields": [_field("o_orderkey", "int64", optional=False)]}


def order_events(spark, sf_dir) -> DataFrame:
    """orders as raw JSON events with their schemas; every fifth order is deleted at last."""
    rows = read(spark, sf_dir, "orders").select("*", F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("us"))
    last = rows.where("o_orderkey % 5 = 0")
    both = rows.withColumn("__op", F.lit("c")).withColumn("at", F.lit(0)).unionByName(last.withColumn("__op", F.lit("d")).withColumn("at", F.lit(1)))
    payload = F.to_json(
        F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("us").alias("o_orderdate"), "__op", (F.col("__op") == "d").alias("__deleted"))
    )

    def enveloped(schema, body):
        return F.concat(F.lit('{"schema": ' + json.dumps(schema) + ', "payload": '), body, F.lit("}"))

    return both.select(
        F.lit("srv.sales.orders").alias("destination"), enveloped(_ORDER_KEY, F.to_json(F.struct("o_orderkey"))).alias("key"),
        enveloped(_ORDER, payload).alias("value"), (F.col("at") * 10_000_000_000 + F.col("o_orderkey")).alias("__arrival"),
    )


def _consumed(spark, sf_dir, **options) -> DataFrame:
    consumer = Consumer(spark, Options(warehouse=workspace(spark, "warehouse"), format_key="json", format_value="json", **options))
    consumer.handle_batch(order_events(spark, sf_dir), 1)
    consumer.handle_batch(order_events(spark, sf_dir).where("__arrival < 50"), 1)  # a replayed batch
    return consumer.table("srv_sales_orders").read()


_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::TIMESTAMP AS o_orderdate, {} FROM orders {}"


@query("consume_append", _ORDER_SQL.format("'c' AS __op, false AS __deleted", "") + " UNION ALL " + _ORDER_SQL.format("'d', true", "WHERE o_orderkey % 5 = 0"))
def consume_append(spark, sf_dir):
    return _consumed(spark, sf_dir)


@query("consume_upsert_soft", _ORDER_SQL.format("CASE WHEN o_orderkey % 5 = 0 THEN 'd' ELSE 'c' END AS __op, o_orderkey % 5 = 0 AS __deleted", ""))
def consume_upsert_soft(spark, sf_dir):
    return _consumed(spark, sf_dir, upsert=True)


@query("consume_upsert_hard", _ORDER_SQL.format("'c' AS __op, false AS __deleted", "WHERE o_orderkey % 5 <> 0"))
def consume_upsert_hard(spark, sf_dir):
    return _consumed(spark, sf_dir, upsert=True, upsert_keep_deletes=False, partition_by=["month(o_orderdate)"])


@query("consume_orc", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 5 <> 0")
def consume_orc(spark, sf_dir):
    out = _consumed(spark, sf_dir, upsert=True, upsert_keep_deletes=False, write_format_default="orc", excluded_columns=["o_totalprice"])
    return out.select("o_orderkey", "o_custkey", "o_orderstatus")


@query("stream_upsert", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 <> 0")
def stream_upsert(spark, sf_dir):
    """The same events through files and a streaming query, a file at a time."""
    base = workspace(spark, "stream")
    events = order_events(spark, sf_dir)
    for i, part in enumerate((events.where("__arrival < 10000000000"), events.where("__arrival >= 10000000000"))):
        part.coalesce(1).select("destination", "key", "value").write.mode("append").json(f"{base}/events/{i}")
    options = Options(warehouse=f"{base}/warehouse", format_key="json", format_value="json", upsert=True, upsert_keep_deletes=False)
    consumer = Consumer(spark, options)
    stream = spark.readStream.schema("destination string, key string, value string").option("recursiveFileLookup", "true")
    for i in range(2):
        query = consumer.start(stream.json(f"{base}/events/{i}"), f"{base}/checkpoint-{i}", available_now=True)
        query.awaitTermination()
    return consumer.table("srv_sales_orders").read().select("o_orderkey", "o_custkey")


@query("schema_from_event", "SELECT * FROM (VALUES ('o_orderkey', 'bigint', false), ('o_custkey', 'bigint', true), ('o_orderstatus', 'string', true), ('o_totalprice', 'double', true), ('o_orderdate', 'timestamp_ntz', true), ('__op', 'string', true), ('__deleted', 'boolean', true)) t(column_name, type, optional)")
def schema_from_event(spark, sf_dir):
    schema = map_schema(_ORDER, _ORDER_KEY, Options()).schema
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in schema], "column_name string, type string, optional boolean")


@query("schema_union", "SELECT * FROM (VALUES ('a', 'bigint'), ('b', 'struct<x:int,y:string>'), ('c', 'double')) t(column_name, type)")
def schema_union(spark, sf_dir):
    old = spark.createDataFrame([], "a int, b struct<x:int>").schema
    new = spark.createDataFrame([], "b struct<x:int,y:string>, a bigint, c double").schema
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in merge_schema(old, new)], "column_name string, type string")


# --- reads


@query("existence_probe", "SELECT count(*) > 0 AS found FROM region")
def existence_probe(spark, sf_dir):
    return spark.createDataFrame([(not read(spark, sf_dir, "region").limit(1).isEmpty(),)], "found boolean")


@query("filtered_read", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) >= DATE '1995-01-01' AND o_totalprice IS NOT NULL")
def filtered_read(spark, sf_dir):
    return read(spark, sf_dir, "orders").where("o_orderstatus = 'F' AND to_date(o_orderdate) >= date'1995-01-01' AND o_totalprice IS NOT NULL").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("day"))


@query("rows_per_file", "SELECT sum(n) AS n, max(n) <= 500 AS small FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey // 500)")
def rows_per_file(spark, sf_dir):
    rows = read(spark, sf_dir, "customer")
    table = Table.create(spark, workspace(spark, "rolling"), rows.schema)
    table.append(rows, rows_per_file=500)
    files = table.read(with_file=True).groupBy("file_path").agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").cast("decimal(38,0)").cast("bigint").alias("n"), (F.max("n") <= 500).alias("small"))


@query("last_orders", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 10")
def last_orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").orderBy(F.desc("o_orderkey")).limit(10).select("o_orderkey")
