import json

import pytest
from pyspark.sql import functions as F

from millrace.options import Options
from millrace.sources.envelope import decode, project_typed
from millrace.streaming.consumer import Consumer, MaxBatchSizeWait, NoBatchSizeWait, event_stream, wait_strategy
from millrace.streaming.state import Archive, OffsetStore, SchemaHistory, resolve_config


def schema(*fields):
    return {"type": "struct", "fields": [{"field": n, "type": k, "optional": True} | ({"name": s} if s else {}) for n, k, s in fields]}


BASE = (("id", "int32", None), ("name", "string", None), ("__op", "string", None), ("__source_ts_ms", "int64", None))


def event(dest, row, fields=BASE, key=("id",)):
    k = None if key is None else json.dumps({"schema": schema(*(f for f in fields if f[0] in key)), "payload": {n: row[n] for n in key}})
    return (dest, k, json.dumps({"schema": schema(*fields), "payload": row}))


def frame(spark, *events):
    return spark.createDataFrame([(*e, i) for i, e in enumerate(events)], "destination string, key string, value string, __arrival bigint")


def options(tmp_path, **more):
    return Options(warehouse=f"file://{tmp_path}/w", format_key="json", format_value="json", **more)


def row(i, name="a", op="c", **more):
    return {"id": i, "name": name, "__op": op, "__source_ts_ms": 1000 * i} | more


def test_tables_evolve_and_batches_commit_once(spark, tmp_path):
    seen = []
    c = Consumer(spark, options(tmp_path, upsert=True, concurrent_uploads=3, lineage_enabled=True), seen.append)
    first = frame(spark, event("s.i.a", row(1)), event("s.i.b", row(1)), event("__x-heartbeat.s", row(9)), event("s.i.a", row(2)))
    assert c.handle_batch(first, 1) == {"s_i_a": True, "s_i_b": True}
    assert c.handle_batch(first, 1) == {"s_i_a": False, "s_i_b": False}
    wide = (*BASE, ("extra", "double", None))
    c.handle_batch(frame(spark, event("s.i.a", row(2, "b", "u")), event("s.i.a", row(3, extra=1.5), wide)), 2)
    got = {r["id"]: r for r in c.table("s_i_a").read().collect()}
    assert (got[2]["name"], got[3]["extra"], got[1]["extra"]) == ("b", 1.5, None)
    assert got[1]["__source_ts_ms"].timestamp() == 1 or got[1]["__source_ts_ms"].second == 1
    assert {s["table"] for s in seen} == {"s_i_a", "s_i_b"}


def test_fixed_schema_and_incompatible_change(spark, tmp_path):
    c = Consumer(spark, options(tmp_path, allow_field_addition=False))
    c.handle_batch(frame(spark, event("a", row(1))), 1)
    c.handle_batch(frame(spark, event("a", row(2, extra=1.0), (*BASE, ("extra", "double", None)))), 2)
    assert "extra" not in c.table("a").read().columns and c.table("a").read().count() == 2
    d = Consumer(spark, options(tmp_path))
    with pytest.raises(ValueError, match="Cannot change column type"):
        d.handle_batch(frame(spark, event("a", {"id": 1, "name": 2}, (("id", "int32", None), ("name", "int64", None)))), 3)


def test_merged_destinations_are_one_group(spark, tmp_path):
    c = Consumer(spark, options(tmp_path, upsert=True, destination_regexp=r"_ptt\d", destination_regexp_replace="_all"))
    c.handle_batch(frame(spark, event("t_ptt1", row(1, "x")), event("t_ptt2", row(1, "y", "u"))), 1)
    assert [r["name"] for r in c.table("t_all").read().collect()] == ["y"]


def test_unflattened_events_as_variant(spark, tmp_path):
    inner = {"field": "after", "type": "struct", "fields": [{"field": "id", "type": "int32"}, {"field": "first_name", "type": "string"}]}
    value = {"schema": {"type": "struct", "fields": [inner | {"field": "before"}, inner, {"field": "op", "type": "string"}]}, "payload": {"before": None, "after": {"id": 1, "first_name": "Sally"}, "op": "c"}}
    c = Consumer(spark, options(tmp_path, nested_as_variant=True))
    c.handle_batch(frame(spark, ("d", None, json.dumps(value))), 1)
    got = c.table("d").read().select(F.try_variant_get("after", "$.first_name", "string").alias("n"), "op").first()
    assert (got["n"], got["op"]) == ("Sally", "c")


def test_decode(spark):
    rows = decode(frame(spark, ("d", None, '{"id": 1}'), ("d", "null", '{"schema": {"a": 1}, "payload": null}'))).orderBy("__arrival").collect()
    assert (rows[0]["value_payload"], rows[0]["value_schema"], rows[0]["key_payload"]) == ('{"id": 1}', None, None)
    assert (rows[1]["value_payload"], rows[1]["value_schema"], rows[1]["key_payload"]) == (None, '{"a":1}', None)
    with pytest.raises(TypeError):
        decode(spark.createDataFrame([("d", 1, "v")], "destination string, key int, value string"))


def test_null_value_is_an_error(spark, tmp_path):
    c = Consumer(spark, options(tmp_path, drop_tombstones=False))
    c.handle_batch(frame(spark, event("a", row(1))), 1)
    null = json.dumps({"schema": schema(*BASE), "payload": None})
    with pytest.raises(Exception, match="null value"):
        c.handle_batch(frame(spark, ("a", None, null)), 2)
    assert c.table("a").read().count() == 1 and not c.metrics["healthy"]
    Consumer(spark, options(tmp_path)).handle_batch(frame(spark, ("a", None, null), event("a", row(2))), 3)
    assert c.table("a").read().count() == 2  # by default a tombstone is dropped


def envelope(i, before, after, op, ts=5):
    inner = [{"field": "id", "type": "int32", "optional": False}, {"field": "name", "type": "string"}]
    source = {"field": "source", "type": "struct", "fields": [{"field": "table", "type": "string"}, {"field": "ts_ms", "type": "int64"}]}
    fields = [{"field": n, "type": "struct", "fields": inner} for n in ("before", "after")] + [source, {"field": "op", "type": "string"}, {"field": "ts_ms", "type": "int64"}]
    value = {"schema": {"type": "struct", "fields": fields}, "payload": {"before": before, "after": after, "source": {"table": "t", "ts_ms": ts}, "op": op, "ts_ms": ts + 1}}
    key = {"schema": {"type": "struct", "fields": inner[:1]}, "payload": {"id": i}}
    return ("e", json.dumps(key), json.dumps(value))


def test_envelopes_are_unwrapped(spark, tmp_path):
    a, b = {"id": 1, "name": "a"}, {"id": 2, "name": "b"}
    events = [envelope(1, None, a, "c"), envelope(2, None, b, "c"), envelope(1, a, a | {"name": "z"}, "u", 2000), envelope(2, b, None, "d", 3000)]
    tomb = ("e", events[3][1], None)
    c = Consumer(spark, options(tmp_path, upsert=True))
    c.handle_batch(frame(spark, *events, tomb), 1)
    got = {r["id"]: r.asDict() for r in c.table("e").read().collect()}
    assert (got[1]["name"], got[1]["__op"], got[1]["__table"], got[1]["__deleted"]) == ("z", "u", "t", False)
    assert (got[2]["name"], got[2]["__op"], got[2]["__deleted"]) == ("b", "d", True)
    assert got[2]["__source_ts_ms"].second == 3 and c.table("e").snapshot().keys == ["id"]
    d = Consumer(spark, Options(warehouse=f"file://{tmp_path}/x", format_key="json", format_value="json", delete_mode="drop", add_fields=["op"]))
    d.handle_batch(frame(spark, *events, tomb), 1)
    assert d.table("e").read().columns == ["id", "name", "__op"] and d.table("e").read().count() == 3


def test_connect_records(spark, tmp_path):
    schema = (
        "destination string, key struct<id:int>, __arrival bigint, value struct<before:struct<id:int,d:decimal(8,2),at:timestamp,tags:array<string>,m:map<string,int>,s:struct<x:int>>,"
        "after:struct<id:int,d:decimal(8,2),at:timestamp,tags:array<string>,m:map<string,int>,s:struct<x:int>>,source:struct<table:string>,op:string>"
    )
    import datetime as dt
    from decimal import Decimal

    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    one = (1, Decimal("1.25"), at, ["a", None], {"k": 1}, (7,))
    rows = [("c", (1,), 1, (None, one, ("t",), "c")), ("c", (1,), 2, (one, None, ("t",), "d")), ("c", (2,), 3, (None, (2, *one[1:]), ("t",), "r")), ("c", (9,), 4, None)]
    c = Consumer(spark, Options(warehouse=f"file://{tmp_path}/w", upsert=True))
    c.handle_batch(spark.createDataFrame(rows, schema), 1)
    got = {r["id"]: r.asDict(True) for r in c.table("c").read().collect()}
    assert sorted(got) == [1, 2] and got[1]["__deleted"] and not got[2]["__deleted"]
    assert (got[2]["d"], got[2]["tags"], got[2]["m"], got[2]["s"], got[2]["__table"]) == (Decimal("1.25"), ["a", None], {"k": 1}, {"x": 7}, "t")
    with pytest.raises(TypeError):
        c.handle_batch(frame(spark, event("c", row(1))), 2)


def test_order_of_files_in_one_batch(spark, tmp_path):
    """A later file that is larger comes first in the batch's partitions, and must win all the same."""
    for name, value, op, pad in (("0001", "old", "c", 0), ("0002", "new", "u", 50_000)):
        rows = [event("a", row(1, value, op)), *(event("a", row(100 + k, "p" * 20)) for k in range(pad // 500))]
        with open(f"{tmp_path}/{name}.json", "w") as f:
            f.write("\n".join(json.dumps(dict(zip(("destination", "key", "value"), r))) for r in rows))
    import os

    os.makedirs(f"{tmp_path}/in")
    for i, name in enumerate(("0001", "0002")):
        os.utime(f"{tmp_path}/{name}.json", (1_700_000_000 + i,) * 2)
        os.rename(f"{tmp_path}/{name}.json", f"{tmp_path}/in/{name}.json")
    c = Consumer(spark, options(tmp_path, upsert=True))
    c.start(event_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/cp", available_now=True).awaitTermination()
    assert [r["name"] for r in c.table("a").read().where("id = 1").collect()] == ["new"]
    with pytest.raises(ValueError, match="order of arrival"):
        c.handle_batch(frame(spark, event("a", row(1))).drop("__arrival"), 9)


def test_transforms(spark, tmp_path):
    config = {
        "transforms": "unwrap,route,some", "transforms.route.type": "x.RegexRouter", "transforms.route.regex": r"srv\.(.*)", "transforms.route.replacement": "$1",
        "transforms.some.type": "Filter", "transforms.some.condition": "destination <> 'b'", "transforms.unwrap.type": "x.ExtractNewRecordState",
        "transforms.unwrap.add.fields": "op", "format_key": "json", "format_value": "json", "warehouse": f"file://{tmp_path}/w", "spark.sql.x": "1",
    }
    o = Options.from_properties(config)
    assert o.add_fields == ["op"] and o.spark_config == {"spark.sql.x": "1"}
    c = Consumer(spark, o)
    assert c.handle_batch(frame(spark, event("srv.a", row(1)), event("srv.b", row(1)), event("c", row(1))), 1) == {"a": True, "c": True}
    with pytest.raises(ValueError, match="no transform"):
        Consumer(spark, options(tmp_path, transforms=["nothing"])).handle_batch(frame(spark, event("a", row(1))), 1)


def test_follow_waits_until_a_batch_is_full(spark, tmp_path):
    from threading import Event, Timer

    (tmp_path / "in").mkdir()

    def put(name, n):
        rows = [event("a", row(i, name)) for i in range(n)]
        (tmp_path / f"{name}.tmp").write_text("\n".join(json.dumps(dict(zip(("destination", "key", "value"), r))) for r in rows))
        (tmp_path / f"{name}.tmp").rename(tmp_path / "in" / f"{name}.json")

    put("f1", 3)
    o = options(tmp_path, batch_size_wait="MaxBatchSizeWait", max_batch_size=5, batch_size_wait_max_wait_ms=60_000, batch_size_wait_wait_interval_ms=200)
    c = Consumer(spark, o)
    later = Timer(3, put, ("f2", 4))
    later.start()
    assert c.follow(f"file://{tmp_path}/in", f"{tmp_path}/cp", Event(), rounds=1) == 1
    assert c.table("a").read().count() == 7 and len(c.table("a").versions()) == 2 and c.metrics["events"] == 7


def test_typed_records(spark):
    rows = spark.createDataFrame([(("7", bytearray(b"\x04\xd2")),)], "value struct<id:string,d:binary>")
    target = spark.createDataFrame([], "id int, d decimal(10,2), missing string").schema
    target["d"].metadata = {"wire": json.dumps({"parameters": {"scale": "2"}})}
    got = project_typed(rows, target, Options()).first()
    assert (got["id"], str(got["d"]), got["missing"]) == (7, "12.34", None)


def test_waits(tmp_path):
    assert isinstance(wait_strategy(Options()), NoBatchSizeWait)
    w = MaxBatchSizeWait(Options(max_batch_size=10, batch_size_wait_max_wait_ms=1000, batch_size_wait_wait_interval_ms=10))
    assert w.keep_waiting(3, 10) and not w.keep_waiting(10, 10) and not w.keep_waiting(3, 1000) and not w.keep_waiting(3, 10, True)
    with pytest.raises(ValueError):
        wait_strategy(Options(batch_size_wait="No"))


def test_stream(spark, tmp_path):
    c = Consumer(spark, options(tmp_path, upsert=True))
    for i in range(2):
        frame(spark, event("a", row(1, f"v{i}", "u"))).drop("__arrival").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        c.start(event_stream(spark, f"{tmp_path}/in", 1), f"{tmp_path}/cp", available_now=True).awaitTermination()
    assert [r["name"] for r in c.table("a").read().collect()] == ["v1"]


def test_state(spark, tmp_path):
    s = OffsetStore(spark, f"file://{tmp_path}/o")
    s.set({"key": "value", "key2": None, None: "x"})
    s.set({"second": "v"})
    again = OffsetStore(spark, f"file://{tmp_path}/o")
    assert again.get(["key", "key2", "second", "no"]) == {"key": "value", "key2": None, "second": "v", "no": None}
    assert again.table.read().count() == 1
    h = SchemaHistory(spark, f"file://{tmp_path}/h")
    assert not h.exists()
    h.initialize()
    assert h.storage_exists() and not h.exists()
    (tmp_path / "old").write_text('{"n": 0}\n\n')
    h.import_file(f"file://{tmp_path}/old")
    h.record({"n": 1})
    h.record(None)
    assert [d["n"] for d in h.recover()] == [0, 1] and h.exists()
    assert resolve_config({"a.x": "1", "s.x": "2", "s.y": "3"}, "a.", "s.") == {"x": "1", "y": "3"}


def test_archive(spark, tmp_path):
    a = Archive(spark, f"file://{tmp_path}/a")
    a.handle_batch(frame(spark, event("d1", row(1)), ("d2", None, '{"payload": 1}')), 1)
    got = {r["event_destination"]: r for r in a.table.read().collect()}
    assert got["d2"]["event_key_schema"] == "null" and got["d2"]["event_value_payload"] == "1"
    assert json.loads(got["d1"]["event_value_payload"])["id"] == 1
