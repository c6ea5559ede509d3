import pytest
from pyspark.sql import types as T

from millrace.operators.partition import Transform, parse, spec
from millrace.options import Options, config_subset, mask_secrets, split_list
from millrace.plans.schema_map import field_ids, map_schema, merge_schema, wire_type


def f(name, kind, sem=None, **more):
    return {"field": name, "type": kind} | ({"name": sem} if sem else {}) | more


def test_defaults():
    o = Options()
    assert (o.upsert, o.upsert_keep_deletes, o.format_value, o.time_precision_mode) == (False, True, "connect", "isostring")
    assert (o.concurrent_uploads, o.batch_size_wait_max_wait_ms, o.format_version) == (1, 300_000, 3)


def test_properties():
    o = Options.from_properties({
        "x.sink.lake.upsert": "true", "x.sink.lake.upsert-keep-deletes": "false", "x.sink.lake.partition-by": r"day(ts), bucket(id\, 4)",
        "x.sink.lake.partition-by.srv.a.b": "c", "x.sink.lake.excluded-columns": "a,b", "x.sink.batch.concurrent-uploads": "3", "x.other": "1",
    })
    assert o.upsert and not o.upsert_keep_deletes and o.concurrent_uploads == 3
    assert o.partition_by == ["day(ts)", "bucket(id, 4)"] and o.excluded_columns == ["a", "b"]
    assert o.partition_spec("srv.a.b") == (["c"], True) and o.partition_spec("other")[1] is False
    assert config_subset({"a.b": "1", "c": "2"}, "a.") == {"b": "1"}
    assert mask_secrets({"db.password": "x", "n": "1"}) == {"db.password": "*****", "n": "1"}
    assert split_list("a, ,b(1,2)") == ["a", "b(1,2)"]


@pytest.mark.parametrize("bad", [
    {"format_value": "json"}, {"format_key": "avro", "format_value": "avro"}, {"time_precision_mode": "adaptive"},
    {"write_format_default": "avro"}, {"batch_size_wait_wait_interval_ms": 400_000},
])
def test_bad_options(bad):
    with pytest.raises(ValueError):
        Options(**bad)


@pytest.mark.parametrize("spec_, want", [
    (f("a", "int8"), "int"), (f("a", "int64"), "bigint"), (f("a", "float32"), "float"), (f("a", "bytes"), "binary"),
    (f("a", "int32", "x.time.Date"), "date"), (f("a", "string", "x.time.IsoDate"), "date"), (f("__ts_ms", "int64"), "timestamp"),
    (f("__source_ts_ns", "int64"), "bigint"), (f("a", "int64", "x.time.MicroTimestamp"), "timestamp_ntz"),
    (f("a", "string", "x.time.ZonedTimestamp"), "timestamp"), (f("a", "int64", "x.time.MicroTime"), "bigint"),
    (f("a", "string", "x.time.ZonedTime"), "string"), (f("a", "bytes", "y.data.Decimal"), "decimal(38,10)"),
    (f("a", "bytes", "y.data.Decimal", parameters={"scale": "2", "connect.decimal.precision": "5"}), "decimal(5,2)"),
    (f("a", "bytes", "y.data.Decimal", parameters={"scale": "5"}), "decimal(38,5)"),
    (f("a", "bytes", "y.data.Decimal", parameters={"scale": "-1", "connect.decimal.precision": "6"}), "decimal(6,6)"),
    (f("a", "array", items={"type": "int32"}), "array<int>"), (f("a", "map", keys={"type": "string"}, values={"type": "int32"}), "map<string,int>"),
    (f("a", "what"), "string"),
])
def test_types(spec_, want):
    assert wire_type(spec_, Options(), spec_["field"]).simpleString() == want


def test_adaptive_mode_keeps_longs():
    o = Options(time_precision_mode="adaptive", time_precision_mode_adaptive_allowed=True)
    assert wire_type(f("a", "int64", "x.time.Timestamp"), o, "a").simpleString() == "bigint"


def test_keys_and_nullability():
    value = {"type": "struct", "fields": [f("id", "int32", optional=False), f("n", "string", optional=False), f("drop", "string")]}
    got = map_schema(value, {"fields": [f("id", "int32")]}, Options(excluded_columns=["drop"]))
    assert got.keys == ["id"] == got.sort and [x.nullable for x in got.schema] == [False, True]
    kept = map_schema(value, None, Options(preserve_required_property=True))
    assert [x.nullable for x in kept.schema] == [False, False, True] and kept.keys == []
    envelope = {"fields": [f("before", "struct", fields=[]), f("after", "struct", fields=[]), f("op", "string")]}
    with pytest.raises(ValueError):
        map_schema(envelope, {"fields": [f("id", "int32")]}, Options())
    assert map_schema(envelope, {"fields": [f("id", "int32")]}, Options(create_identifier_fields=False)).keys == []
    assert map_schema(envelope, None, Options(nested_as_variant=True)).schema["after"].dataType == T.VariantType()
    with pytest.raises(ValueError):
        map_schema({"fields": [f("id", "array", items={"type": "string"})]}, {"fields": [f("id", "array")]}, Options())


def test_field_ids():
    value = {"fields": [f("name", "string"), f("pay", "array", items={"type": "int32"}), f("schedule", "array", items={"type": "string"}), f("x", "string")]}
    ids = field_ids(value)
    assert (ids["name"], ids["pay"], ids["schedule"], ids["x"]) == (1, 2, 5, 8)


def test_merge(spark):
    def kind(ddl):
        return spark.createDataFrame([], ddl).schema

    merged = merge_schema(kind("a int, s struct<x:int>, d decimal(5,2)"), kind("s struct<x:bigint,y:string>, a bigint, d decimal(9,2), n string"))
    assert [(x.name, x.dataType.simpleString()) for x in merged] == [
        ("a", "bigint"), ("s", "struct<x:bigint,y:string>"), ("d", "decimal(9,2)"), ("n", "string"),
    ]
    with pytest.raises(ValueError, match="Cannot change column type: x: bigint -> timestamp"):
        merge_schema(kind("x bigint"), kind("x timestamp"))


def test_partition_specs(spark):
    assert parse(" bucket(id, 8)") == Transform("bucket", "id", 8) and parse("days(ts)") == Transform("days", "ts")
    for bad in ("bucket(10, id)", "bucket(id)", "what(id)", "truncate(id, 0)"):
        with pytest.raises(ValueError):
            parse(bad)
    schema = spark.createDataFrame([], "a int").schema
    assert spec(["a", "b"], schema, strict=False) == [Transform("identity", "a")]
    with pytest.raises(ValueError):
        spec(["b"], schema, strict=True)
