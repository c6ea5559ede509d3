from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import coerce
from millrace.options import Options
from millrace.plans.catalogue import QUERIES


def values(spark, f, docs):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    got = df.select("i", f(coerce.member(F.parse_json("d"), "v")).alias("v")).orderBy("i").collect()
    return [r["v"] for r in got]


DOCS = ['{"v": 12}', '{"v": "12"}', '{"v": true}', '{"v": 1.9}', '{"v": "abc"}', '{"v": {"a": 1}}', '{"v": null}', "{}"]


def test_json_numbers(spark):
    assert values(spark, coerce.json_int, DOCS) == [12, 12, 1, 1, 0, 0, None, None]
    assert values(spark, coerce.json_double, DOCS) == [12.0, 12.0, 1.0, 1.9, 0.0, 0.0, None, None]
    assert values(spark, coerce.json_float, DOCS)[1] == 0.0


def test_json_boolean_and_text(spark):
    assert values(spark, coerce.json_boolean, [*DOCS, '{"v": "true"}', '{"v": 0}']) == [True, False, True, False, False, False, None, None, True, False]
    assert values(spark, coerce.json_string, DOCS) == [None, "12", None, None, "abc", '{"a":1}', None, None]


@pytest.mark.parametrize("n", [0, 1, -1, 127, 128, -128, -129, 10**38 - 1, -(10**38) + 1, 1 << 64, -(1 << 64) - 5])
def test_decimal_bytes(spark, n):
    raw = n.to_bytes(max(1, ((n if n >= 0 else ~n).bit_length() + 8) // 8), "big", signed=True)
    got = spark.createDataFrame([(bytearray(raw),)], "b binary").select(coerce.decimal_of_bytes(F.col("b"), 38, 0).alias("v")).first()["v"]
    assert got == Decimal(n)


def test_decimal_rounds_half_up(spark):
    got = spark.createDataFrame([("12.345",), ("-12.345",)], "s string").select(coerce.decimal_of(F.col("s"), 5, 2).alias("v")).collect()
    assert [r["v"] for r in got] == [Decimal("12.35"), Decimal("-12.35")]


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def test_times(spark):
    n = 1_651_838_589_123_456_789
    assert one(spark, coerce.timestamp_ntz_of(F.lit(n // 10**6), "millis")) == datetime(2022, 5, 6, 12, 3, 9, 123000)
    assert one(spark, coerce.timestamp_ntz_of(F.lit(n), "nanos")) == datetime(2022, 5, 6, 12, 3, 9, 123456)
    assert one(spark, coerce.timestamp_ntz_of(F.lit(-1500), "nanos")) == datetime(1969, 12, 31, 23, 59, 59, 999998)
    assert one(spark, coerce.timestamp_ntz_of_text(F.lit("2020-01-01T10:00:00+02:00"))) == datetime(2020, 1, 1, 10)
    assert one(spark, coerce.timestamp_of_text(F.lit("2020-01-01T10:00:00")).cast("long")) == 1577872800
    assert one(spark, coerce.timestamp_of_text(F.lit("2020-01-01T10:00:00+02:00")).cast("long")) == 1577865600
    assert one(spark, coerce.date_of_text(F.lit("2017-09-15Z"))) == date(2017, 9, 15)
    assert one(spark, coerce.date_of_days(F.lit(-1))) == date(1969, 12, 31)
    assert one(spark, coerce.time_of(F.lit(3_723_004), "millis")) == "01:02:03.004000"


def test_nanos_beyond_a_bigint(spark):
    for n in (2**63 - 1, 2**63, 106_752 * 86_400_123_456_789, 8_999_999 * 86_400_123_456_789, -(2**63) - 1):
        got = spark.range(1).select(F.unix_micros(coerce.timestamp_ntz_of(F.lit(f"{n}").cast("decimal(38,0)"), "nanos").cast("timestamp")).alias("v")).first()["v"]
        assert got == n // 1000


def test_query_nanos_of_large_keys(spark, tmp_path):
    keys = [0, 1, 106_751, 106_752, 149_999, 899_999, 8_999_999, None]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    rows = QUERIES["temporal_nanos"](spark, str(tmp_path))
    got = rows.select("o_orderkey", F.unix_micros(F.col("v").cast("timestamp")).alias("v")).collect()
    assert rows.schema["v"].dataType == T.TimestampNTZType()
    assert {r["o_orderkey"]: r["v"] for r in got} == {k: k if k is None else k * 86_400_123_456_789 // 1000 for k in keys}


def test_uuid_and_binary(spark):
    u = "0F8FAD5B-D9CB-469F-A165-70867728950E"
    assert one(spark, coerce.uuid_of(F.lit(u))) == u.lower()
    assert bytes(one(spark, coerce.binary_of(F.lit("AQI=")))) == b"\x01\x02"
    for bad in (coerce.uuid_of(F.lit("no")), coerce.binary_of(F.lit("*"))):
        with pytest.raises(Exception):
            one(spark, bad)


def test_nested_json(spark):
    kind = spark.createDataFrame([], "a struct<x:int,l:array<bigint>,m:map<string,struct<y:string>>>").schema["a"].dataType
    doc = F.parse_json(F.lit('{"v": {"x": "7", "l": [1, "2", null], "m": {"k": {"y": "t"}, "n": null}}}'))
    got = one(spark, coerce.from_json(coerce.member(doc, "v"), kind, {}, Options()))
    assert (got["x"], got["l"], got["m"]["k"]["y"], got["m"]["n"]) == (7, [1, 2, None], "t", None)
    assert one(spark, coerce.from_json(coerce.member(doc, "w"), kind, {}, Options())) is None


def test_typed_values(spark):
    o = Options()
    assert one(spark, coerce.from_typed(F.lit("3"), T.StringType(), T.LongType(), {}, o)) == 3
    assert one(spark, coerce.from_typed(F.lit("TRUE"), T.StringType(), T.BooleanType(), {}, o)) is True
    with pytest.raises(Exception):
        one(spark, coerce.from_typed(F.lit("x"), T.StringType(), T.IntegerType(), {}, o))
