"""Conversions of wire values, as Column expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.options import TS_MS_FIELDS, Options
from millrace.plans.schema_map import logical

_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def _path(name: str) -> str:
    return "$['" + name.replace("\\", "\\\\").replace("'", "\\'") + "']"


def member(variant: Column, name: str) -> Column:
    """A field of a JSON object, null if it is missing or JSON null."""
    got = F.try_variant_get(variant, _path(name), "variant")
    return F.when(~F.is_variant_null(got), got)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_text(v: Column) -> Column:
    return _kind(v) == "STRING"


def _is_nested(v: Column) -> Column:
    return _kind(v).startswith("OBJECT") | _kind(v).startswith("ARRAY")


def json_int(v: Column, kind: str = "bigint") -> Column:
    """Numbers are cut, numeric text parses, booleans are 1 and 0, anything else is 0; null stays."""
    got = F.coalesce(
        F.try_variant_get(v, "$", kind),
        F.expr("CAST(NULL AS BIGINT)") if kind == "bigint" else F.lit(None).cast(kind),
    )
    return F.when(v.isNotNull(), F.coalesce(got, F.lit(0).cast(kind)))


def json_double(v: Column) -> Column:
    """Numbers and numeric text; anything else is 0."""
    return F.when(v.isNotNull(), F.coalesce(F.try_variant_get(v, "$", "double"), F.lit(0.0)))


def json_float(v: Column) -> Column:
    """Numbers only; text too is 0."""
    got = F.when(~_is_text(v), F.try_variant_get(v, "$", "float"))
    return F.when(v.isNotNull(), F.coalesce(got, F.lit(0.0).cast("float")))


def json_boolean(v: Column) -> Column:
    """Whole numbers other than 0 and the text true; anything else is false."""
    kind = _kind(v)
    got = (
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint") != 0)
        .when(kind == "STRING", F.trim(F.try_variant_get(v, "$", "string")) == "true")
    )
    return F.when(v.isNotNull(), F.coalesce(got, F.lit(False)))


def json_string(v: Column) -> Column:
    """Text; objects and arrays as JSON; numbers and booleans are null."""
    return F.when(_is_text(v), F.try_variant_get(v, "$", "string")).when(_is_nested(v), F.to_json(v))


def unscaled(data: Column) -> Column:
    """A big-endian two's-complement number of up to 16 bytes, as decimal(38,0)."""
    digits = F.hex(data)
    negative = F.substring(digits, 1, 1) >= "8"
    fill = F.when(negative, "F").otherwise("0")
    padded = F.concat(F.repeat(fill, F.lit(32) - F.length(digits)), digits)
    size = F.when(negative, F.translate(padded, "0123456789ABCDEF", "FEDCBA9876543210")).otherwise(padded)
    high, low = (F.conv(F.substring(size, i, 16), 16, 10).cast("decimal(20,0)") for i in (1, 17))
    number = (high * F.expr("18446744073709551616BD") + low).cast("decimal(38,0)")
    return F.when(negative, (F.lit(-1).cast("decimal(38,0)") - number).cast("decimal(38,0)")).otherwise(number)


def decimal_of_bytes(data: Column, precision: int, scale: int) -> Column:
    power = F.expr(f"CAST('1{'0' * scale}' AS DECIMAL(38,0))")
    return F.when(data.isNotNull(), (unscaled(data) / power).cast(f"decimal({precision},{scale})")) if scale else unscaled(
        data
    ).cast(f"decimal({precision},0)")


def decimal_of(v: Column, precision: int, scale: int) -> Column:
    """A number or numeric text, rounded half up to the scale."""
    return v.cast(f"decimal({precision},{scale})")


def uuid_of(text: Column) -> Column:
    return F.when(text.isNull(), None).when(text.rlike(_UUID), F.lower(text)).otherwise(
        F.raise_error(F.concat(F.lit("not a UUID: "), text)).cast("string")
    )


def binary_of(text: Column) -> Column:
    """Base64 text as bytes; other text is an error."""
    return F.to_binary(text, F.lit("base64"))


def date_of_days(days: Column) -> Column:
    return F.date_from_unix_date(days.cast("int"))


def date_of_text(text: Column) -> Column:
    """An ISO date, with or without a zone mark."""
    return F.to_date(F.regexp_replace(text, "(Z|[+-][0-9]{2}:[0-9]{2})$", ""))


def _micros(number: Column, unit: str) -> Column:
    if unit == "millis":
        return number.cast("bigint") * 1000
    if unit == "micros":
        return F.expr("1L") * number.cast("bigint")
    # a bigint of nanos ends in the year 2262, a timestamp doesn't
    return F.floor(number.cast("decimal(38,0)") / F.lit(1000).cast("decimal(20,0)")).cast("bigint")


def timestamp_ntz_of(number: Column, unit: str) -> Column:
    """Epoch millis, micros or nanos (these may be a decimal of scale 0) as a local time of UTC."""
    at = F.timestamp_micros(_micros(number, unit))
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz"))


def timestamp_of(number: Column, unit: str) -> Column:
    return F.timestamp_micros(_micros(number, unit))


def timestamp_ntz_of_text(text: Column) -> Column:
    """ISO text; an offset is dropped and the local time kept."""
    return F.to_timestamp_ntz(F.regexp_replace(text, "(Z|[+-][0-9]{2}:?[0-9]{2})(\\[.*\\])?$", ""))


def timestamp_of_text(text: Column) -> Column:
    """ISO text with an offset; without one it is UTC."""
    has = text.rlike("(Z|[+-][0-9]{2}:?[0-9]{2})$")
    return F.to_timestamp(F.when(has, text).otherwise(F.concat(text, F.lit("Z"))))


def time_of(number: Column, unit: str) -> Column:
    """Time of day, as text with microseconds (Spark here has no TIME type)."""
    return F.date_format(timestamp_ntz_of(number, unit), "HH:mm:ss.SSSSSS")


_UNIT = {"time.Timestamp": "millis", "data.Timestamp": "millis", "time.MicroTimestamp": "micros", "time.NanoTimestamp": "nanos"}


def _unit(sem: str, options: Options) -> str:
    mode = options.time_precision_mode.lower()
    return _UNIT.get(sem) or {"nanoseconds": "nanos", "connect": "millis"}.get(mode, "micros")


def from_json(v: Column, kind: T.DataType, wire: dict, options: Options, name: str = "") -> Column:
    """A value of a parsed JSON document (null where missing) as ``kind``."""
    sem, params = logical(wire.get("name")), wire.get("parameters") or {}
    text, number = F.try_variant_get(v, "$", "string"), F.try_variant_get(v, "$", "bigint")
    if isinstance(kind, T.VariantType):
        return v
    if isinstance(kind, T.StructType):
        wires = {f["field"]: f for f in wire.get("fields", [])}
        inner = [from_json(member(v, f.name), f.dataType, wires.get(f.name, {}), options, f.name).alias(f.name) for f in kind.fields]
        return F.when(v.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(v, "$", "array<variant>")
        each = lambda x: from_json(F.when(~F.is_variant_null(x), x), kind.elementType, wire.get("items") or {}, options)
        return F.transform(items, each)
    if isinstance(kind, T.MapType):
        pairs = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
        value = lambda x: from_json(F.when(~F.is_variant_null(x), x), kind.valueType, wire.get("values") or {}, options)
        return F.map_from_entries(
            F.transform(pairs, lambda p: F.struct(p["key"].cast(kind.keyType).alias("key"), value(p["value"]).alias("value")))
        )
    if isinstance(kind, T.LongType):
        return json_int(v, "bigint")
    if isinstance(kind, T.IntegerType):
        return json_int(v, "int")
    if isinstance(kind, T.FloatType):
        return json_float(v)
    if isinstance(kind, T.DoubleType):
        return json_double(v)
    if isinstance(kind, T.BooleanType):
        return json_boolean(v)
    if isinstance(kind, T.DecimalType):
        plain = decimal_of(F.try_variant_get(v, "$", "decimal(38,18)" if kind.precision - kind.scale <= 20 else kind.simpleString()), kind.precision, kind.scale)
        if wire.get("type") != "bytes":
            return plain
        own = int(params.get("scale", kind.scale))
        packed = decimal_of_bytes(F.unbase64(text), 38, own).cast(kind.simpleString())
        return F.when(_is_text(v) & ~text.rlike(r"^[+-]?[0-9]*\.[0-9]+$"), packed).otherwise(plain)
    if isinstance(kind, T.BinaryType):
        return binary_of(text)
    if isinstance(kind, T.DateType):
        return F.when(_is_text(v), date_of_text(text)).otherwise(date_of_days(number))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zoned = isinstance(kind, T.TimestampType)
        unit = "millis" if name in TS_MS_FIELDS else _unit(sem, options)
        if zoned and name not in TS_MS_FIELDS and not sem:
            unit = "millis"
        of_number, of_text = (timestamp_of, timestamp_of_text) if zoned else (timestamp_ntz_of, timestamp_ntz_of_text)
        bad = F.raise_error(F.concat(F.lit(f"{name}: not a timestamp: "), F.to_json(v))).cast(kind)
        return F.when(v.isNull(), None).when(_is_text(v), of_text(text)).when(number.isNotNull(), of_number(number, unit)).otherwise(bad)
    if sem == "data.Uuid":
        return uuid_of(text)
    return json_string(v)


def from_typed(c: Column, have: T.DataType, kind: T.DataType, wire: dict, options: Options, name: str = "") -> Column:
    """A value of a typed column (a decoded struct record) as ``kind``; what can't be cast is an error."""
    sem, params = logical(wire.get("name")), wire.get("parameters") or {}
    if isinstance(kind, T.VariantType):
        return F.to_variant_object(c) if isinstance(have, (T.StructType, T.ArrayType, T.MapType)) else c.cast("variant")
    if isinstance(kind, T.StructType):
        there = {f.name: f for f in have.fields}
        wires = {f["field"]: f for f in wire.get("fields", [])}
        inner = [
            (from_typed(c[f.name], there[f.name].dataType, f.dataType, wires.get(f.name, {}), options, f.name) if f.name in there else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in kind.fields
        ]
        return F.when(c.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: from_typed(x, have.elementType, kind.elementType, wire.get("items") or {}, options))
    if isinstance(kind, T.MapType):
        pair = lambda p: F.struct(
            from_typed(p["key"], have.keyType, kind.keyType, wire.get("keys") or {}, options).alias("key"),
            from_typed(p["value"], have.valueType, kind.valueType, wire.get("values") or {}, options).alias("value"),
        )
        return F.map_from_entries(F.transform(F.map_entries(c), pair))
    if isinstance(kind, T.DecimalType):
        if isinstance(have, T.BinaryType):
            return decimal_of_bytes(c, 38, int(params.get("scale", kind.scale))).cast(kind.simpleString())
        return decimal_of(c, kind.precision, kind.scale)
    if isinstance(kind, T.BooleanType) and isinstance(have, T.StringType):
        return F.lower(c) == "true"
    if isinstance(kind, T.StringType):
        text = F.decode(c, "UTF-8") if isinstance(have, T.BinaryType) else c.cast("string")
        return uuid_of(text) if sem == "data.Uuid" else text
    if isinstance(kind, T.BinaryType):
        return binary_of(c) if isinstance(have, T.StringType) else c
    whole = isinstance(have, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    if isinstance(kind, T.DateType):
        return date_of_days(c) if whole else date_of_text(c) if isinstance(have, T.StringType) else c.cast("date")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zoned = isinstance(kind, T.TimestampType)
        unit = "millis" if name in TS_MS_FIELDS or (zoned and not sem) else _unit(sem, options)
        if whole:
            return (timestamp_of if zoned else timestamp_ntz_of)(c, unit)
        if isinstance(have, T.StringType):
            return (timestamp_of_text if zoned else timestamp_ntz_of_text)(c)
    return c.cast(kind)


def wire_of(field: T.StructField) -> dict:
    """The wire schema that a mapped field remembers."""
    return json.loads(field.metadata.get("wire", "{}"))


def text_of(offset: Column) -> Column:
    """Bytes of an offset as UTF-8 text."""
    return offset.cast("string")
