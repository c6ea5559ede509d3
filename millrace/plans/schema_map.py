"""Table schemas from the schemas that events carry, and their additive evolution."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import types as T

from millrace.options import TS_MS_FIELDS, Options

_PLAIN = {
    "int8": T.IntegerType(), "int16": T.IntegerType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "float32": T.FloatType(), "float": T.FloatType(), "float64": T.DoubleType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "string": T.StringType(), "bytes": T.BinaryType(), "uuid": T.StringType(),
}


def logical(name: str | None) -> str:
    """``package.Name`` of a semantic type: the last two parts of its full name."""
    return ".".join((name or "").split(".")[-2:])


@dataclass
class Mapped:
    """A table schema with its key columns and sort order; fields remember their wire type."""

    schema: T.StructType
    keys: list[str] = field(default_factory=list)

    @property
    def sort(self) -> list[str]:
        return [k for k in self.keys if k in self.schema.names]


def wire_type(spec: dict, options: Options, name: str = "") -> T.DataType:
    """The Spark type of one wire schema."""
    kind, sem, params = spec.get("type"), logical(spec.get("name")), spec.get("parameters") or {}
    if kind == "struct":
        if options.nested_as_variant and name:
            return T.VariantType()
        return T.StructType([_field(f, options) for f in spec.get("fields", [])])
    if kind == "array":
        if options.nested_as_variant and (spec["items"] or {}).get("type") in ("struct", "array", "map"):
            return T.VariantType()
        return T.ArrayType(wire_type(spec["items"], options))
    if kind == "map":
        return T.MapType(wire_type(spec["keys"], options), wire_type(spec["values"], options))
    if kind in ("int32", "int16", "int8") and sem in ("time.Date", "data.Date"):
        return T.DateType()
    if kind == "int64":
        if name in TS_MS_FIELDS:
            return T.TimestampType()
        if sem in ("time.Timestamp", "time.MicroTimestamp", "time.NanoTimestamp", "data.Timestamp"):
            adaptive = options.time_precision_mode.lower().startswith("adaptive")
            return T.LongType() if adaptive else T.TimestampNTZType()
    if kind == "string":
        return {"time.IsoDate": T.DateType(), "time.IsoTimestamp": T.TimestampNTZType(), "time.ZonedTimestamp": T.TimestampType()}.get(
            sem, T.StringType()
        )
    if kind == "bytes" and sem == "data.Decimal":
        return _decimal(params)
    return _PLAIN.get(kind, T.StringType())


def _decimal(params: dict) -> T.DecimalType:
    if not params:
        return T.DecimalType(38, 10)
    precision = int(params.get("connect.decimal.precision") or 38)
    scale = int(params.get("scale", 10))
    precision = 38 if precision <= 0 else precision
    if scale < 0 or scale > precision:
        scale = min(10, precision)
    return T.DecimalType(precision, scale)


def _field(spec: dict, options: Options, key: bool = False) -> T.StructField:
    name = spec["field"] if "field" in spec else spec["name"]
    nullable = spec.get("optional", True) if options.preserve_required_property else not key
    meta = {"wire": json.dumps({k: v for k, v in spec.items() if k != "field"}, sort_keys=True)}
    if spec.get("doc"):
        meta["comment"] = spec["doc"]
    return T.StructField(name, wire_type(spec, options, name), nullable, meta)


def map_schema(value: dict | str, key: dict | str | None, options: Options) -> Mapped:
    """The table schema of an event's value schema; a column is key if the key schema has its name.

    A key of a map or array, or key columns of an event that isn't flattened, are errors.
    """
    value = json.loads(value) if isinstance(value, str) else value
    key = json.loads(key) if isinstance(key, str) else key
    if value is None:
        raise ValueError("an event without a schema can't make a table")
    names = [f["field"] for f in (key or {}).get("fields", [])] if options.create_identifier_fields else []
    specs = [f for f in value.get("fields", []) if f["field"] not in options.excluded_columns]
    top = {f["field"] for f in specs}
    nested = {"before", "after", "op"} <= top
    if names and nested and not options.nested_as_variant and not is_schema_change(value):
        raise ValueError("identifier fields are supported with flattened events only; set create_identifier_fields=False")
    if options.nested_as_variant or is_schema_change(value):
        names = []
    for f in specs:
        if f["field"] in names and f.get("type") in ("map", "array"):
            raise ValueError(f"{f['field']}: a {f['type']} can't be a key")
    schema = T.StructType([_field(f, options, f["field"] in names) for f in specs])
    return Mapped(schema, [n for n in names if n in top])


#: Wire types of Spark's plain types, and of those that carry a semantic name.
_WIRE = {
    "tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32", "double": "float64",
    "boolean": "boolean", "string": "string", "binary": "bytes", "void": "string",
}
_NAMED = {"date": ("int32", "time.Date"), "timestamp": ("string", "time.ZonedTimestamp"), "timestamp_ntz": ("int64", "time.MicroTimestamp")}


def struct_schema(kind: T.DataType, name: str | None = None, optional: bool = True, meta: dict | None = None) -> dict:
    """The wire schema of a typed record; what a field's metadata keeps under ``wire`` comes first."""
    out: dict = {"optional": optional} | ({"field": name} if name else {})
    plain = kind.simpleString()
    if isinstance(kind, T.StructType):
        out |= {"type": "struct", "fields": [struct_schema(f.dataType, f.name, f.nullable, f.metadata) for f in kind.fields]}
    elif isinstance(kind, T.ArrayType):
        out |= {"type": "array", "items": struct_schema(kind.elementType)}
    elif isinstance(kind, T.MapType):
        out |= {"type": "map", "keys": struct_schema(kind.keyType), "values": struct_schema(kind.valueType)}
    elif isinstance(kind, T.DecimalType):
        sizes = {"scale": str(kind.scale), "connect.decimal.precision": str(kind.precision)}
        out |= {"type": "bytes", "name": "data.Decimal", "parameters": sizes}
    elif plain in _NAMED:
        out |= dict(zip(("type", "name"), _NAMED[plain], strict=True))
    elif plain in _WIRE:
        out |= {"type": _WIRE[plain]}
    else:
        raise ValueError(f"no wire type for {plain}")
    return out | json.loads((meta or {}).get("wire", "{}"))


def is_schema_change(value: dict) -> bool:
    names = {f["field"] for f in value.get("fields", [])}
    return {"ddl", "databaseName", "tableChanges"} <= names


def rooted_keys(value: dict, key: dict | None) -> list[str]:
    """The paths of an event's key fields in its table: under ``after`` where the event isn't flattened."""
    names = [f["field"] for f in (key or {}).get("fields", [])]
    top = {f["field"]: f for f in value.get("fields", [])}
    if {"before", "after", "op"} <= top.keys():
        inside = {f["field"] for f in top["after"].get("fields") or []}
        return [f"after.{n}" for n in names if n in inside]
    return [n for n in names if n in top]


def field_ids(value: dict, start: int = 1) -> dict[str, int]:
    """Ids by path, depth first; a list takes its element's nested ids before the element's own."""
    out: dict[str, int] = {}
    counter = [start - 1]

    def next_id() -> int:
        counter[0] += 1
        return counter[0]

    def walk(spec: dict, path: str) -> None:
        out[path] = next_id()
        inside(spec, path)

    def inside(spec: dict, path: str) -> None:
        if spec.get("type") == "struct":
            for f in spec.get("fields", []):
                walk(f, f"{path}.{f['field']}")
        elif spec.get("type") == "array":
            next_id()  # a placeholder for the element
            inside(spec["items"], f"{path}.element")
            out[f"{path}.element"] = next_id()
        elif spec.get("type") == "map":
            out[f"{path}.key"], out[f"{path}.value"] = next_id(), next_id()
            inside(spec["values"], f"{path}.value")

    for f in value.get("fields", []):
        walk(f, f["field"])
    return out


#: Changes of type that keep every value.
_WIDER = {("int", "bigint"), ("int", "double"), ("float", "double")}


def wider(old: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """The type that holds both; an error where that isn't a safe widening."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schema(old, new, path)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(wider(old.elementType, new.elementType, path), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(wider(old.keyType, new.keyType, path), wider(old.valueType, new.valueType, path), True)
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return old
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType) and old.scale == new.scale:
        return old if old.precision >= new.precision else new
    if (a, b) in _WIDER:
        return new
    if (b, a) in _WIDER:
        return old
    raise ValueError(f"Cannot change column type: {path}: {a} -> {b}")


def merge_schema(old: T.StructType, new: T.StructType, path: str = "") -> T.StructType:
    """``old`` with the columns that ``new`` adds, and safely widened; nothing is dropped."""
    incoming = {f.name: f for f in new.fields}
    out = []
    for f in old.fields:
        other = incoming.pop(f.name, None)
        kind = f.dataType if other is None else wider(f.dataType, other.dataType, f"{path}{f.name}")
        optional = f.nullable or (other is not None and other.nullable) or (other is None and bool(path))
        out.append(T.StructField(f.name, kind, optional, f.metadata))
    return T.StructType(out + [T.StructField(f.name, f.dataType, True, f.metadata) for f in incoming.values()])
