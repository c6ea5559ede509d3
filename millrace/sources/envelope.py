"""Decoding of raw change events: destination, key and value with their schemas."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.coerce import from_json, from_typed, member, wire_of
from millrace.options import Options
from millrace.plans.schema_map import struct_schema


def as_text(events: DataFrame, name: str) -> Column:
    """A text or binary column as text; another type is an error."""
    kind = events.schema[name].dataType
    if isinstance(kind, (T.StringType, T.NullType)):
        return F.col(name).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.decode(F.col(name), "UTF-8")
    raise TypeError(f"{name} is {kind.simpleString()}; events hold text or bytes")


def decode(events: DataFrame) -> DataFrame:
    """(destination, key, value[, ...]) with key_schema, key_payload, value_schema, value_payload as text.

    An enveloped document is parsed once; a bare one is its own payload.
    """
    texts = {c: as_text(events, c) for c in ("key", "value")}
    out = events.withColumns(texts).withColumns({f"__{c}": F.from_json(c, "schema string, payload string") for c in texts})
    parts = {}
    for c in texts:
        schema, payload = F.col(f"__{c}.schema"), F.col(f"__{c}.payload")
        bare = schema.isNull() & payload.isNull() & ~F.coalesce(F.array_contains(F.json_object_keys(c), "payload"), F.lit(False))
        parts[f"{c}_schema"] = schema
        parts[f"{c}_payload"] = F.when(bare, F.when(F.trim(c) != "null", F.col(c))).otherwise(payload)
    return out.withColumns(parts).drop("__key", "__value")


def decode_typed(events: DataFrame) -> DataFrame:
    """The same columns for typed records: key and value are structs, whose types are their schemas.

    A key may be all null; anything else that isn't a struct is an error, as is a null value.
    """
    out = events
    for c in ("key", "value"):
        kind = events.schema[c].dataType
        if isinstance(kind, T.StructType):
            out = out.withColumn(f"{c}_schema", F.lit(json.dumps(struct_schema(kind), sort_keys=True)))
        elif c == "key" and isinstance(kind, T.NullType):
            out = out.withColumn("key_schema", F.lit(None).cast("string"))
        else:
            raise TypeError(f"{c} is {kind.simpleString()}; connect events hold structs")
        out = out.withColumn(f"{c}_payload", F.col(c))
    return out


def has_key(payload: str = "key_payload") -> Column:
    """Whether an event has key data."""
    return F.col(payload).isNotNull()


#: Where an added field without a dot is found (fixed values): in the source block, else at the top.
IN_SOURCE = ("db", "lsn", "schema", "table")


def unwrapped_schema(value: dict, options: Options) -> dict | None:
    """The schema of a change envelope's row with its added fields; None if it isn't an envelope, or stays one.

    A field that comes from the envelope carries its ``path`` there.
    """
    top = {f["field"]: f for f in value.get("fields", [])}
    if not options.unwrap or options.nested_as_variant or not {"before", "after", "op"} <= top.keys():
        return None
    rows = (top["after"] if top["after"].get("fields") else top["before"]).get("fields", [])
    added = []
    for name in options.add_fields:
        path = f"source.{name}" if name in IN_SOURCE else name
        spec = {"fields": value["fields"]}
        for step in path.split("."):
            spec = next((f for f in (spec or {}).get("fields") or [] if f["field"] == step), None)
        if spec is not None:
            added.append(spec | {"field": "__" + name.replace(".", "_"), "path": path, "optional": True})
    if options.delete_mode == "rewrite":
        added.append({"field": "__deleted", "type": "boolean", "optional": True, "path": "op"})
    return {"type": "struct", "fields": rows + added}


def _without_null_values(events: DataFrame, options: Options, payload: str) -> DataFrame:
    """Tombstones are dropped by the options, else a null value is an error: there is no row to write."""
    if options.unwrap and options.drop_tombstones:
        return events.where(F.col(payload).isNotNull())
    kind = events.schema[payload].dataType
    bad = F.raise_error(F.lit("Cannot convert null value")).cast(kind)
    return events.withColumn(payload, F.when(F.col(payload).isNotNull(), F.col(payload)).otherwise(bad))


def project_json(
    events: DataFrame, schema: T.StructType, options: Options, payload: str = "value_payload", keep: tuple[str, ...] = (), unwrapped: bool = False
) -> DataFrame:
    """Decoded events as rows of ``schema``, by name; a missing field is null, others are ignored.

    ``unwrapped``: the documents are change envelopes, whose row is after, or before where there is no after.
    """
    parsed = _without_null_values(events, options, payload).select(*keep, F.parse_json(payload).alias("__doc"))

    def at(path: str) -> Column:
        found = F.col("__doc")
        for step in path.split("."):
            found = member(found, step)
        return found

    if unwrapped:
        op = F.try_variant_get("__doc", "$.op", "string")
        parsed = parsed.withColumns({"__row": F.coalesce(at("after"), at("before")), "__is_delete": op == "d"}).where("__row IS NOT NULL")
        if options.delete_mode == "drop":
            parsed = parsed.where(~F.coalesce("__is_delete", F.lit(False)))

    def value(f: T.StructField) -> Column:
        wire = wire_of(f)
        if unwrapped and f.name == "__deleted" and wire.get("path"):
            return F.coalesce("__is_delete", F.lit(False))
        found = at(wire["path"]) if unwrapped and wire.get("path") else member(F.col("__row" if unwrapped else "__doc"), f.name)
        return from_json(found, f.dataType, wire, options, f.name)

    return parsed.select(*keep, *(value(f).alias(f.name) for f in schema.fields))


def project_typed(
    events: DataFrame, schema: T.StructType, options: Options, value: str = "value", keep: tuple[str, ...] = (), unwrapped: bool = False
) -> DataFrame:
    """Events whose value is a struct column (decoded records) as rows of ``schema``, by name."""
    have = events.schema[value].dataType
    if not isinstance(have, T.StructType):
        raise TypeError(f"{value} is {have.simpleString()}; connect events hold structs")
    rows = _without_null_values(events, options, value)
    base, kind = F.col(value), have
    if unwrapped:
        rows = rows.withColumn("__row", F.coalesce(base["after"], base["before"])).where("__row IS NOT NULL")
        if options.delete_mode == "drop":
            rows = rows.where(~F.coalesce(base["op"] == "d", F.lit(False)))
        kind = have["after"].dataType if isinstance(have["after"].dataType, T.StructType) else have["before"].dataType

    def one(f: T.StructField) -> Column:
        wire = wire_of(f)
        at, of = (F.col("__row"), kind) if unwrapped else (base, have)
        steps = [f.name]
        if unwrapped and wire.get("path"):
            if f.name == "__deleted":
                return F.coalesce(base["op"] == "d", F.lit(False))
            at, of, steps = base, have, wire["path"].split(".")
        for step in steps:
            if not isinstance(of, T.StructType) or step not in of.names:
                return F.lit(None).cast(f.dataType)
            at, of = at[step], of[step].dataType
        return from_typed(at, of, f.dataType, wire, options, f.name)

    return rows.select(*keep, *(one(f).alias(f.name) for f in schema.fields))
