"""Flattening of change envelopes, and column projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Source of each added field, by its option entry.
_OF_SOURCE = {"table", "db", "schema", "lsn"}


def flatten(events: DataFrame, add_fields: Sequence[str] = ("op", "table", "source.ts_ms"), drop_tombstones: bool = True) -> DataFrame:
    """before/after envelopes as rows of after (before, for deletes) with ``__`` fields and ``__deleted``.

    ``events`` has struct columns before and after, op, and what ``add_fields`` names.
    Rows with neither before nor after (tombstones) are dropped unless asked for.
    """
    row = F.coalesce("after", "before")
    names = events.schema["after"].dataType.names
    extra: list[Column] = []
    for name in add_fields:
        path = name if "." in name or name not in _OF_SOURCE else f"source.{name}"
        head = path.split(".")[0]
        if head in events.columns:
            extra.append(F.col(path).alias("__" + name.replace(".", "_")))
    kept = [c for c in events.columns if c not in ("before", "after", "op", "source", *(n.split(".")[0] for n in add_fields))]
    out = events.where("after IS NOT NULL OR before IS NOT NULL") if drop_tombstones else events
    return out.select(*kept, *(row[n].alias(n) for n in names), *extra, (F.col("op") == "d").alias("__deleted"))


def without_columns(rows: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return rows.drop(*excluded)


def rename_key(rows: DataFrame, old: str, new: str) -> DataFrame:
    return rows.withColumnRenamed(old, new)


def keys_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns alone; a dotted name is a field of a struct, and lists or maps have no keys."""
    for k in keys:
        kind = rows.select(k).schema[0].dataType
        if kind.typeName() in ("array", "map"):
            raise ValueError(f"{k}: a {kind.typeName()} can't be a key")
    return rows.select(*(F.col(k).alias(k.replace(".", "_")) for k in keys))
