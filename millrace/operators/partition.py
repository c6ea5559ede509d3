"""Partition transforms: parsing, hidden columns, and predicates that prune."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CALL = re.compile(r"(\w+)\((.+)\)")
_TIME = {"year": "years", "years": "years", "month": "months", "months": "months", "day": "days", "days": "days", "hour": "hours", "hours": "hours"}


@dataclass(frozen=True)
class Transform:
    kind: str
    column: str
    width: int = 0

    @property
    def name(self) -> str:
        return f"_p_{self.column}" + ("" if self.kind == "identity" else f"_{self.kind}")

    def __str__(self) -> str:
        inside = f"{self.column}, {self.width}" if self.width else self.column
        return self.column if self.kind == "identity" else f"{self.kind}({inside})"

    def value(self, c: Column, kind: T.DataType) -> Column:
        """What a value's partition is."""
        if self.kind == "identity":
            return c
        if self.kind in ("bucket", "truncate"):
            if self.kind == "bucket":
                return F.pmod(F.hash(c), F.lit(self.width))
            return F.substring(c, 1, self.width) if isinstance(kind, T.StringType) else c - F.pmod(c, F.lit(self.width))
        local = c.cast("timestamp_ntz")
        if self.kind == "years":
            return F.year(local) - 1970
        if self.kind == "months":
            return (F.year(local) - 1970) * 12 + F.month(local) - 1
        if self.kind == "days":
            return F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date"))
        days = F.datediff(local.cast("date"), F.lit("1970-01-01").cast("date"))
        return days.cast("bigint") * 24 + F.hour(local)

    def prunes(self, kind: T.DataType, low, high) -> Column | None:
        """The predicate on the hidden column that values in low..high imply."""
        if self.kind == "bucket":
            return F.col(self.name) == self.value(F.lit(low).cast(kind), kind) if low == high and low is not None else None
        out = None
        for bound, op in ((low, "__ge__"), (high, "__le__")):
            if bound is not None:
                p = getattr(F.col(self.name), op)(self.value(F.lit(bound).cast(kind), kind))
                out = p if out is None else out & p
        return out


def parse(entry: str) -> Transform:
    """``column`` or ``transform(column[, width])``."""
    entry = entry.strip()
    call = _CALL.fullmatch(entry)
    if not call:
        if "(" in entry:
            raise ValueError(f"not a partition: {entry}")
        return Transform("identity", entry)
    kind, args = call[1].lower(), [a.strip() for a in call[2].split(",")]
    if kind in ("identity", *_TIME) and len(args) == 1:
        return Transform(_TIME.get(kind, kind), args[0])
    if kind in ("bucket", "truncate"):
        if len(args) != 2 or not args[1].isdigit() or not int(args[1]):
            raise ValueError(f"{kind} takes a column and a width: {entry}")
        return Transform(kind, args[0], int(args[1]))
    raise ValueError(f"unsupported partition transform: {entry}")


def spec(entries: list[str], schema: T.StructType, strict: bool) -> list[Transform]:
    """Parsed entries; a column that the schema lacks is an error if strict, else left out."""
    out = []
    for t in map(parse, entries):
        if t.column in schema.names:
            out.append(t)
        elif strict:
            raise ValueError(f"partition column {t.column} isn't in the schema")
    return out
