"""One row per key of a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Which operation wins at equal time (fixed values): larger wins.
PRIORITY = {"c": 1, "i": 1, "r": 2, "u": 3, "d": 4}


def priority(op: Column) -> Column:
    """The rank of an operation; of one that isn't known, -1."""
    table = F.create_map(*(F.lit(x) for pair in PRIORITY.items() for x in pair))
    return F.coalesce(table[op], F.lit(-1))


def checked_op(op: Column) -> Column:
    """The operation in lower case, null as c; another than u, d, r, c, i is an error."""
    low = F.lower(op)
    return F.when(op.isNull(), "c").when(low.isin(*PRIORITY), low).otherwise(
        F.raise_error(F.concat(F.lit("unexpected operation: "), op)).cast("string")
    )


def deduplicate(rows: DataFrame, keys: Sequence[str], order: str, op: str = "__op", by: str | None = None) -> DataFrame:
    """The last row of each key, and ``__new_key``.

    ``order`` is the order of arrival. Without ``by`` the last to arrive wins, and the
    key is new if its first row was an insert; with ``by`` the greatest (by, priority,
    arrival), and the key is new if that row is an insert. A null key, or a null
    ``by``, is an error. The aggregate combines before its shuffle, so a key with
    most of a batch's rows reaches its task as one row from each.
    """
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    guarded = rows.withColumn(
        order, F.when(no_key, F.raise_error(F.lit("Cannot deduplicate data with null key!")).cast(rows.schema[order].dataType)).otherwise(F.col(order))
    )
    whole = F.struct(*(F.col(c) for c in rows.columns))
    if by:
        at = F.when(F.col(by).isNull(), F.raise_error(F.lit(f"no value in {by}")).cast(rows.schema[by].dataType)).otherwise(F.col(by))
        rank = F.struct(at.alias("t"), priority(F.col(op)).alias("p"), F.col(order).alias("o"))
    else:
        rank = F.col(order)
    found = guarded.groupBy(*keys).agg(F.max_by(whole, rank).alias("__row"), F.min_by(F.col(op), F.col(order)).alias("__first"))
    new = (F.col(f"__row.{op}") if by else F.col("__first")).isin("c", "i")
    return found.select("__row.*", new.alias("__new_key"))
