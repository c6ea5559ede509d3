"""What a batch does to a table: append, soft delete or hard delete."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import checked_op, deduplicate
from millrace.options import Options
from millrace.sources.table import Table

ARRIVAL = "__arrival"


def is_delta(table: Table, options: Options) -> bool:
    """Upserts need an option and keys; all else is appended."""
    return options.upsert and bool(table.snapshot().keys)


def write_batch(table: Table, rows: DataFrame, options: Options, batch_id: str | None = None, order: str = ARRIVAL) -> bool:
    """Commit a batch of flattened rows as one snapshot; False if it was committed before.

    Appends take all rows. Upserts take the last of each key, and delete the key first,
    so a batch that comes again under another id changes nothing. Deletes are written
    as rows if they are to be kept, else their keys are deleted alone. With
    ``elide_predelete``, a key that is new needs no delete (and a replay doubles it).
    """
    if not is_delta(table, options):
        return table.append(rows.drop(order), batch_id, options.target_rows_per_file)
    keys = table.snapshot().keys
    op = options.upsert_op_field
    last = deduplicate(rows.withColumn(op, checked_op(F.col(op))), keys, order, op, options.upsert_dedup_column).persist()
    try:
        kept = last if options.upsert_keep_deletes else last.where(F.col(op) != "d")
        gone = last
        if options.elide_predelete and not options.upsert_keep_deletes:
            gone = last.where(~F.col("__new_key") | (F.col(op) == "d"))
        return table.row_delta(kept.drop(order, "__new_key"), gone.select(*keys), batch_id, options.target_rows_per_file)
    finally:
        last.unpersist()


def table_state(changes: DataFrame, keys: list[str], batch: str, order: str, op: str = "__op", by: str | None = None, keep_deletes: bool = True) -> DataFrame:
    """The rows of a table after all batches of a change log, in one aggregate.

    A later batch wins over an earlier one whatever its times; within a batch the
    order of ``deduplicate`` decides.
    """
    from millrace.operators.dedup import priority

    rank = [F.col(batch)] + ([F.col(by), priority(F.col(op))] if by else []) + [F.col(order)]
    rank = F.struct(*(c.alias(f"r{i}") for i, c in enumerate(rank)))
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*changes.columns), rank).alias("row")).select("row.*")
    return last if keep_deletes else last.where(F.col(op) != "d")
