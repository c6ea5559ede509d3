"""Exact deduplication by skew-safe combining, in DataFrame operations alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import row_hash, table, whole

#: The least number of salts; with more shuffle partitions there are as many as these.
SALTS = 64


def normalised(text: str) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(whole(text), r"[\x20\x09-\x0D]+", " ")


def sha256_of(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int | None = None,
    digest: Callable[[Column], Column] = sha256_of,
    with_row: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id, and the group of equal texts it is in.

    Returns (``id_col``, keep_id, group_size, kept, text_sha256[, row]); ``row`` is
    ``row_hash``.

    1. Each task combines its equal (digest, salt, text) rows: the aggregate's
       map-side half. A group that holds a third of all rows is cut to ``salts``
       parts by a hash of the id: SALTS, or spark.sql.shuffle.partitions if more.
    2. The parts meet by (digest, salt, text).
    3. The winners of the salts meet by (digest, text): at most ``salts`` rows a
       group.

    The grouping key holds the whole text at each stage, so equal digests never
    suffice. Rows then find their group by (digest, salt), which no hot group
    owns alone. Should one digest stand for two texts, its rows are joined by
    whole text instead.

    Null text: the empty text. Null id: never the smallest; its rows count and
    are listed, and stay only if no id of the group is known. Rows that repeat an
    id and a text are rows of one document and get the same answer. Empty table:
    no rows. Other columns are ignored.
    """
    if salts is None:
        salts = max(SALTS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    named = row_hash(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("norm"), *([named.alias("row")] if with_row else [])).select(
        "id",
        *(["row"] if with_row else []),
        "norm",
        digest(F.col("norm")).alias("digest"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"),
    )
    groups = table(_groups(rows).drop("norm"), "dedup-groups")
    doubtful = groups.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest")
    if doubtful.isEmpty():
        found = _members(rows, groups, ["digest", "salt"])
    else:
        doubtful = table(doubtful, "dedup-doubtful")
        sure = _members(
            rows.join(doubtful, "digest", "left_anti"),
            groups.join(doubtful, "digest", "left_anti"),
            ["digest", "salt"],
        )
        mixed = rows.join(doubtful, "digest", "left_semi")
        found = sure.unionByName(_members(mixed, _groups(mixed), ["digest", "salt", "norm"]))
    return found.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
        *(["row"] if with_row else []),
    )


def _groups(rows: DataFrame) -> DataFrame:
    """(digest, norm, keep_id, group_size, salts, text_sha256) per text."""
    parts = rows.groupBy("digest", "salt", "norm").agg(
        F.min("id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return parts.groupBy("digest", "norm").agg(
        F.min("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.collect_list("salt").alias("salts"),
    ).withColumn("text_sha256", F.sha2("norm", 256))


def _members(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Every row with its group; a group has a row for each of its salts."""
    spread = groups.withColumn("salt", F.explode("salts")).drop("salts")
    own = [c for c in rows.columns if c in ("id", "row")]
    return rows.select(*own, *keys).join(spread, keys).select(*own, "keep_id", "group_size", "text_sha256")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
