"""What the operators share: the scratch folder, Arrow blocks and components."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch; texts can be long, so a batch holds few of them.
ARROW_ROWS = "512"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where the session names none and runs on one machine (as in tests), a temporary
    folder of this machine is set as the checkpoint folder and used. On a cluster
    that is an error, as executors would lose what they write.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = spark.sparkContext.getCheckpointDir()
        if known:
            return known.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session, or its JVM, may be gone by now
        pass


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it again.

    This cuts the lineage: a lost executor costs no recomputation of what is
    below it.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # its shuffle files go when it is written
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(stored: DataFrame) -> None:
    """Delete a table that ``table`` wrote and nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        _remove(stored.sparkSession, path)


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to few rows, as whole texts pass through them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def whole(text: str) -> Column:
    """The text column as string, null as the empty string."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def row_hash(id_: Column, text: Column) -> Column:
    """A hash of a row's id and text (null as empty), never null: with the id, it tells rows of a repeated id apart."""
    return F.xxhash64(id_, F.coalesce(text.cast("string"), F.lit("")))


def blocks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Join Arrow batches to tables of about ``limit`` bytes (or one batch, if larger)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long) by large-star and small-star.

    Returns (node, component): a row for each node that has an edge to another
    node, with the smallest node that it can reach. Every round is written as a
    table, and dropped when the next one is; nothing but the count and a digest of its
    links reaches the driver, and the rounds end when these stay as they are. Hubs are never gathered: the stars
    are joins on node and its minimum.
    """
    links = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    links = table(links, "links-0")
    before, after = None, _digest(links)
    while after != before:
        last, links = links, table(_star(_star(links, larger=True), larger=False), "links")
        drop(last)
        before, after = after, _digest(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _digest(links: DataFrame) -> tuple:
    """Count and two 64-bit digests of distinct links; the order of rows doesn't matter."""
    found = links.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", F.lit(1), "a"))
    )
    return tuple(found.first())


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One star step over links a > b.

    Large star: every larger neighbour of a node is linked to the node's smallest
    neighbour (itself included). Small star: every smaller neighbour is.
    """
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        out = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of queries that are done; else they stay until memory runs short."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
