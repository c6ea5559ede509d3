"""Token counts by source, language and tokenizer version, kept up by signed deltas."""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import scratch, small_batches, table, whole

KEYS = ("source", "lang", "tokenizer")
TOTALS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, tokenizers: dict[str, str], text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens): a row per document and tokenizer.

    ``tokenizers``: version name to the path of its ranks. Null text: no tokens.
    """
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("source").cast("string"), F.col("lang").cast("string"), whole(text_col).alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, lang string, tokenizer string, n_tokens bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for name, path in tokenizers.items():
                encode = _encoding(path).encode_to_numpy
                counts = np.fromiter((len(encode(t, disallowed_special=())) for t in texts), np.int64, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array([name] * len(texts), pa.string()), pa.array(counts)],
                    ["doc_id", "source", "lang", "tokenizer", "n_tokens"],
                )

    return rows.mapInArrow(work, schema)


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """The change from one set of counts to another: what was goes, what is comes."""
    return deletes(before).unionByName(inserts(after))


class TokenRollup:
    """Additive totals in a folder: a commit per batch, compacted now and then.

    ``apply`` takes signed rows (KEYS, n_docs, n_tokens); a batch id is committed once,
    by renaming a finished folder, so a repeated batch changes nothing, and a lost
    driver or executor leaves no part of one. Sums combine before the shuffle, so a
    source with a third of all rows costs no more than another. Null keys are groups
    of their own. Groups whose totals are all zero are left out.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.folder}/commits"))

    def committed(self, batch_id: str) -> bool:
        return self._fs.exists(self._path(self._commit(batch_id))) or self._folded(self._base(), quote(batch_id, safe=""))

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Add the batch to the totals; False if it was committed before."""
        if self.committed(batch_id):
            return False
        staged = f"{self.folder}/staged/{uuid.uuid4().hex}"
        changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).select(
            *(F.col(f.name).cast(f.dataType) for f in self._schema())
        ).write.parquet(staged)
        return self._publish(staged, self._commit(batch_id))

    def totals(self) -> DataFrame:
        rows = self._read(self._commits() + ([b] if (b := self._base()) else []))
        return _summed(rows)

    def compact(self) -> None:
        """Fold all commits into a new base; it lists the batches it holds."""
        commits, base = self._commits(), self._base()
        if not commits:
            return
        staged = f"{self.folder}/staged/{uuid.uuid4().hex}"
        _summed(self._read(commits + ([base] if base else []))).write.parquet(staged)
        names = self.spark.createDataFrame([(c.rsplit("/", 1)[1],) for c in commits], "batch string")
        (names if base is None else names.unionByName(self._batches(base))).write.parquet(f"{staged}/_batches")
        version = int(base.rsplit("-", 1)[1]) + 1 if base else 1
        if self._publish(staged, f"{self.folder}/base-{version}"):
            for old in [*commits, *([base] if base else [])]:
                self._fs.delete(self._path(old), True)

    def _schema(self):
        return self.spark.createDataFrame([], TOTALS).schema

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(*paths) if paths else self.spark.createDataFrame([], TOTALS)

    def _commit(self, batch_id: str) -> str:
        return f"{self.folder}/commits/{quote(batch_id, safe='')}"

    def _list(self, folder: str) -> list[str]:
        return sorted(str(s.getPath()) for s in self._fs.listStatus(self._path(folder)) if s.isDirectory())

    def _commits(self) -> list[str]:
        found, base = self._list(f"{self.folder}/commits"), self._base()
        if not base or not found:
            return found
        # only a compaction that was cut off leaves commits behind that its base holds
        names = [c.rsplit("/", 1)[1] for c in found]
        done = {r[0] for r in self._batches(base).where(F.col("batch").isin(names)).collect()}
        return [c for c, n in zip(found, names, strict=True) if n not in done]

    def _base(self) -> str | None:
        bases = [p for p in self._list(self.folder) if p.rsplit("/", 1)[1].startswith("base-")]
        return max(bases, key=lambda p: int(p.rsplit("-", 1)[1]), default=None)

    def _batches(self, base: str) -> DataFrame:
        return self.spark.read.schema("batch string").parquet(f"{base}/_batches")

    def _folded(self, base: str | None, name: str) -> bool:
        return base is not None and not self._batches(base).where(F.col("batch") == name).isEmpty()

    def _publish(self, staged: str, target: str) -> bool:
        if self._fs.exists(self._path(target)) or not self._fs.rename(self._path(staged), self._path(target)):
            self._fs.delete(self._path(staged), True)
            return False
        return True


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where(
        "n_docs <> 0 OR n_tokens <> 0"
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under two tokenizer versions, by way of every kind of change.

    Three batches insert all documents (a third each); those of the last come with
    the second version's counts under the first version's name, which a fourth batch
    revises; a fifth inserts the first batch's rows under a stale source and a sixth
    deletes them; two batches come twice. The totals are those of the documents.
    """
    import public_tokenizers

    old, new = "byte_bpe_50k", "byte_bpe_multi_50k"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = table(
        count_tokens(docs, {n: public_tokenizers.path(f"{n}.tiktoken") for n in (old, new)}), "counts"
    )
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    parts = [counts.where(part == i) for i in range(3)]
    guess = parts[2].where(F.col("tokenizer") == new).withColumn("tokenizer", F.lit(old))
    stale = parts[0].withColumn("source", F.lit("stale"))
    rollup = TokenRollup(spark, scratch(spark, "rollup"))
    rollup.apply("insert-0", inserts(parts[0]))
    rollup.apply("insert-1", inserts(parts[1]))
    rollup.apply("insert-0", inserts(parts[0]))
    rollup.apply("insert-2", inserts(guess.unionByName(parts[2].where(F.col("tokenizer") == new))))
    rollup.apply("revise-2", revisions(guess, parts[2].where(F.col("tokenizer") == old)))
    rollup.compact()
    rollup.apply("stale", inserts(stale))
    rollup.apply("drop-stale", deletes(stale))
    rollup.apply("insert-1", inserts(parts[1]))
    return rollup.totals()
