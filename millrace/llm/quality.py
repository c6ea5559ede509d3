"""Quality classifier: an interpolated modified Kneser-Ney model of trusted bytes."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import blocks, release, row_hash, scratch, small_batches, table, whole

#: Bytes of a gram (at most 7, as grams are packed in longs), and of the alphabet with its two marks.
ORDER, ALPHABET = 4, 258
BEGIN, END = b"\x02", b"\x03"
BLOCK_BYTES, SHARD_ROWS = 8 << 20, 500_000
#: A document is rejected above this quantile of its language's trusted documents, times the slack.
QUANTILE, SLACK = 0.99, 1.15


def grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed gram that ends at each byte (and at the end mark) of each text, and how many each has."""
    pad = BEGIN * (order - 1)
    data = np.frombuffer(b"".join(pad + t + END for t in texts), np.uint8)
    lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    packed = np.zeros(len(data), np.int64)
    for i in range(order):
        packed[order - 1 :] |= data[order - 1 - i : len(data) - i].astype(np.int64) << (8 * i)
    ends = np.cumsum(lens + order - 1)
    keep = np.arange(int(lens.sum())) + np.repeat(ends - lens - (np.cumsum(lens) - lens), lens)
    return packed[keep], lens


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang_key, gram, n) over (lang_key, text): summed within blocks, then by shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, BLOCK_BYTES):
            langs = np.array(block.column(0).to_pylist(), np.int64)
            texts = [t.encode() for t in block.column(1).to_pylist()]
            for lang in np.unique(langs).tolist():
                found, n = np.unique(
                    grams([t for t, k in zip(texts, langs, strict=True) if k == lang], order)[0], return_counts=True
                )
                for i in range(0, len(found), 50_000):
                    part = found[i : i + 50_000]
                    yield pa.RecordBatch.from_pydict(
                        {"lang_key": np.full(len(part), lang), "gram": part, "n": n[i : i + 50_000].astype(np.int64)}
                    )

    counted = docs.select("lang_key", "text").mapInArrow(work, "lang_key bigint, gram bigint, n bigint")
    return counted.groupBy("lang_key", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang_key, n_bytes, gram, logp, backoff) from a stored (lang_key, gram, n) of the highest order.

    Lower orders count the distinct bytes before a gram. Each order has three
    discounts a language, from its counts of counts. A gram's probability is its
    discounted share of its context, plus what the context sets aside times the
    probability of the gram without its first byte; both come by joins on packed
    grams, which are sharded by hash. ``backoff`` is what a context sets aside.
    """
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        levels[k] = table(levels[k + 1].groupBy("lang_key", low.alias("gram")).agg(F.count("*").alias("n")), f"kn-counts-{k}")
    out, lower = None, None
    for k in range(1, order + 1):
        level = levels[k].withColumn("context", F.shiftright("gram", 8))
        seen = level.groupBy("lang_key").agg(*(F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in (1, 2, 3, 4)))
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        discount = {
            i: F.greatest(
                F.lit(0.1), F.least(F.lit(i - 0.1), F.coalesce(i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")), F.lit(0.5 * i)))
            )
            for i in (1, 2, 3)
        }
        seen = seen.select("lang_key", *(d.alias(f"d{i}") for i, d in discount.items()))
        level = level.join(seen, "lang_key").withColumn(
            "d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        )
        aside = level.groupBy("lang_key", "context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("aside"))
        level = level.join(aside, ["lang_key", "context"])
        own = (F.col("n") - F.col("d")) / F.col("total")
        if k == 1:
            level = level.withColumn("p", own + F.col("aside") / ALPHABET)
        else:
            low = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            below = lower.select("lang_key", F.col("gram").alias("tail"), F.col("p").alias("below"))
            level = level.withColumn("tail", low).join(below, ["lang_key", "tail"]).withColumn(
                "p", own + F.col("aside") * F.col("below")
            )
            backoff = aside.select("lang_key", F.col("context").alias("gram"), F.log("aside").alias("backoff"))
            part = lower.select("lang_key", "gram", F.log("p").alias("logp")).join(backoff, ["lang_key", "gram"], "full_outer")
            part = part.select("lang_key", F.lit(k - 1).alias("n_bytes"), "gram", "logp", "backoff")
            out = part if out is None else out.unionByName(part)
        lower = table(level.select("lang_key", "gram", "p"), f"kn-{k}")
        if k == 1:
            base = aside.select(
                "lang_key", F.lit(0).alias("n_bytes"), F.lit(0).cast("bigint").alias("gram"),
                (F.log("aside") - F.log(F.lit(float(ALPHABET)))).alias("logp"), F.lit(None).cast("double").alias("backoff"),
            )
            out = base
    top = lower.select(
        "lang_key", F.lit(order).alias("n_bytes"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("backoff")
    )
    return out.unionByName(top)


class Shards:
    """A stored model, read a shard at a time; a worker keeps the last few."""

    def __init__(self, path: str, shards: int, keep: int = 12):
        self.store, self.base = fs.FileSystem.from_uri(path)
        self.shards, self.keep = shards, keep
        self.held: OrderedDict[tuple, dict] = OrderedDict()

    def _shard(self, lang: int, shard: int) -> dict[int, tuple[np.ndarray, ...]]:
        key = (lang, shard)
        if key not in self.held:
            where = fs.FileSelector(f"{self.base}/lang_key={lang}/shard={shard}", allow_not_found=True)
            files = [f.path for f in self.store.get_file_info(where) if f.path.endswith(".parquet")]
            held = {}
            if files:
                t = pa.concat_tables([pq.read_table(f, filesystem=self.store, partitioning=None) for f in files])
                size, gram = t.column("n_bytes").to_numpy(), t.column("gram").to_numpy()
                logp, backoff = t.column("logp").to_numpy(), t.column("backoff").to_numpy()
                for k in np.unique(size).tolist():
                    mine = np.flatnonzero(size == k)
                    mine = mine[np.argsort(gram[mine])]
                    held[k] = (gram[mine], logp[mine], np.nan_to_num(backoff[mine], nan=0.0))
            self.held[key] = held
            while len(self.held) > self.keep:
                self.held.popitem(last=False)
        self.held.move_to_end(key)
        return self.held[key]

    def look_up(self, lang: int, size: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logp or nan, backoff or 0) of distinct grams of ``size`` bytes."""
        logp, backoff = np.full(len(wanted), np.nan), np.zeros(len(wanted))
        home = wanted % self.shards
        for s in np.unique(home).tolist():
            held = self._shard(lang, s).get(size)
            if held is None:
                continue
            mine = np.flatnonzero(home == s)
            at = np.minimum(np.searchsorted(held[0], wanted[mine]), len(held[0]) - 1)
            hit = held[0][at] == wanted[mine]
            logp[mine[hit]], backoff[mine[hit]] = held[1][at[hit]], held[2][at[hit]]
        return logp, backoff

    def score(self, lang: int, wanted: np.ndarray, order: int) -> np.ndarray:
        """log p of distinct grams; those not seen back off to fewer bytes."""
        out, _ = self.look_up(lang, order, wanted)
        open_, gram, carried = np.flatnonzero(np.isnan(out)), wanted, np.zeros(len(wanted))
        for k in range(order - 1, -1, -1):
            if not len(open_):
                break
            if k:
                ctx, back = np.unique(gram[open_] >> 8, return_inverse=True)
                carried[open_] += self.look_up(lang, k, ctx)[1][back]
            low, back = np.unique(gram[open_] & ((1 << 8 * k) - 1), return_inverse=True)
            logp = self.look_up(lang, k, low)[0][back]
            fine = ~np.isnan(logp)
            out[open_[fine]] = logp[fine] + carried[open_[fine]]
            gram = gram.copy()
            gram[open_] &= (1 << 8 * k) - 1
            open_ = open_[~fine]
        return out


def perplexities(docs: DataFrame, model_path: str, shards: int, order: int = ORDER) -> DataFrame:
    """(id, lang, row, perplexity) of (id, lang, row, lang_key, text); null where the language has no model.

    A block of documents gathers its distinct grams, looks them up shard by shard in
    the stored counts, and sums by document. Texts aren't shuffled, and a worker
    holds a block and a few shards, however large the model is.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Shards(model_path, shards)
        for block in blocks(batches, BLOCK_BYTES):
            langs = np.array(block.column(3).to_pylist(), np.int64)
            texts = [t.encode() for t in block.column(4).to_pylist()]
            out = np.full(len(langs), np.nan)
            for lang in np.unique(langs).tolist():
                mine = np.flatnonzero(langs == lang)
                for i in range(0, len(mine), 1024):
                    part = mine[i : i + 1024]
                    found, lens = grams([texts[j] for j in part], order)
                    distinct, back = np.unique(found, return_inverse=True)
                    total = np.add.reduceat(model.score(lang, distinct, order)[back], np.cumsum(lens) - lens)
                    out[part] = np.exp(-total / lens)
            yield from pa.table(
                [*block.columns[:3], pa.array(out, from_pandas=True)], names=["id", "lang", "row", "perplexity"]
            ).to_batches(4096)

    return docs.select("id", "lang", "row", "lang_key", "text").mapInArrow(work, f"id {kind}, lang string, row bigint, perplexity double")


def classify(
    docs: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    order: int = ORDER,
    quantile: float = QUANTILE,
    slack: float = SLACK,
    with_row: bool = False,
) -> DataFrame:
    """(``id_col``, lang, perplexity, threshold, kept[, row]) for every row of ``docs``; ``row`` is ``row_hash``.

    ``trusted``: ids (``id_col``) of documents of ``docs`` to train on, all of them. A
    language has two models: ids fall in two halves by a hash, and a document is
    scored by the trusted documents of the other half, so that trusted documents are
    met as new, like all others. A document is rejected if it is more perplexing than
    ``slack`` times the ``quantile`` of its language's trusted documents.

    Null text: empty, perplexity of the end mark. Null language: a language of its
    own. A language without trusted documents: perplexity and threshold are null and
    its documents stay. Null ids are scored, never trusted. Repeated rows are scored
    alike (and count twice where trusted). Empty tables: no rows, or no thresholds.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(2)).alias("half"),
        whole(text_col).alias("text"),
    )
    lang = F.coalesce("lang", F.lit("\0none"))
    taught = rows.select("id", "text", F.xxhash64(lang, 1 - F.col("half")).alias("lang_key"))
    judged = rows.select("id", "lang", "text", F.xxhash64(lang, "half").alias("lang_key"), row_hash(F.col("id"), F.col("text")).alias("row"))
    ids = trusted.select(F.col(id_col).alias("id")).distinct()
    # merged at every size: a broadcast of the ids would have no bound
    counts = table(gram_counts(taught.join(ids.hint("merge"), "id", "left_semi"), order), "kn-counts")
    release(spark)
    model = table(kneser_ney(counts, order), "kn-model")
    shards = max(1, -(-model.count() // SHARD_ROWS))
    path = scratch(spark, "kn-shards")
    shard = F.pmod("gram", F.lit(shards)).cast("int")
    model.withColumn("shard", shard).repartition("lang_key", "shard").write.partitionBy("lang_key", "shard").parquet(path)
    scored = table(perplexities(judged, path, shards, order), "perplexities")
    limits = scored.join(ids, "id", "left_semi").groupBy(lang.alias("key")).agg(
        (F.percentile_approx("perplexity", quantile, 10_000) * slack).alias("threshold")
    )
    # a language may hold most rows: its threshold is laid out once a salt, its rows are dealt by salt
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = scored.withColumns({"key": lang, "salt": F.pmod("row", F.lit(salts)).cast("int")})
    return dealt.join(limits, ["key", "salt"], "left").select(
        F.col("id").alias(id_col),
        "lang",
        "perplexity",
        "threshold",
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("kept"),
        *(["row"] if with_row else []),
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that a label calls good and none calls bad or toxic."""
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")
    ).where("q = 1 AND t = 0").select("doc_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), trusted_ids(labels))
