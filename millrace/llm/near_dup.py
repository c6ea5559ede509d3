"""Near duplicates: the exact Jaccard join of word shingles by PartEnum signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import components, row_hash, small_batches, table, whole

WORDS = 5
#: A link needs TOP / BASE of the union or more in common.
TOP, BASE = 80, 100
#: Parts of a group, of which one is left out of each signature.
PARTS = 3
#: Up to so many sets that share a signature are paired with each other at once.
RUN = 24
#: Sets of a larger run that are compared in one task, against as many others.
BLOCK = 1024
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; only A-Z is lower-cased."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, _U)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, found), _U, len(found))
    size = min(words, len(found))
    out = np.full(len(found) - size + 1, size, _U)
    for i in range(size):
        out = out * _U(0x9E3779B97F4A7C15) + each[i : len(found) - size + 1 + i]
    return np.unique(_mixed(out))


def most_apart(size: int) -> int:
    """How many elements a set of ``size`` and one linked to it can differ by."""
    return size * (BASE - TOP) // TOP


def signatures(own: np.ndarray) -> np.ndarray:
    """PartEnum signatures of a set, such that linked sets share one.

    Sets fall in bands of doubling size. A band cuts the domain of hashes to groups of
    PARTS parts (the first level); a signature is what a set has in all parts of a
    group but one, and there is one for each part left out (the second level: subsets
    of PARTS - 1 parts). Of two linked sets, a group fails only if they differ in two
    of its parts or more, or in one where the set has elements in one part alone. So a
    group is worth two of the ``most_apart`` differences, or one, and a set lists its
    groups, in their order, until they are worth more than all differences. The one
    of two linked sets whose list ends first has a group in it that doesn't fail, and
    the other lists that too. Subsets without elements aren't listed.

    A set whose groups are worth too little lists all, and joins a signature of its
    band for the like of it. A set that can be linked to larger ones in the next band
    lists its signatures there as well.
    """
    size = len(own)
    band = size.bit_length() - 1
    bands = [band] + [band + 1] * (size * BASE >= TOP << (band + 1))
    need = most_apart(size) + 1
    out = []
    for b in bands:
        groups = max(22, (36 << b) // 100)
        salt = _U((b + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
        part = (_mixed(own + salt) >> _U(11)) % _U(groups * PARTS)
        order = np.argsort(part)
        part = part[order]
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(_mixed(own[order] ^ salt), first)
        part = part[first].astype(np.int64)
        group = part // PARTS
        new = np.concatenate([[True], group[1:] != group[:-1]])
        place = np.cumsum(new) - 1
        filled = np.bincount(place)
        worth = np.cumsum(np.minimum(filled, 2))
        listed = int(np.searchsorted(worth, need)) + 1
        if listed > len(worth):
            out.append(_mixed(np.array([salt], _U)))
        held = np.zeros((len(worth), PARTS), _U)
        held[place, part % PARTS] = _mixed(sums + part.astype(_U) * salt)
        held, some = held[:listed], filled[:listed, None] - (held[:listed] != 0) > 0
        name = group[new][:listed, None].astype(_U) * _U(PARTS) + np.arange(PARTS, dtype=_U)
        out.append(_mixed(held.sum(axis=1, dtype=_U)[:, None] - held + name * _U(0x9E3779B97F4A7C15) + salt)[some])
    return np.concatenate(out)


def sketch(own: np.ndarray) -> np.ndarray:
    """Parities of a set: a bit or two an element. Two sets differ in more elements than parities."""
    bits = max(64, 1 << len(own).bit_length())
    odd = np.bincount((own & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, row): row is a hash of both, never null, by which a text is found again."""
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return rows.withColumn("row", row_hash(F.col("id"), F.col("text")))


def _described(rows: DataFrame) -> DataFrame:
    """(id, n_shingles, set_id, sketch, row) of (id, text, row)."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t) for t in batch.column(1).to_pylist()]
            names = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], _U).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.list_(pa.int64())), batch.column(2)],
                ["id", "n_shingles", "set_id", "sketch", "row"],
            )

    return rows.mapInArrow(work, f"id {kind}, n_shingles bigint, set_id bigint, sketch array<bigint>, row bigint")


def _signed(rows: DataFrame) -> DataFrame:
    """(sig, set_id): the signatures of each set, once a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sigs, names = [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text)
                name = xxhash.xxh3_64_intdigest(own.tobytes())
                if len(own) and name not in seen:
                    seen.add(name)
                    sigs.append(signatures(own))
                    names.append(np.full(len(sigs[-1]), name, _U))
            if sigs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(names).view(np.int64))],
                    ["sig", "set_id"],
                )

    return rows.mapInArrow(work, "sig bigint, set_id bigint")


def _shared(signed: DataFrame) -> DataFrame:
    """(kind, a, b) of rows sorted by signature within partitions.

    Kind 0: sets a < b share a signature; all pairs of a run of up to RUN sets, else
    each set with the first. Kind 1: signature a of a longer run, and a set b of it.
    A run is held up to RUN sets, however long it is.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        held_sig, held, long = None, [], False

        def close() -> list[tuple[int, int, int]]:
            return [] if long else [(0, a, b) for i, a in enumerate(held) for b in held[i + 1 :]]

        for batch in batches:
            sig, name = (c.to_numpy() for c in batch.columns)
            fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])])
            sig, name = sig[fresh], name[fresh]
            starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            ends = np.append(starts[1:], len(sig))
            out: list[tuple[int, int, int]] = []
            # runs of one set inside the batch are passed over at once
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if len(starts) < 3 else _some(starts, ends):
                key = int(sig[s])
                if key != held_sig:
                    out += close()
                    held_sig, held, long = key, [], False
                for x in name[s:e].tolist():
                    if held and x == held[-1]:
                        continue
                    if long:
                        out += [(0, held[0], x), (1, key, x)]
                        held[-1] = x
                    else:
                        held.append(x)
                        if len(held) > RUN:
                            long = True
                            out += [(0, held[0], y) for y in held[1:]] + [(1, key, y) for y in held]
                            held = [held[0], x]
            if out:
                yield np.unique(np.array(out, np.int64), axis=0)
        if last := close():
            yield np.array(last, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, size = [], 0
        for found in pairs(batches):
            pool.append(found)
            size += len(found)
            if size > 500_000:
                pool = [np.unique(np.concatenate(pool), axis=0)]
                yield _three(pool.pop())
                size = 0
        if pool:
            yield _three(np.unique(np.concatenate(pool), axis=0))

    return signed.mapInArrow(work, "kind bigint, a bigint, b bigint")


def _some(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """The runs to look at: the first and the last of a batch, and those of several rows."""
    want = (ends - starts) > 1
    want[[0, -1]] = True
    return zip(starts[want].tolist(), ends[want].tolist(), strict=True)


def _three(rows: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in rows.T], ["kind", "a", "b"])


def _may_link(na: Column, nb: Column, sa: Column, sb: Column) -> Column:
    """Whether sizes and parities allow a link; sketches of neighbouring bands are folded."""

    def fold(x: Column, other: Column) -> Column:
        half = F.size(other)
        folded = F.zip_with(F.slice(x, 1, half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) == 2 * half, folded).otherwise(x)

    apart = F.aggregate(
        F.zip_with(fold(sa, sb), fold(sb, sa), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, x: t + x
    )
    sizes = (F.least(na, nb) * BASE >= F.greatest(na, nb) * TOP) & (F.size(sa) <= 2 * F.size(sb)) & (F.size(sb) <= 2 * F.size(sa))
    return sizes & (apart * (BASE + TOP) <= (na + nb) * (BASE - TOP))


class Join:
    """The join at work on one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str):
        small_batches(docs.sparkSession)
        self.rows = _sets(docs, id_col, text_col)
        self.described = table(_described(self.rows), "sets")
        self.sets = table(
            self.described.where("n_shingles > 0").groupBy("set_id").agg(
                F.min("id").alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
                F.min("row").alias("row"),
            ),
            "distinct-sets",
        )

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """Pairs that share a signature, and (sig, set_id) of long runs."""
        spark = self.rows.sparkSession
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sorted_ = _signed(self.rows).repartition(n, "sig").sortWithinPartitions("sig", "set_id")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
        found = table(_shared(sorted_), "shared")
        small_batches(spark)
        return found.where("kind = 0").select("a", "b").distinct(), found.where("kind = 1").select(
            F.col("a").alias("sig"), F.col("b").alias("set_id")
        )

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Those pairs that sizes and sketches allow, with the sizes."""
        left = self.sets.select(F.col("set_id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
        right = self.sets.select(F.col("set_id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
        ok = _may_link(F.col("na"), F.col("nb"), F.col("ka"), F.col("kb"))
        return pairs.join(left, "a").join(right, "b").where(ok).select("a", "b", "na", "nb")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """Those of ``likely`` pairs that are linked, by their whole sets."""
        wanted = pairs.select(F.col("a").alias("set_id")).unionByName(pairs.select(F.col("b").alias("set_id"))).distinct()
        texts = self.rows.join(self.sets.join(wanted, "set_id", "left_semi").select("row", "set_id"), "row")

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sets = [shingles(t) for t in batch.column(1).to_pylist()]
                names = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], _U).view(np.int64)
                # Another row's text may come along if the hashes of rows agree.
                right = np.flatnonzero(names == batch.column(0).to_numpy())
                own = pa.array([sets[i].view(np.int64) for i in right], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(names[right]), own], ["set_id", "own"])

        full = table(
            texts.select("set_id", "text").mapInArrow(work, "set_id bigint, own array<bigint>").dropDuplicates(["set_id"]), "full-sets"
        )
        left = full.select(F.col("set_id").alias("a"), F.col("own").alias("oa"))
        right = full.select(F.col("set_id").alias("b"), F.col("own").alias("ob"))
        common = F.size(F.array_intersect("oa", "ob"))
        fits = common * BASE >= (F.col("na") + F.col("nb") - common) * TOP
        return table(pairs.join(left, "a").join(right, "b").where(fits).select("a", "b"), "links")

    def across(self, runs: DataFrame, roots: DataFrame, nearest: bool) -> DataFrame:
        """Likely pairs of long runs that lie in different components so far.

        A run whose sets are all in one component is done. The others are dealt to
        blocks of about BLOCK sets, and each two blocks of a run are compared by
        their sketches in one task. ``nearest``: of each component in a comparison,
        only the pair whose sketches are closest; such pairs join most components,
        so that few pairs are left when all are asked for.
        """
        rows = runs.join(roots, "set_id")
        mixed = rows.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
        mixed = mixed.where("lo <> hi").select("sig", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        rows = rows.join(mixed, "sig").join(self.sets.select("set_id", "n", "sketch"), "set_id")
        mine = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
        rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        keys = ["sig", "lo", "hi"]
        rows = rows.select("sig", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "set_id", "root", "n", "sketch")
        return rows.groupBy(*keys).applyInArrow(_compared(nearest), "a bigint, b bigint").distinct()


def _compared(nearest: bool):
    def work(group: pa.Table) -> pa.Table:
        lo, hi = group.column("lo")[0].as_py(), group.column("hi")[0].as_py()
        name, root, n, mine = (group.column(c).to_numpy() for c in ("set_id", "root", "n", "mine"))
        kept = group.column("sketch").to_pylist()
        width = min(map(len, kept))
        bits = np.zeros((len(kept), width), np.int64)
        for i, k in enumerate(kept):  # parities fold to the narrowest, by halves
            bits[i] = np.bitwise_xor.reduce(np.array(k, np.int64).reshape(-1, width), axis=0)
        best = np.full(len(name), np.iinfo(np.int64).max)
        with_ = np.full(len(name), -1)
        out = [np.zeros((0, 2), np.int64)]
        for i in range(len(name)):
            if lo != hi and mine[i] != lo:
                continue
            other = np.arange(i + 1, len(name)) if lo == hi else np.flatnonzero(mine == hi)
            fit = (root[other] != root[i]) & (np.minimum(n[i], n[other]) * BASE >= np.maximum(n[i], n[other]) * TOP)
            other = other[fit]
            apart = np.bitwise_count(bits[other] ^ bits[i]).sum(axis=1, dtype=np.int64)
            fit = apart * (BASE + TOP) <= (n[i] + n[other]) * (BASE - TOP)
            other, apart = other[fit], apart[fit]
            if not len(other):
                continue
            if not nearest:
                out.append(np.stack([np.full(len(other), name[i]), name[other]], axis=1))
                continue
            closer = other[apart < best[other]]
            best[closer], with_[closer] = apart[apart < best[other]], i
            k = int(np.argmin(apart))
            if apart[k] < best[i]:
                best[i], with_[i] = apart[k], other[k]
        if nearest and (with_ >= 0).any():
            order = np.argsort(best, kind="stable")
            order = order[with_[order] >= 0]
            first = order[np.unique(root[order], return_index=True)[1]]
            out.append(np.stack([name[first], name[with_[first]]], axis=1))
        pairs = np.unique(np.sort(np.concatenate(out), axis=1), axis=0)
        return pa.table({"a": pa.array(pairs[:, 0].copy()), "b": pa.array(pairs[:, 1].copy())})

    return work


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_row: bool = False) -> DataFrame:
    """(``id_col``, n_shingles, component_id[, row]) for every row of ``docs``; ``row`` is ``row_hash``.

    1. Rows of equal shingle sets are one set from here on; thousands of copies cost
       as much as one.
    2. Sets that share a signature meet, by one shuffle of the signatures. Short runs
       give all their pairs, long ones each set with the first.
    3. Sizes and sketches drop pairs; whole sets settle the rest. First each set's
       pair with the least other one, then pairs still in different components, then
       such pairs of the long runs, the closest ones at first. No link between
       components is lost: every two sets of a run are in one component, or were
       compared.

    Two different shingles are taken for one only if their 64-bit hashes agree.
    Null or empty text: no shingles, a component of its own (its id). Null ids are
    never a component's id unless all of its ids are null; their rows link others as any
    do, and so does each text of a repeated id. Repeated rows fall in one
    component. Empty table: no rows. Other columns are ignored.
    """
    job = Join(docs, id_col, text_col)
    pairs, runs = job.candidates()
    pairs = table(job.likely(pairs), "likely")
    least = pairs.groupBy("b").agg(F.min(F.struct("a", "na", "nb")).alias("m")).select("m.a", "b", "m.na", "m.nb")
    roots = _joined(job.sets.select("set_id", F.col("set_id").alias("root")), job.linked(least))
    rounds = [lambda: pairs, *[lambda: job.likely(job.across(runs, roots, True))] * 2, lambda: job.likely(job.across(runs, roots, False))]
    for more in rounds:
        open_ = table(_apart(more(), roots), "open")
        if not open_.isEmpty():
            roots = _joined(roots, job.linked(open_))
    return _named(job, roots, id_col, with_row)


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (set_id, root) of all sets after ``links``; only the roots that these touch are gone through."""
    ra = roots.select(F.col("set_id").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("set_id").alias("b"), F.col("root").alias("rb"))
    between = links.join(ra, "a").join(rb, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    found = components(between).withColumnRenamed("node", "root")
    return table(roots.join(found, "root", "left").select("set_id", F.coalesce("component", "root").alias("root")), "roots")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    ra = roots.select(F.col("set_id").alias("a"), F.col("root").alias("ra"))
    rb = roots.select(F.col("set_id").alias("b"), F.col("root").alias("rb"))
    return pairs.join(ra, "a").join(rb, "b").where("ra <> rb").select("a", "b", "na", "nb")


def _named(job: Join, roots: DataFrame, id_col: str, with_row: bool) -> DataFrame:
    sets = table(job.sets.select("set_id", "first").join(roots, "set_id"), "set-roots")
    names = sets.groupBy("root").agg(F.min("first").alias("component_id"))
    named = sets.join(names, "root").select("set_id", "component_id")
    return job.described.select("id", "n_shingles", "row", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id")).join(
        named, "set_id", "left"
    ).select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), *(["row"] if with_row else []))


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
    FROM words)
), sizes AS (
  SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT b, root FROM reach JOIN links ON a = node WHERE root < b
)
SELECT doc_id, any_value(n) AS n_shingles, min(root) AS component_id
FROM reach JOIN sizes ON doc_id = node GROUP BY doc_id
"""
