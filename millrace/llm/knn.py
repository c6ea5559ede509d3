"""Exact top-k search by inner product: a KD-tree per shard, best-first traversal."""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import drop, table

#: Vectors of a tree and of its leaves, queries that meet a tree at once, and root boxes that queries meet at once.
SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES, BLOCK_ROOTS = 8192, 128, 8192, 4096
#: Rows whose medians cut the space to cells, and the least of them in a cell.
SAMPLE_ROWS, CELL_SAMPLE = 20_000, 8


def quantised(vector: Column, scale: float = 1024.0) -> Column:
    """floor(scale * x) of each component as long; null unless all are finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(
        vector.isNotNull() & fine, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    )


class KdTree:
    """Integer vectors in leaves of a median-split tree with tight bounding boxes."""

    FIELDS = ("ids", "vectors", "low", "high", "least", "child", "span")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS) -> KdTree:
        order = np.arange(len(ids))
        low, high, least, child, span = [], [], [], [], []

        def node(start: int, end: int) -> int:
            own = vectors[order[start:end]]
            me = len(low)
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            least.append(ids[order[start:end]].min())
            child.append((-1, -1))
            span.append((start, end))
            if end - start > leaf and own.shape[1]:
                axis = int(np.argmax(high[me] - low[me]))
                if high[me][axis] > low[me][axis]:
                    middle = (end - start) // 2
                    order[start:end] = order[start:end][np.argpartition(own[:, axis], middle)]
                    child[me] = (node(start, start + middle), node(start + middle, end))
            return me

        node(0, len(ids))
        return cls(
            ids=ids[order], vectors=vectors[order], low=np.array(low), high=np.array(high),
            least=np.array(least), child=np.array(child), span=np.array(span),
        )

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{n: getattr(self, n) for n in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> KdTree:
        with np.load(io.BytesIO(data)) as f:
            return cls(**{n: f[n] for n in cls.FIELDS})

    def search(
        self, query: np.ndarray, own: int, k: int, floor: tuple[int, int] | None = None
    ) -> list[tuple[int, int]]:
        """The best (score, id), best first; ties to the smaller id; never ``own``.

        Boxes are visited by their upper bound. ``floor`` is a (score, id) that k
        others are known to reach: what is worse than that isn't sought.
        """
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst at its top

        def worst() -> tuple[int, int] | None:
            known = best[0] if len(best) == k else None
            given = (floor[0], -floor[1]) if floor else None
            return max(known, given) if known and given else known or given

        def bound(at: int) -> int:
            return int(np.maximum(self.low[at] * query, self.high[at] * query).sum())

        queue = [(-bound(0), 0)]
        while queue:
            least, at = heapq.heappop(queue)
            limit = worst()
            if limit:
                if -least < limit[0]:
                    break
                if (-least, -int(self.least[at])) < limit:
                    continue
            if self.child[at][0] >= 0:
                for c in self.child[at].tolist():
                    heapq.heappush(queue, (-bound(c), c))
                continue
            start, end = self.span[at]
            scores, ids = self.vectors[start:end] @ query, self.ids[start:end]
            fit = ids != own
            if limit:
                fit &= scores >= limit[0]
            scores, ids = scores[fit], ids[fit]
            for i in np.lexsort((ids, -scores))[:k].tolist():
                item = (int(scores[i]), -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
                else:
                    break
        return [(s, -i) for s, i in sorted(best, reverse=True)]


class Cells:
    """A cut of space by medians of a sample: a tree of (axis, value) for each length of vectors."""

    def __init__(self, sample: list[tuple[int, list[int]]], depth: int):
        self.cuts: dict[int, list[tuple[int, int]]] = {}
        for dim in {d for d, _ in sample}:
            own = np.array([v for d, v in sample if d == dim], np.int64).reshape(-1, dim)
            self.cuts[dim] = []
            parts = [own]
            for _ in range(depth):
                after = []
                for part in parts:
                    wide = part.max(axis=0) - part.min(axis=0) if len(part) and dim else np.zeros(1, np.int64)
                    axis = int(np.argmax(wide))
                    at = int(np.partition(part[:, axis], len(part) // 2)[len(part) // 2]) if len(part) and dim else 0
                    self.cuts[dim].append((axis, at))
                    after += [part[part[:, axis] < at], part[part[:, axis] >= at]] if dim else [part, part]
                parts = after
        self.depth = depth

    def __call__(self, dim: int, vectors: np.ndarray) -> np.ndarray:
        """The number of each vector's cell; a length that the sample lacks has one cell."""
        at = np.zeros(len(vectors), np.int64)
        if dim not in self.cuts or not self.cuts[dim] or not dim:
            return at
        axis, value = np.array(self.cuts[dim], np.int64).T
        for _ in range(self.depth):
            at = 2 * at + 1 + (vectors[np.arange(len(at)), axis[at]] >= value[at])
        return at - len(axis)


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
    block_roots: int = BLOCK_ROOTS,
) -> DataFrame:
    """(query_id, rank, ``id_col``, score): each query's k highest inner products.

    Both tables hold ``id_col`` and ``vector_col``, an array of longs (``quantised``);
    rows with a null id or vector take no part.

    1. Medians of SAMPLE_ROWS rows (those of least hash) cut space to cells; a cell of
       more than ``shard_rows`` vectors is dealt on by a hash of the id, so a hot
       vector makes many shards. Each shard becomes one tree, stored in the shared
       folder.
    2. Queries meet the shards' root boxes, in blocks of both, and each is first
       sought in the shard of the highest bound.
    3. The kth score it finds there goes along: queries meet the root boxes again,
       and only shards whose bound reaches it are sent the query.

    A task holds one tree and ``block_queries`` queries, or as many and
    ``block_roots`` boxes. Equal scores: the smaller id. Vectors meet queries of their
    own length only. Repeated query rows (id and vector) are one query; an id with
    two vectors is two queries. Repeated rows of ``vectors`` are several candidates
    with one id. Fewer than k candidates: all. No queries or no vectors: no rows.
    Scores must fit a long.
    """
    spark = vectors.sparkSession
    fine = "id IS NOT NULL AND v IS NOT NULL"
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(fine)
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(fine)
    n = base.count()
    asked = asked.select("id", "v", F.size("v").alias("dim"), F.xxhash64("v").alias("which")).distinct()
    asked = table(asked.withColumn("draw", F.xxhash64("id", "which")), "queries")
    blocks = max(1, -(-asked.count() // block_queries))
    sample = [(len(r["v"]), r["v"]) for r in base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).collect()]
    depth = max(0, min((n // shard_rows).bit_length(), (len(sample) // CELL_SAMPLE).bit_length() - 1))
    celled = table(base.mapInArrow(_celled(Cells(sample, depth)), "id bigint, v array<bigint>, dim int, cell bigint"), "cells")
    several = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard_rows).cast("long").alias("several"))
    dealt = celled.join(several, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), "several"))
    trees = dealt.select("dim", F.xxhash64("dim", "cell", "part").alias("shard"), "id", "v")
    trees = trees.groupBy("dim", "shard").applyInArrow(
        _build, "dim int, shard bigint, tree binary, low array<bigint>, high array<bigint>, least bigint"
    )
    trees = table(trees, "trees")
    drop(celled)
    groups = max(1, -(-trees.count() // block_roots))
    roots = trees.select("dim", "shard", "low", "high", "least", F.pmod("shard", F.lit(groups)).cast("int").alias("part"))
    roots = roots.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def shards_for(q: DataFrame, first: bool) -> DataFrame:
        """(id, which, shard, bound): the best shard of each group of boxes, or all that reach the floor."""
        q = q.withColumn("block", F.pmod("draw", F.lit(blocks)).cast("int"))
        q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        keys = ["dim", "part", "block"]
        return q.groupBy(*keys).cogroup(roots.groupBy(*keys)).applyInArrow(_bounded(first), "id bigint, which bigint, shard bigint, bound bigint")

    def meet(q: DataFrame) -> DataFrame:
        """(id, which, cand, score) of queries (with a shard each) and the trees of their shards."""
        many = q.groupBy("shard").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("many"))
        q = q.join(many, "shard").withColumn("block", F.pmod("draw", "many").cast("int")).drop("many")
        copies = trees.select("shard", "tree").join(many, "shard").withColumn("block", F.explode(F.expr("sequence(0, many - 1)")))
        keys = ["shard", "block"]
        found = q.groupBy(*keys).cogroup(copies.drop("many").groupBy(*keys))
        return found.applyInArrow(_search(k), "id bigint, which bigint, cand bigint, score bigint")

    none = F.lit(None).cast("bigint")
    best = shards_for(asked.withColumns({"fs": none, "fi": none}), True)
    home = table(best.groupBy("id", "which").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard")), "homes")
    first = table(meet(asked.join(home, ["id", "which"]).withColumns({"fs": none, "fi": none})), "home-hits")
    kth = first.groupBy("id", "which").agg(
        F.count("cand").alias("n"), F.max(F.struct((-F.col("score")).alias("s"), F.col("cand").alias("c"))).alias("w")
    )
    floor = asked.join(kth, ["id", "which"], "left").withColumns(
        {"fs": F.when(F.col("n") >= k, -F.col("w.s")), "fi": F.when(F.col("n") >= k, F.col("w.c"))}
    )
    floor = floor.drop("n", "w")
    others = shards_for(floor, False).select("id", "which", "shard").join(home, ["id", "which", "shard"], "left_anti")
    hits = first.unionByName(meet(floor.join(others, ["id", "which"])))
    by = Window.partitionBy("id", "which").orderBy(F.desc("score"), "cand")
    ranked = hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias("query_id"), "rank", F.col("cand").alias(id_col), "score")


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]
    return np.concatenate([np.zeros(0, np.int64), *flat]).astype(np.int64).reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)


def _celled(cells: Cells):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).value_lengths().to_numpy()
            cell = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                cell[mine] = cells(dim, _matrix(pa.chunked_array([batch.column(1).take(pa.array(mine))]), dim))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims, pa.int32()), pa.array(cell)], ["id", "v", "dim", "cell"]
            )

    return work


def _build(group: pa.Table) -> pa.Table:
    dim = group.column("dim")[0].as_py()
    tree = KdTree.build(group.column("id").to_numpy(), _matrix(group.column("v"), dim))
    box = pa.list_(pa.int64())
    return pa.table(
        {
            "dim": pa.array([dim], pa.int32()),
            "shard": group.column("shard").slice(0, 1),
            "tree": pa.array([tree.dump()], pa.binary()),
            "low": pa.array([tree.low[0]], box),
            "high": pa.array([tree.high[0]], box),
            "least": pa.array([int(tree.least[0])], pa.int64()),
        }
    )


def _bounded(first: bool):
    """Queries against root boxes: each query's highest bound, or every box that may hold one of its best."""

    def work(queries: pa.Table, roots: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.zeros((4, 0), np.int64)]
        if queries.num_rows and roots.num_rows:
            dim = queries.column("dim")[0].as_py()
            low, high = _matrix(roots.column("low"), dim), _matrix(roots.column("high"), dim)
            shard, least = roots.column("shard").to_numpy(), roots.column("least").to_numpy()
            key, which = queries.column("id").to_numpy(), queries.column("which").to_numpy()
            floor, limit = queries.column("fs").to_pylist(), queries.column("fi").to_pylist()
            for i, q in enumerate(_matrix(queries.column("v"), dim)):
                bound = np.maximum(low * q, high * q).sum(axis=1)
                if first:
                    at = np.array([np.argmax(bound)])
                elif floor[i] is None:
                    at = np.arange(len(bound))
                else:
                    at = np.flatnonzero((bound > floor[i]) | ((bound == floor[i]) & (least < limit[i])))
                out.append(np.stack([np.full(len(at), key[i]), np.full(len(at), which[i]), shard[at], bound[at]]))
        found = np.concatenate(out, axis=1)
        return pa.table({n: pa.array(np.ascontiguousarray(x)) for n, x in zip(("id", "which", "shard", "bound"), found, strict=True)})

    return work


def _search(k: int):
    def work(queries: pa.Table, trees: pa.Table) -> pa.Table:
        out: dict[str, list] = {n: [] for n in ("id", "which", "cand", "score")}
        tree = KdTree.load(trees.column("tree")[0].as_py()) if trees.num_rows and queries.num_rows else None
        for q in queries.to_pylist() if tree else []:
            floor = None if q["fs"] is None else (q["fs"], q["fi"])
            for score, cand in tree.search(np.array(q["v"], np.int64), q["id"], k, floor):
                for n, x in (("id", q["id"]), ("which", q["which"]), ("cand", cand), ("score", score)):
                    out[n].append(x)
        return pa.table({n: pa.array(x, pa.int64()) for n, x in out.items()})

    return work


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", quantised(F.col("embedding")).alias("embedding")
    )
    return exact_top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP3_SQL = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: coalesce(isfinite(x), false)), 'bool_and')
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""
