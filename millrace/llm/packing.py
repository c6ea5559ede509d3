"""Sequence packing as a cutting-stock problem, solved by column generation."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import small_batches, table, whole

SEQUENCE, END_ID, GRID = 2048, 1, 4
#: Parts in which the pieces of one length class are ranked.
RANK_PARTS = 64


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes, by the public rule:
    printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of a ``tokenizers`` file, as a tiktoken encoding.

    Its merges make ids in order, so its vocabulary, without the special tokens, is
    a table of ranks; tests hold the ids against the ``tokenizers`` library, which
    is ten times slower. A special token that a text spells out is its one id, as
    that library has it.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters, special = _byte_letters(), {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's ids with END_ID, cut to pieces of at most ``length``.

    Returns (id, start, length, ids_crc32, doc_tokens[, ids]). Only the last piece
    of a document is shorter than ``length``.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode_to_numpy
        for batch in batches:
            keys, rows = [], []
            cut = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text, allowed_special="all"), END_ID).astype("<u4")
                for start in range(0, len(ids), length):
                    piece = ids[start : start + length]
                    keys.append(key)
                    rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                    if with_ids:
                        cut.append(piece.astype("<i4"))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            arrays = [pa.array(keys, batch.schema.field(0).type), *map(pa.array, columns)]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                arrays.append(pa.array(cut, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema += ", ids array<int>" if with_ids else ""
    return docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).mapInArrow(work, schema)


@dataclass
class Plan:
    """Patterns: how many pieces of each class a sequence takes, and how many sequences follow it."""

    patterns: np.ndarray  # patterns x classes
    times: np.ndarray

    @property
    def first_sequence(self) -> np.ndarray:
        return np.cumsum(self.times) - self.times


def _knapsack(worth: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest worth: unbounded knapsack over classes 1..room."""
    best, take = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for c in range(1, room + 1):
        value = worth[:c] + best[c - 1 :: -1][:c]
        k = int(np.argmax(value))
        if value[k] > best[c - 1]:
            best[c], take[c] = value[k], k + 1
        else:
            best[c], take[c] = best[c - 1], 0
    pattern, c = np.zeros(room, np.int64), room
    while c > 0:
        if take[c]:
            pattern[take[c] - 1] += 1
            c -= take[c]
        else:
            c -= 1
    return best[room], pattern


def cutting_stock(demand: np.ndarray, gap: float = 1e-3) -> Plan:
    """Patterns that cover ``demand`` (pieces of class 1..room) with few sequences.

    The linear program over patterns is solved by the revised simplex method; the
    knapsack prices columns until none improves, or the best dual bound lies within
    ``gap``. Prices are drawn towards those of the best bound so far, which saves
    most columns. Should as many columns as there are classes enter without any
    gain, the basis at hand is taken; any basis is a valid answer. Patterns are taken
    rounded down; what is left, a number of pieces that depends on the classes alone,
    is packed best-fit by decreasing class.

    All sums are elementwise: threaded matrix routines can stall in a process that
    runs a JVM gateway.
    """
    room = len(demand)
    used = np.flatnonzero(demand)
    if not len(used):
        return Plan(np.zeros((0, room), np.int64), np.zeros(0, np.int64))
    need = demand[used].astype(float)
    columns, ended = _first_fill(need, used + 1, room)
    inverse = _triangular_inverse(columns[:, used], ended)
    amount = (inverse * need).sum(axis=1)
    centre = (used + 1.0) / room  # what a piece is worth by its length: a bound
    bound = float((need * centre).sum())
    least, idle = float(amount.sum()), 0
    while amount.sum() - bound > gap * amount.sum() and idle <= len(used):
        price = inverse.sum(axis=0)
        for pull in (0.8, 0.0):
            asked = pull * centre + (1 - pull) * price
            worth = np.full(room, -1.0)
            worth[used] = asked
            value, pattern = _knapsack(worth, room)
            if (need * asked).sum() / value > bound:
                bound, centre = float((need * asked).sum() / value), asked / value
            taken = pattern[used]
            if (taken * price).sum() > 1 + 1e-9:
                break
        else:
            break
        some = np.flatnonzero(taken)
        step = (inverse[:, some] * taken[some]).sum(axis=1)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        move = ratio[out]
        amount -= move * step
        amount[out] = move
        row = inverse[out] / step[out]
        inverse -= step[:, None] * row
        inverse[out] = row
        columns[out] = pattern
        idle = idle + 1 if amount.sum() > least * (1 - 1e-9) else 0
        least = min(least, float(amount.sum()))
    times = np.floor(np.maximum(amount, 0) + 1e-9).astype(np.int64)
    keep = times > 0
    columns, times = columns[keep], times[keep]
    left = demand - (times[:, None] * columns).sum(axis=0)
    # a pattern may cover more than there is; what lacks leaves room in its last sequences
    rest = _best_fit(np.maximum(left, 0))
    return Plan(np.concatenate([columns, rest]), np.concatenate([times, np.ones(len(rest), np.int64)]))


def _triangular_inverse(patterns: np.ndarray, ended: np.ndarray) -> np.ndarray:
    """The inverse of the basis whose column j is pattern j, by substitution.

    No pattern after j has the class that ends with j, so the rows of the basis, in
    the order in which their classes end, are a lower triangle.
    """
    n = len(patterns)
    lower, solved = patterns[:, ended].T.astype(float), np.zeros((n, n))
    for i in range(n):
        before = np.flatnonzero(lower[i, :i])
        solved[i] = -(lower[i, before, None] * solved[before]).sum(axis=0)
        solved[i, i] += 1
        solved[i] /= lower[i, i]
    out = np.empty((n, n))
    out[:, ended] = solved
    return out


def _first_fill(need: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """As many patterns as classes, which form a basis that covers ``need``, and the class that ends with each.

    Each pattern is filled from the largest class that is left, and serves until one
    of its classes is used up; so no later pattern has that class, and the patterns
    are triangular in the order in which classes end.
    """
    left, out, ended = need.copy(), [], []
    alive = np.ones(len(need), bool)
    for _ in range(len(need)):
        pattern, c = np.zeros(room, np.int64), room
        for i in np.flatnonzero(alive)[::-1].tolist():
            k = c // int(sizes[i])
            if k and left[i] < k and out:  # no more than there are, where that is known to be few
                k = max(1, int(left[i]))
            if k:
                pattern[sizes[i] - 1] = k
                c -= k * int(sizes[i])
        have = pattern[sizes - 1]
        times = np.where(alive & (have > 0), left / np.maximum(have, 1), np.inf)
        end = int(np.argmin(times))
        left = np.maximum(left - times[end] * have, 0)
        alive[end] = False
        out.append(pattern)
        ended.append(end)
    return np.array(out), np.array(ended)


def _best_fit(left: np.ndarray) -> np.ndarray:
    """Patterns for the remaining pieces: each goes where the least room stays."""
    room = len(left)
    free: list[list[int]] = [[] for _ in range(room + 1)]
    some, bins = 0, []
    for size in range(room, 0, -1):
        for _ in range(int(left[size - 1])):
            fit = some >> size << size
            if fit:
                at = (fit & -fit).bit_length() - 1
                b = free[at].pop()
                if not free[at]:
                    some &= ~(1 << at)
            else:
                at, b = room, len(bins)
                bins.append(np.zeros(room, np.int64))
            bins[b][size - 1] += 1
            free[at - size].append(b)
            some |= 1 << (at - size)
    return np.array(bins, np.int64).reshape(-1, room)


class Placer:
    """Where the piece of rank r in its class goes: intervals of ranks per class."""

    def __init__(self, plan: Plan):
        first = plan.first_sequence
        self.at: dict[int, tuple[np.ndarray, ...]] = {}
        for c in np.flatnonzero(plan.patterns.any(axis=0)) if len(plan.patterns) else []:
            p = np.flatnonzero(plan.patterns[:, c])
            each = plan.patterns[p, c]
            ends = np.cumsum(each * plan.times[p])
            self.at[int(c) + 1] = (ends - each * plan.times[p], each, first[p])

    def __call__(self, cls: np.ndarray, rank: np.ndarray) -> np.ndarray:
        out = np.empty(len(cls), np.int64)
        for c in np.unique(cls).tolist():
            mine = cls == c
            starts, each, first = self.at[c]
            r = rank[mine]
            i = np.searchsorted(starts, r, "right") - 1
            out[mine] = first[i] + (r - starts[i]) // each[i]
        return out


def pack(pieces: DataFrame, length: int = SEQUENCE, grid: int = GRID, parts: int = RANK_PARTS) -> DataFrame:
    """``pieces`` with sequence_id and offset: sequences of at most ``length`` ids.

    ``pieces`` (of ``token_pieces``, or any table with id, start and length) should
    be a stored table: it is read twice. Its lengths, rounded up to ``grid``, form a
    histogram of at most length / grid classes and ``parts`` parts; the driver sees
    the totals of the classes. Pieces are ranked within class and part (a hash of the
    id) by id and start; the histogram turns that to a rank within the class, and
    the rank to a sequence of a pattern. No class is gathered in one task.

    Empty table: no rows. Repeated rows take a place each. Columns other than
    id, start and length pass through.
    """
    room = -(-length // grid)
    parts = max(parts, int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = pieces.withColumns(
        {
            "__class": F.ceil(F.col("length") / grid).cast("int"),
            "__part": F.pmod(F.xxhash64("id", "start"), F.lit(parts)).cast("int"),
        }
    )
    counts = table(keyed.groupBy("__class", "__part").agg(F.count("*").alias("__n")), "lengths")
    demand = np.zeros(room, np.int64)
    for c, n in counts.groupBy("__class").agg(F.sum("__n")).collect():  # room rows at most
        demand[c - 1] = n
    place = Placer(cutting_stock(demand))
    earlier = Window.partitionBy("__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("__class", "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    schema = keyed.drop("__part").withColumn("sequence_id", F.lit(0).cast("long")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            cls, rank = (batch.column(names.index(n)).to_numpy(zero_copy_only=False) for n in ("__class", "__rank"))
            keep = [n for n in names if n != "__rank"]
            arrays = [batch.column(names.index(n)) for n in keep] + [pa.array(place(cls, rank))]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "sequence_id"])

    within = Window.partitionBy("__class", "__part").orderBy("id", "start")
    ranked = keyed.withColumn("__row", F.row_number().over(within)).join(before, ["__class", "__part"])
    ranked = ranked.withColumn("__rank", F.col("__row") - 1 + F.col("__before")).drop("__part", "__row", "__before")
    placed = ranked.select(*schema.names[:-1], "__rank").mapInArrow(work, schema)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("__class"), "id", "start")
    return placed.withColumn(
        "offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    ).withColumn("offset", F.coalesce("offset", F.lit(0).cast("long"))).drop("__class")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = SEQUENCE,
    with_ids: bool = False,
) -> DataFrame:
    """Pack whole documents: (``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    Null or empty text: a document of END_ID alone. Null ids are packed like
    others. Every id of every row lies in exactly one piece; documents are cut only
    at multiples of ``length``.
    """
    pieces = table(token_pieces(docs, tokenizer_path, id_col, text_col, length, with_ids), "pieces")
    out = pack(pieces, length).withColumnRenamed("id", id_col)
    first = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*first, *(["ids"] if with_ids else []))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json")
    )
