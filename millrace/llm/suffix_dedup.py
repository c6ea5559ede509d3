"""Removal of byte strings that an earlier document has, by a run-length BWT index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import blocks, release, small_batches, table, whole

#: Bytes of a match, and of the gram by whose hash windows find each other.
MATCH, GRAM = 50, 20
_REACH, _SIDE = MATCH - GRAM + 1, (MATCH - GRAM) // 2
#: Positions hashed at once (below 2^16), bytes of an index, pieces of a gram beyond which they are split.
SEGMENT, INDEX_BYTES, CROWD = 60_000, 2 << 20, 20_000
#: What is known of a piece: an earlier document has it, one may share a window, one may and its gram has very many.
SETTLED, OPEN, CROWDED = 0, 1, 2
#: Bytes of text whose equal pieces are combined before they are dealt.
BLOCK_BYTES = 4 << 20
#: Symbols by which suffixes are sorted at first; then by twice as many each time.
_FIRST = 7
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_VALUES = [np.array([int.from_bytes(hashlib.blake2b(bytes([b, s]), digest_size=8).digest(), "big") for b in range(256)], _U) for s in (0, 1)]
_UP = [_powers(b, SEGMENT + 2 * MATCH) for b in _BASES]
_DOWN = [_powers(_inverse(b), SEGMENT + 2 * MATCH) for b in _BASES]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


class _Rolling:
    """Hashes of any stretch of some bytes, alike wherever the stretch lies."""

    def __init__(self, data: np.ndarray, which: int):
        self.which = which
        self.sums = np.zeros(len(data) + 1, _U)
        np.cumsum(_VALUES[which][data] * _UP[which][: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * _DOWN[self.which][start] + (end - start).astype(_U))


def pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of MATCH bytes by their least gram, as three longs a piece.

    Consecutive windows whose least gram hash (the leftmost, of equals) is the same
    gram form a piece. Equal windows have the same gram at the same place, so they
    meet under its hash. Such windows reach _SIDE bytes or more beyond the gram to the
    left or to the right, so pieces with one in common agree in a hash of that side.
    First long: the gram's hash. Second: the piece's, by other values. Third: 10 bits
    each of the left and right sides' (0: no window reaches so far), 5 for the
    windows less one, 31 for the start.
    """
    out: list[tuple[np.ndarray, ...]] = []
    for base in range(0, len(data) - MATCH + 1, SEGMENT):
        part = data[base : base + SEGMENT + MATCH - 1]
        first, second = _Rolling(part, 0), _Rolling(part, 1)
        at = np.arange(len(part) - GRAM + 1)
        gram = _mixed((first.sums[GRAM:] - first.sums[:-GRAM]) * _DOWN[0][: len(at)])
        least = gram >> _U(16) << _U(16) | at.astype(_U)
        for step in (1, 2, 4, 8, _REACH - 16):
            least = np.minimum(least[:-step], least[step:])
        starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        ends = np.append(starts[1:], len(least))  # of window starts
        where = (least[starts] & _U(0xFFFF)).astype(np.int64)
        body = _mixed(second(starts, ends + MATCH - 1) + (where - starts).astype(_U))
        left = second(np.maximum(where - _SIDE, 0), where) % _U(1023) + _U(1)
        left[where - starts < _SIDE] = 0
        right = second(where + GRAM, np.minimum(where + GRAM + _SIDE, len(part))) % _U(1023) + _U(1)
        right[where - ends + 1 > _REACH - 1 - _SIDE] = 0
        rest = left << _U(46) | right << _U(36) | (ends - starts - 1).astype(_U) << _U(31) | (starts + base).astype(_U)
        out.append((gram[where], body, rest))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x).view(np.int64) for x in zip(*out, strict=True))


class RunLengthIndex:
    """The run-compressed Burrows-Wheeler transform of texts, with sampled run ends.

    Texts are sorted suffix by suffix, each closed by a mark of its own that is less
    than all bytes; an equal text is held once. Kept are the runs of the transform
    (symbol, start, ranks before it), the suffix at each run's end, and, for each
    range of suffixes that agree in MATCH bytes, the least owner of one.
    """

    def __init__(self, texts: list[bytes], owners: np.ndarray):
        lens = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        ends = np.cumsum(lens) - 1
        n = int(lens.sum())
        text = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + 1
        to_mark = np.repeat(ends, lens) - np.arange(n)
        key = np.zeros(n, np.int64)
        for i in range(_FIRST):  # so many symbols of 9 bits, none beyond a mark
            key[: n - i] |= np.where(to_mark[: n - i] >= i, text[i:], 0) << (9 * (_FIRST - 1 - i))
        depth, agree = _FIRST, None
        while True:
            order, rank, distinct = _ranked(key, to_mark < depth)
            if depth == 4 * _FIRST:
                agree = rank  # two suffixes agree in MATCH bytes if in so many, and again up to the last of them
            if depth >= 4 * _FIRST and (depth > to_mark.max() or distinct == n):
                break
            key = rank << 32
            key[: n - depth] |= np.where(to_mark[: n - depth] >= depth, rank[depth:] + 1, 0)
            depth *= 2
        suffix = order
        later = np.minimum(suffix + MATCH - 4 * _FIRST, n - 1)
        same = (agree[suffix][1:] == agree[suffix][:-1]) & (agree[later][1:] == agree[later][:-1])
        owner = np.repeat(owners, lens)[suffix]
        self.range_start = np.flatnonzero(np.concatenate([[True], ~same]))
        self.least = np.minimum.reduceat(owner, self.range_start)
        bwt = np.where(suffix > 0, text[suffix - 1], 0)
        self.run_start = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        symbol = bwt[self.run_start]
        length = np.diff(np.append(self.run_start, n))
        self.size = n
        self.run_end_sample = suffix[self.run_start + length - 1]
        by = np.argsort(symbol, kind="stable")
        self.target = np.empty(len(by), np.int64)
        # the marks come first and are told apart by their text, so their runs aren't followed
        self.target[by] = np.cumsum(length[by]) - length[by]

    @property
    def runs(self) -> int:
        return len(self.run_start)

    def back(self, at: np.ndarray) -> np.ndarray:
        """The rank of the suffix that starts one byte before that of rank ``at``."""
        run = np.searchsorted(self.run_start, at, "right") - 1
        return self.target[run] + at - self.run_start[run]

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Where the suffixes of these ranks start in the texts: steps back to a run's end, and its sample."""
        out, open_, at = np.zeros(len(at), np.int64), np.arange(len(at)), at.copy()
        steps = 0
        while len(open_):
            run = np.searchsorted(self.run_start, at, "right") - 1
            end = np.append(self.run_start[1:], self.size)[run] - 1 == at
            out[open_[end]] = self.run_end_sample[run[end]] + steps
            open_, at = open_[~end], self.target[run[~end]] + at[~end] - self.run_start[run[~end]]
            steps += 1
        return out

    def earlier(self, owners: np.ndarray, lens: np.ndarray) -> list[np.ndarray]:
        """For each text, at each window, whether an owner less than its own has the window."""
        flat = self.streamed(owners, lens)
        return [flat[i, : max(0, n - MATCH + 1)] for i, n in enumerate(lens.tolist())]

    def streamed(self, owners: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """``earlier`` as a matrix of texts and window starts.

        All texts are streamed from their ends at once: a step back leads from a
        suffix's rank to that of the longer suffix. A matching statistic of MATCH or
        more with an earlier owner is one whose range has a lesser owner.
        """
        # the suffix of a mark alone has the rank of its text's place among the texts
        at = np.arange(len(lens))
        flat = np.zeros((len(lens), int(lens.max(initial=0)) + 1), bool)
        alive = np.arange(len(lens))
        for step in range(1, int(lens.max(initial=0)) + 1):
            fit = lens[alive] >= step
            alive, at = alive[fit], at[fit]
            at = self.back(at)
            if step >= MATCH:
                range_ = np.searchsorted(self.range_start, at, "right") - 1
                flat[alive, lens[alive] - step] = self.least[range_] < owners[alive]
        return flat


def _ranked(key: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The order of ``key``, each place's rank in it, and how many ranks there are.

    Equal keys share a rank, but for ``whole`` places, which go by place. A key tells
    whether its place is whole, so a rank is shared by such places or by others.
    """
    order = np.argsort(key)
    sorted_ = key[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    size = np.diff(np.append(start, len(key)))
    rank = np.empty(len(key), np.int64)
    rank[order] = np.repeat(start, size)
    distinct = len(start)
    tied = np.flatnonzero(whole & (np.repeat(size, size)[rank] > 1)) if len(start) < len(key) else np.zeros(0, np.int64)
    if len(tied):
        tied = tied[np.argsort(rank[tied], kind="stable")]  # by rank, then place
        first = np.flatnonzero(np.concatenate([[True], rank[tied][1:] != rank[tied][:-1]]))
        offset = np.arange(len(tied)) - np.repeat(first, np.diff(np.append(first, len(tied))))
        rank[tied] += offset
        order[rank[tied]] = tied
        distinct += len(tied) - len(first)
    return order, rank, distinct


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes that the flagged windows of each row cover, as (row, start, end), by row and start."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    return row, start, end - 1 + MATCH


def _cut(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """The pieces of all texts; those that an earlier document of a block has come as settled stretches.

    A piece leaves a block from the first of its documents there alone, so a piece that
    a third of all documents hold is a row a block. A stretch is a row whose third
    long is negative: -1 - its start; the second is its end, the first a hash to
    deal it by.
    """
    for block in blocks(batches, block_bytes):
        keys, found = [], []
        for key, text in zip(block.column(0).to_pylist(), block.column(1).to_pylist(), strict=True):
            data = np.frombuffer(text.encode(), np.uint8)
            if len(data) >= MATCH:
                found.append(pieces(data))
                keys.append(key)
        if not found:
            continue
        lens = np.fromiter((len(f[0]) for f in found), np.int64, len(found))
        one, two, rest = (np.concatenate(x) for x in zip(*found, strict=True))
        key = np.repeat(np.array(keys, np.int64), lens)
        settled = _held_before(one, two, key)
        edge = np.ones(len(key) + 1, bool)  # where a run of settled or other pieces of a row begins
        edge[1:-1] = settled[1:] != settled[:-1]
        edge[np.cumsum(lens) - lens] = True
        edge = np.flatnonzero(edge)
        runs = settled[edge[:-1]]
        first, last = edge[:-1][runs], edge[1:][runs] - 1
        lo = rest[first] & 0x7FFFFFFF
        hi = (rest[last] & 0x7FFFFFFF) + (rest[last] >> 31 & 31) + MATCH
        columns = (
            np.concatenate([one[~settled], _mixed(key[first].view(_U) * _U(0x9E3779B97F4A7C15) + lo.astype(_U)).view(np.int64)]),
            np.concatenate([two[~settled], hi]),
            np.concatenate([rest[~settled], -1 - lo]),
            np.concatenate([key[~settled], key[first]]),
        )
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["one", "two", "three", "id"])


def _held_before(one: np.ndarray, two: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which rows have an equal piece of a smaller key beside them."""
    mixed = one ^ (two << 1)
    order = np.argsort(mixed)
    new = np.concatenate([[True], np.diff(mixed[order]) != 0])
    out = np.zeros(len(key), bool)
    if new.all():
        return out
    several = ~new
    several[:-1] |= ~new[1:]
    order = order[several]
    order = order[np.lexsort((key[order], two[order], one[order]))]
    new = np.concatenate([[True], (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    out[order] = key[order] > key[order][lead]
    return out


def _several(side: np.ndarray, group: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Whether another body of a row's gram has the same hash on this side."""
    key = group << 10 | side
    pairs = np.unique(np.stack([key, body], axis=1)[side > 0], axis=0)[:, 0] if (side > 0).any() else np.zeros(0, np.int64)
    many, counts = np.unique(pairs, return_counts=True)
    return (side > 0) & np.isin(key, many[counts > 1])


def _open(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Of the first documents' pieces, sorted: those that may share a window with another body."""
    group = np.cumsum(np.concatenate([[0], one[1:] != one[:-1]]))
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    body = np.cumsum(new)
    alone = np.bincount(group, weights=new)[group] < 2
    out = ~alone
    if out.any():
        at = np.flatnonzero(out)
        left, right = (three[at] >> 46) & 1023, (three[at] >> 36) & 1023
        out[at] = _several(left, group[at], body[at]) | _several(right, group[at], body[at])
    return out


def _sorted_out(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by piece and id: those that an earlier document has, and open ones.

    A piece that an earlier document has is settled: all its windows go. The pieces
    of its first document stay open if one with another body may have a window of
    theirs. The first documents' pieces of one gram are held until the gram ends; of
    a gram with more than ``most``, they are let through as open, and marked to be cut
    to windows, which are dealt by their bytes. Stretches that are settled pass
    through.
    """
    last = (None, None, 0)
    held: tuple[np.ndarray, ...] = (np.zeros(0, np.int64),) * 4
    crowd = None

    def rows(one, start, windows, key, state):
        flags = np.full(len(key), state, np.int8)
        return pa.RecordBatch.from_arrays(
            [pa.array(one), pa.array(key), pa.array(start.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(flags)],
            ["gram", "id", "start", "windows", "state"],
        )

    def placed(one, three, key, state):
        return rows(one, three & 0x7FFFFFFF, (three >> 31 & 31) + 1, key, state)

    def judged(part, everything=False):
        one, two, three, key = part
        fit = np.ones(len(one), bool) if everything else _open(one, two, three)
        if fit.any():
            yield placed(one[fit], three[fit], key[fit], CROWDED if everything else OPEN)

    for batch in batches:
        one, two, three, key = (c.to_numpy() for c in batch.columns)
        if (done := three < 0).any():
            lo = -1 - three[done]
            yield rows(one[done], lo, two[done] - lo - MATCH + 1, key[done], SETTLED)
            one, two, three, key = (x[~done] for x in (one, two, three, key))
        if not len(one):
            continue
        new = np.concatenate([[(one[0], two[0]) != last[:2]], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(one)), -1))
        first = np.where(lead >= 0, key[np.maximum(lead, 0)], last[2])
        last = (one[-1], two[-1], first[-1])
        settled = key > first
        if settled.any():
            yield placed(one[settled], three[settled], key[settled], SETTLED)
        held = tuple(np.concatenate([h, x[~settled]]) for h, x in zip(held, (one, two, three, key), strict=True))
        crowded = held[0] == crowd if crowd is not None else np.zeros(len(held[0]), bool)
        tail = held[0] == one[-1]
        if (tail & ~crowded).sum() > most:
            crowd = one[-1]
            crowded |= tail
        if crowded.any():
            yield from judged(tuple(x[crowded] for x in held), everything=True)
        if (done := ~crowded & ~tail).any():
            yield from judged(tuple(x[done] for x in held))
        held = tuple(x[tail & ~crowded] for x in held)
    if len(held[0]):
        yield from judged(held)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of open pieces; those of a crowded gram are cut to single windows."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("shard", "gram", "id", "start", "piece")}
        for key, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            data = text.encode()
            for p in found:
                at, windows = p["start"], p["windows"]
                for a, n in [(at + i, 1) for i in range(windows)] if p["crowded"] else [(at, windows)]:
                    piece = data[a : a + n - 1 + MATCH]
                    shard = int.from_bytes(hashlib.blake2b(piece, digest_size=7).digest(), "big") if p["crowded"] else p["gram"]
                    for name, x in (("shard", shard), ("gram", p["gram"]), ("id", key), ("start", a), ("piece", piece)):
                        out[name].append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out.values(), kinds, strict=True)], list(out))


def _indexed(group: pa.Table) -> pa.Table:
    """Marks (id, lo, hi) of the open pieces of one shard."""
    key, start = group.column("id").to_numpy(), group.column("start").to_numpy()
    piece = group.column("piece").to_pylist()
    order = np.argsort(key, kind="stable")
    place: dict[bytes, int] = {}
    owners = []
    for i in order.tolist():
        if piece[i] not in place:
            place[piece[i]] = len(owners)
            owners.append(key[i])
    texts, owners = list(place), np.array(owners, np.int64)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    index = RunLengthIndex(texts, owners)
    row, lo, hi = _stretches(index.streamed(owners, lens))
    at = np.fromiter((place[p] for p in piece), np.int64, len(piece))
    first = key == owners[at]
    later = np.flatnonzero(~first)
    many = np.bincount(row, minlength=len(texts))
    begin = np.cumsum(many) - many
    own = np.flatnonzero(first)
    n = many[at[own]]
    which = np.repeat(begin[at[own]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    own = np.repeat(own, n)
    return pa.table(
        {
            "id": pa.array(np.concatenate([key[own], key[later]])),
            "lo": pa.array(np.concatenate([start[own] + lo[which], start[later]]).astype(np.int32)),
            "hi": pa.array(np.concatenate([start[own] + hi[which], start[later] + lens[at[later]]]).astype(np.int32)),
        }
    )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(id, lo, hi): stretches of bytes of a document covered by strings of an earlier one.

    Stretches of a document may overlap. ``crowd`` pieces of a gram are held in a
    task, and ``block_bytes`` of text; neither changes the result. See ``remove_repeats``.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    cut = rows.mapInArrow(lambda b: _cut(b, block_bytes), "one bigint, two bigint, three bigint, id bigint")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    dealt = cut.repartition(n, "one").sortWithinPartitions("one", "two", "id")
    found = table(dealt.mapInArrow(lambda b: _sorted_out(b, crowd), "gram bigint, id bigint, start int, windows int, state tinyint"), "pieces")
    small_batches(spark)
    release(spark)
    settled = found.where(F.col("state") == SETTLED).select(
        "id", F.col("start").alias("lo"), (F.col("start") + F.col("windows") + MATCH - 1).cast("int").alias("hi")
    )
    open_ = found.where(F.col("state") != SETTLED)
    wanted = open_.groupBy("id").agg(
        F.collect_list(F.struct("gram", "start", "windows", (F.col("state") == CROWDED).alias("crowded"))).alias("found")
    )
    texts = rows.join(wanted, "id").mapInArrow(_texts, "shard bigint, gram bigint, id bigint, start int, piece binary")
    texts = table(texts, "open-pieces")
    release(spark)
    size = texts.agg(F.sum(F.length("piece"))).first()[0] or 0
    shards = max(1, -(-size // INDEX_BYTES))
    marks = (
        texts.select(F.pmod(F.xxhash64("shard"), F.lit(shards)).alias("shard"), "id", "start", "piece")
        .groupBy("shard")
        .applyInArrow(_indexed, "id bigint, lo int, hi int")
    )
    return settled.unionByName(marks)


def _islands(spans: pa.ListArray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, lo, hi) of the maximal stretches that each row's spans cover, within its ``n`` bytes."""
    row = np.repeat(np.arange(len(n)), spans.value_lengths().fill_null(0).to_numpy())
    lo, hi = (c.to_numpy().astype(np.int64) for c in spans.flatten().flatten())
    hi = np.minimum(hi, n[row])
    order = np.flatnonzero(lo < hi)
    order = order[np.lexsort((lo[order], row[order]))]
    row, lo, hi = row[order], lo[order], hi[order]
    reach = np.maximum.accumulate(row << 32 | hi) & 0xFFFFFFFF  # the farthest end so far of the row
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (lo[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return row[first], lo[first], reach[np.append(first[1:], len(row))[: len(first)] - 1]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(``id_col``, n_bytes, n_removed, n_spans, kept binary, removed array<struct<lo, hi>>).

    Each byte goes that a string of MATCH bytes covers which also starts in a document
    of a smaller id. Windows of MATCH bytes are dealt by their least gram, so equal
    ones meet. Where a gram's pieces have one body, its first document decides. The
    others are put in run-length indexes by shard, each distinct piece once, and
    streamed through them. Only ids, places and hashes are shuffled for all windows;
    the bytes of open pieces alone follow. A block's equal
    pieces are combined before, so that no piece comes from all documents. Pieces
    are settled by two hashes of 64 bits, of the gram and of the whole piece, made
    with different values; their bytes aren't compared.

    Null or short text (under MATCH bytes): nothing removed. Null id: neither source
    nor target. Rows that repeat an id should be alike: its spans are those of all,
    as far as a row's text goes.
    Empty table: no rows. Other columns are ignored.
    """
    spans = repeated_spans(docs, id_col, text_col, crowd, block_bytes)
    spans = table(spans.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "repeats")
    release(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, removed array<struct<lo:bigint,hi:bigint>>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            n = pc.binary_length(texts).to_numpy().astype(np.int64)
            row, lo, hi = _islands(batch.column(2), n)
            kept, many = texts.to_pylist(), np.bincount(row, minlength=len(n))
            begin = np.append(0, np.cumsum(many))
            for i in np.flatnonzero(many).tolist():
                mine = slice(begin[i], begin[i + 1])
                edges = zip([0, *hi[mine].tolist()], [*lo[mine].tolist(), None], strict=True)
                kept[i] = b"".join([kept[i][x:y] for x, y in edges])
            gone = np.bincount(row, weights=hi - lo, minlength=len(n)).astype(np.int64)
            removed = pa.ListArray.from_arrays(begin.astype(np.int32), pa.StructArray.from_arrays([pa.array(lo), pa.array(hi)], ["lo", "hi"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(gone), pa.array(many), pa.array(kept, pa.binary()), removed],
                ["id", "n_bytes", "n_removed", "n_spans", "kept", "removed"],
            )

    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    return rows.join(spans, "id", "left").mapInArrow(work, schema).withColumnRenamed("id", id_col)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP9_SQL = """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), parts AS (  -- long strings are slow to take windows of
  SELECT doc_id, p, substring(h, CAST(2 * p + 1 AS INTEGER), 2 * 299) AS h, least(250, n - 49 - p) AS n
  FROM (SELECT doc_id, h, n, unnest(range(0, n - 49, 250)) AS p FROM bytes WHERE n >= 50)
), windows AS (
  SELECT doc_id, p + i AS p, substring(h, CAST(2 * i + 1 AS INTEGER), 100) AS s
  FROM (SELECT doc_id, h, p, unnest(range(0, n)) AS i FROM parts)
), firsts AS (
  SELECT s, min(doc_id) AS least FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
  FROM windows JOIN firsts USING (s) WHERE least < doc_id
), islands AS (
  SELECT doc_id, p, sum(CASE WHEN p <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM gone
), spans AS (
  SELECT doc_id, min(p) AS lo, max(p) + 50 AS hi FROM islands GROUP BY doc_id, island
), gaps AS (
  SELECT doc_id, lo, hi, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS last FROM spans
), kept AS (
  SELECT doc_id, sum(hi - lo) AS n_removed, count(*) AS n_spans,
         string_agg(substring(h, CAST(2 * last + 1 AS INTEGER), CAST(2 * (lo - last) AS INTEGER)), '' ORDER BY lo)
           || substring(any_value(h), CAST(2 * max(hi) + 1 AS INTEGER)) AS k
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (doc_id)
"""
