"""Byte-level BPE by corpus-level merge replay; encoding to ids and decoding to bytes."""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import blocks, small_batches, whole

#: White space of Unicode (fixed values), as Rust's regex library has it.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Text bytes whose new words are replayed at once, and words that a worker remembers.
BLOCK_BYTES, REMEMBERED = 8 << 20, 500_000
#: Words replayed together and positions merged together; words above so many bytes are replayed merge by merge.
BATCH_WORDS, WINDOW, LONG_WORD = 100_000, 8192, 400
_NONE = np.iinfo(np.int32).max
_BESIDE = re.compile(" [\\s\x85]|[^\\S ] ")


@lru_cache(maxsize=8)
def _members(kind: str) -> str:
    """The characters of a general category's first letter, as the inside of a class."""
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(re.escape(chr(start)) + (f"-{re.escape(chr(c - 1))}" if c - 1 > start else ""))
            start = None
    return "".join(out)


@lru_cache(maxsize=8)
def splitter(pattern: str) -> re.Pattern:
    r"""The splitting pattern for Python's re: \p{X}, \s and \S are spelled out as classes."""
    out, i, inside = [], 0, False
    while i < len(pattern):
        if m := re.match(r"\\p\{(\w)\}|\\s", pattern[i:]):
            text = _members(m[1]) if m[1] else _SPACE
            out.append(text if inside else f"[{text}]")
            i += m.end()
        elif pattern.startswith(r"\S", i):
            if inside:
                raise ValueError(r"\S inside a class isn't supported")
            out.append(f"[^{_SPACE}]")
            i += 2
        elif pattern[i] == "\\":
            out.append(pattern[i : i + 2])
            i += 2
        else:
            inside = pattern[i] == "[" or (inside and pattern[i] != "]")
            out.append(pattern[i])
            i += 1
    return re.compile("".join(out))


class Bpe:
    """A vocabulary of ranks: bytes to id, lower ids merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, splitter(pattern)
        size = max(ranks.values()) + 1
        self.bytes_of = [b""] * size
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, made = [], []
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(i)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys = np.array(keys, np.int64)[order]
        self.made = np.array(made, np.int32)[order]
        parts = np.concatenate([self.keys >> 32, self.keys & 0xFFFFFFFF])
        self.precedes = np.zeros(size, bool)  # a token that a merge of a lower rank can follow
        self.precedes[parts[parts > np.concatenate([self.made, self.made])]] = True
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.length = np.fromiter(map(len, self.bytes_of), np.int64, size)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self._forget()

    def _forget(self) -> None:
        """Units are what a worker remembers: a chunk that follows a space, a text's head, a word."""
        self._chunks: dict[str, int] = {}
        self._heads: dict[str, int] = {}
        self._words: dict[str, int] = {}
        self._ids, self._sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str, pattern: str) -> Bpe:
        with open(path, "rb") as f:
            return Bpe({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that each pair of ids merges to, or _NONE."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], _NONE)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, in order, and how many each has.

        The words form one sequence of linked positions. ``index`` maps a merge (by
        the id that its pairs make, which is its rank) to the positions of its pairs.
        Merges leave the index in rank order, WINDOW positions or more at a time; a
        word takes only its lowest merge of a window, at every place from the left
        that it doesn't overlap (up to one that a lower merge follows), and has its
        others put back. Only the neighbours of what was merged are looked
        up and indexed again. Words don't touch, so each sees its merges in rank
        order, as if the corpus had been replayed merge by merge. Long words have
        many merges in any window, so theirs is a window of one merge.
        """
        out: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        for i in range(0, len(words), BATCH_WORDS):
            part = words[i : i + BATCH_WORDS]
            long = [k for k, w in enumerate(part) if len(w) > LONG_WORD]
            ids, counts = self._replay([b"" if len(w) > LONG_WORD else w for w in part] if long else part, WINDOW)
            if long:
                cut = np.split(ids, np.cumsum(counts)[:-1])
                own, sized = self._replay([part[k] for k in long], 1)
                for k, x in zip(long, np.split(own, np.cumsum(sized)[:-1]), strict=True):
                    cut[k] = x
                ids, counts = np.concatenate(cut), np.fromiter(map(len, cut), np.int64, len(cut))
            out.append(ids)
            sizes.append(counts)
        return np.concatenate([np.zeros(0, np.int32), *out]), np.concatenate([np.zeros(0, np.int64), *sizes])

    def _replay(self, words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        n, ends = int(lens.sum()), np.cumsum(lens)
        word = np.repeat(np.arange(len(words), dtype=np.int32), lens)
        tok = self.first[np.frombuffer(b"".join(words), np.uint8)]
        nxt = np.arange(1, n + 1, dtype=np.int64)
        nxt[ends[lens > 0] - 1] = -1
        prv = np.arange(-1, n - 1, dtype=np.int64)
        prv[(ends - lens)[lens > 0]] = -1
        rank = np.full(n, _NONE, np.int32)
        left = np.flatnonzero(nxt >= 0)
        rank[left] = self.pair(tok[left], tok[left + 1])
        left = left[rank[left] != _NONE]
        left = left[np.argsort(rank[left], kind="stable")]
        cuts = np.flatnonzero(np.diff(rank[left], prepend=-1)).tolist() + [len(left)]
        index = {int(rank[left[i]]): left[i:j].tolist() for i, j in zip(cuts[:-1], cuts[1:], strict=True)}
        queue = sorted(index)
        while queue:
            taken: list[int] = []
            under: list[int] = []
            many: list[int] = []
            while queue and len(taken) < window:
                under.append(heapq.heappop(queue))
                held = index.pop(under[-1])
                taken += held
                many.append(len(held))
            at = np.array(taken, np.int64)
            at = at[rank[at] == np.repeat(np.array(under, np.int32), many)]  # else the pair has changed since
            at = np.unique(at)
            own = np.cumsum(np.diff(word[at], prepend=-1) != 0) - 1
            lowest = np.full(own[-1] + 1 if len(own) else 0, _NONE, np.int32)
            np.minimum.at(lowest, own, rank[at])
            pick = rank[at] == lowest[own]
            back, at = at[~pick], at[pick]
            free = self._apart(at, nxt)
            back, at = np.concatenate([back, at[~free]]), at[free]
            free = self._undisturbed(at, tok, nxt, prv, rank, word)
            back, at = np.concatenate([back, at[~free]]), at[free]
            right = nxt[at]
            after = nxt[right]
            tok[at], tok[right] = rank[at], -1
            rank[right] = _NONE
            nxt[at] = after
            more = after >= 0
            prv[after[more]] = at[more]
            before = prv[at]
            touched = np.concatenate([at, before[before >= 0]])
            follow = nxt[touched]
            rank[touched] = np.where(follow >= 0, self.pair(tok[touched], tok[follow]), _NONE)
            again = np.concatenate([touched, back])
            again = again[rank[again] != _NONE]
            for r, p in zip(rank[again].tolist(), again.tolist(), strict=True):
                if r in index:
                    index[r].append(p)
                else:
                    index[r] = [p]
                    heapq.heappush(queue, r)
        alive = np.concatenate([[0], np.cumsum(tok >= 0)])
        return tok[tok >= 0], alive[ends] - alive[ends - lens]

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Which of these positions, in order, begin pairs that don't overlap: each second one of a chain."""
        chained = np.zeros(len(at), bool)
        chained[1:] = nxt[at[:-1]] == at[1:]
        place = np.arange(len(at))
        head = np.maximum.accumulate(np.where(chained, 0, place))
        return (place - head) % 2 == 0

    def _undisturbed(self, at, tok, nxt, prv, rank, word) -> np.ndarray:
        """Which of these merges of a word have none before them that makes a pair of a lower rank."""
        made = rank[at]
        maybe = self.precedes[made]
        if not maybe.any():
            return np.ones(len(at), bool)
        after, before = nxt[nxt[at]], prv[at]
        touching = np.zeros(len(at), bool)
        touching[1:] = nxt[at[:-1]] == before[1:]
        left = np.where(touching, made, tok[before])
        lower = maybe & (before >= 0) & (self.pair(left, made) < made)
        lower |= maybe & (after >= 0) & (self.pair(made, tok[after]) < made)
        seen = np.cumsum(lower) - lower
        first = np.flatnonzero(np.diff(word[at], prepend=-1))
        return seen == np.repeat(seen[first], np.diff(np.append(first, len(at))))

    def encode(self, texts: list[str], part: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each ``part`` texts: their ids in a row, and how many each text has.

        A single space between other characters always begins a match of the
        splitting pattern, so texts are first cut there and the pattern runs over
        distinct chunks alone. A text with other white space next to a space is
        matched whole.
        """
        if len(self._sizes) > REMEMBERED:
            self._forget()
        chunks, heads, words = set(), set(), set()
        whole = []
        for i, t in enumerate(texts):
            if self._odd(t):
                whole.append(i)
                words.update(self.split.findall(t))
            else:
                head, *rest = t.split(" ")
                heads.add(head)
                chunks.update(rest)
        find = self.split.findall
        for known, fresh, cut in (
            (self._chunks, chunks, lambda c: find(" " + c)),
            (self._heads, heads, find),
            (self._words, words, lambda w: [w]),
        ):
            new = [x for x in fresh if x not in known]
            have = len(self._sizes)
            self._learn([cut(x) for x in new])
            known.update(zip(new, range(have, have + len(new)), strict=True))
        start = np.cumsum(self._sizes) - self._sizes
        whole = set(whole)
        for i in range(0, len(texts), part):
            units = [self._units(t, i + k in whole) for k, t in enumerate(texts[i : i + part])]
            unit = np.concatenate(units)
            size = self._sizes[unit]
            ends = np.cumsum(size)
            total = int(ends[-1]) if len(ends) else 0
            ids = self._ids[np.repeat(start[unit] - (ends - size), size) + np.arange(total)]
            last = np.cumsum([len(u) for u in units])
            upto = np.where(last > 0, ends[last - 1] if len(ends) else 0, 0)
            yield ids, np.diff(upto, prepend=0)

    def _units(self, text: str, whole: bool) -> np.ndarray:
        if whole:
            found = self.split.findall(text)
            return np.fromiter(map(self._words.__getitem__, found), np.int64, len(found))
        found = text.split(" ")
        out = np.empty(len(found), np.int64)
        out[0] = self._heads[found[0]]
        del found[0]
        out[1:] = np.fromiter(map(self._chunks.__getitem__, found), np.int64, len(found))
        return out

    @staticmethod
    def _odd(text: str) -> bool:
        return "  " in text or text[-1:].isspace() or text[:1].isspace() or _BESIDE.search(text) is not None

    def _learn(self, units: list[list[str]]) -> None:
        """Remember the ids of new units, each a list of words."""
        place = {w: i for i, w in enumerate(dict.fromkeys(w for u in units for w in u))}
        raw = [w.encode() for w in place]
        single = [self.ranks.get(b) for b in raw]  # a word that is a token isn't merged
        many = [i for i, s in enumerate(single) if s is None]
        ids, counts = self.replay([raw[i] for i in many])
        size = np.ones(len(raw), np.int64)
        size[many] = counts
        start = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), np.int32)
        flat[np.repeat(start[many] - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
        alone = [i for i, s in enumerate(single) if s is not None]
        flat[start[alone]] = [single[i] for i in alone]
        per = np.fromiter(map(len, units), np.int64, len(units))
        word = np.fromiter((place[w] for u in units for w in u), np.int64, int(per.sum()))
        each = size[word]
        ends = np.cumsum(each)
        out = flat[np.repeat(start[word] - (ends - each), each) + np.arange(int(each.sum()))]
        upto = np.concatenate([[0], ends])[np.cumsum(per)]
        self._ids = np.concatenate([self._ids, out])
        self._sizes = np.concatenate([self._sizes, np.diff(upto, prepend=0)])

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and where each id's bytes end."""
        size = self.length[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(total)], ends


def bpe_encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(``id_col``, ids array<int>) for every row: its whole text by the ranks, without special tokens.

    A block of documents (BLOCK_BYTES of text) is split by ``pattern``; its
    distinct words that the worker doesn't remember are replayed together. Words
    don't touch each other, so blocks give what one replay of the corpus would,
    and no word or text is shuffled.

    Null or empty text: no ids. Repeated rows are encoded alike. Empty table: no
    rows. Other columns are ignored. ``ranks_path`` must exist on every machine.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(ranks_path, pattern)
        for block in blocks(batches, BLOCK_BYTES):
            key, at = block.column(0).to_pylist(), 0
            for ids, counts in bpe.encode(block.column(1).to_pylist()):
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                keys = pa.array(key[at : at + len(counts)], block.schema.field(0).type)
                yield pa.RecordBatch.from_arrays([keys, lists], ["id", "ids"])
                at += len(counts)

    out = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).mapInArrow(
        work, f"id {kind}, ids array<int>"
    )
    return out.withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", as_col: str = "text") -> DataFrame:
    """``encoded`` with the bytes of its ids as binary column ``as_col``; null ids give null."""
    small_batches(encoded.sparkSession)
    schema = encoded.drop(as_col).withColumn(as_col, F.lit(b"")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.load(ranks_path, pattern)
        for batch in batches:
            lists = batch.column(batch.schema.names.index(ids_col))
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            data, ends = bpe.decode(lists.flatten().to_numpy(zero_copy_only=False))
            last = np.cumsum(size)
            upto = np.where(last > 0, ends[last - 1] if len(ends) else 0, 0)
            offsets = np.concatenate([[0], upto]).astype(np.int32)
            null = np.packbits(lists.is_valid().to_numpy(zero_copy_only=False), bitorder="little")
            text = pa.BinaryArray.from_buffers(
                pa.binary(), len(size), [pa.py_buffer(null.tobytes()), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
            )
            names = [n for n in batch.schema.names if n != as_col]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.names.index(n)) for n in names), text], [*names, as_col])

    return encoded.mapInArrow(work, schema)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = bpe_encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, pattern)
    return bpe_decode(encoded, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
