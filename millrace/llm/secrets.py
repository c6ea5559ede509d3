"""Secret scans: fixed patterns, and novelty against a primed zstandard dictionary."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import small_batches, whole

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
#: Greedy runs are maximal, so the least length can stand in these patterns.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Every access key, long hex number and novelty candidate lies in such a run.
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: What stands between the '=' of a run, with the padding at its end.
_VALUE = re.compile(r"[^=]+(?:=+\Z)?")
#: Long parts between joints, in a run that doesn't mix digits and letters.
_PART = re.compile(r"[^+/_=-]{16,}")
_FREE = re.compile(rb"\0{16,}")
_SENSITIVE = re.compile(
    r"passw|pwd|secret|token|key|cred|auth|bearer|private|login|session|cookie|signature|sig\b|salt|cert", re.I | re.A
)
#: What code around a secret is made of: the dictionary that primes the compressor.
_IDENTIFIERS = """
import os sys json config settings environ getenv export const let var def class return function public static
private final String string int true false null None self this new http https url host port user username name
password passwd pwd secret token api_key apikey access_key secret_key client_id client_secret private_key
authorization bearer basic auth login session cookie signature certificate credential credentials account
aws_access_key_id aws_secret_access_key database connection server localhost example test default value key id
headers request response content type application json charset utf-8 base64 encode decode begin end rsa ssh
0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ the and of to in is that for with as on
"""


def _bare(word: str) -> str:
    """A run without the padding and joints at its ends, by which copies may differ."""
    return word.strip("+/_=-") or word


def _candidates(text: str, covered: bytearray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """What is to be measured of text[start:end], a run or a part of one."""
    if covered.find(1, start, end) >= 0:
        for free in _FREE.finditer(covered, start, end):
            left = text[free.start() : free.end()].lstrip("+/_=-")
            at, bare = free.end() - len(left), left.rstrip("+/_=-")
            if len(bare) >= 16:
                yield from _candidates(text, covered, at, at + len(bare))
        return
    word = text[start:end]
    if any(c.isdigit() for c in word) and any(c.isalpha() for c in word):
        yield start, end
    else:
        yield from (m.span() for m in _PART.finditer(text, start, end))


def _copies(text: str, values: set[str]) -> Iterator[tuple[int, int]]:
    """Places of ``values`` in the runs of text, the longest at each; they don't overlap."""
    if not values:
        return
    least = min(map(len, values))
    heads: dict[str, dict[int, set[str]]] = {}
    for v in values:
        heads.setdefault(v[:least], {}).setdefault(len(v), set()).add(v)
    for run in re.finditer(f"[A-Za-z0-9+/_=-]{{{least},}}", text):
        at = run.start()
        while at + least <= run.end():
            sizes = heads.get(text[at : at + least], {})
            n = max((n for n, same in sizes.items() if text[at : at + n] in same), default=0)
            if n:
                yield at, at + n
            at += n or 1


class Scanner:
    """Finds secrets in one text; holds the primed compressor.

    A candidate is a run of 16 or more token characters, in the ``reach`` characters
    after a sensitive word; where pattern spans lie in it, what is left of it by
    16 or more. Of a run with '=' inside, each part of 16 or more characters is
    a candidate, and the names before it may hold the word. Of a run that doesn't mix
    digits and letters, each 16 or more letters or digits between joints are one. Its novelty is what it adds to the compressed size of its
    surroundings (``around`` characters to either side, other copies of it blanked)
    under the identifier dictionary; at ``novelty`` bytes a character or more it is
    reported, and so is every other copy of it in the text, whatever stands before.
    """

    def __init__(self, novelty: float = 0.6, around: int = 200, reach: int = 48):
        words = zstandard.ZstdCompressionDict(_IDENTIFIERS.encode() * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._press = zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False)
        self.novelty, self.around, self.reach = novelty, around, reach

    def _size(self, text: str) -> int:
        return len(self._press.compress(text.encode()))

    def added_bytes(self, text: str, start: int, end: int) -> int:
        """Compressed bytes that text[start:end] adds to its surroundings, other copies of it blanked."""
        value = _bare(text[start:end])
        blank, more = " " * len(value), len(value) - 1
        # Copies that the bounds of the surroundings would cut are blanked too.
        low = max(0, start - self.around)
        far = max(0, low - more)
        before = text[far:start].replace(value, blank)[low - far :]
        after = text[end : end + self.around + more].replace(value, blank)[: self.around]
        return self._size(before + text[start:end] + after) - self._size(before + after)

    def scan(self, text: str) -> list[tuple[int, int, int, float]]:
        """(start, index in KINDS, end, novelty), in order; code points, end exclusive."""
        found: list[tuple[int, int, int]] = []
        low = text.lower()
        if "passw" in low or "secret" in low or "token" in low or ("api" in low and "key" in low):
            found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
        maybe = []
        for run in _RUN.finditer(text):
            at, word = run.start(), run.group()
            base = [(m.start() + at, 1, m.end() + at) for m in _ACCESS.finditer(word)]
            base += [(m.start() + at, 2, m.end() + at) for m in _HEX.finditer(word)]
            found += base
            parts = [(m.start() + at, m.end() + at) for m in _VALUE.finditer(word) if len(m[0]) >= 16]
            maybe += parts or [(at, run.end())]
        out = [(*x, self.added_bytes(text, x[0], x[2]) / (x[2] - x[0])) for x in found]
        if not maybe:
            return sorted(out)
        covered = bytearray(len(text))
        for start, _, end in found:
            covered[start:end] = b"\1" * (end - start)
        values = set()
        for start, end in [c for part in maybe for c in _candidates(text, covered, *part)]:
            if _SENSITIVE.search(text, max(0, start - self.reach), start):
                score = self.added_bytes(text, start, end) / (end - start)
                if score >= self.novelty:
                    out.append((start, 3, end, score))
                    covered[start:end] = b"\1" * (end - start)
                    values.add(_bare(text[start:end]))
        for start, end in _copies(text, values):
            if covered.find(1, start, end) < 0:
                out.append((start, 3, end, self.added_bytes(text, start, end) / (end - start)))
        return sorted(out)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: float = 0.6) -> DataFrame:
    """One row per row of ``docs``: its id and the secrets found in its whole text.

    Returns (``id_col``, spans array<struct<kind, start, end, novelty>>), in order
    of start, then kind as in KINDS. One pass over the texts; nothing is shuffled.

    Null or empty text: no spans. Repeated rows are scanned alike. Empty table: no
    rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,novelty:double>>"
    spans_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())])
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(novelty)
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "novelty": n} for s, k, e, n in scanner.scan(t)]
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, spans_type)], ["id", "spans"])

    out = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text")).mapInArrow(work, schema)
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each found span (overlapping ones as one) replaced by ``mark``.

    Same columns and rows; a text without secrets is unchanged, null stays null.
    A column n_chars, if there is one, follows the new text.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            names = batch.schema.names
            at = names.index(text_col)
            texts = [None if t is None else _masked(t, scanner, mark) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if "n_chars" in names:
                n = names.index("n_chars")
                old, new = batch.column(at).to_pylist(), batch.column(n).to_pylist()
                columns[n] = pa.array(
                    [k if a == b else len(b) for a, b, k in zip(old, texts, new, strict=True)], batch.schema.field(n).type
                )
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(work, docs.schema)


def _masked(text: str, scanner: Scanner, mark: str) -> str:
    out, done = [], 0
    for start, _, end, _ in scanner.scan(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join(out) + text[done:]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        each = F.transform(
            spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
        )
        return F.array_join(each, ",")

    return found.select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count("novel"),
    )
