"""Each registered query on a written folder of hard rows, against a plain version or its SQL."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import catalogue, quality

from . import cases
from .test_operators import base_spans

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = {(i * 3 + 1, t, ["en", "de", None][i % 3], ["hot", "hot", "src"][i % 3]) for i, t in enumerate(cases.texts())}
    docs = spark.createDataFrame(sorted(rows), "doc_id bigint, text string, lang string, source string").repartition(4)
    docs.withColumn("id", F.lit("clash")).write.parquet(f"{path}/documents.parquet")
    pages = [(i, f"http://h/{i}", f"<p>{i % 4}</p>" if i % 5 else None) for i in range(30)] + [(40, None, ""), (41, "u", "é" * 50_000)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3).write.parquet(f"{path}/pages.parquet")
    rnd = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in rnd.normal(size=5)]) for i in range(400)] + [(400 + i, [0.25] * 5) for i in range(120)] + [(600, None), (700, [1.0, None, 0.0, 0.0, 0.0])]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    labels = [(i, int(i % 2 == 0), 0) for i, *_ in sorted(rows)[:90]]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(spark, folder, name):
    return [r.asDict(True) for r in catalogue.QUERIES[name](spark, folder).collect()]


def documents(spark, folder):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_against_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    found = con.execute(catalogue.SQL[name])
    names = [d[0] for d in found.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in found.fetchall()), key=str)
    got = sorted(({n: r[n] for n in names} for r in rows_of(spark, folder, name)), key=str)
    assert got == want and got


def test_op1(spark, folder):
    docs, got = documents(spark, folder), rows_of(spark, folder, "op1_secret_scan")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    kinds = ("assign", "access", "hex")
    for r in got:
        base = base_spans(docs[r["doc_id"]]["text"] or "")
        listed = [f"{kinds[k]}:{a}:{b}" for a, k, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("novel")] == listed


def test_op2(spark, folder):
    from tokenizers import Tokenizer

    tokenizer, docs = Tokenizer.from_file(P.path("byte_bpe_50k.json")), documents(spark, folder)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows_of(spark, folder, "op2_packing"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    total = 0
    for i, doc in docs.items():
        ids = np.array([*tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        at, total = 0, total + len(ids)
        for r in sorted(pieces.pop(i), key=lambda r: r["start"]):
            part = ids[at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    for parts in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(parts)]).tolist()]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    assert len(sequences) <= -(-total // 2048) * 1.02 + 2


def test_op4(spark, folder):
    import base64

    import tiktoken

    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain, docs = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), documents(spark, folder)
    got = rows_of(spark, folder, "op4_bpe")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        text = docs[r["doc_id"]]["text"] or ""
        ids = plain.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op6(spark, folder):
    from millrace.llm.token_counts import _encoding

    want = defaultdict(lambda: [0, 0])
    for name in ("byte_bpe_50k", "byte_bpe_multi_50k"):
        encode = _encoding(P.path(f"{name}.tiktoken")).encode_ordinary
        for r in documents(spark, folder).values():
            total = want[r["source"], r["lang"], name]
            total[0] += 1
            total[1] += len(encode(r["text"] or ""))
    got = rows_of(spark, folder, "op6_token_counts")
    assert {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"]] for r in got} == dict(want)


class PlainKneserNey:
    """Interpolated modified Kneser-Ney over byte strings, a dictionary at a time."""

    def __init__(self, texts, order):
        self.order, levels = order, {order: Counter()}
        for t in texts:
            padded = quality.BEGIN * (order - 1) + t + quality.END
            levels[order].update(padded[i : i + order] for i in range(len(padded) - order + 1))
        for k in range(order - 1, 0, -1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        self.own, self.aside = {}, {}
        for level in levels.values():
            n = Counter(level.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
            d = {i: max(0.1, min(i - 0.1, i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0.5 * i)) for i in (1, 2, 3)}
            total, held = Counter(), Counter()
            for g, c in level.items():
                total[g[:-1]] += c
                held[g[:-1]] += d[min(c, 3)]
            self.own |= {g: (c - d[min(c, 3)]) / total[g[:-1]] for g, c in level.items()}
            k = len(next(iter(level)))
            self.aside |= {(k, context): held[context] / total[context] for context in total}

    def p(self, gram):
        if not gram:
            return 1 / quality.ALPHABET
        return self.own.get(gram, 0.0) + self.aside.get((len(gram), gram[:-1]), 1.0) * self.p(gram[1:])

    def perplexity(self, text):
        padded = quality.BEGIN * (self.order - 1) + text + quality.END
        logs = [math.log(self.p(padded[i : i + self.order])) for i in range(len(padded) - self.order + 1)]
        return math.exp(-sum(logs) / len(logs))


def test_op8(spark, folder):
    docs, trusted = documents(spark, folder), {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    ids = spark.createDataFrame([(i,) for i in docs], "doc_id bigint")
    half = {r["doc_id"]: r["h"] for r in ids.withColumn("h", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()}
    text = {i: (d["text"] or "").encode() for i, d in docs.items()}
    models = {}
    for lang in ("en", "de", None):
        for h in (0, 1):
            mine = [text[i] for i in sorted(trusted) if docs[i]["lang"] == lang and half[i] != h]
            models[lang, h] = PlainKneserNey(mine, quality.ORDER)
    got = {r["doc_id"]: r for r in rows_of(spark, folder, "op8_quality")}
    assert sorted(got) == sorted(docs)
    want = {i: models[d["lang"], half[i]].perplexity(text[i]) for i, d in docs.items() if len(text[i]) < 5000}
    assert all(math.isclose(got[i]["perplexity"], p, rel_tol=1e-9) for i, p in want.items()) and len(want) > 100
    for lang in ("en", "de", None):
        known = sorted(r["perplexity"] for i, r in got.items() if i in trusted and docs[i]["lang"] == lang)
        limit = known[math.ceil(quality.QUANTILE * len(known)) - 1] * quality.SLACK
        for i, r in got.items():
            if docs[i]["lang"] == lang:
                assert math.isclose(r["threshold"], limit) and r["kept"] == (r["perplexity"] <= r["threshold"])
