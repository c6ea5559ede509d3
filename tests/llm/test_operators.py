import base64
import hashlib
import io
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("millrace.llm")

from millrace.llm import bpe, dedup_exact, knn, near_dup, packing, quality, secrets, suffix_dedup, token_counts, warc  # noqa: E402
from millrace.llm.common import components  # noqa: E402

from . import cases  # noqa: E402

P = pytest.importorskip("public_tokenizers")


# --- exact dedup


@pytest.mark.parametrize("digest", [dedup_exact.sha256_of, lambda n: F.substring(F.unhex(F.sha2(n, 256)), 1, 1)])
def test_exact_dedup(spark, digest):
    docs = cases.documents(spark)
    got = [r.asDict() for r in dedup_exact.exact_dedup(docs, digest=digest).collect()]
    rows = [(r["doc_id"], cases.norm(r["text"])) for r in docs.collect()]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    assert len(got) == len(rows)
    want = Counter((i, min(groups[t]), len(groups[t]), i == min(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert Counter(tuple(r.values()) for r in got) == want


def test_exact_dedup_nulls_and_empty(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (5, "a"), (None, "b")], "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in dedup_exact.exact_dedup(docs).collect()), key=str)
    assert got == [(5, 5, 3, True), (None, 5, 3, False), (None, 5, 3, False), (None, None, 1, True)]
    assert dedup_exact.exact_dedup(cases.empty(spark)).count() == 0
    plan = dedup_exact.exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- secrets


def base_spans(text):
    out = []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


TRICKY = [
    "token=token:abcdefgh", 'API_KEY = "abc.def-123"', "apikey:'x/y+z=='", "PaſSword=abcdef", "toKen=abcdef", "password = = abcdefg",
    "AKIAAKIA" + "A" * 11, "AKIA" + "B" * 15, "xAKIA" + "C" * 30, "0123456789abcdef01234567", "G0123456789abcdef0123456", "secret:AKIA" + "D" * 16,
    "é" * 5 + " token=abcdefgh", "password=" + "a1" * 30_000, "passwd : 12345", "passwd : 123456",
]


def test_secret_base_spans():
    scanner = secrets.Scanner()
    for text in TRICKY + [t or "" for t in cases.texts()]:
        got = [x[:3] for x in scanner.scan(text) if x[1] < 3]
        assert got == base_spans(text), text[:80]


def test_secret_novelty():
    scanner = secrets.Scanner()
    text = 'client credential -> "zQ8vT2mK9xW4pL7nR3aB" for the service'
    assert [secrets.KINDS[x[1]] for x in scanner.scan(text)] == ["novel"]
    assert scanner.scan("see page zQ8vT2mK9xW4pL7nR3aB of the book") == []
    assert scanner.scan("the key words1234words1234words1234words1234words1234 words1234words1234words1234") == []


def spots(text, value):
    return [(m.start(), m.end()) for m in re.finditer(re.escape(value), text)]


def test_secret_copies():
    scanner, key = secrets.Scanner(), "zQ8vT2mK9xW4pL7nR3aB"
    line = f'client credential "{key}"\n'
    texts = [line * 2, line * 30, line + "the quick brown fox jumps " * 5 + line, line + f"sent {key} to the host" + " word" * 90 + f" //host/{key}/x"]
    # A copy that the bound of the surroundings cuts.
    texts += [line + "ab " * n + " " * k + line for n in (55, 60) for k in range(3)]
    for text in texts:
        assert [(s, e) for s, k, e, _ in scanner.scan(text) if k == 3] == spots(text, key), text
        assert key not in secrets._masked(text, scanner, "[SECRET]")
    assert scanner.scan(f"see page {key} of the book, and page {key}") == []


def test_secret_unspaced_assignments():
    scanner, key = secrets.Scanner(), "zQ8vT2mK9xW4pL7nR3aB"
    texts = [f"export PRIVATE_KEY={key}", f"AUTH={key}", f"client_credential={key}\n", f"env AUTH=={key} run", f"X=1=AUTH={key}=v"]
    texts += [f"AUTH={key}\nexport PRIVATE_KEY={key}\nAUTH={key}", f"PRIVATE_KEY={key}={key}"]
    for text in texts:
        assert [(s, e) for s, k, e, _ in scanner.scan(text) if k == 3] == spots(text, key), text
    padded = f"AUTH={key}=="
    assert [x[:3] for x in scanner.scan(padded)] == [(5, 3, len(padded))]
    assert scanner.scan(f"page={key}") == []
    short = "client credential a1=zQ8vT2mK9xW4pL"
    assert [x[:3] for x in scanner.scan(short)] == [(18, 3, len(short))]


def test_secret_letters_digits_and_rests():
    scanner, key = secrets.Scanner(), "zQ8vT2mK9xW4pL7nR3aB"
    for value in ("qzvxtkmwplrnaybcdjfh", "QzvXtkmWplrNaybCdjfH", "83017492655103846927"):
        text = f'client credential "{value}" for the service'
        assert [(s, e) for s, k, e, _ in scanner.scan(text) if k == 3] == spots(text, value), text
    for joint in "/=-_":
        for base in ("AKIA" + "Q" * 16, "0123456789abcdef01234567"):
            # An access key takes in the capitals that follow, a hex number its digits; joints end both.
            for text in (f"session {base}{joint}{key} end", f"session {key}{joint}{base} end", f"auth {key}{joint}{base}{joint}{key}"):
                assert [(s, e) for s, k, e, _ in scanner.scan(text) if k == 3] == spots(text, key), text
                assert [x[:3] for x in scanner.scan(text) if x[1] < 3] == base_spans(text)
    assert scanner.scan("the key zzzzzzzzzzzzzzzzzzzzzzzz and 1111111111111111 ------------------------") == []
    assert scanner.scan("token get_authenticated_session_handler some-hyphenated-css-class-name") == []


def test_secret_scan_and_redaction(spark):
    docs = cases.documents(spark)
    found = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(docs).collect()}
    for i, t in cases.pairs(docs):
        assert [(s["start"], s["end"]) for s in found[i] if s["kind"] != "novel"] == [(a, b) for a, _, b in base_spans(t or "")]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    for i, t in cases.pairs(docs):
        assert (clean[i] == t) == (not found[i]) and (t is None or not base_spans(clean[i] or ""))
    assert secrets.redact(docs).columns == docs.columns and secrets.scan_secrets(cases.empty(spark)).count() == 0


# --- BPE


def test_bpe_matches_tiktoken(spark):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    b = bpe.Bpe.load(path, P.PATTERN)
    ref = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    hard = ["aaaa" * 200, "ab" * 300, " \n \n  x", "\x1c\x85 a  b", "don't I'LL we've's", "²½Ⅷ ١٢٣", "a b  c", "<|endoftext|>", " lead", "trail ", "x\n y"]
    texts = [t or "" for t in cases.texts()] + hard
    got = []
    for ids, counts in b.encode(texts, part=7):
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [ref.encode_ordinary(t) for t in texts]
    rnd = np.random.default_rng(6)
    for letters in ("ab", "aaab", "abcdefghijklmnopqrstuvwxyz", "日本é"):  # long words without a cut
        word = "".join(rnd.choice(list(letters), 20_000))
        assert b.replay([word.encode()])[0].tolist() == ref.encode_ordinary(word)
    words = [w.encode() for t in texts for w in b.split.findall(t)]
    ids, counts = b.replay([w for w in words if len(w) < 300])
    assert int(counts.sum()) == len(ids)
    docs = cases.documents(spark)
    rows = bpe.bpe_decode(bpe.bpe_encode(docs, path, P.PATTERN), path, P.PATTERN).collect()
    want = dict(cases.pairs(docs))
    assert all(bytes(r["text"]).decode() == (want[r["doc_id"]] or "") for r in rows) and len(rows) == docs.count()
    assert bpe.bpe_encode(cases.empty(spark), path, P.PATTERN).count() == 0


# --- packing


def test_encoder_matches_tokenizers():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    texts = [t or "" for t in cases.texts()] + ["  lead", "don't\n\n\tgo ²½", "🎉é" * 50]
    texts += ["<|endoftext|> x", "a <|endoftext|> b", "a  <|endoftext|>\n<|endoftext|><|endoftext|", "x<|endoftext|>'s  "]
    got = [packing.encoder(path).encode(x, allowed_special="all") for x in texts]
    assert [e.ids for e in t.encode_batch(texts, add_special_tokens=False)] == got


def test_packing(spark):
    path = P.path("byte_bpe_50k.json")
    docs = cases.documents(spark)
    rows = [r.asDict() for r in packing.pack_documents(docs, path, with_ids=True).collect()]
    enc, want = packing.encoder(path), Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r["doc_id"]] += len(enc.encode_ordinary(r["text"] or "")) + 1
    by_doc, by_seq = Counter(), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]] += r["length"]
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    assert by_doc == want
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    pieces = {(r["doc_id"], r["start"]): r["ids"] for r in rows}
    text = dict(cases.pairs(docs))
    for i, t in text.items():
        ids = sum((v for k, v in sorted(pieces.items()) if k[0] == i), [])
        assert ids == [*enc.encode_ordinary(t or ""), 1]
    assert packing.pack_documents(cases.empty(spark), path).count() == 0


def test_first_basis_is_inverted_by_substitution():
    rnd = np.random.default_rng(2)
    need = rnd.integers(1, 1000, 120).astype(float)
    sizes = np.sort(rnd.choice(np.arange(1, 257), 120, replace=False))
    patterns, ended = packing._first_fill(need, sizes, 256)
    basis = patterns[:, sizes - 1].T
    product = (basis[:, :, None] * packing._triangular_inverse(patterns[:, sizes - 1], ended)[None]).sum(axis=1)
    assert np.allclose(product, np.eye(120), atol=1e-6)


@pytest.mark.parametrize("n", [1, 50, 20_000, 400_000])
def test_cutting_stock(spark, n):  # beside a live session
    rnd = np.random.default_rng(n)
    sizes = np.minimum(512, np.maximum(1, rnd.lognormal(5, 1, n).astype(int)))
    demand = np.bincount(sizes, minlength=513)[1:]
    plan = packing.cutting_stock(demand)
    assert (plan.times @ plan.patterns >= demand).all() and (plan.patterns @ np.arange(1, 513) <= 512).all()
    least = -(-int(sizes.sum()) // 512)
    assert plan.times.sum() <= max(least * 1.02 + 2, least + 1)


# --- search


def brute(vectors, queries, k):
    out = set()
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q and len(w) == len(v))
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def test_top_k(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=6)]) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(80)] + [(900, None), (901, [1.0, None] + [0.0] * 4), (902, [float("nan")] * 6), (903, [float("inf")] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("id", F.lit("clash")).repartition(3)
    vectors = df.select("vec_id", "id", knn.quantised(F.col("embedding")).alias("embedding"))
    plain = [(r["vec_id"], r["embedding"]) for r in vectors.collect() if r["embedding"] is not None]
    assert len(plain) == 380
    queries = vectors.where("vec_id % 20 = 0")
    got = {tuple(r) for r in knn.exact_top_k(vectors, queries, 10, shard_rows=60, block_queries=7, block_roots=3).collect()}
    assert got == brute(plain, [(i, v) for i, v in plain if i % 20 == 0], 10)
    again = queries.unionByName(queries).unionByName(queries.where("vec_id = 20"))
    rows = knn.exact_top_k(vectors, again, 10, shard_rows=6).collect()
    assert {tuple(r) for r in rows} == got and len(rows) == len(got)
    mixed = vectors.unionByName(vectors.select((F.col("vec_id") + 2000).alias("vec_id"), "id", F.slice("embedding", 1, 3).alias("embedding")))
    plain = [(r["vec_id"], r["embedding"]) for r in mixed.collect() if r["embedding"] is not None]
    got = {tuple(r) for r in knn.exact_top_k(mixed, mixed.where("vec_id % 40 = 0"), 10, shard_rows=50).collect()}
    assert got == brute(plain, [(i, v) for i, v in plain if i % 40 == 0], 10)
    few = vectors.where("vec_id < 4")
    assert knn.exact_top_k(few, few, 10).count() == 12
    assert knn.exact_top_k(vectors.limit(0), queries.limit(0)).count() == 0


# --- Jaccard join


def test_signatures_are_shared_by_linked_sets():
    rnd = np.random.default_rng(5)
    for size in [*range(1, 40), 63, 64, 65, 127, 128, 129, 400, 1000, 1500]:
        for _ in range(6):
            a = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
            drop = int(rnd.integers(0, len(a) * 20 // 100 + 1))
            more = int(rnd.integers(0, (len(a) - drop) * 100 // 80 - len(a) + 1))
            c = np.unique(np.concatenate([a[drop:], rnd.integers(0, 1 << 63, more, dtype=np.uint64)]))
            common = len(np.intersect1d(a, c))
            assert 100 * common >= 80 * (len(a) + len(c) - common)
            assert set(near_dup.signatures(a).tolist()) & set(near_dup.signatures(c).tolist())


def test_near_duplicates(spark):
    docs = cases.documents(spark)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs).collect()}
    assert got == cases.linked_groups(cases.pairs(docs))
    assert near_dup.near_duplicates(cases.empty(spark)).count() == 0


@pytest.mark.parametrize("block", [near_dup.BLOCK, 16])
def test_near_duplicates_of_crowded_signatures(spark, monkeypatch, block):
    """Chains of small texts: more sets share a signature than are paired at once, or fit a block."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    base = cases.prose(9, 30).split()
    rows = [(i, " ".join([*base, *(f"w{i}" for _ in range(i % 3))][: 30 + i % 3])) for i in range(90)]
    rows += [(200 + i, " ".join(base[:15] + [f"q{i}{j}" for j in range(15)])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs).collect()}
    assert got == cases.linked_groups(rows)


def test_near_duplicates_of_null_and_repeated_ids(spark):
    """A chain through a set that only null ids hold, and links of each text of one id."""
    base, other = cases.prose(11, 60).split(), cases.prose(12, 60).split()
    chain = [" ".join(base[i : i + 50]) for i in (0, 5, 10)]
    again = [" ".join(w) for w in (base[10:], other[:50], other[5:55])]
    rows = [(1, chain[0]), (None, chain[1]), (2, chain[2]), (None, chain[1]), (7, "x " + again[0]), (7, again[1]), (9, again[2])]
    assert cases.linked_groups([(0, chain[0]), (1, chain[2])])[1][1] == 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs).collect()), key=str)
    at = cases.linked_groups([(i, t) for i, (_, t) in enumerate(rows)])
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[at[i][1]] = min(doc, least.get(at[i][1], doc))
    want = [(doc, at[i][0], least.get(at[i][1])) for i, (doc, _) in enumerate(rows)]
    assert got == sorted(want, key=str) and (None, 46, 1) in got and (2, 46, 1) in got


def test_components(spark):
    """Chains, a hub, repeated and turned links, links of a node with itself; negative ids; no links."""
    links = [(i, i + 1) for i in range(10, 40)] + [(i + 1, i) for i in range(60, 75)] + [(100, 100 + i) for i in range(1, 50)]
    links += [(-5, 10), (-5, 10), (10, -5), (200, 200), (75, 149)]
    got = components(spark.createDataFrame(links, "a bigint, b bigint").repartition(5)).collect()
    least = {x: x for link in links for x in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    del least[200]
    assert len(got) == len(least) and {r["node"]: r["component"] for r in got} == least
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- token counts


def test_token_rollup(spark, tmp_path):
    docs = cases.documents(spark)
    path = {n: P.path(f"{n}.tiktoken") for n in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    counts = token_counts.count_tokens(docs, path).cache()
    want = Counter()
    for r in counts.collect():
        want[r["source"], r["lang"], r["tokenizer"]] += r["n_tokens"]
    one = docs.where("doc_id = 34").first()["text"]
    enc = token_counts._encoding(path["byte_bpe_50k"])
    assert counts.where("doc_id = 34 AND tokenizer = 'byte_bpe_50k'").first()["n_tokens"] == len(enc.encode_ordinary(one))
    roll = token_counts.TokenRollup(spark, f"file://{tmp_path}/r")

    def total():
        return {(r["source"], r["lang"], r["tokenizer"]): r["n_tokens"] for r in roll.totals().collect()}

    assert roll.apply("a", token_counts.inserts(counts)) and not roll.apply("a", token_counts.inserts(counts))
    assert total() == dict(want)
    revised = counts.withColumn("n_tokens", F.col("n_tokens") + 1)
    roll.compact()
    assert roll.apply("b/é", token_counts.revisions(counts, revised)) and not roll.apply("a", token_counts.inserts(counts))
    assert sum(total().values()) == sum(want.values()) + counts.count()
    roll.compact()
    assert not roll.apply("b/é", token_counts.deletes(revised))
    roll.apply("c", token_counts.deletes(revised))
    assert total() == {}
    roll.apply("d", token_counts.inserts(token_counts.count_tokens(cases.empty(spark), path)))
    assert total() == {}


# --- WARC


def test_warc(spark, tmp_path):
    pages = [(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (9, None, "<p>x</p>"), (3, "http://a/ \r\n3", "WARC/1.1\r\n\r\n" * 50), (4, "u", None), (5, "u", ""), (6, "u", "é" * 400_000), (None, "u", "lone")]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("sha", F.lit("clash")).repartition(3)
    archives = warc.archive_pages(df, f"file://{tmp_path}/w")
    got = {r["page_id"]: r for r in warc.read_archives(archives, with_payload=True).collect()}
    assert len(got) == 8
    for i, _, html in pages:
        data = (html or "").encode()
        r = got[i]
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == data
    assert [(got[i]["record_type"], got[i]["refers_to"]) for i in (1, 2, 9, 4, 5)] == [
        ("revisit", 9), ("revisit", 9), ("response", None), ("revisit", 5), ("response", None),
    ]
    big = {r["page_id"]: r["refers_to"] for r in warc.with_references(df, least_bytes=1).collect()}
    assert big[4] is None and big[1] == 9
    assert warc.archive_pages(df.limit(0), f"file://{tmp_path}/none").count() == 0


def test_warc_streams():
    records = [warc.record(i, "u", bytes([i]) * (i * 40_000), None, "d") for i in range(5)]
    whole = zlib.compressobj(wbits=31)
    data = whole.compress(b"".join(records)) + whole.flush()
    out = io.BytesIO()
    entries = list(warc.normalise(io.BytesIO(data), out))
    assert [zlib.decompress(out.getvalue()[e["offset"] : e["offset"] + e["length"]], 31) for e in entries] == records
    again = io.BytesIO()
    assert list(warc.normalise(io.BytesIO(out.getvalue()), again)) == entries and again.getvalue() == out.getvalue()
    for bad in (data[:-20], data[: len(data) // 2]):
        with pytest.raises(ValueError):
            list(warc.normalise(io.BytesIO(bad), io.BytesIO()))
    assert list(warc.normalise(io.BytesIO(b""), io.BytesIO())) == []


# --- quality


def test_kneser_ney_is_a_distribution(spark):
    docs = spark.createDataFrame([(7, "abracadabra"), (7, "abba"), (7, "cab")], "lang_key bigint, text string")
    counts = quality.gram_counts(docs, 3)
    model = {(r["n_bytes"], r["gram"]): r for r in quality.kneser_ney(counts, 3).collect()}

    def p(gram):
        k = len(gram)
        key = int.from_bytes(gram, "big") if gram else 0
        if (k, key) in model and model[k, key]["logp"] is not None:
            return np.exp(model[k, key]["logp"])
        context = model.get((k - 1, key >> 8))
        return p(gram[1:]) * (np.exp(context["backoff"]) if context and context["backoff"] is not None else 1.0)

    for context in (b"ab", b"ra", b"\x02a", b"zz"):
        total = sum(p(context + bytes([w])) for w in range(256))
        assert abs(total - 1) < 0.02, (context, total)  # two symbols of the alphabet aren't bytes


def test_quality(spark):
    good = [(i, cases.prose(i, 150), "en") for i in range(0, 60)]
    bad = [(100 + i, "".join(chr(33 + (i * j * 7919) % 90) for j in range(400)), "en") for i in range(1, 8)]
    other = [(200, None, "en"), (201, "", None), (202, "word", "xx"), (None, "alpha1 beta2", "en"), (0, good[0][1], "en")]
    docs = spark.createDataFrame(good + bad + other, "doc_id bigint, text string, lang string").withColumn("id", F.lit("clash")).repartition(3)
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint")
    got = {r["doc_id"]: r for r in quality.classify(docs, trusted).collect()}
    assert all(not got[i]["kept"] for i, _, _ in bad)
    assert sum(got[i]["kept"] for i, _, _ in good) >= 58
    assert got[202]["kept"] and got[202]["perplexity"] is None and got[201]["kept"]
    assert quality.classify(cases.empty(spark), trusted).count() == 0
    assert {r["kept"] for r in quality.classify(docs, trusted.limit(0)).collect()} == {True}


def test_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 1, None), (None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    assert {r["doc_id"] for r in quality.trusted_ids(labels).collect()} == {1, 4}


# --- suffix dedup


def test_suffix_dedup(spark):
    docs = cases.documents(spark).unionByName(
        spark.createDataFrame([(2, "a" * 49), (5, "a" * 200), (8, "b" + "a" * 50 + "c"), (11, "ab" * 100), (14, "ba" * 60)], "doc_id bigint, text string"), True
    )
    out = suffix_dedup.remove_repeats(docs)
    got = {r["doc_id"]: r for r in out.collect()}
    want = cases.without_repeats(cases.pairs(docs))
    assert {i: (r["n_bytes"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for i, r in got.items()} == want
    assert all(sum(s["hi"] - s["lo"] for s in r["removed"]) == r["n_removed"] and len(r["removed"]) == r["n_spans"] for r in got.values())
    assert suffix_dedup.remove_repeats(cases.empty(spark)).count() == 0
    null = spark.createDataFrame([(None, "x" * 80), (1, "x" * 80), (2, "x" * 80)], "doc_id bigint, text string")
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(null).collect()} == {None: 0, 1: 0, 2: 80}


def test_crowded_grams_are_cut_to_windows(spark, monkeypatch):
    rows = [(0, None, [{"gram": 1, "start": 0, "windows": 3, "crowded": True}])]

    batch = pa.RecordBatch.from_pydict({"id": [4], "text": ["q" * 60], "found": [rows[0][2]]})
    out = next(suffix_dedup._texts(iter([batch])))
    assert out.column("start").to_pylist() == [0, 1, 2] and {len(p) for p in out.column("piece").to_pylist()} == {50}


def test_suffix_dedup_of_a_crowded_gram(spark):
    """One line in many contexts: its gram's pieces are cut to windows, and nothing else changes."""
    line = "this line of seventy bytes stands in every document, as lines often do"
    rows = [(i, cases.prose(i, 12) + line[: 40 + i % 30] + cases.prose(100 + i, 12) + line) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    want = cases.without_repeats(rows)
    for crowd in (suffix_dedup.CROWD, 5):
        out = suffix_dedup.remove_repeats(docs, crowd=crowd, block_bytes=1000).collect()
        assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in out} == want


def test_spans_of_a_batch_are_merged():
    """Overlaps and touching spans are one stretch; null, empty and too long lists of rows that repeat an id are met."""
    rnd = np.random.default_rng(2)
    kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
    for size in [0, 1, 2, 5] * 100:
        n = rnd.choice([0, 5, 20], size)
        spans, want = [], []
        for i in range(size):
            lo = rnd.integers(0, 25, rnd.integers(0, 5)).tolist()
            spans.append([{"lo": a, "hi": a + int(rnd.integers(1, 6))} for a in lo] if lo or i % 2 else None)
            covered = [any(x["lo"] <= b < x["hi"] for x in spans[i] or []) for b in range(n[i])] + [False]
            edges = [b for b in range(n[i] + 1) if covered[b] != (b > 0 and covered[b - 1])]
            want += [(i, a, b) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        got = suffix_dedup._islands(pa.array(spans, kind), n)
        assert list(zip(*(g.tolist() for g in got), strict=True)) == want


def test_run_length_index():
    rnd = np.random.default_rng(1)
    seed = bytes(rnd.integers(97, 100, 400).astype(np.uint8))
    texts = list(dict.fromkeys(seed[a : a + n] for a, n in zip(rnd.integers(0, 300, 60).tolist(), rnd.integers(50, 90, 60).tolist(), strict=True)))
    owners = np.arange(len(texts))[::-1].copy() // 2
    index = suffix_dedup.RunLengthIndex(texts, owners)
    got = index.earlier(owners, np.array([len(t) for t in texts]))
    first = {}
    for t, o in zip(texts, owners.tolist(), strict=True):
        for p in range(len(t) - 49):
            first[t[p : p + 50]] = min(o, first.get(t[p : p + 50], o))
    want = [[first[t[p : p + 50]] < o for p in range(len(t) - 49)] for t, o in zip(texts, owners.tolist(), strict=True)]
    assert [g.tolist() for g in got] == want
    data, ranks = b"".join(t + b"\0" for t in texts), np.arange(len(texts))
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    for step in range(1, 40):  # what lies a step before each text's end
        ranks = index.back(ranks)
        assert index.locate(ranks).tolist() == [int(e) - step for e in ends]
    assert len(data) == index.size and index.runs < sum(map(len, texts)) / 2
