"""Documents that are hard to handle, and plain versions of the operators."""

import hashlib
import random
import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(40)) for _ in range(n))


def texts():
    base, passage = prose(1, 120), prose(2, 70)
    out = [None, "", " ", "\t\n", "one", "One  one", "one one", "a b c d", "a b c d e", "x" * 70_000, "été ñandú 日本 🎉 " * 30]
    out += [base, base, base.replace(" ", "  \n"), base.upper(), base + " end", "start " + base, prose(3, 2000) + " " + passage]
    out += [prose(10 + i, 60) + " " + passage + " " + prose(50 + i, 60) for i in range(40)]  # one passage in many
    out += [" ".join(w if j != i else f"other{i}" for j, w in enumerate(base.split())) for i in range(60)]  # near copies
    out += ["password = 'hunter2hunter2' and AKIA" + "Q" * 16, "token: abc key deadbeef" + "0123456789" * 3, "secret=" + "x" * 5]
    return out


def documents(spark, extra=True):
    rows = [(i * 3 + 1, t, ["en", "de", None][i % 3], "src0") for i, t in enumerate(texts())]
    rows.append(rows[11])  # a repeated row
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    if extra:
        for name in ("id", "digest", "salt", "norm", "gram", "sig", "set_id", "keep_id", "ids", "length", "spans"):
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")


def pairs(df):
    return sorted({(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()}, key=lambda x: x[0])


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def shingle_set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def linked_groups(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        own = [b[p : p + 50] for p in range(len(b) - 49)]
        for p, w in enumerate(own):
            if w in seen:
                gone[p : p + 50] = b"\1" * 50
        seen.update(own)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), hashlib.sha256(kept).hexdigest())
    return out
