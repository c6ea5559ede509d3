from collections import Counter

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from . import cases  # noqa: E402


def test_stages(spark, tmp_path):
    rows = [(1000 + i, cases.prose(i, 80), "en", "s", 5) for i in range(80)]
    rows += [(i * 3 + 1, t, "en", "s", len(t or "")) for i, t in enumerate(cases.texts())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(1000 + i, 1, 0) for i in range(0, 80, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = cases.pairs(at) if "text" in at.columns else None
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        at = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert at.columns == docs.columns
            kept.append({i for i, _ in cases.pairs(at)})
        if name == "quality classifier":
            assert {1000 + i for i in range(80)} <= kept[-1] | {1000 + i for i in (0, 1)}
        if name == "exact dedup":
            first = {}
            for i, t in before:
                first.setdefault(cases.norm(t), i)
            assert kept[-1] == set(first.values())
        if name == "n-gram Jaccard join":
            assert kept[-1] == {i for i, (_, c) in cases.linked_groups(before).items() if i == c}
        if name == "secret scans":
            assert kept[-1] == {i for i, _ in before} and not any("hunter2" in (t or "") for _, t in cases.pairs(at))
    assert {r["doc_id"] for r in at.collect()} == kept[-1]
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(tuple, whole.select("doc_id", "start", "length").collect())) == Counter(map(tuple, at.select("doc_id", "start", "length").collect()))


def stored(spark, tmp_path, rows, labels=()):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    for name in ("id", "row", "kept", "component_id", "gone", "docs", "length"):
        docs = docs.withColumn(name, F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def test_rows_of_repeated_and_null_ids(spark, tmp_path):
    """Only the rejected row of an id goes; a null id gives way to others; extra columns stay as they are."""
    a, b, c = (cases.prose(k, 60) for k in (21, 22, 23))
    near_b = b + " end"
    rows = [(1, a), (2, b), (3, c), (3, a), (4, near_b), (4, c + " x y z"), (None, c), (None, "lone words of null"), (5, None), (5, "")]
    docs = stored(spark, tmp_path, [(i, t, "en", "s", 1) for i, t in rows])
    stages = dict(corpus_pipeline.STAGES)
    everything = stages["quality classifier"](spark, docs, str(tmp_path))
    assert everything.count() == len(rows) and everything.columns == docs.columns  # nothing is trusted, so all stay

    def left(df):
        assert df.columns == docs.columns
        return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)

    exact = stages["exact dedup"](spark, docs, str(tmp_path))
    kept = [r for r in rows if r not in ((3, a), (None, c))]
    assert left(exact) == sorted(kept, key=str)
    near = stages["n-gram Jaccard join"](spark, exact, str(tmp_path))
    assert left(near) == sorted([r for r in kept if r not in ((4, near_b), (4, c + " x y z"))], key=str)
    assert left(stages["secret scans"](spark, near, str(tmp_path))) == left(near)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == near.count()


def test_an_empty_table(spark, tmp_path):
    docs = stored(spark, tmp_path, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0, name
