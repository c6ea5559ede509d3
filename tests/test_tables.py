import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedup import deduplicate
from millrace.operators.partition import spec
from millrace.operators.writer import write_batch
from millrace.options import Options
from millrace.sources.table import CommitConflict, Table, load_namespace

ROW = "id int, first_name string, __op string, __source_ts_ns bigint, __arrival bigint"


def batch(spark, *events):
    """Events as (op, id[, name[, ts]])."""
    rows = [(e[1], (e[2] if len(e) > 2 else "n"), e[0], (e[3] if len(e) > 3 else 0), i) for i, e in enumerate(events)]
    return spark.createDataFrame(rows, ROW)


def make(spark, tmp_path, keys=("id",), **more):
    schema = T.StructType([T.StructField(f.name, f.dataType, f.name not in keys) for f in spark.createDataFrame([], ROW).schema if f.name != "__arrival"])
    return Table.create(spark, f"file://{tmp_path}/t", schema, list(keys), list(keys), **more)


def state(table):
    return {(r["id"], r["first_name"]): r["__op"] for r in table.read().collect()}


def ops(table):
    return {r["id"]: (r["__op"], r["first_name"]) for r in table.read().collect()}


def test_soft_deletes(spark, tmp_path):
    t, o = make(spark, tmp_path), Options(upsert=True)
    write_batch(t, batch(spark, "c1 c2 c3".split()[0:0] or ("c", 1), ("c", 2), ("c", 3)), o, "1")
    assert len(ops(t)) == 3
    write_batch(t, batch(spark, ("r", 1), ("d", 2), ("u", 3, "V1"), ("c", 4)), o, "2")
    assert {k: v[0] for k, v in ops(t).items()} == {1: "r", 2: "d", 3: "u", 4: "c"}
    third = [("r", 3), ("u", 3), ("u", 3, "V4"), ("u", 4), ("u", 4), ("r", 4, "4V3"), ("r", 5), ("r", 6), ("d", 6), ("c", 6), ("u", 6, "6V1")]
    assert write_batch(t, batch(spark, *third), o, "3") and not write_batch(t, batch(spark, *third), o, "3")
    got = ops(t)
    assert len(got) == 6 and got[3] == ("u", "V4") and got[4] == ("r", "4V3") and got[6] == ("u", "6V1")


def test_hard_deletes_and_history(spark, tmp_path):
    t, o = make(spark, tmp_path), Options(upsert=True, upsert_keep_deletes=False)
    write_batch(t, batch(spark, ("c", 1), ("c", 2), ("c", 3)), o)
    write_batch(t, batch(spark, ("r", 1), ("d", 2), ("u", 3), ("c", 4)), o)
    assert set(ops(t)) == {1, 3, 4}
    write_batch(t, batch(spark, ("u", 3), ("d", 4), ("d", 5), ("r", 6), ("d", 6), ("c", 6), ("u", 6, "V1")), o)
    assert set(ops(t)) == {1, 3, 6} and ops(t)[6] == ("u", "V1")
    t.compact()
    assert set(ops(t)) == {1, 3, 6} and not t.snapshot().deletes
    assert {r["id"] for r in t.read(version=1).collect()} == {1, 2, 3}
    assert [r["operation"] for r in t.snapshots().orderBy("version").collect()] == ["create", "overwrite", "overwrite", "overwrite", "compact"]
    assert t.history().where("is_current").count() == 1


def test_composite_key(spark, tmp_path):
    t, o = make(spark, tmp_path, ("id", "first_name")), Options(upsert=True, upsert_keep_deletes=False)
    write_batch(t, batch(spark, ("c", 1, "u1"), ("c", 1, "u2"), ("u", 1, "u1"), ("r", 1, "u1")), o)
    assert state(t) == {(1, "u1"): "r", (1, "u2"): "c"}
    write_batch(t, batch(spark, ("u", 1, "u1"), ("r", 1, "u1"), ("d", 1, "u1"), ("d", 1, "u2")), o)
    assert state(t) == {}


def test_without_keys_upserts_append(spark, tmp_path):
    t, o = make(spark, tmp_path, ()), Options(upsert=True)
    for _ in range(2):
        write_batch(t, batch(spark, ("c", 1), ("c", 1), ("u", 1)), o)
    assert t.read().count() == 6


def test_dedup_column_and_new_key(spark):
    def run(*events, by="__source_ts_ns"):
        got = deduplicate(batch(spark, *events), ["id"], "__arrival", by=by).collect()
        return [(r["__op"], r["__new_key"]) for r in got]

    assert run(("c", 1, "n", 1), ("u", 1, "n", 3), by=None) == [("u", True)]
    assert run(("r", 1, "n", 1), ("u", 1, "n", 1)) == [("u", False)]
    assert run(("r", 1, "n", 1), ("d", 1, "n", 1), ("c", 1, "n", 1), ("u", 1, "n", 1)) == [("d", False)]
    assert run(("u", 1, "n", 5), ("c", 1, "n", 1)) == [("u", False)]
    with pytest.raises(Exception, match="null key"):
        run(("c", None))


def test_unknown_op_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="unexpected operation"):
        write_batch(make(spark, tmp_path), batch(spark, ("x", 1)), Options(upsert=True))


@pytest.mark.parametrize("keep, by", [(True, None), (False, None), (True, "__source_ts_ns"), (False, "__source_ts_ns")])
def test_random_batches(spark, tmp_path, keep, by):
    rnd, t, want = random.Random(7), make(spark, tmp_path), {}
    o = Options(upsert=True, upsert_keep_deletes=keep, upsert_dedup_column=by)
    prio = {"c": 1, "r": 2, "u": 3, "d": 4}
    for b in range(4):
        events = [(rnd.choice("crud"), rnd.randrange(8), f"{b}.{i}", rnd.randrange(3)) for i in range(15)]
        write_batch(t, batch(spark, *events), o, str(b))
        last = {}
        for i, e in enumerate(events):
            rank = (e[3], prio[e[0]], i) if by else (i,)
            if e[1] not in last or rank > last[e[1]][0]:
                last[e[1]] = (rank, e)
        for k, (_, e) in last.items():
            want.pop(k, None)
            if keep or e[0] != "d":
                want[k] = (e[0], e[2])
    assert ops(t) == want


@pytest.mark.parametrize("kind", ["parquet", "orc"])
def test_partitions_and_pruning(spark, tmp_path, kind):
    rows = spark.range(100).select("id", (F.col("id") % 3).cast("string").alias("g"), F.timestamp_seconds(F.col("id") * 7200).cast("timestamp_ntz").alias("ts"))
    t = Table.create(spark, f"file://{tmp_path}/p", rows.schema, partition=spec(["g", "day(ts)", "bucket(id, 4)"], rows.schema, True), format=kind)
    t.append(rows)
    t.append(rows.limit(0))
    assert t.read().count() == 100
    some = t.read(between={"id": (5, 5), "g": ("2", None)})
    assert [r["id"] for r in some.collect()] == [5]
    assert "_p_id_bucket" in some._jdf.queryExecution().executedPlan().toString()


def test_conflicts_are_retried_and_failures_leave_nothing(spark, tmp_path):
    t = make(spark, tmp_path)
    before = t.snapshot().version
    with pytest.raises(Exception):
        t.append(batch(spark, ("c", 1)).select(F.raise_error(F.lit("no")).cast("int").alias("id"), "first_name", "__op", "__source_ts_ns"))
    assert t.snapshot().version == before and t.store.names("data") == []
    with pytest.raises(CommitConflict):
        t.store.create("_log/0000000000.json", "{}")
    real, calls = t._commit, []

    def late(new):
        if not calls:
            calls.append(1)
            Table(spark, t.folder).append(batch(spark, ("c", 9)).drop("__arrival"))
        return real(new)

    t._commit = late
    t.append(batch(spark, ("c", 1)).drop("__arrival"))
    assert set(ops(t)) == {1, 9} and t.snapshot().version == 2


def test_overwrite_rename_and_namespace(spark, tmp_path):
    t = make(spark, tmp_path, ())
    t.append(batch(spark, ("c", 1), ("c", 2)).drop("__arrival"))
    t.overwrite(batch(spark, ("c", 3)).drop("__arrival"))
    t.rename_column("first_name", "name_legacy")
    t.evolve(spark.createDataFrame([], "first_name bigint").schema)
    r = t.read().first()
    assert (r["id"], r["name_legacy"], r["first_name"]) == (3, "n", None)
    assert load_namespace(spark, f"file://{tmp_path.parent}", tmp_path.name) == ["t"]


def joined(table):
    return table.read()._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("key", ["bigint", "string"])
def test_many_deletes_in_small_files_are_not_broadcast(spark, tmp_path, key):
    n = 600_000
    rows = spark.range(n).select(F.col("id").cast(key).alias("id"), (F.col("id") % 7).alias("v"))
    t = Table.create(spark, f"file://{tmp_path}/t", rows.schema, ["id"], format="orc")
    t.append(rows)
    t.row_delta(None, spark.range(0, 1000, 10).select(F.col("id").cast(key).alias("id")))
    assert "BroadcastHashJoin" in joined(t)  # a few are still left to the optimizer
    assert t.read().count() == n - 100
    t.row_delta(rows.where("id % 5 <> 0"), rows.select("id"))
    files = [p for p in (tmp_path / "t/deletes").rglob("*.orc")]
    assert sum(p.stat().st_size for p in files) < 10 << 20
    assert "BroadcastHashJoin" not in joined(t) and "SortMergeJoin" in joined(t)
    want = [k for k in range(n) if k % 5]
    got = t.read().agg(F.count("*"), F.sum(F.col("id").cast("bigint")), F.sum("v")).first()
    assert tuple(got) == (len(want), sum(want), sum(k % 7 for k in want))


def test_deletes_of_a_log_without_sizes(spark, tmp_path):
    t = Table.create(spark, f"file://{tmp_path}/t", spark.range(0).schema, ["id"], format="orc")
    t.append(spark.range(100))
    t.row_delta(spark.range(5), spark.range(50))
    entry = tmp_path / "t/_log/0000000002.json"
    raw = json.loads(entry.read_text())
    assert list(raw.pop("delete_bytes").values()) == [50 * 24]
    (entry.parent / f".{entry.name}.crc").unlink(missing_ok=True)
    entry.write_text(json.dumps(raw))
    assert "BroadcastHashJoin" not in joined(t)
    assert sorted(r["id"] for r in t.read().collect()) == [*range(5), *range(50, 100)]
    t.compact()
    assert t.snapshot().delete_bytes == {} and t.read().count() == 55
