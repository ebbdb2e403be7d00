"""Partition-scoped upsert: what is read, rewritten, moved, removed and recovered."""
import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from loadkit.contracts import AuditColumns, ContractError, LoadSpec
from loadkit.operators.upsert import upsert
from loadkit.plans.partitioned import PartitionedTable, partition_filter
from loadkit.plans.runner import run_load

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
AUD = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")
COLS = "id long, v string, part string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, upd_by string, del_flag string"
SRC = "id long, v string, part string"


def _table(spark, tmp, rows, parts=("part",)):
    t = PartitionedTable(spark, os.path.join(tmp, "t"), parts)
    t.create(spark.createDataFrame([(i, v, p, T1, "seed", None, None, "N") for i, v, p in rows], COLS))
    return t


def _files(t):
    return {r["path"] for r in t.files().collect()}


def _rows(t):
    return sorted(((r.id, r.v, r.part, r.del_flag) for r in t.read().collect()), key=str)


def test_move_between_partitions_empties_and_keeps(spark, tmp):
    t = _table(spark, tmp, [(1, "a", "x"), (2, "b", "y"), (3, "c", "y"), (4, "d", "z 1/%"), (5, "e", None)])
    before = _files(t)
    src = spark.createDataFrame([(1, "a2", "y"), (9, "n", "new=1"), (5, "e2", None), (None, "k", "y")], SRC)
    m = t.upsert(src.withColumn("del_flag", F.lit("N")), ["id"], AUD, "L", T2, "run 1")
    assert _rows(t) == sorted([(1, "a2", "y", "N"), (2, "b", "y", "N"), (3, "c", "y", "N"), (4, "d", "z 1/%", "N"), (5, "e2", None, "N"), (9, "n", "new=1", "N")], key=str)
    assert (m["n_insert"], m["n_update"], m["rows_rewritten"]) == (1, 2, 5)
    kept = before & _files(t)
    assert len(kept) == 1 and "z" in next(iter(kept)).rsplit("part=", 1)[1]
    assert not any("part=x" in f for f in _files(t))          # emptied
    assert t.upsert(src.withColumn("del_flag", F.lit("N")), ["id"], AUD, "L", T2, "run 1") == {}


def test_equals_the_whole_table_upsert(spark, tmp):
    rows = [(i, f"v{i}", f"p{i % 7}") for i in range(200)]
    t = _table(spark, tmp, rows)
    src = spark.createDataFrame([(i, f"w{i}", f"p{(i + (i % 3 == 0)) % 7}") for i in range(0, 300, 5)], SRC).withColumn("del_flag", F.lit("N"))
    want = upsert(t.read(), src, ["id"], AUD, "L", T2)
    want = sorted(tuple(r) for r in want.select(sorted(want.columns)).collect())
    t.upsert(src, ["id"], AUD, "L", T2, "r")
    assert sorted(tuple(r) for r in t.read().select(sorted(want and t.read().columns)).collect()) == want


@pytest.mark.parametrize("scope, gone", [("partitions", {2}), ("table", {2, 4})])
def test_delete_scope(spark, tmp, scope, gone):
    t = _table(spark, tmp, [(1, "a", "x"), (2, "b", "x"), (4, "d", "z")])
    spec = LoadSpec("L", t.root, lambda s: s.createDataFrame([(1, "a", "x")], SRC), "callable", ("id",), AUD, delete_flag_col="del_flag",
                    detect_deletes=True, partition_by=("part",), delete_scope=scope)
    assert not spec.validate()
    m = run_load(spark, spec, "d-1", T2).metrics
    assert {r.id for r in t.read().filter("del_flag = 'Y'").collect()} == gone and m["n_delete"] == len(gone)


def test_a_driver_that_died_before_publishing(spark, tmp, monkeypatch):
    t = _table(spark, tmp, [(1, "a", "x"), (2, "b", "y")])
    src = spark.createDataFrame([(1, "z", "y")], SRC).withColumn("del_flag", F.lit("N"))
    with monkeypatch.context() as mp:
        mp.setattr(PartitionedTable, "_publish", lambda self, name: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            t.upsert(src, ["id"], AUD, "L", T2, "r1")
    # another one, before its plan was complete: nothing of it may appear
    spark.createDataFrame([(7, "q", "x")], SRC).write.partitionBy("part").parquet(f"{t.root}/_loadkit/pending/half/data")
    again = PartitionedTable(spark, t.root, ["part"])
    assert _rows(again) == [(1, "z", "y", "N"), (2, "b", "y", "N")]
    assert again.committed("r1") and not os.path.exists(f"{t.root}/_loadkit/pending/half")


def test_keys_that_hold_the_partition_need_no_lookup_and_the_scan_is_pruned(spark, tmp):
    t = _table(spark, tmp, [(1, "a", "x"), (1, "b", "y")])
    src = spark.createDataFrame([(1, "c", "y")], SRC).withColumn("del_flag", F.lit("N"))
    t.upsert(src, ["id", "part"], AUD, "L", T2, "r")
    assert _rows(t) == [(1, "a", "x", "N"), (1, "c", "y", "N")]
    plan = t.read().filter(partition_filter(["part"], [("y",)]))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ = y", plan)
    assert t.read().filter(partition_filter(["part", "id"], [("y", 1), (None, 2)])).count() == 1
    assert t.read().filter(partition_filter(["part"], [])).count() == 0


def test_what_is_refused(spark, tmp):
    t = _table(spark, tmp, [(1, "a", "x")])
    with pytest.raises(ContractError):
        t.create(t.read())
    with pytest.raises(ContractError):
        PartitionedTable(spark, t.root, ["ins_by"]).upsert(t.read(), ["id"], AUD, "L", T2, "r")
    bad = LoadSpec("L", "db.t", "x", keys=("id",), audit=AUD, partition_by=("part",), delete_where="id = 1")
    assert len(bad.validate()) == 2
    empty = spark.createDataFrame([], SRC).withColumn("del_flag", F.lit("N"))
    before = _files(t)
    assert t.upsert(empty, ["id"], AUD, "L", T2, "nothing")["rows_rewritten"] == 0 and _files(t) == before
