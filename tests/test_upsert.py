"""Upsert and change classification: the target-table cases of the fixture list."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadkit.contracts import AuditColumns, ContractError
from loadkit.operators.changes import classify_changes
from loadkit.operators.upsert import ACTION_COL, append_rows, key_violations, upsert, upsert_frame

AUD = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")
TGT_DDL = ("k1 string, k2 string, d_str string, d_int bigint, d_dec decimal(15,2), d_date date, del_flag string, "
           "ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, upd_by string")
T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 2, 1)
T2 = dt.datetime(2024, 3, 1)


def tgt(spark, rows):
    return spark.createDataFrame(rows, TGT_DDL)


def src(spark, rows, ddl="k1 string, k2 string, d_str string, d_int bigint, d_dec decimal(15,2), d_date date"):
    return spark.createDataFrame(rows, ddl)


def d(x):
    return Decimal(x)


BASE = [
    ("a", "1", "x", 1, d("1.00"), dt.date(2024, 1, 1), "N", T0, "seed", None, None),   # unchanged
    ("a", "2", "y", 2, d("2.00"), dt.date(2024, 1, 2), "N", T0, "seed", None, None),   # changed
    ("a", "3", "z", 3, d("3.00"), dt.date(2024, 1, 3), "N", T0, "seed", None, None),   # missing from source
    ("a", "4", "w", 4, d("4.00"), dt.date(2024, 1, 4), "Y", T0, "seed", T0, "old"),    # returns after delete
    ("a", "5", None, 5, d("5.00"), None, "N", T0, "seed", None, None),                 # NULL moved
    ("a", "6", "p-q", 6, d("6.00"), None, "N", T0, "seed", None, None),                # '-' inside text
]
SRC = [
    ("a", "1", "x", 1, d("1.00"), dt.date(2024, 1, 1)),
    ("a", "2", "y2", 2, d("2.00"), dt.date(2024, 1, 2)),
    ("a", "4", "w", 4, d("4.00"), dt.date(2024, 1, 4)),
    ("a", "5", "5", None, d("5.00"), None),
    ("a", "6", "p", 6, d("6.00"), None),
    ("a", "7", "new", 7, d("7.00"), None),                                             # new
    (None, "8", "nullkey", 8, d("8.00"), None),                                        # NULL key
]


def run(spark, t, s, ts=T1, **kw):
    return {(r["k1"], r["k2"]): r for r in upsert_frame(t, s, ["k1", "k2"], AUD, "L1", ts, **kw).collect()}


def test_upsert_cases_with_soft_delete(spark):
    out = run(spark, tgt(spark, BASE), src(spark, SRC), delete_flag_col="del_flag", detect_deletes=True)
    act = {k: r[ACTION_COL] for k, r in out.items()}
    assert act == {("a", "1"): "keep", ("a", "2"): "update", ("a", "3"): "delete", ("a", "4"): "restore",
                   ("a", "5"): "update", ("a", "6"): "update", ("a", "7"): "insert"}
    assert out[("a", "2")]["d_str"] == "y2" and out[("a", "2")]["ins_ts"] == T0 and out[("a", "2")]["upd_ts"] == T1
    assert out[("a", "3")]["del_flag"] == "Y" and out[("a", "3")]["upd_by"] == "L1" and out[("a", "3")]["d_str"] == "z"
    assert out[("a", "4")]["del_flag"] == "N" and out[("a", "4")]["upd_ts"] == T1
    assert out[("a", "7")]["del_flag"] == "N" and out[("a", "7")]["ins_by"] == "L1" and out[("a", "7")]["upd_ts"] is None
    assert out[("a", "1")]["upd_ts"] is None
    assert (None, "8") not in out     # NULL keys are not applied ...
    v = key_violations(src(spark, SRC), ["k1", "k2"]).collect()
    assert [(r["violation"], r["k2"]) for r in v] == [("null_key", "8")]   # ... but reported


def test_missing_twice_stamps_once_and_keep_mode(spark):
    first = upsert(tgt(spark, BASE), src(spark, SRC), ["k1", "k2"], AUD, "L1", T1,
                   delete_flag_col="del_flag", detect_deletes=True)
    second = run(spark, first, src(spark, SRC), ts=T2, delete_flag_col="del_flag", detect_deletes=True)
    assert second[("a", "3")][ACTION_COL] == "keep" and second[("a", "3")]["upd_ts"] == T1
    assert all(r[ACTION_COL] == "keep" for r in second.values())          # idempotent
    kept = run(spark, tgt(spark, BASE), src(spark, SRC), delete_flag_col="del_flag", detect_deletes=True,
               on_reappear="keep")
    assert kept[("a", "4")]["del_flag"] == "Y" and kept[("a", "4")][ACTION_COL] == "keep"


def test_without_delete_detection_flag_is_data(spark):
    s = src(spark, [r + ("N",) for r in SRC[:1]],
            "k1 string, k2 string, d_str string, d_int bigint, d_dec decimal(15,2), d_date date, del_flag string")
    out = run(spark, tgt(spark, BASE), s)
    assert out[("a", "3")][ACTION_COL] == "keep" and out[("a", "3")]["del_flag"] == "N"


def test_duplicate_source_key_fails(spark):
    s = src(spark, SRC[:2] + [SRC[1]])
    kw = dict(delete_flag_col="del_flag", detect_deletes=True)
    with pytest.raises(ContractError, match="duplicate"):      # reported before anything runs
        upsert_frame(tgt(spark, BASE), s, ["k1", "k2"], AUD, "L1", T1, check_keys="separate", **kw)
    lazy = upsert_frame(tgt(spark, BASE), s, ["k1", "k2"], AUD, "L1", T1, **kw)   # inline guard
    with pytest.raises(Exception, match="duplicate key"):
        lazy.collect()


def test_mixed_case_order_and_narrow_types(spark):
    s = spark.createDataFrame([(7, "a", "2", "y2", 2.0, dt.date(2024, 1, 2))],
                              "D_INT int, K1 string, k2 string, D_Str string, d_dec double, D_DATE date")
    out = run(spark, tgt(spark, BASE), s, delete_flag_col="del_flag", detect_deletes=True)
    assert out[("a", "2")][ACTION_COL] == "update" and out[("a", "2")]["d_int"] == 7
    assert out[("a", "2")]["d_dec"] == d("2.00")


def test_empty_source_and_empty_target(spark):
    empty_s = src(spark, [])
    out = run(spark, tgt(spark, BASE), empty_s, delete_flag_col="del_flag", detect_deletes=True)
    assert sum(r[ACTION_COL] == "delete" for r in out.values()) == 5
    out2 = run(spark, tgt(spark, []), src(spark, SRC), delete_flag_col="del_flag", detect_deletes=True)
    assert all(r[ACTION_COL] == "insert" for r in out2.values()) and len(out2) == 6


def test_classify_legacy_hash_misses_changes(spark):
    t = tgt(spark, BASE).drop("del_flag", "ins_ts", "ins_by", "upd_ts", "upd_by")
    s = src(spark, SRC)
    exact = {r["k2"]: r["record_status"] for r in classify_changes(s, t, ["k1", "k2"]).collect()}
    legacy = {r["k2"]: r["record_status"] for r in classify_changes(s, t, ["k1", "k2"], compare="legacy_hash").collect()}
    digest = {r["k2"]: r["record_status"] for r in classify_changes(s, t, ["k1", "k2"], compare="digest").collect()}
    assert exact["5"] == "changed" and exact["6"] == "changed"
    assert exact == digest
    assert legacy["1"] == "unchanged" and legacy["2"] == "changed"
    assert exact["8"] == "null_key" and exact["7"] == "new"


def test_classify_legacy_hash_null_collision(spark):
    t = spark.createDataFrame([("k", "a", None, "b")], "id string, c1 string, c2 string, c3 string")
    s = spark.createDataFrame([("k", "a", "b", None)], "id string, c1 string, c2 string, c3 string")
    assert classify_changes(s, t, ["id"], compare="legacy_hash").first()["record_status"] == "unchanged"
    assert classify_changes(s, t, ["id"]).first()["record_status"] == "changed"


def test_append_rows(spark):
    t = tgt(spark, BASE).drop("del_flag")
    s = src(spark, SRC).select("d_date", "k2", "k1", "d_str", "d_int", "d_dec")
    rows = append_rows(t.schema, s, AUD, "L2", T1).collect()
    assert len(rows) == len(SRC) and all(r["ins_by"] == "L2" and r["upd_ts"] is None for r in rows)
    with pytest.raises(ContractError):
        append_rows(t.schema, s.drop("d_date"), AUD, "L2", T1)


def test_row_count_property(spark):
    """new target rows = target rows + inserted rows, over a seeded random change set."""
    import random
    rnd = random.Random(7)
    base = [("k", str(i), f"v{rnd.randint(0, 3)}", i, d("1.00"), None, "N", T0, "s", None, None) for i in range(300)]
    chg = [("k", str(i), f"v{rnd.randint(0, 3)}", i, d("1.00"), None) for i in range(150, 450)]
    t, s = tgt(spark, base), src(spark, chg)
    kw = dict(delete_flag_col="del_flag", detect_deletes=True)
    new = upsert_frame(t, s, ["k1", "k2"], AUD, "L1", T1, **kw)
    n_ins = new.filter(F.col(ACTION_COL) == "insert").count()
    assert new.count() == t.count() + n_ins == 450
    again = upsert_frame(new.drop(ACTION_COL), s, ["k1", "k2"], AUD, "L1", T2, **kw)
    assert again.filter(F.col(ACTION_COL) != "keep").count() == 0


def test_null_keys_split_off_on_both_sides(spark):
    base = BASE + [(None, "9", "legacy", 9, d("9.00"), None, "N", T0, "seed", None, None)]
    out = upsert_frame(tgt(spark, base), src(spark, SRC), ["k1", "k2"], AUD, "L1", T1,
                       delete_flag_col="del_flag", detect_deletes=True).collect()
    legacy = [r for r in out if r["k2"] == "9"]
    assert len(legacy) == 1 and legacy[0][ACTION_COL] == "keep" and legacy[0]["d_str"] == "legacy"
    assert len(out) == len(base) + 1          # one insert (a,7); the NULL-key source row is not applied
    t = tgt(spark, base).drop("del_flag", "ins_ts", "ins_by", "upd_ts", "upd_by")
    st = classify_changes(src(spark, SRC), t, ["k1", "k2"]).collect()
    assert len(st) == len(SRC) and [r["record_status"] for r in st if r["k1"] is None] == ["null_key"]


def test_keys_only_tables(spark):
    t = spark.createDataFrame([(1,), (2,)], "id long")
    s = spark.createDataFrame([(2,), (3,)], "id long")
    st = {r["id"]: r["record_status"] for r in classify_changes(s, t, ["id"]).collect()}
    assert st == {2: "unchanged", 3: "new"}


def test_null_keys_are_salted_into_the_hash_key(spark):
    """Many NULL-key rows must not share one shuffle partition: the salt has to be
    part of the hash key (not folded into a join filter), with one shuffle per side."""
    base = [(None, str(i), "x", i, d("1.00"), None, "N", T0, "seed", None, None) for i in range(50)] + BASE
    t = tgt(spark, base)
    up = upsert_frame(t, src(spark, SRC), ["k1", "k2"], AUD, "L1", T1, delete_flag_col="del_flag", detect_deletes=True)
    plan = up._jdf.queryExecution().executedPlan().toString()
    exchanges = [l for l in plan.split("\n") if "Exchange hashpartitioning" in l]
    assert len(exchanges) == 2 and all("_salt" in l for l in exchanges)
    assert up.filter(F.col("k1").isNull()).count() == 50
    cl = classify_changes(src(spark, SRC), t.drop("del_flag", "ins_ts", "ins_by", "upd_ts", "upd_by"), ["k1", "k2"])
    cplan = cl._jdf.queryExecution().executedPlan().toString()
    assert all("_salt" in l for l in cplan.split("\n") if "Exchange hashpartitioning" in l)
