
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from loadkit.contracts import AuditColumns, ContractError, LoadSpec, validate_target_columns
from loadkit.operators.audit import maintenance_due
from loadkit.operators.conform import conform
from loadkit.plans.runner import run_load
from loadkit.plans.snapshots import SnapshotTable

AUD = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")
T1 = dt.datetime(2024, 2, 1)
TGT = "id long, v string, del string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, upd_by string"


def test_d14_first_maintenance_is_due_on_empty_history(spark):
    runs = spark.createDataFrame([], "table_name string, start_time timestamp_ntz, status string")
    tables = spark.createDataFrame([("t",)], "table_name string")
    first = maintenance_due(runs, T1, tables=tables).collect()
    assert [(r["table_name"], r["n_runs"], r["due"]) for r in first] == [("t", 0, True)]
    runs = spark.createDataFrame([("t", dt.datetime(2024, 1, 31), "failed"), ("u", dt.datetime(2024, 1, 31), "success")],
                                 "table_name string, start_time timestamp_ntz, status string")
    due = {r["table_name"]: r["due"] for r in maintenance_due(runs, T1, days=7).collect()}
    assert due == {"t": True, "u": False}


def test_d25_merge_from_a_table_source(spark, tmp):
    tgt = SnapshotTable(spark, os.path.join(tmp, "t25"))
    tgt.write(spark.createDataFrame([(1, "a", "N", None, None, None, None)], TGT), run_id="seed")
    spark.sql("CREATE DATABASE IF NOT EXISTS lk_src")
    spark.sql("DROP TABLE IF EXISTS lk_src.s25")
    (spark.createDataFrame([(1, "b"), (2, "c")], "id long, v string").write.mode("overwrite")
          .option("path", os.path.join(tmp, "s25")).saveAsTable("lk_src.s25"))
    spec = LoadSpec(load_id="T", target=tgt.root, source="lk_src.s25", source_type="table", keys=("id",), audit=AUD,
                    delete_flag_col="del", detect_deletes=True)
    res = run_load(spark, spec, "d25", T1)
    assert res.metrics["n_insert"] == 1 and res.metrics["n_update"] == 1


def test_d27_missing_flag_column_fails_validation(spark):
    spec = LoadSpec(load_id="T", target="x/y", source="select 1", keys=("id",), audit=AUD,
                    delete_flag_col="del", detect_deletes=True)
    assert validate_target_columns(["id", "v", "ins_ts", "ins_by", "upd_ts", "upd_by"], spec) == \
        ["target lacks column del"]


def test_d28_unknown_strategy_is_an_error(spark, tmp):
    spec = LoadSpec(load_id="T", target=os.path.join(tmp, "t28"), source="select 1", keys=("id",), audit=AUD,
                    strategy="delete")
    with pytest.raises(ContractError, match="strategy"):
        run_load(spark, spec, "d28", T1)


def test_d4_failed_casts_are_reported_not_silent(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("1", "2024-01-31"), ("x", "2024-02-30"), (None, None)], "ID string, D string")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("d", T.DateType())])
    rows = conform(df, target, error_col="_failed").collect()
    assert [r["_failed"] for r in rows] == [[], ["id", "d"], []]
    with pytest.raises(ContractError):
        conform(df.drop("D"), target)                         # column sets must be equal


def test_d6_overwrite_feed_without_files_keeps_the_table(spark, tmp):
    raw = SnapshotTable(spark, os.path.join(tmp, "raw6"))
    raw.write(spark.range(3), run_id="old")
    assert raw.read().count() == 3 and len(raw.snapshots()) == 1   # nothing truncated ahead of a load
