"""Runner, ledger feed loads, snapshots, numbering, table creation, contracts."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadkit.contracts import (AuditColumns, ColumnMap, ContractError, FeedContract, LoadSpec, TableDef,
                               validate_load_row, validate_table_def)
from loadkit.functions.exprs import literal_prefix, substitute
from loadkit.functions.numbering import number_within
from loadkit.operators.audit import audit_latest_state, parquet_append_sink
from loadkit.operators.ledger import LEDGER_SCHEMA, discover_files, entity_rules, stage_new_files
from loadkit.plans.runner import load_feed, load_many, run_load
from loadkit.plans.snapshots import SnapshotTable
from loadkit.plans.tables import create_tables, environment_properties, merge_properties, table_ddl
from loadkit.sources.listing import list_files, normalise_paths

AUD = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")
T1 = dt.datetime(2024, 2, 1)


def test_number_within_matches_window_on_skewed_groups(spark):
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 20)}", f"{i:06d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o string")
    a = number_within(df, ["g"], ["o"], out="rn", num_partitions=16)
    w = df.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    joined = a.join(w, ["g", "o"])
    assert joined.count() == 3000
    assert joined.filter(F.col("rn") != F.col("rn2")).count() == 0


def test_glob_helpers():
    assert literal_prefix("FEED_A*.txt") == "FEED_A" and literal_prefix("X.txt") == "X.txt"
    assert substitute("select * from <<source>>", {"source": "v1"}) == "select * from v1"
    with pytest.raises(ContractError):
        substitute("select * from <<source>>", {"source": "v1; drop table x"})


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)
    os.utime(path, (0, dt.datetime(2024, 1, 1, 0, 0, int(os.path.basename(path)[3:5])).timestamp()))


FEED = FeedContract("cc", (ColumnMap("_c0", "code", "string"), ColumnMap("_c1", "amount", "decimal(15,2)")),
                    sep="|", extract_type="full", load_type="overwrite")


def _ledger_setup(spark, tmp):
    land = os.path.join(tmp, "landing")
    _write(f"{land}/cc/CC_01.txt", "a|1.00\nb|2.00\n")
    _write(f"{land}/cc/CC_02.txt", "a|1.50\n")
    _write(f"{land}/cc/CC_03.txt", "a|9.00\nc|3.00\n")
    _write(f"{land}/cc/CC_sub/CC_04.txt", "z|0.00\n")     # * crosses folders
    _write(f"{land}/other/XX_01.txt", "q|1\n")
    systems = spark.createDataFrame([("ERP", 1, land, "active")],
                                    "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    ents = spark.createDataFrame([("ERP", "CC", 2, "cc/CC_*.txt", "active"), ("ERP", "OFF", 3, "other/*", "inactive")],
                                 "src_sys_key string, src_entity_key string, src_entity_id int, "
                                 "src_entity_pattern string, src_entity_status string")
    listing = normalise_paths(list_files(spark, land, system_key="ERP"))
    disc = discover_files(listing, entity_rules(systems, ents))
    ledger = SnapshotTable(spark, os.path.join(tmp, "ledger"))
    staged = stage_new_files(disc, spark.createDataFrame([], LEDGER_SCHEMA), T1)
    ledger.write(staged.select(*LEDGER_SCHEMA.names), run_id="stage-1")
    return land, disc, ledger


def test_discover_stage_and_full_feed_load(spark, tmp):
    land, disc, ledger = _ledger_setup(spark, tmp)
    names = sorted(r["src_entity_name"] for r in disc.collect())
    assert names == ["CC_01.txt", "CC_02.txt", "CC_03.txt", "CC_04.txt"]
    led = ledger.read()
    assert sorted(r["src_entity_inst_no"] for r in led.collect()) == [1, 2, 3, 4]
    assert led.first()["src_entity_load_run_id"].startswith("00001.00002.")
    # staging again finds nothing new (anti join on the instance key)
    again = stage_new_files(disc, led, T1)
    assert again.count() == 0

    raw = SnapshotTable(spark, os.path.join(tmp, "raw_cc"))
    res = load_feed(spark, FEED, ledger, raw, "CC", "run-1")
    assert res.status == "completed" and res.metrics["n_files"] == 1
    st = {r["src_entity_name"]: r["src_entity_load_status"] for r in ledger.read().collect()}
    newest = max(st)  # CC_04 has the latest modification time
    assert st[newest] == "success" and sorted(st.values()).count("skipped") == 3
    assert raw.read().count() == 1
    # nothing left in the queue: no new snapshot, raw table untouched (no truncate before load)
    res2 = load_feed(spark, FEED, ledger, raw, "CC", "run-2")
    assert res2.metrics["n_files"] == 0 and raw.read().count() == 1


def test_incremental_all_appends_oldest_first_and_isolates_bad_file(spark, tmp):
    land, disc, ledger = _ledger_setup(spark, tmp)
    _write(f"{land}/cc/CC_05.txt", "bad|line|too|many\n")
    listing = normalise_paths(list_files(spark, land, system_key="ERP"))
    systems = spark.createDataFrame([("ERP", 1, land, "active")],
                                    "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    ents = spark.createDataFrame([("ERP", "CC", 2, "cc/CC_*.txt", "active")],
                                 "src_sys_key string, src_entity_key string, src_entity_id int, "
                                 "src_entity_pattern string, src_entity_status string")
    new = stage_new_files(discover_files(listing, entity_rules(systems, ents)), ledger.read(), T1)
    ledger.write(new.select(*LEDGER_SCHEMA.names), run_id="stage-2", mode="append")
    inc = FeedContract("cc", FEED.columns, sep="|", extract_type="incremental", load_type="append",
                       load_all_incremental=True, reject_bad_files=True)   # else the row stays and is counted
    raw = SnapshotTable(spark, os.path.join(tmp, "raw_inc"))
    res = load_many(spark, [(inc, raw, "CC")], ledger, "run-3")[0]
    assert res.status == "failed" and res.metrics["n_failed_files"] == 1
    assert raw.read().count() == 6
    st = {r["src_entity_name"]: r["src_entity_load_status"] for r in ledger.read().collect()}
    assert st["CC_05.txt"] == "failed" and st["CC_01.txt"] == "success"


def test_run_load_merge_with_hooks_audit_and_snapshots(spark, tmp):
    tgt = SnapshotTable(spark, os.path.join(tmp, "tgt"))
    base = spark.createDataFrame([(1, "a", "N", None, None, None, None), (2, "b", "N", None, None, None, None)],
                                 "id long, v string, del string, ins_ts timestamp_ntz, ins_by string, "
                                 "upd_ts timestamp_ntz, upd_by string")
    tgt.write(base, run_id="seed")
    spark.createDataFrame([(1, "a2"), (3, "c")], "id long, v string").createOrReplaceTempView("src_v")
    audit_dir = os.path.join(tmp, "audit")
    spec = LoadSpec(load_id="L1", target=tgt.root, source="SELECT id, v FROM src_v", keys=("id",), audit=AUD,
                    delete_flag_col="del", detect_deletes=True,
                    pre_sql="CREATE OR REPLACE TEMP VIEW pre_seen AS SELECT count(*) AS n FROM <<source>>",
                    post_sql="CREATE OR REPLACE TEMP VIEW post_seen AS SELECT count(*) AS n FROM <<target>>")
    res = run_load(spark, spec, "run-1", T1, audit_sink=parquet_append_sink(audit_dir))
    assert res.metrics["n_insert"] == 1 and res.metrics["n_update"] == 1 and res.metrics["n_delete"] == 1
    assert res.metrics["rows_read"] == 2
    out = {r["id"]: r for r in tgt.read().collect()}
    assert out[2]["del"] == "Y" and out[1]["v"] == "a2" and out[3]["ins_by"] == "L1"
    assert spark.table("pre_seen").first()["n"] == 2
    # re-running the same run id does not write twice
    run_load(spark, spec, "run-1", T1)
    assert len(tgt.snapshots()) == 2
    state = audit_latest_state(spark.read.parquet(audit_dir)).first()
    assert state["status"] == "completed" and state["rows_new"] == 1 and state["rows_read"] == 2
    # a failing load leaves a failed audit event
    bad = LoadSpec(load_id="L2", target=tgt.root, source="SELECT id FROM src_v", keys=("id",), audit=AUD)
    with pytest.raises(ContractError):
        run_load(spark, bad, "run-2", T1, audit_sink=parquet_append_sink(audit_dir))
    st = {r["id"]: r["status"] for r in audit_latest_state(spark.read.parquet(audit_dir)).collect()}
    assert st["run-2"] == "failed"


def test_run_load_insert_and_source_reading_target(spark, tmp):
    tgt = SnapshotTable(spark, os.path.join(tmp, "tgt_ins"))
    base = spark.createDataFrame([(1, "a", None, None, None, None)],
                                 "id long, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, "
                                 "upd_by string")
    tgt.write(base, run_id="seed")
    # the source reads the target itself: still correct, the new version goes to a new folder
    spec = LoadSpec(load_id="L9", target=tgt.root, source=lambda s: tgt.read().select((F.col("id") + 10).alias("id"), "v"),
                    source_type="callable", strategy="insert", audit=AUD)
    res = run_load(spark, spec, "ins-1", T1)
    assert res.metrics["n_insert"] == 1
    assert sorted(r["id"] for r in tgt.read().collect()) == [1, 11]


def test_snapshot_compact_and_expire(spark, tmp):
    t = SnapshotTable(spark, os.path.join(tmp, "snap"))
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    t.write(df, run_id="a", num_files=20)
    assert t.file_stats().first()["n_files"] == 20
    t.compact(target_file_bytes=1 << 30)
    assert t.file_stats().first()["n_files"] == 1 and t.read().count() == 1000
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=10)
    removed = t.expire(min_keep=1, max_age_days=3, now=later)
    assert len(removed) == 1 and len(t.snapshots()) == 1 and t.read().count() == 1000


def test_create_tables_and_properties(spark, tmp):
    assert merge_properties({"a": "1", "b": "1"}, {"b": "2"}) == {"a": "1", "b": "2"}
    d = {"DatabaseName": "lk_test", "TableName": "t1", "TableProperties": {"p": "x"},
         "Columns": [{"ColumnID": 1, "ColumnName": "id", "FormattedDataType": "bigint", "IsNull": False, "Description": "key"},
                     {"ColumnID": 2, "ColumnName": "amt", "FormattedDataType": "decimal(15,2)", "IsNull": True}]}
    assert validate_table_def(d) == []
    ddl = table_ddl(TableDef.from_json(d), {"p": "default", "q": "y"})
    assert "NOT NULL" in ddl and "COMMENT 'key'" in ddl and "'p' = 'x'" in ddl and "'q' = 'y'" in ddl
    created = create_tables(spark, [d])
    assert created == ["lk_test.t1"] and spark.catalog.tableExists("t1", "lk_test")
    assert create_tables(spark, [d]) == ["lk_test.t1"]          # if not exists
    with pytest.raises(ContractError):
        create_tables(spark, [dict(d, TableName="t2", Columns=[dict(d["Columns"][0], FormattedDataType="nosuchtype")])])
    with pytest.raises(ContractError):
        table_ddl(TableDef.from_json(dict(d, IsExternal="yes")))   # an external file table needs a location
    assert validate_table_def({"DatabaseName": "x"})
    assert environment_properties({"Production": {"a": "1"}}, "Production") == {"a": "1"}
    for env in ("prod", "Validation"):
        with pytest.raises(ContractError):
            environment_properties({"Production": {"a": "1"}}, env)


def test_load_row_validation():
    row = {"load_id": "1", "load_name": "n", "src_type": "query", "src_db_name": None, "src_tbl_name": None,
           "src_qry_text": "select 1", "aud_cols_json": json.dumps({"RecordInsertDate": "a", "RecordInsertBy": "b",
                                                                    "RecordUpdateDate": "c", "RecordUpdateBy": "d"}),
           "key_cols_json": json.dumps({"k": "id"}), "tgt_db_name": "db", "tgt_tbl_name": "t",
           "tgt_upd_strategy": "merge", "tgt_del_flag_col_name": None, "identify_src_delete": "no",
           "pre_tgt_load_sql": None, "post_tgt_load_sql": None}
    assert validate_load_row(row) == []
    spec = LoadSpec.from_row(row)
    assert spec.keys == ("id",) and spec.target == "db.t" and spec.audit.update_by == "d"
    assert validate_load_row(dict(row, identify_src_delete="yes"))
    assert validate_load_row(dict(row, tgt_upd_strategy="delete"))
    assert validate_load_row(dict(row, src_type="table"))
    assert validate_load_row(dict(row, src_qry_text=""))
    assert validate_load_row({k: v for k, v in row.items() if k != "key_cols_json"})


def test_run_load_maintenance_compacts(spark, tmp):
    from loadkit.plans.runner import MaintenancePolicy
    tgt = SnapshotTable(spark, os.path.join(tmp, "tgt_m"))
    base = spark.range(300).select(F.col("id"), F.lit("v").alias("v"),
                                   F.lit(None).cast("timestamp_ntz").alias("ins_ts"), F.lit(None).cast("string").alias("ins_by"),
                                   F.lit(None).cast("timestamp_ntz").alias("upd_ts"), F.lit(None).cast("string").alias("upd_by"))
    tgt.write(base, run_id="seed", num_files=30)
    spec = LoadSpec(load_id="L1", target=tgt.root, source=lambda s: s.range(5).select("id", F.lit("w").alias("v")),
                    source_type="callable", strategy="insert", audit=AUD)
    res = run_load(spark, spec, "m-1", T1, maintenance=MaintenancePolicy(max_files=4, min_mean_bytes=1 << 30))
    assert res.metrics["compacted"] and tgt.file_stats().first()["n_files"] == 1
    assert tgt.read().count() == 305


def test_run_load_catalog_target(spark, tmp):
    spark.sql("CREATE DATABASE IF NOT EXISTS lk_cat")
    spark.sql("DROP TABLE IF EXISTS lk_cat.tgt")
    spark.sql(f"CREATE TABLE lk_cat.tgt (id bigint, v string, ins_ts timestamp_ntz, ins_by string, "
              f"upd_ts timestamp_ntz, upd_by string) USING parquet LOCATION '{tmp}/cat_tgt'")
    spark.sql("INSERT INTO lk_cat.tgt VALUES (1, 'a', NULL, NULL, NULL, NULL), (2, 'b', NULL, NULL, NULL, NULL)")
    spec = LoadSpec(load_id="C1", target="lk_cat.tgt", keys=("id",), audit=AUD, source_type="callable",
                    source=lambda s: s.createDataFrame([(2, "b2"), (3, "c")], "id long, v string"))
    res = run_load(spark, spec, "cat-1", T1)
    assert res.metrics["n_insert"] == 1 and res.metrics["n_update"] == 1
    spark.catalog.refreshTable("lk_cat.tgt")
    assert {r["id"]: r["v"] for r in spark.table("lk_cat.tgt").collect()} == {1: "a", 2: "b2", 3: "c"}
    ins = LoadSpec(load_id="C2", target="lk_cat.tgt", strategy="insert", audit=AUD, source_type="callable",
                   source=lambda s: s.createDataFrame([(9, "z")], "id long, v string"))
    assert run_load(spark, ins, "cat-2", T1).metrics["n_insert"] == 1
    spark.catalog.refreshTable("lk_cat.tgt")
    assert spark.table("lk_cat.tgt").count() == 4


def test_load_xml_feed_appends_run_stamped_staging(spark, tmp):
    from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
    from loadkit.plans.runner import load_xml_feed
    land = os.path.join(tmp, "xland")
    doc = ("<ROOT><DOC><HDR><N>{n}</N></HDR><A><K>{n}a</K><B><V>1</V></B><B><V>2</V></B></A></DOC></ROOT>")
    for i in (1, 2):
        _write(f"{land}/x/GL_0{i}.xml", doc.format(n=i))
    contract = XmlContract("x", "DOC", (
        XmlRecordSet("a", "A", (XmlColumn("N", "HDR/N", False), XmlColumn("K", "A/K"))),
        XmlRecordSet("b", "A/B", (XmlColumn("N", "HDR/N", False), XmlColumn("K", "A/K", False),
                                  XmlColumn("V", "A/B/V")))))
    systems = spark.createDataFrame([("ERP", 1, land, "active")],
                                    "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    ents = spark.createDataFrame([("ERP", "GL", 5, "x/GL_*.xml", "active")],
                                 "src_sys_key string, src_entity_key string, src_entity_id int, "
                                 "src_entity_pattern string, src_entity_status string")
    disc = discover_files(normalise_paths(list_files(spark, land, system_key="ERP")), entity_rules(systems, ents))
    ledger = SnapshotTable(spark, os.path.join(tmp, "xledger"))
    ledger.write(stage_new_files(disc, spark.createDataFrame([], LEDGER_SCHEMA), T1).select(*LEDGER_SCHEMA.names))
    staging = {"a": SnapshotTable(spark, os.path.join(tmp, "stg_a")), "b": SnapshotTable(spark, os.path.join(tmp, "stg_b"))}
    res = load_xml_feed(spark, contract, ledger, staging, "GL", "x-1")
    assert res.metrics["rows_a"] == 2 and res.metrics["rows_b"] == 4
    assert sorted(r["K"] for r in staging["a"].read().collect()) == ["1a", "2a"]
    assert {r["src_entity_load_status"] for r in ledger.read().collect()} == {"success"}
    assert load_xml_feed(spark, contract, ledger, staging, "GL", "x-2").metrics["n_files"] == 0


def test_run_messages_flushed_once_even_on_failure(spark, tmp):
    tgt = SnapshotTable(spark, os.path.join(tmp, "tgt_msg"))
    tgt.write(spark.createDataFrame([(1, "a", None, None, None, None)],
                                    "id long, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, "
                                    "upd_by string"), run_id="seed")
    msgs = os.path.join(tmp, "msgs")
    ok = LoadSpec(load_id="M1", target=tgt.root, keys=("id",), audit=AUD, source_type="callable",
                  source=lambda s: s.createDataFrame([(1, "b")], "id long, v string"))
    run_load(spark, ok, "msg-1", T1, message_sink=parquet_append_sink(msgs))
    bad = LoadSpec(load_id="M2", target=tgt.root, keys=("id",), audit=AUD, source_type="callable",
                   source=lambda s: s.createDataFrame([(1,)], "id long"))
    with pytest.raises(ContractError):
        run_load(spark, bad, "msg-2", T1, message_sink=parquet_append_sink(msgs))
    m = spark.read.parquet(msgs)
    assert m.filter("run_id = 'msg-1'").count() == 2
    assert m.filter("run_id = 'msg-2' AND message_type = 'error'").count() == 1


def test_stream_sink_is_idempotent_per_batch(spark, tmp):
    from pyspark.sql import types as T
    from loadkit.streaming.ingest import snapshot_sink
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()),
                           T.StructField("ins_ts", T.TimestampNTZType()), T.StructField("ins_by", T.StringType()),
                           T.StructField("upd_ts", T.TimestampNTZType()), T.StructField("upd_by", T.StringType())])
    tbl = SnapshotTable(spark, os.path.join(tmp, "stream_tbl"))
    sink = snapshot_sink(tbl, target, AUD, "S", T1)                 # append mode
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    sink(batch, 0)
    sink(batch, 0)                                                  # replay of the same batch
    sink(batch.selectExpr("id + 10 AS id", "v"), 1)
    assert tbl.read().count() == 4 and len(tbl.snapshots()) == 2


def test_feed_reload_after_crash_publishes_once(spark, tmp):
    land, disc, ledger = _ledger_setup(spark, tmp)
    inc = FeedContract("cc", FEED.columns, sep="|", extract_type="incremental", load_type="append",
                       load_all_incremental=True)
    raw = SnapshotTable(spark, os.path.join(tmp, "raw_crash"))
    before = ledger.latest()
    load_feed(spark, inc, ledger, raw, "CC", "run-a")
    rows = raw.read().count()
    # simulate a crash after publishing: the ledger update is lost
    import shutil
    shutil.rmtree(ledger.latest().path)
    assert ledger.latest().seq == before.seq
    load_feed(spark, inc, ledger, raw, "CC", "run-b")
    assert raw.read().count() == rows
    assert {r["src_entity_load_status"] for r in ledger.read().collect()} == {"success"}


def test_merge_hooks_see_classified_source(spark, tmp):
    tgt = SnapshotTable(spark, os.path.join(tmp, "tgt_hook"))
    tgt.write(spark.createDataFrame([(1, "a", None, None, None, None)],
                                    "id long, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, "
                                    "upd_by string"), run_id="seed")
    spec = LoadSpec(load_id="H1", target=tgt.root, keys=("id",), audit=AUD, source_type="callable",
                    source=lambda s: s.createDataFrame([(1, "b"), (2, "c")], "id long, v string"),
                    pre_sql="CREATE OR REPLACE TEMP VIEW hook_status AS "
                            "SELECT record_status, count(*) AS n FROM <<source>> GROUP BY record_status")
    run_load(spark, spec, "hook-1", T1)
    got = {r["record_status"]: r["n"] for r in spark.table("hook_status").collect()}
    assert got == {"changed": 1, "new": 1}


def test_merge_into_reaches_the_catalog_as_one_statement(spark):
    """No source with row-level changes is at hand: the plan is built and analysed, and
    the plain table's refusal of MERGE is what comes back."""
    from loadkit.operators.upsert import merge_into
    from pyspark.errors import PySparkException
    spark.sql("CREATE TABLE IF NOT EXISTS lk_merge (id bigint, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, "
              "upd_by string, del_flag string) USING parquet")
    src = spark.createDataFrame([(1, "a"), (None, "x")], "ID long, v string")
    w = merge_into(src, "lk_merge", spark.table("lk_merge").schema, ["id"], AUD, "L1", T1, "del_flag", True)
    with pytest.raises(PySparkException) as e:
        w.merge()
    assert "does not support MERGE" in str(e.value)


def test_hidden_and_empty_files_are_listed(spark, tmp):
    from loadkit.sources.listing import list_files
    os.makedirs(os.path.join(tmp, "in"))
    for name, text in (("a.txt", "x"), ("b c%.txt", "y"), ("empty.txt", ""), ("_late.txt", "z"), (".dot.txt", "z")):
        with open(os.path.join(tmp, "in", name), "w") as fh:
            fh.write(text)
    got = list_files(spark, tmp).select(F.regexp_extract("path", "[^/]*$", 0).alias("n"), "length").collect()
    assert sorted((r.n, r.length) for r in got) == [(".dot.txt", 1), ("_late.txt", 1), ("a.txt", 1), ("b c%.txt", 1), ("empty.txt", 0)]


def test_glob_classes(spark):
    from loadkit.operators.ledger import glob_regex_col
    rows = [("F_[12]*.txt", "F_1x.txt", True), ("F_[12]*.txt", "F_3.txt", False), ("F_[!12].txt", "F_3.txt", True), ("F_[!12].txt", "F_1.txt", False),
            ("a[b.txt", "a[b.txt", True), ("a?c", "abc", True), ("a?c", "ac", False), ("x[a-c]y", "xby", True), ("x[*]y", "x*y", True),
            ("x[*]y", "xay", False), ("a.b", "axb", False), ("a+(b){2}^$|", "a+(b){2}^$|", True),
            ("a*b]c", "axxb]c", True), ("a*b]c", "ab", False), ("a/*/b?.[ch]sv", "a/x/y/b1.csv", True), ("a/*/b?.[ch]sv", "a/b1.txt", False), ("[a.b]*", ".x", True)]
    got = spark.createDataFrame(rows, "p string, n string, w boolean").select("*", F.regexp_like("n", glob_regex_col(F.col("p"))).alias("g")).collect()
    assert [(r.p, r.n) for r in got if r.g != r.w] == []


def test_xml_flatten_carries_no_ancestor(spark, tmp):
    from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
    from loadkit.sources.xml import load_xml_recordsets
    path = os.path.join(tmp, "a.xml")
    with open(path, "w") as fh:
        fh.write("<DOC><H><n>1</n></H><O><k>2</k><L><q>3</q></L><L><q>4</q></L></O></DOC>")
    c = XmlContract("x", "DOC", (XmlRecordSet("l", "O/L", (XmlColumn("n", "H/n"), XmlColumn("k", "O/k"), XmlColumn("q", "O/L/q"))),))
    df = load_xml_recordsets(spark, path, c, materialize=True)["l"]
    assert sorted(map(tuple, df.collect())) == [("1", "2", "3"), ("1", "2", "4")]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    kept = [line.split("Project", 1)[1] for line in plan.splitlines() if "Project" in line]
    # what travels beside an exploded element are values: H and O stay behind
    assert all("_at" not in k.split("_next")[0] or "H#" not in k for k in kept) and plan.count("Generate explode") == 2
    last = kept[0]
    assert "H#" not in last and "O#" not in last


def test_catalog_targets_take_a_run_in_once(spark, tmp):
    import dataclasses
    name = f"lk_runs_{os.getpid()}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id bigint, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, upd_by string) USING parquet")
    src = lambda s: s.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    spec = LoadSpec("L", name, src, "callable", ("id",), AUD, strategy="insert")
    for _ in range(2):
        run_load(spark, spec, "it's 1", T1)
        assert spark.table(name).count() == 2
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES ('loadkit.runs')")      # died before the run was noted
    run_load(spark, spec, "it's 1", T1)
    assert spark.table(name).count() == 2
    run_load(spark, spec, "run 2", dt.datetime(2024, 5, 5))
    assert spark.table(name).count() == 4
    seen = os.path.join(tmp, "seen")
    hooked = dataclasses.replace(spec, post_sql=f"INSERT OVERWRITE DIRECTORY '{seen}' USING parquet SELECT count(*) AS n FROM <<target>>; SELECT nothing")
    with pytest.raises(Exception, match="nothing"):
        run_load(spark, hooked, "run 3", dt.datetime(2024, 6, 6))
    fixed = dataclasses.replace(hooked, post_sql=hooked.post_sql.split(";")[0])
    run_load(spark, fixed, "run 3", dt.datetime(2024, 6, 6))                   # only the hook
    assert spark.table(name).count() == 6 and spark.read.parquet(seen).first()["n"] == 6
    spark.sql(f"DROP TABLE {name}")


def test_xml_feed_in_slices(spark, tmp):
    from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
    from loadkit.plans.runner import load_xml_feed, stage_files
    for i in range(5):
        _write(f"{tmp}/in/f__0{i}.xml", "<R>" + (f"<DOC><O><P>{i}</P></O></DOC>" if i != 3 else "<DOC><O></DOC>") + "</R>")
    ledger = SnapshotTable(spark, os.path.join(tmp, "ledger"))
    ledger.write(spark.createDataFrame([], LEDGER_SCHEMA), run_id="none")
    systems = spark.createDataFrame([("ERP", 1, tmp, "active")], "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    ents = spark.createDataFrame([("ERP", "X", 2, "in/f*.xml", "active")],
                                 "src_sys_key string, src_entity_key string, src_entity_id int, src_entity_pattern string, src_entity_status string")
    stage_files(spark, tmp, "ERP", systems, ents, ledger, T1)
    staging = {"o": SnapshotTable(spark, os.path.join(tmp, "o"))}
    contract = XmlContract("x", "DOC", (XmlRecordSet("o", "O", (XmlColumn("p", "O/P"),)),))
    res = load_xml_feed(spark, contract, ledger, staging, "X", "r", files_per_scan=2)
    assert res.status == "failed" and res.metrics == {"n_files": 5, "n_failed_files": 1, "rows_o": 4}
    assert sorted(r.p for r in staging["o"].read().collect()) == ["0", "1", "2", "4"]
    load_xml_feed(spark, contract, ledger, staging, "X", "r", files_per_scan=2)
    assert staging["o"].read().count() == 4
