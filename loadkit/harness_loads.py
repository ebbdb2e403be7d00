"""Registered queries over loads: partitioned targets, the event ledger, feeds, splittable
XML, listings, computed keys, rejects, removed rows, maintenance and streaming. Imported by
``loadkit.harness``, which holds the tables and change sets they build on."""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit import harness as H
from loadkit.contracts import LoadSpec
from loadkit.harness import AUDIT, RUN_TS, RUN_TS_SQL, SEED_AUDIT_SQL, register, table, upsert_sql, with_seed_audit
from loadkit.operators.upsert import ACTION_COL
from loadkit.session import drop_scratch, scratch_path

TARGET_ORDERS = "SELECT * FROM o WHERE (o_orderkey % 10 <> 0 OR o_orderkey % 70 = 0)"


# ---------------------------------------------------------------- partitioned targets
PARTITIONED_CTES = f"""
    o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM ({H.ORDERS_TYPED})),
    t0 AS (SELECT *, {SEED_AUDIT_SQL} FROM ({TARGET_ORDERS})),
    s0 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                  CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS DECIMAL(15,2)) AS o_totalprice,
                  CASE WHEN o_orderkey % 11 = 0 THEN CAST(o_orderdate + INTERVAL 40 DAY AS DATE) ELSE o_orderdate END AS o_orderdate, o_orderpriority
           FROM o WHERE month = (SELECT min(month) FROM o) AND o_orderkey % 7 <> 0),
    s AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM s0)"""


@register("upsert_partitions", f"""
WITH {PARTITIONED_CTES},
touched AS (SELECT month FROM s UNION SELECT month FROM t0 WHERE o_orderkey IN (SELECT o_orderkey FROM s))
SELECT u.* EXCLUDE ({ACTION_COL}), u.month NOT IN (SELECT month FROM touched) AS files_kept
FROM ({upsert_sql(PARTITIONED_CTES, "t0", "s", ["o_orderkey"], [*H.ORDERS_DATA, "month"])}) u""")
def q_upsert_partitions(spark, sf_dir):
    """Orders partitioned by month; the change set is one month, some of whose
    orders move to a later one. Rows of the target after `run_load`, and whether the files
    of their partition are the ones that were there before."""
    from loadkit.plans.partitioned import PartitionedTable
    from loadkit.plans.runner import run_load
    month = lambda: F.date_format("o_orderdate", "yyyy-MM")
    o, k = H.orders_typed(spark, sf_dir).withColumn("month", month()), F.col("o_orderkey")
    first = o.agg(F.min("month")).first()[0]
    src = (o.filter((F.col("month") == first) & (k % 7 != 0))
           .withColumn("o_totalprice", F.when(k % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).cast("decimal(15,2)"))
           .withColumn("o_orderdate", F.when(k % 11 == 0, F.date_add("o_orderdate", 40)).otherwise(F.col("o_orderdate")))
           .withColumn("month", month()))
    t = PartitionedTable(spark, scratch_path(spark, "orders_by_month"), ["month"])
    t.create(with_seed_audit(o.filter(H.in_target(k))))
    before = scratch_path(spark, "files_before")
    t.files().write.parquet(before)
    spec = LoadSpec(load_id="L1", target=t.root, source=lambda s: src, source_type="callable", keys=("o_orderkey",), audit=AUDIT, partition_by=("month",))
    run_load(spark, spec, "parts-1", RUN_TS)
    run_load(spark, spec, "parts-1", RUN_TS)      # committed already
    was, now = spark.read.parquet(before), t.files()
    both = was.select("path", F.lit(1).alias("w")).join(now.select("path", F.lit(1).alias("n")), "path", "full")
    changed = both.filter(F.col("w").isNull() | F.col("n").isNull()).select(F.regexp_extract("path", "/month=([^/]+)/", 1).alias("month")).distinct()
    return t.read().join(changed.withColumn("_c", F.lit(True)), "month", "left").withColumn("files_kept", F.col("_c").isNull()).drop("_c")


# ---------------------------------------------------------------- computed keys (JN6)
SUPPLIER_LANG_CTES = f"""
    p AS (SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(15,2)) AS s_acctbal FROM supplier),
    t AS (SELECT *, CASE s_suppkey % 3 WHEN 0 THEN 'NA' WHEN 1 THEN NULL ELSE 'EN' END AS lang, {SEED_AUDIT_SQL}
          FROM p WHERE (s_suppkey % 10 <> 0 OR s_suppkey % 70 = 0)),
    s AS (SELECT s_suppkey, s_name, s_nationkey,
                 CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS DECIMAL(15,2)) AS s_acctbal,
                 CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'NA' ELSE 'EN' END AS lang
          FROM p WHERE s_suppkey % 7 <> 0),
    tk AS (SELECT * EXCLUDE (lang), coalesce(lang, 'NA') AS k FROM t), sk AS (SELECT * EXCLUDE (lang), coalesce(lang, 'NA') AS k FROM s)"""


@register("run_load_key_expressions", f"""
WITH {SUPPLIER_LANG_CTES}
SELECT u.* EXCLUDE (k, {ACTION_COL}), CASE WHEN u.{ACTION_COL} = 'insert' THEN s.lang ELSE t.lang END AS lang
FROM ({upsert_sql(SUPPLIER_LANG_CTES, "tk", "sk", ["s_suppkey", "k"], H.SUPPLIER_DATA)}) u
LEFT JOIN t ON t.s_suppkey = u.s_suppkey AND coalesce(t.lang, 'NA') = u.k LEFT JOIN s ON s.s_suppkey = u.s_suppkey AND coalesce(s.lang, 'NA') = u.k""")
def q_run_load_key_expressions(spark, sf_dir):
    """JN6, K5: the key columns of an XML record set, one of them an expression: a NULL
    language meets 'NA' on either side; matched rows keep the target's key value."""
    from loadkit.contracts import XmlRecordSet
    from loadkit.plans.runner import run_load
    from loadkit.plans.snapshots import SnapshotTable
    k = F.col("s_suppkey")
    p = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.col("s_acctbal").cast("decimal(15,2)").alias("s_acctbal"))
    lang = lambda zero, one: F.when(k % 3 == 0, zero).when(k % 3 == 1, one).otherwise(F.lit("EN"))
    none = F.lit(None).cast("string")
    t = SnapshotTable(spark, scratch_path(spark, "supplier_texts"))
    t.write(with_seed_audit(p.filter(H.in_target(k)).withColumn("lang", lang(F.lit("NA"), none))), run_id="seed")
    src = (p.filter(k % 7 != 0).withColumn("s_acctbal", F.when(k % 5 == 0, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")).cast("decimal(15,2)"))
           .withColumn("lang", lang(none, F.lit("NA"))))
    rs = XmlRecordSet("texts", "TEXT", (), "supplier_texts", {"s_suppkey": "<<tname>>.s_suppkey", "lang": "nvl(<<tname>>.lang, 'NA')"})
    run_load(spark, LoadSpec.for_record_set(rs, t.root, lambda s: src, AUDIT, "L1"), "keys-1", RUN_TS)
    return t.read()


# ---------------------------------------------------------------- rejects
REJECT_SQL = """
    f AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS c,
                 CASE WHEN o_orderkey % 23 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS p,
                 CASE WHEN o_orderkey % 13 = 0 THEN '2023-02-30' WHEN o_orderkey % 19 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS d
          FROM orders),
    w AS (SELECT k, TRY_CAST(c AS BIGINT) AS c, TRY_CAST(p AS DECIMAL(15,2)) AS p, TRY_CAST(d AS DATE) AS d,
                 concat_ws(',', CASE WHEN TRY_CAST(c AS BIGINT) IS NULL THEN 'o_custkey' END, CASE WHEN TRY_CAST(p AS DECIMAL(15,2)) IS NULL THEN 'o_totalprice' END,
                           CASE WHEN d IS NOT NULL AND TRY_CAST(d AS DATE) IS NULL THEN 'o_orderdate' END) AS failed
          FROM f),
    t AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 2 = 0)"""


@register("run_load_rejects", f"""
WITH {REJECT_SQL}
SELECT 'row' AS what, k, c, p, d, CASE WHEN k IN (SELECT k FROM t) THEN 'seed' ELSE 'L1' END AS ins_by, NULL AS failed, NULL AS counter, CAST(NULL AS BIGINT) AS n
FROM w WHERE failed = ''
UNION ALL SELECT 'row', o_orderkey, NULL, NULL, NULL, 'seed', NULL, NULL, NULL FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey IN (SELECT k FROM w WHERE failed <> '')
UNION ALL SELECT 'reject', k, NULL, NULL, NULL, NULL, failed, NULL, NULL FROM w WHERE failed <> ''
UNION ALL SELECT 'counter', NULL, NULL, NULL, NULL, NULL, NULL, c.counter, c.n FROM (
  SELECT 'rows_offered' AS counter, count(*) AS n FROM w UNION ALL SELECT 'rows_rejected', count(*) FILTER (failed <> '') FROM w
  UNION ALL SELECT 'cells_rejected', sum(length(failed) - length(replace(failed, ',', '')) + CASE WHEN failed = '' THEN 0 ELSE 1 END) FROM w
  UNION ALL SELECT 'rows_read', count(*) FILTER (failed = '') FROM w
  UNION ALL SELECT 'n_insert', count(*) FILTER (failed = '' AND k NOT IN (SELECT k FROM t)) FROM w
  UNION ALL SELECT 'n_update', count(*) FILTER (failed = '' AND k IN (SELECT k FROM t)) FROM w) c""")
def q_run_load_rejects(spark, sf_dir):
    """Orders as text into a typed target (even keys are there, empty): rows
    of the target, rows of the reject table with the columns at fault, and the counters."""
    from loadkit.plans.runner import run_load
    from loadkit.plans.snapshots import SnapshotTable
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    cust = F.col("o_custkey").cast("string")
    text = o.select(k, F.when(k % 17 == 0, F.concat(F.lit("x"), cust)).otherwise(cust).alias("O_CUSTKEY"),
                    F.when(k % 23 == 0, "n/a").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")).alias("o_totalprice"),
                    F.when(k % 13 == 0, "2023-02-30").when(k % 19 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"))
    empty = o.filter(k % 2 == 0).select(k, F.lit(None).cast("bigint").alias("o_custkey"), F.lit(None).cast("decimal(15,2)").alias("o_totalprice"),
                                        F.lit(None).cast("date").alias("o_orderdate"))
    t, rejects = SnapshotTable(spark, scratch_path(spark, "typed_orders")), scratch_path(spark, "rejected_orders")
    t.write(with_seed_audit(empty), run_id="seed")
    m = run_load(spark, LoadSpec("L1", t.root, lambda s: text, "callable", ("o_orderkey",), AUDIT, rejects=rejects), "rejects-1", RUN_TS).metrics
    rows = t.read().select(F.lit("row").alias("what"), k.alias("k"), F.col("o_custkey").alias("c"), F.col("o_totalprice").alias("p"), F.col("o_orderdate").alias("d"), "ins_by")
    bad = SnapshotTable(spark, rejects).read().select(
        F.lit("reject").alias("what"), F.get_json_object("source_row", "$.o_orderkey").cast("bigint").alias("k"), F.array_join("failed_columns", ",").alias("failed"))
    names = ("rows_offered", "rows_rejected", "cells_rejected", "rows_read", "n_insert", "n_update")
    counts = spark.createDataFrame([("counter", n, int(m[n])) for n in names], "what string, counter string, n long")
    return rows.unionByName(bad, allowMissingColumns=True).unionByName(counts, allowMissingColumns=True)


# ---------------------------------------------------------------- rows removed with the commit
@register("run_load_removes_rows", f"""
WITH {H.ORDERS_CTE}, tt0 AS (SELECT *, {SEED_AUDIT_SQL} FROM t),
u AS ({upsert_sql(f"{H.ORDERS_CTE}, tt0 AS (SELECT *, {SEED_AUDIT_SQL} FROM t)", "tt0", "s", ["o_orderkey"], H.ORDERS_DATA)}),
k AS (SELECT * FROM u WHERE o_custkey % 9 <> 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 6 = 0)
      AND NOT (o_orderkey % 4 = 0 AND o_orderkey IN (SELECT s.o_orderkey FROM s JOIN t USING (o_orderkey) WHERE NOT {H._distinct(H.ORDERS_DATA)})))
SELECT k.* EXCLUDE ({ACTION_COL}), (SELECT count(*) FROM u) AS rows_total, (SELECT count(*) FROM k) AS rows_kept,
       (SELECT count(*) FROM u) - (SELECT count(*) FROM k) AS rows_removed FROM k""")
def q_run_load_removes_rows(spark, sf_dir):
    """Rows leave a snapshot target with the load's own commit: by keys (an anti join)
    and by a predicate, one part of which reads the classified source. Kept rows, counts."""
    from loadkit.plans.runner import run_load
    from loadkit.plans.snapshots import SnapshotTable
    tgt, src = H.orders_change_set(spark, sf_dir)
    t = SnapshotTable(spark, scratch_path(spark, "orders_removed"))
    t.write(with_seed_audit(tgt), run_id="seed")
    gone = table(spark, sf_dir, "orders").filter("o_orderkey % 6 = 0").select("o_orderkey")
    spec = LoadSpec("L1", t.root, lambda s: src, "callable", ("o_orderkey",), AUDIT, delete_keys=lambda s: gone,
                    delete_where="o_custkey % 9 = 0 OR (o_orderkey % 4 = 0 AND o_orderkey IN "
                                 "(SELECT o_orderkey FROM <<source>> WHERE record_status = 'unchanged'))")
    m = run_load(spark, spec, "removes-1", RUN_TS).metrics
    assert len(t.snapshots()) == 2      # one commit
    return t.read().select("*", *[F.lit(m[n]).cast("long").alias(n) for n in ("rows_total", "rows_kept", "rows_removed")])


# ---------------------------------------------------------------- event ledger
EVENT_STATES_SQL = f"""{H.LISTING_SQL},
    {H._staged_sql('led', 'disc', None, RUN_TS_SQL).strip()},
    st AS (SELECT *, src_entity_inst_no % 7 AS m,
                  CASE src_entity_inst_no % 7 WHEN 0 THEN 'skipped' WHEN 4 THEN 'failed' WHEN 5 THEN 'error' WHEN 6 THEN 'started' ELSE 'success' END AS status
           FROM led)"""


@register("ledger_events", f"""
WITH {EVENT_STATES_SQL}
SELECT 'state' AS what, src_entity_key, status, NULL AS met, count(*) AS n, CAST(sum(CASE WHEN m = 0 THEN 0 ELSE 1 END) AS BIGINT) AS attempts,
       CAST(sum(CASE WHEN m IN (1, 2, 3) THEN src_entity_size END) AS BIGINT) AS n_rows FROM st GROUP BY ALL
UNION ALL SELECT 'refused', src_entity_key, 'started', 'success', count(*), NULL, NULL FROM st WHERE m = 1 GROUP BY ALL
UNION ALL SELECT 'refused', src_entity_key, 'success', 'skipped', count(*), NULL, NULL FROM st WHERE m = 0 GROUP BY ALL
UNION ALL SELECT 'refused', src_entity_key, 'skipped', NULL, count(*), NULL, NULL FROM st WHERE m = 2 GROUP BY ALL
UNION ALL SELECT 'queue', src_entity_key, CASE WHEN m = 6 THEN 'failed' WHEN m = 5 THEN 'failed' ELSE status END, NULL, count(*), NULL, NULL
FROM st WHERE m IN (4, 5, 6) GROUP BY ALL""")
def q_ledger_events(spark, sf_dir):
    """Every listed file staged, then started and finished (or skipped) by
    appended events; events that a state does not allow, or of unknown files, are refused.
    States with attempts and row counts, refusals, and what waits in the queue; the state
    survives folding the events into the staged files."""
    from loadkit.operators.ledger import LEDGER_KEY, LEDGER_SCHEMA, discover_files, stage_new_files
    from loadkit.plans.event_ledger import EventLedger
    led = EventLedger(spark, scratch_path(spark, "event_ledger"))
    led.stage(stage_new_files(discover_files(*H.events_listing(spark, sf_dir)), spark.createDataFrame([], LEDGER_SCHEMA), RUN_TS))
    m = F.col("src_entity_inst_no") % 7

    def tell(which, status, minute, **over):
        rows = led.files.read().filter(which)
        led.record(rows.select(*[F.lit(over[k]).alias(k) if k in over else F.col(k) for k in LEDGER_KEY],
                               (F.lit(status) if isinstance(status, str) else status).alias("src_entity_load_status"), F.lit("told").alias("src_entity_load_mesg"),
                               F.lit("R1").alias("src_entity_load_run_id"), F.when(m.isin(1, 2, 3), F.col("src_entity_size")).alias("n_rows"))
                   if not over else rows.select("src_entity_inst_key", F.lit("NOWHERE").alias("src_sys_key"), "src_entity_key",
                                                F.lit(status).alias("src_entity_load_status"), F.lit("told").alias("src_entity_load_mesg"),
                                                F.lit("R1").alias("src_entity_load_run_id")), RUN_TS + dt.timedelta(minutes=minute))
    tell(m != 0, "started", 1)
    tell(m.isin(1, 2, 3, 4, 5), F.when(m == 4, "failed").when(m == 5, "error").otherwise("success"), 2)
    tell(m == 0, "skipped", 2)
    tell(m == 1, "started", 3)                                 # loaded already
    tell(m == 0, "success", 3)                                 # skipped already
    tell(m == 2, "skipped", 3, src_sys_key="NOWHERE")          # never staged
    life = led.lifecycle().groupBy("src_entity_key", F.col("src_entity_load_status").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_attempts").alias("attempts"), F.sum("src_entity_rec_count").alias("n_rows"))
    out = scratch_path(spark, "event_states")
    life.withColumn("what", F.lit("state")).write.parquet(out)
    bad = scratch_path(spark, "event_refused")
    (led.refused().groupBy("src_entity_key", F.col("event_status").alias("status"), "met").agg(F.count(F.lit(1)).alias("n"))
     .withColumn("what", F.lit("refused")).write.parquet(bad))
    led.fold()
    waits = led.queue().groupBy("src_entity_key", F.col("src_entity_load_status").alias("status")).agg(F.count(F.lit(1)).alias("n")).withColumn("what", F.lit("queue"))
    got = spark.read.parquet(out).unionByName(spark.read.parquet(bad), allowMissingColumns=True).unionByName(waits, allowMissingColumns=True)
    return got.select("what", "src_entity_key", "status", "met", "n", "attempts", "n_rows")


# ---------------------------------------------------------------- independent feeds
def _two_feeds(spark, sf_dir, root: str):
    """Orders with bad cells under a contract that rejects such files, customers without;
    staged in one event ledger."""
    from loadkit.plans.event_ledger import EventLedger
    H._hostile_lines(spark, sf_dir).select("value").write.text(f"{root}/orders")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").cast("string"), "c_mktsegment")
    c.write.option("sep", "|").csv(f"{root}/customer")
    ledger = EventLedger(spark, scratch_path(spark, "feeds_ledger"))
    H._land(spark, root, [("ORDERS", 12, "orders/part-*.txt"), ("CUSTOMER", 13, "customer/part-*.csv")], ledger, RUN_TS)
    kw = {"sep": "|", "quote": '"', "extract_type": "incremental", "load_type": "append", "load_all_incremental": True}
    orders = H._contract("orders_feed", [(f"_c{i}", n, t) for i, (n, t) in enumerate(H.HOSTILE_FEED)], date_format="yyyyMMdd", reject_bad_files=True, **kw)
    customer = H._contract("customer_feed", [(f"_c{i}", t, ty) for i, (_, t, ty) in enumerate(H.CUSTOMER_FEED)], **kw)
    return ledger, orders, customer


@register("feeds_independent", """
SELECT * FROM (VALUES ('stop', 'failed', 0, 1, 1, 'staged'), ('independent', 'failed', 1, 1, 0, 'success'), ('side by side', 'failed', 1, 1, 0, 'success'))
  AS v(mode, status, n_completed, n_failed, n_not_run, customer_state),
LATERAL (SELECT CASE WHEN mode = 'stop' THEN 0 ELSE count(*) END AS customer_rows FROM customer) AS c,
LATERAL (SELECT 0 AS orders_rows, 'failed' AS orders_state, count(*) > 0 AS told FROM orders) AS o""")
def q_feeds_independent(spark, sf_dir):
    """Two feeds of which the first fails: stopped there; independent; independent and
    side by side. Merged outcome, rows published, state of the files in the event ledger."""
    from loadkit.plans.runner import load_many, merged_outcome
    from loadkit.plans.snapshots import SnapshotTable
    out = None
    for mode, kw in (("stop", {}), ("independent", {"stop_at_failure": False}), ("side by side", {"stop_at_failure": False, "parallel": 2})):
        ledger, orders, customer = _two_feeds(spark, sf_dir, scratch_path(spark, "feeds"))
        raw = {n: SnapshotTable(spark, scratch_path(spark, f"raw_{n}")) for n in ("orders", "customer")}
        got = merged_outcome(load_many(spark, [(orders, raw["orders"], "ORDERS"), (customer, raw["customer"], "CUSTOMER")], ledger, "feeds", **kw), 2)
        rows = {n: r.read().count() if r.exists() else 0 for n, r in raw.items()}
        state = ledger.read().groupBy().pivot("src_entity_key", ["ORDERS", "CUSTOMER"]).agg(F.array_join(F.collect_set("src_entity_load_status"), ","))
        told = ledger.events().filter("event_status = 'failed' AND event_mesg LIKE 'rejected:%'").count() > 0
        one = state.select(F.lit(mode).alias("mode"), *[F.lit(v).alias(k) for k, v in got.items()], F.col("CUSTOMER").alias("customer_state"),
                           F.lit(rows["customer"]).cast("long").alias("customer_rows"), F.lit(rows["orders"]).alias("orders_rows"),
                           F.col("ORDERS").alias("orders_state"), F.lit(told).alias("told"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- splittable XML
PARTS, FILES_PER_PART = 8, 16   # parts of the documents that are on disk one after the other: at most, and files of each at least


@register("xml_header_detail_split", H.XML_LINES_SQL)
def q_xml_header_detail_split(spark, sf_dir):
    """The order documents as one file (large tables: files of about ``RECORDS_PER_FILE``
    records), cut at the closing tag that its contract declares. Text that is to be split stays
    uncompressed; large tables are rendered and loaded in up to ``PARTS`` parts, each of whose
    files go when its documents are loaded."""
    from loadkit.operators.conform import conform
    from loadkit.sources.xml import load_xml_recordsets
    contract = dataclasses.replace(H.order_xml_contract(), documents_end_with="</DOC>")
    n = min(PARTS, max(1, H.order_files(spark, sf_dir) // FILES_PER_PART))
    lines = []
    for i in range(n):
        path = H.render_order_documents(spark, sf_dir, scratch_path(spark, "orders_one_xml"), files=1, part=(i, n), indent="")
        lines.append(load_xml_recordsets(spark, path, contract, materialize=True)["lines"])
        drop_scratch(spark, path)
    return conform(functools.reduce(DataFrame.unionByName, lines), H._ddl_schema(H.XML_LINE_TYPES))


@register("load_xml_feed_hostile_split", H.ORACLES["load_xml_feed_hostile"])
def q_load_xml_feed_hostile_split(spark, sf_dir):
    """The hostile documents again, one a line and declared so."""
    return H.hostile_xml_feed(spark, sf_dir, "\n")


# ---------------------------------------------------------------- listing
@register("list_hidden_folders", """
SELECT CASE WHEN c_nationkey % 3 = 0 THEN '_hold/_n=' WHEN c_nationkey % 3 = 1 THEN '.late/n=' ELSE 'plain/n=' END || CAST(c_nationkey AS VARCHAR) AS folder,
       CAST(1 AS BIGINT) AS n_files, CAST(sum(length(c_name) + 1) AS BIGINT) AS n_bytes
FROM customer GROUP BY c_nationkey""")
def q_list_hidden_folders(spark, sf_dir):
    """Customer names in a folder per nation, a third of them below folders that hold
    hidden names only; files and bytes by folder, from a listing made in tasks."""
    from loadkit.sources.listing import list_files
    root, c = scratch_path(spark, "landing_hidden"), table(spark, sf_dir, "customer")
    for rest, (top, part) in enumerate((("_hold", "_n"), (".late", "n"), ("plain", "n"))):
        (c.filter(F.col("c_nationkey") % 3 == rest).select(F.col("c_name").alias("value"), F.col("c_nationkey").alias(part))
         .repartition(part).write.partitionBy(part).text(f"{root}/{top}"))
    found = list_files(spark, root).filter(F.col("path").contains("/part-"))
    folder = F.regexp_extract("path", "([^/]+/[^/]+)/[^/]+$", 1)
    return found.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))


# ---------------------------------------------------------------- maintenance flow
@register("maintenance_flow", """
SELECT o_orderpriority AS table_name, count(*) AS n_rows,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'maintain' WHEN '3-MEDIUM' THEN 'maintain' WHEN '4-NOT SPECIFIED' THEN 'maintain' ELSE 'skip' END AS action,
       CASE o_orderpriority WHEN '2-HIGH' THEN 'not due yet' WHEN '5-LOW' THEN 'conditions not met' END AS reason,
       o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED') AS fewer_files,
       CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED') THEN 'started,success' ELSE 'skipped' END AS events,
       o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED') AS rested FROM orders GROUP BY o_orderpriority""")
def q_maintenance_flow(spark, sf_dir):
    """A table per order priority: never maintained, maintained lately, long
    ago, tried lately without success, and one with few files. Decision, files and events;
    a second round finds those just maintained not due (``rested``)."""
    from loadkit.plans.maintenance import MaintenanceLog, MaintenancePolicy, maintain
    from loadkit.plans.snapshots import SnapshotTable
    o, tables = table(spark, sf_dir, "orders"), {}
    for name in [r[0] for r in o.select("o_orderpriority").distinct().collect()]:
        tables[name] = SnapshotTable(spark, scratch_path(spark, "maintained"))
        tables[name].write(o.filter(F.col("o_orderpriority") == name), run_id="seed", num_files=1 if name == "5-LOW" else 6)
    log = MaintenanceLog(spark, scratch_path(spark, "maintenance_log"))
    for name, status, days in (("2-HIGH", "success", 3), ("2-HIGH", "failed", 1), ("3-MEDIUM", "success", 30), ("4-NOT SPECIFIED", "failed", 1)):
        log.add(name, "before", status, RUN_TS - dt.timedelta(days=days))
    policy = MaintenancePolicy(max_files=4, min_mean_bytes=1 << 40, target_file_bytes=1 << 30)
    files = {n: t.file_stats().first()["n_files"] for n, t in tables.items()}
    done = maintain(spark, tables, log, policy, RUN_TS, "m-1")
    again = maintain(spark, tables, log, dataclasses.replace(policy, max_files=0), RUN_TS + dt.timedelta(days=1), "m-2")
    rows = [(n, t.read().count(), done[n]["action"], done[n]["reason"], t.file_stats().first()["n_files"] < files[n],
             done[n]["action"] == "maintain" and again[n]["reason"] == "not due yet") for n, t in tables.items()]
    seen = log.read().filter("run_id = 'm-1'").groupBy("table_name").agg(F.array_join(F.array_sort(F.collect_list("status")), ",").alias("events"))
    return spark.createDataFrame(rows, "table_name string, n_rows long, action string, reason string, fewer_files boolean, rested boolean").join(seen, "table_name")


# ---------------------------------------------------------------- streaming into the ledger
@register("stream_with_ledger", f"""
SELECT 'row' AS what, c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, CAST(c_acctbal AS DECIMAL(15,2)) AS balance,
       c_mktsegment AS segment, {RUN_TS_SQL} AS ins_ts, 'STREAM' AS ins_by, NULL AS how, CAST(NULL AS BIGINT) AS n_rows FROM customer
UNION ALL SELECT 'file', NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN c_custkey % 2 = 0 THEN 'batch' ELSE 'stream' END, count(*) FROM customer GROUP BY ALL
UNION ALL SELECT 'versions', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'target', 2""")
def q_stream_with_ledger(spark, sf_dir):
    """Customer as CSV files; a batch load takes those there first, a stream the
    rest, two a micro-batch, from the same ledger (a second stream from scratch finds
    nothing). One merge brings all raw rows to the target. Its rows, rows by who loaded
    them, and the target's versions (empty, merged)."""
    from pyspark.sql import types as T
    from loadkit.plans.event_ledger import EventLedger
    from loadkit.plans.runner import load_feed
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.streaming.ledger_ingest import FILE_COLS, FILE_SIZE, FILE_TIME, ingest_with_ledger, ledger_sink, merge_new_rows
    root = scratch_path(spark, "shared_landing")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").cast("string"), "c_mktsegment")
    kw = {"sep": ",", "quote": '"', "file_pattern": "part-*", "extract_type": "incremental", "load_type": "append", "load_all_incremental": True}
    contract = H._contract("shared_feed", [(f"_c{i}", t, ty) for i, (_, t, ty) in enumerate(H.CUSTOMER_FEED)], **kw)
    ledger, raw = EventLedger(spark, scratch_path(spark, "shared_ledger")), SnapshotTable(spark, scratch_path(spark, "shared_raw"))
    tagged = T.StructType(contract.target_schema().fields + [T.StructField(FILE_COLS[0], T.StringType()), T.StructField(FILE_TIME, T.TimestampNTZType()),
                                                             T.StructField(FILE_SIZE, T.LongType())])
    c.filter("c_custkey % 2 = 0").repartition(4).write.csv(f"{root}/in")
    H._land(spark, root, [("CUSTOMER", 12, "in/part-*.csv")], ledger, RUN_TS)
    load_feed(spark, contract, ledger, raw, "CUSTOMER", "batch-1")
    c.filter("c_custkey % 2 = 1").repartition(4).write.mode("append").csv(f"{root}/in")
    sink = ledger_sink(ledger, raw, ("ERP", 3), ("CUSTOMER", 12), "STREAM", RUN_TS)
    ingest_with_ledger(spark, f"{root}/in", contract, sink, scratch_path(spark, "shared_ckpt"), 2)
    again = ledger_sink(ledger, raw, ("ERP", 3), ("CUSTOMER", 12), "AGAIN", RUN_TS)
    ingest_with_ledger(spark, f"{root}/in", contract, again, scratch_path(spark, "shared_ckpt"), 3)
    target = SnapshotTable(spark, scratch_path(spark, "shared_target"))
    target.write(with_seed_audit(spark.createDataFrame([], contract.target_schema())), run_id="seed")
    held = spark.read.schema(tagged).parquet(*[s.path for s in raw.snapshots()])     # batch rows carry no file columns
    merge_new_rows(spark, raw, LoadSpec("STREAM", target.root, "", "callable", ("customer_id",), AUDIT), RUN_TS)
    merge_new_rows(spark, raw, LoadSpec("STREAM", target.root, "", "callable", ("customer_id",), AUDIT), RUN_TS)
    rows = target.read().withColumn("what", F.lit("row")).drop("upd_ts", "upd_by")
    files = held.groupBy(F.when(F.col(FILE_TIME).isNull(), "batch").otherwise("stream").alias("how")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("what", F.lit("file"))
    versions = spark.range(1).select(F.lit("versions").alias("what"), F.lit("target").alias("how"), F.lit(len(target.snapshots())).cast("long").alias("n_rows"))
    return rows.unionByName(files, allowMissingColumns=True).unionByName(versions, allowMissingColumns=True)


# ---------------------------------------------------------------- full refresh, queue order, definitions, messages
@register("feed_full_refresh", """
SELECT 'row' AS what, c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, CAST(c_acctbal AS DECIMAL(15,2)) AS balance,
       c_mktsegment AS segment, NULL AS folder, NULL AS status, CAST(NULL AS BIGINT) AS n FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'file', NULL, NULL, NULL, NULL, NULL, f, s, 1 FROM (VALUES ('old', 'skipped'), ('mid', 'success'), ('new', 'success')) v(f, s)
UNION ALL SELECT 'versions', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 2""")
def q_feed_full_refresh(spark, sf_dir):
    """Full extracts of customer: of two waiting files the newest is loaded and
    the older skipped; a later file replaces the raw table in one commit."""
    from loadkit.plans.event_ledger import EventLedger
    from loadkit.plans.runner import load_feed
    from loadkit.plans.snapshots import SnapshotTable
    root = scratch_path(spark, "full_landing")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").cast("string"), "c_mktsegment")
    ledger, raw = EventLedger(spark, scratch_path(spark, "full_ledger")), SnapshotTable(spark, scratch_path(spark, "full_raw"))
    contract = H._contract("full_feed", [(f"_c{i}", t, ty) for i, (_, t, ty) in enumerate(H.CUSTOMER_FEED)], sep="|", quote='"')

    def land(folder, which):
        c.filter(which).coalesce(1).write.option("sep", "|").csv(f"{root}/{folder}")
        H._land(spark, root, [("CUSTOMER", 12, "*/part-*.csv")], ledger, RUN_TS)
    land("old", "c_custkey % 3 = 0")
    land("mid", "c_custkey % 3 = 1")
    load_feed(spark, contract, ledger, raw, "CUSTOMER", "full-1")
    land("new", "c_custkey % 3 <> 0")
    load_feed(spark, contract, ledger, raw, "CUSTOMER", "full-2")
    files = ledger.read().select(F.lit("file").alias("what"), F.regexp_extract("src_entity_path", "([^/]+)/[^/]+$", 1).alias("folder"),
                                 F.col("src_entity_load_status").alias("status"), F.lit(1).cast("long").alias("n"))
    versions = spark.range(1).select(F.lit("versions").alias("what"), F.lit(len(raw.snapshots())).cast("long").alias("n"))
    return raw.read().withColumn("what", F.lit("row")).unionByName(files, allowMissingColumns=True).unionByName(versions, allowMissingColumns=True)


@register("queue_order", f"""WITH {H.LEDGER_CTES},
q AS (SELECT l.*, e.src_entity_extract_type AS kind FROM ledger l JOIN entities e USING (src_sys_key, src_entity_key) WHERE src_entity_load_status IN ('staged', 'failed'))
SELECT src_entity_key, src_entity_name, kind, CAST(row_number() OVER (PARTITION BY src_entity_key ORDER BY
         CASE WHEN kind = 'incremental' THEN epoch_us(src_entity_timestamp) ELSE -epoch_us(src_entity_timestamp) END,
         CASE WHEN kind = 'incremental' THEN src_entity_name END, src_entity_name DESC) AS BIGINT) AS place
FROM q""")
def q_queue_order(spark, sf_dir):
    """Waiting files in load order, oldest first for incremental entities and
    newest first for full extracts; the place of each within its entity."""
    from loadkit.functions.numbering import number_within
    from loadkit.operators.ledger import queue_order
    listing, rules = H.events_listing(spark, sf_dir)
    ledger = H.ledger_frame(spark, sf_dir).join(rules.select("src_entity_key", F.col("src_entity_extract_type").alias("kind")), "src_entity_key")
    waits, out = ledger.filter(F.col("src_entity_load_status").isin("staged", "failed")), None
    for kind in ("incremental", "full"):
        # the sorted frame's own order is what is numbered
        placed = queue_order(waits.filter(F.col("kind") == kind), kind).withColumn("_at", F.monotonically_increasing_id())
        one = number_within(placed, ["src_entity_key"], ["_at"], out="place").select("src_entity_key", "src_entity_name", "kind", "place")
        out = one if out is None else out.unionByName(one)
    return out


@register("definition_checks", """
WITH d AS (SELECT event_type AS src_sys_key, user_id % 3 AS v FROM events WHERE event_type <> 'view' OR user_id % 3 = 0),
k AS (SELECT DISTINCT event_type AS src_sys_key FROM events UNION ALL SELECT 'missing')
SELECT k.src_sys_key, count(DISTINCT d.v) AS n, count(DISTINCT d.v) = 1 AS ok FROM k LEFT JOIN d USING (src_sys_key) GROUP BY k.src_sys_key""")
def q_definition_checks(spark, sf_dir):
    """Every system key that events name must have one definition row; which do."""
    from loadkit.contracts import ContractError
    from loadkit.operators.ledger import assert_single_system, system_definitions
    e = table(spark, sf_dir, "events")
    defs = e.filter("event_type <> 'view' OR user_id % 3 = 0").select(F.col("event_type").alias("src_sys_key"), (F.col("user_id") % 3).alias("v")).distinct()
    keys = e.select(F.col("event_type").alias("src_sys_key")).distinct().unionByName(spark.createDataFrame([("missing",)], "src_sys_key string"))
    found = system_definitions(defs, keys)
    assert_single_system(defs, "view")
    try:
        assert_single_system(defs, "missing")
    except ContractError:
        return found
    raise AssertionError("a missing system passed")


@register("run_load_counts", f"""
WITH {H.CUSTOMER_CTE}, u AS ({upsert_sql(H.CUSTOMER_CTE, "t", "s", ["c_custkey"], H.CUSTOMER_DATA, flag=True)})
SELECT m.*, k.* FROM (SELECT count(*) AS rows_total, count(*) FILTER ({ACTION_COL} = 'insert') AS n_insert, count(*) FILTER ({ACTION_COL} = 'update') AS n_update,
       count(*) FILTER ({ACTION_COL} = 'delete') AS n_delete, count(*) FILTER ({ACTION_COL} = 'restore') AS n_restore FROM u) m,
     (VALUES ('good', 1, 'info'), ('good', 2, 'info'), ('bad', 1, 'info'), ('bad', 2, 'error')) k(run_id, message_seq, message_type)""")
def q_run_load_counts(spark, sf_dir):
    """Counts of a load with soft deletes (gathered during its write), and the
    messages of that run and of one that fails."""
    from loadkit.contracts import ContractError
    from loadkit.operators.audit import parquet_append_sink
    from loadkit.plans.runner import run_load
    from loadkit.plans.snapshots import SnapshotTable
    tgt, src = H.customer_change_set(spark, sf_dir)
    t, notes = SnapshotTable(spark, scratch_path(spark, "customer_counts")), scratch_path(spark, "messages")
    t.write(tgt, run_id="seed")
    spec = LoadSpec("L1", t.root, lambda s: src, "callable", ("c_custkey",), AUDIT, delete_flag_col="del_flag", detect_deletes=True)
    m = run_load(spark, spec, "good", RUN_TS, message_sink=parquet_append_sink(notes)).metrics
    try:
        run_load(spark, dataclasses.replace(spec, keys=()), "bad", RUN_TS, message_sink=parquet_append_sink(notes))
    except ContractError:
        pass
    told = spark.read.parquet(notes).select("run_id", F.col("message_seq").cast("int").alias("message_seq"), "message_type")
    return told.select(*[F.lit(m[n]).cast("long").alias(n) for n in ("rows_total", "n_insert", "n_update", "n_delete", "n_restore")], "*")


@register("xml_empty_records", """
SELECT CAST(o_orderkey AS VARCHAR) AS k, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS p, CAST(o_custkey AS VARCHAR) AS c
FROM orders WHERE o_orderkey % 4 <> 0""")
def q_xml_empty_records(spark, sf_dir):
    """Order documents some of whose records hold nothing (dropped) or only some of
    their columns (kept)."""
    from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
    from loadkit.sources.xml import load_xml_recordsets
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    prio = F.when(k % 5 == 0, "<P/>").otherwise(F.concat(F.lit("<P>"), "o_orderpriority", F.lit("</P>")))
    full = F.concat(F.lit("<O><K>"), k.cast("string"), F.lit("</K>"), prio, F.lit("<C>"), F.col("o_custkey").cast("string"), F.lit("</C></O>"))
    doc = F.concat(F.lit("<DOC>"), F.when(k % 4 == 0, F.when(k % 8 == 0, "<O/>").otherwise("<O><K></K><P/></O>")).otherwise(full), F.lit("</DOC>"))
    root = scratch_path(spark, "empty_records")
    o.select(doc.alias("value")).write.text(root)
    sets = (XmlRecordSet("o", "O", (XmlColumn("k", "O/K"), XmlColumn("p", "O/P"), XmlColumn("c", "O/C"))),)
    rows = load_xml_recordsets(spark, root, XmlContract("empty", "DOC", sets, documents_end_with="\n"))["o"]
    return rows.select("k", F.nullif("p", F.lit("")).alias("p"), "c")
