"""Registered queries over the driver's test tables, each with its DuckDB oracle.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from them)
and exercises one operator family. Change sets follow one rule so both engines
build them identically: target ``T`` holds keys with ``k % 10 <> 0`` or
``k % 70 = 0``, source ``S`` keys with ``k % 7 <> 0`` (so that every row of the table
is in one of them or both), and some data columns of ``S`` are altered by key
arithmetic. That shapes inserts / updates / deletes; it is not a sample: every
row of the table goes through the operator.

Doubles are cast to ``decimal(15,2)`` and timestamps to dates or NTZ values so
the two engines produce identical values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.contracts import AuditColumns
from loadkit.functions.exprs import ntz_literal
from loadkit.operators.changes import classify_changes, load_totals, status_counts
from loadkit.operators.conform import conform
from loadkit.operators.upsert import ACTION_COL, upsert_frame

RUN_TS = dt.datetime(2024, 6, 30, 12, 0, 0)
SEED_TS = dt.datetime(2024, 1, 1, 0, 0, 0)
RUN_TS_SQL = "TIMESTAMP '2024-06-30 12:00:00'"
SEED_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"
AUDIT = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def in_target(key):
    return (key % 10 != 0) | (key % 70 == 0)


def with_seed_audit(df: DataFrame) -> DataFrame:
    return (df.withColumn("ins_ts", ntz_literal(SEED_TS))
              .withColumn("ins_by", F.lit("seed"))
              .withColumn("upd_ts", F.lit(None).cast("timestamp_ntz"))
              .withColumn("upd_by", F.lit(None).cast("string")))


SEED_AUDIT_SQL = (f"{SEED_TS_SQL} AS ins_ts, 'seed' AS ins_by, CAST(NULL AS TIMESTAMP) AS upd_ts, "
                  "CAST(NULL AS VARCHAR) AS upd_by")

# ---------------------------------------------------------------- orders change set
ORDERS_TYPED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"""
ORDERS_DATA = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_typed(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
                    F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")


def orders_change_set(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    o = orders_typed(spark, sf_dir)
    k = F.col("o_orderkey")
    tgt = o.filter(in_target(k))
    src = (o.filter(k % 7 != 0)
            .withColumn("o_totalprice", F.when(k % 5 == 0, F.col("o_totalprice") + 1)
                        .otherwise(F.col("o_totalprice")).cast("decimal(15,2)"))
            .withColumn("o_orderpriority", F.when(k % 11 == 0, F.lit(None).cast("string"))
                        .otherwise(F.col("o_orderpriority"))))
    return tgt, src


ORDERS_CTE = f"""
    o AS ({ORDERS_TYPED}),
    t AS (SELECT * FROM o WHERE (o_orderkey % 10 <> 0 OR o_orderkey % 70 = 0)),
    s AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                 CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
                      AS DECIMAL(15,2)) AS o_totalprice,
                 o_orderdate,
                 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
          FROM o WHERE o_orderkey % 7 <> 0)"""


def _distinct(cols, a="s", b="t") -> str:
    return "(" + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in cols) + ")"


CLASSIFY_SQL = f"""
WITH {ORDERS_CTE}
SELECT s.*, CASE WHEN t.o_orderkey IS NULL THEN 'new'
                 WHEN {_distinct(ORDERS_DATA)} THEN 'changed'
                 ELSE 'unchanged' END AS record_status
FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey"""


@register("classify_changes", CLASSIFY_SQL)
def q_classify_changes(spark, sf_dir):
    tgt, src = orders_change_set(spark, sf_dir)
    return classify_changes(src, tgt, ["o_orderkey"])


@register("change_status_counts", f"""
WITH c AS ({CLASSIFY_SQL})
SELECT record_status, CAST(count(*) AS BIGINT) AS n_rows FROM c GROUP BY record_status""")
def q_change_status_counts(spark, sf_dir):
    tgt, src = orders_change_set(spark, sf_dir)
    return status_counts(classify_changes(src, tgt, ["o_orderkey"]))


@register("load_totals", f"""
WITH c AS ({CLASSIFY_SQL})
SELECT CAST(sum(CASE WHEN record_status = 'new' THEN 1 ELSE 0 END) AS BIGINT) AS n_new,
       CAST(sum(CASE WHEN record_status = 'changed' THEN 1 ELSE 0 END) AS BIGINT) AS n_changed,
       CAST(sum(CASE WHEN record_status = 'unchanged' THEN 1 ELSE 0 END) AS BIGINT) AS n_unchanged,
       CAST(0 AS BIGINT) AS n_null_key,
       CAST(sum(CASE WHEN record_status IN ('new', 'changed') THEN 1 ELSE 0 END) AS BIGINT) AS n_incremental,
       CAST(count(*) AS BIGINT) AS n_total
FROM c""")
def q_load_totals(spark, sf_dir):
    tgt, src = orders_change_set(spark, sf_dir)
    return load_totals(classify_changes(src, tgt, ["o_orderkey"]))


def upsert_sql(ctes: str, tgt: str, src: str, keys: list[str], data: list[str], flag: bool = False,
               restore: bool = True, load_id: str = "L1") -> str:
    """Oracle for the full-outer upsert rewrite of ``upsert_frame``.

    ``tgt`` holds keys, data, ins_ts, ins_by, upd_ts, upd_by (and del_flag when
    ``flag``); ``src`` holds keys and data. Source rows with NULL keys are excluded.
    """
    on = " AND ".join(f"tt.{k} = ss.{k}" for k in keys)
    tcols = [*keys, *data, "ins_ts", "ins_by", "upd_ts", "upd_by", *(["del_flag"] if flag else [])]
    changed = " OR ".join(f"s_{c} IS DISTINCT FROM t_{c}" for c in data) or "false"
    was_del = "coalesce(t_del_flag = 'Y', false)" if flag else "false"
    rs, fl = str(restore).lower(), str(flag).lower()
    out = [f"coalesce(t_{k}, s_{k}) AS {k}" for k in keys]
    out += [f"CASE WHEN act IN ('insert', 'update') THEN s_{c} ELSE t_{c} END AS {c}" for c in data]
    out += [f"CASE WHEN act = 'insert' THEN {RUN_TS_SQL} ELSE t_ins_ts END AS ins_ts",
            f"CASE WHEN act = 'insert' THEN '{load_id}' ELSE t_ins_by END AS ins_by",
            f"CASE WHEN act = 'insert' THEN NULL WHEN act IN ('update', 'delete', 'restore') "
            f"THEN {RUN_TS_SQL} ELSE t_upd_ts END AS upd_ts",
            f"CASE WHEN act = 'insert' THEN NULL WHEN act IN ('update', 'delete', 'restore') "
            f"THEN '{load_id}' ELSE t_upd_by END AS upd_by"]
    if flag:
        out.append(f"CASE WHEN act = 'insert' THEN 'N' WHEN act = 'delete' THEN 'Y' "
                   f"WHEN {rs} AND {was_del} AND in_s THEN 'N' ELSE t_del_flag END AS del_flag")
    out.append(f"act AS {ACTION_COL}")
    return f"""
WITH {ctes},
j AS (
  SELECT tt._in_t IS NOT NULL AS in_t, ss._in_s IS NOT NULL AS in_s,
         {', '.join(f'tt.{c} AS t_{c}' for c in tcols)},
         {', '.join(f'ss.{c} AS s_{c}' for c in [*keys, *data])}
  FROM (SELECT *, true AS _in_t FROM {tgt}) tt
  FULL OUTER JOIN (SELECT *, true AS _in_s FROM {src}
                   WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)}) ss ON {on}),
a AS (
  SELECT *, CASE WHEN in_s AND NOT in_t THEN 'insert'
                 WHEN in_s AND in_t AND ({changed}) THEN 'update'
                 WHEN in_s AND in_t AND {was_del} AND {rs} THEN 'restore'
                 WHEN NOT in_s AND in_t AND {fl} AND NOT {was_del} THEN 'delete'
                 ELSE 'keep' END AS act
  FROM j)
SELECT {', '.join(out)}
FROM a"""


UPSERT_ORDERS_SQL = upsert_sql(f"{ORDERS_CTE}, tt0 AS (SELECT *, {SEED_AUDIT_SQL} FROM t)",
                               "tt0", "s", ["o_orderkey"], ORDERS_DATA)


@register("upsert_snapshot", UPSERT_ORDERS_SQL)
def q_upsert_snapshot(spark, sf_dir):
    tgt, src = orders_change_set(spark, sf_dir)
    return upsert_frame(with_seed_audit(tgt), src, ["o_orderkey"], AUDIT, "L1", RUN_TS)


@register("mapping_projection", """
SELECT c_custkey AS customer_id, c_name AS customer_name, CAST(c_nationkey AS BIGINT) AS nation_id,
       CAST(c_acctbal AS DECIMAL(15,2)) AS balance, c_mktsegment AS segment
FROM customer""")
def q_mapping_projection(spark, sf_dir):
    from pyspark.sql import types as T
    c = table(spark, sf_dir, "customer")
    renamed = c.select(F.col("c_custkey").alias("CUSTOMER_ID"), F.col("c_name").alias("Customer_Name"),
                       F.col("c_nationkey").alias("nation_id"), F.col("c_acctbal").alias("BALANCE"),
                       F.col("c_mktsegment").alias("segment"))
    target = T.StructType([
        T.StructField("customer_id", T.LongType()), T.StructField("customer_name", T.StringType()),
        T.StructField("nation_id", T.LongType()), T.StructField("balance", T.DecimalType(15, 2)),
        T.StructField("segment", T.StringType())])
    return conform(renamed, target)


# ---------------------------------------------------------------- customer: soft delete
CUSTOMER_TYPED = """
    SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal, c_mktsegment
    FROM customer"""
CUSTOMER_DATA = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customer_change_set(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").alias("c_acctbal"),
        "c_mktsegment")
    k = F.col("c_custkey")
    tgt = with_seed_audit(c.filter(in_target(k))).withColumn(
        "del_flag", F.when(k % 13 == 0, F.lit("Y")).otherwise(F.lit("N")))
    src = c.filter(k % 7 != 0).withColumn(
        "c_acctbal", F.when(k % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).cast("decimal(15,2)"))
    return tgt, src


CUSTOMER_CTE = f"""
    c AS ({CUSTOMER_TYPED}),
    t AS (SELECT *, {SEED_AUDIT_SQL}, CASE WHEN c_custkey % 13 = 0 THEN 'Y' ELSE 'N' END AS del_flag
          FROM c WHERE (c_custkey % 10 <> 0 OR c_custkey % 70 = 0)),
    s AS (SELECT c_custkey, c_name, c_nationkey,
                 CAST(CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS DECIMAL(15,2)) AS c_acctbal,
                 c_mktsegment
          FROM c WHERE c_custkey % 7 <> 0)"""


@register("upsert_soft_delete", upsert_sql(CUSTOMER_CTE, "t", "s", ["c_custkey"], CUSTOMER_DATA, flag=True))
def q_upsert_soft_delete(spark, sf_dir):
    tgt, src = customer_change_set(spark, sf_dir)
    return upsert_frame(tgt, src, ["c_custkey"], AUDIT, "L1", RUN_TS, delete_flag_col="del_flag",
                        detect_deletes=True)


# ---------------------------------------------------------------- supplier: key returns after delete
SUPPLIER_DATA = ["s_name", "s_nationkey", "s_acctbal"]
SUPPLIER_CTE = f"""
    p AS (SELECT s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(15,2)) AS s_acctbal FROM supplier),
    t AS (SELECT *, {SEED_AUDIT_SQL}, CASE WHEN s_suppkey % 3 = 0 THEN 'Y' ELSE 'N' END AS del_flag
          FROM p WHERE (s_suppkey % 10 <> 0 OR s_suppkey % 70 = 0)),
    s AS (SELECT s_suppkey, s_name, s_nationkey,
                 CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS DECIMAL(15,2)) AS s_acctbal
          FROM p WHERE s_suppkey % 7 <> 0)"""


def _reappear_sql() -> str:
    parts = []
    for mode, restore in (("restore", True), ("keep", False)):
        parts.append(f"SELECT *, '{mode}' AS on_reappear FROM ("
                     + upsert_sql(SUPPLIER_CTE, "t", "s", ["s_suppkey"], SUPPLIER_DATA, flag=True,
                                  restore=restore) + ") x")
    return "\nUNION ALL\n".join(parts)


@register("upsert_reappear", _reappear_sql())
def q_upsert_reappear(spark, sf_dir):
    s0 = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", F.col("s_acctbal").cast("decimal(15,2)").alias("s_acctbal"))
    k = F.col("s_suppkey")
    tgt = with_seed_audit(s0.filter(in_target(k))).withColumn(
        "del_flag", F.when(k % 3 == 0, F.lit("Y")).otherwise(F.lit("N")))
    src = s0.filter(k % 7 != 0).withColumn(
        "s_acctbal", F.when(k % 5 == 0, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")).cast("decimal(15,2)"))
    out = None
    for mode in ("restore", "keep"):
        r = upsert_frame(tgt, src, ["s_suppkey"], AUDIT, "L1", RUN_TS, delete_flag_col="del_flag",
                         detect_deletes=True, on_reappear=mode).withColumn("on_reappear", F.lit(mode))
        out = r if out is None else out.unionByName(r)
    return out


# ---------------------------------------------------------------- lineitem: composite + expression key
LINEITEM_DATA = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_TYPED = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice,
           CAST(l_discount AS DECIMAL(15,2)) AS l_discount, CAST(l_tax AS DECIMAL(15,2)) AS l_tax,
           l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
    FROM lineitem"""


def lineitem_typed(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    dec = lambda c: F.col(c).cast("decimal(15,2)").alias(c)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dec("l_quantity"),
                     dec("l_extendedprice"), dec("l_discount"), dec("l_tax"), "l_returnflag", "l_linestatus",
                     F.col("l_shipdate").cast("date").alias("l_shipdate"))


LINEITEM_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
LINEITEM_VALUES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINEITEM_CTE = f"""
    li AS ({LINEITEM_TYPED}),
    t AS (SELECT *, {SEED_AUDIT_SQL} FROM li WHERE ((l_orderkey * 8 + l_linenumber) % 10 <> 0 OR (l_orderkey * 8 + l_linenumber) % 70 = 0)),
    s0 AS (SELECT l_orderkey, l_linenumber, l_partkey,
                  CASE WHEN (l_orderkey * 8 + l_linenumber) % 97 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey,
                  l_shipdate,
                  CAST(CASE WHEN (l_orderkey * 8 + l_linenumber) % 5 = 0 THEN l_quantity + 1 ELSE l_quantity END
                       AS DECIMAL(15,2)) AS l_quantity,
                  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
           FROM li WHERE (l_orderkey * 8 + l_linenumber) % 7 <> 0),
    s AS (SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_suppkey, -1) AS l_suppkey, l_shipdate,
                 {', '.join(LINEITEM_VALUES)}
          FROM s0)"""


@register("upsert_composite_key", upsert_sql(LINEITEM_CTE, "t", "s", LINEITEM_KEYS, LINEITEM_VALUES))
def q_upsert_composite_key(spark, sf_dir):
    from loadkit.operators.upsert import with_key_expressions
    li = lineitem_typed(spark, sf_dir)
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    tgt = with_seed_audit(li.filter(in_target(k)))
    src = (li.filter(k % 7 != 0)
             .withColumn("l_quantity", F.when(k % 5 == 0, F.col("l_quantity") + 1)
                         .otherwise(F.col("l_quantity")).cast("decimal(15,2)"))
             .withColumn("l_suppkey", F.when(k % 97 == 0, F.lit(None).cast("long"))
                         .otherwise(F.col("l_suppkey"))))
    src = with_key_expressions(src, {"l_suppkey": "coalesce(<<tname>>.l_suppkey, -1)"})
    return upsert_frame(tgt, src, LINEITEM_KEYS, AUDIT, "L1", RUN_TS)


# ---------------------------------------------------------------- query source
ORDER_REVENUE_TEMPLATE = """
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
           CAST(count(*) AS BIGINT) AS n_lines,
           CAST(sum(CAST(l.l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS gross,
           CAST(max(CAST(l.l_shipdate AS DATE)) AS DATE) AS last_ship
    FROM {orders} o JOIN {lineitem} l ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_orderkey, o.o_custkey"""
ORDER_REVENUE_SQL = ORDER_REVENUE_TEMPLATE.format(orders="orders", lineitem="lineitem")
REVENUE_DATA = ["customer_id", "n_lines", "gross", "last_ship"]


@register("upsert_query_source", upsert_sql(
    f"""q AS ({ORDER_REVENUE_SQL}),
    t AS (SELECT order_id, customer_id,
                 CASE WHEN order_id % 5 = 0 THEN n_lines + 1 ELSE n_lines END AS n_lines, gross, last_ship,
                 {SEED_AUDIT_SQL} FROM q WHERE (order_id % 10 <> 0 OR order_id % 70 = 0))""",
    "t", "q", ["order_id"], REVENUE_DATA))
def q_upsert_query_source(spark, sf_dir):
    from loadkit.sources.tables import read_source
    views = {name: f"loadkit_{name}" for name in ("orders", "lineitem")}
    for name, view in views.items():
        table(spark, sf_dir, name).createOrReplaceTempView(view)
    src = read_source(spark, ORDER_REVENUE_TEMPLATE.format(**views), "query")
    k = F.col("order_id")
    tgt = with_seed_audit(src.filter(in_target(k)).withColumn(
        "n_lines", F.when(k % 5 == 0, F.col("n_lines") + 1).otherwise(F.col("n_lines"))))
    return upsert_frame(tgt, src, ["order_id"], AUDIT, "L1", RUN_TS)


# ---------------------------------------------------------------- append with audit
PART_TYPED = """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(15,2)) AS p_retailprice
    FROM part"""


@register("append_with_audit", f"""
WITH p AS ({PART_TYPED})
SELECT *, {SEED_AUDIT_SQL} FROM p WHERE p_partkey % 10 <> 0
UNION ALL
SELECT *, {RUN_TS_SQL} AS ins_ts, 'L1' AS ins_by, CAST(NULL AS TIMESTAMP) AS upd_ts, CAST(NULL AS VARCHAR) AS upd_by
FROM p""")
def q_append_with_audit(spark, sf_dir):
    from loadkit.operators.upsert import append_rows
    p = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size",
        F.col("p_retailprice").cast("decimal(15,2)").alias("p_retailprice"))
    tgt = with_seed_audit(p.filter(F.col("p_partkey") % 10 != 0))
    # source columns in another order and case: resolved by name
    src = p.select(F.col("p_retailprice").alias("P_RETAILPRICE"), "p_size", "p_type", "p_brand", "p_name",
                   "p_partkey")
    return tgt.unionByName(append_rows(tgt.schema, src, AUDIT, "L1", RUN_TS))


# ---------------------------------------------------------------- key checks
@register("null_and_duplicate_keys", """
WITH e AS (SELECT CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS user_id, event_type FROM events)
SELECT 'null_key' AS violation, user_id, event_type, CAST(count(*) AS BIGINT) AS n_rows
FROM e WHERE user_id IS NULL OR event_type IS NULL GROUP BY user_id, event_type
UNION ALL
SELECT 'duplicate_key' AS violation, user_id, event_type, CAST(count(*) AS BIGINT) AS n_rows
FROM e WHERE user_id IS NOT NULL AND event_type IS NOT NULL GROUP BY user_id, event_type HAVING count(*) > 1""")
def q_null_and_duplicate_keys(spark, sf_dir):
    from loadkit.operators.upsert import key_violations
    e = table(spark, sf_dir, "events")
    e = e.select(F.when(F.col("event_id") % 50 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
                 "event_type")
    return key_violations(e, ["user_id", "event_type"])


# ---------------------------------------------------------------- legacy hash collisions
def _collision_frames(p: DataFrame) -> tuple[DataFrame, DataFrame]:
    k, v = F.col("p_partkey"), F.col("p_partkey") % 3
    size = F.col("p_size").cast("string")
    dash = lambda *cs: F.concat_ws("-", *cs)
    nul = F.lit(None).cast("string")
    tgt = p.select(k, F.when(v == 1, dash("p_brand", "p_type")).otherwise(F.col("p_brand")).alias("c1"),
                   F.when(v == 1, F.col("p_name")).otherwise(F.col("p_type")).alias("c2"),
                   F.when(v == 0, nul).otherwise(size).alias("c3"))
    src = p.select(k, F.col("p_brand").alias("c1"),
                   F.when(v == 0, nul).when(v == 1, dash("p_type", "p_name")).otherwise(F.col("p_type")).alias("c2"),
                   F.when(v == 0, F.col("p_type")).when(v == 1, size)
                    .otherwise((F.col("p_size") + 1).cast("string")).alias("c3"))
    return tgt, src


@register("legacy_hash_collisions", """
WITH t AS (SELECT p_partkey,
                  CASE WHEN p_partkey % 3 = 1 THEN concat_ws('-', p_brand, p_type) ELSE p_brand END AS c1,
                  CASE WHEN p_partkey % 3 = 1 THEN p_name ELSE p_type END AS c2,
                  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS c3
           FROM part),
     s AS (SELECT p_partkey, p_brand AS c1,
                  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN concat_ws('-', p_type, p_name)
                       ELSE p_type END AS c2,
                  CASE WHEN p_partkey % 3 = 0 THEN p_type WHEN p_partkey % 3 = 1 THEN CAST(p_size AS VARCHAR)
                       ELSE CAST(p_size + 1 AS VARCHAR) END AS c3
           FROM part)
SELECT s.p_partkey,
       CASE WHEN concat_ws('-', s.c1, s.c2, s.c3) <> concat_ws('-', t.c1, t.c2, t.c3) THEN 'changed'
            ELSE 'unchanged' END AS legacy_status,
       CASE WHEN s.c1 IS DISTINCT FROM t.c1 OR s.c2 IS DISTINCT FROM t.c2 OR s.c3 IS DISTINCT FROM t.c3
            THEN 'changed' ELSE 'unchanged' END AS exact_status
FROM s JOIN t ON s.p_partkey = t.p_partkey""")
def q_legacy_hash_collisions(spark, sf_dir):
    tgt, src = _collision_frames(table(spark, sf_dir, "part"))
    leg = classify_changes(src, tgt, ["p_partkey"], compare="legacy_hash", status_col="legacy_status")
    exa = classify_changes(src, tgt, ["p_partkey"], compare="exact", status_col="exact_status")
    # both sides hold every part: neither goes through the driver
    return leg.select("p_partkey", "legacy_status").join(exa.select("p_partkey", "exact_status").hint("merge"), "p_partkey")


# ---------------------------------------------------------------- file ledger over an events listing
# events rows stand for files: one file per event, under a folder per event type;
# every fourth file sits one level deeper in archive/ (matched only by a wildcard
# that crosses folders).
LISTING_SQL = """
    listing AS (
      SELECT 'ERP' AS src_sys_key,
             'landing/erp/' || event_type || '/' || CASE WHEN event_id % 4 = 0 THEN 'archive/' ELSE '' END
               || upper(event_type) || '_' || lpad(CAST(event_id AS VARCHAR), 7, '0') || '.txt' AS path,
             ts AS modificationTime, user_id AS length
      FROM events),
    entities AS (
      SELECT 'ERP' AS src_sys_key, upper(event_type) AS src_entity_key,
             CAST(ascii(event_type) * 10 + length(event_type) AS INTEGER) AS src_entity_id,
             event_type || '/' || upper(event_type) || '_*.txt' AS src_entity_pattern,
             CASE WHEN event_type = 'signup' THEN 'inactive' ELSE 'active' END AS src_entity_status,
             CASE WHEN event_type IN ('click', 'view') THEN 'full' ELSE 'incremental' END AS src_entity_extract_type
      FROM (SELECT DISTINCT event_type FROM events)
      UNION ALL
      SELECT 'ERP', 'ARCHIVE', 99, '*/archive/*.txt', 'active', 'incremental'),
    rules AS (
      SELECT e.*, 7 AS src_sys_id, 'landing/erp/' || e.src_entity_pattern AS pattern
      FROM entities e WHERE src_entity_status = 'active'),
    disc AS (
      SELECT strftime(l.modificationTime, '%Y%m%d.%H%M%S.%f') || '.' || l.src_sys_key || '.'
               || regexp_extract(l.path, '[^/]*$') AS src_entity_inst_key,
             l.src_sys_key, r.src_sys_id, r.src_entity_key, r.src_entity_id, r.src_entity_extract_type,
             l.path AS src_entity_path, regexp_extract(l.path, '[^/]*$') AS src_entity_name,
             l.modificationTime AS src_entity_timestamp, CAST(l.length AS BIGINT) AS src_entity_size
      FROM listing l JOIN rules r ON l.src_sys_key = r.src_sys_key AND l.path GLOB r.pattern)"""

LEDGER_OUT = ["src_entity_inst_key", "src_sys_key", "src_entity_key", "src_entity_inst_no", "src_entity_path",
              "src_entity_name", "src_entity_timestamp", "src_entity_size", "src_entity_staged_time",
              "src_entity_load_status", "src_entity_load_mesg", "src_entity_load_run_id"]


def _staged_sql(alias: str, src: str, last: str | None, ts_sql: str) -> str:
    base = "0" if last is None else f"coalesce((SELECT max(src_entity_inst_no) FROM {last} x " \
                                     f"WHERE x.src_sys_key = d.src_sys_key AND x.src_entity_key = d.src_entity_key), 0)"
    no = (f"CAST({base} + row_number() OVER (PARTITION BY d.src_sys_key, d.src_entity_key "
          f"ORDER BY d.src_entity_inst_key) AS BIGINT)")
    return f"""
    {alias} AS (
      SELECT src_entity_inst_key, src_sys_key, src_entity_key, inst_no AS src_entity_inst_no, src_entity_path,
             src_entity_name, src_entity_timestamp, src_entity_size, {ts_sql} AS src_entity_staged_time,
             'staged' AS src_entity_load_status, 'Staged' AS src_entity_load_mesg,
             lpad(CAST(src_sys_id AS VARCHAR), 5, '0') || '.' || lpad(CAST(src_entity_id AS VARCHAR), 5, '0')
               || '.' || lpad(CAST(inst_no AS VARCHAR), 10, '0') AS src_entity_load_run_id
      FROM (SELECT d.*, {no} AS inst_no FROM {src} d) z)"""


LEDGER_CTES = f"""{LISTING_SQL},
    {_staged_sql('old', '(SELECT * FROM disc WHERE src_entity_size % 3 = 0)', None, SEED_TS_SQL).strip()},
    {_staged_sql('new', '(SELECT * FROM disc WHERE src_entity_inst_key NOT IN (SELECT src_entity_inst_key FROM old))',
                 'old', RUN_TS_SQL).strip()},
    ledger AS (
      SELECT src_entity_inst_key, src_sys_key, src_entity_key, src_entity_inst_no, src_entity_path, src_entity_name,
             src_entity_timestamp, src_entity_size, src_entity_staged_time,
             CASE src_entity_inst_no % 5 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' ELSE 'staged' END
               AS src_entity_load_status,
             src_entity_load_mesg, src_entity_load_run_id
      FROM (SELECT * FROM old UNION ALL SELECT * FROM new))"""


def events_listing(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(listing, rules) derived from the events table."""
    from loadkit.operators.ledger import entity_rules
    e = table(spark, sf_dir, "events")
    path = F.concat(F.lit("landing/erp/"), F.col("event_type"), F.lit("/"),
                    F.when(F.col("event_id") % 4 == 0, F.lit("archive/")).otherwise(F.lit("")),
                    F.upper("event_type"), F.lit("_"), F.lpad(F.col("event_id").cast("string"), 7, "0"),
                    F.lit(".txt"))
    listing = e.select(F.lit("ERP").alias("src_sys_key"), path.alias("path"),
                       F.col("ts").alias("modificationTime"), F.col("user_id").alias("length"))
    et = F.col("event_type")
    ents = e.select("event_type").distinct().select(
        F.lit("ERP").alias("src_sys_key"), F.upper(et).alias("src_entity_key"),
        (F.ascii(et) * 10 + F.length(et)).cast("int").alias("src_entity_id"),
        F.concat(et, F.lit("/"), F.upper(et), F.lit("_*.txt")).alias("src_entity_pattern"),
        F.when(et == "signup", F.lit("inactive")).otherwise(F.lit("active")).alias("src_entity_status"),
        F.when(et.isin("click", "view"), F.lit("full")).otherwise(F.lit("incremental"))
         .alias("src_entity_extract_type"))
    archive = spark.createDataFrame([("ERP", "ARCHIVE", 99, "*/archive/*.txt", "active", "incremental")],
                                    ents.schema)
    systems = spark.createDataFrame([("ERP", 7, "landing/erp", "active")],
                                    "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    return listing, entity_rules(systems, ents.unionByName(archive))


@register("discover_files", f"WITH {LISTING_SQL}\nSELECT * FROM disc")
def q_discover_files(spark, sf_dir):
    from loadkit.operators.ledger import discover_files
    listing, rules = events_listing(spark, sf_dir)
    return discover_files(listing, rules)


def _ledger_frames(spark, sf_dir):
    from loadkit.operators.ledger import LEDGER_SCHEMA, discover_files, stage_new_files
    listing, rules = events_listing(spark, sf_dir)
    disc = discover_files(listing, rules)
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    old = stage_new_files(disc.filter(F.col("src_entity_size") % 3 == 0), empty, SEED_TS)
    new = stage_new_files(disc, old, RUN_TS)
    return old, new


@register("stage_new_files", f"WITH {LEDGER_CTES}\nSELECT * FROM new")
def q_stage_new_files(spark, sf_dir):
    return _ledger_frames(spark, sf_dir)[1]


def ledger_frame(spark, sf_dir) -> DataFrame:
    old, new = _ledger_frames(spark, sf_dir)
    n = F.col("src_entity_inst_no") % 5
    return old.unionByName(new).withColumn(
        "src_entity_load_status",
        F.when(n == 0, F.lit("success")).when(n == 1, F.lit("failed")).otherwise(F.lit("staged")))


def _select_sql(policy: str) -> str:
    part = "PARTITION BY src_sys_key, src_entity_key"
    if policy == "full":
        action = (f"CASE WHEN src_entity_inst_key = max(src_entity_inst_key) OVER ({part}) THEN 'load' "
                  "ELSE 'skip' END")
        seq = f"CASE WHEN src_entity_inst_key = max(src_entity_inst_key) OVER ({part}) THEN CAST(1 AS BIGINT) END"
    elif policy == "incremental_one":
        action = (f"CASE WHEN src_entity_inst_key = min(src_entity_inst_key) OVER ({part}) THEN 'load' "
                  "ELSE 'wait' END")
        seq = f"CASE WHEN src_entity_inst_key = min(src_entity_inst_key) OVER ({part}) THEN CAST(1 AS BIGINT) END"
    else:
        action = "'load'"
        seq = f"CAST(row_number() OVER ({part} ORDER BY src_entity_inst_key) AS BIGINT)"
    return f"""WITH {LEDGER_CTES}
SELECT *, {action} AS action, {seq} AS load_seq
FROM ledger WHERE src_entity_load_status IN ('staged', 'failed')"""


def _select(policy):
    def q(spark, sf_dir):
        from loadkit.operators.ledger import select_files
        return select_files(ledger_frame(spark, sf_dir), policy)
    return q


register("select_full_latest", _select_sql("full"))(_select("full"))
register("select_incremental_all", _select_sql("incremental_all"))(_select("incremental_all"))
register("select_incremental_oldest", _select_sql("incremental_one"))(_select("incremental_one"))


@register("ledger_status_update", f"""WITH {LEDGER_CTES},
sel AS (SELECT src_entity_inst_key,
               CASE WHEN src_entity_inst_key = max(src_entity_inst_key)
                         OVER (PARTITION BY src_sys_key, src_entity_key) THEN 'load' ELSE 'skip' END AS action
        FROM ledger WHERE src_entity_load_status IN ('staged', 'failed')),
upd AS (SELECT src_entity_inst_key,
               CASE WHEN action = 'load' THEN 'success' ELSE 'skipped' END AS st,
               CASE WHEN action = 'load' THEN 'Loaded' ELSE 'Skipped: newer file loaded' END AS msg
        FROM sel)
SELECT l.src_entity_inst_key, l.src_sys_key, l.src_entity_key, l.src_entity_inst_no, l.src_entity_path,
       l.src_entity_name, l.src_entity_timestamp, l.src_entity_size, l.src_entity_staged_time,
       coalesce(u.st, l.src_entity_load_status) AS src_entity_load_status,
       coalesce(u.msg, l.src_entity_load_mesg) AS src_entity_load_mesg,
       CASE WHEN u.src_entity_inst_key IS NOT NULL THEN 'R1' ELSE l.src_entity_load_run_id END AS src_entity_load_run_id
FROM ledger l LEFT JOIN upd u ON l.src_entity_inst_key = u.src_entity_inst_key""")
def q_ledger_status_update(spark, sf_dir):
    from loadkit.operators.ledger import LEDGER_KEY, apply_status, select_files, skip_others
    ledger = ledger_frame(spark, sf_dir)
    sel = select_files(ledger, "full")
    loaded = sel.filter(F.col("action") == "load").select(
        *LEDGER_KEY, F.lit("success").alias("src_entity_load_status"),
        F.lit("Loaded").alias("src_entity_load_mesg"), F.lit("R1").alias("src_entity_load_run_id"))
    return apply_status(ledger, loaded.unionByName(skip_others(sel, "R1")))


# ---------------------------------------------------------------- delimited feeds (C4)
def _contract(name, cols, **kw):
    from loadkit.contracts import ColumnMap, FeedContract
    return FeedContract(name=name, columns=tuple(ColumnMap(s, t, ty) for s, t, ty in cols), **kw)


CUSTOMER_FEED = [("c_custkey", "customer_id", "bigint"), ("c_name", "customer_name", "string"),
                 ("c_nationkey", "nation_id", "int"), ("c_acctbal", "balance", "decimal(15,2)"),
                 ("c_mktsegment", "segment", "string")]


@register("delimited_roundtrip", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
       CAST(c_acctbal AS DECIMAL(15,2)) AS balance, c_mktsegment AS segment
FROM customer""")
def q_delimited_roundtrip(spark, sf_dir):
    """customer -> tab-separated files with a header (16 files) -> contract read."""
    from loadkit.session import scratch_path
    from loadkit.sources.delimited import load_delimited, render_delimited
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").cast("string").alias("c_acctbal"),
        "c_mktsegment")
    path = render_delimited(c, scratch_path(spark, "feed_tab_header"), sep="\t", header=True)
    contract = _contract("feed_tab_header", CUSTOMER_FEED, header=True, sep="\t", quote='"')
    return load_delimited(spark, path, contract)


ORDERS_FEED = [("_c0", "order_id", "bigint"), ("_c1", "customer_id", "bigint"), ("_c2", "order_date", "date"),
               ("_c3", "amount", "decimal(15,2)"), ("_c4", "priority", "string")]


@register("delimited_dates_decimals", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 THEN NULL
            ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_orderkey % 23 = 0 OR o_orderkey % 29 = 0 THEN NULL
            ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS amount,
       CASE WHEN o_orderkey % 31 = 0 THEN o_orderpriority || '|x'
            WHEN o_orderkey % 37 = 0 THEN o_orderpriority || chr(10) || 'line2'
            ELSE o_orderpriority END AS priority
FROM orders""")
def q_delimited_dates_decimals(spark, sf_dir):
    """orders -> pipe text with yyyyMMdd dates, quoted separators and newlines and
    derived hostile cells (00000000, 20230230, blank, non-numeric, over precision)."""
    from loadkit.session import scratch_path
    from loadkit.sources.delimited import load_delimited, render_delimited
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    date_txt = (F.when(k % 13 == 0, F.lit("00000000")).when(k % 17 == 0, F.lit("20230230"))
                 .when(k % 19 == 0, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")))
    amt_txt = (F.when(k % 23 == 0, F.lit("n/a")).when(k % 29 == 0, F.lit("12345678901234.50"))
                .otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")))
    prio = (F.when(k % 31 == 0, F.concat("o_orderpriority", F.lit("|x")))
             .when(k % 37 == 0, F.concat("o_orderpriority", F.lit("\nline2"))).otherwise(F.col("o_orderpriority")))
    text = o.select(k.cast("string"), F.col("o_custkey").cast("string"), date_txt, amt_txt, prio)
    path = render_delimited(text, scratch_path(spark, "feed_pipe"), sep="|")
    contract = _contract("feed_pipe", ORDERS_FEED, sep="|", quote='"', multiline=True, date_format="yyyyMMdd")
    return load_delimited(spark, path, contract)


# ---------------------------------------------------------------- XML record sets
ORDERS_PER_DOC = 64
RECORDS_PER_FILE = 1 << 20   # orders and lines that one rendered file holds at most about


def order_files(spark, sf_dir, least: int = 1) -> int:
    """Files for the order documents: ``least``, more where they would hold more than about
    ``RECORDS_PER_FILE`` records each."""
    records = table(spark, sf_dir, "orders").count() + table(spark, sf_dir, "lineitem").count()
    return max(least, -(-records // RECORDS_PER_FILE))


def order_documents(spark, sf_dir, files: int, parent_after_child: bool = False, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Documents of ORDERS_PER_DOC consecutive order keys, in ``files`` partitions: orders and
    lines are dealt to them by document, in one shuffle, and put together where they land.
    ``part`` (i, n) is the i-th of n parts of the documents. An order that is there twice has
    its lines twice; lines without an order are left out."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.struct(
        "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(15,2)").alias("o_totalprice"),
        "o_orderdate", "o_orderpriority").alias("o"), F.lit(None).alias("l"))
    li = table(spark, sf_dir, "lineitem").filter("l_orderkey IS NOT NULL").select(
        F.col("l_orderkey").alias("k"), F.lit(None).alias("o"),
        F.struct(F.col("l_linenumber").alias("L_LINENUMBER"), F.col("l_partkey").alias("L_PARTKEY"),
                 F.col("l_suppkey").alias("L_SUPPKEY"), F.col("l_quantity").cast("decimal(15,2)").alias("L_QTY"),
                 F.col("l_extendedprice").cast("decimal(15,2)").alias("L_PRICE")).alias("l"))
    line_type = "array<struct<L_LINENUMBER:string,L_PARTKEY:string,L_SUPPKEY:string,L_QTY:string,L_PRICE:string>>"
    rows = o.unionByName(li).withColumn("doc", F.expr(f"k div {ORDERS_PER_DOC}"))
    i, n = part
    if n > 1:
        rows = rows.filter(F.pmod(F.xxhash64("doc"), F.lit(n)) == i)
    orders = (rows.repartition(files, "doc").groupBy("doc", "k").agg(F.collect_list("o").alias("o"), F.collect_list("l").alias("l"))
                  .select("doc", "k", F.explode("o").alias("o"), F.col("l").cast(line_type).alias("LINE")))
    k = F.col("k")
    prio = F.when(k % 7 == 0, F.concat("o.o_orderpriority", F.lit(" & co"))).otherwise(F.col("o.o_orderpriority"))
    fields = [k.cast("string").alias("O_ORDERKEY"), F.col("o.o_custkey").cast("string").alias("O_CUSTKEY"),
              F.col("o.o_orderstatus").alias("O_STATUS"), F.col("o.o_totalprice").cast("string").alias("O_TOTAL"),
              F.date_format("o.o_orderdate", "yyyy-MM-dd").alias("O_DATE"), prio.alias("O_PRIORITY")]
    order = F.struct(*([F.col("LINE")] + fields if parent_after_child else fields + [F.col("LINE")]))
    docs = orders.groupBy("doc").agg(F.min("o.o_orderdate").alias("created"), F.collect_list(order).alias("ORDER"))
    return docs.select(F.struct(F.col("doc").cast("string").alias("DOCNUM"),
                                F.date_format("created", "yyyy-MM-dd").alias("CREATED_ON")).alias("HDR"),
                       "ORDER")


def render_order_documents(spark, sf_dir, path: str, parent_after_child: bool = False,
                           files: int = 8, part: tuple[int, int] = (0, 1), **options: str) -> str:
    """orders + lineitem as XML: one <DOC> per 64 consecutive order keys, a header
    segment, repeating <ORDER> with repeating <LINE> children.

    Document size is bounded by ORDERS_PER_DOC orders and lines per order are
    bounded by the line-number domain, so no collected group grows with the data.
    There are ``files`` files, more where they would hold more than about
    ``RECORDS_PER_FILE`` records each: a file is written by one task. With ``part`` (i, n)
    the i-th of n parts of the documents is written, into its share of the files;
    ``options`` are the writer's.
    """
    share = -(-order_files(spark, sf_dir, files) // part[1])
    (order_documents(spark, sf_dir, share, parent_after_child, part).write.format("xml")
        .options(rootTag="ORDERS", rowTag="DOC", **options).mode("errorifexists").save(path))
    return path


def order_xml_contract():
    from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
    hdr = [XmlColumn("docnum", "HDR/DOCNUM", False), XmlColumn("created_on", "HDR/CREATED_ON", False)]
    order_cols = [XmlColumn("o_orderkey", "ORDER/O_ORDERKEY"), XmlColumn("o_custkey", "ORDER/O_CUSTKEY"),
                  XmlColumn("o_orderstatus", "ORDER/O_STATUS"), XmlColumn("o_totalprice", "ORDER/O_TOTAL"),
                  XmlColumn("o_orderdate", "ORDER/O_DATE"), XmlColumn("o_orderpriority", "ORDER/O_PRIORITY")]
    line_cols = [XmlColumn("l_linenumber", "ORDER/LINE/L_LINENUMBER"), XmlColumn("l_partkey", "ORDER/LINE/L_PARTKEY"),
                 XmlColumn("l_suppkey", "ORDER/LINE/L_SUPPKEY"), XmlColumn("l_quantity", "ORDER/LINE/L_QTY"),
                 XmlColumn("l_extendedprice", "ORDER/LINE/L_PRICE")]
    carried = [XmlColumn(c.name, c.path, False) for c in order_cols[:1] + order_cols[4:5]]
    return XmlContract("orders_xml", "DOC", (
        XmlRecordSet("orders", "ORDER", tuple(hdr + order_cols)),
        XmlRecordSet("lines", "ORDER/LINE", tuple(hdr + carried + line_cols))))


XML_ORDER_TYPES = "docnum bigint, created_on date, o_orderkey bigint, o_custkey bigint, o_orderstatus string, " \
                  "o_totalprice decimal(15,2), o_orderdate date, o_orderpriority string"
XML_LINE_TYPES = "docnum bigint, created_on date, o_orderkey bigint, o_orderdate date, l_linenumber int, " \
                 "l_partkey bigint, l_suppkey bigint, l_quantity decimal(15,2), l_extendedprice decimal(15,2)"

XML_DOC_CTE = f"""
    o AS (SELECT *, o_orderkey // {ORDERS_PER_DOC} AS doc FROM orders),
    h AS (SELECT doc, CAST(min(o_orderdate) AS DATE) AS created_on FROM o GROUP BY doc)"""


def _xml_records(spark, sf_dir, record_set: str, types: str, parent_after_child: bool = False):
    from loadkit.session import scratch_path
    from loadkit.sources.xml import load_xml_recordsets
    # one task reads a file, compressed or not
    path = render_order_documents(spark, sf_dir, scratch_path(spark, "orders_xml"), parent_after_child, indent="", compression="gzip")
    sets = load_xml_recordsets(spark, path, order_xml_contract())
    return conform(sets[record_set], _ddl_schema(types))


def _ddl_schema(ddl: str):
    from pyspark.sql import types as T
    fields = []
    for part in ddl.split(", "):
        name, ty = part.split(" ", 1)
        fields.append(T.StructField(name, T._parse_datatype_string(ty)))
    return T.StructType(fields)


@register("xml_orders", f"""
WITH {XML_DOC_CTE}
SELECT CAST(o.doc AS BIGINT) AS docnum, h.created_on, o_orderkey, o_custkey, o_orderstatus,
       CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority || ' & co' ELSE o_orderpriority END AS o_orderpriority
FROM o JOIN h ON o.doc = h.doc""")
def q_xml_orders(spark, sf_dir):
    return _xml_records(spark, sf_dir, "orders", XML_ORDER_TYPES)


XML_LINES_SQL = f"""
WITH {XML_DOC_CTE}
SELECT CAST(o.doc AS BIGINT) AS docnum, h.created_on, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS o_orderdate,
       l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_quantity AS DECIMAL(15,2)) AS l_quantity,
       CAST(l.l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice
FROM o JOIN h ON o.doc = h.doc JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""


@register("xml_header_detail", XML_LINES_SQL)
def q_xml_header_detail(spark, sf_dir):
    return _xml_records(spark, sf_dir, "lines", XML_LINE_TYPES)


@register("xml_parent_after_child", XML_LINES_SQL)
def q_xml_parent_after_child(spark, sf_dir):
    return _xml_records(spark, sf_dir, "lines", XML_LINE_TYPES, parent_after_child=True)


# ---------------------------------------------------------------- audit log and maintenance schedule
AUDIT_EVENTS_SQL = """
    a AS (SELECT 'run-' || CAST(user_id AS VARCHAR) AS id, 'finance' AS domain, 'raw' AS layer,
                 'load_' || CAST(user_id % 7 AS VARCHAR) AS job_name, 'app' AS spark_application_id,
                 CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' ELSE 'started' END
                   AS status,
                 ts AS event_time, event_id AS rows_read, user_id AS rows_new, CAST(NULL AS BIGINT) AS rows_changed,
                 CAST(0 AS BIGINT) AS rows_deleted, event_type AS message
          FROM events)"""


def audit_events(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return e.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("id"), F.lit("finance").alias("domain"),
        F.lit("raw").alias("layer"), F.concat(F.lit("load_"), (F.col("user_id") % 7).cast("string")).alias("job_name"),
        F.lit("app").alias("spark_application_id"),
        F.when(et == "error", "failed").when(et == "purchase", "completed").otherwise("started").alias("status"),
        F.col("ts").alias("event_time"), F.col("event_id").alias("rows_read"), F.col("user_id").alias("rows_new"),
        F.lit(None).cast("long").alias("rows_changed"), F.lit(0).cast("long").alias("rows_deleted"),
        et.alias("message"))


@register("audit_latest_state", f"""
WITH {AUDIT_EVENTS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_time DESC) AS rn,
             min(event_time) OVER (PARTITION BY id) AS st, max(event_time) OVER (PARTITION BY id) AS mt
      FROM a)
SELECT id, domain, layer, job_name, spark_application_id, status, rows_read, rows_new, rows_changed, rows_deleted,
       message, st AS start_time, CASE WHEN status IN ('completed', 'failed') THEN mt END AS end_time
FROM r WHERE rn = 1""")
def q_audit_latest_state(spark, sf_dir):
    from loadkit.operators.audit import audit_latest_state
    return audit_latest_state(audit_events(spark, sf_dir))


@register("maintenance_due", """
WITH m AS (SELECT event_type || '_' || CAST(user_id % 10 AS VARCHAR) AS table_name, ts AS start_time,
                  CASE WHEN event_id % 97 = 0 THEN 'success' ELSE 'failed' END AS status
           FROM events),
g AS (SELECT table_name, max(CASE WHEN status = 'success' THEN start_time END) AS last_success,
             CAST(count(*) AS BIGINT) AS n_runs
      FROM m GROUP BY table_name)
SELECT table_name, last_success, n_runs,
       (last_success IS NULL OR last_success < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY) AS due
FROM g""")
def q_maintenance_due(spark, sf_dir):
    from loadkit.operators.audit import maintenance_due
    e = table(spark, sf_dir, "events")
    runs = e.select(F.concat(F.col("event_type"), F.lit("_"), (F.col("user_id") % 10).cast("string")).alias("table_name"),
                    F.col("ts").alias("start_time"),
                    F.when(F.col("event_id") % 97 == 0, "success").otherwise("failed").alias("status"))
    return maintenance_due(runs, dt.datetime(2024, 1, 31), days=7)


# ---------------------------------------------------------------- streaming ingestion
@register("stream_ingest", f"""
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
       CAST(c_acctbal AS DECIMAL(15,2)) AS balance, c_mktsegment AS segment,
       {RUN_TS_SQL} AS ins_ts, 'STREAM' AS ins_by, CAST(NULL AS TIMESTAMP) AS upd_ts, CAST(NULL AS VARCHAR) AS upd_by
FROM customer""")
def q_stream_ingest(spark, sf_dir):
    """customer as 8 headerless CSV files, streamed available-now two files per
    micro-batch, upserted by key into a snapshot table; result = final table."""
    from pyspark.sql import types as T
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    from loadkit.sources.delimited import render_delimited
    from loadkit.streaming.ingest import ingest_available, snapshot_sink
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").cast("string"), "c_mktsegment")
    src_dir = render_delimited(c, scratch_path(spark, "stream_src"), sep=",", files=8)
    contract = _contract("feed_stream", [(f"_c{i}", t, ty) for i, (_, t, ty) in enumerate(CUSTOMER_FEED)],
                         sep=",", quote='"', file_pattern="part-*")
    target = T.StructType(contract.target_schema().fields + [
        T.StructField("ins_ts", T.TimestampNTZType()), T.StructField("ins_by", T.StringType()),
        T.StructField("upd_ts", T.TimestampNTZType()), T.StructField("upd_by", T.StringType())])
    tbl = SnapshotTable(spark, scratch_path(spark, "stream_tgt"))
    sink = snapshot_sink(tbl, target, AUDIT, "STREAM", RUN_TS, keys=["customer_id"])
    ingest_available(spark, src_dir, contract, sink, scratch_path(spark, "stream_ckpt"), max_files_per_trigger=2)
    return tbl.read()


# ---------------------------------------------------------------- numbering and instance keys
@register("number_instances", """
SELECT event_id, event_type,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS BIGINT) AS instance_no
FROM events""")
def q_number_instances(spark, sf_dir):
    """Gap-free numbering per event type (each type holds about a fifth of all
    rows) with the range-partitioned numbering that splits hot groups."""
    from loadkit.functions.numbering import number_within
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return number_within(e, ["event_type"], ["ts", "event_id"], out="instance_no").drop("ts")


@register("instance_key", """
WITH f AS (SELECT event_id, ts, upper(event_type) || '_' || lpad(CAST(event_id AS VARCHAR), 7, '0') || '.txt' AS path,
                  CAST(ascii(event_type) * 10 + length(event_type) AS INTEGER) AS entity_id
           FROM events)
SELECT event_id, path AS file_name,
       strftime(ts, '%Y%m%d.%H%M%S.%f') || '.ERP.' || path AS src_entity_inst_key,
       '00007.' || lpad(CAST(entity_id AS VARCHAR), 5, '0') || '.' || lpad(CAST(event_id AS VARCHAR), 10, '0')
         AS src_entity_load_run_id
FROM f""")
def q_instance_key(spark, sf_dir):
    """Instance key from file time, system and base name; padded run id."""
    from loadkit.functions.exprs import basename, instance_key, padded_run_id
    e = table(spark, sf_dir, "events")
    path = F.concat(F.lit("landing/erp/"), F.col("event_type"), F.lit("/"), F.upper("event_type"), F.lit("_"),
                    F.lpad(F.col("event_id").cast("string"), 7, "0"), F.lit(".txt"))
    ent = (F.ascii("event_type") * 10 + F.length("event_type")).cast("int")
    name = basename(path)
    return e.select("event_id", name.alias("file_name"),
                    instance_key(F.col("ts"), F.lit("ERP"), name).alias("src_entity_inst_key"),
                    padded_run_id(F.lit(7), ent, F.col("event_id")).alias("src_entity_load_run_id"))


# ---------------------------------------------------------------- conform with cast-failure report
@register("conform_cast_failures", """
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 23 = 0 THEN 'n/a' WHEN o_orderkey % 29 = 0 THEN '12345678901234.50'
              ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) END AS amount,
         CASE WHEN o_orderkey % 13 = 0 THEN '2023-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN o_orderkey % 17 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END
           AS customer_id
  FROM orders)
SELECT o_orderkey AS order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id,
       TRY_CAST(amount AS DECIMAL(15,2)) AS amount, TRY_CAST(order_date AS DATE) AS order_date,
       concat_ws(',', CASE WHEN TRY_CAST(customer_id AS BIGINT) IS NULL THEN 'customer_id' END,
                      CASE WHEN TRY_CAST(amount AS DECIMAL(15,2)) IS NULL THEN 'amount' END,
                      CASE WHEN TRY_CAST(order_date AS DATE) IS NULL THEN 'order_date' END) AS failed_columns
FROM t""")
def q_conform_cast_failures(spark, sf_dir):
    """Text columns conformed to typed targets with try_cast; each row lists the
    columns whose non-NULL value could not be cast (counted, not silently NULLed)."""
    from pyspark.sql import types as T
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = o.select(
        k.alias("ORDER_ID"),
        F.when(k % 17 == 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string")))
         .otherwise(F.col("o_custkey").cast("string")).alias("Customer_Id"),
        F.when(k % 23 == 0, F.lit("n/a")).when(k % 29 == 0, F.lit("12345678901234.50"))
         .otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string")).alias("amount"),
        F.when(k % 13 == 0, F.lit("2023-02-30")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
         .alias("order_date"))
    target = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
                           T.StructField("amount", T.DecimalType(15, 2)), T.StructField("order_date", T.DateType())])
    out = conform(text, target, error_col="_failed")
    return out.select("order_id", "customer_id", "amount", "order_date",
                      F.array_join("_failed", ",").alias("failed_columns"))


# ---------------------------------------------------------------- end to end: runner and snapshots
@register("run_load_orders", f"SELECT * EXCLUDE ({ACTION_COL}) FROM ({UPSERT_ORDERS_SQL})")
def q_run_load_orders(spark, sf_dir):
    """C10 end to end: snapshot target seeded from T, merge of S through run_load
    (pre/post hooks, audit events, one published version); result = new target."""
    from loadkit.contracts import LoadSpec
    from loadkit.operators.audit import parquet_append_sink
    from loadkit.plans.runner import run_load
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    tgt, src = orders_change_set(spark, sf_dir)
    table_ = SnapshotTable(spark, scratch_path(spark, "orders_tgt"))
    table_.write(with_seed_audit(tgt), run_id="seed")
    spec = LoadSpec(load_id="L1", target=table_.root, source=lambda s: src, source_type="callable",
                    keys=("o_orderkey",), audit=AUDIT,
                    pre_sql="CREATE OR REPLACE TEMP VIEW loadkit_pre_counts AS "
                            "SELECT record_status, count(*) AS n FROM <<source>> GROUP BY record_status",
                    post_sql="CREATE OR REPLACE TEMP VIEW loadkit_post_rows AS SELECT count(*) AS n FROM <<target>>")
    run_load(spark, spec, "run-orders-1", RUN_TS, audit_sink=parquet_append_sink(scratch_path(spark, "audit")))
    return table_.read()


@register("snapshot_compaction", """
SELECT CAST(count(*) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after,
       TRUE AS fewer_files, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
FROM lineitem""")
def q_snapshot_compaction(spark, sf_dir):
    """Lineitem as one overwrite version of many files plus an append version,
    compacted to about 64 MB a file: rows are kept, there are fewer files."""
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    t = SnapshotTable(spark, scratch_path(spark, "compact"))
    t.write(li.filter(F.col("l_linenumber") <= 3), run_id="base", num_files=16)
    t.write(li.filter(F.col("l_linenumber") > 3), run_id="more", num_files=4, mode="append")
    before, files = t.read().count(), t.file_stats().first()["n_files"]
    t.compact(target_file_bytes=64 << 20)
    after = t.file_stats().first()["n_files"]
    return t.read().agg(F.lit(before).cast("long").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"),
                        F.lit(after < files).alias("fewer_files"), F.sum("l_orderkey").cast("long").alias("key_sum"))


# ---------------------------------------------------------------- end to end: listing -> ledger -> feed load
@register("feed_load_incremental", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
       CAST(c_acctbal AS DECIMAL(15,2)) AS balance, c_mktsegment AS segment
FROM customer""")
def q_feed_load_incremental(spark, sf_dir):
    """S6 + C1-C4 + K11/K12 + C13: customer written as 8 CSV files, listed with
    binaryFile, discovered against an entity wildcard, staged into a ledger table
    and loaded (incremental, all files, append) in one scan; result = raw table."""
    from loadkit.operators.ledger import LEDGER_SCHEMA, discover_files, entity_rules, stage_new_files
    from loadkit.plans.runner import load_many
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    from loadkit.sources.delimited import render_delimited
    from loadkit.sources.listing import list_files, normalise_paths
    root = scratch_path(spark, "landing")
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(15,2)").cast("string"), "c_mktsegment")
    render_delimited(c, f"{root}/customer", sep="|", files=8)
    systems = spark.createDataFrame([("ERP", 3, root, "active")],
                                    "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    entities = spark.createDataFrame([("ERP", "CUSTOMER", 12, "customer/part-*.csv", "active")],
                                     "src_sys_key string, src_entity_key string, src_entity_id int, "
                                     "src_entity_pattern string, src_entity_status string")
    listing = normalise_paths(list_files(spark, root, system_key="ERP"))
    staged = stage_new_files(discover_files(listing, entity_rules(systems, entities)),
                             spark.createDataFrame([], LEDGER_SCHEMA), RUN_TS)
    ledger = SnapshotTable(spark, scratch_path(spark, "ledger"))
    ledger.write(staged.select(*LEDGER_SCHEMA.names), run_id="stage-1")
    contract = _contract("customer_feed", [(f"_c{i}", t, ty) for i, (_, t, ty) in enumerate(CUSTOMER_FEED)],
                         sep="|", quote='"', extract_type="incremental", load_type="append",
                         load_all_incremental=True)
    raw = SnapshotTable(spark, scratch_path(spark, "raw_customer"))
    load_many(spark, [(contract, raw, "CUSTOMER")], ledger, "feed-1")
    return raw.read()


# ---------------------------------------------------------------- hostile feeds
HOSTILE_FEED = [("k", "bigint"), ("c", "bigint"), ("amount", "decimal(15,2)"), ("d", "date")]


def _land(spark, listing_root: str, rules: list[tuple], ledger, run_ts):
    """List, discover, stage and append to the ledger in one call."""
    from loadkit.plans.runner import stage_files
    systems = spark.createDataFrame([("ERP", 3, listing_root, "active")],
                                    "src_sys_key string, src_sys_id int, src_entity_path string, src_sys_status string")
    entities = spark.createDataFrame([("ERP", *r, "active") for r in rules],
                                     "src_sys_key string, src_entity_key string, src_entity_id int, "
                                     "src_entity_pattern string, src_entity_status string")
    stage_files(spark, listing_root, "ERP", systems, entities, ledger, run_ts)


def _hostile_lines(spark, sf_dir) -> DataFrame:
    """orders as pipe text: a zero date (k % 11 = 0), an amount that is none (k % 13 = 0),
    a row without its last field (k % 17 = 0)."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    amount = F.when(k % 13 == 0, "abc").otherwise(F.col("o_totalprice").cast("decimal(15,2)").cast("string"))
    date = F.when(k % 11 == 0, "00000000").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    head = F.concat_ws("|", k.cast("string"), F.col("o_custkey").cast("string"), amount)
    return o.select(k.alias("k"), F.when(k % 17 == 0, head).otherwise(F.concat_ws("|", head, date)).alias("value"))


_HOSTILE_SQL = """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c,
                  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS amount,
                  CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d,
                  CASE o_orderkey % 3 WHEN 0 THEN 'plain' WHEN 1 THEN 'a b%41+c' ELSE 'later' END AS folder,
                  o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 AS bad
           FROM orders)
SELECT 'row' AS what, k, c, amount, d, NULL AS folder, NULL AS status, CAST(NULL AS BIGINT) AS n_rows, CAST(NULL AS BIGINT) AS n_bad FROM o
UNION ALL
SELECT 'file', NULL, NULL, NULL, NULL, folder, 'success', count(*), count(*) FILTER (bad) FROM o GROUP BY folder
UNION ALL
SELECT 'file', NULL, NULL, NULL, NULL, 'empty', 'success', 0, 0"""


def _file_rows(ledger: DataFrame) -> DataFrame:
    """Rows and bad rows that the ledger's messages tell, by folder and status."""
    told = lambda n: F.sum(F.regexp_extract("src_entity_load_mesg", r"^\w+: (\d+) rows, (\d+) ", n).cast("long"))
    folder = F.regexp_extract("src_entity_path", "([^/]+)/[^/]+$", 1)
    return (ledger.groupBy(folder.alias("folder"), F.col("src_entity_load_status").alias("status"))
            .agg(told(1).alias("n_rows"), told(2).alias("n_bad")))


@register("feed_load_hostile", _HOSTILE_SQL)
def q_feed_load_hostile(spark, sf_dir):
    """Bad cells, short rows, an empty file, a folder with a
    blank, a per cent and a plus sign; loaded in two runs, then again after the ledger
    forgot them (a crash between publishing and the ledger update). Rows of the raw
    table, and what the ledger holds of each folder's files."""
    from loadkit.operators.ledger import LEDGER_SCHEMA
    from loadkit.plans.runner import load_feed
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    root, lines = scratch_path(spark, "hostile"), _hostile_lines(spark, sf_dir)
    ledger, raw = SnapshotTable(spark, scratch_path(spark, "ledger")), SnapshotTable(spark, scratch_path(spark, "raw"))
    ledger.write(spark.createDataFrame([], LEDGER_SCHEMA), run_id="none")
    contract = _contract("hostile", [(f"_c{i}", n, t) for i, (n, t) in enumerate(HOSTILE_FEED)], sep="|", quote='"',
                         date_format="yyyyMMdd", extract_type="incremental", load_type="append", load_all_incremental=True)

    def land(folder, which, run):
        which.select("value").write.text(f"{root}/in/{folder}")
        _land(spark, root, [("ORDERS", 12, "in/*/part-[0-9]*.txt")], ledger, RUN_TS + dt.timedelta(minutes=run))
    land("plain", lines.filter("k % 3 = 0"), 0)
    land("a b%41+c", lines.filter("k % 3 = 1"), 1)
    land("empty", lines.filter("false"), 2)
    ledger.write(ledger.read(), run_id="kept")    # for the crash below
    kept = ledger.latest()
    load_feed(spark, contract, ledger, raw, "ORDERS", "run-1")
    load_feed(spark, contract, ledger, raw, "ORDERS", "run-1b")
    ledger.write(spark.read.schema(LEDGER_SCHEMA).parquet(kept.path), run_id="crash")
    land("later", lines.filter("k % 3 = 2"), 3)
    load_feed(spark, contract, ledger, raw, "ORDERS", "run-2", files_per_scan=3)
    rows = raw.read().withColumn("what", F.lit("row"))
    return rows.unionByName(_file_rows(ledger.read()).withColumn("what", F.lit("file")), allowMissingColumns=True).select(
        "what", "k", "c", "amount", "d", "folder", "status", "n_rows", "n_bad")


@register("load_xml_feed_hostile", """
WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, o_orderkey % 6 = 5 AS broken FROM orders)
SELECT 'row' AS what, CAST(k AS VARCHAR) AS k, CASE WHEN k % 6 = 1 THEN '</DOC>' ELSE p END AS p, NULL AS folder, NULL AS status FROM o WHERE NOT broken
UNION ALL SELECT 'file', NULL, NULL, 'good', 'success'
UNION ALL SELECT 'file', NULL, NULL, 'bad', 'failed'""")
def q_load_xml_feed_hostile(spark, sf_dir):
    """Orders as documents with a namespace prefix, a closing tag inside
    CDATA, a document element inside a comment, a spaced closing tag; a folder of broken
    documents, whose files fail. Staged rows, and folders by file status; the second run
    finds nothing to stage again."""
    return hostile_xml_feed(spark, sf_dir, None)


def hostile_xml_feed(spark, sf_dir, documents_end_with: str | None) -> DataFrame:
    from loadkit.contracts import XmlColumn, XmlContract, XmlRecordSet
    from loadkit.operators.ledger import LEDGER_SCHEMA
    from loadkit.plans.runner import load_xml_feed
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    root, o, k = scratch_path(spark, "hostile_xml"), table(spark, sf_dir, "orders"), F.col("o_orderkey")
    prio = F.when(k % 6 == 1, "<![CDATA[</DOC>]]>").otherwise(F.col("o_orderpriority"))
    body = F.concat(F.lit("<H><K>"), k.cast("string"), F.lit("</K></H><O><P>"), prio, F.lit("</P></O>"))
    doc = (F.when(k % 6 == 0, F.concat(F.lit("<x:DOC xmlns:x='urn:x'>"), body, F.lit("</x:DOC>")))
            .when(k % 6 == 2, F.concat(F.lit("<!-- <DOC> --><DOC>"), body, F.lit("</DOC>")))
            .when(k % 6 == 3, F.concat(F.lit("<DOC>"), body, F.lit("</DOC >")))
            .when(k % 6 == 5, F.concat(F.lit("<DOC>"), F.replace(body, F.lit("</H>"), F.lit("</J>")), F.lit("</DOC>")))
            .otherwise(F.concat(F.lit("<DOC>"), body, F.lit("</DOC>"))))
    for folder, which in (("good", k % 6 != 5), ("bad", k % 6 == 5)):   # a file for 512 keys in a row
        (o.filter(which).groupBy(F.expr("o_orderkey div 512").alias("n")).agg(F.array_join(F.collect_list(doc), "\n").alias("docs"))
         .select(F.concat(F.lit("<R>"), "docs", F.lit("</R>")).alias("value"), "n").write.partitionBy("n").text(f"{root}/{folder}"))
    contract = XmlContract("hostile_xml", "DOC", (XmlRecordSet("o", "O", (XmlColumn("k", "H/K"), XmlColumn("p", "O/P"))),),
                           documents_end_with=documents_end_with)
    ledger = SnapshotTable(spark, scratch_path(spark, "ledger"))
    staging = {"o": SnapshotTable(spark, scratch_path(spark, "staging_o"))}
    ledger.write(spark.createDataFrame([], LEDGER_SCHEMA), run_id="none")
    _land(spark, root, [("DOCS", 5, "*/n=*/part-*.txt")], ledger, RUN_TS)
    load_xml_feed(spark, contract, ledger, staging, "DOCS", "x-1")
    load_xml_feed(spark, contract, ledger, staging, "DOCS", "x-2")   # the failed files once more
    files = ledger.read().select(F.lit("file").alias("what"), F.regexp_extract("src_entity_path", "/(good|bad)/", 1).alias("folder"),
                                 F.col("src_entity_load_status").alias("status")).distinct()
    rows = staging["o"].read().select(F.lit("row").alias("what"), "k", "p")
    return rows.unionByName(files, allowMissingColumns=True).select("what", "k", "p", "folder", "status")


@register("ledger_overlapping_entities", f"""WITH {LISTING_SQL},
two AS (SELECT src_entity_key AS e FROM disc UNION ALL SELECT src_entity_key || '_ALL' FROM disc)
SELECT e AS src_entity_key, CASE WHEN e LIKE '%\\_ALL' ESCAPE '\\' THEN 'staged' ELSE 'success' END AS status, count(*) AS n FROM two GROUP BY 1, 2""")
def q_ledger_overlapping_entities(spark, sf_dir):
    """Every file matches two entities and is staged for both; the status of one
    entity's files does not touch the other's."""
    from loadkit.operators.ledger import LEDGER_KEY, LEDGER_SCHEMA, apply_status, discover_files, stage_new_files
    listing, rules = events_listing(spark, sf_dir)
    other = rules.withColumn("src_entity_key", F.concat("src_entity_key", F.lit("_ALL"))).withColumn("src_entity_id", F.col("src_entity_id") + 1000)
    disc = discover_files(listing, rules.unionByName(other))
    staged = stage_new_files(disc, spark.createDataFrame([], LEDGER_SCHEMA), RUN_TS)
    again = stage_new_files(disc, staged, RUN_TS)   # nothing
    done = staged.filter(~F.col("src_entity_key").endswith("_ALL")).select(
        *LEDGER_KEY, F.lit("success").alias("src_entity_load_status"), F.lit("loaded").alias("src_entity_load_mesg"), F.lit("R1").alias("src_entity_load_run_id"))
    return (apply_status(staged.unionByName(again), done).groupBy("src_entity_key", F.col("src_entity_load_status").alias("status"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("run_load_hooks", """
WITH s AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 7 <> 0), t AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 10 <> 0 OR o_orderkey % 70 = 0),
n AS (SELECT count(*) AS k FROM customer)
SELECT (SELECT count(*) FROM t) AS target_before, (SELECT count(*) FROM orders) AS target_after,
       (SELECT count(*) FROM s) + (SELECT k FROM n) AS rows_read, (SELECT k FROM n) AS rows_without_key, (SELECT k FROM n) AS quarantined,
       (SELECT count(*) FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)) AS n_insert""")
def q_run_load_hooks(spark, sf_dir):
    """The pre hook sees the target before the load, the post hook the
    version just committed (it runs on a replay if it has not finished); source rows
    without a key (one a customer) are counted and set aside."""
    from loadkit.contracts import LoadSpec
    from loadkit.plans.runner import run_load
    from loadkit.plans.snapshots import SnapshotTable
    from loadkit.session import scratch_path
    tgt, src = orders_change_set(spark, sf_dir)
    keyless = table(spark, sf_dir, "customer").select(F.lit(None).cast("bigint").alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"))
    t, aside = SnapshotTable(spark, scratch_path(spark, "hook_target")), scratch_path(spark, "hook_aside")
    t.write(with_seed_audit(tgt), run_id="seed")
    # a table holds what the hook saw, whatever the target is later (a view would follow it)
    seen = "CREATE TABLE {w}_hook_{i} USING parquet AS SELECT count(*) AS n FROM {t}"
    me = uuid.uuid4().hex
    spec = LoadSpec(load_id="L1", target=t.root, source_type="callable", keys=("o_orderkey",), audit=AUDIT, quarantine=aside,
                    source=lambda s: src.unionByName(keyless, allowMissingColumns=True),
                    pre_sql=seen.format(w="pre", i=me, t="<<target>>"), post_sql=seen.format(w="post", i=me, t="<<target>>"))
    res = run_load(spark, spec, "hooks-1", RUN_TS)
    run_load(spark, spec, "hooks-1", RUN_TS)
    before, after = (spark.table(f"{w}_hook_{me}").first()["n"] for w in ("pre", "post"))
    for w in ("pre", "post"):
        spark.sql(f"DROP TABLE {w}_hook_{me}")
    m = res.metrics
    return spark.range(1).select(*[F.lit(v).cast("long").alias(n) for n, v in (
        ("target_before", before), ("target_after", after), ("rows_read", m["rows_read"]), ("rows_without_key", m["rows_without_key"]),
        ("quarantined", SnapshotTable(spark, aside).read().count()), ("n_insert", m["n_insert"]))])


@register("create_tables_from_list", """
SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal, 'own' AS p_own, 'default' AS p_default FROM customer""")
def q_create_tables_from_list(spark, sf_dir):
    """A list document names a definition script; the table it makes
    is filled from customer and read back, with its merged properties."""
    import json
    from loadkit.plans.tables import create_tables, environment_properties, load_table_list
    from loadkit.session import scratch_path
    root, name = scratch_path(spark, "ddl"), f"customer_{uuid.uuid4().hex[:12]}"
    typed = [("c_custkey", "bigint", False), ("c_name", "string", True), ("c_acctbal", "decimal(15,2)", True)]
    script = {"DatabaseName": "loadkit_demo", "TableName": name, "IsExternal": "yes", "Location": f"{root}/data",
              "TableProperties": {"lk.own": "own"}, "Columns": [
                  {"ColumnID": i, "ColumnName": c, "FormattedDataType": t, "IsNull": n} for i, (c, t, n) in enumerate(typed, 1)]}
    put = lambda doc, at: spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.text(f"{root}/{at}")
    put(script, "customer_ddl.json")
    put({"TableList": [{"TableName": name, "ScriptFileName": "customer_ddl.json", "DDLType": "Create", "DropTable": "No"}]}, "list.json")
    defaults = environment_properties({"Development": {"lk.own": "x", "lk.default": "default"}}, "Development")
    made = create_tables(spark, load_table_list(spark, f"{root}/list.json", root), defaults)[0]
    c = table(spark, sf_dir, "customer")
    c.select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(15,2)")).write.insertInto(made)
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {made}").collect()}
    return spark.table(made).select("*", F.lit(props["lk.own"]).alias("p_own"), F.lit(props["lk.default"]).alias("p_default"))


from loadkit import harness_loads  # noqa: E402, F401  registers more queries here
