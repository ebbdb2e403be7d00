"""

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and
prints ONE JSON line. Each operation is fully executed with a ``noop`` write
(whole plan, no collect), warmed up once, timed as the median of
$BENCH_REPEAT runs. Input rendering (text / XML files) happens before timing.
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from loadkit import harness as H  # noqa: E402
from loadkit.session import build_session, scratch_path  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    fn()  # warm-up
    ts = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="loadkit-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "4g")})
    from loadkit.contracts import AuditColumns
    from loadkit.operators.changes import classify_changes
    from loadkit.operators.ledger import LEDGER_SCHEMA, discover_files, stage_new_files
    from loadkit.operators.upsert import upsert_frame
    from loadkit.sources.delimited import load_delimited, render_delimited
    from loadkit.sources.xml import load_xml_recordsets

    q: dict[str, float] = {}

    # 1. classify an orders change set
    def classify():
        tgt, src = H.orders_change_set(spark, sf_dir)
        run(classify_changes(src, tgt, ["o_orderkey"]))
    q["classify_orders"] = timed(classify, repeat)

    # 2. upsert with soft delete on lineitem (composite key)
    li = H.lineitem_typed(spark, sf_dir)
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    tgt = H.with_seed_audit(li.filter(H.in_target(k))).withColumn("del_flag", F.lit("N"))
    src = li.filter(k % 7 != 0).withColumn(
        "l_quantity", F.when(k % 5 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")).cast("decimal(15,2)"))
    aud = AuditColumns("ins_ts", "ins_by", "upd_ts", "upd_by")
    q["upsert_soft_delete_lineitem"] = timed(lambda: run(upsert_frame(
        tgt, src, H.LINEITEM_KEYS, aud, "B1", H.RUN_TS, delete_flag_col="del_flag", detect_deletes=True)), repeat)

    # 3. exact (null-safe) compare against the legacy hash, lineitem
    for mode in ("exact", "legacy_hash"):
        q[f"compare_{mode}_lineitem"] = timed(
            lambda m=mode: run(classify_changes(src, tgt.drop("del_flag", "ins_ts", "ins_by", "upd_ts", "upd_by"),
                                                H.LINEITEM_KEYS, compare=m)), repeat)

    # 4. delimited load: lineitem as pipe text, 1 file vs 16 files, multiline on vs off
    text = H.table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("string") for c in
                                                      H.table(spark, sf_dir, "lineitem").columns])
    cols = [(f"_c{i}", c, "string") for i, c in enumerate(text.columns)]
    contract = H._contract("lineitem_pipe", cols, sep="|", quote='"', multiline=True)
    for n in (1, 16):
        path = render_delimited(text, scratch_path(spark, f"bench_li_{n}"), sep="|", files=n)
        for ml in (True, False):
            q[f"delimited_{n}file{'s' if n > 1 else ''}_multiline_{'on' if ml else 'off'}"] = timed(
                lambda p=path, m=ml: run(load_delimited(spark, p, contract, multiline=m)), repeat)

    # 5. XML flatten: orders + lineitem documents, 1 file vs 64 files
    for n in (1, 64):
        path = H.render_order_documents(spark, sf_dir, scratch_path(spark, f"bench_xml_{n}"), files=n)
        # one large file is read split: its contract declares the text that ends each document
        xml = H.order_xml_contract() if n > 1 else dataclasses.replace(H.order_xml_contract(), documents_end_with="</DOC>")

        def flatten(p=path, xml=xml):
            sets = load_xml_recordsets(spark, p, xml)
            run(sets["orders"])
            run(sets["lines"])
        q[f"xml_flatten_{n}file{'s' if n > 1 else ''}"] = timed(flatten, repeat)

    # 6. stage new files: events as a listing against a ledger holding a third of them
    listing, rules = H.events_listing(spark, sf_dir)
    disc = discover_files(listing, rules)
    ledger_path = scratch_path(spark, "bench_ledger")
    stage_new_files(disc.filter(F.col("src_entity_size") % 3 == 0),
                    spark.createDataFrame([], LEDGER_SCHEMA), H.SEED_TS).write.parquet(ledger_path)
    ledger = spark.read.parquet(ledger_path)
    q["stage_new_files_events"] = timed(lambda: run(stage_new_files(disc, ledger, H.RUN_TS)), repeat)

    total = round(sum(q.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in q.items()},
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": int(cpus),
                      "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
