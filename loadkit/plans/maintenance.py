"""Maintenance decided from events and file statistics, and logged as events.

For every table one distributed listing gives files and mean size; the log gives the last
good maintenance. A table is *worn* when it has many small files and *due* when its last
good run is older than the policy's days, or there is none. The decision is a join of the
two frames; a table that is worn and due is compacted between a ``started`` and a
``success`` or ``failed`` event, any other gets a ``skipped`` event with the reason. The
log is append-only, so a run that dies leaves its ``started`` event and the table due.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.operators.audit import maintenance_due
from loadkit.plans.snapshots import SnapshotTable

STARTED, SUCCESS, FAILED, SKIPPED = "started", "success", "failed", "skipped"
EVENTS = ("table_name string, run_id string, status string, start_time timestamp_ntz, files_before long, files_after long, "
          "rewritten_files long, expired_versions long, message string")


@dataclass(frozen=True)
class MaintenancePolicy:
    """Worn: more than ``max_files`` data files of mean size below ``min_mean_bytes``. Due:
    no success within ``every_days``. Versions beyond ``min_keep`` older than
    ``max_age_days`` are expired."""

    max_files: int = 200
    min_mean_bytes: int = 32 << 20
    target_file_bytes: int = 128 << 20
    min_keep: int = 30
    max_age_days: float = 3.0
    every_days: int = 7


class MaintenanceLog:
    """Append-only events below ``root``, one folder per append."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path(self.root))

    def read(self) -> DataFrame:
        return self.spark.read.schema(EVENTS).option("recursiveFileLookup", "true").parquet(self.root)

    def append(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.parquet(f"{self.root}/{uuid.uuid4().hex}")

    def add(self, table_name: str, run_id: str, status: str, when: _dt.datetime, before: int | None = None, after: int | None = None,
            rewritten: int | None = None, expired: int | None = None, message: str | None = None) -> None:
        self.append(self.spark.createDataFrame([(table_name, run_id, status, when, before, after, rewritten, expired, message)], EVENTS))


def decide(stats: DataFrame, events: DataFrame, as_of: _dt.datetime, policy: MaintenancePolicy) -> DataFrame:
    """``stats`` (``table_name, n_files, mean_bytes``) with ``last_success, due, worn, action``
    and the reason where the action is ``skip``."""
    due = maintenance_due(events, as_of, policy.every_days, tables=stats).select("table_name", "last_success", "due")
    worn = (F.col("n_files") > policy.max_files) & (F.col("mean_bytes") < policy.min_mean_bytes)
    out = stats.join(due, "table_name").withColumn("worn", worn)
    why = F.when(~F.col("worn"), "conditions not met").when(~F.col("due"), "not due yet")
    return out.withColumn("reason", why).withColumn("action", F.when(F.col("reason").isNull(), "maintain").otherwise("skip"))


def maintain(spark: SparkSession, tables: dict[str, SnapshotTable], log: MaintenanceLog, policy: MaintenancePolicy,
             as_of: _dt.datetime, run_id: str) -> dict[str, dict]:
    """Run the flow for ``tables``; what was done with each. A table whose maintenance
    fails is logged as failed and does not keep the others from theirs."""
    stats = reduce(DataFrame.unionByName, [t.file_stats().withColumn("table_name", F.lit(n)) for n, t in tables.items()])
    found = decide(stats, log.read(), as_of, policy).collect()       # a row a table
    skipped = [(r["table_name"], run_id, SKIPPED, as_of, r["n_files"], r["n_files"], 0, 0, r["reason"]) for r in found if r["action"] == "skip"]
    if skipped:
        log.append(spark.createDataFrame(skipped, EVENTS))
    out = {r["table_name"]: {"action": "skip", "reason": r["reason"], "compacted": False, "expired": 0} for r in found if r["action"] == "skip"}
    for r in found:
        if r["action"] != "maintain":
            continue
        name, table, before = r["table_name"], tables[r["table_name"]], r["n_files"]
        log.add(name, run_id, STARTED, as_of, before)
        try:
            table.compact(policy.target_file_bytes, run_id=f"{run_id}:compact")
            after = table.file_stats().first()["n_files"]
            expired = len(table.expire(policy.min_keep, policy.max_age_days))
            log.add(name, run_id, SUCCESS, as_of, before, after, before, expired)
            out[name] = {"action": "maintain", "reason": None, "compacted": True, "expired": expired, "files_before": before, "files_after": after}
        except Exception as e:
            log.add(name, run_id, FAILED, as_of, before, message=str(e)[:500])
            out[name] = {"action": "failed", "reason": str(e), "compacted": False, "expired": 0}
    return out
