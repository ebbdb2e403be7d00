"""Run a target load or a feed load end to end.

``run_load``: audit start -> build source -> conform -> pre SQL -> upsert or
append -> publish one snapshot (counts gathered during the write) -> post SQL
-> audit end, with the failure event written in ``finally``-style handling.
``load_feed``: ledger selection -> one multi-file scan -> publish -> ledger
status write-back. ``load_many`` runs feeds in order and stops at the first
failure. Targets are snapshot-table folders (``/`` in the name) or catalog
tables.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.contracts import ContractError, FeedContract, LoadSpec, validate_target_columns
from loadkit.functions.exprs import ntz_literal, substitute
from loadkit.operators.audit import JobAudit, MessageLog
from loadkit.operators.ledger import (FAILED, LEDGER_KEY, LEDGER_SCHEMA, LOAD, SKIPPED, SUCCESS, discover_files, entity_rules,
                                      select_files, skip_others, stage_new_files)
from loadkit.operators.upsert import ACTION_COL, DELETE, INSERT, RESTORE, UPDATE, append_rows, match_values, merge_into, upsert_frame
from loadkit.plans.event_ledger import Book, EventLedger
from loadkit.plans.maintenance import MaintenanceLog, MaintenancePolicy, maintain
from loadkit.plans.partitioned import PartitionedTable
from loadkit.plans.snapshots import SnapshotTable
from loadkit.session import observed, scratch_path
from loadkit.sources.delimited import SOURCE_FILE, file_outcomes, load_delimited, plain_path
from loadkit.sources.listing import list_files, normalise_paths
from loadkit.sources.tables import read_source


def run_maintenance(table: SnapshotTable, policy: MaintenancePolicy, run_id: str) -> dict:
    out = {"compacted": False, "expired": 0}
    if table.needs_compaction(policy.max_files, policy.min_mean_bytes):
        table.compact(policy.target_file_bytes, run_id=f"{run_id}:compact")
        out["compacted"] = True
    out["expired"] = len(table.expire(policy.min_keep, policy.max_age_days))
    return out


@dataclass
class LoadResult:
    run_id: str
    status: str
    metrics: dict = field(default_factory=dict)
    snapshot: object = None
    message: str | None = None


def _is_path(ref: str) -> bool:
    return "/" in ref or ref.startswith("file:")


def _view_name(prefix: str, run_id: str) -> str:
    return f"{prefix}_{re.sub(r'[^A-Za-z0-9_]', '_', run_id)}"


def run_sql_hook(spark: SparkSession, sql: str | None, names: dict[str, str]) -> None:
    """Pre/post SQL (X3/X4): placeholders ``<<source>>``/``<<target>>`` become
    validated view names; statements separated by ``;`` run in order."""
    if not sql:
        return
    for stmt in [s.strip() for s in substitute(sql, names).split(";") if s.strip()]:
        spark.sql(stmt)


def run_load(spark: SparkSession, spec: LoadSpec, run_id: str, run_ts: _dt.datetime,
             audit_sink=None, job_name: str | None = None,
             maintenance: MaintenancePolicy | None = None, message_sink=None,
             maintenance_log: MaintenanceLog | None = None) -> LoadResult:
    """Apply ``spec`` once, then the maintenance check: with a log the whole flow
    (`loadkit.plans.maintenance`: is it due, decision and outcome as events), without one
    compaction whenever the files ask for it. Raises on invalid
    configuration or data (after writing the failed audit event). Run messages
    (K16) are buffered and appended once through ``message_sink``, also on failure."""
    log = MessageLog(run_id)
    log.log("info", f"load {spec.load_id} ({spec.strategy}) into {spec.target} started")
    try:
        bad = spec.validate()
        if bad:
            raise ContractError(f"load {spec.load_id} is invalid", bad)
        audit = (JobAudit(spark, run_id, job_name or spec.load_name or spec.load_id, audit_sink)
                 if audit_sink else contextlib.nullcontext())
        with audit as a:
            result = _run_load(spark, spec, run_id, run_ts)
            if a is not None:
                m = result.metrics
                a.counters.rows_read = m.get("rows_read")
                a.counters.rows_new = m.get("n_insert")
                a.counters.rows_changed = m.get("n_update")
                a.counters.rows_deleted = m.get("n_delete")
        log.log("info", f"load {spec.load_id} completed: {result.metrics}")
        if maintenance is not None and _is_path(spec.target) and result.snapshot is not None:
            if maintenance_log is not None:
                name = spec.load_name or spec.target
                result.metrics["maintenance"] = maintain(spark, {name: SnapshotTable(spark, spec.target)}, maintenance_log, maintenance, run_ts, run_id)[name]
            else:
                result.metrics.update(run_maintenance(SnapshotTable(spark, spec.target), maintenance, run_id))
            log.log("info", "maintenance checked")
        return result
    except Exception as e:
        log.log("error", f"load {spec.load_id} failed: {e}")
        raise
    finally:
        if message_sink is not None:
            message_sink(log.frame(spark))


def _run_load(spark: SparkSession, spec: LoadSpec, run_id: str, run_ts: _dt.datetime) -> LoadResult:
    snap_target = _is_path(spec.target)
    partitioned = snap_target and bool(spec.partition_by)
    table = (PartitionedTable(spark, spec.target, spec.partition_by) if partitioned else SnapshotTable(spark, spec.target)) if snap_target else None
    if snap_target:
        if not table.exists():
            raise ContractError(f"target {spec.target} has no committed snapshot")
        if table.committed(run_id):
            return _replayed(spark, spec, table, run_id)
        tgt = table.read()
    else:
        if not spark.catalog.tableExists(spec.target):
            raise ContractError(f"target table {spec.target} does not exist")
        table = CatalogRuns(spark, spec.target)
        if table.committed(run_id) or (spec.strategy == "insert" and _inserted(spark, spec, run_ts)):
            return _replayed(spark, spec, table, run_id)
        tgt = spark.table(spec.target)
    bad = validate_target_columns(tgt.columns, spec)
    if bad:
        raise ContractError(f"target {spec.target} does not fit the load", bad)
    src = read_source(spark, spec.source, spec.source_type)
    split = {}
    if spec.rejects:
        src, split = split_rejects(spark, src, tgt.schema, _not_in_source(spec), spec.rejects, run_id)
    src_view, tgt_view = _view_name("loadkit_source", run_id), _view_name("loadkit_target", run_id)
    if spec.strategy == "merge":
        # hooks see the classified source (record_status), a lazy view that only
        # runs if a hook reads it
        from loadkit.operators.changes import classify_changes
        from loadkit.operators.conform import conform
        excl = _not_in_source(spec)
        classify_changes(conform(src, tgt.schema, exclude=excl), tgt, spec.keys, compare=spec.compare,
                         key_exprs=spec.key_exprs).createOrReplaceTempView(src_view)
    else:
        src.createOrReplaceTempView(src_view)
    tgt.createOrReplaceTempView(tgt_view)
    names = {"source": src_view, "target": tgt_view if snap_target else spec.target}
    run_sql_hook(spark, spec.pre_sql, names)

    if spec.strategy == "merge":
        from pyspark.sql import Observation
        src_obs = Observation(f"src_{_view_name('', run_id)}")
        no_key = F.lit(False)
        own = conform_names(src, spec.keys)
        for v in match_values(own, spec.key_exprs, "incoming"):
            no_key = no_key | v.isNull()
        src = src.alias("incoming")
        observed_src = src.observe(src_obs, F.count(F.lit(1)).alias("rows_read"),
                                   F.sum(F.when(no_key, 1).otherwise(0)).cast("long").alias("rows_without_key"))
        if spec.quarantine:
            quarantine = SnapshotTable(spark, spec.quarantine)
            quarantine.write(src.filter(no_key).withColumn("_run_id", F.lit(run_id)), run_id=run_id, mode="append")
        if partitioned:
            metrics = table.upsert(observed_src, spec.keys, spec.audit, spec.load_id, run_ts, run_id, spec.delete_flag_col, spec.detect_deletes,
                                   spec.delete_scope, spec.compare, spec.on_reappear, spec.key_exprs)
            return _after_publish(spark, spec, table, run_id, names, tgt_view, {**metrics, **observed(src_obs, "rows_read", "rows_without_key"), **split}, None)
        new = upsert_frame(tgt, src if spec.native_merge else observed_src, spec.keys, spec.audit, spec.load_id, run_ts,
                           delete_flag_col=spec.delete_flag_col, detect_deletes=spec.detect_deletes,
                           compare=spec.compare, on_reappear=spec.on_reappear, key_exprs=spec.key_exprs)
        a = F.col(ACTION_COL)
        cnt = lambda v: F.sum(F.when(a == v, 1).otherwise(0)).cast("long")
        observe = {"rows_total": F.count(F.lit(1)), "n_insert": cnt(INSERT), "n_update": cnt(UPDATE),
                   "n_delete": cnt(DELETE), "n_restore": cnt(RESTORE)}
        if snap_target:
            from pyspark.sql import Observation
            obs = Observation(f"merge_{_view_name('', run_id)}")
            body = new.observe(obs, *[c.alias(n) for n, c in observe.items()]).drop(ACTION_COL)
            body = leave_out(spark, spec, body, run_id)
            snap, kept = table.write(body, run_id=run_id, observe={"rows_kept": F.count(F.lit(1))} if spec.removes_rows() else None)
            metrics = observed(obs, *observe)
            if kept:
                metrics |= kept | {"rows_removed": metrics["rows_total"] - kept["rows_kept"]}
        elif spec.native_merge:
            # a row-level statement reports no counts: they are taken from the frames before it
            metrics = new.agg(*[c.alias(n) for n, c in observe.items()]).first().asDict()
            metrics |= src.agg(F.count(F.lit(1)).alias("rows_read"), F.sum(F.when(no_key, 1).otherwise(0)).cast("long").alias("rows_without_key")).first().asDict()
            merge_into(src, spec.target, tgt.schema, spec.keys, spec.audit, spec.load_id, run_ts, spec.delete_flag_col,
                       spec.detect_deletes, spec.on_reappear, spec.key_exprs).merge()
            snap = None
        else:
            snap, metrics = None, _overwrite_catalog(spark, spec.target, new, observe)
        if not spec.native_merge:
            metrics.update(observed(src_obs, "rows_read", "rows_without_key"))
        metrics.update(split)
    elif spec.strategy == "insert":
        rows = append_rows(tgt.schema, src, spec.audit, spec.load_id, run_ts)
        observe = {"n_insert": F.count(F.lit(1))}
        if snap_target:
            snap, metrics = table.write(rows, run_id=run_id, observe=observe, mode="append")
            metrics["rows_read"] = metrics.get("n_insert")
        else:
            from pyspark.sql import Observation
            obs = Observation(f"ins_{_view_name('', run_id)}")
            rows.observe(obs, *[c.alias(n) for n, c in observe.items()]).write.insertInto(spec.target)
            snap, metrics = None, dict(obs.get)
            metrics["rows_read"] = metrics.get("n_insert")
        metrics.update(split)
    else:  # validated above; kept for safety
        raise ContractError(f"unknown update strategy {spec.strategy!r}")
    if not snap_target:
        table.mark_committed(run_id)
    return _after_publish(spark, spec, table, run_id, names, tgt_view, metrics, snap)


def _after_publish(spark: SparkSession, spec: LoadSpec, table, run_id: str, names: dict, tgt_view: str, metrics: dict, snap) -> LoadResult:
    table.read().createOrReplaceTempView(tgt_view)   # the post hook sees the version just committed
    if spec.post_sql:
        run_sql_hook(spark, spec.post_sql, names)
        table.mark_hook_done(run_id)
    # the run-scoped views stay registered: hooks may have defined views over them
    return LoadResult(run_id, "completed", metrics, snap)


def _not_in_source(spec: LoadSpec) -> list[str]:
    """Target columns that a source does not bring."""
    return spec.audit.names() + ([spec.delete_flag_col] if spec.detect_deletes else [])


def split_rejects(spark: SparkSession, src: DataFrame, tgt_schema, exclude: list[str], path: str, run_id: str) -> tuple[DataFrame, dict]:
    """One pass over the source writes its rows conformed, apart by whether every
    value could be cast. Rows with one that could not are appended to the reject table
    (the row as it came, the columns at fault, the run) and not loaded. Returns the others
    and the counts taken during the pass."""
    import uuid

    from pyspark.sql import Observation
    from pyspark.sql import types as T

    from loadkit.operators.conform import conform
    whole = T.StructType([*tgt_schema.fields, T.StructField("_source", T.StringType())])
    told = src.withColumn("_source", F.to_json(F.struct(*[F.col(f"`{c}`") for c in src.columns]), {"ignoreNullFields": "false"}))
    rows = conform(told, whole, exclude=exclude, error_col="_failed").withColumn("_rejected", F.size("_failed") > 0)
    obs = Observation(f"split_{uuid.uuid4().hex[:8]}")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("rows_offered"), F.sum(F.col("_rejected").cast("long")).alias("rows_rejected"),
                        F.sum(F.size("_failed")).cast("long").alias("cells_rejected"))
    at = scratch_path(spark, "conformed")
    rows.write.partitionBy("_rejected").parquet(at)
    held = spark.read.schema(rows.schema).parquet(at)
    bad = held.filter("_rejected").select(F.lit(run_id).alias("run_id"), F.col("_failed").alias("failed_columns"), F.col("_source").alias("source_row"))
    SnapshotTable(spark, path).write(bad, run_id=run_id, mode="append")
    counts = observed(obs, "rows_offered", "rows_rejected", "cells_rejected")
    return held.filter("not _rejected").drop("_rejected", "_failed", "_source"), counts


def leave_out(spark: SparkSession, spec: LoadSpec, new: DataFrame, run_id: str) -> DataFrame:
    """The rows of the new content that stay: without those that meet
    ``delete_where`` (a predicate, perhaps with a subquery) and those whose keys are in
    ``delete_keys`` (an anti join). Part of the load's own commit."""
    if spec.delete_keys is not None:
        kind = "callable" if callable(spec.delete_keys) or isinstance(spec.delete_keys, DataFrame) else "query"
        gone = read_source(spark, spec.delete_keys, kind)
        keys = conform_names(new, spec.keys)
        new = new.join(gone.select(*[F.col(f"`{g}`").cast(new.schema[k].dataType).alias(k) for g, k in zip(conform_names(gone, spec.keys), keys)]).distinct(),
                       keys, "left_anti")
    if spec.delete_where:
        view = _view_name("loadkit_new", run_id)
        new.createOrReplaceTempView(view)
        names = {"source": _view_name("loadkit_source", run_id), "target": view}
        new = spark.sql(f"SELECT * FROM {view} WHERE NOT coalesce(({substitute(spec.delete_where, names)}), false)")
    return new


class CatalogRuns:
    """Run ids that a catalog table has taken in, and whether their post hook is done: a
    table property that remembers the latest ``KEPT`` runs."""

    PROPERTY, KEPT = "loadkit.runs", 200

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def _runs(self) -> dict[str, str]:
        held = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        return json.loads(held.get(self.PROPERTY) or "{}")

    def _mark(self, run_id: str, state: str) -> None:
        runs = {k: v for k, v in self._runs().items() if k != run_id} | {run_id: state}
        text = json.dumps(dict(list(runs.items())[-self.KEPT:])).replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"ALTER TABLE {self.name} SET TBLPROPERTIES ('{self.PROPERTY}' = '{text}')")

    def committed(self, run_id: str) -> bool:
        return run_id in self._runs()

    def mark_committed(self, run_id: str) -> None:
        self._mark(run_id, "committed")

    def hook_done(self, run_id: str) -> bool:
        return self._runs().get(run_id) == "hook done"

    def mark_hook_done(self, run_id: str) -> None:
        self._mark(run_id, "hook done")


def _inserted(spark: SparkSession, spec: LoadSpec, run_ts: _dt.datetime) -> bool:
    """Whether the target holds rows of this very insert (its audit columns tell), as after
    a crash between the insert and the note of it."""
    t = spark.table(spec.target)
    ts, by = conform_names(t, [spec.audit.insert_ts, spec.audit.insert_by])
    own = (F.col(by) == F.lit(spec.load_id).cast(t.schema[by].dataType)) & (F.col(ts) == ntz_literal(run_ts).cast(t.schema[ts].dataType))
    return not t.filter(own).limit(1).isEmpty()


def _replayed(spark: SparkSession, spec: LoadSpec, table: SnapshotTable | PartitionedTable | CatalogRuns, run_id: str) -> LoadResult:
    """A run that is committed already writes nothing; a post hook that did not finish
    runs now, on the committed table and the source as it is."""
    if spec.post_sql and not table.hook_done(run_id):
        src_view, tgt_view = _view_name("loadkit_source", run_id), _view_name("loadkit_target", run_id)
        read_source(spark, spec.source, spec.source_type).createOrReplaceTempView(src_view)
        table.read().createOrReplaceTempView(tgt_view)
        run_sql_hook(spark, spec.post_sql, {"source": src_view, "target": spec.target if isinstance(table, CatalogRuns) else tgt_view})
        table.mark_hook_done(run_id)
    return LoadResult(run_id, "completed", {}, None, "run already committed")


def conform_names(df: DataFrame, names) -> list[str]:
    """The frame's own spelling of ``names`` (matched without regard to case)."""
    own = {c.lower(): c for c in df.columns}
    return [own[n.lower()] for n in names]


def _overwrite_catalog(spark: SparkSession, name: str, new: DataFrame, observe: dict) -> dict:
    """Catalog target without MERGE: materialise the new content (lineage cut, so
    the table is no longer read) and overwrite it. Not atomic on plain tables."""
    from pyspark.sql import Observation
    obs = Observation(f"ovw_{abs(hash(name))}")
    body = new.observe(obs, *[c.alias(n) for n, c in observe.items()]).checkpoint(eager=True)
    metrics = dict(obs.get)
    body.drop(ACTION_COL).write.insertInto(name, overwrite=True)
    return metrics


def feed_policy(contract: FeedContract) -> str:
    if contract.extract_type == "full":
        return "full"
    if contract.extract_type == "incremental":
        return "incremental_all" if contract.load_all_incremental else "incremental_one"
    raise ContractError(f"unknown extract type {contract.extract_type!r}")


def stage_files(spark: SparkSession, root: str, system_key: str, systems: DataFrame, entities: DataFrame,
                ledger: SnapshotTable | EventLedger, run_ts: _dt.datetime) -> SnapshotTable | EventLedger:
    """List ``root``, match the entities' wildcards, append what the ledger lacks."""
    listing = normalise_paths(list_files(spark, root, system_key=system_key))
    files = ledger.files if isinstance(ledger, EventLedger) else ledger
    new = stage_new_files(discover_files(listing, entity_rules(systems, entities)), files.read_or_empty(LEDGER_SCHEMA), run_ts)
    files.write(new.select(*LEDGER_SCHEMA.names), mode="append")
    return ledger


FILES_PER_SCAN = 10_000   # paths that one scan (and the driver) holds at a time


def load_feed(spark: SparkSession, contract: FeedContract, ledger: SnapshotTable | EventLedger, raw: SnapshotTable,
              entity_key: str, run_id: str, multiline: bool | None = None,
              files_per_scan: int = FILES_PER_SCAN) -> LoadResult:
    """C3 + C4 + publish + K12/K13 for one feed.

    The chosen files are read in scans of ``files_per_scan``. A bad cell becomes NULL and
    its row stays (D5, D8); rows with one are counted per file. Only a contract that says
    ``reject_bad_files`` fails the file instead. Every chosen file gets an outcome, also
    one without rows. A version remembers the instance keys it published, so a run after
    a crash between publishing and the ledger update publishes no file twice (D35). An
    overwrite feed replaces the raw table only when at least one file was accepted. A path
    that was delivered again holds its newest content only: that instance is loaded, the
    older ones are skipped.

    With an `EventLedger` the files pass through ``started`` and, if the load itself
    breaks off, ``error``; every step is an append.
    """
    book = Book(ledger)
    sel = select_files(book.queue().filter(F.col("src_entity_key") == entity_key), feed_policy(contract))
    chosen_path = scratch_path(spark, "chosen_files")
    sel.write.parquet(chosen_path)
    sel = spark.read.schema(sel.schema).parquet(chosen_path)
    chosen = sel.filter(F.col("action") == LOAD)
    n = chosen.count()
    if not n:
        return LoadResult(run_id, "completed", {"n_files": 0}, None, "no file to load")
    book.started(chosen, run_id)
    try:
        return _load_chosen(spark, contract, book, raw, run_id, multiline, files_per_scan, sel, chosen, n)
    except Exception as e:
        book.broken(chosen, run_id, f"Error: {e}")
        raise


def _load_chosen(spark, contract, book, raw, run_id, multiline, files_per_scan, sel, chosen, n) -> LoadResult:
    metrics = {"n_files": n, "n_failed_files": 0, "rows_loaded": 0, "rows_rejected": 0}
    snap, updates, again = None, None, None
    for lo in range(0, n, files_per_scan):
        part = chosen.filter((F.col("load_seq") > lo) & (F.col("load_seq") <= lo + files_per_scan))
        keys = part.select(*LEDGER_KEY, plain_path(F.regexp_replace("src_entity_path", "%", "%25")).alias("_path"))
        held = {}
        for r in keys.collect():   # at most files_per_scan
            held[r["_path"]] = max(held.get(r["_path"], ""), r["src_entity_inst_key"])
        loaded = load_delimited(spark, [_escape(p) for p in held], contract, with_source_file=True, with_rejects=True, multiline=multiline)
        counts = file_outcomes(loaded).select(plain_path(F.col(SOURCE_FILE)).alias("_path"), "n_rows", "n_rejects", "n_null_cells")
        outcome = (keys.join(counts, "_path", "left").fillna(0, ["n_rows", "n_rejects"])
                   .withColumn("_bad", F.lit(contract.reject_bad_files) & (F.col("n_rejects") > 0)))
        told = outcome.collect()   # one row a file of this scan
        rows = [r for r in told if held[r["_path"]] == r["src_entity_inst_key"]]
        older = [r for r in told if held[r["_path"]] != r["src_entity_inst_key"]]
        outcome = spark.createDataFrame(rows, outcome.schema)
        good = {r["_path"]: r["src_entity_inst_key"] for r in rows if not r["_bad"]}
        offered = spark.createDataFrame([(k, p) for p, k in good.items()], "src_entity_inst_key string, _path string")
        unpublished = offered.join(raw.published(), "src_entity_inst_key", "left_anti")
        fresh = [r["_path"] for r in unpublished.collect()]
        if fresh:
            body = load_delimited(spark, [_escape(p) for p in fresh], contract, multiline=multiline)
            mode = "overwrite" if contract.load_type == "overwrite" and lo == 0 else "append"
            snap, m = raw.write(body, run_id=f"{contract.name}:{run_id}:{lo}", observe={"rows_loaded": F.count(F.lit(1))},
                                mode=mode, files=spark.createDataFrame([(good[p],) for p in fresh], "src_entity_inst_key string"))
            metrics["rows_loaded"] += m.get("rows_loaded", 0)
        metrics["n_failed_files"] += sum(r["_bad"] for r in rows)
        metrics["rows_rejected"] += sum(r["n_rejects"] for r in rows)
        told = F.concat(F.when(F.col("_bad"), "rejected: ").otherwise("loaded: "), F.col("n_rows").cast("string"), F.lit(" rows, "),
                        F.col("n_rejects").cast("string"), F.lit(" with a bad cell"))
        st = outcome.select(*LEDGER_KEY, F.when(F.col("_bad"), FAILED).otherwise(SUCCESS).alias("src_entity_load_status"),
                            told.alias("src_entity_load_mesg"), F.lit(run_id).alias("src_entity_load_run_id"), "n_rows")
        if older:
            replaced = spark.createDataFrame(older, outcome.schema).select(
                *LEDGER_KEY, F.lit(FAILED if book.is_events else SKIPPED).alias("src_entity_load_status"),
                F.lit("Skipped: the path was delivered again").alias("src_entity_load_mesg"), F.lit(run_id).alias("src_entity_load_run_id"),
                F.lit(None).cast("long").alias("n_rows"))
            again = replaced if again is None else again.unionByName(replaced)
        updates = st if updates is None else updates.unionByName(st)
    ok = metrics["n_failed_files"] < n
    skipped = skip_others(sel, run_id) if ok and feed_policy(contract) == "full" else None
    if again is not None:
        updates = updates.unionByName(again)
        if book.is_events:      # a started file fails before it can be skipped
            late = again.withColumn("src_entity_load_status", F.lit(SKIPPED)).drop("n_rows")
            skipped = late if skipped is None else skipped.unionByName(late)
    if skipped is not None and not book.is_events:
        updates, skipped = updates.unionByName(skipped, allowMissingColumns=True), None
    book.outcome(updates, run_id)
    if skipped is not None:
        book.outcome(skipped, run_id)
    return LoadResult(run_id, "completed" if not metrics["n_failed_files"] else "failed", metrics, snap)


def _escape(path: str) -> str:
    """A literal path for a reader that takes wildcards."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def load_xml_feed(spark: SparkSession, contract, ledger: SnapshotTable | EventLedger, staging: dict[str, SnapshotTable],
                  entity_key: str, run_id: str, files_per_scan: int = FILES_PER_SCAN) -> LoadResult:
    """Every queued XML file of an entity (oldest first), parsed once, ``files_per_scan``
    at a time. A file with a
    document that does not parse, or with none, is ``failed`` and contributes nothing;
    the others' record sets are appended to their staging tables stamped with the run id
    (earlier unconsumed runs stay, D36). A staging version remembers its files, so a
    rerun after a failure appends no file to a set twice."""
    missing = [rs.name for rs in contract.record_sets if rs.target_table and rs.name not in staging]
    if missing:
        raise ContractError(f"XML load of {entity_key} lacks staging tables", missing)
    book = Book(ledger)
    sel = select_files(book.queue().filter(F.col("src_entity_key") == entity_key), "xml")
    chosen_path = scratch_path(spark, "chosen_files")
    sel.filter(F.col("action") == LOAD).write.parquet(chosen_path)
    chosen = spark.read.schema(sel.schema).parquet(chosen_path)
    if chosen.isEmpty():
        return LoadResult(run_id, "completed", {"n_files": 0}, None, "no file to load")
    book.started(chosen, run_id)
    try:
        return _load_xml_chosen(spark, contract, book, staging, run_id, chosen, files_per_scan)
    except Exception as e:
        book.broken(chosen, run_id, f"Error: {e}")
        raise


def _load_xml_chosen(spark, contract, book, staging, run_id, chosen, files_per_scan) -> LoadResult:
    n, updates = chosen.count(), None
    metrics = {"n_files": n, "n_failed_files": 0} | {f"rows_{rs.name}": 0 for rs in contract.record_sets if rs.name in staging}
    for lo in range(0, n, files_per_scan):
        part = chosen.filter((F.col("load_seq") > lo) & (F.col("load_seq") <= lo + files_per_scan))
        st = _load_xml_part(spark, contract, staging, run_id, run_id if not lo else f"{run_id}:{lo}", part, metrics)
        updates = st if updates is None else updates.unionByName(st)
    book.outcome(updates, run_id)
    return LoadResult(run_id, "failed" if metrics["n_failed_files"] else "completed", metrics, None)


def _good_files(held: dict, rows: list) -> dict:
    """The paths of ``held`` all of whose rows are without a fault; an older delivery of a path
    that was delivered again tells what its newest one tells."""
    bad = {r["_path"] for r in rows if r["n_rejects"] or not r["n_documents"]}
    return {p: k for p, k in held.items() if p not in bad}


def _load_xml_part(spark, contract, staging, run_id, version, part, metrics) -> DataFrame:
    """One scan of files: append their record sets, count, return the files' outcomes."""
    from loadkit.sources.xml import SOURCE_FILE as XML_FILE
    from loadkit.sources.xml import document_outcomes, load_xml_recordsets
    key = "src_entity_inst_key string"
    keys = part.select(*LEDGER_KEY, plain_path(F.regexp_replace("src_entity_path", "%", "%25")).alias("_path"))
    held = {}
    for r in keys.collect():     # at most files_per_scan
        held[r["_path"]] = max(held.get(r["_path"], ""), r["src_entity_inst_key"])
    sets = load_xml_recordsets(spark, [_escape(p) for p in held], contract, with_source_file=True, documents=True)
    counts = document_outcomes(sets.pop("")).select(plain_path(F.col(XML_FILE)).alias("_path"), "n_documents", "n_rejects")
    outcome = keys.join(counts, "_path", "left").fillna(0, ["n_documents", "n_rejects"])
    rows = outcome.collect()     # one row a file
    outcome = spark.createDataFrame(rows, outcome.schema)
    good = _good_files(held, rows)
    metrics["n_failed_files"] += sum(r["_path"] not in good for r in rows)
    for name, df in sets.items():
        if name not in staging:
            continue
        offered = spark.createDataFrame([(k, p) for p, k in good.items()], f"{key}, _path string")
        fresh = {r["_path"]: r["src_entity_inst_key"] for r in offered.join(staging[name].published(), "src_entity_inst_key", "left_anti").collect()}
        if fresh:
            paths = spark.createDataFrame([(p,) for p in fresh], "_path string")
            body = (df.withColumn("_path", plain_path(F.col(XML_FILE))).join(paths, "_path", "left_semi")
                    .drop(XML_FILE, "_path").withColumn("_run_id", F.lit(run_id)))
            _, m = staging[name].write(body, run_id=version, observe={"rows": F.count(F.lit(1))}, mode="append",
                                       files=spark.createDataFrame([(k,) for k in fresh.values()], key))
            metrics[f"rows_{name}"] += m.get("rows", 0)
    bad = (F.col("n_rejects") > 0) | (F.col("n_documents") == 0)
    told = (F.when(F.col("n_documents") == 0, F.lit("rejected: no document"))
            .when(bad, F.concat(F.lit("rejected: "), F.col("n_rejects").cast("string"), F.lit(" unparsable documents")))
            .otherwise(F.concat(F.lit("loaded: "), F.col("n_documents").cast("string"), F.lit(" documents"))))
    return outcome.select(*LEDGER_KEY, F.when(bad, FAILED).otherwise(SUCCESS).alias("src_entity_load_status"),
                          told.alias("src_entity_load_mesg"), F.lit(run_id).alias("src_entity_load_run_id"), F.col("n_documents").alias("n_rows"))


def load_many(spark: SparkSession, feeds: list[tuple[FeedContract, SnapshotTable, str]], ledger: SnapshotTable | EventLedger,
              run_id: str, stop_at_failure: bool = True, parallel: int = 1) -> list[LoadResult]:
    """One result per feed that ran, in the order of ``feeds``.

    By default feeds run in order and the first failed one ends the run. With
    ``stop_at_failure=False`` feeds are independent: each commits its own outcome, one
    that breaks off is a failed result and the others still run, ``parallel`` of them side
    by side (an `EventLedger` only: its outcomes are appends)."""
    if parallel > 1 and not isinstance(ledger, EventLedger):
        raise ContractError("feeds side by side need an event ledger")
    if parallel > 1 and stop_at_failure:
        raise ContractError("feeds side by side cannot stop at the first failure")

    def one(i: int) -> LoadResult:
        contract, raw, entity = feeds[i]
        try:
            return load_feed(spark, contract, ledger, raw, entity, f"{run_id}.{i:03d}")
        except Exception as e:
            if stop_at_failure:
                raise
            return LoadResult(f"{run_id}.{i:03d}", "failed", {}, None, str(e))
    if parallel > 1:
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(parallel) as pool:     # threads hold a Spark job each, no data
            return list(pool.map(one, range(len(feeds))))
    out = []
    for i in range(len(feeds)):
        out.append(one(i))
        if stop_at_failure and out[-1].status != "completed":
            break
    return out


def merged_outcome(results: list[LoadResult], n_feeds: int) -> dict:
    """One outcome of a run of feeds: the worst status, and how many ran, failed, were not tried."""
    failed = sum(r.status != "completed" for r in results)
    return {"status": "failed" if failed else "completed", "n_completed": len(results) - failed, "n_failed": failed,
            "n_not_run": n_feeds - len(results)}
