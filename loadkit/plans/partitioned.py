"""K5/C8 on a partitioned Parquet folder: only touched partitions are read and rewritten.

The partitions that a change set touches are those its rows belong to and those where its
keys lie now (a narrow scan of the key columns, left out where the keys hold the partition
columns). They are few values, so they become a filter on the partition columns: the scan
prunes every other folder. The merged partitions are written beside the table first, then
over it with dynamic partition overwrite, so the files of all other partitions stay as
they are. A driver that dies in between leaves the written partitions and their plan; the
next load on the table finishes them before it starts (same rows, so twice is harmless).

One writer per table. Readers see single partitions change one after the other while a
load is being published; a snapshot table is the form with one visible step.
"""

from __future__ import annotations

import datetime as _dt
import json
import re
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.contracts import AuditColumns, ContractError
from loadkit.functions.exprs import resolve_columns
from loadkit.operators.conform import conform
from loadkit.operators.upsert import ACTION_COL, DELETE, INSERT, RESTORE, UPDATE, match_values, upsert_frame
from loadkit.session import observed, scratch_path

MAX_TOUCHED = 10_000     # partition values kept as a filter; a change set with more reads the whole table
META = "_loadkit"        # a name that Spark's readers leave out


def partition_filter(cols: Sequence[str], values: Sequence) -> Column:
    """Rows of the given partitions (NULL is a value); one column becomes a plain IN."""
    if not values:
        return F.lit(False)
    if len(cols) == 1:
        own = [v[0] for v in values if v[0] is not None]
        cond = F.col(cols[0]).isin(own) if own else F.lit(False)
        return cond | F.col(cols[0]).isNull() if len(own) < len(values) else cond
    same = lambda v: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(x)) for c, x in zip(cols, v)])
    return reduce(lambda a, b: a | b, [same(v) for v in values])


class PartitionedTable:
    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str]):
        self.spark, self.root, self.partition_by = spark, root.rstrip("/"), list(partition_by)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ small files beside the data
    def _has(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.root}/{META}/{name}"))

    def _get(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.root}/{META}/{name}"))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(f"{self.root}/{META}/{name}"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    # ------------------------------------------------------------ read / create
    def exists(self) -> bool:
        return self._has("schema.json")

    def files(self) -> DataFrame:
        """``path, length`` of the data files (a distributed listing)."""
        return (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                .load(self.root).select("path", "length"))

    def create(self, df: DataFrame) -> None:
        """First content; the schema is kept, as folder names alone do not tell types."""
        if self.exists():
            raise ContractError(f"{self.root} holds a table already")
        parts = resolve_columns(df, self.partition_by)
        self._spread(df, parts).write.mode("overwrite").partitionBy(*parts).parquet(self.root)
        self._put("schema.json", df.schema.json())

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self._get("schema.json")))

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no table under {self.root}")
        self.finish_pending()
        return self._read()

    def _read(self) -> DataFrame:
        s = self.schema()
        return self.spark.read.schema(s).parquet(self.root).select(*s.names)

    @staticmethod
    def _spread(df: DataFrame, parts: list[str]) -> DataFrame:
        """Files of moderate size: adaptive execution joins small partitions and splits
        those far above its advisory size, whatever share of the rows they hold."""
        return df.hint("rebalance", *parts)

    # ------------------------------------------------------------ publish
    def _run_name(self, run_id: str) -> str:
        return re.sub(r"[^A-Za-z0-9_.-]", "_", run_id)

    def committed(self, run_id: str) -> bool:
        return self._has(f"runs/{self._run_name(run_id)}")

    def hook_done(self, run_id: str) -> bool:
        return self._has(f"hooks/{self._run_name(run_id)}")

    def mark_hook_done(self, run_id: str) -> None:
        self._put(f"hooks/{self._run_name(run_id)}", "")

    def finish_pending(self) -> None:
        """Publish what a load wrote before its driver died."""
        at = self._path(f"{self.root}/{META}/pending")
        if not self._fs.exists(at):
            return
        for st in self._fs.listStatus(at):
            name = st.getPath().getName()
            if self._has(f"pending/{name}/plan.json"):
                self._publish(name)
            else:
                self._fs.delete(st.getPath(), True)     # never complete: nothing of it is visible

    def _publish(self, name: str) -> None:
        plan = json.loads(self._get(f"pending/{name}/plan.json"))
        schema = self.schema()
        body = self.spark.read.schema(schema).parquet(f"{self.root}/{META}/pending/{name}/data")
        (body.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*plan["partition_by"]).parquet(self.root))
        for folder in plan["emptied"]:
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)
        self._put(f"runs/{name}", json.dumps(plan["metrics"]))
        self._fs.delete(self._path(f"{self.root}/{META}/pending/{name}"), True)

    # ------------------------------------------------------------ upsert
    def upsert(self, src: DataFrame, keys: Sequence[str], audit: AuditColumns, load_id: str, run_ts: _dt.datetime, run_id: str,
               delete_flag_col: str | None = None, detect_deletes: bool = False, delete_scope: str = "table",
               compare: str = "exact", on_reappear: str = "restore", key_exprs: dict[str, str] | None = None) -> dict:
        """Apply ``src`` and publish; returns the counts of the load, among them the
        partitions touched. A run that is committed already does nothing."""
        tgt = self.read()
        if self.committed(run_id):
            return {}
        name = self._run_name(run_id)
        parts, tkeys = resolve_columns(tgt, self.partition_by), resolve_columns(tgt, keys)
        keep_out = resolve_columns(tgt, audit.names() + ([delete_flag_col] if detect_deletes and delete_flag_col else []))
        if {p.lower() for p in parts} & {c.lower() for c in keep_out}:
            raise ContractError("a table is not partitioned by audit columns", parts)
        staged = scratch_path(self.spark, "changes")
        conformed = conform(src, tgt.schema, exclude=keep_out)
        conformed.write.parquet(staged)           # read for the touched partitions and for the merge
        s = self.spark.read.schema(conformed.schema).parquet(staged)

        covered = s.select(*parts).distinct()
        touched = covered
        if key_exprs or not {p.lower() for p in parts} <= {k.lower() for k in tkeys}:
            match = [f"_k_{i}" for i in range(len(tkeys))]
            value = lambda df: df.alias("x").select("x.*", *[v.alias(m) for m, v in zip(match, match_values(tkeys, key_exprs, "x"))])
            at = value(tgt.select(*dict.fromkeys([*tkeys, *parts]))).join(value(s.select(*tkeys)).select(*match), match, "left_semi")
            touched = covered.unionByName(at.select(*parts)).distinct()
        whole = detect_deletes and delete_scope == "table"
        found = [] if whole else touched.limit(MAX_TOUCHED + 1).collect()
        whole = whole or len(found) > MAX_TOUCHED
        if not whole and not found:
            self._put(f"runs/{name}", "{}")       # no row to apply
            return {k: 0 for k in ("rows_rewritten", "n_insert", "n_update", "n_delete", "n_restore", "partitions_touched")}
        current = tgt if whole else tgt.filter(partition_filter(parts, found))
        scope = None
        if detect_deletes and delete_scope == "partitions":
            inside = covered.limit(MAX_TOUCHED + 1).collect()
            if len(inside) > MAX_TOUCHED:
                raise ContractError(f"delete detection over more than {MAX_TOUCHED} partitions: use the scope of the table")
            scope = partition_filter(parts, inside)
        new = upsert_frame(current, s, tkeys, audit, load_id, run_ts, delete_flag_col=delete_flag_col, detect_deletes=detect_deletes,
                           compare=compare, on_reappear=on_reappear, key_exprs=key_exprs, delete_scope=scope)
        a = F.col(ACTION_COL)
        obs = Observation(f"parts_{name}")
        count = lambda v: F.sum(F.when(a == v, 1).otherwise(0)).cast("long")
        body = new.observe(obs, F.count(F.lit(1)).alias("rows_rewritten"), count(INSERT).alias("n_insert"), count(UPDATE).alias("n_update"),
                           count(DELETE).alias("n_delete"), count(RESTORE).alias("n_restore")).drop(ACTION_COL)
        data = f"{self.root}/{META}/pending/{name}/data"
        self._spread(body, parts).write.mode("overwrite").partitionBy(*parts).parquet(data)
        metrics = observed(obs, "rows_rewritten", "n_insert", "n_update", "n_delete", "n_restore")
        before, after = self._folders(current, self.root), self._folders(self.spark.read.schema(tgt.schema).parquet(data), data)
        metrics["partitions_touched"] = len(before | after)
        # a partition whose last row moved away is not in the new data: its folder goes
        self._put(f"pending/{name}/plan.json", json.dumps({"partition_by": parts, "emptied": sorted(before - after), "metrics": metrics}))
        self._publish(name)
        return metrics

    def _folders(self, df: DataFrame, root: str) -> set[str]:
        """Partition folders that ``df`` reads, below ``root`` (one row a partition)."""
        depth = len(self.partition_by)
        folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1 - depth)
        parts = F.concat_ws("/", F.slice(F.split(F.col("_metadata.file_path"), "/"), -1 - depth, depth)) if depth > 1 else folder
        raw = [r[0] for r in df.select(parts.alias("p")).distinct().collect()]
        uri = self.spark.sparkContext._jvm.java.net.URI
        return {uri(f"file:/{p}").getPath()[1:] for p in raw}     # as the file system names them
