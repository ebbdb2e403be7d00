"""Run-stamped Parquet snapshots: an all-or-nothing publish without a table format.

Layout: ``<root>/v=<seq>/`` holds the files one write added; a version is
visible only after its commit marker ``_LOADKIT_COMMIT`` is written, which
happens after Spark's job commit succeeded. A version is either an
``overwrite`` (complete table content) or an ``append`` (rows added on top);
the table is the latest overwrite plus the appends committed after it, read in
one scan. A run id already committed is not written twice, so re-running a
load after a crash cannot duplicate rows. Spark cannot overwrite a path it is reading, so every rewrite goes to a
fresh folder; older versions stay for rollback until ``expire`` removes them.
One writer per table; there is no transaction log or concurrency control.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadkit.session import observed

FILES = "_files"            # instance keys of the source files in a version, beside its rows
KEY = "src_entity_inst_key"
MARKER = "_LOADKIT_COMMIT"
HOOK_MARKER = "_LOADKIT_HOOK_DONE"
_VERSION = re.compile(r"^v=(\d{10})$")


@dataclass(frozen=True)
class Snapshot:
    seq: int
    path: str
    run_id: str | None
    committed_at: str | None
    mode: str = "overwrite"
    n_files: int = 0                    # source files whose instance keys are kept beside it


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jpath = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._jpath(self.root).getFileSystem(self._conf)
        self._known: dict[int, tuple[int, Snapshot]] = {}

    # ------------------------------------------------------------ metadata
    def _path(self, p: str):
        return self._jpath(p)

    def snapshots(self) -> list[Snapshot]:
        """Committed versions, oldest first: one listing of the markers; a marker is small,
        never changes, and is opened once by this object."""
        root = self._path(self.root)
        if not self._fs.exists(root):
            return []
        there = {}
        for st in self._fs.globStatus(self._path(f"{self.root}/v=*/{MARKER}")) or []:
            name = st.getPath().getParent().getName()
            if m := _VERSION.match(name):
                there[int(m.group(1))] = (name, st.getModificationTime())
        self._known = {k: v for k, v in self._known.items() if k in there and v[0] == there[k][1]}
        for seq in there.keys() - self._known.keys():
            name, written = there[seq]
            meta = self._read_text(f"{self.root}/{name}/{MARKER}")
            info = json.loads(meta) if meta else {}
            self._known[seq] = (written, Snapshot(seq, f"{self.root}/{name}", info.get("run_id"), info.get("committed_at"),
                                                  info.get("mode", "overwrite"), info.get("n_files", 0)))
        return [self._known[k][1] for k in sorted(self._known)]

    def latest(self) -> Snapshot | None:
        s = self.snapshots()
        return s[-1] if s else None

    def committed_runs(self) -> set[str]:
        return {s.run_id for s in self.snapshots() if s.run_id}

    def committed(self, run_id: str) -> bool:
        return run_id in self.committed_runs()

    def published(self) -> DataFrame:
        """``src_entity_inst_key`` of the source files that committed versions hold (a table
        to anti-join; it never passes through the driver)."""
        at = [f"{s.path}/{FILES}" for s in self.snapshots() if s.n_files]
        if not at:
            return self.spark.createDataFrame([], f"{KEY} string")
        return self.spark.read.schema(f"{KEY} string").parquet(*at).distinct()

    def hook_done(self, run_id: str) -> bool:
        """Whether the post-load hook of a committed run has finished."""
        return any(s.run_id == run_id and self._fs.exists(self._path(f"{s.path}/{HOOK_MARKER}")) for s in self.snapshots())

    def mark_hook_done(self, run_id: str) -> None:
        for s in self.snapshots():
            if s.run_id == run_id:
                self._write_text(f"{s.path}/{HOOK_MARKER}", "")

    def _read_text(self, p: str) -> str:
        stream = self._fs.open(self._path(p))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_text(self, p: str, text: str) -> None:
        out = self._fs.create(self._path(p), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def current_chain(self) -> list[Snapshot]:
        """Versions making up the table now: the latest overwrite and later appends."""
        chain = []
        for s in reversed(self.snapshots()):
            chain.append(s)
            if s.mode == "overwrite":
                break
        return list(reversed(chain))

    # ------------------------------------------------------------ read / write
    def exists(self) -> bool:
        return bool(self.current_chain())

    def read(self) -> DataFrame:
        chain = self.current_chain()
        if not chain:
            raise FileNotFoundError(f"no committed snapshot under {self.root}")
        return self.spark.read.parquet(*[s.path for s in chain])

    def read_since(self, seq: int) -> DataFrame:
        """Rows that versions after ``seq`` hold; columns that some lack are NULL there."""
        return self.spark.read.option("mergeSchema", "true").parquet(*[s.path for s in self.snapshots() if s.seq > seq])

    def read_or_empty(self, schema) -> DataFrame:
        if not self.current_chain():
            return self.spark.createDataFrame([], schema)
        return self.read()

    def write(self, df: DataFrame, run_id: str | None = None, observe: dict | None = None,
              repartition_by: list[str] | None = None, num_files: int | None = None,
              partition_cols: list[str] | None = None, mode: str = "overwrite",
              files: DataFrame | None = None) -> tuple[Snapshot, dict]:
        """Write ``df`` as the next version and commit it. ``observe`` maps metric
        names to aggregate Columns gathered during the same write (no extra pass).
        ``mode`` is ``overwrite`` (new complete content) or ``append``.
        ``files``: instance keys of the source files in it (one column), kept beside the version."""
        if mode not in ("overwrite", "append"):
            raise ValueError(f"unknown write mode {mode!r}")
        if run_id is not None:
            for s in self.snapshots():
                if s.run_id == run_id:
                    return s, {}     # already committed: nothing runs, nothing observed
        last = self.latest()
        seq = (last.seq if last else 0) + 1
        path = f"{self.root}/v={seq:010d}"
        if self._fs.exists(self._path(path)):
            # an uncommitted attempt (crashed writer): its files are garbage
            self._fs.delete(self._path(path), True)
        obs = None
        if observe:
            obs = Observation(f"snap_{uuid.uuid4().hex[:8]}")
            df = df.observe(obs, *[c.alias(n) for n, c in observe.items()])
        if repartition_by:
            df = df.repartition(num_files, *repartition_by) if num_files else df.repartition(*repartition_by)
        elif num_files:
            df = df.repartition(num_files)
        w = df.write.mode("errorifexists")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        w.parquet(path)
        metrics = observed(obs, *observe) if obs is not None else {}   # filled by the write above
        n_files = 0
        if files is not None:
            count = Observation(f"files_{uuid.uuid4().hex[:8]}")
            files.select(F.col(files.columns[0]).alias(KEY)).observe(count, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{FILES}")
            n_files = observed(count, "n")["n"]
        committed_at = _dt.datetime.now(_dt.timezone.utc).isoformat()
        self._write_text(f"{path}/{MARKER}", json.dumps({"run_id": run_id, "committed_at": committed_at, "mode": mode, "n_files": n_files,
                                                          "metrics": {k: str(v) for k, v in metrics.items()}}))
        return Snapshot(seq, path, run_id, committed_at, mode, n_files), metrics

    # ------------------------------------------------------------ maintenance
    def file_stats(self) -> DataFrame:
        """Data files and bytes of the current table, from a distributed listing."""
        chain = self.current_chain()
        if not chain:
            return self.spark.createDataFrame([(0, 0, 0.0)], "n_files long, total_bytes long, mean_bytes double")
        files = (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                      .option("recursiveFileLookup", "true").load([s.path for s in chain]).select("length"))
        return files.agg(F.count(F.lit(1)).alias("n_files"),
                         F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("total_bytes"),
                         F.coalesce(F.avg("length"), F.lit(0.0)).alias("mean_bytes"))

    def needs_compaction(self, max_files: int = 200, min_mean_bytes: int = 32 << 20) -> bool:
        r = self.file_stats().first()
        return bool(r["n_files"] > max_files and r["mean_bytes"] < min_mean_bytes)

    def compact(self, target_file_bytes: int = 128 << 20, run_id: str | None = None) -> Snapshot | None:
        """Rewrite the latest version into files of about ``target_file_bytes``."""
        r = self.file_stats().first()
        if r["n_files"] == 0:
            return None
        n = max(1, math.ceil(r["total_bytes"] / target_file_bytes))
        held = any(s.n_files for s in self.snapshots())
        snap, _ = self.write(self.read(), run_id=run_id or "compact", num_files=n, files=self.published() if held else None)
        return snap

    def expire(self, min_keep: int = 30, max_age_days: float = 3.0,
               now: _dt.datetime | None = None) -> list[str]:
        """Delete versions beyond the newest ``min_keep`` that are older than
        ``max_age_days``. Returns removed paths."""
        now = now or _dt.datetime.now(_dt.timezone.utc)
        snaps = self.snapshots()
        live = {s.seq for s in self.current_chain()}
        removed = []
        for s in (snaps[:-min_keep] if min_keep > 0 else snaps):
            if s.seq in live:
                continue
            ts = _dt.datetime.fromisoformat(s.committed_at) if s.committed_at else None
            if ts is not None and (now - ts).total_seconds() > max_age_days * 86400:
                self._fs.delete(self._path(s.path), True)
                removed.append(s.path)
        return removed

