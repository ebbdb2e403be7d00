"""The file ledger as staged files plus append-only status events.

``<root>/files`` holds a row per staged file, ``<root>/events`` one folder per batch of
events. Nothing is rewritten when a feed ends: its outcome is a small append, so feeds
can run side by side and a crash loses no earlier state. The state of a file is its
latest accepted event (``max_by``), ``staged`` without one.

====================  ==========================================
state                 may become
====================  ==========================================
staged, failed        started, skipped
error                 started, skipped
started               success, failed, error, started (taken over)
success, skipped      nothing
====================  ==========================================

An event that its file's state does not allow, or of a file that was never staged, is kept
as refused with the state it met; it changes no state (`refused`).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.exprs import ntz_literal
from loadkit.operators.ledger import FAILED, LEDGER_KEY, LEDGER_SCHEMA, SKIPPED, STAGED, SUCCESS
from loadkit.plans.snapshots import SnapshotTable
from loadkit.session import observed

STARTED, ERROR = "started", "error"
ALLOWED = {
    STAGED: (STARTED, SKIPPED),
    FAILED: (STARTED, SKIPPED),
    ERROR: (STARTED, SKIPPED),
    STARTED: (SUCCESS, FAILED, ERROR, STARTED),
    SUCCESS: (),
    SKIPPED: (),
}
OPEN = (STAGED, FAILED, ERROR, STARTED)
ORDER = (STAGED, STARTED, SKIPPED, FAILED, ERROR, SUCCESS)     # of events at the same time the later one counts

EVENT_SCHEMA = T.StructType([
    *[T.StructField(k, T.StringType()) for k in LEDGER_KEY],
    T.StructField("event_status", T.StringType()), T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("event_mesg", T.StringType()), T.StructField("event_run_id", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("met", T.StringType()), T.StructField("accepted", T.BooleanType()),
])


def _allowed(met, status):
    ok = F.lit(False)
    for state, after in ALLOWED.items():
        if after:
            ok = ok | ((met == state) & status.isin(*after))
    return F.coalesce(ok, F.lit(False))


def _rank():
    return F.array_position(F.array(*[F.lit(s) for s in ORDER]), F.col("event_status"))


def _last_status():
    """Status of a group's latest event. Time and rank as one number, so that the grouping
    sorts nothing; the time is zone-free, so its parts are taken as they stand."""
    t = F.col("event_time")
    seconds = F.unix_date(t.cast("date")).cast("long") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    micros = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("long")
    return F.get(F.array(*[F.lit(s) for s in ORDER]), (F.pmod(F.max(micros * 8 + _rank()), F.lit(8)) - 1).cast("int"))


def latest_events(events: DataFrame) -> DataFrame:
    """The latest accepted event of each file."""
    own = ["event_status", "event_time", "event_mesg", "event_run_id", "n_rows"]
    last = F.max_by(F.struct(*own), F.struct("event_time", _rank().alias("rank")))
    return events.filter("accepted").groupBy(*LEDGER_KEY).agg(last.alias("l")).select(*LEDGER_KEY, "l.*")


class EventLedger:
    def __init__(self, spark: SparkSession, root: str, clock=None):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = SnapshotTable(spark, f"{self.root}/files")
        self._clock = clock or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._path = path
        self._fs.mkdirs(path(f"{self.root}/events"))

    def events(self) -> DataFrame:
        """Every event, accepted or refused."""
        return self.spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.root}/events")

    def refused(self) -> DataFrame:
        return self.events().filter("not accepted").drop("accepted")

    def read_or_empty(self, schema=LEDGER_SCHEMA) -> DataFrame:
        return self.read() if self.files.exists() else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """The ledger as it stands: staged files with status, message and run id of now."""
        now = latest_events(self.events())
        j = self.files.read_or_empty(LEDGER_SCHEMA).join(now, LEDGER_KEY, "left")
        told = {"src_entity_load_status": "event_status", "src_entity_load_mesg": "event_mesg", "src_entity_load_run_id": "event_run_id"}
        return j.select(*[F.coalesce(told[c], c).alias(c) if c in told else F.col(c) for c in LEDGER_SCHEMA.names])

    def queue(self) -> DataFrame:
        """Files that wait for a load. One that a run started and left without an outcome,
        or whose load broke off, is taken up again like a failed one."""
        state = F.col("src_entity_load_status")
        return self.read().filter(state.isin(*OPEN)).withColumn(
            "src_entity_load_status", F.when(state.isin(STARTED, ERROR), FAILED).otherwise(state))

    def lifecycle(self) -> DataFrame:
        """Per file: attempts, first start, time of the last outcome and its row count."""
        is_end = F.col("event_status") != STARTED
        seen = self.events().filter("accepted").groupBy(*LEDGER_KEY).agg(
            _last_status().alias("_now"),
            F.sum(F.when(is_end, 0).otherwise(1)).cast("long").alias("n_attempts"),
            F.min(F.when(~is_end, F.col("event_time"))).alias("src_entity_load_start_time"),
            F.max(F.when(is_end, F.col("event_time"))).alias("src_entity_load_finish_time"),
            F.max_by(F.col("n_rows"), F.when(is_end, F.col("event_time"))).alias("src_entity_rec_count"))
        state = F.coalesce("_now", "src_entity_load_status").alias("src_entity_load_status")
        return self.files.read_or_empty(LEDGER_SCHEMA).join(seen, LEDGER_KEY, "left").select(
            *LEDGER_KEY, state, F.coalesce("n_attempts", F.lit(0)).alias("n_attempts"),
            "src_entity_load_start_time", "src_entity_load_finish_time", "src_entity_rec_count")

    def stage(self, rows: DataFrame, run_id: str | None = None) -> None:
        """Append new files (``stage_new_files``)."""
        self.files.write(rows.select(*LEDGER_SCHEMA.names), run_id=run_id, mode="append")

    def record(self, updates: DataFrame, when: _dt.datetime | None = None) -> dict:
        """Append an event per row of ``updates`` (ledger key, ``src_entity_load_status``,
        ``src_entity_load_mesg``, ``src_entity_load_run_id`` and perhaps ``n_rows``);
        returns how many were accepted and refused."""
        n_rows = F.col("n_rows").cast("long") if "n_rows" in updates.columns else F.lit(None).cast("long")
        u = updates.select(*LEDGER_KEY, F.col("src_entity_load_status").alias("event_status"), ntz_literal(when or self._clock()).alias("event_time"),
                           F.col("src_entity_load_mesg").alias("event_mesg"), F.col("src_entity_load_run_id").alias("event_run_id"), n_rows.alias("n_rows"))
        # three shuffles by the key: the updates, the staged files and the events, each once
        held = self.files.read_or_empty(LEDGER_SCHEMA).select(*LEDGER_KEY, F.col("src_entity_load_status").alias("_first"), F.lit(True).alias("_held"))
        now = self.events().filter("accepted").groupBy(*LEDGER_KEY).agg(_last_status().alias("_now"))
        out = u.join(held, LEDGER_KEY, "left").join(now, LEDGER_KEY, "left").withColumn("met", F.when(F.col("_held"), F.coalesce("_now", "_first")))
        out = out.withColumn("accepted", _allowed(F.col("met"), F.col("event_status")))
        obs = Observation(f"events_{uuid.uuid4().hex[:8]}")
        out = out.select(*EVENT_SCHEMA.names).observe(obs, F.sum(F.col("accepted").cast("long")).alias("accepted"), F.count(F.lit(1)).alias("n"))
        out.write.parquet(f"{self.root}/events/{uuid.uuid4().hex}")
        got = observed(obs, "accepted", "n")
        return {"accepted": got["accepted"], "refused": got["n"] - got["accepted"]}

    def fold(self) -> None:
        """Housekeeping: the state of now becomes the staged files' own, and the events it
        holds go. A crash in between leaves events that give the same state once more."""
        folders = [st.getPath() for st in self._fs.listStatus(self._path(f"{self.root}/events"))]
        self.files.write(self.read())
        for f in folders:
            self._fs.delete(f, True)


class Book:
    """What a feed load asks of its ledger, for both kinds: an event ledger gets appends,
    a snapshot table is rewritten once at the end."""

    def __init__(self, ledger):
        self.ledger, self.is_events = ledger, isinstance(ledger, EventLedger)

    def queue(self) -> DataFrame:
        return self.ledger.queue() if self.is_events else self.ledger.read()

    def _tell(self, chosen: DataFrame, status: str, mesg: str, run_id: str) -> None:
        if self.is_events:
            self.ledger.record(chosen.select(*LEDGER_KEY, F.lit(status).alias("src_entity_load_status"), F.lit(mesg).alias("src_entity_load_mesg"),
                                             F.lit(run_id).alias("src_entity_load_run_id")))

    def started(self, chosen: DataFrame, run_id: str) -> None:
        self._tell(chosen, STARTED, "Started", run_id)

    def broken(self, chosen: DataFrame, run_id: str, why: str) -> None:
        self._tell(chosen, ERROR, why[:500], run_id)

    def outcome(self, updates: DataFrame, run_id: str) -> None:
        if self.is_events:
            self.ledger.record(updates)
        else:
            from loadkit.operators.ledger import apply_status
            self.ledger.write(apply_status(self.ledger.read(), updates.drop("n_rows")), run_id=f"{run_id}:ledger")
