"""Job audit (K15), load messages (K16) and the maintenance schedule.

The audit log is append-only: every state change of a run is a new event row,
so a crashed run still leaves its ``started`` event and a failure its ``failed``
event (written in ``finally``). The current state per run is derived with a
partial aggregate (``max_by`` on event time), never an in-place update.
"""

from __future__ import annotations

import datetime as _dt
import traceback
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.exprs import ntz_literal

STARTED, COMPLETED, FAILED = "started", "completed", "failed"
FINAL = (COMPLETED, FAILED)

AUDIT_EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("domain", T.StringType()),
    T.StructField("layer", T.StringType()), T.StructField("job_name", T.StringType()),
    T.StructField("spark_application_id", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("rows_read", T.LongType()), T.StructField("rows_new", T.LongType()),
    T.StructField("rows_changed", T.LongType()), T.StructField("rows_deleted", T.LongType()),
    T.StructField("message", T.StringType()),
])
MESSAGE_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("message_seq", T.LongType()),
    T.StructField("message_type", T.StringType()), T.StructField("message_time", T.TimestampNTZType()),
    T.StructField("message_text", T.StringType()),
])

_STATE_FIELDS = ["domain", "layer", "job_name", "spark_application_id", "status", "rows_read", "rows_new",
                 "rows_changed", "rows_deleted", "message"]


def audit_latest_state(events: DataFrame, id_col: str = "id", time_col: str = "event_time") -> DataFrame:
    """One row per run: fields of its latest event, first event time, end time when final."""
    cols = [c for c in _STATE_FIELDS if c in events.columns]
    # of events at the same time the final state is the later one
    latest = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(time_col), F.col("status").isin(*FINAL)))
    agg = events.groupBy(id_col).agg(latest.alias("_last"), F.min(time_col).alias("start_time"),
                                     F.max(time_col).alias("_max_t"))
    out = agg.select(id_col, *[F.col(f"_last.{c}").alias(c) for c in cols], "start_time",
                     F.when(F.col("_last.status").isin(*FINAL), F.col("_max_t")).alias("end_time"))
    return out


def maintenance_due(runs: DataFrame, as_of: _dt.datetime, days: int = 7, table_col: str = "table_name",
                    time_col: str = "start_time", status_col: str = "status",
                    ok_status: str = "success", tables: DataFrame | None = None) -> DataFrame:
    """Per table: last successful maintenance and whether one is due.

    Due when no successful run started within ``days`` before ``as_of``,
    including never. With ``tables`` (one column ``table_col``) every listed
    table is reported, so a table without any history is due (D14).
    """
    cutoff = ntz_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")
    last = runs.groupBy(table_col).agg(
        F.max(F.when(F.col(status_col) == ok_status, F.col(time_col))).alias("last_success"),
        F.count(F.lit(1)).alias("n_runs"))
    if tables is not None:
        last = (tables.select(table_col).distinct().join(last, table_col, "left")
                      .withColumn("n_runs", F.coalesce(F.col("n_runs"), F.lit(0).cast("long"))))
    return last.withColumn("due", F.col("last_success").isNull() | (F.col("last_success") < cutoff))


@dataclass
class RunCounters:
    rows_read: int | None = None
    rows_new: int | None = None
    rows_changed: int | None = None
    rows_deleted: int | None = None


@dataclass
class JobAudit:
    """Context manager writing started / completed / failed events for one run.

    ``sink`` is a callable taking a one-row DataFrame (e.g. an append to a table);
    counters are fresh per run.
    """

    spark: SparkSession
    run_id: str
    job_name: str
    sink: object
    domain: str = "default"
    layer: str = "raw"
    counters: RunCounters = field(default_factory=RunCounters)
    clock: object = None

    def _now(self):
        return self.clock() if self.clock else _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

    def _event(self, status: str, message: str | None = None) -> None:
        c = self.counters
        row = (self.run_id, self.domain, self.layer, self.job_name, self.spark.sparkContext.applicationId,
               status, self._now(), c.rows_read, c.rows_new, c.rows_changed, c.rows_deleted, message)
        self.sink(self.spark.createDataFrame([row], AUDIT_EVENT_SCHEMA))

    def __enter__(self) -> "JobAudit":
        self._event(STARTED)
        return self

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc is None:
            self._event(COMPLETED)
        else:
            self._event(FAILED, "".join(traceback.format_exception_only(exc_type, exc)).strip())
        return False


@dataclass
class MessageLog:
    """Load messages buffered on the driver (a few per run) and appended once."""

    run_id: str
    messages: list = field(default_factory=list)

    def log(self, kind: str, text: str, when: _dt.datetime | None = None) -> None:
        when = when or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        self.messages.append((self.run_id, len(self.messages) + 1, kind, when, text))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.messages, MESSAGE_SCHEMA)


def parquet_append_sink(path: str):
    """Sink appending small frames to a Parquet folder (audit log, messages)."""
    def sink(df: DataFrame) -> None:
        df.coalesce(1).write.mode("append").parquet(path)
    return sink
