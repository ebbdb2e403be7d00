"""T1 with the file ledger: a stream that shares its ledger with batch loads.

Each micro-batch is written once, tagged with its files. Files the ledger does not know
are staged, those it holds as loaded or skipped (by a batch load, say) are left out, the
others are appended to the raw table and get their ``started`` and ``success`` events.
The raw table remembers its files and batch ids, so a batch that is replayed after a crash
at any point appends nothing twice and only makes up for the missing events. The keyed
target is not touched by batches: `merge_new_rows` merges what was appended since the last
merge, newest file first per key, in one load.

A file without a row does not reach a micro-batch; listing stages it.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadkit.contracts import FeedContract, LoadSpec
from loadkit.functions.exprs import basename, instance_key
from loadkit.operators.ledger import LEDGER_KEY, SUCCESS, stage_new_files
from loadkit.plans.event_ledger import OPEN, STARTED, EventLedger
from loadkit.plans.runner import LoadResult, run_load
from loadkit.plans.snapshots import SnapshotTable
from loadkit.session import scratch_path
from loadkit.sources.delimited import SOURCE_FILE, plain_path, reader_options

FILE_TIME, FILE_SIZE = "_file_time", "_file_size"
FILE_COLS = [SOURCE_FILE, FILE_TIME, FILE_SIZE]


def stream_tagged(spark: SparkSession, source_dir: str, contract: FeedContract, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming rows of a delimited feed with the path, time and size of their file."""
    r = spark.readStream.schema(contract.read_schema()).options(**reader_options(contract))
    if contract.file_pattern:
        r = r.option("pathGlobFilter", contract.file_pattern)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(source_dir).select(
        *[F.col(f"`{c.source}`").alias(c.target) for c in contract.columns], plain_path(F.col("_metadata.file_path")).alias(SOURCE_FILE),
        F.to_utc_timestamp("_metadata.file_modification_time", spark.conf.get("spark.sql.session.timeZone")).cast("timestamp_ntz").alias(FILE_TIME),
        F.col("_metadata.file_size").alias(FILE_SIZE))


def ledger_sink(ledger: EventLedger, raw: SnapshotTable, system: tuple[str, int], entity: tuple[str, int], load_id: str,
                run_ts: _dt.datetime) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function; ``system`` and ``entity`` are (key, number)."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, run_id = batch.sparkSession, f"{load_id}:batch:{batch_id}"
        at = scratch_path(spark, "micro_batch")
        batch.write.parquet(at)
        rows = spark.read.schema(batch.schema).parquet(at)
        inst = instance_key(F.col(FILE_TIME), F.lit(system[0]), basename(F.col(SOURCE_FILE)))
        files = rows.groupBy(*FILE_COLS).agg(F.count(F.lit(1)).alias("n_rows")).select(
            inst.alias("src_entity_inst_key"), F.lit(system[0]).alias("src_sys_key"), F.lit(system[1]).alias("src_sys_id"),
            F.lit(entity[0]).alias("src_entity_key"), F.lit(entity[1]).alias("src_entity_id"), F.col(SOURCE_FILE).alias("src_entity_path"),
            basename(F.col(SOURCE_FILE)).alias("src_entity_name"), F.col(FILE_TIME).alias("src_entity_timestamp"),
            F.col(FILE_SIZE).alias("src_entity_size"), "n_rows")
        ledger.stage(stage_new_files(files, ledger.read_or_empty(), run_ts), run_id=f"{run_id}:stage")
        state = ledger.read().select(*LEDGER_KEY, "src_entity_load_status")
        waits = files.join(state, LEDGER_KEY).filter(F.col("src_entity_load_status").isin(*OPEN))
        todo = scratch_path(spark, "micro_batch_files")
        waits.select(*LEDGER_KEY, "src_entity_path", "n_rows").write.parquet(todo)    # at most the files of one trigger
        waits = spark.read.parquet(todo)
        if waits.isEmpty():
            return
        told = lambda status, mesg: waits.select(
            *LEDGER_KEY, F.lit(status).alias("src_entity_load_status"), mesg.alias("src_entity_load_mesg"),
            F.lit(run_id).alias("src_entity_load_run_id"), "n_rows")
        ledger.record(told(STARTED, F.lit("Started")))
        if not raw.committed(run_id):
            fresh = waits.join(raw.published(), "src_entity_inst_key", "left_anti")
            body = rows.join(fresh.select(F.col("src_entity_path").alias(SOURCE_FILE)), SOURCE_FILE, "left_semi")
            raw.write(body.select(*batch.columns), run_id=run_id, mode="append", files=fresh.select("src_entity_inst_key"))
        ledger.record(told(SUCCESS, F.concat(F.lit("loaded: "), F.col("n_rows").cast("string"), F.lit(" rows"))))
    return apply


def ingest_with_ledger(spark: SparkSession, source_dir: str, contract: FeedContract, sink, checkpoint: str,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Every file present now, in bounded micro-batches."""
    q = (stream_tagged(spark, source_dir, contract, max_files_per_trigger).writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def newest_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: that of the newest file (a partial aggregate, no window); rows
    without file columns, as batch loads append them, are the oldest."""
    for c, kind in zip(FILE_COLS, ("string", "timestamp_ntz", "long")):
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast(kind))
    data = [c for c in rows.columns if c not in FILE_COLS]
    rest = [c for c in data if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(FILE_TIME, SOURCE_FILE)).alias("_r")).select(
        *[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in data])


def merge_new_rows(spark: SparkSession, raw: SnapshotTable, spec: LoadSpec, run_ts: _dt.datetime) -> LoadResult:
    """Merge what ``raw`` gained since the last merge into ``spec.target``, once."""
    last = raw.latest()
    target, prefix = SnapshotTable(spark, spec.target), f"{spec.load_id}:merge:"
    seen = max([0, *(int(r[len(prefix):]) for r in target.committed_runs() if r.startswith(prefix))])
    if last is None or last.seq <= seen:
        return LoadResult(f"{prefix}{seen}", "completed", {}, None, "nothing new")
    import dataclasses
    own = dataclasses.replace(spec, source=lambda s: newest_per_key(raw.read_since(seen), spec.keys), source_type="callable")
    return run_load(spark, own, f"{prefix}{last.seq}", run_ts)
