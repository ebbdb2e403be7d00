"""Table scans, query sources, schema and existence checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadkit.contracts import ContractError, check_identifier


def read_source(spark: SparkSession, source, source_type: str = "query") -> DataFrame:
    """Build a load source: SQL text, a table name or a callable returning a frame."""
    if isinstance(source, DataFrame):
        return source
    if callable(source):
        return source(spark)
    if source_type == "query":
        return spark.sql(source)
    if source_type == "table":
        return read_table(spark, source)
    raise ContractError(f"unknown source type {source_type!r}")


def read_table(spark: SparkSession, ref: str) -> DataFrame:
    """A catalog table (``db.t``) or a snapshot table folder (path with ``/``)."""
    if "/" in ref or ref.startswith("file:"):
        from loadkit.plans.snapshots import SnapshotTable
        return SnapshotTable(spark, ref).read()
    return spark.table(check_identifier(ref))


def table_exists(spark: SparkSession, ref: str) -> bool:
    if "/" in ref or ref.startswith("file:"):
        from loadkit.plans.snapshots import SnapshotTable
        return SnapshotTable(spark, ref).latest() is not None
    parts = check_identifier(ref).split(".")
    if len(parts) == 2:
        return spark.catalog.tableExists(parts[1], parts[0])
    return spark.catalog.tableExists(ref)


def table_schema(spark: SparkSession, ref: str) -> T.StructType:
    """Schema without running a job (no ``describe`` partition rows, no probe query)."""
    return read_table(spark, ref).schema
