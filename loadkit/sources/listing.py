"""File listing as a DataFrame (path, modificationTime, length).

Folders are listed level by level in tasks: each level's folders are rows, spread over
the cluster and listed there through ``pyarrow.fs``; what they hold is written, its
folders are the next level. No path passes through the driver, whose part is one small
job a level. Every file that a wildcard could mean is there: empty ones, names and folders
that begin with ``_`` or ``.``, which Spark's own index leaves out. Work folders of
writers in flight and checksum files are not.

A store that ``pyarrow.fs`` does not know is listed through Spark's ``binaryFile`` index
(visible, not empty files only).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.exprs import literal_prefix
from loadkit.session import scratch_path

#: Fixed names: folders that Spark and Hadoop writers fill before they commit.
WORK_FOLDERS = ("_temporary", ".spark-staging")
FOLDERS_PER_TASK = 16
MAX_LEVELS = 100
CHILD = "path string, is_folder boolean, ms long, length long"


def _store(path: str):
    """File system, path within it, and what to put before the paths it gives."""
    from pyarrow import fs
    if path.startswith("/"):
        return fs.LocalFileSystem(), path, "file:"
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/"), "file:"
    system, at = fs.FileSystem.from_uri(path)
    return system, at, path[:len(path) - len(at)] if path.endswith(at) else path.split("://")[0] + "://"


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs
    for batch in batches:
        for folder in batch.column("path").to_pylist():
            system, at, scheme = _store(folder)
            found = [i for i in system.get_file_info(fs.FileSelector(at, recursive=False, allow_not_found=True))
                     if not i.base_name.startswith(WORK_FOLDERS) and not (i.base_name.startswith(".") and i.base_name.endswith(".crc"))]
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([scheme + i.path for i in found], pa.string()),
                "is_folder": pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_()),
                "ms": pa.array([i.mtime_ns // 1_000_000 if i.mtime_ns else 0 for i in found], pa.int64()),
                "length": pa.array([i.size or 0 for i in found], pa.int64())})


def walk_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root``: ``path, modificationTime, length``."""
    level, n, found = spark.createDataFrame([(root,)], "path string"), 1, None
    for _ in range(MAX_LEVELS):
        at = scratch_path(spark, "listing")
        (level.select("path").repartition(max(1, -(-n // FOLDERS_PER_TASK)), "path").mapInArrow(_children, CHILD).write.parquet(at))
        held = spark.read.schema(CHILD).parquet(at)
        files = held.filter("not is_folder")
        found = files if found is None else found.unionByName(files)
        level = held.filter("is_folder")
        n = level.count()
        if not n:
            return found.select("path", F.timestamp_millis("ms").alias("modificationTime"), "length")
    raise RuntimeError(f"more than {MAX_LEVELS} levels of folders below {root}")


def list_files(spark: SparkSession, root: str, pattern: str | None = None,
               system_key: str | None = None) -> DataFrame:
    """Files below ``root`` (recursive). With ``pattern``, listing starts at the
    folder of the pattern's literal prefix (P9) and names are glob-filtered
    later by the ledger's rule join."""
    base = root.rstrip("/")
    if pattern:
        lp = literal_prefix(pattern)
        if "/" in lp:
            base = f"{base}/{lp.rsplit('/', 1)[0]}"
    try:
        _store(base)
        df = walk_files(spark, base)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError):   # a scheme of another library
        df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                   .load(base).select("path", "modificationTime", "length"))
    if system_key is not None:
        df = df.withColumn("src_sys_key", F.lit(system_key))
    return df


def normalise_paths(df: DataFrame, col: str = "path") -> DataFrame:
    """Drop a ``file:`` scheme so listed paths compare with configured roots."""
    return df.withColumn(col, F.regexp_replace(F.col(col), "^file:(//)?", ""))
