"""Session helpers: a tuned builder and the shared work folder.

Intermediate files (rendered fixtures, checkpoints, run-scoped materialisations)
go below the folder the cluster names in ``spark.checkpoint.dir``. It is read
from the session; only when it is unset (local tests) is a private folder set.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_ROOTS: dict[str, str] = {}   # work root per Spark application


def build_session(master: str | None = None, app: str = "loadkit",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join) and Arrow on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Broadcast only on a measured size: the static planner's guess from file
        # sizes is off; AQE decides from actual shuffle output (<= 32 MB), and a
        # shuffled hash join replaces sort-merge only when every partition's map
        # is proven small (<= 64 MB).
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_root(spark)
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and run-scoped files.

    Taken from ``spark.checkpoint.dir``, else from a checkpoint folder already set
    on the SparkContext; only when neither exists (local tests) is a private
    local folder set as the context's checkpoint folder.
    """
    app = spark.sparkContext.applicationId
    if app in _ROOTS:
        return _ROOTS[app]
    root = spark.conf.get(_CKPT_KEY, None) or spark.sparkContext.getConf().get(_CKPT_KEY, None)
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if not root and not current.isEmpty():
        root = current.get()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CKPT_KEY} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="loadkit-ckpt-")   # local[*]: one machine
    if jsc.getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    _ROOTS[app] = root.rstrip("/")
    return _ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name below the work root (not created)."""
    return f"{work_root(spark)}/loadkit/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that `scratch_path` named, once nothing reads it any more."""
    if not path.startswith(f"{work_root(spark)}/loadkit/"):
        raise ValueError(f"{path} is not below the work folder")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def observed(obs, *names: str) -> dict:
    """What an `Observation` saw; zeros where the observed rows were found to be none
    while planning, so that nothing ran that could have been observed."""
    from py4j.protocol import Py4JJavaError
    try:
        got = dict(obs.get)
    except Py4JJavaError:
        got = {}
    return {n: got.get(n) or 0 for n in names} if names else got


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file access in tests."""
    p = path[len("file:"):] if path.startswith("file:") else path
    return os.path.abspath(p)
