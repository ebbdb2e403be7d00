"""Contract-driven delimited scans.

All chosen files are read in ONE scan (``spark.read.csv(paths)``) under the
contract's positional schema with target types, then renamed to target names.
``_metadata.file_path`` tags rows with their file so per-file outcomes (row and
reject counts) come from one aggregate rather than one job per file.

Multiline CSV cannot be split inside a file, so its parallelism is per file; only a
contract (or caller) that declares no quoted newline makes large single files
splittable. Bad cells become NULL and their rows stay; they are counted per file.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.contracts import ContractError, FeedContract

SOURCE_FILE = "_source_file"
CORRUPT = "_corrupt_record"


def reader_options(contract: FeedContract, multiline: bool | None = None) -> dict[str, str]:
    """S2 options; ``multiline`` overrides the contract's declaration."""
    ml = contract.multiline if multiline is None else multiline
    if not isinstance(ml, bool):
        raise ContractError(f"multiline must be declared true or false, got {ml!r}")
    opts = contract.reader_options()
    if ml:
        opts["multiLine"] = "true"
    else:
        opts.pop("multiLine", None)
    return opts


def plain_path(path: Column) -> Column:
    """A path as ledgers hold it: no ``file:`` scheme, URL escapes undone."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(path, r"\+", "%2B")), "^file:(//)?", "")


def load_delimited(spark: SparkSession, paths: str | Sequence[str], contract: FeedContract,
                   with_source_file: bool = False, with_rejects: bool = False,
                   multiline: bool | None = None) -> DataFrame:
    """C4: rows of every file in ``paths`` under target names and types.

    Bad cells become NULL (PERMISSIVE). With ``with_rejects`` the raw text of
    malformed lines (wrong field count, unparsable value) is kept in
    ``_corrupt_record`` so it can be counted per file.
    """
    schema = contract.read_schema()
    opts = reader_options(contract, multiline)
    if with_rejects:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        opts["columnNameOfCorruptRecord"] = CORRUPT
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.schema(schema).options(**opts).csv(paths)
    cols = [F.col(f"`{c.source}`").alias(c.target) for c in contract.columns]
    if with_source_file:
        cols.append(F.col("_metadata.file_path").alias(SOURCE_FILE))
    if with_rejects:
        cols.append(F.col(CORRUPT))
    return raw.select(*cols)


def file_outcomes(loaded: DataFrame) -> DataFrame:
    """Rows and rejects per source file (needs ``with_source_file`` and ``with_rejects``).

    Every data column is referenced so the CSV parser (which prunes unreferenced
    columns) checks every field of every line.
    """
    data = [F.col(f"`{c}`") for c in loaded.columns if c not in (SOURCE_FILE, CORRUPT)]
    nulls = sum((c.isNull().cast("int") for c in data), F.lit(0))
    return loaded.groupBy(SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(nulls).cast("long").alias("n_null_cells"),
        F.sum(F.when(F.col(CORRUPT).isNotNull(), 1).otherwise(0)).cast("long").alias("n_rejects"))


def render_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = False,
                     date_format: str | None = None, files: int | None = None, quote_all: bool = False) -> str:
    """Write a frame as delimited text (fixtures, exports). Returns ``path``."""
    w = df if files is None else df.repartition(files)
    wr = w.write.mode("errorifexists").option("sep", sep).option("header", str(header).lower())
    if date_format:
        wr = wr.option("dateFormat", date_format)
    if quote_all:
        wr = wr.option("quoteAll", "true")
    wr.csv(path)
    return path
