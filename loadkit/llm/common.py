"""Shared pieces of the training-data operators: table access, lineage cuts,
row keys, Arrow batch slicing and connected components.

A document row is identified by ``(doc_id, xxhash64(text))`` (`row_key`): rows
with an equal id and an equal text are the same document, so they always get the
same answer; a NULL id or a NULL text is a value like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.session import scratch_path

SLICE_ROWS = 256   # rows handed to Python code at once, whatever the Arrow batch holds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back (lineage cut that
    survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long), ``th`` (text hash) and ``text`` (string); nothing else of
    the input can clash with an operator's own columns."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("th"), text.alias("text"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until it is unused in ``taken`` (any case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def map_slices(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
               schema: str, rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` with a function built once per task by ``make``."""
    def run(batches):
        one = make()
        for piece in slices(batches, rows):
            yield one(piece)
    return df.mapInArrow(run, schema)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Labels ``(node, root)`` with the smallest node of each component, for the
    nodes that have an edge ``(a, b)``.

    Alternating large-star / small-star rounds: each is a partial minimum and one
    equi-join, so no neighbourhood is ever gathered, nor is an edge sent to the driver;
    rounds grow with the logarithm of the longest chain. Each round's edges are a written
    table.
    """
    e = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .filter("u <> v").distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low.hint("merge"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e = cut(small, "cc")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
    raise RuntimeError("components did not settle")
