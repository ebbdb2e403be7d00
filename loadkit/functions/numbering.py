"""Gap-free numbering within groups that stays parallel when one group is huge.

``Window.partitionBy(g).orderBy(o)`` sends every row of a group to one task; a
group holding a third of the data then becomes one straggler task. Here rows are
range-partitioned on ``(g, o)`` instead, so a hot group is spread over many
partitions. Each row gets its position inside its partition from
``monotonically_increasing_id`` (partition index in the high bits, row index in
the low bits, assigned after the in-partition sort), and a small table of
per-(partition, group) counts supplies the offset of earlier partitions (at
most #partitions + #groups rows; AQE broadcasts it if it measures small). The ranges
are written to the shared work folder so that both uses see the same partitioning.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadkit.session import scratch_path

_ROW_BITS = 33


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_within(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column],
                  out: str = "rn", num_partitions: int | None = None,
                  skew_safe: bool = True) -> DataFrame:
    """Add ``out`` = 1, 2, ... per group of ``partition_by`` in ``order_by`` order.

    With ``skew_safe=False`` this is a plain window ``row_number`` (one task per group).
    """
    partition_by = list(partition_by)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order_by]
    if not skew_safe:
        w = Window.partitionBy(*partition_by).orderBy(*order_cols)
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [F.col(c) for c in partition_by] + order_cols
    # written once before the ranges are sampled, so that sampling does not run the
    # input again, and once with the ranges, so that both uses below see the same ones
    ranged = (_written(df, "numbering_input").repartitionByRange(n, *sort_cols)
                .sortWithinPartitions(*sort_cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = _written(ranged, "numbering_ranges").withColumn("_pid", F.shiftrightunsigned("_mid", _ROW_BITS))

    # At most (#partitions + #groups) rows: one per partition a group touches.
    pieces = ranged.groupBy("_pid", *partition_by).agg(F.min("_mid").alias("_first"),
                                                       F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*partition_by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    pieces = pieces.select(*[F.col(c).alias(f"_p_{c}") for c in partition_by],
                           F.col("_pid").alias("_p_pid"), "_first", "_before")
    cond = ranged["_pid"] == pieces["_p_pid"]
    for c in partition_by:
        cond = cond & ranged[c].eqNullSafe(pieces[f"_p_{c}"])
    joined = ranged.join(pieces, cond, "inner")
    rn = (F.col("_mid") - F.col("_first") + F.lit(1) + F.col("_before")).cast("long")
    return joined.withColumn(out, rn).drop("_mid", "_pid", "_p_pid", "_first", "_before",
                                           *[f"_p_{c}" for c in partition_by])

