"""Skew-safe row positions.

``row_number()`` over a window puts a whole group (or, without a partition
key, the whole table) into one task.  Here a range exchange on
(group, order) spreads even a group holding a third of all rows over many
partitions; each partition numbers its own slice, and a small table of
per-(partition, group) counts turns local numbers into group positions.
The range-partitioned rows are written once with their partition id, so the
numbering is deterministic under recomputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_group_position(df: DataFrame, group_cols, order_cols, name: str = "pos",
                        count_name: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Adds ``name`` = 0-based position of the row inside its group when the
    group is ordered by ``order_cols`` (which should make rows unique), and,
    if ``count_name`` is given, the group size."""
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The partition id is computed once, right after the range exchange, and
    # stored: both branches below (and any recomputation after an executor
    # loss) read the same ids.  Recomputing the exchange instead would
    # re-sample its bounds from input whose order is not fixed.
    from textrec.session import materialize
    ranged = materialize(
        df.repartitionByRange(n, *group_cols, *order_cols).withColumn("_pid", F.spark_partition_id()),
        "positions")
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid", *group_cols).orderBy(*order_cols)))
    counts = local.groupBy("_pid", *group_cols).agg(F.count("*").alias("_cnt"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = ["_pid", *group_cols, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")]
    if count_name:
        cols.append(F.sum("_cnt").over(Window.partitionBy(*group_cols)).alias(count_name))
    offsets = counts.select(*cols)
    out = local.join(offsets, ["_pid", *group_cols], "inner")
    return out.withColumn(name, F.col("_off") + F.col("_lrn") - 1).drop("_pid", "_lrn", "_off")


def positional_slice(df: DataFrame, order_cols, start, end, name: str = "pos") -> DataFrame:
    """Rows whose 0-based position in the order lies in [start, end)."""
    pos = with_group_position(df, [], order_cols, name=name)
    return pos.where((F.col(name) >= start) & (F.col(name) < end))
