"""Row numbers within groups without gathering a group into one task.

A window ``row_number() OVER (PARTITION BY g ORDER BY ...)`` sends every row
of a group to one task. Here the rows are range-partitioned and sorted by
(group, order) across all tasks instead; a checkpoint in the shared folder
fixes the partitioning so row ids are stable on retry; each row's position in
its partition plus the count of the group's rows in earlier partitions gives
its rank. The offsets table has one row per (partition, group) present.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from aerolake.operators.joins import broadcast_if_bounded
from aerolake.session import checkpoint_root

# Offsets tables up to this size are broadcast; larger ones are shuffle-joined.
OFFSETS_MAX_ROWS = 1_000_000


def ranked(df: DataFrame, group: str, order: list[Column], out: str = "idx",
           partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out``: the 0-based row number of each row within its
    ``group`` under ``order`` (which must be a total order within a group)."""
    spark = df.sparkSession
    checkpoint_root(spark)  # make sure a (shared) checkpoint folder is set
    keys = [F.col(group)] + list(order)
    # Without an explicit count AQE sizes the range partitions from the data,
    # so a small input is not cut into the cluster's full shuffle width.
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ordered = spread.sortWithinPartitions(*keys)
    ordered = ordered.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fixed = ordered.checkpoint(eager=True)
    finally:
        ordered.unpersist()
    with_pos = (fixed.withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()))
    stats = with_pos.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_first"))
    w = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    offsets = broadcast_if_bounded(offsets, OFFSETS_MAX_ROWS)
    j = with_pos.join(offsets, ["_pid", group])
    return j.withColumn(out, (F.col("_offset") + F.col("_pos") - F.col("_first")).cast("long")).drop(
        "_pid", "_pos", "_first", "_offset")
