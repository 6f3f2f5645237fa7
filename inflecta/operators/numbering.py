"""Consecutive numbers in a given order, without putting all rows or a hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inflecta.session import durable

# Fixed value: ``monotonically_increasing_id`` keeps the row in the low 33 bits, the task above them.
_ROW_BITS = 33


def number_rows(rows: DataFrame, order: Sequence[str], name: str, within: Sequence[str] = ()) -> DataFrame:
    """Add ``name``: 1, 2, … by ``order``, restarting for each ``within`` group.

    Rows are range partitioned by group and order, so a large group is spread over several slices;
    a row's number is its place in its slice plus the sizes of the earlier slices of its group.
    The sliced rows are made durable first, because both uses must see the same slices; the rows before them,
    because a range partitioning samples its input, which would be computed twice.
    """
    keys = list(within)
    sliced = durable(
        durable(rows).repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_row", _ROW_BITS))
    )
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count("*").alias("_size"), F.min("_row").alias("_first"))
    # One row per slice of a group: never more rows than there are slices.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, "_slice", "_first", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    )
    if not keys:
        # As many rows as slices: bounded by the number of partitions.
        offsets = F.broadcast(offsets)
    numbered = sliced.join(offsets, [*keys, "_slice"])
    return numbered.select(*rows.columns, (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias(name))
