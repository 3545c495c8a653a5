"""Splitting keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxvigil.session import written_table

# A key with more rows than this is split over several tasks.
ROWS_PER_TASK = 4_000_000


def heavy_keys(rows: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    """Keys holding more than ``rows_per_task`` rows, with their ``row_count``.

    Counting combines map-side, so a hot key costs one row per task.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("row_count"))
    return counts.where(F.col("row_count") > rows_per_task)


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` between two frames."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def ordered_slices(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> tuple[DataFrame, DataFrame | None]:
    """Cut the ordered history of each heavy key into consecutive slices.

    Returns ``(whole, sliced)``. ``whole`` holds the keys that fit one task. ``sliced`` holds
    the heavy keys with a ``slice`` number that grows along ``order_by``; range partitioning
    keeps slices near ``rows_per_task`` however the order values are distributed. It is
    written once, so every reader sees the same cuts. ``None`` means there is no heavy key.
    Rows are counted when this is called: one job that reads the keys alone.
    """
    heavy = heavy_keys(rows.select(*keys), keys, rows_per_task)
    heavy_rows = heavy.agg(F.sum("row_count")).first()[0]
    if not heavy_rows:
        return rows, None
    slices = -(-heavy_rows // rows_per_task)
    hot = heavy.select(*keys)
    match = same_keys(rows, hot, keys)
    sliced = (
        rows.join(hot, match, "left_semi")
        .repartitionByRange(slices, *keys, *order_by)
        .withColumn("slice", F.spark_partition_id())
    )
    return rows.join(hot, match, "left_anti"), written_table(sliced, "slices")
