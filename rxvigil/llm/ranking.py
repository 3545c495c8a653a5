"""Places of rows in one global order, without bringing the rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxvigil.session import written_table

PART_BITS = 33


def ranked(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with a long column ``name``: 1, 2, 3 ... in ``order``; rows that tie are numbered in any order.

    The rows are range-partitioned and written in order. Only the partitions' row counts, one number a partition, go
    through the driver, so a place is the count before its partition plus its place there.
    """
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = written_table(ordered.withColumn(name, F.monotonically_increasing_id()), "ranked")
    part = F.shiftright(name, PART_BITS)
    held = sorted((r["part"], r["count"]) for r in ordered.groupBy(part.alias("part")).count().collect())
    before, bases = 0, []
    for number, count in held:
        bases.append((number, before - (number << PART_BITS) + 1))
        before += count
    bases = rows.sparkSession.createDataFrame(bases, "__part long, __base long")
    based = ordered.join(F.broadcast(bases), part == F.col("__part"))
    return based.withColumn(name, F.col(name) + F.col("__base")).drop("__part", "__base")
