"""Left lookup of events in a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(events: DataFrame, table: DataFrame, key: str = "key") -> DataFrame:
    """``events`` ⟕ ``table`` on ``key``; ``matched`` tells found from missing.

    Spark broadcasts a table within its size limit. Beyond it both sides shuffle on the key,
    and adaptive execution splits the events of a heavy key, null included, over several tasks.
    """
    joined = events.join(table.withColumn("matched", F.lit(True)), key, "left")
    return joined.withColumn("matched", F.coalesce("matched", F.lit(False)))
