"""Left as-of join: each event sees the table as it stood at the event's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxvigil.operators.skew import ROWS_PER_TASK, ordered_slices

_TABLE, _EVENT = 0, 1


def asof_join(
    events: DataFrame,
    changelog: DataFrame,
    columns: Sequence[str],
    key: str = "key",
    event_time: str = "ts",
    table_order: tuple[str, str] = ("ts", "offset"),
    delete: str = "is_delete",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``columns`` of the newest ``changelog`` row of the same key at or before each event.

    Equal times count as "table first". A delete, like a missing row, gives nulls; ``matched``
    tells the two outcomes apart from a found row. Events with a null key match nothing and
    never enter the shuffle.

    Both inputs go through one shuffle on the key and one ordered scan. The history of a heavy
    key is cut into consecutive slices; a slice starts from the last table row before it.
    """
    table_time, table_offset = table_order
    entry = F.struct(
        F.coalesce(F.col(delete), F.lit(False)).alias("gone"),
        F.struct(*columns).alias("value"),
    )
    # The event's columns stay top-level, so those nobody reads are pruned before the shuffle.
    payload = {f"event_{i}": f for i, f in enumerate(events.schema.fields)}
    table_side = changelog.where(F.col(key).isNotNull()).select(
        F.col(key).alias("asof_key"),
        F.col(table_time).alias("asof_time"),
        F.lit(_TABLE).alias("asof_side"),
        F.col(table_offset).cast("long").alias("asof_offset"),
        entry.alias("entry"),
        *[F.lit(None).cast(f.dataType).alias(alias) for alias, f in payload.items()],
    )
    event_side = events.where(F.col(key).isNotNull()).select(
        F.col(key).alias("asof_key"),
        F.col(event_time).alias("asof_time"),
        F.lit(_EVENT).alias("asof_side"),
        # Events do not see each other; their own order among equal times is irrelevant.
        F.lit(0).cast("long").alias("asof_offset"),
        F.lit(None).cast(table_side.schema["entry"].dataType).alias("entry"),
        *[F.col(f.name).alias(alias) for alias, f in payload.items()],
    )
    groups = ["asof_key"]
    order = ["asof_time", "asof_side", "asof_offset"]
    merged = table_side.unionByName(event_side)
    whole, sliced = ordered_slices(merged, groups, order, rows_per_task)

    def seen(rows: DataFrame, parts: list[str]) -> DataFrame:
        up_to_here = (
            Window.partitionBy(*parts).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        looked_up = rows.withColumn("seen", F.last("entry", ignorenulls=True).over(up_to_here))
        return looked_up.where(F.col("asof_side") == _EVENT)

    result = seen(whole, groups).select(*payload, "seen")
    if sliced is not None:
        cut = [*groups, "slice"]
        carried = seen(sliced, cut).join(_carried_entries(sliced, groups, order), cut, "left")
        result = result.unionByName(
            carried.select(*payload, F.coalesce("seen", "carried").alias("seen"))
        )

    found = F.col("seen").isNotNull() & ~F.col("seen.gone")
    keyed = result.select(
        *[F.col(alias).alias(f.name) for alias, f in payload.items()],
        *[F.when(found, F.col("seen.value")[c]).alias(c) for c in columns],
        found.alias("matched"),
    )
    keyless = events.where(F.col(key).isNull()).select(
        *events.columns,
        *[F.lit(None).cast(changelog.schema[c].dataType).alias(c) for c in columns],
        F.lit(False).alias("matched"),
    )
    return keyed.unionByName(keyless)


def _carried_entries(sliced: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Per slice the last table row of the key's earlier slices: one row per slice."""
    closing = sliced.groupBy(*groups, "slice").agg(
        F.max_by(
            "entry", F.when(F.col("asof_side") == _TABLE, F.struct(*order))
        ).alias("closing")
    )
    earlier = (
        Window.partitionBy(*groups).orderBy("slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return closing.select(
        *groups, "slice", F.last("closing", ignorenulls=True).over(earlier).alias("carried")
    )
