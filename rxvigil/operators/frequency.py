"""Alert counts per key in tumbling event-time windows, one final result per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.functions import window_key
from rxvigil.operators.skew import ROWS_PER_TASK


def alert_event_time(alerts: DataFrame, ingest_time: str = "timestamp") -> DataFrame:
    """Event time ``ts``: when the alert was issued, else when its record was ingested."""
    return alerts.withColumn("ts", F.coalesce("issuedByUtc", ingest_time).cast("timestamp"))


def window_counts(alerts: DataFrame, window: str = S.WINDOW_DURATION, key: str = "key") -> DataFrame:
    """Count per (key, window). Partial counts combine map-side, so hot keys stay cheap."""
    return _counted(alerts, window, key).drop("newest")


def _counted(alerts: DataFrame, window: str, key: str) -> DataFrame:
    """Count and newest event time per (key, window)."""
    counted = (
        alerts.where(F.col(key).isNotNull())
        .groupBy(F.col(key), F.window("ts", window).alias("window"))
        .agg(F.count("*").alias("count"), F.max("ts").alias("newest"))
    )
    return counted.select(
        key,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "count",
        "newest",
    )


def count_alerts(
    alerts: DataFrame,
    window: str = S.WINDOW_DURATION,
    grace: str = S.GRACE_PERIOD,
    min_count: int = S.MIN_ALERT_COUNT,
    final_only: bool = True,
    key: str = "key",
) -> DataFrame:
    """Windows with at least ``min_count`` alerts, keyed ``key@start/end``.

    ``alerts`` carries event time in ``ts``. A window is final once the newest event time
    reaches its end plus ``grace``. On a stream the watermark applies this rule (use append
    mode) and drops later alerts; on a table windows still open at the end are left out.
    """
    keyed = alerts.where(F.col(key).isNotNull())
    if alerts.isStreaming:
        counts = _counted(keyed.withWatermark("ts", grace), window, key)
    else:
        counts = _counted(keyed, window, key)
        if final_only:
            # From the windows, so that the alerts are read once.
            closed_before = counts.agg(F.max("newest") - F.expr(f"INTERVAL {grace}"))
            counts = counts.where(F.col("window_end") <= closed_before.scalar())
    return counts.where(F.col("count") >= min_count).select(
        window_key(key, "window_start", "window_end").alias("summary_key"),
        key,
        "window_start",
        "window_end",
        "count",
    )


def mark_late(
    alerts: DataFrame,
    window: str = S.WINDOW_DURATION,
    grace: str = S.GRACE_PERIOD,
    rows_per_task: int = ROWS_PER_TASK,
    key: str = "key",
) -> DataFrame:
    """Replay arrival order on a table: add ``streamTime`` and ``late``.

    Stream time is the newest event time seen so far in the record's partition; an alert is
    late once its window's end plus ``grace`` is at or before it. A partition's log is cut by
    offset into slices of at most ``rows_per_task`` records, so no task holds a whole log.
    Alerts without a key are never counted: they do not move stream time and are left out.
    """
    log = ["topic", "partition"]
    sliced = alerts.where(F.col(key).isNotNull()).withColumn("slice", F.floor(F.col("offset") / rows_per_task))
    earlier = Window.partitionBy(*log).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice of a log.
    carried = (
        sliced.groupBy(*log, "slice").agg(F.max("ts").alias("newest"))
        .select(*log, "slice", F.max("newest").over(earlier).alias("carried"))
    )
    so_far = (
        Window.partitionBy(*log, "slice").orderBy("offset")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    stream_time = F.greatest(F.max("ts").over(so_far), F.col("carried"))
    closes = F.window("ts", window)["end"] + F.expr(f"INTERVAL {grace}")
    return (
        sliced.join(carried, [*log, "slice"], "left")
        .withColumn("streamTime", stream_time)
        .withColumn("closes", closes)
        .withColumn("late", F.col("closes") <= F.col("streamTime"))
        .drop("slice", "carried", "closes")
    )


def late_alerts(alerts: DataFrame, **options) -> DataFrame:
    """Alerts that arrived after their window was final; they do not count."""
    return mark_late(alerts, **options).where("late")
