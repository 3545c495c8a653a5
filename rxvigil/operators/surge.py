"""Price surges against the independently confirmed catalogue price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.functions import half_up_2dp, positive
from rxvigil.operators.lookup import lookup_join


def confirmed_prices(catalogue: DataFrame, key: str = "key") -> DataFrame:
    return catalogue.select(key, F.col("publicPriceCHF").alias("confirmedPriceCHF"))


def with_baseline(joined: DataFrame) -> DataFrame:
    """Baseline: the confirmed price if positive, else the price the event itself names."""
    confirmed = F.col("confirmedPriceCHF")
    baseline = F.when(confirmed.isNotNull() & positive(confirmed), confirmed).otherwise(
        F.col("previousPublicPriceCHF")
    )
    return joined.withColumn("baselineCHF", baseline)


def with_change(baselined: DataFrame) -> DataFrame:
    """Unrounded percentage change; updates without a usable baseline are left out."""
    baseline = F.col("baselineCHF")
    change = ((F.col("newPublicPriceCHF") - baseline) / baseline) * F.lit(100.0)
    return baselined.where(baseline > 0.0).withColumn("changePct", change)


def price_changes(
    updates: DataFrame, prices: DataFrame, key: str = "key", **join
) -> DataFrame:
    """Update ⟕ confirmed price → baseline and change, skipping unusable baselines."""
    return with_change(with_baseline(lookup_join(updates, prices, key, **join)))


def surges(changes: DataFrame, threshold: float = S.SURGE_THRESHOLD_PERCENT) -> DataFrame:
    """Notifications for changes strictly above ``threshold``, compared before rounding."""
    carried = [c for c in ("key", "topic", "partition", "offset") if c in changes.columns]
    return changes.where(F.col("changePct") > F.lit(float(threshold))).select(
        *carried,
        "gtin",
        F.lit(None).cast("string").alias("productName"),
        F.col("baselineCHF").alias("previousPublicPriceCHF"),
        "newPublicPriceCHF",
        half_up_2dp("changePct").alias("changePercent"),
        "changeReason",
        F.col("effectiveDateUtc").alias("effectiveDate"),
        F.current_timestamp().alias("detectedAt"),
    )


def detect_price_surges(
    updates: DataFrame,
    prices: DataFrame,
    threshold: float = S.SURGE_THRESHOLD_PERCENT,
    key: str = "key",
    **join,
) -> DataFrame:
    return surges(price_changes(updates, prices, key, **join), threshold)
