"""Alert enrichment with the product catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.functions import is_blank, json_record, severity_label
from rxvigil.operators.deadletter import envelope_struct, letter, output_record
from rxvigil.operators.lookup import lookup_join

PRODUCT_FIELDS = (
    "productName", "manufacturer", "activeSubstance", "atcCode", "dosageForm", "narcoticsCategory",
)


def enrich_alerts(alerts: DataFrame, catalogue: DataFrame, key: str = "key", **join) -> DataFrame:
    """Alert ⟕ product. ``route`` is ``known`` or ``unknown``; every alert is kept.

    ``catalogue`` has one row per key. The output key is the record key, ``gtin`` comes from
    the alert itself. Positions (topic, partition, offset) pass through for dead letters.
    """
    return project_enriched(lookup_join(alerts, catalogue.select(key, *PRODUCT_FIELDS), key, **join))


def project_enriched(joined: DataFrame) -> DataFrame:
    """The enriched record of an alert already joined with its product (see ``matched``)."""
    category = F.col("narcoticsCategory")
    enriched = joined.select(
        "*",
        F.col("issuedByUtc").alias("issuedAt"),
        (category.isNotNull() & ~is_blank(category)).alias("narcotic"),
        severity_label("severity").alias("severityLabel"),
        F.when(F.col("matched"), "known").otherwise("unknown").alias("route"),
    )
    position = [c for c in ("key", "topic", "partition", "offset") if c in joined.columns]
    return enriched.select(*position, *S.ENRICHED_COLUMNS, "route")


def known(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("route") == "known")


def unknown(enriched: DataFrame) -> DataFrame:
    return enriched.where(F.col("route") == "unknown")


def narcotics_only(enriched: DataFrame) -> DataFrame:
    return known(enriched).where("narcotic")


def _unknown_envelope() -> Column:
    return envelope_struct(
        "VALIDATION",
        F.concat(F.lit("no product for GTIN "), F.coalesce("key", F.lit("null"))),
        "AlertEnrichment",
        {"gtin": "gtin", "alertId": "alertId", "severity": "severity"},
        exception_class="ValidationException",
    )


def unknown_envelopes(enriched: DataFrame) -> DataFrame:
    """VALIDATION envelopes of alerts whose product is not in the catalogue."""
    return unknown(enriched).select(_unknown_envelope().alias("envelope")).select("envelope.*")


def alert_records(
    enriched: DataFrame,
    enriched_topic: str = S.ENRICHED_TOPIC,
    narcotics_topic: str = S.NARCOTICS_TOPIC,
) -> DataFrame:
    """All output records in one pass: each known alert, a copy of each narcotic one, and a
    dead letter for each unknown one."""
    value = json_record(enriched, S.ENRICHED_COLUMNS)
    is_known = F.col("route") == "known"
    routes = F.array_compact(F.array(
        F.when(is_known, output_record(F.lit(enriched_topic), "key", value)),
        F.when(is_known & F.col("narcotic"), output_record(F.lit(narcotics_topic), "key", value)),
        F.when(~is_known, letter(_unknown_envelope())),
    ))
    return enriched.select(F.explode(routes).alias("record")).select("record.*")
