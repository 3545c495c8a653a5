"""Record schemas, value domains and defaults of the three input feeds and the outputs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Domains, names and defaults that are part of the data contract.
# ---------------------------------------------------------------------------
ALERT_TYPES = ("RECALL", "SHORTAGE", "QUALITY_DEFECT", "PRICE_SUSPENSION", "IMPORT_BAN")
SEVERITIES = ("CLASS_I", "CLASS_II", "CLASS_III", "ADVISORY")
MARKETING_STATUSES = ("ACTIVE", "SUSPENDED", "WITHDRAWN", "PENDING")
DEFAULT_MARKETING_STATUS = "ACTIVE"

SEVERITY_LABELS = {
    "CLASS_I": "CRITICAL — Immediate health risk",
    "CLASS_II": "HIGH — Possible health impact",
    "CLASS_III": "MEDIUM — Precautionary measure",
    "ADVISORY": "LOW — Advisory only",
}
UNKNOWN_SEVERITY_LABEL = "UNKNOWN"

STATUS_TRANSITIONS = {
    "PENDING": ("ACTIVE", "WITHDRAWN"),
    "ACTIVE": ("SUSPENDED", "WITHDRAWN"),
    "SUSPENDED": ("ACTIVE", "WITHDRAWN"),
    "WITHDRAWN": (),
}

TOPIC_PREFIX = "hci."
DLQ_PREFIX = "hci.dlq."
DLQ_PARTS_SUFFIX = ".parts"
DLQ_UNKNOWN_TOPIC = "hci.dlq.unknown.v1"
PRODUCTS_TOPIC = "hci.medicinal-products.avro"
ALERTS_TOPIC = "hci.drug-alerts.avro"
PRICES_TOPIC = "hci.price-updates.avro"
ENRICHED_TOPIC = "hci.alerts.enriched.avro"
NARCOTICS_TOPIC = "hci.alerts.narcotics.avro"
SUMMARY_TOPIC = "hci.products.alert-summary.avro"
SURGE_TOPIC = "hci.prices.surge-notifications.avro"

SURGE_THRESHOLD_PERCENT = 15.0
WINDOW_DURATION = "60 minutes"
GRACE_PERIOD = "10 minutes"
MIN_ALERT_COUNT = 2
MAX_RECORD_BYTES = 1024 * 1024


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_STR, _DBL, _TS = T.StringType(), T.DoubleType(), T.TimestampType()

# Field names, types and nullability of the records.
MEDICINAL_PRODUCT = _struct(
    ("gtin", _STR, False),
    ("authorizationNumber", _STR, False),
    ("productName", _STR, False),
    ("atcCode", _STR, False),
    ("dosageForm", _STR, False),
    ("manufacturer", _STR, False),
    ("activeSubstance", _STR, False),
    ("marketingStatus", _STR, False),
    ("exFactoryPriceCHF", _DBL, False),
    ("publicPriceCHF", _DBL, False),
    ("lastUpdatedUtc", _TS, False),
    ("dataSource", _STR, False),
    ("packageSize", _STR, True),
    ("narcoticsCategory", _STR, True),
)

DRUG_ALERT = _struct(
    ("alertId", _STR, False),
    ("gtin", _STR, False),
    ("alertType", _STR, False),
    ("severity", _STR, False),
    ("headline", _STR, False),
    ("description", _STR, False),
    ("affectedLots", T.ArrayType(_STR), False),
    ("issuedByUtc", _TS, False),
    ("expiresUtc", _TS, True),
    ("sourceUrl", _STR, False),
)

PRICE_UPDATE = _struct(
    ("gtin", _STR, False),
    ("previousExFactoryPriceCHF", _DBL, False),
    ("newExFactoryPriceCHF", _DBL, False),
    ("previousPublicPriceCHF", _DBL, False),
    ("newPublicPriceCHF", _DBL, False),
    ("effectiveDateUtc", _TS, False),
    ("changeReason", _STR, False),
    ("changedBy", _STR, False),
    ("approvalReference", _STR, True),
)

DLQ_ENVELOPE = _struct(
    ("originalTopic", _STR, True),
    ("partition", T.IntegerType(), True),
    ("offset", T.LongType(), True),
    ("errorType", _STR, True),
    ("errorMessage", _STR, True),
    ("exceptionClass", _STR, True),
    ("stackTrace", _STR, True),
    ("retryCount", T.IntegerType(), True),
    ("originalKeyBase64", _STR, True),
    ("originalValueBase64", _STR, True),
    ("failedAt", _STR, True),
    ("processorName", _STR, True),
    ("context", T.MapType(_STR, _STR), True),
)

# A record as it arrives: raw bytes plus its position. These are the columns Spark's
# message-log sources yield, so only ``format`` and ``options`` differ per deployment.
RAW_RECORD = _struct(
    ("key", T.BinaryType(), True),
    ("value", T.BinaryType(), True),
    ("topic", _STR, True),
    ("partition", T.IntegerType(), True),
    ("offset", T.LongType(), True),
    ("timestamp", _TS, True),
)

ENRICHED_COLUMNS = (
    "alertId", "gtin", "alertType", "severity", "headline", "description", "issuedAt",
    "productName", "manufacturer", "activeSubstance", "atcCode", "dosageForm",
    "narcoticsCategory", "narcotic", "severityLabel",
)

SURGE_COLUMNS = (
    "gtin", "productName", "previousPublicPriceCHF", "newPublicPriceCHF",
    "changePercent", "changeReason", "effectiveDate", "detectedAt",
)


@dataclass(frozen=True)
class Feed:
    """What a decoder needs to know about one feed."""

    topic: str
    schema: T.StructType
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # SQL text of the value a field takes when it is absent.
    defaults: dict[str, str] = field(default_factory=dict)


PRODUCT_FEED = Feed(
    PRODUCTS_TOPIC,
    MEDICINAL_PRODUCT,
    domains={"marketingStatus": MARKETING_STATUSES},
    defaults={"marketingStatus": f"'{DEFAULT_MARKETING_STATUS}'"},
)
ALERT_FEED = Feed(
    ALERTS_TOPIC,
    DRUG_ALERT,
    domains={"alertType": ALERT_TYPES, "severity": SEVERITIES},
    defaults={"affectedLots": "cast(array() as array<string>)"},
)
PRICE_FEED = Feed(PRICES_TOPIC, PRICE_UPDATE)
