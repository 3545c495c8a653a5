"""Plain SQL giving the expected result of each registered query."""

from __future__ import annotations

from rxvigil.plans.queries import DOCUMENT_LIMIT_BYTES
from rxvigil.plans.views import VIEWS, view_sql


def _names(view: str, without: tuple[str, ...] = ()) -> str:
    return ", ".join(f'"{c}"' for c in VIEWS[view][1] if c not in without)


def _with(views: str, *ctes: str, select: str, recursive: bool = False) -> str:
    parts = [view_sql(*views.split()), *ctes]
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + select


def _iso(ts: str) -> str:
    whole = f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"
    micros = f"(epoch_us({ts}) % 1000000)"
    return (
        f"{whole} || CASE WHEN {micros} = 0 THEN '' "
        f"WHEN {micros} % 1000 = 0 THEN '.' || lpad(CAST({micros} // 1000 AS VARCHAR), 3, '0') "
        f"ELSE '.' || lpad(CAST({micros} AS VARCHAR), 6, '0') END || 'Z'"
    )


_LABEL = """CASE WHEN severity IS NULL THEN 'UNKNOWN'
  WHEN severity = 'CLASS_I' THEN 'CRITICAL — Immediate health risk'
  WHEN severity = 'CLASS_II' THEN 'HIGH — Possible health impact'
  WHEN severity = 'CLASS_III' THEN 'MEDIUM — Precautionary measure'
  WHEN severity = 'ADVISORY' THEN 'LOW — Advisory only' END"""

_ENRICHED = f"""enriched AS (
  SELECT a.key, a."partition", a."offset", a."alertId", a.gtin, a."alertType", a.severity, a.headline,
    a.description, a."issuedByUtc" AS "issuedAt", c."productName", c.manufacturer,
    c."activeSubstance", c."atcCode", c."dosageForm", c."narcoticsCategory",
    coalesce(trim(c."narcoticsCategory") <> '', false) AS narcotic,
    {_LABEL} AS "severityLabel", c.key IS NOT NULL AS matched
  FROM v_alerts a LEFT JOIN v_catalogue c ON a.key = c.key)"""
_ENRICHED_NAMES = (
    '"alertId", gtin, "alertType", severity, headline, description, "issuedAt", "productName", '
    'manufacturer, "activeSubstance", "atcCode", "dosageForm", "narcoticsCategory", narcotic, '
    '"severityLabel"'
)

_CHANGES = """baselined AS (
  SELECT u.*, c."publicPriceCHF" AS "confirmedPriceCHF",
    CASE WHEN c."publicPriceCHF" > 0 THEN c."publicPriceCHF" ELSE u."previousPublicPriceCHF" END AS "baselineCHF"
  FROM v_price_updates u LEFT JOIN v_catalogue c ON u.key = c.key),
changes AS (
  SELECT *, (("newPublicPriceCHF" - "baselineCHF") / "baselineCHF") * 100.0::DOUBLE AS "changePct"
  FROM baselined WHERE "baselineCHF" > 0)"""
_SURGES = """surges AS (
  SELECT key, "offset", gtin, CAST(NULL AS VARCHAR) AS "productName",
    "baselineCHF" AS "previousPublicPriceCHF", "newPublicPriceCHF",
    floor("changePct" * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS "changePercent",
    "changeReason", "effectiveDateUtc" AS "effectiveDate"
  FROM changes WHERE "changePct" > 15.0::DOUBLE)"""

_ASOF = """timed AS (
  SELECT u.*, CASE WHEN NOT t.is_delete THEN t."publicPriceCHF" END AS price,
    coalesce(NOT t.is_delete, false) AS matched
  FROM v_price_updates u ASOF LEFT JOIN (
    SELECT * FROM v_product_changelog
    QUALIFY row_number() OVER (PARTITION BY key, ts ORDER BY "offset" DESC) = 1) t
  ON u.key = t.key AND u.ts >= t.ts)"""

_WINDOWS = """windows AS (
  SELECT key, time_bucket(INTERVAL '60 minutes', ts, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL '60 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '60 minutes' AS window_end,
    count(*) AS "count"
  FROM {source} GROUP BY ALL)"""
_CLOSED = f"""SELECT key || '@' || {_iso('window_start')} || '/' || {_iso('window_end')} AS summary_key,
  key, window_start, window_end, "count"
FROM windows WHERE "count" >= 2 AND window_end <= (SELECT max(ts) - INTERVAL '10 minutes' FROM {{source}})"""

_LATE = """marked AS (
  SELECT *, max(ts) OVER (PARTITION BY "partition" ORDER BY "offset") AS "streamTime",
    time_bucket(INTERVAL '60 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '70 minutes'
      <= max(ts) OVER (PARTITION BY "partition" ORDER BY "offset") AS late
  FROM v_delayed_alerts WHERE key IS NOT NULL),
on_time AS (SELECT * FROM marked WHERE NOT late)"""

_RULES = """ruled AS (
  SELECT *, CASE WHEN is_delete THEN NULL
      WHEN key IS NULL OR trim(key) = '' THEN 'GTIN_REQUIRED'
      WHEN "marketingStatus" = 'PENDING' AND trim("authorizationNumber") = '' THEN 'AUTH_NUMBER_REQUIRED'
      WHEN "publicPriceCHF" < "exFactoryPriceCHF" THEN 'PRICE_INVERSION'
      WHEN trim("narcoticsCategory") = '' THEN 'NARCOTICS_CATEGORY_BLANK' END AS rule
  FROM v_product_changelog),
explained AS (
  SELECT *, CASE rule
      WHEN 'GTIN_REQUIRED' THEN 'GTIN key is null or empty'
      WHEN 'AUTH_NUMBER_REQUIRED' THEN 'PENDING product must have a Swissmedic authorisation number'
      WHEN 'PRICE_INVERSION' THEN
        'Public price CHF ' || printf('%.2f', "publicPriceCHF") || ' < ex-factory price CHF ' ||
        printf('%.2f', floor("exFactoryPriceCHF" * 100 + 0.5) / 100) || ' — impossible'
      WHEN 'NARCOTICS_CATEGORY_BLANK' THEN
        'narcoticsCategory is present but blank — must be null or a valid BetmG code'
    END AS rule_message FROM ruled)"""

# The verdicts one by one: each key's rows in order, carrying the status before every row.
_FOLD = """matrix AS (
  SELECT * FROM (VALUES ('PENDING', 'ACTIVE'), ('PENDING', 'WITHDRAWN'), ('ACTIVE', 'SUSPENDED'),
    ('ACTIVE', 'WITHDRAWN'), ('SUSPENDED', 'ACTIVE'), ('SUSPENDED', 'WITHDRAWN'),
    ('ACTIVE', 'ACTIVE'), ('SUSPENDED', 'SUSPENDED'), ('PENDING', 'PENDING'),
    ('WITHDRAWN', 'WITHDRAWN')) t(a, b)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, "offset") AS rn FROM explained),
fold AS (
  SELECT n.key, n.rn, CAST(NULL AS VARCHAR) AS prior,
    CASE WHEN n.is_delete OR n.rule IS NOT NULL THEN NULL ELSE n."marketingStatus" END AS after
  FROM numbered n WHERE n.rn = 1
  UNION ALL
  SELECT n.key, n.rn, f.after AS prior,
    CASE WHEN n.is_delete THEN NULL
      WHEN n.rule IS NOT NULL THEN f.after
      WHEN f.after IS NULL OR EXISTS (
        SELECT 1 FROM matrix m WHERE m.a = f.after AND m.b = n."marketingStatus") THEN n."marketingStatus"
      ELSE f.after END AS after
  FROM fold f JOIN numbered n ON n.key = f.key AND n.rn = f.rn + 1),
verdicts AS (
  SELECT n.*, CASE WHEN n.is_delete OR n.rule IS NOT NULL THEN NULL ELSE f.prior END AS "priorStatus",
    CASE WHEN n.is_delete THEN 'TOMBSTONE'
      WHEN n.rule IS NOT NULL THEN n.rule
      WHEN f.prior IS NULL OR EXISTS (
        SELECT 1 FROM matrix m WHERE m.a = f.prior AND m.b = n."marketingStatus") THEN 'OK'
      ELSE 'ILLEGAL_STATUS_TRANSITION' END AS verdict
  FROM numbered n JOIN fold f ON n.key = f.key AND n.rn = f.rn),
judged AS (
  SELECT *, CASE WHEN verdict = 'ILLEGAL_STATUS_TRANSITION'
    THEN 'Status transition ' || "priorStatus" || ' → ' || "marketingStatus" || ' is not permitted'
    ELSE rule_message END AS message FROM verdicts)"""

_OVERSIZED = f"strlen(key) + strlen(value) > {DOCUMENT_LIMIT_BYTES}"
_REJECTED = "verdict NOT IN ('OK', 'TOMBSTONE')"


def _envelope(
    error_type: str,
    message: str,
    topic: str = "topic",
    partition: str = '"partition"',
    offset: str = '"offset"',
    exception: str = "CAST(NULL AS VARCHAR)",
    key: str = "CAST(NULL AS VARCHAR)",
    value: str = "CAST(NULL AS VARCHAR)",
    processor: str = "CAST(NULL AS VARCHAR)",
) -> str:
    return (
        f'{topic} AS "originalTopic", {partition} AS "partition", {offset} AS "offset", '
        f"""'{error_type}' AS "errorType", {message} AS "errorMessage", {exception} AS "exceptionClass", """
        f'0 AS "retryCount", {key} AS "originalKeyBase64", {value} AS "originalValueBase64", '
        f'{processor} AS "processorName"'
    )


def _b64(text: str) -> str:
    return f"to_base64(encode({text}))"


_DLQ_ALERTS = "'hci.dlq.drug-alerts.avro'"
_BAD = "\"offset\" % 50 IN (0, 1, 2)"
_REJECTION = _envelope("VALIDATION", "message", processor="'ProductCatalogueProcessor'")


def _all(view: str) -> str:
    return _with(view, select=f"SELECT {_names(view)} FROM {view}")


ORACLES: dict[str, str] = {
    "src_products": _all("v_product_changelog"),
    "src_alerts": _all("v_alerts"),
    "src_price_updates": _all("v_price_updates"),
    "alert_event_time": _with(
        "v_undated_alerts",
        select='SELECT key, "alertId", coalesce("issuedByUtc", "timestamp") AS ts FROM v_undated_alerts',
    ),
    "decode_good": _with("v_raw", select=f"""
SELECT key, topic, "partition", "offset", CAST(json_extract(value, '$.k') AS INTEGER) AS k
FROM v_raw WHERE NOT {_BAD}"""),
    "decode_bad": _with("v_raw", select=f"""
SELECT {_envelope('DESERIALIZATION', "'malformed value'", exception="'SerializationException'",
                  key=_b64('key'), value=_b64('value'))}, {_DLQ_ALERTS} AS "dlqTopic"
FROM v_raw WHERE {_BAD}"""),
    "severity_labels": _with(
        "v_alerts", select=f'SELECT "alertId", severity, {_LABEL} AS "severityLabel" FROM v_alerts'
    ),
    "alert_product_join": _with("v_alerts v_catalogue", select="""
SELECT a.key, a."alertId", c."productName", c."marketingStatus", c.key IS NOT NULL AS matched
FROM v_alerts a LEFT JOIN v_catalogue c ON a.key = c.key"""),
    "enriched_alerts": _with(
        "v_alerts v_catalogue", _ENRICHED,
        select=f"SELECT key, {_ENRICHED_NAMES} FROM enriched WHERE matched",
    ),
    "narcotics_alerts": _with(
        "v_alerts v_catalogue", _ENRICHED,
        select=f"SELECT {_ENRICHED_NAMES} FROM enriched WHERE matched AND narcotic",
    ),
    "unknown_alerts": _with("v_alerts v_catalogue", select=f"""
SELECT {_envelope('VALIDATION', "'no product for GTIN ' || key", exception="'ValidationException'",
                  processor="'AlertEnrichment'")},
  gtin, "alertId", severity, CASE WHEN severity IS NULL THEN 2 ELSE 3 END AS "contextEntries"
FROM v_alerts a WHERE NOT EXISTS (SELECT 1 FROM v_catalogue c WHERE c.key = a.key)"""),
    "enriched_json": _with("v_alerts v_catalogue", _ENRICHED, select=f"""
SELECT key, "alertId", gtin, "alertType", severity, headline, description,
  {_iso('"issuedAt"')} AS "issuedAt", "productName", manufacturer, "activeSubstance", "atcCode",
  "dosageForm", "narcoticsCategory", CAST(narcotic AS VARCHAR) AS narcotic, "severityLabel",
  "narcoticsCategory" IS NULL AS "keepsNull"
FROM enriched WHERE matched"""),
    "confirmed_prices": _with(
        "v_catalogue", select='SELECT key, "publicPriceCHF" AS "confirmedPriceCHF" FROM v_catalogue'
    ),
    "price_baseline": _with("v_price_updates v_catalogue", _CHANGES, select="""
SELECT key, "offset", "previousPublicPriceCHF", "confirmedPriceCHF", "baselineCHF",
  "baselineCHF" > 0 AS usable FROM baselined"""),
    "price_changes": _with("v_price_updates v_catalogue", _CHANGES, select="""
SELECT key, "offset", "baselineCHF", "newPublicPriceCHF", "changePct" FROM changes"""),
    "price_surges": _with(
        "v_price_updates v_catalogue", _CHANGES, _SURGES, select="SELECT * FROM surges"
    ),
    "surge_json": _with("v_price_updates v_catalogue", _CHANGES, _SURGES, select=f"""
SELECT key, "offset", gtin, "productName", "changeReason", {_iso('"effectiveDate"')} AS "effectiveDate",
  "previousPublicPriceCHF", "newPublicPriceCHF", "changePercent",
  true AS "keepsNull", true AS "hasDetectedAt" FROM surges"""),
    "asof_price": _with("v_price_updates v_product_changelog", _ASOF, select="""
SELECT key, "offset", "newPublicPriceCHF", price AS "publicPriceCHF", matched FROM timed"""),
    "asof_surges": _with(
        "v_price_updates v_product_changelog", _ASOF,
        """baselined AS (
  SELECT *, CASE WHEN price > 0 THEN price ELSE "previousPublicPriceCHF" END AS "baselineCHF" FROM timed),
changes AS (
  SELECT *, (("newPublicPriceCHF" - "baselineCHF") / "baselineCHF") * 100.0::DOUBLE AS "changePct"
  FROM baselined WHERE "baselineCHF" > 0)""",
        _SURGES, select="SELECT * FROM surges",
    ),
    "latest_products": _with("v_product_changelog", select=f"""
SELECT {_names('v_product_changelog')} FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, "offset" DESC) AS rn
  FROM v_product_changelog) t WHERE rn = 1 AND NOT is_delete"""),
    "alert_window_counts": _with(
        "v_alerts", _WINDOWS.format(source="v_alerts"), select="SELECT * FROM windows"
    ),
    "alert_frequency": _with(
        "v_alerts", _WINDOWS.format(source="v_alerts"), select=_CLOSED.format(source="v_alerts")
    ),
    "late_alerts": _with("v_delayed_alerts", _LATE, select="""
SELECT key, "partition", "offset", ts, "streamTime", late FROM marked"""),
    "alert_frequency_in_arrival_order": _with(
        "v_delayed_alerts", _LATE, _WINDOWS.format(source="on_time"),
        select=_CLOSED.format(source="on_time"),
    ),
    "stateless_rules": _with("v_product_changelog", _RULES, select="""
SELECT key, "offset", is_delete, rule, rule_message AS message FROM explained"""),
    "catalogue_verdicts": _with("v_product_changelog", _RULES, _FOLD, recursive=True, select="""
SELECT key, ts, "offset", "marketingStatus", verdict, message, "priorStatus" FROM judged"""),
    "status_transitions": _with("v_product_changelog", _RULES, _FOLD, recursive=True, select="""
SELECT "priorStatus", "marketingStatus" AS "nextStatus", count(*) AS updates,
  bool_and(verdict = 'OK') AS allowed
FROM judged WHERE verdict IN ('OK', 'ILLEGAL_STATUS_TRANSITION') GROUP BY 1, 2"""),
    "accepted_catalogue": _with("v_product_changelog", _RULES, _FOLD, recursive=True, select="""
SELECT key, ts, "offset", "productName", "marketingStatus", "publicPriceCHF", "narcoticsCategory"
FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, "offset" DESC) AS newest
  FROM judged WHERE verdict IN ('OK', 'TOMBSTONE')) t
WHERE newest = 1 AND verdict = 'OK'"""),
    "catalogue_dlq": _with("v_product_changelog", _RULES, _FOLD, recursive=True, select=f"""
SELECT {_REJECTION}, key AS gtin, "productName", verdict AS "validationRule", manufacturer,
  topic || '/' || "partition" || '/' || "offset" AS "dlqKey"
FROM judged WHERE {_REJECTED}"""),
    "dlq_topic": _with("v_topics", select="""
SELECT "offset", topic, CASE WHEN topic IS NULL THEN 'hci.dlq.unknown.v1'
  ELSE 'hci.dlq.' || regexp_replace(topic, '^hci\\.', '') END AS "dlqTopic" FROM v_topics"""),
    "dlq_records": _with("v_product_changelog", _RULES, _FOLD, recursive=True, select=f"""
SELECT 'hci.dlq.medicinal-products.avro' AS topic,
  topic || '/' || "partition" || '/' || "offset" AS key, topic AS "originalTopic",
  'VALIDATION' AS "errorType", message AS "errorMessage",
  'ProductCatalogueProcessor' AS "processorName", '0' AS "retryCount",
  CAST("partition" AS VARCHAR) AS "partition", CAST("offset" AS VARCHAR) AS "offset",
  verdict AS "validationRule", false AS "keepsNull", true AS "hasFailedAt"
FROM judged WHERE {_REJECTED}"""),
    "processing_failures": _with("v_price_updates", select=f"""
SELECT {_envelope('PROCESSING', "'Division by zero'", exception="'ArithmeticException'",
                  processor="'PriceRatio'")}, gtin
FROM v_price_updates WHERE "previousPublicPriceCHF" = 0"""),
    "processing_results": _with("v_price_updates", select="""
SELECT key, "offset", "newPublicPriceCHF" / "previousPublicPriceCHF" AS "priceRatio"
FROM v_price_updates WHERE "previousPublicPriceCHF" <> 0"""),
    "output_guard": _with("v_output", select=f"""
SELECT {_envelope('PRODUCTION',
                  f"'record of ' || (strlen(key) + strlen(value)) || ' bytes exceeds the limit of {DOCUMENT_LIMIT_BYTES}'",
                  partition='-1', offset='CAST(-1 AS BIGINT)', exception="'RecordTooLargeException'",
                  key=_b64('key'), value=_b64('value'))},
  'hci.dlq.alerts.enriched.avro' AS "dlqTopic"
FROM v_output WHERE {_OVERSIZED}"""),
    "output_accepted": _with("v_output", select=f"""
SELECT topic, key, value FROM v_output WHERE NOT {_OVERSIZED}"""),
    "dlq_parts": _with("v_output", select=f"""
SELECT key AS record, {_b64("key")} AS "originalKeyBase64", {_b64("value")} AS "originalValueBase64", true AS fits,
  true AS intact
FROM v_output WHERE {_OVERSIZED}"""),
    "output_isolated": _with("v_output", select=f"""
SELECT topic, key, value, NULL AS "errorType", NULL AS "exceptionClass", NULL AS "originalTopic",
  NULL AS "originalKeyBase64", NULL AS "originalValueBase64"
FROM v_output WHERE CAST(key AS BIGINT) % 5000 NOT IN (17, 42)
UNION ALL
SELECT 'hci.dlq.' || substr(refused, 5), refused || '/-1/-1', NULL, 'PRODUCTION', exception, refused,
  {_b64('key')}, {_b64('value')}
FROM (
  SELECT *, CASE CAST(key AS BIGINT) % 5000 WHEN 17 THEN 'hci.refused.v1' ELSE topic END AS refused,
    CASE CAST(key AS BIGINT) % 5000 WHEN 17 THEN 'InvalidTopicException' ELSE 'CorruptRecordException' END AS exception
  FROM v_output WHERE CAST(key AS BIGINT) % 5000 IN (17, 42))"""),
    "dlq_unknown_topic": _with("v_raw", select=f"""
SELECT 'hci.dlq.unknown.v1' AS topic, 'unknown/-1/-1' AS key, 'malformed value' AS "errorMessage",
  {_b64('key')} AS "originalKeyBase64" FROM v_raw WHERE {_BAD}"""),
    "dlq_error_counts": _with(
        "v_raw v_alerts v_catalogue v_product_changelog v_price_updates v_output",
        _RULES, _FOLD, recursive=True, select=f"""
SELECT * FROM (
  SELECT {_DLQ_ALERTS} AS "dlqTopic", 'DESERIALIZATION' AS "errorType", count(*) AS records
  FROM v_raw WHERE {_BAD}
  UNION ALL SELECT {_DLQ_ALERTS}, 'VALIDATION', count(*) FROM v_alerts a
  WHERE NOT EXISTS (SELECT 1 FROM v_catalogue c WHERE c.key = a.key)
  UNION ALL SELECT 'hci.dlq.medicinal-products.avro', 'VALIDATION', count(*) FROM judged WHERE {_REJECTED}
  UNION ALL SELECT 'hci.dlq.price-updates.avro', 'PROCESSING', count(*) FROM v_price_updates
  WHERE "previousPublicPriceCHF" = 0
  UNION ALL SELECT 'hci.dlq.alerts.enriched.avro', 'PRODUCTION', count(*) FROM v_output
  WHERE {_OVERSIZED}) t WHERE records > 0"""),
}

# -- streaming runs: the tables arrive in batches, the wire carries milliseconds, and alerts without a
# severity are refused --

_WIRE_ALERTS = """wire_alerts AS (
  SELECT * REPLACE (date_trunc('milliseconds', ts) AS ts, date_trunc('milliseconds', "issuedByUtc") AS "issuedByUtc")
  FROM v_alerts_in_batches WHERE severity IS NOT NULL)"""
_WIRE_ENRICHED = _ENRICHED.replace("FROM v_alerts a", "FROM wire_alerts a").replace(
    "v_catalogue c ON a.key = c.key", "v_catalogue_in_batches c ON a.key = c.key AND c.arrives <= a.arrives"
)
_WIRE_FIELDS = f"""key, "alertId", gtin, "alertType", severity, {_iso('"issuedAt"')} AS "issuedAt", "productName",
  manufacturer, "narcoticsCategory", CAST(narcotic AS VARCHAR) AS narcotic,
  "severityLabel" AS "severityLabel" """
# Alerts whose window was not closed by what earlier batches brought.
_PUNCTUAL = """newest AS (
  SELECT a.arrives, max(e.ts) AS seen FROM (SELECT DISTINCT arrives FROM wire_alerts) a
  LEFT JOIN wire_alerts e ON e.arrives < a.arrives GROUP BY 1),
punctual AS (
  SELECT w.* FROM wire_alerts w JOIN newest n ON w.arrives = n.arrives
  WHERE n.seen IS NULL OR
    time_bucket(INTERVAL '60 minutes', w.ts, TIMESTAMP '1970-01-01') + INTERVAL '70 minutes' > n.seen)"""
_BATCH_RULES = _RULES.replace("v_product_changelog", "v_changelog_in_batches")
_BATCH_FOLD = _FOLD.replace('ORDER BY ts, "offset") AS rn', 'ORDER BY arrives, ts, "offset") AS rn')

ORACLES.update({
    "stream_enriched_alerts": _with(
        "v_alerts_in_batches v_catalogue_in_batches", _WIRE_ALERTS, _WIRE_ENRICHED, select=f"""
SELECT 'hci.alerts.enriched.avro' AS topic, {_WIRE_FIELDS} FROM enriched WHERE matched
UNION ALL
SELECT 'hci.alerts.narcotics.avro' AS topic, {_WIRE_FIELDS} FROM enriched WHERE matched AND narcotic"""),
    "stream_alert_dead_letters": _with("v_alerts_in_batches v_catalogue_in_batches", select=f"""
SELECT {_DLQ_ALERTS} AS topic, topic || '/' || "partition" || '/' || "offset" AS key,
  CASE WHEN severity IS NULL THEN 'DESERIALIZATION' ELSE 'VALIDATION' END AS "errorType",
  CASE WHEN severity IS NULL THEN 'missing required field severity'
    ELSE 'no product for GTIN ' || key END AS "errorMessage"
FROM v_alerts_in_batches a
WHERE severity IS NULL OR NOT EXISTS (
  SELECT 1 FROM v_catalogue_in_batches c WHERE c.key = a.key AND c.arrives <= a.arrives)"""),
    "stream_price_surges": _with("v_price_updates v_catalogue", _CHANGES, _SURGES, select=f"""
SELECT key, gtin, "changeReason", {_iso('"effectiveDate"')} AS "effectiveDate",
  "previousPublicPriceCHF", "newPublicPriceCHF", "changePercent" FROM surges"""),
    "stream_alert_frequency": _with(
        "v_alerts_in_batches", _WIRE_ALERTS, _PUNCTUAL, _WINDOWS.format(source="punctual"),
        f"closed AS ({_CLOSED.format(source='wire_alerts')})",
        select=f"""SELECT 'hci.products.alert-summary.avro' AS topic, summary_key AS key, "count" FROM closed
UNION ALL
SELECT {_DLQ_ALERTS}, topic || '/' || "partition" || '/' || "offset", NULL FROM v_alerts_in_batches
WHERE severity IS NULL"""),
    "stream_catalogue_admission": _with(
        "v_changelog_in_batches", _BATCH_RULES, _BATCH_FOLD, recursive=True, select=f"""
SELECT 'catalogue.accepted' AS topic, key,
  CASE WHEN verdict = 'OK' THEN "marketingStatus" END AS "marketingStatus",
  CASE WHEN verdict = 'OK' THEN "publicPriceCHF" END AS "publicPriceCHF",
  CAST(NULL AS VARCHAR) AS "errorMessage", CAST(NULL AS VARCHAR) AS "validationRule"
FROM judged WHERE NOT ({_REJECTED})
UNION ALL
SELECT 'hci.dlq.medicinal-products.avro', topic || '/' || "partition" || '/' || "offset",
  NULL, NULL, message, verdict FROM judged WHERE {_REJECTED}"""),
    "stream_catalogue_verdicts": _with("v_changelog_in_batches", _BATCH_RULES, _BATCH_FOLD, recursive=True, select="""
SELECT key, ts, "offset", "marketingStatus", verdict, message, "priorStatus" FROM judged"""),
    "stream_asof_price": ORACLES["asof_price"],
    "stream_asof_in_time_order": ORACLES["asof_price"],
    "stream_processing_failures": _with("v_price_updates_delayed", select="""
SELECT CASE WHEN failed THEN 'hci.dlq.price-updates.avro' ELSE 'price.ratios' END AS topic,
  CASE WHEN failed THEN topic || '/' || "partition" || '/' || "offset" ELSE key END AS key,
  CASE WHEN NOT failed THEN gtin END AS gtin,
  CASE WHEN NOT failed THEN new / previous END AS "priceRatio", CASE WHEN NOT failed THEN previous / (1300 - new) END AS headroom,
  CASE WHEN failed THEN 'PROCESSING' END AS "errorType",
  CASE WHEN previous = 0 THEN 'no previous price' WHEN new = 1300 THEN 'price at its cap' END AS "errorMessage",
  CASE WHEN previous = 0 THEN 'ArithmeticException' WHEN new = 1300 THEN 'IllegalStateException' END AS "exceptionClass",
  CASE WHEN failed THEN 'PriceRatio' END AS "processorName",
  CASE WHEN previous = 0 AND new = 1300 THEN 'priceRatio,headroom' WHEN previous = 0 THEN 'priceRatio'
    WHEN new = 1300 THEN 'headroom' END AS "failedExpressions"
FROM (SELECT *, previous = 0 OR new = 1300 AS failed FROM (
  SELECT *, CAST("previousPublicPriceCHF" AS DOUBLE) AS previous, CAST("newPublicPriceCHF" AS DOUBLE) AS new
  FROM v_price_updates_delayed))"""),
    "stream_delivered_once": _with("v_alerts_in_batches", select="""
SELECT topic, key, "alertId", severity, true AS repeats FROM v_alerts_in_batches"""),
})
