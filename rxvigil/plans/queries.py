"""The registered queries: every operator run over whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxvigil import operators as O
from rxvigil import schemas as S
from rxvigil.functions import (
    dlq_topic,
    json_record,
    record_position,
    severity_label,
    transition_allowed,
)
from rxvigil.operators import frequency, surge
from rxvigil.plans.views import plain_timestamps, view
from rxvigil.session import scratch_path
from rxvigil.sources import decode, decode_failures
from rxvigil.streaming.delivery import Ledger, delivering_sink, read_committed, with_header
from rxvigil.streaming.sinks import wire_values

Query = Callable[[SparkSession, str], DataFrame]

# A small limit, so that the benchmark's documents fall on both sides of it.
DOCUMENT_LIMIT_BYTES = 4000
ENVELOPE_COLUMNS = [
    "originalTopic", "partition", "offset", "errorType", "errorMessage", "exceptionClass",
    "retryCount", "originalKeyBase64", "originalValueBase64", "processorName",
]
_RAW_SCHEMA = T.StructType([T.StructField("k", T.IntegerType(), False)])


# -- sources ------------------------------------------------------------------

def src_products(spark, sf):
    return plain_timestamps(view(spark, sf, "v_product_changelog"))


def src_alerts(spark, sf):
    return plain_timestamps(view(spark, sf, "v_alerts"))


def src_price_updates(spark, sf):
    return plain_timestamps(view(spark, sf, "v_price_updates"))


def alert_event_time(spark, sf):
    timed = O.alert_event_time(view(spark, sf, "v_undated_alerts"))
    return plain_timestamps(timed.select("key", "alertId", "ts"))


def _decoded(spark, sf):
    return decode(view(spark, sf, "v_raw"), schema=_RAW_SCHEMA)


def decode_good(spark, sf):
    good = _decoded(spark, sf).where(F.col("decode_error").isNull())
    return good.select("key", "topic", "partition", "offset", "record.k")


def decode_bad(spark, sf):
    bad = decode_failures(_decoded(spark, sf))
    return bad.select(*ENVELOPE_COLUMNS, dlq_topic("originalTopic").alias("dlqTopic"))


# -- alert enrichment ---------------------------------------------------------

def severity_labels(spark, sf):
    return view(spark, sf, "v_alerts").select(
        "alertId", "severity", severity_label("severity").alias("severityLabel")
    )


def alert_product_join(spark, sf):
    products = view(spark, sf, "v_catalogue").select("key", "productName", "marketingStatus")
    joined = O.lookup_join(view(spark, sf, "v_alerts"), products)
    return joined.select("key", "alertId", "productName", "marketingStatus", "matched")


def _enriched(spark, sf):
    return O.enrich_alerts(view(spark, sf, "v_alerts"), view(spark, sf, "v_catalogue"))


def enriched_alerts(spark, sf):
    return plain_timestamps(O.known(_enriched(spark, sf)).select("key", *S.ENRICHED_COLUMNS))


def narcotics_alerts(spark, sf):
    return plain_timestamps(O.narcotics_only(_enriched(spark, sf)).select(*S.ENRICHED_COLUMNS))


def unknown_alerts(spark, sf):
    envelopes = O.unknown_envelopes(_enriched(spark, sf))
    return envelopes.select(
        *ENVELOPE_COLUMNS,
        F.col("context")["gtin"].alias("gtin"),
        F.col("context")["alertId"].alias("alertId"),
        F.col("context")["severity"].alias("severity"),
        F.size("context").alias("contextEntries"),
    )


def _parsed(records: DataFrame, schema: str) -> DataFrame:
    """The records with the named fields of their JSON value, parsed once."""
    fields = F.from_json("value", schema).alias("json")
    return records.select("*", fields).select(*records.columns, "json.*")


def enriched_json(spark, sf):
    enriched = O.known(_enriched(spark, sf))
    records = enriched.select("key", json_record(enriched, S.ENRICHED_COLUMNS).alias("value"))
    schema = ", ".join(f"{name} string" for name in S.ENRICHED_COLUMNS)
    return _parsed(records, schema).select(
        "key",
        *S.ENRICHED_COLUMNS,
        F.col("value").contains('"narcoticsCategory":null').alias("keepsNull"),
    )


# -- price surges -------------------------------------------------------------

def confirmed_prices(spark, sf):
    return surge.confirmed_prices(view(spark, sf, "v_catalogue"))


def _baselined(spark, sf):
    prices = surge.confirmed_prices(view(spark, sf, "v_catalogue"))
    return surge.with_baseline(O.lookup_join(view(spark, sf, "v_price_updates"), prices))


def price_baseline(spark, sf):
    return _baselined(spark, sf).select(
        "key", "offset", "previousPublicPriceCHF", "confirmedPriceCHF", "baselineCHF",
        (F.col("baselineCHF") > 0.0).alias("usable"),
    )


def price_changes(spark, sf):
    changes = surge.with_change(_baselined(spark, sf))
    return changes.select("key", "offset", "baselineCHF", "newPublicPriceCHF", "changePct")


def _surges(spark, sf):
    prices = surge.confirmed_prices(view(spark, sf, "v_catalogue"))
    return O.detect_price_surges(view(spark, sf, "v_price_updates"), prices)


_SURGE_OUTPUT = [c for c in S.SURGE_COLUMNS if c != "detectedAt"]


def price_surges(spark, sf):
    return plain_timestamps(_surges(spark, sf).select("key", "offset", *_SURGE_OUTPUT))


def surge_json(spark, sf):
    surges = _surges(spark, sf)
    records = surges.select(
        "key", "offset", json_record(surges, S.SURGE_COLUMNS).alias("value")
    )
    schema = (
        "gtin string, productName string, changeReason string, effectiveDate string, "
        "previousPublicPriceCHF double, newPublicPriceCHF double, changePercent double, "
        "detectedAt string"
    )
    return _parsed(records, schema).select(
        "key", "offset", "gtin", "productName", "changeReason", "effectiveDate",
        "previousPublicPriceCHF", "newPublicPriceCHF", "changePercent",
        F.col("value").contains('"productName":null').alias("keepsNull"),
        F.col("detectedAt").endswith("Z").alias("hasDetectedAt"),
    )


def asof_price(spark, sf):
    joined = O.asof_join(
        view(spark, sf, "v_price_updates"),
        view(spark, sf, "v_product_changelog"),
        ["publicPriceCHF"],
    )
    return joined.select("key", "offset", "newPublicPriceCHF", "publicPriceCHF", "matched")


def asof_surges(spark, sf):
    joined = O.asof_join(
        view(spark, sf, "v_price_updates"),
        view(spark, sf, "v_product_changelog").withColumnRenamed("publicPriceCHF", "confirmedPriceCHF"),
        ["confirmedPriceCHF"],
    )
    surges = surge.surges(surge.with_change(surge.with_baseline(joined)))
    return plain_timestamps(surges.select("key", "offset", *_SURGE_OUTPUT))


# -- table materialisation ----------------------------------------------------

def latest_products(spark, sf):
    return plain_timestamps(O.latest_by_key(view(spark, sf, "v_product_changelog")))


# -- alert frequency ----------------------------------------------------------

def alert_window_counts(spark, sf):
    return plain_timestamps(frequency.window_counts(view(spark, sf, "v_alerts")))


def alert_frequency(spark, sf):
    return plain_timestamps(O.count_alerts(view(spark, sf, "v_alerts")))


def late_alerts(spark, sf):
    marked = frequency.mark_late(view(spark, sf, "v_delayed_alerts"))
    return plain_timestamps(marked.select("key", "partition", "offset", "ts", "streamTime", "late"))


def alert_frequency_in_arrival_order(spark, sf):
    on_time = frequency.mark_late(view(spark, sf, "v_delayed_alerts")).where(~F.col("late"))
    return plain_timestamps(O.count_alerts(on_time))


# -- catalogue admission ------------------------------------------------------

def stateless_rules(spark, sf):
    ruled = O.check_rules(view(spark, sf, "v_product_changelog"))
    return ruled.select("key", "offset", "is_delete", "rule", "message")


def _verdicts(spark, sf):
    return O.validate_catalogue(view(spark, sf, "v_product_changelog"))


def catalogue_verdicts(spark, sf):
    return plain_timestamps(_verdicts(spark, sf).select(
        "key", "ts", "offset", "marketingStatus", "verdict", "message", "priorStatus"
    ))


def status_transitions(spark, sf):
    judged = _verdicts(spark, sf).where(
        F.col("verdict").isin("OK", "ILLEGAL_STATUS_TRANSITION")
    )
    return judged.groupBy("priorStatus", F.col("marketingStatus").alias("nextStatus")).agg(
        F.count("*").alias("updates"),
    ).withColumn("allowed", transition_allowed("priorStatus", "nextStatus"))


def accepted_catalogue(spark, sf):
    columns = ["key", "ts", "offset", "productName", "marketingStatus", "publicPriceCHF",
               "narcoticsCategory"]
    # Choose the columns first: the newest row of a key is picked as a whole.
    verdicts = _verdicts(spark, sf).select(*columns, "is_delete", "verdict")
    return plain_timestamps(O.accepted_catalogue(verdicts).select(*columns))


def catalogue_dlq(spark, sf):
    envelopes = O.rejection_envelopes(_verdicts(spark, sf))
    names = ["gtin", "productName", "validationRule", "manufacturer"]
    return envelopes.select(
        *ENVELOPE_COLUMNS, *[F.col("context")[n].alias(n) for n in names],
        record_position("originalTopic", "partition", "offset").alias("dlqKey"),
    )


# -- dead letters -------------------------------------------------------------

def dlq_topics(spark, sf):
    return view(spark, sf, "v_topics").select(
        "offset", "topic", dlq_topic("topic").alias("dlqTopic")
    )


def dlq_records(spark, sf):
    records = O.dlq_records(O.rejection_envelopes(_verdicts(spark, sf)))
    schema = (
        "originalTopic string, errorType string, errorMessage string, processorName string, "
        "retryCount string, `partition` string, `offset` string, failedAt string, "
        "context map<string,string>"
    )
    return _parsed(records, schema).select(
        "topic", "key", "originalTopic", "errorType", "errorMessage", "processorName",
        "retryCount", "partition", "offset",
        F.col("context")["validationRule"].alias("validationRule"),
        F.col("value").contains("stackTrace").alias("keepsNull"),
        F.col("failedAt").endswith("Z").alias("hasFailedAt"),
    )


def _priced(spark, sf):
    updates = view(spark, sf, "v_price_updates")
    ratio = F.try_divide("newPublicPriceCHF", "previousPublicPriceCHF")
    absent = F.col("newPublicPriceCHF").isNull() | F.col("previousPublicPriceCHF").isNull()
    return O.split_failures(updates, ratio, "priceRatio", absent)


def _processing_envelopes(spark, sf):
    _, failed = _priced(spark, sf)
    return O.envelope(
        failed, "PROCESSING", F.lit("Division by zero"), "PriceRatio", {"gtin": "gtin"},
        exception_class="ArithmeticException",
    )


def processing_failures(spark, sf):
    return _processing_envelopes(spark, sf).select(
        *ENVELOPE_COLUMNS, F.col("context")["gtin"].alias("gtin")
    )


def processing_results(spark, sf):
    priced, _ = _priced(spark, sf)
    return priced.select("key", "offset", "priceRatio")


def _guarded(spark, sf):
    return O.guard_output(view(spark, sf, "v_output"), DOCUMENT_LIMIT_BYTES)


def output_guard(spark, sf):
    _, refused = _guarded(spark, sf)
    return refused.select(*ENVELOPE_COLUMNS, dlq_topic("originalTopic").alias("dlqTopic"))


def dlq_parts(spark, sf):
    """Letters of refused records beyond the size limit, put together again from their parts."""
    records = O.guard_records(view(spark, sf, "v_output"), DOCUMENT_LIMIT_BYTES)
    fits = F.octet_length("key") + F.octet_length("value") <= DOCUMENT_LIMIT_BYTES
    named = records.where(F.col("topic").startswith(S.DLQ_PREFIX)).withColumn("fits", fits)
    is_part = F.col("topic").endswith(S.DLQ_PARTS_SUFFIX)
    pointer = F.from_json("value", "context map<string,string>")["context"]["sha256"]
    letters = named.where(~is_part).select(pointer.alias("sha"), F.col("fits").alias("letter_fits"))
    number = F.split("key", "#")
    parts = named.where(is_part).select(
        number[0].alias("sha"), "fits", F.struct(number[1].cast("int").alias("n"), "value").alias("part")
    )
    whole = parts.groupBy("sha").agg(F.min("fits").alias("fits"), F.array_sort(F.collect_list("part")).alias("parts"))
    text = F.unbase64(F.array_join(F.transform("parts", lambda p: p["value"]), ""))
    joined = letters.join(whole, "sha").select(
        (F.col("fits") & F.col("letter_fits")).alias("fits"),
        (F.sha2(text, 256) == F.col("sha")).alias("intact"),
        F.from_json(text.cast("string"), "originalKeyBase64 string, originalValueBase64 string").alias("json"),
    )
    return joined.select(
        F.unbase64("json.originalKeyBase64").cast("string").alias("record"), "json.*", "fits", "intact"
    )


def dlq_unknown_topic(spark, sf):
    """Dead letters of records whose topic and position are unknown."""
    bad = _decoded(spark, sf).where(F.col("decode_error").isNotNull()).drop("topic", "partition", "offset")
    letters = O.dlq_records(O.envelope(bad, "DESERIALIZATION", F.col("decode_error"), raw_key="key"))
    fields = F.from_json("value", "errorMessage string, originalKeyBase64 string")
    return letters.select("topic", "key", fields.alias("json")).select("topic", "key", "json.*")


def output_accepted(spark, sf):
    accepted, _ = _guarded(spark, sf)
    return accepted.select("topic", "key", "value")


def output_isolated(spark, sf):
    """All documents written to a log that refuses one topic and, elsewhere, single values."""
    odd = F.col("key").cast("long") % 5000
    topic = F.when(odd == 17, F.lit("hci.refused.v1")).otherwise(F.col("topic"))
    records = view(spark, sf, "v_output").withColumn("topic", topic)
    folder = scratch_path(spark, "isolated")
    ledger = Ledger(folder, "documents")

    def append(part: DataFrame, delivery: str) -> None:
        # The log fails the task that brings it such a record.
        number = F.try_to_number(F.col("key").cast("string"), F.lit("999999999999")) % 5000
        value = (
            F.when(F.col("topic") == "hci.refused.v1", F.raise_error(F.lit("InvalidTopicException: hci.refused.v1")))
            .when(number == 42, F.raise_error(F.lit("CorruptRecordException: checksum"))).otherwise(F.col("value"))
        )
        with_header(part.withColumn("value", value), delivery).write.parquet(f"{folder}/log/{delivery}")

    delivering_sink(append, ledger, at_once=8)(wire_values(records), 0)
    written = read_committed(spark.read.parquet(f"{folder}/log/*"), ledger)
    written = written.withColumns({"key": F.col("key").cast("string"), "value": F.col("value").cast("string")})
    is_letter = F.col("topic").startswith(S.DLQ_PREFIX)
    fields = ["errorType", "exceptionClass", "originalTopic", "originalKeyBase64", "originalValueBase64"]
    letter = F.from_json(F.when(is_letter, F.col("value")), ", ".join(f"{f} string" for f in fields)).alias("letter")
    return written.select(
        "topic", "key", F.when(~is_letter, F.col("value")).alias("value"), letter
    ).select("topic", "key", "value", "letter.*")


def dlq_error_counts(spark, sf):
    _, refused = _guarded(spark, sf)
    routes = [
        decode_failures(_decoded(spark, sf)),
        O.unknown_envelopes(_enriched(spark, sf)),
        O.rejection_envelopes(_verdicts(spark, sf)),
        _processing_envelopes(spark, sf),
        refused,
    ]
    merged = routes[0]
    for route in routes[1:]:
        merged = merged.unionByName(route)
    return merged.groupBy(dlq_topic("originalTopic").alias("dlqTopic"), "errorType").agg(
        F.count("*").alias("records")
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        src_products, src_alerts, src_price_updates, alert_event_time, decode_good, decode_bad,
        severity_labels, alert_product_join, enriched_alerts, narcotics_alerts, unknown_alerts,
        enriched_json, confirmed_prices, price_baseline, price_changes, price_surges, surge_json,
        asof_price, asof_surges, latest_products, alert_window_counts, alert_frequency,
        late_alerts, alert_frequency_in_arrival_order, stateless_rules, catalogue_verdicts,
        status_transitions, accepted_catalogue, catalogue_dlq, dlq_topics, dlq_records,
        processing_failures, processing_results, output_guard, output_accepted, dlq_error_counts,
        dlq_parts, dlq_unknown_topic, output_isolated,
    )
}
QUERIES["dlq_topic"] = QUERIES.pop("dlq_topics")
