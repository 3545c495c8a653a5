"""Small cases with known answers: enrichment, surges, dead letters, windows, expressions."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.functions import dlq_topic, half_up_2dp, is_blank, iso_instant, json_record
from rxvigil.operators import (
    Guarded,
    alert_event_time,
    alert_records,
    count_alerts,
    detect_price_surges,
    dlq_records,
    enrich_alerts,
    envelope,
    guard_expressions,
    guard_output,
    guard_records,
    known,
    late_alerts,
    narcotics_only,
    price_changes,
    processing_routes,
    split_failures,
    unknown,
    unknown_envelopes,
)
from rxvigil.operators.frequency import mark_late
from rxvigil.sources import split_decoded
from tests.builders import T0, alerts, at, one_row, prices, products, updates


# -- alert enrichment ---------------------------------------------------------

def test_known_product_is_enriched(spark):
    catalogue = products(spark, ("1000000000011", "Samplin 20mg", None))
    [row] = known(enrich_alerts(
        alerts(spark, ("a-1", "1000000000011", "RECALL", "CLASS_I")), catalogue)).collect()
    assert (row.alertId, row.gtin) == ("a-1", "1000000000011")
    assert (row.productName, row.manufacturer) == ("Samplin 20mg", "Muster Labs")
    assert row.narcotic is False and "CRITICAL" in row.severityLabel


def test_narcotic_alert_is_in_both_outputs(spark):
    catalogue = products(spark, ("1000000000033", "Opiatin 5mg", "BetmG-A"))
    enriched = enrich_alerts(
        alerts(spark, ("n-1", "1000000000033", "RECALL", "CLASS_I")), catalogue)
    [row] = known(enriched).collect()
    assert row.narcotic and row.narcoticsCategory == "BetmG-A"
    assert narcotics_only(enriched).select("alertId").collect() == [("n-1",)]
    assert [r.topic for r in alert_records(enriched).collect()] == [S.ENRICHED_TOPIC, S.NARCOTICS_TOPIC]


@pytest.mark.parametrize("category", [None, "", " ", "\t", " \n"])
def test_blank_category_is_no_narcotic(spark, category):
    catalogue = products(spark, ("1000000000022", "Paracetamol 500mg", category))
    enriched = enrich_alerts(alerts(spark, ("a", "1000000000022", "SHORTAGE", "ADVISORY")), catalogue)
    assert known(enriched).count() == 1 and narcotics_only(enriched).count() == 0


def test_unknown_product_yields_only_a_dead_letter(spark):
    catalogue = products(spark, ("other", "Other", None))
    enriched = enrich_alerts(
        alerts(spark, ("u-1", "1000UNLISTED1", "RECALL", "CLASS_II"),
               ("no-key", None, "RECALL", "CLASS_II")), catalogue)
    assert known(enriched).count() == 0 and narcotics_only(enriched).count() == 0
    assert unknown(enriched).count() == 2
    assert {r.errorType for r in unknown_envelopes(enriched).collect()} == {"VALIDATION"}


def test_severity_labels(spark):
    catalogue = products(spark, ("1000SEVERITY1", "Test Product", None))
    rows = [(f"sev-{s}", "1000SEVERITY1", "RECALL", s) for s in (*S.SEVERITIES, None)]
    enriched = known(enrich_alerts(alerts(spark, *rows), catalogue)).collect()
    assert {r.severity: r.severityLabel for r in enriched} == {**S.SEVERITY_LABELS, None: "UNKNOWN"}


def test_output_key_is_the_record_key_and_gtin_the_field(spark):
    catalogue = products(spark, ("k", "Product", None))
    alert = alerts(spark, ("a", "k", "RECALL", "CLASS_I")).withColumn("gtin", F.lit("other"))
    [row] = enrich_alerts(alert, catalogue).collect()
    assert (row.key, row.gtin, row.route) == ("k", "other", "known")


def test_enriched_json_keeps_nulls_in_field_order(spark):
    enriched = known(enrich_alerts(
        alerts(spark, ("a", "k", "RECALL", None)), products(spark, ("k", "P", None))))
    value = json.loads(enriched.select(json_record(enriched, S.ENRICHED_COLUMNS)).first()[0])
    assert list(value) == list(S.ENRICHED_COLUMNS)
    assert value["severity"] is None and value["narcotic"] is False
    assert value["issuedAt"] == "2024-01-01T00:00:00Z"


# -- price surges -------------------------------------------------------------

@pytest.mark.parametrize("confirmed, previous, new, expected", [
    (100.0, 100.0, 125.0, 25.0),
    (50.0, 50.0, 53.0, None),
    (50.0, 50.0, 30.0, None),
    (200.0, 200.0, 300.0, 50.0),
    (100.0, 100.0, 115.0, None),          # exactly the threshold
    (100.0, 120.0, 125.0, 25.0),          # the event's own previous price is stale
    (None, 100.0, 120.0, 20.0),
    (0.0, 100.0, 120.0, 20.0),
    (-5.0, 100.0, 120.0, 20.0),
    (float("nan"), 100.0, 120.0, 20.0),
    (0.0, 0.0, 120.0, None),
    (None, -1.0, 120.0, None),
])
def test_surge(spark, confirmed, previous, new, expected):
    table = prices(spark, ("k", confirmed)) if confirmed is not None else prices(spark, ("other", 1.0))
    rows = detect_price_surges(updates(spark, ("k", previous, new)), table).collect()
    assert [r.changePercent for r in rows] == ([] if expected is None else [expected])
    if rows:
        assert rows[0].newPublicPriceCHF == new and rows[0].changeReason == "YEARLY_REVIEW"
        assert rows[0].productName is None and rows[0].detectedAt is not None


def test_threshold_is_compared_before_rounding(spark):
    table, update = prices(spark, ("k", 100.0)), updates(spark, ("k", 1.0, 115.001))
    [row] = detect_price_surges(update, table).collect()
    assert row.changePercent == 15.0
    assert price_changes(update, table).first().changePct > 15.0
    assert detect_price_surges(update, table, threshold=20).count() == 0


@pytest.mark.parametrize("value, expected", [
    (1.005, 1.0), (2.675, 2.68), (0.125, 0.13), (-0.125, -0.12), (15.0, 15.0),
    (0.004999999999999999, 0.0), (float("nan"), 0.0), (1e300, 9.223372036854775807e16),
    (float("inf"), 9.223372036854775807e16),
])
def test_rounding(spark, value, expected):
    assert one_row(spark, x=float(value)).select(half_up_2dp("x")).first()[0] == expected


# -- dead letters -------------------------------------------------------------

@pytest.mark.parametrize("topic, expected", [
    ("hci.drug-alerts.avro", "hci.dlq.drug-alerts.avro"),
    ("hci.price-updates.avro", "hci.dlq.price-updates.avro"),
    ("hci.medicinal-products.avro", "hci.dlq.medicinal-products.avro"),
    ("external.topic", "hci.dlq.external.topic"),
    ("hci.", "hci.dlq."),
    (None, "hci.dlq.unknown.v1"),
])
def test_dlq_topic(spark, topic, expected):
    df = spark.createDataFrame([(topic,)], "topic string")
    assert df.select(dlq_topic("topic")).first()[0] == expected


def test_envelope_has_all_fields(spark):
    failed = spark.createDataFrame(
        [("hci.drug-alerts.avro", 2, 1234, bytearray(b"k"), None, "1000000000044")],
        "topic string, partition int, offset bigint, rk binary, rv binary, gtin string")
    made = envelope(
        failed, "DESERIALIZATION", F.lit("test failure"), "TestProcessor", {"gtin": "gtin", "lot": F.lit(None)},
        exception_class="RuntimeException", raw_key="rk", raw_value="rv")
    assert made.columns == S.DLQ_ENVELOPE.fieldNames()
    assert [f.dataType for f in made.schema] == [f.dataType for f in S.DLQ_ENVELOPE]
    [row] = made.collect()
    assert (row.originalTopic, row.partition, row.offset) == ("hci.drug-alerts.avro", 2, 1234)
    assert (row.errorType, row.errorMessage, row.exceptionClass) == (
        "DESERIALIZATION", "test failure", "RuntimeException")
    assert row.retryCount == 0 and row.processorName == "TestProcessor"
    assert row.context == {"gtin": "1000000000044"} and row.failedAt.endswith("Z")
    assert row.originalKeyBase64 == "aw==" and row.originalValueBase64 is None


def test_dlq_record_is_readable_json_without_nulls(spark):
    failed = one_row(spark, topic="hci.price-updates.avro", partition=0, offset=99)
    [row] = dlq_records(envelope(failed, "VALIDATION", F.lit("price inversion"))).collect()
    assert (row.topic, row.key) == ("hci.dlq.price-updates.avro", "hci.price-updates.avro/0/99")
    value = json.loads(row.value)
    assert set(value) == {
        "originalTopic", "partition", "offset", "errorType", "errorMessage", "retryCount", "failedAt"}
    assert value["errorType"] == "VALIDATION"


def test_unknown_position_and_defaults(spark):
    [row] = envelope(one_row(spark, x=1)).collect()
    assert (row.originalTopic, row.partition, row.offset) == ("unknown", -1, -1)
    assert row.errorType == "PROCESSING" and row.context is None
    [record] = dlq_records(envelope(one_row(spark, x=1))).collect()
    assert (record.topic, record.key) == ("hci.dlq.unknown.v1", "unknown/-1/-1")


def test_long_payload_is_one_base64_line(spark):
    [row] = envelope(one_row(spark, v="é" * 500), raw_value="v").collect()
    import base64
    assert base64.b64decode(row.originalValueBase64, validate=True).decode() == "é" * 500


def test_split_failures(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "t string")
    good, bad = split_failures(df, F.col("t").try_cast("int"), "n", F.col("t").isNull())
    assert sorted(map(tuple, good.collect()), key=str) == [("1", 1), (None, None)]
    assert [tuple(r) for r in bad.collect()] == [("x",)]


def test_several_guarded_expressions(spark):
    df = spark.createDataFrame(
        [("t", 0, 1, "8", "2"), ("t", 0, 2, "x", "2"), ("t", 0, 3, "8", "0"), ("t", 0, 4, "x", "0"), ("t", 0, 5, None, "2")],
        "topic string, partition int, offset bigint, a string, b string",
    )
    expressions = {
        "n": Guarded(F.col("a").try_cast("int"), F.concat(F.lit("no number: "), "a"), "NumberFormatException", F.col("a").isNull()),
        "part": Guarded(F.try_divide(F.lit(1), F.col("b").try_cast("int")), "Division by zero", "ArithmeticException"),
    }
    listed = guard_expressions(df, expressions).select("offset", F.col("errors.expression").alias("failed")).collect()
    assert {r.offset: r.failed for r in listed} == {1: [], 2: ["n"], 3: ["part"], 4: ["n", "part"], 5: []}
    good, failed = processing_routes(df, expressions, "Parser", {"b": "b"})
    assert {r.offset: (r.n, r.part) for r in good.collect()} == {1: (8, 0.5), 5: (None, 0.5)}
    letters = {r.offset: (r.errorType, r.errorMessage, r.exceptionClass, r.processorName, r.context) for r in failed.collect()}
    assert letters == {
        2: ("PROCESSING", "no number: x", "NumberFormatException", "Parser", {"b": "2", "failedExpressions": "n"}),
        3: ("PROCESSING", "Division by zero", "ArithmeticException", "Parser", {"b": "0", "failedExpressions": "part"}),
        4: ("PROCESSING", "no number: x", "NumberFormatException", "Parser", {"b": "0", "failedExpressions": "n,part"}),
    }


def test_guard(spark):
    df = spark.createDataFrame([("t", "a", "é" * 5), ("t", "b", "é" * 6), ("t", "c", None)],
                               "topic string, key string, value string")
    accepted, envelopes = guard_output(df, 11)
    assert [r.key for r in accepted.collect()] == ["a", "c"]
    [e] = envelopes.collect()
    assert (e.errorType, e.originalTopic, e.partition, e.offset) == ("PRODUCTION", "t", -1, -1)


def test_letters_beyond_the_limit_are_kept_in_parts(spark):
    import base64
    import hashlib

    df = spark.createDataFrame([("t", "a", "x" * 1999), ("t", "b", "é" * 3000), ("t", "k" * 2500, None)],
                               "topic string, key string, value string")
    records = guard_records(df, 2000).collect()
    assert all(len(r.key.encode()) + len(r.value.encode()) <= 2000 for r in records)
    by_topic = {}
    for r in records:
        by_topic.setdefault(r.topic, []).append(r)
    assert [r.key for r in by_topic["t"]] == ["a"] and len(by_topic["hci.dlq.t"]) == 2
    whole = []
    for r in by_topic["hci.dlq.t"]:
        context = json.loads(r.value)["context"]
        assert context["partsTopic"] == "hci.dlq.t.parts"
        parts = {p.key: p.value for p in by_topic["hci.dlq.t.parts"]}
        text = base64.b64decode("".join(parts[f"{context['sha256']}#{n}"] for n in range(int(context["parts"]))))
        assert hashlib.sha256(text).hexdigest() == context["sha256"] and len(text) == int(context["bytes"])
        whole.append(json.loads(text))
    assert sorted(base64.b64decode(e.get("originalValueBase64", "")).decode() for e in whole) == ["", "é" * 3000]
    assert sorted(base64.b64decode(e["originalKeyBase64"]).decode() for e in whole) == ["b", "k" * 2500]


def test_decode_defaults_and_required_fields(spark):
    full = {f.name: "x" for f in S.MEDICINAL_PRODUCT} | {
        "exFactoryPriceCHF": 1.0, "publicPriceCHF": 2.0, "lastUpdatedUtc": 1704067200123}
    no_status = {k: v for k, v in full.items() if k not in ("marketingStatus", "packageSize")}
    rows = [
        (0, json.dumps({**full, "marketingStatus": "SUSPENDED"})), (1, json.dumps(no_status)),
        (2, json.dumps({**no_status, "gtin": None})), (3, "[]"), (4, ""), (5, "7"), (6, None),
        (7, json.dumps({**full, "marketingStatus": "GONE"})),
        (8, json.dumps({**no_status, "publicPriceCHF": "dear"})),
    ]
    raw = spark.createDataFrame(
        [(bytearray(b"k"), None if v is None else bytearray(v.encode()), S.PRODUCTS_TOPIC, 0, i, T0)
         for i, v in rows], S.RAW_RECORD)
    good, bad = split_decoded(raw, S.PRODUCT_FEED)
    found = {r.offset: r for r in good.collect()}
    assert set(found) == {0, 1, 6}
    assert found[0].marketingStatus == "SUSPENDED" and found[1].marketingStatus == "ACTIVE"
    assert found[1].lastUpdatedUtc == datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert found[6].is_delete and found[6].gtin is None
    assert {r.offset for r in bad.collect()} == {2, 3, 4, 5, 7, 8}


# -- alert frequency ----------------------------------------------------------

EVENTS = "key string, topic string, partition int, offset bigint, ts timestamp"


def timed(spark, *rows):
    return spark.createDataFrame([(k, "t", 0, i, at(s)) for i, (k, s) in enumerate(rows)], EVENTS)


def test_window_is_final_only_after_grace(spark):
    early = [("k", 300), ("k", 600), ("z", 700), ("k", 4199.999)]
    assert count_alerts(timed(spark, *early)).collect() == []
    [row] = count_alerts(timed(spark, *early, ("k", 4200))).collect()
    assert row.summary_key == "k@2024-01-01T00:00:00Z/2024-01-01T01:00:00Z" and row["count"] == 2


def test_window_bounds_min_count_and_null_keys(spark):
    rows = [("k", 0), ("k", 3599.999), ("k", 3600), (None, 5), (None, 6), ("z", 1), ("end", 99999)]
    got = {(r.key, r["count"]) for r in count_alerts(timed(spark, *rows)).collect()}
    assert got == {("k", 2)}
    singles = count_alerts(timed(spark, *rows), min_count=1)
    assert {(r.key, r["count"]) for r in singles.collect()} == {("k", 2), ("k", 1), ("z", 1)}
    half = count_alerts(timed(spark, *rows), window="30 minutes", final_only=False)
    assert half.count() == 0


@pytest.mark.parametrize("rows_per_task", [2, 1000])
def test_late_alerts_in_arrival_order(spark, rows_per_task):
    rows = [("k", 300), ("k", 4199), ("k", 1800), ("k", 4200), ("k", 3500), ("k", 3601), ("z", 90000), ("k", 4300)]
    marked = mark_late(timed(spark, *rows), rows_per_task=rows_per_task)
    assert [r.late for r in marked.orderBy("offset").collect()] == [
        False, False, False, False, True, False, False, True]
    assert late_alerts(timed(spark, *rows), rows_per_task=rows_per_task).count() == 2


def test_event_time_falls_back_to_ingestion(spark):
    df = spark.createDataFrame([(T0, at(5)), (None, at(5))], "issuedByUtc timestamp, timestamp timestamp")
    assert [r.ts for r in alert_event_time(df).collect()] == [T0, at(5)]


# -- expressions --------------------------------------------------------------

@pytest.mark.parametrize("text, blank", [
    ("", True), (" ", True), ("\t\n", True), (" ", True), ("a", False), (" a ", False),
    (" ", False), ("\u0085", False), ("a\n", False), ("\n\n", True),
])
def test_is_blank(spark, text, blank):
    assert one_row(spark, t=text).select(is_blank("t")).first()[0] is blank


@pytest.mark.parametrize("micros, expected", [
    (0, "2024-01-01T00:00:00Z"), (120000, "2024-01-01T00:00:00.120Z"),
    (120001, "2024-01-01T00:00:00.120001Z"), (1, "2024-01-01T00:00:00.000001Z"),
])
@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_iso_instant_in_any_session_zone(spark, micros, expected, zone):
    df = spark.createDataFrame([(1704067200000000 + micros,)], "m bigint").select(
        F.timestamp_micros("m").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert df.select(iso_instant("t")).first()[0] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
