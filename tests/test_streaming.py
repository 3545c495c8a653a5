import json

import pytest
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil import streaming as st
from rxvigil.operators import Guarded, asof_join, validate_catalogue
from rxvigil.sources import read_feed, stream_feed
from rxvigil.streaming.tables import ChangeTable
from tests.builders import T0, at, change, changelog

MS0 = int(T0.timestamp()) * 1000


def product(key, name="Samplin 20mg", narcotics=None, public=12.8, status="ACTIVE", ex=5.5):
    return dict(
        gtin=key, authorizationNumber="A-17", productName=name, atcCode="X00YZ09",
        dosageForm="Pill", manufacturer="Muster Labs", activeSubstance="Samplin",
        marketingStatus=status, exFactoryPriceCHF=ex, publicPriceCHF=public, lastUpdatedUtc=MS0,
        dataSource="TEST", packageSize="20 pills", narcoticsCategory=narcotics,
    )


def alert(alert_id, key, seconds=0, severity="CLASS_I", type_="RECALL"):
    return dict(
        alertId=alert_id, gtin=key, alertType=type_, severity=severity,
        headline=f"Notice: {type_}", description="d", affectedLots=[],
        issuedByUtc=MS0 + int(seconds * 1000), expiresUtc=None, sourceUrl="u",
    )


def price(key, previous, new):
    return dict(
        gtin=key, previousExFactoryPriceCHF=previous * 0.7, newExFactoryPriceCHF=new * 0.7,
        previousPublicPriceCHF=previous, newPublicPriceCHF=new, effectiveDateUtc=MS0,
        changeReason="YEARLY_REVIEW", changedBy="desk", approvalReference=None,
    )


class Feed:
    """Appends files of raw records; each file is one micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.offset, self.files = spark, folder, 0, 0

    def add(self, *records):
        """(topic, key, value) with the value a dict, bytes or None."""
        rows = []
        for topic, key, value in records:
            value = json.dumps(value).encode() if isinstance(value, dict) else value
            rows.append((
                None if key is None else bytearray(key.encode()),
                None if value is None else bytearray(value), topic, 0, self.offset, at(self.offset),
            ))
            self.offset += 1
        frame = self.spark.createDataFrame(rows, S.RAW_RECORD).coalesce(1)
        frame.write.mode("append").parquet(self.folder)
        self.files += 1

    def stream(self):
        return stream_feed(self.spark, self.folder, options={"maxFilesPerTrigger": "1"})


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path / "feed"))


@pytest.fixture
def run(spark, tmp_path):
    """Runs a pipeline to the end of its input; a second call resumes from the checkpoint."""

    def go(start, feed, **options):
        out = str(tmp_path / "out")
        start(feed.stream(), st.file_sink(out), str(tmp_path / "checkpoint"), **options).awaitTermination()
        found = {}
        for r in st.read_records(spark, out).orderBy("batch_id").collect():
            found.setdefault(r.topic, []).append((r.key, r.value if r.number is None else r.number))
        return found

    return go


P, A, U = S.PRODUCTS_TOPIC, S.ALERTS_TOPIC, S.PRICES_TOPIC


@pytest.mark.parametrize("start", [st.start_alert_enrichment, st.start_strict_enrichment])
def test_enrichment_routes(run, feed, start):
    feed.add((P, "p1", product("p1")), (P, "n1", product("n1", "Opiatin 5mg", "BetmG-A")))
    feed.add((A, "p1", alert("a-1", "p1")), (A, "n1", alert("n-1", "n1")),
             (A, "x", alert("u-2", "x", severity="CLASS_II")), (A, None, alert("alert-n", "p1")),
             (A, "p1", None))
    found = run(start, feed)
    enriched = {json.loads(v)["alertId"]: json.loads(v) for _, v in found[S.ENRICHED_TOPIC]}
    assert set(enriched) == {"a-1", "n-1"}
    first = enriched["a-1"]
    assert list(first) == list(S.ENRICHED_COLUMNS)
    assert first["manufacturer"] == "Muster Labs" and first["narcotic"] is False
    assert "CRITICAL" in first["severityLabel"] and first["issuedAt"] == "2024-01-01T00:00:00Z"
    assert first["narcoticsCategory"] is None
    [(key, value)] = found[S.NARCOTICS_TOPIC]
    assert key == "n1" and json.loads(value)["narcotic"] is True
    letters = [json.loads(v) for _, v in found["hci.dlq.drug-alerts.avro"]]
    assert {e["context"]["alertId"] for e in letters} == {"u-2", "alert-n"}
    assert {e["errorType"] for e in letters} == {"VALIDATION"} and "stackTrace" not in letters[0]


def test_table_changes_reach_later_alerts_only(run, feed):
    feed.add((P, "p", product("p", "old")), (A, "p", alert("a1", "p")))
    feed.add((P, "p", product("p", "new")))
    feed.add((A, "p", alert("a2", "p")))
    feed.add((P, "p", None))
    feed.add((A, "p", alert("a3", "p")))
    found = run(st.start_alert_enrichment, feed)
    names = {json.loads(v)["alertId"]: json.loads(v)["productName"] for _, v in found[S.ENRICHED_TOPIC]}
    assert names == {"a1": "old", "a2": "new"}
    assert len(found["hci.dlq.drug-alerts.avro"]) == 1


def test_strict_mode_sees_the_table_within_a_batch(run, feed):
    feed.add((P, "p", product("p", "old")), (A, "p", alert("a1", "p")), (P, "p", product("p", "new")),
             (A, "p", alert("a2", "p")), (P, "p", None), (A, "p", alert("a3", "p")))
    feed.add((A, "p", alert("a4", "p")), (P, "p", product("p", "back")), (A, "p", alert("a5", "p")))
    found = run(st.start_strict_enrichment, feed)
    names = {json.loads(v)["alertId"]: json.loads(v)["productName"] for _, v in found[S.ENRICHED_TOPIC]}
    assert names == {"a1": "old", "a2": "new", "a5": "back"}


def test_restart_continues_with_state_and_repeats_nothing(run, feed):
    feed.add((P, "p", product("p")), (A, "p", alert("a1", "p")))
    assert len(run(st.start_alert_enrichment, feed)[S.ENRICHED_TOPIC]) == 1
    feed.add((A, "p", alert("a2", "p")))
    found = run(st.start_alert_enrichment, feed)
    assert sorted(json.loads(v)["alertId"] for _, v in found[S.ENRICHED_TOPIC]) == ["a1", "a2"]


def test_failed_batch_is_retried_without_duplicates(spark, feed, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    feed.add((P, "p", product("p")), (A, "p", alert("a1", "p")))
    write = st.file_sink(out)

    def crash_after_writing(records, batch_id):
        write(records, batch_id)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        st.start_alert_enrichment(feed.stream(), crash_after_writing, checkpoint).awaitTermination()
    st.start_alert_enrichment(feed.stream(), write, checkpoint).awaitTermination()
    assert st.read_records(spark, out, S.ENRICHED_TOPIC).count() == 1


def test_undecodable_records_are_kept_and_the_stream_goes_on(run, feed):
    bad = alert("a2", "p")
    del bad["headline"]
    odd = alert("a3", "p", severity="CLASS_IX")
    feed.add((P, "p", product("p")), (A, "p", b"{broken"), (A, "p", bad), (A, "p", odd),
             (A, "p", alert("a4", "p")), (P, "q", b"\x00\x01"))
    found = run(st.start_alert_enrichment, feed)
    assert len(found[S.ENRICHED_TOPIC]) == 1
    letters = {k: json.loads(v) for k, v in found["hci.dlq.drug-alerts.avro"]}
    assert {k: e["errorMessage"] for k, e in letters.items()} == {
        f"{A}/0/1": "malformed value", f"{A}/0/2": "missing required field headline",
        f"{A}/0/3": "unknown severity: CLASS_IX",
    }
    assert letters[f"{A}/0/1"]["originalValueBase64"] == "e2Jyb2tlbg=="
    assert {e["errorType"] for e in letters.values()} == {"DESERIALIZATION"}
    assert len(found["hci.dlq.medicinal-products.avro"]) == 1


def test_records_too_large_for_the_sink_are_dead_lettered(run, feed):
    feed.add((P, "p", product("p")), (P, "big", product("big", "x" * 5000)),
             (A, "p", alert("a1", "p")), (A, "big", alert("a2", "big")))
    found = run(st.start_alert_enrichment, feed, max_bytes=3000)
    assert [json.loads(v)["alertId"] for _, v in found[S.ENRICHED_TOPIC]] == ["a1"]
    [(key, value)] = found["hci.dlq.alerts.enriched.avro"]
    assert key == f"{S.ENRICHED_TOPIC}/-1/-1" and json.loads(value)["errorType"] == "PRODUCTION"


@pytest.mark.parametrize("start", [st.start_price_surges, st.start_strict_price_surges])
def test_price_surges(run, feed, start):
    feed.add(*[(P, k, product(k, public=p)) for k, p in [("a", 100.0), ("b", 50.0), ("c", 50.0), ("d", 200.0)]])
    feed.add((U, "a", price("a", 100.0, 125.0)), (U, "b", price("b", 50.0, 53.0)),
             (U, "c", price("c", 50.0, 30.0)), (U, "d", price("d", 200.0, 300.0)))
    found = {k: json.loads(v) for k, v in run(start, feed)[S.SURGE_TOPIC]}
    assert set(found) == {"a", "d"}
    assert found["a"]["newPublicPriceCHF"] == 125.0 and found["a"]["changeReason"] == "YEARLY_REVIEW"
    assert found["a"]["changePercent"] == 25.0 and found["d"]["changePercent"] == 50.0
    assert found["a"]["productName"] is None and found["a"]["detectedAt"].endswith("Z")


@pytest.mark.parametrize("start", [st.start_price_surges, st.start_strict_price_surges])
def test_events_that_fail_a_guarded_expression_are_dead_lettered(run, feed, start):
    guarded = {
        "ratio": Guarded(F.try_divide("newPublicPriceCHF", "previousPublicPriceCHF"), "no previous price", "ArithmeticException"),
        "room": Guarded(F.try_divide(F.lit(1), 300 - F.col("newPublicPriceCHF")), "at its cap", "IllegalStateException"),
    }
    feed.add(*[(P, k, product(k, public=100.0)) for k in "abcd"])
    feed.add((U, "a", price("a", 100.0, 125.0)), (U, "b", price("b", 0.0, 200.0)), (U, "c", b"{broken"))
    feed.add((U, "d", price("d", 0.0, 300.0)), (U, "a", price("a", 100.0, 300.0)))
    found = run(start, feed, guarded=guarded)
    assert [k for k, _ in found[S.SURGE_TOPIC]] == ["a"]
    letters = [json.loads(v) for _, v in found["hci.dlq.price-updates.avro"]]
    failed = {v["offset"]: (v["errorMessage"], v["context"]["failedExpressions"]) for v in letters if v["errorType"] == "PROCESSING"}
    assert failed == {5: ("no previous price", "ratio"), 7: ("no previous price", "ratio,room"), 8: ("at its cap", "room")}
    assert [v["offset"] for v in letters if v["errorType"] != "PROCESSING"] == [6]


def test_validated_catalogue_ignores_rejected_updates(run, feed):
    feed.add((P, "p", product("p", public=100.0)))
    feed.add((P, "p", product("p", public=1.0, ex=5.0)), (P, "p", product("p", public=50.0, status="PENDING")))
    feed.add((U, "p", price("p", 10.0, 125.0)))
    found = run(st.start_price_surges, feed, catalogue="validated")
    [(_, value)] = found[S.SURGE_TOPIC]
    assert json.loads(value)["previousPublicPriceCHF"] == 100.0
    rules = {json.loads(v)["context"]["validationRule"] for _, v in found["hci.dlq.medicinal-products.avro"]}
    assert rules == {"PRICE_INVERSION", "ILLEGAL_STATUS_TRANSITION"}


def summary(found):
    return found.get(S.SUMMARY_TOPIC, [])


def test_window_closes_once_after_the_grace_period(run, feed):
    feed.add((A, "k", alert("1", "k", 300)), (A, "k", alert("2", "k", 600)), (A, "z", alert("3", "z", 700)))
    feed.add((A, "k", alert("4", "k", 4199.999)))
    assert summary(run(st.start_alert_frequency, feed)) == []
    feed.add((A, "k", alert("5", "k", 4200)))
    closed = [("k@2024-01-01T00:00:00Z/2024-01-01T01:00:00Z", 2)]
    assert summary(run(st.start_alert_frequency, feed)) == closed
    feed.add((A, "k", alert("6", "k", 1800)))
    assert summary(run(st.start_alert_frequency, feed)) == closed


def test_late_alert_within_the_grace_period_counts(run, feed):
    feed.add((A, "k", alert("1", "k", 300)), (A, "k", alert("2", "k", 4100)))
    feed.add((A, "k", alert("3", "k", 1800)), (A, None, alert("4", "k", 1900)))
    feed.add((A, "k", alert("5", "k", 9000)))
    assert summary(run(st.start_alert_frequency, feed)) == [
        ("k@2024-01-01T00:00:00Z/2024-01-01T01:00:00Z", 2)
    ]


def test_counts_leave_as_eight_bytes_and_text_as_utf8(spark):
    records = spark.createDataFrame(
        [("t", "k", None, 258), ("t", "k", None, -1), ("t", "k", "é", None)],
        "topic string, key string, value string, number bigint",
    )
    got = [bytes(r.value) for r in st.sinks.wire_values(records).collect()]
    assert got == [(258).to_bytes(8, "big"), (-1).to_bytes(8, "big", signed=True), "é".encode()]


@pytest.mark.parametrize("start, topic", [
    (st.start_strict_enrichment, A), (st.start_strict_price_surges, U), (st.start_alert_frequency, A),
    (st.start_alert_enrichment, A), (st.start_price_surges, U),
])
def test_every_pipeline_routes_its_bad_records(run, feed, start, topic):
    feed.add((topic, "p", b"{broken"), (topic, "p", b"1 2"))
    feed.add((topic, "p", b"also broken"))
    found = run(start, feed)
    assert len(found[topic.replace("hci.", "hci.dlq.")]) == 3


def test_arrival_order_decides_across_batches(run, feed):
    """A status accepted in a later batch counts, even if its time is earlier."""
    feed.add((P, "p", product("p", status="ACTIVE")))
    feed.offset = 5
    feed.add((P, "p", product("p", status="SUSPENDED")))
    feed.offset = 2
    feed.add((P, "p", product("p", status="WITHDRAWN")))
    feed.offset = 9
    feed.add((P, "p", product("p", status="SUSPENDED")))
    found = run(st.start_catalogue_admission, feed, accepted_topic="ok")
    assert [json.loads(v)["marketingStatus"] for _, v in found["ok"]] == ["ACTIVE", "SUSPENDED", "WITHDRAWN"]
    [(_, letter)] = found["hci.dlq.medicinal-products.avro"]
    assert json.loads(letter)["errorMessage"] == "Status transition WITHDRAWN → SUSPENDED is not permitted"


def test_catalogue_admission_across_batches(run, feed):
    statuses = ["PENDING", "ACTIVE", "PENDING", "SUSPENDED", "WITHDRAWN", "ACTIVE"]
    for s in statuses[:3]:
        feed.add((P, "p", product("p", status=s)))
    feed.add(*[(P, "p", product("p", status=s)) for s in statuses[3:]])
    feed.add((P, "p", None), (P, "p", product("p", status="ACTIVE")), (P, " ", product(" ")))
    found = run(st.start_catalogue_admission, feed, accepted_topic="ok")
    accepted = [v and json.loads(v)["marketingStatus"] for _, v in found["ok"]]
    assert sorted(accepted, key=str) == sorted(
        ["PENDING", "ACTIVE", "SUSPENDED", "WITHDRAWN", None, "ACTIVE"], key=str)
    messages = [json.loads(v)["errorMessage"] for _, v in found["hci.dlq.medicinal-products.avro"]]
    assert sorted(messages) == [
        "GTIN key is null or empty", "Status transition ACTIVE → PENDING is not permitted",
        "Status transition WITHDRAWN → ACTIVE is not permitted",
    ]


def test_decode_failures_run_on_their_own(run, feed):
    feed.add((A, "p", b"no json"), (A, "p", alert("a", "p")))

    def start(raw, sink, checkpoint):
        return st.start_decode_failures(raw, S.ALERT_FEED, sink, checkpoint)

    assert list(run(start, feed)) == ["hci.dlq.drug-alerts.avro"]


def stream_of(spark, folder, frame):
    """One micro-batch per file, in three files by offset."""
    for part in range(3):
        frame.where(F.col("offset") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", "1").parquet(folder)


def collected(spark, stream, tmp_path):
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(str(tmp_path / "table"))
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "table"))


def test_stateful_verdicts_keep_status_between_batches(spark, tmp_path):
    moves = ["PENDING", "ACTIVE", "PENDING", "SUSPENDED", "WITHDRAWN", "ACTIVE", None, "ACTIVE"]
    rows = [change("k", i, m, delete=m is None) for i, m in enumerate(moves)] + [
        change(" ", 8), change(None, 9, None, delete=True), change("k", 10, narc=" ")]
    log = changelog(spark, rows)
    folder = str(tmp_path / "in")
    for low in (0, 3, 5):
        high = {0: 3, 3: 5, 5: 99}[low]
        log.where(F.col("offset").between(low, high - 1)).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", "1").parquet(folder)
    got = collected(spark, st.stateful_verdicts(stream), tmp_path)
    expected = validate_catalogue(log)
    assert sorted(got.collect(), key=lambda r: r.offset) == sorted(
        expected.select(*got.columns).collect(), key=lambda r: r.offset)


def test_stateful_asof_equals_the_batch_join_in_one_batch(spark, tmp_path):
    log = changelog(spark, [change(f"k{i % 5}", i, delete=i % 7 == 0, public=float(i)) for i in range(60)])
    events = spark.createDataFrame(
        [(None if i == 3 else f"k{i % 6}", i, at(i * 0.9)) for i in range(60)],
        "key string, offset bigint, ts timestamp",
    )
    log.coalesce(1).write.parquet(str(tmp_path / "log"))
    events.coalesce(1).write.parquet(str(tmp_path / "events"))
    joined = st.stateful_asof(
        spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")),
        spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")),
        ["publicPriceCHF", "marketingStatus"],
    )
    got = collected(spark, joined, tmp_path)
    expected = asof_join(events, log, ["publicPriceCHF", "marketingStatus"])
    assert sorted(got.collect(), key=lambda r: r.offset) == sorted(
        expected.select(*got.columns).collect(), key=lambda r: r.offset)


@pytest.mark.parametrize("page, slice_seconds", [(1000, 3600), (2, 7)])
def test_rows_that_arrive_late_count_in_order_of_time(spark, tmp_path, monkeypatch, page, slice_seconds):
    """Shuffled arrivals within the watermark, a hot key, ties in time: the batch join's rows, batch by batch."""
    monkeypatch.setattr(st.stateful, "_PAGE", page)
    monkeypatch.setattr(st.stateful, "_GATHERED", 5 * page)
    keys = ["hot"] * 6 + ["k1", "k2"]
    log = changelog(spark, [change(keys[i % 8], i, delete=i % 7 == 0, public=float(i)) for i in range(80)])
    rows = [(keys[i % 7], 1000 + i, at(i * 0.8 // 1)) for i in range(100)] + [(None, 2000, at(3))]
    events = spark.createDataFrame(rows, "key string, offset bigint, ts timestamp")
    order = F.pmod(F.xxhash64("offset"), F.lit(3))
    for batch in range(4):
        last = [("end", 9999, at(10_000))] if batch == 3 else []
        log.where(order == batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        more = events.where(order == batch).unionByName(spark.createDataFrame(last, events.schema))
        more.coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
        joined = st.stateful_asof(
            spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")),
            spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")),
            ["publicPriceCHF", "marketingStatus"], delay="200 seconds", slice_seconds=slice_seconds,
        )
        got = collected(spark, joined, tmp_path)
        # Nothing leaves before the watermark has passed it.
        assert batch == 3 or got.where("key IS NOT NULL").count() == 0
    expected = asof_join(events, log, ["publicPriceCHF", "marketingStatus"])
    assert sorted(got.collect(), key=lambda r: r.offset) == sorted(
        expected.select(*got.columns).collect(), key=lambda r: r.offset)


def test_change_table_merges_compacts_and_survives_retries(spark, tmp_path):
    table = ChangeTable(str(tmp_path / "t"), ["publicPriceCHF"], compact_every=2)
    batches = [
        [change("a", 0, public=1.0), change("b", 1, public=1.0)],
        [change("a", 2, public=2.0), change("b", 3, delete=True)],
        [change("c", 4, public=3.0), change("b", 0, public=9.0)],
        [], [change("a", 5, public=7.0)],
    ]
    for i, rows in enumerate(batches):
        frame = changelog(spark, rows)
        table.apply(frame, i)
        table.apply(frame, i)
    schema = table.schema_of(frame)

    def prices(batch_id, keys=None):
        return {r.key: r.publicPriceCHF for r in table.as_of(spark, batch_id, schema, keys).collect()}

    assert prices(-1) == {}
    assert prices(0) == {"a": 1.0, "b": 1.0}
    assert prices(1) == {"a": 2.0}
    # Arrival decides: an older change that arrives after the delete counts.
    assert prices(2) == prices(3) == {"a": 2.0, "b": 9.0, "c": 3.0}
    assert prices(4) == {"a": 7.0, "b": 9.0, "c": 3.0}
    assert prices(4, spark.createDataFrame([("a",), ("b",)], "key string")) == {"a": 7.0, "b": 9.0}


def test_feed_reads_what_is_already_there(spark, feed):
    feed.add((A, "p", alert("a", "p")))
    feed.add((A, "p", alert("b", "p")))
    assert read_feed(spark, feed.folder).count() == 2
    assert feed.stream().isStreaming


@pytest.mark.parametrize("start", [st.start_price_surges, lambda *a: st.start_catalogue_admission(*a, "accepted")])
def test_a_batch_is_held_in_files_that_are_removed(spark, feed, tmp_path, monkeypatch, start):
    """A batch larger than the executors' memory must not fill it, and leaves nothing behind."""
    feed.add((P, "a", product("a", public=100.0)), (P, "b", b"{"), (U, "a", price("a", 100.0, 125.0)), (U, "b", b"{"))
    jvm, inside = spark.sparkContext._jsc.sc(), []
    monkeypatch.setattr("rxvigil.session.shared_folder", lambda _: str(tmp_path / "shared"))

    def sink(records, batch_id):
        records.collect()
        inside.append((jvm.getPersistentRDDs().size(), len(list((tmp_path / "shared").glob("batch-*")))))

    before = jvm.getPersistentRDDs().size()
    start(feed.stream(), sink, str(tmp_path / "checkpoint")).awaitTermination()
    assert inside == [(before, 2)] and not list((tmp_path / "shared").glob("batch-*"))


def test_processing_reads_a_batch_once(spark, feed, tmp_path):
    """Records, failures and undecodable values leave in one pass over the batch."""
    feed.add((U, "a", price("a", 100.0, 125.0)), (U, "b", price("b", 0.0, 2.0)), (U, "c", b"{"), (U, "d", None), (A, "x", b"{"))
    guarded = {"ratio": Guarded(F.try_divide("newPublicPriceCHF", "previousPublicPriceCHF"), "no previous price", "ArithmeticException")}
    scans, found = [], []

    def sink(records, batch_id):
        plan = records._jdf.queryExecution().optimizedPlan()
        scans.append(plan.collectLeaves().size())
        found.extend((r.topic, r.key, r.value) for r in records.collect())

    st.start_processing(feed.stream(), S.PRICE_FEED, guarded, "ratios", ["gtin", "ratio"], sink, str(tmp_path / "c"), processor="R").awaitTermination()
    assert scans == [1] and len(found) == 3
    assert [json.loads(v) for t, _, v in found if t == "ratios"] == [{"gtin": "a", "ratio": 1.25}]
    letters = {e["errorType"]: e for e in (json.loads(v) for t, _, v in found if t == "hci.dlq.price-updates.avro")}
    assert letters["PROCESSING"]["offset"] == 1 and letters["PROCESSING"]["processorName"] == "R"
    assert letters["DESERIALIZATION"]["offset"] == 2 and letters["DESERIALIZATION"]["originalValueBase64"] == "ew=="


def test_a_key_with_few_waiting_rows_uses_one_value(monkeypatch):
    """One read and one write of state a call, whatever slices of time the rows lie in."""
    from types import SimpleNamespace

    calls = []

    class State:
        def __init__(self, name):
            self.name, self.value = name, None

        def __getattr__(self, call):
            def called(*args):
                calls.append((self.name, call))
                if call == "update":
                    self.value = args[0]
                return self.value if call == "get" else None
            return called

    states = {}
    handle = SimpleNamespace(
        getValueState=lambda name, _: states.setdefault(name, State(name)), getMapState=lambda name, *_: states.setdefault(name, State(name)),
        registerTimer=lambda _: None,
    )
    lookup = st.stateful._OrderedLookup(10)
    lookup.init(handle)
    rows = [SimpleNamespace(micros=100 * i, side=i % 2, offset=i, payload=f"p{i}") for i in range(20)]
    assert not list(lookup.handleInputRows(("k",), iter(rows), None)) and len(calls) == 2
    calls.clear()
    out = list(lookup.handleExpiredTimer(("k",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 1), None))
    assert [(r.event, r.entry) for r in out] == [(f"p{i}", f"p{i - 1}") for i in range(1, 11, 2)] and len(calls) == 2


def test_keys_share_state_and_many_table_rows_lie_in_parts(monkeypatch):
    """Far fewer reads and writes of state than keys; a deleted row leaves its part, and the last one the state."""
    from types import SimpleNamespace

    calls, states = [], {}

    class State:
        def __init__(self):
            self.held = {}

        def __getattr__(self, call):
            def called(*args):
                calls.append(call)
                at = args[0] if args and call != "update" else None
                if call in ("update", "updateValue"):
                    self.held[at] = args[-1]
                elif call in ("clear", "removeKey"):
                    del self.held[at]
                return at in self.held if call == "containsKey" else list(self.held) if call == "keys" else self.held.get(at)
            return called

    handle = SimpleNamespace(
        getValueState=lambda name, _: states.setdefault(name, State()), getMapState=lambda name, *_: states.setdefault(name, State()),
        registerTimer=lambda _: None,
    )
    lookup = st.stateful._OrderedLookup(10, named=True)
    lookup.init(handle)

    def passed(rows, mark):
        rows = [SimpleNamespace(micros=m, side=side, offset=n, payload=payload, name=name) for n, (m, side, name, payload) in enumerate(rows)]
        assert not list(lookup.handleInputRows((1,), iter(rows), None))
        return [(r.event, r.entry) for r in lookup.handleExpiredTimer((1,), SimpleNamespace(getCurrentWatermarkInMs=lambda: mark), None)]

    names = [f"k{i}" for i in range(600)]
    assert passed([(10, 0, n, f"old {n}") for n in names], 1) == []
    assert len(calls) < 60 and len(states["entries"].held) > 1
    # Later calls see them, change some and delete others.
    late = [(2_000, 1, n, f"e {n}") for n in names] + [(2_001, 0, n, None if i % 2 else "new") for i, n in enumerate(names)]
    assert sorted(passed(late, 3)) == sorted((f"e {n}", f"old {n}") for n in names)
    assert sorted(passed([(4_000, 1, n, n) for n in names], 5), key=str) == sorted(((n, None if i % 2 else "new") for i, n in enumerate(names)), key=str)
    calls.clear()
    assert passed([(6_000, 0, "k0", "one"), (6_001, 1, "k0", "e")], 7) == [("e", "one")] and len(calls) <= 6
    assert passed([(8_000, 0, n, None) for n in names], 9) == []
    assert not any(s.held for s in states.values())


def test_late_rows_of_many_keys_in_few_states(spark, tmp_path, monkeypatch):
    """Table rows outlive the batch that brings them, whatever keys share their state."""
    monkeypatch.setattr(st.stateful, "BUCKETS", 2)
    monkeypatch.setattr(st.stateful, "_ENTRIES", 2)
    log = changelog(spark, [change(f"k{i % 23}", i, delete=i % 7 == 0, public=float(i)) for i in range(120)])
    rows = [(f"k{i % 29}", None if i % 50 == 9 else 1000 + i, at(i * 0.8 // 1)) for i in range(150)]
    events = spark.createDataFrame(rows, "key string, offset bigint, ts timestamp")
    order = F.floor(F.unix_seconds("ts") / 40) + F.pmod(F.xxhash64("key", "offset"), F.lit(2))
    first = events.agg(F.min(F.floor(F.unix_seconds("ts") / 40))).first()[0]
    for batch in range(6):
        last = [("end", 9999, at(10_000))] if batch == 5 else []
        log.where(order == first + batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        more = events.where(order == first + batch).unionByName(spark.createDataFrame(last, events.schema))
        more.coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
        joined = st.stateful_asof(
            spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")),
            spark.readStream.schema(log.schema).parquet(str(tmp_path / "log")),
            ["publicPriceCHF", "marketingStatus"], delay="90 seconds",
        )
        got = collected(spark, joined, tmp_path)
    expected = asof_join(events, log, ["publicPriceCHF", "marketingStatus"])
    assert sorted(got.collect(), key=str) == sorted(expected.select(*got.columns).collect(), key=str)
