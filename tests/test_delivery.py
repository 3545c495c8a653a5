import base64
import json

import pytest
from pyspark.sql import functions as F

from rxvigil import operators as O
from rxvigil import schemas as S
from rxvigil import streaming as st
from rxvigil.streaming.delivery import record_error, with_header
from rxvigil.streaming.sinks import wire_values


def records(spark, n, topic="hci.out.v1"):
    return spark.range(n).select(
        F.lit(topic).alias("topic"), F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value")
    ).repartition(2)


class Log:
    """A log as a Parquet folder; ``refuses`` is an expression over a record that fails the writing task with its text."""

    def __init__(self, folder, refuses=None):
        self.folder, self.refuses, self.writes = str(folder), refuses, 0

    def append(self, part, delivery):
        self.writes += 1
        if self.refuses is not None:
            refused = self.refuses
            part = part.withColumn("value", F.when(refused.isNotNull(), F.raise_error(refused)).otherwise(F.col("value")))
        with_header(part, delivery).write.parquet(f"{self.folder}/{delivery}")

    def read(self, spark, ledger=None):
        log = spark.read.parquet(f"{self.folder}/*")
        log = st.read_committed(log, ledger) if ledger else log
        return [(r.topic, r.key, bytes(r.value).decode()) for r in log.collect()]


def wire(rows):
    return wire_values(rows)


def test_single_refused_records_become_letters_and_nothing_is_lost(spark, tmp_path):
    key = F.col("key").cast("string")
    log = Log(tmp_path / "log", F.when(F.col("topic") == "hci.closed.v1", "x InvalidTopicException y").when(key == "4711", "SerializationException"))
    ledger = st.Ledger(str(tmp_path / "ledger"), "q")
    given = records(spark, 10_000).withColumn("topic", F.when(F.col("key") == "77", "hci.closed.v1").otherwise(F.col("topic")))
    st.delivering_sink(log.append, ledger, at_once=8)(wire(given), 3)
    found = log.read(spark, ledger)
    plain = [(t, k, v) for t, k, v in found if not t.startswith(S.DLQ_PREFIX)]
    assert sorted(plain) == sorted(("hci.out.v1", str(i), f"v{i}") for i in range(10_000) if i not in (77, 4711))
    letters = {json.loads(v)["exceptionClass"]: (t, json.loads(v)) for t, _, v in found if t.startswith(S.DLQ_PREFIX)}
    assert set(letters) == {"InvalidTopicException", "SerializationException"} and len(found) == 10_000
    topic, letter = letters["InvalidTopicException"]
    assert topic == "hci.dlq.closed.v1" and letter["originalTopic"] == "hci.closed.v1"
    assert (letter["errorType"], letter["partition"], letter["offset"]) == ("PRODUCTION", -1, -1)
    assert base64.b64decode(letter["originalValueBase64"]) == b"v77" and base64.b64decode(letter["originalKeyBase64"]) == b"77"
    # Two refused records of 10,000 take about 2 * 4 * log4(10,000) writes.
    assert log.writes < 75


def test_other_failures_fail_the_batch(spark, tmp_path):
    log = Log(tmp_path / "log", F.when(F.col("key").cast("string") == "7", "TimeoutException: broker away"))
    ledger = st.Ledger(str(tmp_path / "ledger"), "q")
    with pytest.raises(Exception, match="broker away"):
        st.delivering_sink(log.append, ledger)(wire(records(spark, 100)), 0)
    assert log.writes == 1 and ledger.deliveries(spark).count() == 0
    # The retry, when the broker is back, delivers all of it once.
    log.refuses = None
    sink = st.delivering_sink(log.append, ledger)
    sink(wire(records(spark, 100)), 0)
    sink(wire(records(spark, 100)), 0)
    assert len(log.read(spark, ledger)) == 100 and log.writes == 2


def test_refusal_without_isolation_and_of_letters_fail_the_batch(spark, tmp_path):
    log = Log(tmp_path / "a", F.when(F.col("key").cast("string") == "7", "CorruptRecordException"))
    with pytest.raises(Exception, match="CorruptRecord"):
        st.delivering_sink(log.append, isolate=False)(wire(records(spark, 20)), 0)
    every = Log(tmp_path / "b", F.when((F.col("key").cast("string") == "7") | F.col("topic").startswith(S.DLQ_PREFIX), "CorruptRecordException"))
    ledger = st.Ledger(str(tmp_path / "ledger"), "q")
    with pytest.raises(Exception, match="CorruptRecord"):
        st.delivering_sink(every.append, ledger)(wire(records(spark, 20)), 0)
    assert ledger.deliveries(spark).count() == 0


def test_all_refused_and_empty_batches(spark, tmp_path):
    log = Log(tmp_path / "log", F.when(~F.col("topic").startswith(S.DLQ_PREFIX), "RecordTooLargeException"))
    ledger = st.Ledger(str(tmp_path / "ledger"), "q")
    st.delivering_sink(log.append, ledger)(wire(records(spark, 5)), 0)
    assert [t for t, _, _ in log.read(spark, ledger)] == ["hci.dlq.out.v1"] * 5
    st.delivering_sink(log.append, ledger)(wire(records(spark, 0)), 1)
    assert ledger.deliveries(spark).where("batch_id = 1").count() == 1


def test_kinds_of_failure():
    cause = ValueError("org.apache.kafka.common.errors.RecordTooLargeException: too big")
    outer = RuntimeError("Job aborted")
    outer.__cause__ = cause
    assert record_error(outer) == "RecordTooLargeException" and record_error(RuntimeError("TimeoutException")) is None


def test_attempts_that_were_not_committed_are_not_read(spark, tmp_path):
    log, root = Log(tmp_path / "log"), str(tmp_path / "ledger")
    first = st.Ledger(root, "q")
    st.delivering_sink(log.append, first)(wire(records(spark, 10)), 0)
    # A run writes batch 1 and ends before the commit; the next run takes over.
    first_write = st.delivering_sink(log.append, type("Lost", (st.Ledger,), {"commit": lambda *_: None})(root, "q"))
    first_write(wire(records(spark, 10)), 1)
    second = st.Ledger(root, "q")
    st.delivering_sink(log.append, second)(wire(records(spark, 10)), 1)
    assert len(log.read(spark)) == 30 and len(log.read(spark, second)) == 20
    # The earlier run comes back to life: it can neither commit a new batch nor one that is there.
    with pytest.raises(st.FencedError):
        st.delivering_sink(log.append, first)(wire(records(spark, 10)), 2)
    with pytest.raises(st.FencedError):
        second.commit(spark, 1, ["again"])
    assert len(log.read(spark, second)) == 20
    # Another query's ledger is another one.
    assert st.Ledger(root, "other").deliveries(spark).count() == 0


def test_topic_names_are_checked_before_the_write(spark):
    topics = ["ok.v1", "no spaces", "..", "", "a" * 250, None, "fine_name-2"]
    given = spark.createDataFrame([(t, str(i), "v") for i, t in enumerate(topics)], "topic string, key string, value string")
    out = {r.key: r for r in O.guard_records(given).collect()}
    assert {k for k, r in out.items() if r.value == "v"} == {"0", "6"}
    letters = [json.loads(r.value) for r in O.guard_records(given).collect() if r.value != "v"]
    assert {e["exceptionClass"] for e in letters} == {"InvalidTopicException"} and len(letters) == 5
    assert {e.get("context", {}).get("topic") for e in letters} == {"no spaces", "..", "", "a" * 250, None}
    accepted, envelopes = O.guard_output(given)
    assert accepted.count() == 2 and envelopes.count() == 5


def test_small_parts_of_a_refused_batch_read_a_small_share_of_it(spark, tmp_path):
    """Each write opens the files of its own part, so many refused records do not read the batch over and over."""

    class Counted(Log):
        scans = ()

        def append(self, part, delivery):
            plan = part._jdf.queryExecution().executedPlan().toString()
            self.scans += (plan.split("PartitionFilters: ")[-1].split("PushedFilters")[0],)
            super().append(part, delivery)

    number = F.col("key").cast("string").try_cast("long")
    log = Counted(tmp_path / "log", F.when(number % 2_000 == 42, "CorruptRecordException"))
    st.delivering_sink(log.append, at_once=8)(wire(records(spark, 20_000)), 0)
    # Between the write of all and that of the letters.
    assert all("__folder" in filters for filters in log.scans[1:-1])
    found = log.read(spark)
    assert sum(topic == "hci.dlq.out.v1" for topic, _, _ in found) == 10
    assert {key for topic, key, _ in found if topic == "hci.out.v1"} == {str(i) for i in range(20_000) if i % 2_000 != 42}


def test_records_of_a_refused_topic_take_few_writes(spark, tmp_path):
    """They are looked for side by side; others take about one write for each halving of a folder."""
    key = F.col("key").cast("string")
    refused = F.when(F.col("topic") == "hci.closed.v1", "InvalidTopicException").when(key.try_cast("long") % 2_500 == 42, "CorruptRecordException")
    log, ledger = Log(tmp_path / "log", refused), st.Ledger(str(tmp_path / "ledger"), "q")
    closed = F.col("key").cast("long") % 250 == 17
    given = records(spark, 10_000).withColumn("topic", F.when(closed, F.lit("hci.closed.v1")).otherwise(F.col("topic")))
    st.delivering_sink(log.append, ledger, at_once=8)(wire(given), 0)
    found = log.read(spark, ledger)
    assert sorted(int(k) for t, k, _ in found if t == "hci.out.v1") == [i for i in range(10_000) if i % 250 != 17 and i % 2_500 != 42]
    letters = sorted((t, int(base64.b64decode(json.loads(v)["originalKeyBase64"]))) for t, _, v in found if t.startswith(S.DLQ_PREFIX))
    assert letters == [("hci.dlq.closed.v1", i) for i in range(17, 10_000, 250)] + [("hci.dlq.out.v1", i) for i in range(42, 10_000, 2_500)]
    # 44 refused records; about 20 writes each if all are looked for one by one.
    assert log.writes < 260, log.writes


def test_rows_that_are_refused_only_beside_others_are_written(spark, tmp_path):
    """A record alone decides: what is written then is no letter, whatever its part did before."""

    class Crowded(Log):
        def append(self, part, delivery):
            self.refuses = F.when(F.col("key").cast("string") == "5", "SerializationException") if part.count() > 1 else None
            super().append(part, delivery)

    log = Crowded(tmp_path / "log")
    st.delivering_sink(log.append)(wire(records(spark, 20)), 0)
    assert sorted(int(k) for _, k, _ in log.read(spark)) == list(range(20))
