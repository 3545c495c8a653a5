"""The runnable streams: raw records in, output and dead-letter records out.

Each takes one raw stream carrying all the topics it needs, a sink and a checkpoint folder. The
checkpoint records the source offsets, so after a failure the interrupted micro-batch runs again
with the same id and input; with an idempotent sink every record takes effect once.

Spark has no side outputs. A micro-batch is decoded once and kept in a table while it is handled (or its routes are
made in one pass), every route becomes rows of one frame of records, and that frame is written once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rxvigil import schemas as S
from rxvigil.functions import json_record
from rxvigil.operators import (
    Guarded,
    admission_records,
    alert_records,
    count_alerts,
    detect_price_surges,
    dlq_records,
    enrich_alerts,
    guard_records,
    processing_routes,
    rejection_envelopes,
    validate_catalogue,
)
from rxvigil.operators.catalogue import OK, TOMBSTONE
from rxvigil.operators.deadletter import envelope_struct, guard_expressions, processing_failure
from rxvigil.operators.enrich import PRODUCT_FIELDS, project_enriched
from rxvigil.operators.frequency import alert_event_time
from rxvigil.operators.surge import surges, with_baseline, with_change
from rxvigil.session import scratch_path
from rxvigil.sources import decode, decode_failures, decoded_good
from rxvigil.sources.feeds import record_columns, undecodable
from rxvigil.streaming.files import remove
from rxvigil.streaming.sinks import Sink
from rxvigil.streaming.stateful import stateful_asof
from rxvigil.streaming.tables import ChangeTable

_AVAILABLE_NOW = {"availableNow": True}
_TABLE_FIELDS = (*PRODUCT_FIELDS, "marketingStatus", "publicPriceCHF")


def _start(
    stream: DataFrame,
    handler: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: Mapping | None,
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or _AVAILABLE_NOW))
        .start()
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _decoded(raw: DataFrame, feed: S.Feed) -> DataFrame:
    return decode(raw.where(F.col("topic") == feed.topic), feed)


@contextmanager
def _held() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Within a micro-batch, a way to keep frames for several routes; they are removed at its end.

    They are kept as tables in the shared folder: a batch may be far larger than the executors' memory, and each route
    reads only the columns it needs.
    """
    folders: list[tuple[SparkSession, str]] = []

    def hold(rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        folders.append((spark, scratch_path(spark, "batch")))
        rows.write.parquet(folders[-1][1])
        return spark.read.schema(rows.schema).parquet(folders[-1][1])

    try:
        yield hold
    finally:
        for spark, folder in folders:
            remove(spark, folder)


def _without_payload(decoded: DataFrame) -> DataFrame:
    """Decoded records; the payload is needed for letters only, so that of good records is left out."""
    return decoded.withColumn("value", F.when(F.col("decode_error").isNotNull(), F.col("value")))


def _good(raw: DataFrame, feed: S.Feed) -> DataFrame:
    return decoded_good(_decoded(raw, feed))


def _letters(raw: DataFrame, feeds: list[S.Feed], max_bytes: int, more: Sequence[DataFrame] = ()) -> DataFrame:
    """Dead letters of the feeds' undecodable records and of further envelopes."""
    return dlq_records(_union([*(decode_failures(_decoded(raw, f)) for f in feeds), *more]), max_bytes)


def _held_to(events: DataFrame, guarded: Mapping[str, Guarded] | None) -> tuple[DataFrame, list[DataFrame]]:
    """Events for which every guarded expression holds, and the envelopes of the others."""
    if not guarded:
        return events, []
    good, failed = processing_routes(events, guarded)
    return good.drop(*guarded), [failed]


def _records(df: DataFrame, topic: str, columns) -> DataFrame:
    return df.select(F.lit(topic).alias("topic"), "key", json_record(df, columns).alias("value"))


def _admitted(
    table: ChangeTable, products: DataFrame, batch_id: int
) -> DataFrame:
    """Verdicts on a batch's product updates, given the statuses held before it."""
    held = table.as_of(products.sparkSession, batch_id - 1, table.schema_of(products), products)
    return validate_catalogue(products, order_by=table.order_by, statuses=held)


def _lookup_pipeline(
    raw: DataFrame,
    feed: S.Feed,
    output: Callable[[DataFrame, DataFrame], DataFrame],
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None,
    table: ChangeTable | None,
    catalogue: str,
    max_bytes: int,
    guarded: Mapping[str, Guarded] | None,
) -> StreamingQuery:
    """Shared course of the two pipelines that look events up in the product table.

    A batch's product changes are applied first, so an event sees the table as of the end of
    its batch. A ``shared`` table is kept by another query; its newest version is read and product records are not.
    An event for which an expression of ``guarded`` fails becomes a letter instead of output.
    """
    if catalogue not in ("raw", "validated", "shared"):
        raise ValueError(f"catalogue must be 'raw', 'validated' or 'shared', not {catalogue!r}")
    if catalogue == "shared" and table is None:
        raise ValueError("a shared catalogue needs its table")
    table = table or ChangeTable(f"{checkpoint}/catalogue", _TABLE_FIELDS)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _held() as hold:
            changes = hold(_without_payload(_decoded(batch, S.PRODUCT_FEED)))
            arrived = hold(_without_payload(_decoded(batch, feed)))
            products = decoded_good(changes)
            events = decoded_good(arrived).where(~F.col("is_delete"))
            letters = [decode_failures(changes), decode_failures(arrived)]
            if catalogue == "shared":
                letters = letters[1:]
            events, failed = _held_to(events, guarded)
            letters += failed
            if catalogue == "validated":
                verdicts = hold(_admitted(table, products, batch_id))
                products = verdicts.where(F.col("verdict").isin(OK, TOMBSTONE))
                letters.append(rejection_envelopes(verdicts))
            if catalogue != "shared":
                table.apply(products, batch_id)
            version = None if catalogue == "shared" else batch_id
            current = table.as_of(batch.sparkSession, version, table.schema_of(products), events)
            records = guard_records(output(events, current), max_bytes)
            sink(records.unionByName(dlq_records(_union(letters), max_bytes)), batch_id)

    return _start(raw, handle, checkpoint, trigger)


def start_alert_enrichment(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None = None,
    table: ChangeTable | None = None,
    catalogue: str = "raw",
    max_bytes: int = S.MAX_RECORD_BYTES,
    guarded: Mapping[str, Guarded] | None = None,
) -> StreamingQuery:
    """Alerts with their product; narcotics copied to their own topic; unknowns dead-lettered.

    ``raw`` carries the alert and the product topic. ``catalogue="validated"`` admits only
    product updates that pass the rules and the status lifecycle; ``"shared"`` looks alerts up in a ``table`` that
    another query, such as ``start_catalogue_admission``, keeps. Alerts for which an expression of ``guarded`` fails
    are dead-lettered.
    """

    def output(alerts, products):
        return alert_records(enrich_alerts(alerts, products))

    return _lookup_pipeline(
        raw, S.ALERT_FEED, output, sink, checkpoint, trigger, table, catalogue, max_bytes, guarded
    )


def start_price_surges(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None = None,
    table: ChangeTable | None = None,
    catalogue: str = "raw",
    threshold: float = S.SURGE_THRESHOLD_PERCENT,
    max_bytes: int = S.MAX_RECORD_BYTES,
    guarded: Mapping[str, Guarded] | None = None,
) -> StreamingQuery:
    """Surge notifications. ``raw`` carries the price-update and the product topic. Updates for which an expression
    of ``guarded`` fails are dead-lettered."""

    def output(updates, products):
        prices = products.select("key", F.col("publicPriceCHF").alias("confirmedPriceCHF"))
        found = detect_price_surges(updates, prices, threshold)
        return _records(found, S.SURGE_TOPIC, S.SURGE_COLUMNS)

    return _lookup_pipeline(
        raw, S.PRICE_FEED, output, sink, checkpoint, trigger, table, catalogue, max_bytes, guarded
    )


def start_strict_enrichment(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None = None,
    max_bytes: int = S.MAX_RECORD_BYTES,
    guarded: Mapping[str, Guarded] | None = None,
) -> StreamingQuery:
    """As ``start_alert_enrichment``, but each alert sees the product as of its own place in
    the order of arrival, with the table held as keyed state."""
    feeds = [S.ALERT_FEED, S.PRODUCT_FEED]
    events, failed = _held_to(_good(raw, S.ALERT_FEED).where(~F.col("is_delete")), guarded)
    joined = stateful_asof(events, _good(raw, S.PRODUCT_FEED), PRODUCT_FIELDS)

    records = guard_records(alert_records(project_enriched(joined)), max_bytes)
    return _start(records.unionByName(_letters(raw, feeds, max_bytes, failed)), sink, checkpoint, trigger)


def start_strict_price_surges(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None = None,
    threshold: float = S.SURGE_THRESHOLD_PERCENT,
    max_bytes: int = S.MAX_RECORD_BYTES,
    guarded: Mapping[str, Guarded] | None = None,
) -> StreamingQuery:
    """As ``start_price_surges``, with the confirmed price held as keyed state."""
    feeds = [S.PRICE_FEED, S.PRODUCT_FEED]
    events, failed = _held_to(_good(raw, S.PRICE_FEED).where(~F.col("is_delete")), guarded)
    joined = stateful_asof(
        events,
        _good(raw, S.PRODUCT_FEED).withColumnRenamed("publicPriceCHF", "confirmedPriceCHF"),
        ["confirmedPriceCHF"],
    )
    found = surges(with_change(with_baseline(joined)), threshold)

    records = guard_records(_records(found, S.SURGE_TOPIC, S.SURGE_COLUMNS), max_bytes)
    return _start(records.unionByName(_letters(raw, feeds, max_bytes, failed)), sink, checkpoint, trigger)


def start_alert_frequency(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None = None,
    window: str = S.WINDOW_DURATION,
    grace: str = S.GRACE_PERIOD,
    min_count: int = S.MIN_ALERT_COUNT,
    max_bytes: int = S.MAX_RECORD_BYTES,
) -> StreamingQuery:
    """One record per closed window with enough alerts: ``key@start/end`` → count.

    The count is a long in the column ``number``; sinks say how they store it.
    """
    alerts = alert_event_time(
        _good(raw, S.ALERT_FEED).withColumnRenamed("ts", "timestamp"), "timestamp"
    )
    counts = count_alerts(alerts, window, grace, min_count).select(
        F.lit(S.SUMMARY_TOPIC).alias("topic"),
        F.col("summary_key").alias("key"),
        F.lit(None).cast("string").alias("value"),
        F.col("count").alias("number"),
    )
    letters = _letters(raw, [S.ALERT_FEED], max_bytes).withColumn("number", F.lit(None).cast("bigint"))
    return _start(counts.unionByName(letters), sink, checkpoint, trigger)


def start_decode_failures(
    raw: DataFrame, feed: S.Feed, sink: Sink, checkpoint: str, trigger: Mapping | None = None,
    max_bytes: int = S.MAX_RECORD_BYTES,
) -> StreamingQuery:
    """Dead-letter the undecodable records of a feed that no other pipeline reads; each of those
    dead-letters its own."""
    return _start(_letters(raw, [feed], max_bytes), sink, checkpoint, trigger)


def start_processing(
    raw: DataFrame,
    feed: S.Feed,
    guarded: Mapping[str, Guarded],
    topic: str,
    columns: list[str],
    sink: Sink,
    checkpoint: str,
    trigger: Mapping | None = None,
    processor: str | None = None,
    max_bytes: int = S.MAX_RECORD_BYTES,
) -> StreamingQuery:
    """A feed's records with named expressions computed on each: ``columns`` of these and of the input go to ``topic``.

    A record for which any expression fails, or that cannot be decoded, becomes one dead letter.
    """

    # Every row is read, decoded and computed once and leaves as its record or as its letter.
    bad, errors = F.col("__error").isNotNull(), "__errors"
    held = {name: g._replace(result=F.when(~bad, g.result)) for name, g in guarded.items()}

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = _decoded(batch, feed).where(F.col("decode_error").isNotNull() | ~F.col("is_delete"))
        computed = guard_expressions(decoded.select(
            *record_columns(decoded), F.struct("key", "value").alias("__raw"), F.col("decode_error").alias("__error")
        ), held, errors)
        undecoded = envelope_struct(**undecodable("__error", raw_key="__raw.key", raw_value="__raw.value"))
        failed = envelope_struct(**processing_failure(errors, processor))
        made = F.when(bad, undecoded).when(F.size(errors) > 0, failed)
        routed = computed.withColumn("__made", made).select(
            F.lit(topic).alias("topic"), "key",
            F.when(F.col("__made").isNull(), json_record(computed, columns)).alias("value"), F.col("__made").alias("made"),
        )
        sink(guard_records(routed, max_bytes, "made"), batch_id)

    return _start(raw, handle, checkpoint, trigger)


def start_catalogue_admission(
    raw: DataFrame,
    sink: Sink,
    checkpoint: str,
    accepted_topic: str,
    trigger: Mapping | None = None,
    table: ChangeTable | None = None,
    max_bytes: int = S.MAX_RECORD_BYTES,
) -> StreamingQuery:
    """Forward accepted product updates and deletes; dead-letter the rejected ones.

    The accepted catalogue is kept in ``table``. A delete is forwarded with a null value.
    """
    table = table or ChangeTable(f"{checkpoint}/catalogue", _TABLE_FIELDS)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with _held() as hold:
            decoded = hold(_without_payload(_decoded(batch, S.PRODUCT_FEED)))
            verdicts = hold(_admitted(table, decoded_good(decoded), batch_id))
            table.apply(verdicts.where(F.col("verdict").isin(OK, TOMBSTONE)), batch_id)
            records = guard_records(admission_records(verdicts, accepted_topic), max_bytes)
            sink(records.unionByName(dlq_records(decode_failures(decoded), max_bytes)), batch_id)

    return _start(raw, handle, checkpoint, trigger)
