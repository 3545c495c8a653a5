"""Registered streaming runs: whole benchmark tables replayed through the pipelines.

The tables become raw records (JSON values) read as a stream. Most arrive in several batches, some rows
late, and the pipeline starts again from its checkpoint for each; then the written records are
read back. Feed, checkpoint and output live in a new folder below the shared folder.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxvigil import schemas as S
from rxvigil import streaming as st
from rxvigil.operators import Guarded
from rxvigil.plans.views import BATCHES, VIEWS, plain_timestamps, project_view, view
from rxvigil.session import scratch_path
from rxvigil.sources import stream_feed

ACCEPTED_TOPIC = "catalogue.accepted"
RATIOS_TOPIC = "price.ratios"
PRICE_CAP_CHF = 1300.0
_ASOF_COLUMNS = ("key", "ts", "offset", "newPublicPriceCHF")


def table_stream(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """A domain view over its source table read as a stream."""
    path = f"{sf_dir}/{VIEWS[view][0]}.parquet"
    schema = spark.read.parquet(path).schema
    # As a pattern the path may name one file or a folder of files.
    return project_view(spark.readStream.schema(schema).parquet(f"{path[:-1]}[t]"), view)


def to_raw(rows: DataFrame, feed: S.Feed) -> DataFrame:
    """Records as they would arrive: JSON values, instants in epoch milliseconds.

    Required text the view lacks is filled with a constant, a missing instant with the epoch.
    """
    fields = []
    for f in feed.schema.fields:
        if f.name not in rows.columns:
            if f.nullable or isinstance(f.dataType, T.ArrayType):
                continue
            fields.append(F.lit(0 if isinstance(f.dataType, T.TimestampType) else "n/a").alias(f.name)
                          if not isinstance(f.dataType, T.DoubleType) else F.lit(0.0).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            fields.append(F.unix_millis(f.name).alias(f.name))
        else:
            fields.append(F.col(f.name))
    value = F.to_json(F.struct(*fields)).cast("binary")
    if "is_delete" in rows.columns:
        value = F.when(~F.col("is_delete"), value)

    def position(name, default):
        return F.col(name) if name in rows.columns else default

    return rows.select(
        F.col("key").cast("binary").alias("key"),
        value.alias("value"),
        F.lit(feed.topic).alias("topic"),
        position("partition", F.lit(0)).alias("partition"),
        position("offset", F.lit(0).cast("long")).cast("long").alias("offset"),
        position("ts", F.timestamp_seconds(F.lit(0))).alias("timestamp"),
        *([F.col("arrives")] if "arrives" in rows.columns else []),
    )


def _run(spark: SparkSession, name: str, raw: DataFrame, start) -> DataFrame:
    """Run a pipeline batch after batch of the column ``arrives``, each time from its checkpoint; returns its records."""
    folder = scratch_path(spark, name)
    for batch in range(BATCHES):
        raw.where(F.col("arrives") == batch).drop("arrives").write.mode("append").parquet(f"{folder}/feed")
        stream = stream_feed(spark, f"{folder}/feed")
        start(stream, st.file_sink(f"{folder}/records"), f"{folder}/checkpoint").awaitTermination()
    return st.read_records(spark, f"{folder}/records")


def _run_once(spark: SparkSession, name: str, raw: DataFrame, start) -> DataFrame:
    """Run a pipeline over everything available; returns its records."""
    folder = scratch_path(spark, name)
    start(raw, st.file_sink(f"{folder}/records"), f"{folder}/checkpoint").awaitTermination()
    return st.read_records(spark, f"{folder}/records")


def _write(stream: DataFrame, folder: str) -> None:
    """Add a stream's rows to a table with Spark's exactly-once file sink."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start(f"{folder}/table")
    )
    query.awaitTermination()


def _parsed(records: DataFrame, schema: str) -> DataFrame:
    fields = F.from_json("value", schema).alias("json")
    return records.select("topic", "key", fields).select("topic", "key", "json.*")


def _enrichment(spark, sf) -> DataFrame:
    products = to_raw(view(spark, sf, "v_catalogue_in_batches"), S.PRODUCT_FEED)
    alerts = to_raw(view(spark, sf, "v_alerts_in_batches"), S.ALERT_FEED)
    return _run(spark, "enrichment", products.unionByName(alerts), st.start_alert_enrichment)


def stream_enriched_alerts(spark, sf):
    records = _enrichment(spark, sf)
    enriched = records.where(F.col("topic").isin(S.ENRICHED_TOPIC, S.NARCOTICS_TOPIC))
    return _parsed(
        enriched,
        "alertId string, gtin string, alertType string, severity string, issuedAt string, "
        "productName string, manufacturer string, narcoticsCategory string, narcotic string, "
        "severityLabel string",
    )


def stream_alert_dead_letters(spark, sf):
    records = _enrichment(spark, sf)
    letters = records.where(F.col("topic").startswith(S.DLQ_PREFIX))
    return _parsed(letters, "errorType string, errorMessage string")


class _StopsBeforeCommit(st.Ledger):
    """A ledger whose run ends between the write and the commit of its second batch, once."""

    stopped = False

    def commit(self, spark, batch_id, deliveries):
        if batch_id == 1 and not self.stopped:
            self.stopped = True
            raise InterruptedError("ended between write and commit")
        super().commit(spark, batch_id, deliveries)


def stream_delivered_once(spark, sf):
    """Alerts appended to a log, with a stop after a write, and what a reader of committed records then sees."""
    folder = scratch_path(spark, "delivered")
    raw = to_raw(view(spark, sf, "v_alerts_in_batches"), S.ALERT_FEED)
    ledger = _StopsBeforeCommit(f"{folder}/ledger", "alerts")
    sink = st.log_sink("parquet", {"path": f"{folder}/log"}, ledger)
    for batch in range(BATCHES):
        raw.where(F.col("arrives") == batch).drop("arrives").write.mode("append").parquet(f"{folder}/feed")
        for _ in range(2 if batch == 1 else 1):
            stream = stream_feed(spark, f"{folder}/feed").select("topic", F.col("key").cast("string"), F.col("value").cast("string"))
            query = (
                stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/checkpoint")
                .trigger(availableNow=True).start()
            )
            try:
                query.awaitTermination()
            except StreamingQueryException as failed:
                if "ended between" not in str(failed):
                    raise
    log = spark.read.parquet(f"{folder}/log")
    records = st.read_committed(log, ledger).select("topic", F.col("key").cast("string"), F.col("value").cast("string"))
    return _parsed(records, "alertId string, severity string").withColumn("repeats", F.lit(log.count() > records.count()))


def stream_price_surges(spark, sf):
    products = to_raw(table_stream(spark, sf, "v_catalogue"), S.PRODUCT_FEED)
    raw = products.unionByName(to_raw(table_stream(spark, sf, "v_price_updates"), S.PRICE_FEED))
    records = _run_once(spark, "surges", raw, st.start_price_surges)
    surges = records.where(F.col("topic") == S.SURGE_TOPIC)
    return _parsed(
        surges,
        "gtin string, changeReason string, effectiveDate string, previousPublicPriceCHF double, "
        "newPublicPriceCHF double, changePercent double",
    ).drop("topic")


def stream_processing_failures(spark, sf):
    """Two guarded expressions over price updates: their results, and one letter for each update that fails either."""
    raw = to_raw(view(spark, sf, "v_price_updates_delayed"), S.PRICE_FEED)
    new, previous = F.col("newPublicPriceCHF"), F.col("previousPublicPriceCHF")
    guarded = {
        "priceRatio": Guarded(F.try_divide(new, previous), "no previous price", "ArithmeticException"),
        "headroom": Guarded(F.try_divide(previous, F.lit(PRICE_CAP_CHF) - new), "price at its cap", "IllegalStateException"),
    }

    def start(stream, sink, checkpoint):
        columns = ["gtin", *guarded]
        return st.start_processing(stream, S.PRICE_FEED, guarded, RATIOS_TOPIC, columns, sink, checkpoint, processor="PriceRatio")

    return _parsed(
        _run(spark, "processing", raw, start),
        "gtin string, priceRatio double, headroom double, errorType string, errorMessage string, exceptionClass string, "
        "processorName string, context map<string,string>",
    ).withColumn("failedExpressions", F.col("context")["failedExpressions"]).drop("context")


def stream_alert_frequency(spark, sf):
    raw = to_raw(view(spark, sf, "v_alerts_in_batches"), S.ALERT_FEED)
    records = _run(spark, "frequency", raw, st.start_alert_frequency)
    return records.select("topic", "key", F.col("number").alias("count"))


def stream_catalogue_admission(spark, sf):
    raw = to_raw(view(spark, sf, "v_changelog_in_batches"), S.PRODUCT_FEED)

    def start(stream, sink, checkpoint):
        return st.start_catalogue_admission(stream, sink, checkpoint, ACCEPTED_TOPIC)

    return _parsed(
        _run(spark, "admission", raw, start),
        "marketingStatus string, publicPriceCHF double, errorMessage string, "
        "context map<string,string>",
    ).withColumn("validationRule", F.col("context")["validationRule"]).drop("context")


def stream_catalogue_verdicts(spark, sf):
    log, folder = view(spark, sf, "v_changelog_in_batches"), scratch_path(spark, "verdicts")
    for batch in range(BATCHES):
        log.where(F.col("arrives") == batch).drop("arrives").write.mode("append").parquet(f"{folder}/feed")
        stream = spark.readStream.schema(log.drop("arrives").schema).parquet(f"{folder}/feed")
        verdicts = st.stateful_verdicts(stream)
        _write(verdicts, folder)
    result = spark.read.schema(verdicts.schema).parquet(f"{folder}/table")
    return plain_timestamps(result.select(
        "key", "ts", "offset", "marketingStatus", "verdict", "message", "priorStatus"
    ))


def stream_asof_price(spark, sf):
    # What nobody reads does not travel through the state's processor.
    updates = table_stream(spark, sf, "v_price_updates").select(*_ASOF_COLUMNS)
    changelog = table_stream(spark, sf, "v_product_changelog")
    joined, folder = st.stateful_asof(updates, changelog, ["publicPriceCHF"]), scratch_path(spark, "asof")
    _write(joined, folder)
    result = spark.read.schema(joined.schema).parquet(f"{folder}/table")
    return result.select("key", "offset", "newPublicPriceCHF", "publicPriceCHF", "matched")


def stream_asof_in_time_order(spark, sf):
    """As ``stream_asof_price``, but rows arrive up to 900 days late and still count in order of time."""
    folder = scratch_path(spark, "asof-in-order")
    feeds = {n: view(spark, sf, f"v_{n}_delayed") for n in ("price_updates", "product_changelog")}
    feeds["price_updates"] = feeds["price_updates"].select(*_ASOF_COLUMNS, "arrives")
    feeds["product_changelog"] = feeds["product_changelog"].select("key", "ts", "offset", "is_delete", "publicPriceCHF", "arrives")
    for batch in range(BATCHES + 1):
        for name, feed in feeds.items():
            rows = feed.where(F.col("arrives") == batch)
            if batch == BATCHES and name == "price_updates":
                # What moves the watermark past the last row.
                rows = feed.limit(1).withColumns({"key": F.lit("end"), "ts": F.to_timestamp(F.lit("2100-01-01"))})
            rows.drop("arrives").write.mode("append").parquet(f"{folder}/{name}")
        streams = [spark.readStream.schema(f.drop("arrives").schema).parquet(f"{folder}/{n}") for n, f in feeds.items()]
        joined = st.stateful_asof(*streams, ["publicPriceCHF"], delay="900 days", slice_seconds=1000 * 86_400)
        _write(joined, folder)
    result = spark.read.schema(joined.schema).parquet(f"{folder}/table")
    return result.select("key", "offset", "newPublicPriceCHF", "publicPriceCHF", "matched")


STREAM_QUERIES = {
    f.__name__: f
    for f in (
        stream_enriched_alerts, stream_alert_dead_letters, stream_price_surges,
        stream_alert_frequency, stream_catalogue_admission, stream_catalogue_verdicts,
        stream_asof_price, stream_asof_in_time_order, stream_delivered_once,
        stream_processing_failures,
    )
}
