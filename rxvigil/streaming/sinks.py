"""Writing output records. A sink is a function of (records, batch id).

Records are ``(topic, key, value)``; a record whose value is a long has it in ``number`` and no
text. The file sink stores both columns, the log sink writes the long as 8 bytes, big-endian. A batch that is retried after a failure runs again with
the same id; the file sink then replaces what the first attempt left.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.streaming.delivery import Ledger, delivering_sink, with_header

Sink = Callable[[DataFrame, int], None]
RECORD = "key string, value string, number bigint, topic string, batch_id bigint"


def _columns(records: DataFrame) -> list[str]:
    return [c for c in ("topic", "key", "value", "number") if c in records.columns]


def wire_values(records: DataFrame) -> DataFrame:
    """Records with binary values: UTF-8 text, or a long as 8 bytes, big-endian."""
    value = F.col("value").cast("binary")
    if "number" in records.columns:
        value = F.coalesce(value, F.unhex(F.lpad(F.hex("number"), 16, "0")))
    return records.select("topic", "key", value.alias("value"))


def file_sink(root: str, fmt: str = "parquet") -> Sink:
    """One folder per batch and topic, replaced as a whole: effectively exactly once."""

    def write(records: DataFrame, batch_id: int) -> None:
        (
            records.select(*_columns(records))
            .write.mode("overwrite").partitionBy("topic").format(fmt)
            .save(f"{root}/batch_id={batch_id}")
        )

    return write


def log_sink(
    fmt: str, options: Mapping[str, str], ledger: Ledger | None = None, isolate: bool = True,
    max_bytes: int = S.MAX_RECORD_BYTES,
) -> Sink:
    """Append to a message log through Spark's own connector.

    Records the log refuses one by one become dead letters (``isolate``); every other failure fails the batch. At least once
    without a ``ledger``; with one every write names its delivery in the records' headers, and :func:`read_committed`
    gives each record once.
    """

    def append(records: DataFrame, delivery: str) -> None:
        named = with_header(records, delivery) if ledger else records
        named.write.format(fmt).mode("append").options(**options).save()

    deliver = delivering_sink(append, ledger, isolate, max_bytes)
    return lambda records, batch_id: deliver(wire_values(records), batch_id)


def read_records(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """Everything a file sink has written, or one topic of it."""
    records = spark.read.schema(RECORD).option("basePath", root).parquet(root)
    return records if topic is None else records.where(records["topic"] == topic)
