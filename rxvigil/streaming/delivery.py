"""Delivering a micro-batch to a sink that may refuse single records or be written to twice.

Refused records: a write that fails for a reason that lies in a record is cut into parts until each record that causes it stands
alone. Those become PRODUCTION dead letters and all others are written; any other failure fails the batch, which
is then retried from the checkpoint.

Exactly once: every write carries a delivery name in the records' headers, and a ledger lists the names that count. A
reader keeps the records of listed deliveries, so what a failed or outdated attempt left behind is never seen.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxvigil import schemas as S
from rxvigil.operators.deadletter import dlq_records, refused_envelope
from rxvigil.session import scratch_path, written_table
from rxvigil.streaming.files import create_once, exists, names

#: Appends records under a delivery name.
Append = Callable[[DataFrame, str], None]
#: Failures that lie in a record and come back however often it is written (fixed values).
RECORD_ERRORS = ("RecordTooLargeException", "SerializationException", "InvalidTopicException", "CorruptRecordException")
HEADER = "delivery"
_ROW, _FOLDER = "__row", "__folder"
#: Rows in a folder of a batch that is cut, and refused rows of a folder after which others may go on with the rest of it.
_FOLDER_ROWS, _FEW = 2_000, 16


class FencedError(RuntimeError):
    """A newer run of the query has taken the ledger over."""


def record_error(error: BaseException) -> str | None:
    """The class of failure that lies in a record, or None if the failure may pass or is unknown."""
    texts, seen = [], error
    while seen is not None:
        texts.append(f"{type(seen).__name__} {seen}")
        seen = seen.__cause__
    found = re.search("|".join(RECORD_ERRORS), "\n".join(texts))
    return found.group() if found else None


class Ledger:
    """Which deliveries of a query's batches count; one small file a batch below ``root``.

    Files appear whole and never replace one another, so of two attempts at a batch one alone can be listed. A run that
    opens the ledger takes the next epoch and so fences off all earlier runs.
    """

    def __init__(self, root: str, query: str):
        self.folder = f"{root.rstrip('/')}/{query}"
        self.query = query
        self._epoch: int | None = None

    def open(self, spark: SparkSession) -> int:
        """Take the next epoch. A sink does this on its first batch."""
        while self._epoch is None:
            wanted = self._newest_epoch(spark) + 1
            if create_once(spark, f"{self.folder}/epochs/{wanted}", ""):
                self._epoch = wanted
        return self._epoch

    def has(self, spark: SparkSession, batch_id: int) -> bool:
        return exists(spark, f"{self.folder}/batches/{batch_id}.json")

    def commit(self, spark: SparkSession, batch_id: int, deliveries: list[str]) -> None:
        """List a batch's deliveries; fails if the batch is listed already or a newer run has opened the ledger."""
        if self._newest_epoch(spark) != self.open(spark):
            raise FencedError(f"{self.query}: a newer run is at work")
        text = "".join(json.dumps({"query": self.query, "batch_id": batch_id, "delivery": d}) + "\n" for d in deliveries)
        if not create_once(spark, f"{self.folder}/batches/{batch_id}.json", text):
            raise FencedError(f"{self.query}: batch {batch_id} is delivered already")

    def deliveries(self, spark: SparkSession) -> DataFrame:
        """``query``, ``batch_id``, ``delivery`` of every write that counts."""
        schema = "query string, batch_id bigint, delivery string"
        if not exists(spark, f"{self.folder}/batches"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).json(f"{self.folder}/batches")

    def _newest_epoch(self, spark: SparkSession) -> int:
        return max((int(n) for n in names(spark, f"{self.folder}/epochs") if n.isdigit()), default=0)


def with_header(records: DataFrame, delivery: str) -> DataFrame:
    """``records`` with the delivery's name in the column ``headers``, as log connectors write it."""
    header = F.struct(F.lit(HEADER).alias("key"), F.lit(delivery).cast("binary").alias("value"))
    return records.withColumn("headers", F.array(header))


def read_committed(records: DataFrame, ledger: Ledger) -> DataFrame:
    """The records (with ``headers``) of deliveries that count: each record of the query once."""
    name: Column = F.filter("headers", lambda h: h["key"] == HEADER)
    named = records.withColumn(HEADER, F.try_element_at(name, F.lit(1))["value"].cast("string"))
    listed = ledger.deliveries(records.sparkSession).select(HEADER)
    return named.join(listed, HEADER, "left_semi").drop(HEADER)


def delivering_sink(
    append: Append, ledger: Ledger | None = None, isolate: bool = True, max_bytes: int = S.MAX_RECORD_BYTES,
    at_once: int = 1,
) -> Callable[[DataFrame, int], None]:
    """A sink around ``append``, which takes records ``(topic, key, value)`` with binary values and a delivery's name.

    Without a ledger delivery is at least once: a retried or divided write may repeat records. With one it is exactly once
    for readers that use :func:`read_committed`; a batch that is listed already is not written again. ``isolate``
    says whether refused records are looked for, with ``at_once`` writes side by side: more than one if the sink stands
it, as logs do and a single folder of files does not. A refused dead letter fails the batch.
    """

    def sink(records: DataFrame, batch_id: int) -> None:
        spark = records.sparkSession
        if ledger:
            ledger.open(spark)
            if ledger.has(spark, batch_id):
                return
        deliveries: list[str] = []

        def write(part: DataFrame) -> None:
            name = f"{batch_id}-{uuid.uuid4().hex}"
            append(part, name)
            deliveries.append(name)

        try:
            write(records)
        except Exception as error:
            if not isolate or not record_error(error):
                raise
            _write_isolated(records, write, max_bytes, at_once)
        if ledger:
            ledger.commit(spark, batch_id, deliveries)

    return sink


def _write_isolated(records: DataFrame, write: Callable[[DataFrame], None], max_bytes: int, at_once: int) -> None:
    """Write all records but those the sink refuses one by one, and these as dead letters.

    The batch is kept in a table, so that its parts stay the same, in folders of about ``_FOLDER_ROWS`` rows that follow one
    another by topic; a row's number tells its place. It is known to fail as a whole. Ranges of folders that fail are cut in four
    again and again, in sixteen while all of them fail. In a folder that fails the first refused row is found by halves: a first half
    that fails holds it, one that is written leaves it in the second; what follows the row is then written at once. So ``n``
    refused rows of ``m`` in a folder take about ``n * (log2(m) + 2)`` writes, and those of a topic that is refused, which lie side by
    side, about two each. A part of a folder reads this folder alone, however many records the batch has.
    """
    spark = records.sparkSession
    kept = written_table(records.withColumn(_ROW, F.monotonically_increasing_id()), "refused-batch")
    path, folders = scratch_path(spark, "refused-parts"), max(1, -(-kept.count() // _FOLDER_ROWS))
    placed = kept.repartitionByRange(folders, "topic", _ROW).sortWithinPartitions("topic", _ROW)
    placed.withColumns({_FOLDER: F.spark_partition_id(), _ROW: F.monotonically_increasing_id()}).write.partitionBy(_FOLDER).parquet(path)
    schema = T.StructType([*kept.schema.fields, T.StructField(_FOLDER, T.IntegerType())])
    held = spark.read.schema(schema).parquet(path)
    # One row a folder.
    spans = sorted(tuple(r) for r in held.groupBy(_FOLDER).agg(F.min(_ROW), F.max(_ROW) + 1).collect())

    def failure(part: DataFrame) -> str | None:
        """Why a part was refused; None if it was written."""
        try:
            write(part.drop(_ROW, _FOLDER))
        except Exception as error:
            kind = record_error(error)
            if not kind:
                raise
            return kind
        return None

    def of_folders(part: list[tuple]) -> str | None:
        return failure(held.where(F.col(_FOLDER).between(part[0][0], part[-1][0])))

    def isolated(part: tuple[int, int, int, bool]) -> tuple[list[tuple], list[tuple]]:
        """Refused rows of a folder from one row on up to another, and ranges that are left; whether the range is known to fail."""
        folder, start, past, fails = part
        rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{_FOLDER}={folder}").where(F.col(_FOLDER) == folder)
        refused: list[tuple[int, str, str]] = []
        # A refused row lies before ``bad``, if that is known.
        bad, alone = past if fails else None, False
        while start < past:
            if len(refused) >= _FEW:
                step = -(-(past - start) // 4)
                return refused, [(folder, n, min(n + step, past), False) for n in range(start, past, step)]
            if bad is None:
                end = start + 1 if alone else past
            else:
                end = start + max(1, (bad - start) // 2)
            kind = failure(rows.where(F.col(_ROW).between(start, end - 1)))
            if not kind:
                # The rest up to ``bad`` is known to fail, unless there is none.
                start, alone, bad = end, False, bad if bad and end < bad else None
            elif end - start > 1:
                bad = end
            else:
                # Other records of the topic are refused as well; so may be what follows two refused side by side.
                alone = kind == "InvalidTopicException" or bool(refused) and refused[-1][0] == start - 1
                refused.append((start, kind, f"refused by the sink: {kind}"))
                start, bad = end, None
        return refused, []

    refused: list[tuple[int, str, str]] = []
    parts, single = _cut(spans, 4), []
    with ThreadPoolExecutor(at_once) as writers:
        while parts:
            failed = [part for part, kind in zip(parts, writers.map(of_folders, parts)) if kind]
            step = 16 if len(failed) == len(parts) else 4
            single += [(*part[0], True) for part in failed if len(part) == 1]
            parts = [one for part in failed if len(part) > 1 for one in _cut(part, step)]
        at_work = {writers.submit(isolated, part) for part in single}
        while at_work:
            done, at_work = wait(at_work, return_when=FIRST_COMPLETED)
            for found, left in (one.result() for one in done):
                refused += found
                at_work |= {writers.submit(isolated, part) for part in left}
    if refused:
        reasons = spark.createDataFrame(refused, f"{_ROW} long, kind string, message string")
        # As many rows as records that were refused one by one.
        bad = held.drop(_FOLDER).join(F.broadcast(reasons), _ROW).withColumn("key", F.col("key").cast("string"))
        made = refused_envelope(F.col("message"), F.col("kind")).alias("made")
        letters = dlq_records(bad.select(made).select("made.*"), max_bytes)
        write(letters.select("topic", "key", F.col("value").cast("binary").alias("value")))


def _cut(parts: list, pieces: int) -> list[list]:
    """Up to so many lists, one after another."""
    size = -(-len(parts) // pieces) or 1
    return [parts[n : n + size] for n in range(0, len(parts), size)]
