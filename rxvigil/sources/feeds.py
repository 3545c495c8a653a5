"""Reading the feeds and decoding their records.

A feed is any Spark source yielding ``key, value, topic, partition, offset, timestamp``: a
message log in deployment, files in tests. Connection options are handed to Spark unchanged.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxvigil import schemas as S
from rxvigil.operators.deadletter import envelope

_RAW = [f.name for f in S.RAW_RECORD]
# Log sources bring their own schema and start from the earliest record on first start.
_LOG_OPTIONS = {"startingOffsets": "earliest"}
_END = "end of the value"
_FILE_FORMATS = ("parquet", "json", "orc", "csv", "text", "avro")


def read_feed(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All records of a feed as a table."""
    return _load(spark.read, path, fmt, options)


def stream_feed(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A feed as a stream, from its earliest record on the first start.

    Bound the work of a micro-batch with ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``.
    """
    return _load(spark.readStream, path, fmt, options)


def _load(reader, path, fmt, options) -> DataFrame:
    reader = reader.format(fmt)
    if fmt in _FILE_FORMATS:
        reader = reader.schema(S.RAW_RECORD)
    else:
        reader = reader.options(**_LOG_OPTIONS)
    raw = reader.options(**(options or {})).load(path)
    return raw.select(*_RAW)


def _wire_type(data_type: T.DataType) -> T.DataType:
    # Instants travel as epoch milliseconds.
    return T.LongType() if isinstance(data_type, T.TimestampType) else data_type


def decode(
    raw: DataFrame,
    feed: S.Feed | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Parse JSON values once, tagging each record with ``decode_error`` (null if good).

    Keeps the raw record, adds ``record`` (a struct of the feed's fields) and ``is_delete``
    for null values. Rejected are values that are no JSON object of the schema, have anything
    but white space beside it, lack a required field, or hold a value outside an enumerated
    domain. One bad record never stops the others.
    """
    feed = feed or S.Feed("", schema)
    fields = feed.schema.fields
    wire = T.StructType(
        [T.StructField(f.name, _wire_type(f.dataType), True) for f in fields]
        + [T.StructField(_END, T.LongType(), True)]
    )
    # The parser stops at the end of the first value. So the value is put into a list before an
    # end mark that only it can have: text beside the object breaks the list, closes it early or
    # makes it longer.
    text = F.col("value").cast("string")
    mark = F.xxhash64(text)
    wrapped = F.concat(F.lit('{"list":['), text, F.lit(f',{{"{_END}":'), mark.cast("string"), F.lit("}]}"))
    listed = T.StructType(
        [T.StructField("list", T.ArrayType(wire)), T.StructField("_corrupt", T.StringType(), True)]
    )
    parsed = F.from_json(
        wrapped, listed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    ended = F.try_element_at(parsed["list"], F.lit(2))[_END]
    whole = parsed["_corrupt"].isNull() & (F.size(parsed["list"]) == 2) & (ended == mark)
    parsed = F.when(whole, F.try_element_at(parsed["list"], F.lit(1)))
    # Filters on the result are not pushed below a generator, where they would repeat the
    # parsing once per field they look at.
    parsed = raw.select("*", F.explode(F.array(parsed)).alias("parsed"))

    def value(f: T.StructField) -> Column:
        got = F.col("parsed")[f.name]
        if isinstance(f.dataType, T.TimestampType):
            got = F.timestamp_millis(got)
        if f.name in feed.defaults:
            got = F.coalesce(got, F.expr(feed.defaults[f.name]))
        return got

    is_delete = F.col("value").isNull()
    error = F.when(is_delete, None).when(F.col("parsed").isNull(), "malformed value")
    for f in fields:
        if not f.nullable:
            error = error.when(value(f).isNull(), f"missing required field {f.name}")
    for name, domain in feed.domains.items():
        symbol = value(feed.schema[name])
        error = error.when(
            ~symbol.isin(*domain), F.concat(F.lit(f"unknown {name}: "), symbol)
        )
    record = F.when(~is_delete, F.struct(*[value(f).alias(f.name) for f in fields]))
    return parsed.select(
        *[c for c in raw.columns],
        record.alias("record"),
        is_delete.alias("is_delete"),
        error.cast("string").alias("decode_error"),
    )


def decoded_good(decoded: DataFrame) -> DataFrame:
    """Good records: text key, position, ``ts`` (record time), ``is_delete``, and the fields."""
    return decoded.where(F.col("decode_error").isNull()).select(*record_columns(decoded))


def record_columns(decoded: DataFrame) -> list[Column]:
    """Columns of a decoded record: text key, position, ``ts``, ``is_delete``, and the fields."""
    ts = F.col("timestamp") if "timestamp" in decoded.columns else F.lit(None).cast("timestamp")
    return [
        F.col("key").cast("string").alias("key"),
        *map(F.col, ("topic", "partition", "offset")),
        ts.alias("ts"),
        F.col("is_delete"),
        F.col("record.*"),
    ]


def undecodable(error: str = "decode_error", processor: str | None = None, raw_key: str = "key", raw_value: str = "value") -> dict:
    """What an envelope says of an undecodable record, as options of ``envelope_struct``."""
    return {
        "error_type": "DESERIALIZATION",
        "message": F.col(error),
        "processor": processor,
        "exception_class": "SerializationException",
        "raw_key": raw_key,
        "raw_value": raw_value,
    }


def decode_failures(decoded: DataFrame, processor: str | None = None) -> DataFrame:
    """DESERIALIZATION envelopes with the raw key and value for replay."""
    return envelope(decoded.where(F.col("decode_error").isNotNull()), **undecodable(processor=processor))


def split_decoded(raw: DataFrame, feed: S.Feed) -> tuple[DataFrame, DataFrame]:
    """``(good records, dead-letter envelopes)``."""
    decoded = decode(raw, feed)
    return decoded_good(decoded), decode_failures(decoded)
