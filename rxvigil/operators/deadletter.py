"""Dead-letter envelopes: one fixed JSON shape for everything that could not be handled.

An envelope is a struct column, so a row can carry its output record or its dead letter and all
routes of a frame are produced in one pass. ``envelope`` gives the same as a frame of its own.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxvigil import schemas as S
from rxvigil.functions import dlq_topic, iso_instant, record_position


def envelope_struct(
    error_type: str,
    message: Column | None = None,
    processor: str | None = None,
    context: Mapping[str, Column | str] | None = None,
    exception_class: Column | str | None = None,
    raw_key: str | None = None,
    raw_value: str | None = None,
    topic: Column | str = "topic",
    partition: Column | str = "partition",
    offset: Column | str = "offset",
) -> Column:
    """Envelope of the current row (see ``DLQ_ENVELOPE``).

    An unknown position becomes ``unknown``, -1 and -1. ``raw_key``/``raw_value`` name payload
    columns to keep as base64. Context entries without a value are left out.
    """
    text = F.lit(None).cast("string")

    def column(c: Column | str) -> Column:
        return F.col(c) if isinstance(c, str) else c

    def literal(c: Column | str) -> Column:
        return F.lit(c) if isinstance(c, str) else c

    def payload(name: str | None) -> Column:
        if name is None:
            return text
        # Spark may break base64 into lines; the envelope carries it in one piece.
        return F.translate(F.base64(F.col(name).cast("binary")), "\r\n", "")

    entries = F.lit(None).cast("map<string,string>")
    if context:
        pairs = []
        for name, value in context.items():
            pairs += [F.lit(name), column(value).cast("string")]
        entries = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return F.struct(
        F.coalesce(column(topic), F.lit("unknown")).alias("originalTopic"),
        F.coalesce(column(partition).cast("int"), F.lit(-1)).alias("partition"),
        F.coalesce(column(offset).cast("bigint"), F.lit(-1).cast("bigint")).alias("offset"),
        F.lit(error_type).alias("errorType"),
        (text if message is None else message).alias("errorMessage"),
        (text if exception_class is None else literal(exception_class)).alias("exceptionClass"),
        text.alias("stackTrace"),
        F.lit(0).alias("retryCount"),
        payload(raw_key).alias("originalKeyBase64"),
        payload(raw_value).alias("originalValueBase64"),
        iso_instant(F.current_timestamp()).alias("failedAt"),
        (F.lit(processor) if processor else text).alias("processorName"),
        entries.alias("context"),
    )


def envelope(failed: DataFrame, error_type: str = "PROCESSING", *args, **options) -> DataFrame:
    """One envelope row per failed record; position columns the frame lacks are unknown."""
    for name, type_ in (("topic", "string"), ("partition", "int"), ("offset", "bigint")):
        if name not in failed.columns:
            options.setdefault(name, F.lit(None).cast(type_))
    made = envelope_struct(error_type, *args, **options)
    return failed.select(made.alias("envelope")).select("envelope.*")


def output_record(topic: Column, key: Column | str, value: Column) -> Column:
    return F.struct(
        topic.alias("topic"),
        (F.col(key) if isinstance(key, str) else key).alias("key"),
        value.alias("value"),
    )


def letter(made: Column) -> Column:
    """The dead-letter record of an envelope: topic from its source topic, nulls dropped."""
    # An envelope says "unknown" for a missing topic.
    source = F.nullif(made["originalTopic"], F.lit("unknown"))
    return output_record(dlq_topic(source), _position(made), F.to_json(made))


def _position(made: Column) -> Column:
    return record_position(made["originalTopic"], made["partition"], made["offset"])


def _bytes(record: Column) -> Column:
    """Size of a record: key and value."""
    return sum((F.coalesce(F.octet_length(record[n]), F.lit(0)) for n in ("key", "value")), F.lit(0))


_PART_KEY_BYTES = 64 + 12
#: What a message log accepts as a topic's name.
_LEGAL_TOPIC = r"^(?!\.{1,2}$)[A-Za-z0-9._-]{1,249}$"


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with columns made below a generator: they are computed once a row, not once a use."""
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return rows.select("*", F.explode(F.array(made)).alias("once")).select(*rows.columns, "once.*")


def _with_letters(rows: DataFrame, max_bytes: int) -> DataFrame:
    """The records of ``rows`` (``record``, ``made``): the record itself, or the letter of the envelope ``made``.

    A letter beyond the limit is cut into parts, base64 of its JSON text, which go to the letter's topic with
    the suffix ``.parts`` and the key ``sha256#n``, n from 0. The letter itself then holds the envelope without payload,
    message and context, and in the context how to find the parts and to check them. Nothing is lost or shortened, as
    long as the limit leaves room for a short letter. Records that pass and letters that fit are touched by no more than a
    test of their size.
    """
    made, whole, cut = F.col("made"), F.col("whole"), F.col("cut")
    rows = _once(rows, whole=F.when(made.isNotNull(), letter(made)))
    binary = whole["value"].cast("binary")
    body = F.struct(
        F.translate(F.base64(binary), "\r\n", "").alias("text"), F.sha2(binary, 256).alias("sha"),
        F.octet_length(binary).cast("string").alias("bytes"),
    )
    rows = _once(rows, cut=F.when(_bytes(whole) > max_bytes, body))
    size = max(max_bytes - _PART_KEY_BYTES, 1)
    parts_topic = F.concat(whole["topic"], F.lit(S.DLQ_PARTS_SUFFIX))
    count = F.ceil(F.length(cut["text"]) / size).cast("int")

    def part(n: Column) -> Column:
        return output_record(
            parts_topic, F.concat(cut["sha"], F.lit("#"), n.cast("string")), F.substring(cut["text"], n * size + 1, F.lit(size))
        )

    pointer = F.create_map(
        F.lit("partsTopic"), parts_topic,
        F.lit("parts"), count.cast("string"),
        F.lit("bytes"), cut["bytes"],
        F.lit("sha256"), cut["sha"],
    )
    dropped = {"errorMessage", "originalKeyBase64", "originalValueBase64"}
    short = F.struct(*[
        (pointer if f.name == "context" else F.lit(None).cast(f.dataType) if f.name in dropped else made[f.name]).alias(f.name)
        for f in S.DLQ_ENVELOPE
    ])
    in_parts = F.concat(F.array(letter(short)), F.transform(F.sequence(F.lit(0), count - 1), part))
    records = F.when(cut.isNotNull(), in_parts).when(whole.isNotNull(), F.array(whole)).otherwise(F.array("record"))
    return rows.select(F.explode(records).alias("record")).select("record.*")


def dlq_records(envelopes: DataFrame, max_bytes: int = S.MAX_RECORD_BYTES) -> DataFrame:
    """Envelope rows as records ``(topic, key, value)``, none larger than ``max_bytes``; larger letters leave in parts."""
    made = F.struct(*[F.col(f.name) for f in S.DLQ_ENVELOPE]).alias("made")
    none = F.lit(None).cast("struct<topic:string,key:string,value:string>").alias("record")
    return _with_letters(envelopes.select(none, made), max_bytes)


def split_failures(
    records: DataFrame, result: Column, name: str, missing: Column
) -> tuple[DataFrame, DataFrame]:
    """Compute ``name`` with a ``try_*`` expression; rows where it fails go to the second frame.

    A null result counts as failure unless ``missing`` says the input itself was absent.
    """
    computed = records.withColumn(name, result)
    failed = F.col(name).isNull() & ~F.coalesce(missing, F.lit(False))
    return computed.where(~failed), computed.where(failed).drop(name)


class Guarded(NamedTuple):
    """An expression that gives null where it fails (``try_*``), and what is said of it then.

    Where ``absent`` is true its input is missing, and null is its proper result.
    """

    result: Column
    message: Column | str
    exception_class: str
    absent: Column | None = None


def guard_expressions(records: DataFrame, expressions: Mapping[str, Guarded], errors: str = "errors") -> DataFrame:
    """``records`` with a column for each expression, all computed in one projection, and the array ``errors``.

    It names the expressions that failed, with message and exception class, in the mapping's order. An expression
    sees the input columns, not other expressions.
    """
    computed = records.select("*", *(g.result.alias(name) for name, g in expressions.items()))
    failures = []
    for name, g in expressions.items():
        absent = F.lit(False) if g.absent is None else F.coalesce(g.absent, F.lit(False))
        message = F.lit(g.message) if isinstance(g.message, str) else g.message
        failure = F.struct(
            F.lit(name).alias("expression"), message.alias("message"), F.lit(g.exception_class).alias("exceptionClass")
        )
        failures.append(F.when(F.col(name).isNull() & ~absent, failure))
    return computed.withColumn(errors, F.array_compact(F.array(*failures)))


def processing_routes(
    records: DataFrame,
    expressions: Mapping[str, Guarded],
    processor: str | None = None,
    context: Mapping[str, Column | str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records for which every expression holds, with their results; and one PROCESSING envelope for each other record.

    The envelope tells the first failure, as processing would stop there; ``failedExpressions`` in its context names all.
    """
    errors = "__errors"
    computed = guard_expressions(records, expressions, errors)
    failed = envelope(computed.where(F.size(errors) > 0), **processing_failure(errors, processor, context))
    return computed.where(F.size(errors) == 0).drop(errors), failed


def processing_failure(
    errors: str, processor: str | None = None, context: Mapping[str, Column | str] | None = None
) -> dict:
    """What an envelope says of the failures in the array ``errors``, as options of ``envelope_struct``."""
    first = F.try_element_at(errors, F.lit(1))
    return {
        "error_type": "PROCESSING",
        "message": first["message"],
        "processor": processor,
        "context": {**(context or {}), "failedExpressions": F.array_join(F.col(errors)["expression"], ",")},
        "exception_class": first["exceptionClass"],
    }


def _oversized(max_bytes: int) -> Column:
    return _bytes(F.struct("key", "value")) > max_bytes


def legal_topic(topic: Column) -> Column:
    """Whether a message log accepts the topic's name."""
    return F.coalesce(topic.rlike(_LEGAL_TOPIC), F.lit(False))


def refused_envelope(message: Column, exception_class: Column | str) -> Column:
    """Envelope of a record (``topic``, ``key``, ``value``) that the sink does not take; its output position is unknown.

    A topic whose name is not legal has no dead-letter topic of its own either: such letters go to that of
    unknown topics, and the context names it.
    """
    legal = legal_topic(F.col("topic"))
    made = envelope_struct(
        "PRODUCTION",
        message,
        context={"topic": F.when(~legal, F.col("topic"))},
        raw_key="key",
        raw_value="value",
        topic=F.when(legal, F.col("topic")),
        partition=F.lit(-1),
        offset=F.lit(-1),
    )
    name = F.lit(exception_class) if isinstance(exception_class, str) else exception_class
    context = F.when(F.size(made["context"]) > 0, made["context"])
    return made.withField("exceptionClass", name).withField("context", context)


def _production_envelope(max_bytes: int) -> Column:
    too_large = F.format_string(
        "record of %d bytes exceeds the limit of %d", _bytes(F.struct("key", "value")), F.lit(max_bytes)
    )
    size = _oversized(max_bytes)
    return refused_envelope(
        F.when(size, too_large).otherwise("not a legal topic name"),
        F.when(size, "RecordTooLargeException").otherwise("InvalidTopicException"),
    )


def _refused(max_bytes: int) -> Column:
    return _oversized(max_bytes) | ~legal_topic(F.col("topic"))


def guard_output(
    records: DataFrame, max_bytes: int = S.MAX_RECORD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Split records a sink would refuse for their size or topic: ``(accepted, envelopes)``."""
    refused = records.where(_refused(max_bytes))
    return (
        records.where(~_refused(max_bytes)),
        refused.select(_production_envelope(max_bytes).alias("envelope")).select("envelope.*"),
    )


def guard_records(records: DataFrame, max_bytes: int = S.MAX_RECORD_BYTES, made: str | None = None) -> DataFrame:
    """The records to write, a refused one replaced by its dead letter, in one pass.

    ``made`` names a column of envelopes; a row that has one leaves as its letter.
    """
    kept = output_record(F.col("topic"), "key", F.col("value")).alias("record")
    refused = F.when(_refused(max_bytes), _production_envelope(max_bytes))
    return _with_letters(records.select(kept, (F.coalesce(made, refused) if made else refused).alias("made")), max_bytes)
