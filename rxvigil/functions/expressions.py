"""Column expressions shared by the operators. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxvigil import schemas as S

# 2^53: from here on a double has no fractional part left to round.
_EXACT_DOUBLE = 9007199254740992.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """Empty or whitespace only (any whitespace, not just spaces); null stays null."""
    return _col(c).rlike(r"\A\p{javaWhitespace}*\z")


def positive(c: Column | str) -> Column:
    """``c > 0`` where NaN is not positive (Spark sorts NaN above every number)."""
    c = _col(c)
    return (c > 0.0) & ~F.isnan(c)


def less_than(a: Column | str, b: Column | str) -> Column:
    """IEEE ``a < b``: false as soon as either side is NaN."""
    a, b = _col(a), _col(b)
    return (a < b) & ~F.isnan(b)


def half_up_2dp(c: Column | str) -> Column:
    """Two decimals, ties towards positive infinity, computed on the binary double.

    ``round(c, 2)`` rounds the decimal rendering instead and differs on values such as 1.005.
    """
    scaled = _col(c) * F.lit(100.0)
    whole = F.floor(scaled)
    up = (scaled - whole >= 0.5) & (scaled < F.lit(_EXACT_DOUBLE))
    return (whole + up.cast("long")) / F.lit(100.0)


def iso_instant(c: Column | str) -> Column:
    """ISO-8601 UTC text with 0, 3 or 6 fraction digits, whatever the session time zone."""
    c = _col(c)
    micros = F.unix_micros(c)
    utc = F.to_utc_timestamp(c, F.current_timezone())
    return (
        F.when(F.pmod(micros, F.lit(1_000_000)) == 0, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.pmod(micros, F.lit(1_000)) == 0, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .otherwise(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )


def severity_label(c: Column | str) -> Column:
    c = _col(c)
    label = F.when(c.isNull(), S.UNKNOWN_SEVERITY_LABEL)
    for severity, text in S.SEVERITY_LABELS.items():
        label = label.when(c == severity, text)
    return label


def transition_allowed(before: Column | str, after: Column | str) -> Column:
    """Whether the lifecycle lets a product go from one status to another.

    A product without an accepted status may take any; staying put is always allowed.
    """
    before, after = _col(before), _col(after)
    allowed = before.isNull() | (before == after)
    for status, targets in S.STATUS_TRANSITIONS.items():
        if targets:
            allowed = allowed | ((before == status) & after.isin(*targets))
    return allowed


def dlq_topic(
    c: Column | str,
    prefix: str = S.TOPIC_PREFIX,
    dlq_prefix: str = S.DLQ_PREFIX,
    unknown: str = S.DLQ_UNKNOWN_TOPIC,
) -> Column:
    """Dead-letter topic of a source topic."""
    c = _col(c)
    rest = F.when(c.startswith(prefix), c.substr(F.lit(len(prefix) + 1), F.length(c))).otherwise(c)
    return F.when(c.isNull(), unknown).otherwise(F.concat(F.lit(dlq_prefix), rest))


def record_position(topic: Column | str, partition: Column | str, offset: Column | str) -> Column:
    """``topic/partition/offset`` with the markers for unknown provenance."""
    return F.concat_ws(
        "/",
        F.coalesce(_col(topic), F.lit("unknown")),
        F.coalesce(_col(partition), F.lit(-1)).cast("string"),
        F.coalesce(_col(offset), F.lit(-1)).cast("string"),
    )


def window_key(key: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.concat(_col(key), F.lit("@"), iso_instant(start), F.lit("/"), iso_instant(end))


def json_record(df: DataFrame, columns: Iterable[str]) -> Column:
    """JSON text of a record: nulls kept, instants as ISO-8601 strings."""
    fields = [
        iso_instant(name).alias(name)
        if isinstance(df.schema[name].dataType, T.TimestampType)
        else F.col(name)
        for name in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
