"""Operators that keep state per key across micro-batches.

Rows of a key reach the processor unordered, so each call sorts them. What a call holds is one
key's share of one micro-batch: bound it with the source's rate limit. Payloads cross into
Python as one JSON text; everything else is done by Spark expressions around the processor.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rxvigil import schemas as S
from rxvigil.functions import is_blank
from rxvigil.operators.catalogue import OK, TOMBSTONE, check_rules

# Microseconds, with and without a time zone.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_TABLE, _EVENT = 0, 1


def _pack(columns: Sequence[str]):
    return F.to_json(F.struct(*columns), _JSON)


def _unpack(column: str, schema):
    return F.from_json(column, schema, _JSON)


class _Admission(StatefulProcessor):
    """Judges the updates of one key in order; the state is its last accepted status."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._status = handle.getValueState("status", "status string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._status.get()
        before = status = held[0] if held else None
        for row in sorted(rows, key=lambda r: (r.ts, r.offset)):
            prior = status
            if row.is_delete:
                verdict, prior, status = TOMBSTONE, None, None
            elif status in (None, row.status) or row.status in S.STATUS_TRANSITIONS.get(status, ()):
                verdict, status = OK, row.status
            else:
                verdict = "ILLEGAL_STATUS_TRANSITION"
            yield Row(payload=row.payload, status=row.status, verdict=verdict, priorStatus=prior)
        if status is None:
            self._status.clear()
        elif status != before:
            self._status.update((status,))

    def close(self) -> None:
        pass


def stateful_verdicts(changelog: DataFrame, key: str = "key") -> DataFrame:
    """Streaming form of ``validate_catalogue``: same columns, verdicts across micro-batches.

    Updates broken by a stateless rule, and deletes without a usable key, never reach the state.
    """
    columns = changelog.columns
    schema = changelog.schema
    ruled = check_rules(changelog, key)
    decided = F.col("rule").isNotNull() | F.col(key).isNull() | is_blank(key)
    gone = F.coalesce("is_delete", F.lit(False))
    status = F.coalesce("marketingStatus", F.lit(S.DEFAULT_MARKETING_STATUS))
    stateless = ruled.where(decided).select(
        *columns,
        F.coalesce("rule", F.lit(TOMBSTONE)).alias("verdict"),
        "message",
        F.lit(None).cast("string").alias("priorStatus"),
    )
    judged = (
        ruled.where(~decided)
        .select(
            F.col(key).alias("state_key"), "ts", "offset", gone.alias("is_delete"),
            F.when(~gone, status).alias("status"), _pack(columns).alias("payload"),
        )
        .groupBy("state_key")
        .transformWithState(
            statefulProcessor=_Admission(),
            outputStructType="payload string, status string, verdict string, priorStatus string",
            outputMode="Append",
            timeMode="None",
        )
    )
    illegal = F.col("verdict") == "ILLEGAL_STATUS_TRANSITION"
    text = F.format_string("Status transition %s → %s is not permitted", "priorStatus", "status")
    return judged.select(
        _unpack("payload", schema).alias("payload"),
        "verdict",
        F.when(illegal, text).alias("message"),
        "priorStatus",
    ).select("payload.*", "verdict", "message", "priorStatus").unionByName(stateless)


class _TableLookup(StatefulProcessor):
    """Keeps the table row of one key; each event leaves with the row it found."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._entry = handle.getValueState("entry", "entry string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._entry.get()
        before = entry = held[0] if held else None
        for row in sorted(rows, key=lambda r: (r.ts, r.side, r.offset)):
            if row.side == _EVENT:
                yield Row(event=row.payload, entry=entry)
            else:
                entry = row.payload
        if entry is None:
            if before is not None:
                self._entry.clear()
        elif entry != before:
            self._entry.update((entry,))

    def close(self) -> None:
        pass


#: Rows in a page of waiting rows, and rows gathered before pages are stored; table rows in a part.
_PAGE, _GATHERED, _ENTRIES = 1_000, 20_000, 64
#: Keys share so many state keys.
BUCKETS = 4096
_NOTHING = (None, 0, 0, None, 0)


def _order(row: Sequence) -> tuple:
    """By time, table first, and offset; none first. Other keys' rows may have the same time, so any two must compare."""
    micros, side, offset = row[:3]
    return micros, side, offset is not None, 0 if offset is None else offset


class _Entries:
    """The table rows of a bucket's keys: as one text while they are few, else in parts by hash of the key, read when a key is asked for."""

    def __init__(self, state, text: str | None, count: int, parts: int):
        self._state, self._text, self._count, self._parts = state, text, count, parts
        self._loaded: dict[int, dict] = {} if parts else {0: json.loads(text) if text else {}}
        self._changed: set[int] = set()

    def get(self, name: str) -> str | None:
        return self._part(self._number(name)).get(name)

    def put(self, name: str, entry: str | None) -> None:
        number = self._number(name)
        held = self._part(number)
        if held.get(name) == entry:
            return
        if entry is None:
            del held[name]
            self._count -= 1
        else:
            self._count += name not in held
            held[name] = entry
        self._changed.add(number)

    def save(self) -> tuple:
        """Store what changed; the text, the number of keys and of parts."""
        if not self._changed:
            return self._text, self._count, self._parts
        if self._count > _ENTRIES * max(1, self._parts):
            every = {n: e for number in range(max(1, self._parts)) for n, e in self._part(number).items()}
            while self._count > _ENTRIES * max(1, self._parts):
                self._parts = 4 * max(1, self._parts)
            self._loaded = {number: {} for number in range(self._parts)}
            for name, entry in every.items():
                self._loaded[self._number(name)][name] = entry
            self._changed = set(self._loaded)
        if not self._parts:
            return json.dumps(self._loaded[0]) if self._count else None, self._count, 0
        for number in self._changed:
            if self._loaded[number]:
                self._state.updateValue((number,), (json.dumps(self._loaded[number]),))
            elif self._state.containsKey((number,)):
                self._state.removeKey((number,))
        return None, self._count, self._parts if self._count else 0

    def _number(self, name: str) -> int:
        return zlib.crc32(name.encode()) % self._parts if self._parts else 0

    def _part(self, number: int) -> dict:
        if number not in self._loaded:
            found = self._state.getValue((number,))
            self._loaded[number] = json.loads(found[0]) if found else {}
        return self._loaded[number]


class _OrderedLookup(StatefulProcessor):
    """As ``_TableLookup``, but rows wait until the watermark has passed them and are then taken in order of time.

    With ``named`` a state key stands for many keys, which the rows' ``name`` tells apart, so that state is read and written
    for many keys at once. Up to a page of waiting rows lies with the table rows in one value, read and written once a call. Where
    there are more they lie in pages by slice of time. A timer at the earliest one releases slice after slice, so a call
    holds one slice of one state key, however many rows of it wait.
    """

    def __init__(self, slice_micros: int, named: bool = False):
        self._slice, self._named = slice_micros, named

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        # Few table rows with their number and that of their parts, up to a page of waiting rows, and the number of pages ever stored.
        self._held = handle.getValueState("held", "entries string, number bigint, parts bigint, few string, pages bigint")
        self._entries = handle.getMapState("entries", "part bigint", "entries string")
        self._waiting = handle.getMapState("waiting", "slice bigint, page bigint", "rows string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        *table, few, pages = before = self._load()
        waiting = json.loads(few) if few else []
        awaited = min((r[0] for r in waiting), default=None)
        first, gathered = None, waiting
        for row in rows:
            gathered.append((row.micros, row.side, row.offset, row.payload, row.name if self._named else ""))
            first = row.micros if first is None else min(first, row.micros)
            if len(gathered) >= _GATHERED:
                pages, gathered = self._store(gathered, pages), []
        if pages or len(gathered) > _PAGE:
            pages, gathered = self._store(gathered, pages), []
        self._save(before, (*table, json.dumps(gathered) if gathered else None, pages))
        # There is a timer at the earliest of the few rows already.
        if first is not None and (awaited is None or first < awaited):
            self._wake(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        *table, few, pages = before = self._load()
        entries = _Entries(self._entries, *table)
        if few:
            rows = sorted(json.loads(few), key=_order)
            passed = sum(r[0] <= mark for r in rows)
            yield from self._taken(rows[:passed], entries)
            rest = rows[passed:]
            few = json.dumps(rest) if rest else None
            if rest:
                self._wake(rest[0][0])
        slices: dict[int, list] = {}
        if pages:
            for number, page in self._waiting.keys():
                slices.setdefault(number, []).append((number, page))
        later, left = [n for n in slices if n * self._slice > mark], False
        for number in sorted(set(slices) - set(later)):
            rows = [row for at in slices[number] for row in json.loads(self._waiting.getValue(at)[0])]
            for at in slices[number]:
                self._waiting.removeKey(at)
            rows.sort(key=_order)
            passed = sum(r[0] <= mark for r in rows)
            yield from self._taken(rows[:passed], entries)
            rest = rows[passed:]
            if rest:
                pages, left = self._store(rest, pages), True
                self._wake(rest[0][0])
        if later:
            self._wake(min(later) * self._slice)
        self._save(before, (*entries.save(), few, pages if later or left else 0))

    def close(self) -> None:
        pass

    def _taken(self, rows: list, entries: _Entries) -> Iterator[Row]:
        for _, side, _, payload, name in rows:
            if side == _EVENT:
                yield Row(event=payload, entry=entries.get(name))
            else:
                entries.put(name, payload)

    def _wake(self, micros: int) -> None:
        self._handle.registerTimer(-(-micros // 1000))

    def _load(self) -> tuple:
        held = self._held.get()
        return tuple(held) if held else _NOTHING

    def _save(self, before: tuple, now: tuple) -> None:
        if now == before:
            return
        if now == _NOTHING:
            self._held.clear()
        else:
            self._held.update(now)

    def _store(self, rows: list, page: int) -> int:
        """Store rows in pages by slice of time, numbered from ``page`` on; the next number."""
        slices: dict[int, list] = {}
        for row in rows:
            slices.setdefault(row[0] // self._slice, []).append(row)
        for number, part in slices.items():
            for at in range(0, len(part), _PAGE):
                self._waiting.updateValue((number, page), (json.dumps(part[at : at + _PAGE]),))
                page += 1
        return page


def _name(key: str, kind: T.DataType):
    """A key as text; different keys have different texts."""
    if isinstance(kind, T.StringType):
        return F.col(key)
    return F.hex(key) if isinstance(kind, T.BinaryType) else F.to_json(F.struct(key), _JSON)


def stateful_asof(
    events: DataFrame,
    changelog: DataFrame,
    columns: Sequence[str],
    key: str = "key",
    delay: str | None = None,
    slice_seconds: int = 3600,
) -> DataFrame:
    """Streaming form of ``asof_join``: each event sees the table as it stands when processed.

    Rows of a micro-batch are taken in ``(ts, table first, offset)`` order; across batches arrival order counts. A delete
    has a null payload and empties the state. With ``delay`` rows count in order of ``ts`` whatever batch brings them, as long as
    they come no later than ``delay`` after newer ones: they wait until the watermark has passed them, so an event leaves
    ``delay`` after its time. Rows that come later still, and rows without a time, are dropped, as by every watermark.
    Keys then share ``BUCKETS`` state keys; ``slice_seconds`` bounds the rows of one of these that are sorted at once.
    """
    gone = F.coalesce("is_delete", F.lit(False))
    table_side = changelog.where(F.col(key).isNotNull()).select(
        F.col(key).alias("state_key"), "ts", F.lit(_TABLE).alias("side"), "offset",
        F.when(~gone, _pack(columns)).alias("payload"),
    )
    event_side = events.where(F.col(key).isNotNull()).select(
        F.col(key).alias("state_key"), "ts", F.lit(_EVENT).alias("side"), "offset",
        _pack(events.columns).alias("payload"),
    )
    both = table_side.unionByName(event_side)
    if delay:
        both = both.where(F.col("ts").isNotNull()).withWatermark("ts", delay).withColumn("micros", F.unix_micros("ts"))
        name = _name("state_key", both.schema["state_key"].dataType)
        both = both.withColumn("name", name).withColumn("state_key", F.pmod(F.xxhash64("name"), F.lit(BUCKETS)))
    joined = (
        both.groupBy("state_key")
        .transformWithState(
            statefulProcessor=_OrderedLookup(slice_seconds * 1_000_000, named=True) if delay else _TableLookup(),
            outputStructType="event string, entry string",
            outputMode="Append",
            timeMode="EventTime" if delay else "None",
        )
        .select(
            _unpack("event", events.schema).alias("event"),
            _unpack("entry", changelog.select(*columns).schema).alias("entry"),
        )
        .select("event.*", *[f"entry.{c}" for c in columns], F.col("entry").isNotNull().alias("matched"))
    )
    keyless = events.where(F.col(key).isNull()).select(
        "*",
        *[F.lit(None).cast(changelog.schema[c].dataType).alias(c) for c in columns],
        F.lit(False).alias("matched"),
    )
    return joined.unionByName(keyless)
