"""Licence notices found with bounded errors.

A notice that may hold e errors is split into e + 1 pieces; wherever it occurs, at least one piece occurs unchanged. One
automaton finds all pieces in a single pass, and the regex library verifies the text around each hit.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.words import plain_words, rows_of

PLACES = "array<struct<label:string,first:long,past:long,errors:int,similarity:double,base:boolean,passage:string>>"


class Notice(NamedTuple):
    """``words`` may hold up to ``errors`` edits; ``tail``, such as a version, must follow them unchanged."""

    label: str
    words: str
    tail: str = ""
    errors: int = 0
    base: bool = False


#: The phrases of the base search and their labels.
PHRASES = (
    Notice("mit", "under the mit license", base=True),
    Notice("apache-2", "apache license version 2", base=True),
    Notice("cc-by-nc", "cc by nc", base=True),
)
NOTICES = (
    Notice("mit", "released under the mit license", errors=3),
    Notice("mit", "licensed under the mit license", errors=3),
    Notice("apache-2", "licensed under the apache license version", "2", errors=4),
    Notice("cc-by-nc", "licensed under", "cc by nc", errors=1),
    Notice("cc-by-nc", "creative commons attribution noncommercial", errors=4),
    Notice("gpl-3", "under the gnu general public license version", "3", errors=4),
    Notice("gpl-2", "under the gnu general public license version", "2", errors=4),
    Notice("lgpl", "under the gnu lesser general public license", errors=3),
    Notice("mpl-2", "under the mozilla public license version", "2", errors=4),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", errors=7),
    Notice("cc0", "dedicated to the public domain under cc0", errors=3),
)


def scan(
    docs: DataFrame, notices: tuple[Notice, ...] = (*PHRASES, *NOTICES), text: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``n_words`` and ``places`` of every notice found in the whole text.

    The text's words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. ``places`` are spans of words
    ``[first, past)`` with the label, the number of single-byte edits, the similarity (1 - edits / length), whether the
    notice is a base phrase, and the passage. A notice without errors is reported at every place where its words stand;
    with errors, at its best non-overlapping matches that begin and end with words. Null and empty texts have no
    words and no places; rows are scanned one by one, repeated ones too. Input columns named like the added ones are
    replaced. An empty table gives an empty result.
    """
    kept = [c for c in (carry or docs.columns) if c.lower() not in ("n_words", "places")]
    wanted = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text).cast("string").cast("binary").alias("__text"))
    empty = wanted.drop("__text").withColumn("n_words", F.lit(0).cast("long"))
    schema = empty.withColumn("places", F.lit(None).cast(PLACES)).schema

    def scanned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        seeds, patterns = _seeds(notices), _patterns(regex, notices)
        kind = pa.struct([
            ("label", pa.string()), ("first", pa.int64()), ("past", pa.int64()), ("errors", pa.int32()),
            ("similarity", pa.float64()), ("base", pa.bool_()), ("passage", pa.string()),
        ])
        for batch in batches:
            n_words, places = [], []
            for (value,) in rows_of([batch.select([batch.num_columns - 1])]):
                words = plain_words(value)
                # One character a byte, so that places in the text and in the words' bytes agree.
                joined = b" ".join([b"", *words, b""]).decode("latin-1")
                n_words.append(len(words))
                places.append(_places(joined, notices, seeds, patterns))
            columns = [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(places, pa.list_(kind))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "places"])

    return wanted.mapInArrow(scanned, schema)


def _bounds(notice: Notice) -> list[tuple[int, int]]:
    """Where the pieces of a notice's words begin and end."""
    parts, size = notice.errors + 1, len(notice.words)
    return [(size * i // parts, size * (i + 1) // parts) for i in range(parts)]


def _seeds(notices: tuple[Notice, ...]):
    import ahocorasick

    places: dict[str, list[tuple[int, int]]] = {}
    for number, notice in enumerate(notices):
        for first, past in _bounds(notice):
            places.setdefault(notice.words[first:past], []).append((number, first))
    automaton = ahocorasick.Automaton()
    for piece, owners in places.items():
        automaton.add_word(piece, (len(piece), owners))
    automaton.make_automaton()
    return automaton


def _patterns(regex, notices: tuple[Notice, ...]) -> list:
    tails = (f" {regex.escape(n.tail)}" if n.tail else "" for n in notices)
    return [
        regex.compile(f"(?b)(?<= )(?:{regex.escape(n.words)}){{e<={n.errors}}}{tail}(?= )") for n, tail in zip(notices, tails)
    ]


def _matches(pattern, joined: str, low: int, high: int):
    """Matches in order. The best one comes first and the search goes on after it, so what lies before is searched again."""
    for match in pattern.finditer(joined, low, high):
        yield from _matches(pattern, joined, low, match.start())
        yield match
        low = match.end()


def _places(joined: str, notices: tuple[Notice, ...], seeds, patterns) -> list[dict]:
    windows: dict[int, list[list[int]]] = {}
    for last, (length, owners) in seeds.iter(joined):
        for number, offset in owners:
            notice = notices[number]
            start = last - length + 1 - offset
            # Room for the errors, the tail, and the spaces on both sides.
            low, high = start - notice.errors - 1, start + len(notice.words) + len(notice.tail) + notice.errors + 2
            ranges = windows.setdefault(number, [])
            if notice.errors and ranges and low <= ranges[-1][1]:
                ranges[-1][1] = max(high, ranges[-1][1])
            else:
                ranges.append([low, high])
    found = []
    for number, ranges in windows.items():
        notice, size = notices[number], len(notices[number].words) + len(notices[number].tail)
        at = words = 0
        for low, high in ranges:
            for match in _matches(patterns[number], joined, max(0, low), min(len(joined), high)):
                words += joined.count(" ", at, match.start())
                at = match.start()
                errors = sum(match.fuzzy_counts)
                found.append({
                    "label": notice.label, "first": words - 1, "past": words + match[0].count(" "), "errors": errors,
                    "similarity": 1 - errors / size, "base": notice.base,
                    "passage": match[0].encode("latin-1").decode("utf-8", "replace"),
                })
    return found
