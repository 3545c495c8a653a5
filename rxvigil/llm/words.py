"""Word splitting on UTF-8 bytes, used inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

#: Lower-cases A-Z and keeps every other byte; ``bytes.split()`` then cuts at 0x20 and 0x09-0x0D.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: The same, with every ASCII byte that is neither a letter nor a digit turned into a space.
ALNUM = bytes(b if 48 <= b <= 57 or b >= 128 else c if 97 <= c <= 122 else 32 for b, c in enumerate(LOWER))


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between white space."""
    return text.translate(LOWER).split() if text else []


def plain_words(text: bytes | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters."""
    return text.translate(ALNUM).split() if text else []


def in_blocks(rows: Iterable[tuple], text_at: int, limit: int, row_bytes: int = 0) -> Iterator[list[tuple]]:
    """Lists of rows whose texts together hold about ``limit`` bytes, so that a task's memory is bounded.

    ``row_bytes`` are counted for each row beside its text, where many texts may be empty.
    """
    block, held = [], 0
    for row in rows:
        block.append(row)
        held += len(row[text_at] or b"") + row_bytes
        if held >= limit:
            yield block
            block, held = [], 0
    if block:
        yield block


def rows_of(batches) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def with_columns(frame: DataFrame, **columns) -> DataFrame:
    """``frame`` with columns added; a column of the same name, in any case, is replaced."""
    names = {n.lower() for n in columns}
    kept = [c for c in frame.columns if c.lower() not in names]
    return frame.select(*(frame[f"`{c}`"] for c in kept), *(v.alias(n) for n, v in columns.items()))
