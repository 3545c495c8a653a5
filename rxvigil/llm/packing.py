"""Power-of-two packing: documents cut into pieces of binary lengths, so no sequence crosses documents."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.words import rows_of

PIECES = (
    "doc_id long, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long, bucket int"
)
#: A space may only be cut at if no other white space touches it.
WIDE_SPACE = re.compile(r"\s | \s|^ | $")
KNOWN_WORDS = 400_000
ROWS_PER_BATCH = 2048


def pack(
    docs: DataFrame, ranks: str, longest: int = 1024, end: int = 0, key: str = "doc_id", text: str = "text",
    added: dict[str, int] | None = None,
) -> DataFrame:
    """One row per sequence: a piece of one document, a power of two long, hence without any padding.

    A document is the ids of its whole text under the byte-level BPE whose ranks lie at ``ranks``, then the id
    ``end``; a string of ``added`` in the text has the id that stands there. It is cut into pieces of ``longest`` and then the binary digits of the rest, longest first. Each piece is
    a sequence of its own; ``bucket`` is its length, by which :func:`write_buckets` keeps equal lengths together.
    ``tokens`` holds the ids as little-endian unsigned 32-bit numbers. ``sequence_id`` is unique in the result, in no
    special order. No row is shuffled. A null or empty text gives the single id ``end``. Rows are packed one by
    one, so repeated rows give repeated pieces; other input columns are not carried. An empty table gives no pieces.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, added)
        last = np.array([end], dtype="<u4").tobytes()
        next_id, pieces = TaskContext.get().partitionId() << 33, []
        for doc_id, words in rows_of(batches):
            ids = encode(words or "") + last
            count, start = len(ids) // 4, 0
            while start < count:
                length = min(longest, 1 << ((count - start).bit_length() - 1))
                pieces.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], count, next_id, 0, length))
                start, next_id = start + length, next_id + 1
                if len(pieces) == ROWS_PER_BATCH:
                    yield _batch(pieces)
                    pieces = []
        if pieces:
            yield _batch(pieces)

    wanted = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return wanted.mapInArrow(cut, PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the pieces as Parquet, one folder for each length."""
    pieces.write.partitionBy("bucket").parquet(path)


def encoder(ranks: str, added: dict[str, int] | None = None):
    """A function from a text to the bytes of its ids.

    The text is first split at the strings of ``added``, which have ids of their own, as tokenizers does.
    The pre-tokenizer never joins text across a single space between two non-spaces, and the space opens what
    follows it. So a text falls into chunks whose ids are the same wherever they stand, and known ones are looked up.
    """
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    known: dict[str, bytes] = {}

    def ids(text: str) -> bytes:
        return np.array(bpe.encode_ordinary(text), dtype="<u4").tobytes()

    def plain(text: str) -> bytes:
        if WIDE_SPACE.search(text):
            return ids(text)
        first, *rest = text.split(" ")
        found = [ids(first)]
        for chunk in rest:
            got = known.get(chunk)
            if got is None:
                if len(known) >= KNOWN_WORDS:
                    known.clear()
                got = known[chunk] = ids(" " + chunk)
            found.append(got)
        return b"".join(found)

    if not added:
        return plain
    whole = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")")
    special = {t: np.array([i], dtype="<u4").tobytes() for t, i in added.items()}

    def encode(text: str) -> bytes:
        parts = whole.split(text)
        return b"".join(special[t] if n % 2 else plain(t) for n, t in enumerate(parts) if t) if len(parts) > 1 else plain(text)

    return encode


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    doc, start, length, tokens, count, sequence, offset, bucket = zip(*pieces)
    arrays = [
        pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
        pa.array(tokens, pa.binary()), pa.array(count, pa.int64()), pa.array(sequence, pa.int64()),
        pa.array(offset, pa.int64()), pa.array(bucket, pa.int32()),
    ]
    return pa.RecordBatch.from_arrays(
        arrays, ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset", "bucket"]
    )
