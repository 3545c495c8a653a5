"""Importance resampling towards a target's distribution, on hashed words and word pairs.

An untrained Regex Split of the tokenizers library over ASCII-lowered text returns a text's words with their offsets.
Windows of one and two consecutive offset pairs are features; the CRC of a window's bytes, words joined by one space, names
its bucket. Buckets are counted over all documents and over the target; the logarithm of the ratio is a bucket's gain, and a
document's weight is the mean gain of its features. Gumbel noise on the weights turns the largest sums into a sample.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.ranking import ranked
from rxvigil.llm.words import LOWER
from rxvigil.session import written_table

#: What a word is, and the reversed polynomial of CRC-32.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
POLYNOMIAL = 0xEDB88320
BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
#: Characters that are split at once, and bytes of a word that are hashed in step with others.
SLICE, IN_STEP = 1 << 16, 48
FEATURES = "n_words long, n_features long, buckets binary"


@dataclass(frozen=True)
class Settings:
    """``buckets``: at most 65,536; ``least_words``: of a text that may be drawn; ``percent``: of these that are drawn."""

    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    seed: int = 7


def resample(
    docs: DataFrame, target: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_features``, ``weight``, ``score`` and ``rank`` for every row of ``docs``, all long but the key.

    Weights are thousandths: the floored mean of the gains of a text's features, repeats counted, 0 without any.
    ``score`` adds Gumbel noise, made from the key and the seed alone. Of the texts with ``least_words`` words or more
    ``percent`` percent, rounded down, with the largest scores are drawn; ties go to smaller keys, then to any row, and null
    keys come last. ``rank`` numbers them from 1; it is null for all others. Null texts have no words; a null key is
    noised as an empty one. Repeated rows are counted and drawn each. Bytes that are no UTF-8 count as U+FFFD. Other columns of
    both tables are not used, whatever their names. Without target texts a gain says how rare a bucket is in ``docs``.
    An empty table gives an empty result. Each text is read once; its buckets, two bytes a feature, are written and read twice.
    """
    settings = settings or Settings()
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    bags = written_table(source.mapInArrow(_features(settings.buckets), f"key {kind}, {FEATURES}"), "feature-buckets")
    aimed = target.select(F.lit(0).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    aimed = aimed.mapInArrow(_features(settings.buckets), f"key int, {FEATURES}")
    gains = _gains(_histogram(bags, settings.buckets), _histogram(aimed, settings.buckets))
    # One number a bucket: bounded by the settings.
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    weighed = bags.mapInArrow(_weigher(shared), f"key {kind}, n_words long, n_features long, weight long")

    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    scored = scored.withColumn("eligible", F.col("n_words") >= settings.least_words)
    order = [F.desc("eligible"), F.desc("score"), F.col("key").asc_nulls_last()]
    placed = ranked(scored, order)
    eligible = placed.filter("eligible").count()
    rank = F.when(F.col("eligible") & (F.col("place") <= eligible * settings.percent // 100), F.col("place"))
    return placed.select(F.col("key").alias(key), "n_features", "weight", "score", rank.alias("rank"))


def _histogram(bags: DataFrame, size: int) -> np.ndarray:
    """Features in each bucket; a task sends one row a bucket, and as many rows reach the driver."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for data in batch.column(0):
                total += np.bincount(np.frombuffer(data.as_buffer(), "<u2"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    counts = bags.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, np.int64)
    total[counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return total


def _gains(everything: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the smoothed shares' ratio, rounded down."""
    size = len(everything)
    wanted = (target + 1.0) * float(everything.sum() + size)
    held = (everything + 1.0) * float(target.sum() + size)
    return np.floor(1000 * np.log(wanted / held)).astype(np.int64)


def _weigher(shared):
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            key, words, features, data = batch.columns
            weights = []
            for n, own in zip(features.to_pylist(), data):
                weights.append(int(gains[np.frombuffer(own.as_buffer(), "<u2")].sum()) // n if n else 0)
            yield pa.RecordBatch.from_arrays(
                [key, words, features, pa.array(weights, pa.int64())], ["key", "n_words", "n_features", "weight"]
            )

    return weigh


def _features(size: int):
    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Regex, pre_tokenizers

        split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        windows = _Windows(size)
        for batch in batches:
            texts = batch.column(1)
            words, held = [0] * len(texts), [[] for _ in range(len(texts))]
            for pieces in _blocks(t.as_py() for t in texts):
                # A line feed parts words, so the pieces can be split as one text.
                joined = "\n".join(piece for _, piece in pieces)
                found = split.pre_tokenize_str(joined)
                offsets = np.fromiter(chain.from_iterable(map(itemgetter(1), found)), np.int64, 2 * len(found)).reshape(-1, 2)
                lengths = [len(piece) + 1 for _, piece in pieces]
                starts = np.cumsum([0, *lengths])[:-1]
                piece_of = np.searchsorted(starts, offsets[:, 0], side="right") - 1
                for at, n, data in windows.buckets(joined, offsets, piece_of, [row for row, _ in pieces]):
                    words[at] += n
                    held[at].append(data)
            windows.start()
            data = [b"".join(parts) for parts in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array([len(d) // 2 for d in data], pa.int64()), pa.array(data, pa.binary())],
                ["key", "n_words", "n_features", "buckets"],
            )

    return read


def _blocks(texts: Iterable[bytes | None]) -> Iterator[list[tuple[int, str]]]:
    """Lists of (row, lowered piece of its text) with about ``SLICE`` characters; a long text is cut between words."""
    block, held = [], 0
    for row, text in enumerate(texts):
        for piece in _slices(text.translate(LOWER).decode("utf-8", "replace")) if text else ():
            block.append((row, piece))
            held += len(piece)
            if held >= SLICE:
                yield block
                block, held = [], 0
    if block:
        yield block


def _slices(text: str) -> Iterator[str]:
    """Consecutive parts of a long text, cut between words."""
    at = 0
    while len(text) - at > SLICE:
        cut = BETWEEN.search(text, at + SLICE)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def _table() -> np.ndarray:
    """What eight shifts of the CRC register do to each byte."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1)
    return value


@dataclass
class _Windows:
    """CRC buckets of the windows of one and two words. The last word of a text that goes on in the next block is kept."""

    size: int
    table: np.ndarray = field(default_factory=_table)
    last: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint32))
    last_row: int = -1

    def start(self) -> None:
        self.last_row = -1

    def buckets(self, text: str, offsets: np.ndarray, piece_of: np.ndarray, rows: list[int]) -> Iterator[tuple[int, int, bytes]]:
        """For each piece its row, its number of words, and its windows' buckets as little-endian 16-bit numbers."""
        if not len(offsets):
            return
        data = text.encode()
        codes = np.frombuffer(data, np.uint8)
        if len(data) > len(text):  # offsets count characters
            offsets = np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(data))[offsets]
        one = self._over(data, codes, offsets, np.full(len(offsets), 0xFFFFFFFF, np.uint32))
        # A window of two words goes on from the first word's register, past a space, over the second.
        spaced = self.table[(one ^ 32) & 0xFF] ^ (one >> 8)
        second = np.flatnonzero(piece_of[1:] == piece_of[:-1]) + 1
        before, goes_on = spaced[second - 1], rows[piece_of[0]] == self.last_row
        if goes_on:
            second, before = np.append(0, second), np.append(self.last, before)
        two = self._over(data, codes, offsets[second], before)
        self.last, self.last_row = spaced[-1:], rows[piece_of[-1]]
        ones, twos = (((~part) % np.uint32(self.size)).astype("<u2") for part in (one, two))
        pieces = np.arange(len(rows) + 1)
        one_at, two_at = np.searchsorted(piece_of, pieces), np.searchsorted(piece_of[second], pieces)
        for n, row in enumerate(rows):
            own = slice(one_at[n], one_at[n + 1])
            yield row, own.stop - own.start, ones[own].tobytes() + twos[two_at[n] : two_at[n + 1]].tobytes()

    def _over(self, data: bytes, codes: np.ndarray, offsets: np.ndarray, register: np.ndarray) -> np.ndarray:
        """The registers after the bytes of each window; all windows take a byte at a time, the longest first."""
        lengths = offsets[:, 1] - offsets[:, 0]
        order = np.argsort(-lengths, kind="stable")
        starts, state = offsets[order, 0], register[order]
        longest = int(lengths[order[0]]) if len(order) else 0
        # Windows that still have a byte at step i stand before more[i].
        more = len(order) - np.searchsorted(np.sort(lengths), np.arange(min(longest, IN_STEP)), side="right")
        for i, n in enumerate(more.tolist()):
            state[:n] = self.table[(state[:n] ^ codes[starts[:n] + i]) & 0xFF] ^ (state[:n] >> 8)
        if longest > IN_STEP:
            for at in np.flatnonzero(lengths[order] > IN_STEP).tolist():
                rest = data[starts[at] + IN_STEP : offsets[order[at], 1]]
                state[at] = zlib.crc32(rest, int(~state[at])) ^ 0xFFFFFFFF
        out = np.empty_like(state)
        out[order] = state
        return out
