"""Quality by importance resampling: texts drawn in proportion to how much likelier they are as target than as raw text.

Two bag-of-hashed-n-gram models, one of target texts and one of all texts, give each document a log weight. Adding Gumbel
noise and taking the k largest sums draws k documents without replacement in proportion to the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.words import LOWER, rows_of
from rxvigil.session import written_table

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^\s0-9a-z\x80-\xff]+")
KNOWN_WORDS = 400_000


@dataclass(frozen=True)
class Settings:
    """``buckets``: hashed unigrams and bigrams; ``targets``: labelled texts the target model is fitted on at most."""

    buckets: int = 1 << 14
    targets: int = 20_000
    seed: int = 7


def resample(
    docs: DataFrame, targets: DataFrame, share: float, settings: Settings | None = None, key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, ``log_weight``, ``draw`` (log weight and noise) and ``selected`` for every row of ``docs``.

    ``targets`` holds the keys of target documents; the first ``settings.targets`` by hash are fitted on. The raw model counts
    all documents. ``round(share * rows)`` rows with the largest draws are selected; ties go to smaller keys, then to an
    arbitrary one. The noise depends on key and seed alone, so a run can be repeated. Tokens are runs of letters, digits
    and non-ASCII characters and runs of other visible characters; features are tokens and pairs of them. Null and
    empty texts weigh 0. Without targets all weights are 0. Other input columns are not carried. An empty table gives
    an empty result.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    kind = docs.select(key).schema[0].dataType.simpleString()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    order = (F.xxhash64("key", F.lit(settings.seed)), F.col("key"))
    chosen = targets.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct().orderBy(*order)
    # Bounded by the settings, so it may be sent to every task.
    chosen = written_table(chosen.limit(settings.targets).withColumn("target", F.lit(True)), "target-sample")
    marked = source.join(F.broadcast(chosen), "key", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = marked.mapInArrow(_counter(settings.buckets), "bucket int, target long, raw long")
    table = counts.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toArrow()
    ratios = spark.sparkContext.broadcast(_log_ratios(table, settings.buckets))
    weighed = source.mapInArrow(_weigher(ratios, settings.buckets), f"key {kind}, log_weight double")
    # Uniform in (0, 1) from 53 bits of a hash.
    uniform = (F.shiftrightunsigned(F.xxhash64("key", F.lit("gumbel"), F.lit(settings.seed)), 11) + F.lit(0.5)) / F.lit(2.0**53)
    draws = weighed.withColumn("draw", F.col("log_weight") - F.log(-F.log(uniform)))
    # Written in order, so that a row's place is its rank; only counts of the partitions are collected.
    place = F.monotonically_increasing_id()
    ordered = draws.repartitionByRange(F.desc("draw"), "key").sortWithinPartitions(F.desc("draw"), "key")
    ordered = written_table(ordered.withColumn("place", place), "draws")
    part = F.shiftright("place", 33)
    held = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    left = round(share * sum(r["count"] for r in held))
    last = -1  # the place of the last row selected
    for row in held:
        if left <= 0:
            break
        last = (row["part"] << 33) + min(left, row["count"]) - 1
        left -= row["count"]
    return ordered.select(F.col("key").alias(key), "log_weight", "draw", (F.col("place") <= last).alias("selected"))


class _Buckets:
    """The buckets of a text's tokens and token pairs."""

    def __init__(self, buckets: int):
        self.buckets, self.known = np.uint64(buckets), {}

    def of(self, text: bytes | None) -> np.ndarray:
        hashed = []
        for token in TOKEN.findall(text.translate(LOWER)) if text else ():
            value = self.known.get(token)
            if value is None:
                if len(self.known) >= KNOWN_WORDS:
                    self.known.clear()
                value = self.known[token] = xxhash.xxh64_intdigest(token)
            hashed.append(value)
        one = np.array(hashed, np.uint64)
        two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
        two ^= two >> np.uint64(31)
        return (np.concatenate([one, two]) % self.buckets).astype(np.int64)


def _counter(size: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, raw, target = _Buckets(size), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for text, is_target in rows_of([batch]):
                found = np.bincount(buckets.of(text), minlength=size)
                raw += found
                if is_target:
                    target += found
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(target[at]), pa.array(raw[at])], ["bucket", "target", "raw"]
        )

    return count


def _log_ratios(table: pa.Table, size: int) -> np.ndarray:
    logs = []
    for name in ("target", "raw"):
        counts = np.ones(size)
        counts[table["bucket"].to_numpy()] += table[name].to_numpy()
        logs.append(np.log(counts / counts.sum()))
    return logs[0] - logs[1] if len(table) and table["target"].to_numpy().any() else np.zeros(size)


def _weigher(ratios, size: int):
    def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, ratio = _Buckets(size), ratios.value
        for batch in batches:
            weights = [float(ratio[buckets.of(text.as_py())].sum()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights, pa.float64())], ["key", "log_weight"])

    return weigh
