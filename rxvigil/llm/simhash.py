"""SimHash near-duplicates found by anchor-point covering.

Anchors are the codewords of a product of perfect binary Golay codes over the fingerprint's first 46 bits. Every block
of 23 bits lies within 3 bits of exactly one codeword (its home). If two fingerprints differ by at most the
threshold, one lies within covering radius plus threshold of the other's home; so replicating every fingerprint to all
these anchors and comparing it with those at home there finds every link.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.components import connected_components
from rxvigil.llm.words import rows_of, spaced_words
from rxvigil.session import written_table

SEED = 42
#: The binary Golay code's length, check bits, generator polynomial and covering radius.
LENGTH, CHECKS, GENERATOR, RADIUS = 23, 11, 0xC75, 3
BLOCKS = 2
HASHES_AT_ONCE = 1 << 15
FINGERPRINTS_AT_ONCE = 2048
#: An anchor with more fingerprints at home is compared in parts of about this size.
HOMES_AT_ONCE = 4096


def fingerprints(
    docs: DataFrame, shingle: int = 3, text: str = "text", name: str = "fingerprint", carry: list[str] | None = None
) -> DataFrame:
    """``docs`` (or its columns ``carry``) with a long column ``name``: bit i is set if it is set in over half of the shingles' XXH64.

    Words lie between ASCII white space, with A-Z lower-cased; shingles are ``shingle`` consecutive words, repeats
    included, joined by spaces. A text with fewer words is one shingle; null and wordless texts get 0. A column of that
    name is replaced.
    """
    kept = [c for c in (carry or docs.columns) if c.lower() != name.lower()]
    wanted = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text).cast("binary").alias("__words"))
    schema = wanted.drop("__words").withColumn(name, F.lit(0).cast("long")).schema

    def fingerprint(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_fingerprint(t.as_py(), shingle) for t in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array(np.array(own, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, name])

    return wanted.mapInArrow(fingerprint, schema)


def _fingerprint(text: bytes | None, shingle: int) -> int:
    words = spaced_words(text)
    if not words:
        return 0
    hashed, join = xxhash.xxh64_intdigest, b" ".join
    count = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, HASHES_AT_ONCE):
        part = words[at : at + HASHES_AT_ONCE + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [words]
        values = np.array([hashed(join(run), SEED) for run in runs], "<u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<u8")[0])


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words after division by the generator."""
    left = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - CHECKS)), left)
    return left


def _patterns(extra: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For m from 0 to ``extra``: the error patterns from a word to the anchors at distance up to RADIUS (m = 0) or
    exactly RADIUS + m, sorted by syndrome, with each syndrome's first pattern and count."""
    tables = []
    for m in range(extra + 1):
        weights = range(RADIUS + 1) if m == 0 else [RADIUS + m]
        errors = np.array([sum(1 << i for i in c) for w in weights for c in combinations(range(LENGTH), w)], np.int64)
        syndromes = _syndromes(errors)
        counts = np.bincount(syndromes, minlength=1 << CHECKS)
        tables.append((errors[np.argsort(syndromes, kind="stable")], np.cumsum(counts) - counts, counts))
    return tables


def _spread(at: np.ndarray, word: np.ndarray, table) -> tuple[np.ndarray, np.ndarray]:
    """For rows ``at``: each anchor that the table has for their word, and the row it is for."""
    errors, first, counts = table
    syndrome = _syndromes(word)
    n = counts[syndrome]
    row = np.repeat(np.arange(len(word)), n)
    within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    return at[row], word[row] ^ errors[np.repeat(first[syndrome], n) + within]


def anchors(distinct: DataFrame, threshold: int, name: str = "fingerprint") -> DataFrame:
    """``anchor`` and ``fingerprint`` for each anchor within covering radius plus threshold.

    Distances beyond the radius add up over the blocks; together they may not exceed the threshold. With a threshold
    of 0 each fingerprint gets its home alone.
    """

    def replicate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _patterns(threshold)
        for batch in batches:
            values = np.asarray(batch.column(0))
            for at in range(0, len(values), FINGERPRINTS_AT_ONCE):
                yield from _replicas(values[at : at + FINGERPRINTS_AT_ONCE], tables, threshold)

    return distinct.select(name).mapInArrow(replicate, "anchor long, fingerprint long")


def _replicas(values: np.ndarray, tables, threshold: int) -> Iterator[pa.RecordBatch]:
    mask = (1 << LENGTH) - 1
    frontier = [(np.arange(len(values)), np.zeros(len(values), np.int64), 0)]
    for block in range(BLOCKS):
        grown = []
        for row, anchor, used in frontier:
            word = (values[row] >> (LENGTH * block)) & mask
            for m in range(threshold - used + 1):
                at, code = _spread(np.arange(len(row)), word, tables[m])
                grown.append((row[at], anchor[at] | code << (LENGTH * block), used + m))
        frontier = grown
    for row, anchor, _ in frontier:
        yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(values[row])], ["anchor", "fingerprint"])


def links(distinct: DataFrame, threshold: int = 2, name: str = "fingerprint") -> DataFrame:
    """Every pair ``a < b`` of different fingerprints that differ by at most ``threshold`` bits, once.

    ``distinct`` holds each fingerprint once. A fingerprint has at most a few thousand such neighbours, so links
    grow with the fingerprints. An anchor that is home to many is compared in parts.
    """
    homes = anchors(distinct, 0, name).select("anchor", F.col("fingerprint").alias("a"))
    guests = anchors(distinct, threshold, name).select("anchor", F.col("fingerprint").alias("b"))
    hot = homes.groupBy("anchor").count().filter(F.col("count") > HOMES_AT_ONCE)
    hot = written_table(hot.select("anchor", F.ceil(F.col("count") / HOMES_AT_ONCE).cast("int").alias("parts")), "hot-anchors")
    parts = F.coalesce("parts", F.lit(1))
    homes = homes.join(hot, "anchor", "left").select("anchor", "a", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part"))
    guests = guests.join(hot, "anchor", "left").select("anchor", "b", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)
    # Spark takes the replicas for no larger than the fingerprints they are made of, and would broadcast them.
    met = homes.join(guests.hint("merge"), (homes.anchor == guests.anchor) & (homes.part == guests.part) & close)
    return met.select("a", "b")


def components(
    docs: DataFrame, shingle: int = 3, threshold: int = 2, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` for every row of ``docs``.

    Fingerprints link at ``threshold`` or fewer differing bits; equal ones are one node, so copies of a text are
    never paired. ``component_id`` is the smallest key reachable; it is null if all of a component's keys are. Rows with
    null or repeated keys each keep a row. An empty table gives an empty result.
    """
    wanted = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    printed = written_table(fingerprints(wanted, shingle, carry=["doc_id"]), "fingerprints")
    named = _rooted(printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), threshold)
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "root").select("fingerprint", "component_id")
    return printed.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, threshold: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their component: the one with the smallest key, null keys last.

    Ties between rows of the same key go to a hash of the whole row; rows equal in every column are one document.
    """
    row = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    identified = docs.withColumns({"__key": F.col(key), "__row": row})
    printed = written_table(fingerprints(identified, shingle, text, carry=["__key", "__row"]), "fingerprints")
    order = F.struct(F.col("__key").isNull().alias("no_key"), "__key", "__row")
    named = _rooted(printed.groupBy("fingerprint").agg(F.min(order).alias("least")), threshold)
    chosen = written_table(named.groupBy("root").agg(F.min("least").alias("least")).select("least.__key", "least.__row"), "kept-rows")
    same = identified["__row"].eqNullSafe(chosen["__row"]) & identified["__key"].eqNullSafe(chosen["__key"])
    return identified.join(chosen, same, "left_semi").dropDuplicates(["__key", "__row"]).select(docs.columns)


def _rooted(distinct: DataFrame, threshold: int) -> DataFrame:
    """``distinct``, one row a fingerprint, with ``root``, which the fingerprints of a component share."""
    distinct = written_table(distinct, "distinct-fingerprints")
    roots = connected_components(written_table(links(distinct, threshold), "near-links"))
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").drop("node")
    return written_table(rooted.withColumn("root", F.coalesce("root", "fingerprint")), "rooted-fingerprints")


def hex_digits(name: str = "fingerprint"):
    """The fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(name), 16, "0"))
