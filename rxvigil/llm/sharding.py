"""Histogram sort: rows dealt into shards of near-equal bytes along a sort key.

Rounds of exact counting find the shard boundaries. A round counts the bytes of every cell of the key
space; a cell that holds more than the tolerance is divided further by the next round's probes. Once no
cell is too large, every boundary can be put at a cell's edge, or between two rows of a cell of equal ones. Then one exchange
sorts the rows, and a row's place in the order says its shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxvigil.session import written_table

FIRST_BITS, STEP_BITS, KEY_BITS = 12, 6, 64


def shard_by_bytes(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", tolerance: float = 0.01
) -> DataFrame:
    """Add ``size``, ``shard`` and ``slot`` to ``docs``; shards are contiguous ranges of the key.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has no bytes). Every shard boundary is off its
    ideal place by at most half of ``tolerance`` of a shard's bytes, or half of a single larger row. ``slot``
    counts a shard's rows from 0 in key order. Null keys sort first. Rows with equal keys are ordered by a
    hash of their text and may be parted by a boundary, so that a hot key is split; rows equal in key and
    text are interchangeable and are parted like others, in any order. Input columns named like an added one are replaced. An
    empty table gives an empty result. The key must be an integer. The rows are written once, in order; no task
    holds more than a range of the order, whose size Spark's range partitioning balances.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    names = {"size", "shard", "slot"}
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in names)).alias("row"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))).alias("k"),
        F.xxhash64(F.col(text)).alias("t"),
        size.alias("size"),
    )
    # The rounds read this small table instead of the texts.
    digest = written_table(keyed.select("k", "t", "size"), "sharding-digest")
    low, high, total = digest.agg(F.min("k"), F.max("k"), F.sum("size")).first()
    if total is None:
        return keyed.select("row.*", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    same = KEY_BITS - ((low ^ high) & (2**64 - 1)).bit_length()
    bits = min(KEY_BITS, same + FIRST_BITS)

    probes, too_large = [bits], []
    while True:
        counted = (
            _located(digest, probes, too_large)
            .groupBy("cell", "cell_t")
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        )
        cells = written_table(counted, "sharding-cells")
        large = cells.filter((F.col("bytes") > tolerance * total / shards) & (F.col("rows") > 1))
        if probes[-1] == 2 * KEY_BITS or large.isEmpty():
            break
        # At most shards / tolerance cells are too large, whatever the input's size.
        too_large.append(written_table(large.select("cell", "cell_t"), "sharding-large"))
        step = probes[-1] + STEP_BITS
        probes.append(KEY_BITS if probes[-1] < KEY_BITS < step else min(2 * KEY_BITS, step))

    bounds = _bounds(cells, total, shards, tolerance)
    order = ["k", "t", "u"]
    sorted_ = keyed.withColumn("u", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().alias("place")
    ordered = written_table(sorted_.select("row", "size", place), "sharding-order")
    # One number a partition.
    part = F.shiftright("place", 33)
    held = {r["part"]: r["count"] for r in ordered.groupBy(part.alias("part")).count().collect()}
    before, bases = 0, []
    for number in range(max(held) + 1):
        bases.append(before - (number << 33))
        before += held.get(number, 0)
    base = F.element_at(F.expr(f"array({', '.join(f'{b}L' for b in bases)})"), (part + 1).cast("int"))
    rank = ordered.withColumn("rank", F.col("place") + base)
    first = F.expr(f"array({', '.join(f'{b}L' for b in bounds)})")
    dealt = rank.withColumn("shard", F.size(F.filter(first, lambda b: b <= F.col("rank"))) - 1)
    return dealt.select("row.*", "size", "shard", (F.col("rank") - F.element_at(first, F.col("shard") + 1)).alias("slot"))


def _bounds(cells: DataFrame, total: int, shards: int, tolerance: float) -> list[int]:
    """The rank of each shard's first row. Shards that begin at one rank: all but the last of them stay empty."""
    in_order = Window.orderBy("cell", "cell_t").rowsBetween(Window.unboundedPreceding, -1)
    below = cells.withColumn("bytes_below", F.coalesce(F.sum("bytes").over(in_order), F.lit(0)).cast("decimal(38,0)"))
    # Only cells of rows equal in key and text are still too large; their rows have one size.
    equal = (F.col("bytes") > tolerance * total / shards) & (F.col("rows") > 1)
    sums = []
    for shard in range(1, shards):
        edge = F.lit(shard * total // shards).cast("decimal(38,0)")
        whole = F.when(F.col("bytes_below") + F.expr("bytes div 2") < edge, F.col("rows")).otherwise(0)
        inside = F.round((edge - F.col("bytes_below")) * F.col("rows") / F.col("bytes")).cast("long")
        taken = F.when(equal, F.least(F.col("rows"), F.greatest(F.lit(0), inside))).otherwise(whole)
        sums.append(F.sum(taken).cast("long").alias(f"b{shard}"))
    # One number a shard.
    return [0, *(below.agg(*sums).first() if sums else [])]


def _prefix(column: str, bits: int) -> Column:
    """The column with all but its leading bits cleared: the lower edge of its cell."""
    if bits <= 0:
        return F.lit(0).cast("long")
    if bits >= KEY_BITS:
        return F.col(column)
    return F.col(column).bitwiseAND(F.lit(-(1 << (KEY_BITS - bits))).cast("long"))


def _located(rows: DataFrame, probes: list[int], too_large: list[DataFrame]) -> DataFrame:
    """``rows`` with their cell; each table of ``too_large`` sends the rows of its cells on to finer ones."""
    found = rows.withColumns({"cell": _prefix("k", probes[0]), "cell_t": _prefix("t", probes[0] - KEY_BITS)})
    for bits, large in zip(probes[1:], too_large):
        marked = large.select(F.col("cell").alias("large"), F.col("cell_t").alias("large_t"))
        found = found.join(
            F.broadcast(marked), (F.col("cell") == F.col("large")) & (F.col("cell_t") == F.col("large_t")), "left"
        )
        finer = {"cell": _prefix("k", bits), "cell_t": _prefix("t", bits - KEY_BITS)}
        found = found.withColumns(
            {n: F.when(F.col("large").isNotNull(), c).otherwise(F.col(n)) for n, c in finer.items()}
        ).drop("large", "large_t")
    return found
