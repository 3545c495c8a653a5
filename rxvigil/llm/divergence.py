"""Audit of how far the sources of a language diverge from each other and from the language as a whole.

Terms are counted in tasks on packed words: terms fall into buckets by length; up to 8 bytes become one unsigned 64-bit word,
up to 16 bytes two, which are radix-sorted by 16-bit digits and counted by runs. Longer terms lie in buckets of one length
each, sorted as bytes. All shares are whole numbers of billionths, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxvigil.llm.words import in_blocks, rows_of
from rxvigil.session import written_table

#: A-Z lower-cased, and every ASCII byte that is no letter turned into 0.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 0 for b in range(256))
BLOCK_BYTES = 8 << 20
COUNTS = "lang string, source string, term binary, n long, docs long"
#: Sources and terms that are compared in one step; a step's table holds about so many squared sources times terms.
TILE, TERMS_AT_ONCE = 128, 512
SCALE, SMOOTHING = 1_000_000_000, 5


def audit(
    docs: DataFrame, least_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: divergence of every source of every language.

    A term is a run of letters and non-ASCII characters with A-Z lower-cased; a language keeps those in ``least_docs`` of its
    documents or more. A share is 1 + floor(10^9 (count + 5) / (N + 5 V)), with N occurrences of the V kept terms. Part ``pair`` ranks the
    other sources of the language by the sum over all kept terms of the shares' absolute differences (0 without kept terms).
    Part ``term`` ranks the source's terms whose share is above the language's by that difference, up to rank ``top``. Ranks
    go by value downwards, then item by UTF-8 bytes. Null texts, languages and sources are empty strings; sources without any
    term take part in pairs. Repeated rows are documents of their own. Other columns are not used, whatever their names. An
    empty table gives an empty result. A text must fit a task.
    """

    def plain(name: str, alias: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(alias)

    wanted = docs.select(plain(lang, "lang"), plain(source, "source"), plain(text, "text").cast("binary").alias("text"))
    pieces = wanted.mapInArrow(_term_counts, COUNTS)
    counts = pieces.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written_table(counts, "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = written_table(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    found = written_table(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")

    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = wanted.select("lang", "source").distinct()
    tiles = F.ceil(F.count("*") / TILE).cast("int")
    langs = groups.groupBy("lang").agg(tiles.alias("tiles")).join(langs, "lang", "left")
    groups = groups.join(langs, "lang").join(totals, ["lang", "source"], "left").na.fill(0, ["v", "lang_total", "total"])
    buckets = F.greatest(F.ceil(F.col("v") / TERMS_AT_ONCE), F.lit(1)).cast("int")
    groups = groups.withColumn("buckets", buckets).withColumn("base", _share(F.lit(0), "total"))
    groups = written_table(groups, "source-groups")

    shares = found.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), "total"))
    shares = shares.withColumn("q", _share(F.col("lang_n"), "lang_total"))
    terms = shares.filter("p > q").select("lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    pairs = _pairs(shares, groups).withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return terms.withColumn("part", F.lit("term")).select(columns).unionByName(pairs.withColumn("part", F.lit("pair")).select(columns))


def _share(count: Column, total: str) -> Column:
    """Billionths, rounded down, plus 1; exact in decimals. Null without kept terms."""
    above = (count.cast("decimal(20,0)") + SMOOTHING) * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif(F.col(total) + SMOOTHING * F.col("v"), F.lit(0)).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Sums of differences of each two sources of a language.

    Sources fall into tiles and terms into buckets. A task gets the shares of two tiles in one bucket; a source without a
    term there has its base share, so that only terms found somewhere are sent, and the others are counted.
    """
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    to_every_tile = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    here = shares.select(
        "lang", "source", "base", "term", "p", tile.alias("tile"), "tiles",
        F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int").alias("bucket"),
    )
    # Each source stands in every bucket once without a term.
    marks = groups.select(
        "lang", "source", "base", F.lit(None).cast("binary").alias("term"), F.lit(None).cast("long").alias("p"), tile.alias("tile"),
        "tiles", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
    )
    sent = here.unionByName(marks).withColumn("other", to_every_tile).select(
        "lang", "bucket", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b"), "tile",
        "source", F.coalesce("base", F.lit(0)).alias("base"), "term", "p",
    )
    compared = sent.groupBy("lang", "bucket", "tile_a", "tile_b").applyInPandas(
        _compared, "lang string, a string, b string, f long, found long"
    )
    sums = compared.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"), F.sum("found").alias("found"))
    both = sums.select("lang", F.inline(F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))
    )), "f", "found")
    own = groups.select("lang", "source", "v", F.coalesce("base", F.lit(0)).alias("base"))
    theirs = groups.select("lang", F.col("source").alias("item"), F.coalesce("base", F.lit(0)).alias("item_base"))
    both = both.join(own, ["lang", "source"]).join(theirs, ["lang", "item"])
    rest = (F.col("v") - F.col("found")) * F.abs(F.col("base") - F.col("item_base"))
    return both.select("lang", "source", "item", (F.col("f") + rest).alias("value"))


def _compared(rows: pd.DataFrame) -> pd.DataFrame:
    """Each two sources of the tiles' pair: the sum of their differences over the terms found here, and their number."""
    marks = rows[rows["term"].isna()].drop_duplicates("source")
    sources, tiles = marks["source"].to_numpy(), marks["tile"].to_numpy()
    shares = rows[rows["term"].notna()]
    number = {s: i for i, s in enumerate(sources)}
    terms = pd.factorize(shares["term"].map(bytes))[0]
    found = int(terms.max()) + 1 if len(terms) else 0
    table = np.repeat(marks["base"].to_numpy(np.int64)[:, None], found, axis=1)
    table[shares["source"].map(number).to_numpy(np.int64), terms] = shares["p"].to_numpy(np.int64)
    out, one_tile = [], rows["tile_a"].iloc[0] == rows["tile_b"].iloc[0]
    for i in range(len(sources)):
        # Two sources of one tile meet in that tile's own group, two of different tiles in their tiles' group.
        others = np.arange(i + 1, len(sources))
        if not one_tile:
            others = others[tiles[others] != tiles[i]]
        sums = np.abs(table[others] - table[i]).sum(axis=1)
        out += [(*sorted((sources[i], sources[j])), int(f)) for j, f in zip(others, sums)]
    result = pd.DataFrame(out, columns=["a", "b", "f"])
    result.insert(0, "lang", rows["lang"].iloc[0])
    result["found"] = found
    return result.astype({"f": "int64", "found": "int64"})


def _term_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of each term in each group of a block of documents, and the documents that hold it."""
    for block in in_blocks(rows_of(batches), 2, BLOCK_BYTES):
        # In order of groups, so that stable sorting keeps the documents of a group together.
        block.sort(key=lambda row: row[:2])
        groups = sorted({row[:2] for row in block})
        number = {g: i for i, g in enumerate(groups)}
        group_of = np.array([number[row[:2]] for row in block], np.int64)
        langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
        for terms, group, n, docs in _runs([row[2] for row in block], group_of):
            at = pa.array(group)
            yield pa.RecordBatch.from_arrays(
                [langs.take(at), sources.take(at), terms, pa.array(n), pa.array(docs)], ["lang", "source", "term", "n", "docs"]
            )


def _runs(texts: list[bytes], group_of: np.ndarray) -> Iterator[tuple]:
    """For each bucket of lengths: term, group, occurrences, and documents, a row for each term in each group."""
    data = b"\0".join(t.translate(LETTERS) for t in texts)
    codes = np.frombuffer(data + bytes(17), np.uint8)
    edges = np.flatnonzero(np.diff((codes != 0).astype(np.int8), prepend=np.int8(0)))
    starts, lengths = edges[::2], np.diff(edges)[::2]
    first_byte = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    docs = np.searchsorted(first_byte, starts, side="right") - 1
    for digits in range(1, 9):
        mine = np.flatnonzero((lengths > 2 * digits - 2) & (lengths <= 2 * digits))
        if len(mine):
            words = _packed(codes, starts[mine], lengths[mine], 1 if digits <= 4 else 2)
            order = _radix_order(words, digits)
            words, width = words[order], 8 * words.shape[1]
            terms = np.ascontiguousarray(words).astype(">u8").view(f"S{width}").ravel()
            yield _counted(terms, (words[1:] != words[:-1]).any(axis=1), docs[mine][order], group_of)
    for length in np.unique(lengths[lengths > 16]).tolist():
        mine = np.flatnonzero(lengths == length)
        terms = np.lib.stride_tricks.sliding_window_view(codes, length)[starts[mine]].view(f"S{length}").ravel()
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        yield _counted(terms, terms[1:] != terms[:-1], docs[mine][order], group_of)


def _packed(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, words: int) -> np.ndarray:
    """Terms as rows of big-endian 64-bit words, zero behind their end."""
    taken = np.lib.stride_tricks.sliding_window_view(codes, 8 * words)[starts]
    taken = np.ascontiguousarray(taken).view(">u8").astype(np.uint64)
    for word in range(words):
        spare = np.clip(8 * (word + 1) - lengths, 0, 7).astype(np.uint64) * np.uint64(8)
        taken[:, word] = taken[:, word] >> spare << spare
    return taken


def _radix_order(words: np.ndarray, digits: int) -> np.ndarray:
    """Stable order of rows of words by their first ``digits`` 16-bit digits, the last digit first."""
    order = None
    for digit in reversed(range(digits)):
        values = (words[:, digit // 4] >> np.uint64(48 - 16 * (digit % 4))).astype(np.uint16)
        # NumPy sorts 16-bit numbers stably by radix.
        step = np.argsort(values if order is None else values[order], kind="stable")
        order = step if order is None else order[step]
    return order


def _counted(terms: np.ndarray, differs: np.ndarray, docs: np.ndarray, group_of: np.ndarray) -> tuple:
    """Runs of sorted terms within a group: a first row of each, its length and the documents in it."""
    groups = group_of[docs]
    opens = np.append(True, differs | (groups[1:] != groups[:-1]))
    at = np.flatnonzero(opens)
    new_doc = opens | np.append(True, docs[1:] != docs[:-1])
    in_docs = np.add.reduceat(new_doc.astype(np.int64), at)
    return pa.array(terms[at].tolist(), pa.binary()), groups[at], np.diff(np.append(at, len(terms))), in_docs
