"""Cross-entropy difference: how much better an n-gram model of the target predicts a document than one of all texts.

Both models are interpolated bigram models over one vocabulary with the same smoothing, and the background's counts are
scaled to the target's number of words, so that they differ in nothing but the texts they were counted on. Counts are
exact and grow with the corpus: every word and every bigram is counted.

Texts are kept in blocks of bounded size as numbers of their block's words. A block sends each of its distinct words
once, with its counts, to the part that counts it, packed with all others of that part; the part sends back the sums in
the same order. The same is done with bigrams, as pairs of the words' numbers. Parts grow in number, not in size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.words import in_blocks, plain_words, rows_of
from rxvigil.session import written_table

#: Bytes of text in a block, and those counted for a row beside its text.
BLOCK_BYTES, ROW_BYTES = 8 << 20, 64
#: Bytes of target keys, each counted with ``ROW_BYTES`` beside it, up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: Distinct words and bigrams of blocks that a part counts, about.
PART_WORDS, PART_BIGRAMS = 1 << 17, 1 << 18
COUNTS = ("word_target", "word_background", "before_target", "before_background")
PLANES = ", ".join(f"{c} binary" for c in COUNTS)
BLOCKS = f"n_tokens long, target boolean, ids binary, n_bigrams long, n_words long, words array<binary>, {PLANES}"
WORDS = f"part int, block long, words array<binary>, {PLANES}"
NUMBERS = f"part int, block long, n_words long, number binary, {PLANES}"
PACKED = "part int, block long, before binary, word binary, target binary, background binary"
SUMS = "part int, block long, target binary, background binary"
MODELS = ("target", "background")


@dataclass(frozen=True)
class Settings:
    """``pull``: weight of the unigram distribution, in counts."""

    pull: float = 20.0


def score(
    docs: DataFrame, targets: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_tokens``, ``target_loss``, ``background_loss`` and ``difference`` for every row of ``docs``.

    ``targets`` holds the keys of the target's documents; the background is all documents. Losses are mean bits a word;
    ``difference`` is the mean over the words of target loss less background loss, so it is lower for a document
    closer to the target. A text's words are runs of letters, digits and non-ASCII characters with A-Z lower-cased.
    Null and wordless texts have 0 tokens and a difference of 0. Without target documents both models are equal and
    every difference is 0. Repeated rows are counted and scored each; null keys are background only. A text longer than
    a block is a block of its own. Other input columns are not carried. An empty table gives an empty result.
    """
    settings = settings or Settings()
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    marks = written_table(targets.select(F.col(key).alias("key")).distinct().withColumn("target", F.lit(True)), "target-keys")
    # Few keys are broadcast; more are joined by shuffling the texts.
    key_bytes = marks.agg(F.sum(F.coalesce(F.octet_length(F.col("key").cast("string")), F.lit(0)) + ROW_BYTES)).first()[0] or 0
    if key_bytes <= BROADCAST_BYTES:
        marks = F.broadcast(marks)
    marked = source.join(marks, "key", "left").select("key", "text", F.coalesce("target", F.lit(False)).alias("target"))
    kind = source.schema["key"].dataType.simpleString()
    blocks = written_table(marked.mapInArrow(_blocks, f"block long, key {kind}, {BLOCKS}"), "blocks-of-texts")
    texts = blocks.filter("words IS NULL").select("block", "key", "n_tokens", "target", "ids")
    mass, target_mass, n_words, n_bigrams = (
        n or 0 for n in blocks.agg(F.sum("n_tokens"), F.sum(F.when(F.col("target"), F.col("n_tokens"))), F.sum("n_words"), F.sum("n_bigrams")).first()
    )

    own = blocks.filter("words IS NOT NULL").select("block", "words", *COUNTS)
    own = own.mapInArrow(_word_packer(-(-n_words // PART_WORDS) or 1), WORDS)
    numbers = written_table(own.groupBy("part").applyInArrow(_number_words, NUMBERS), "words-of-blocks")
    size = (numbers.agg(F.sum("n_words")).first()[0] or 0) + 1
    parts = -(-n_bigrams // PART_BIGRAMS) or 1
    by_block = numbers.select("block", F.col("part").alias("word_part"), "number", *COUNTS).groupBy("block")
    numbered = numbers.select("block", F.col("part").alias("word_part"), "number").groupBy("block")
    packed = texts.select("block", "target", "ids").groupBy("block").cogroup(numbered).applyInArrow(_packer(parts), PACKED)
    sums = written_table(packed.groupBy("part").applyInArrow(_add_up, SUMS), "bigram-sums")

    models = {"target": ("target" if target_mass else "background", 1.0), "background": ("background", (target_mass or mass) / (mass or 1))}
    both = texts.drop("target").unionByName(sums, allowMissingColumns=True)
    scorer = _scorer(parts, models, float(size), float(target_mass or mass), settings.pull)
    scored = both.groupBy("block").cogroup(by_block).applyInArrow(
        scorer, f"key {kind}, n_tokens long, target_loss double, background_loss double"
    )
    return scored.withColumn("difference", F.col("target_loss") - F.col("background_loss")).withColumnRenamed("key", key)


def _hash(word: bytes) -> int:
    """The word's place in the order of a block; the empty word is the first."""
    return xxhash.xxh64_intdigest(word) >> 1 if word else -1


def _word_packer(parts: int):
    """The words of each block cut by part, a range of hashes."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words = batch.column(1)[row].values
                hashes = np.array([max(_hash(w), 0) for w in words.to_pylist()], np.int64)
                part = (hashes >> 31) * parts >> 32
                counts = [_unpacked(batch.column(2 + i)[row].as_py(), np.int64) for i in range(len(COUNTS))]
                starts = np.append(0, np.flatnonzero(np.diff(part)) + 1)
                ends = np.append(starts[1:], len(part))
                cuts = [[_packed(np.ascontiguousarray(c[a:b])) for a, b in zip(starts, ends)] for c in counts]
                lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(part)), pa.int32()), words)
                blocks = pa.array(np.full(len(starts), batch.column(0)[row].as_py()), pa.int64())
                columns = [pa.array(part[starts], pa.int32()), blocks, lists, *(pa.array(c, pa.binary()) for c in cuts)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "block", "words", *COUNTS])

    return pack


def _number_words(packed: pa.Table) -> pa.Table:
    """The number and the sums of a part's words, for each block in its order."""
    lists = packed["words"].combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    words = lists.flatten().dictionary_encode()
    word = words.indices.to_numpy().astype(np.int64)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))[:-1]
    # The empty word is none of the vocabulary.
    distinct = len(words.dictionary) - pc.sum(pc.equal(pc.binary_length(words.dictionary), 0)).as_py()
    columns = [word + (packed["part"][0].as_py() << 32)]
    for name in COUNTS:
        counts = np.concatenate([_unpacked(v, np.int64) for v in packed[name].to_pylist()])
        sums = np.zeros(len(words.dictionary), np.int64)
        np.add.at(sums, word, counts)
        columns.append(sums[word])
    once = pa.array([distinct, *(packed.num_rows - 1) * [0]], pa.int64())
    cut = [pa.array([_packed(np.ascontiguousarray(c)) for c in np.split(v, ends)], pa.binary()) for v in columns]
    return pa.table([packed["part"], packed["block"], once, *cut], names=["part", "block", "n_words", "number", *COUNTS])


def _packed(values: np.ndarray) -> bytes:
    """The numbers compressed, all lowest bytes first, then all second ones and so on."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text with its words as numbers, and one for each block with its words and their counts.

    Word 0 of a block is the empty one before a text's beginning.
    """
    batches = iter(batches)
    first = next(batches, None)
    if first is None:
        return
    kinds = [pa.int64(), first.schema.types[0], pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.binary())]
    kinds += len(COUNTS) * [pa.binary()]
    names = ["block", "key", "n_tokens", "target", "ids", "n_bigrams", "n_words", "words", *COUNTS]
    base = TaskContext.get().partitionId() << 32
    for number, rows in enumerate(in_blocks(rows_of(chain([first], batches)), 1, BLOCK_BYTES, ROW_BYTES)):
        known: dict[bytes, int] = {b"": 0}
        ids = [np.array([known.setdefault(w, len(known)) for w in plain_words(text)], np.uint32) for _, text, _ in rows]
        # Words of a block are in order of their hash, so that those of a part are side by side.
        words = sorted(known, key=_hash)
        rank = np.empty(len(words), np.uint32)
        rank[[known[w] for w in words]] = np.arange(len(words), dtype=np.uint32)
        ids = [rank[i] for i in ids]
        marks = [target for _, _, target in rows]
        before, word, target = _bigrams(ids, marks)
        counts = [_packed(np.bincount(c, minlength=len(words))) for c in (word[target], word, before[target], before)]
        n_bigrams = len(np.unique(before << np.uint64(32) | word))
        out = [(base + number, key, len(i), mark, _packed(i), *(3 + len(COUNTS)) * [None]) for (key, _, mark), i in zip(rows, ids)]
        out.append((base + number, None, None, None, None, n_bigrams, len(words), words, *counts))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def _bigrams(ids: list[np.ndarray], marks: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the texts the one before it, the word itself and the text's mark."""
    word = np.concatenate([np.empty(0, np.uint32), *ids])
    before = np.concatenate([np.empty(0, np.uint32), *(i for own in ids if len(own) for i in (np.zeros(1, np.uint32), own[:-1]))])
    return before.astype(np.uint64), word.astype(np.uint64), np.repeat(np.array(marks, bool), [len(i) for i in ids])


def _distinct(ids: list[np.ndarray], numbers: np.ndarray, parts: int) -> tuple[np.ndarray, ...]:
    """The block's distinct bigrams in order of part and word numbers, and for each word of the texts the place of its bigram.

    The order depends on the bigrams alone, so the sums of a part come back in it.
    """
    before, word, _ = _bigrams(ids, [False] * len(ids))
    pairs, inverse = np.unique(before << np.uint64(32) | word, return_inverse=True)
    before, word = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    mixed = numbers[before].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + numbers[word].astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    part = ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((numbers[word], numbers[before], part))
    places = np.empty(len(order), np.int64)
    places[order] = np.arange(len(order))
    return part[order], before[order], word[order], places[inverse]


def _of_words(table: pa.Table, column: str) -> np.ndarray:
    """A column of a block's words in their order."""
    return np.concatenate([_unpacked(v, np.int64) for v in table.sort_by("word_part")[column].to_pylist()])


def _packer(parts: int):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("before", "word", *MODELS))])

    def pack(texts: pa.Table, words: pa.Table) -> pa.Table:
        ids = [_unpacked(i, np.uint32) for i in texts["ids"].to_pylist()]
        numbers = _of_words(words, "number")
        part, before, word, at = _distinct(ids, numbers, parts)
        marks = np.repeat(np.array(texts["target"].to_pylist(), bool), [len(i) for i in ids])
        target, background = (np.bincount(a, minlength=len(part)).astype(np.uint32) for a in (at[marks], at))
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else [0]
        rows = []
        for a, b in zip(cuts, cuts[1:]):
            steps = np.diff(numbers[before[a:b]], prepend=0)
            columns = (steps, numbers[word[a:b]], target[a:b], background[a:b])
            rows.append((int(part[a]), words["block"][0].as_py(), *map(_packed, map(np.ascontiguousarray, columns))))
        return pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)

    return pack


def _add_up(packed: pa.Table) -> pa.Table:
    """The sums of a part's bigrams over all blocks, for each block in its order."""
    before, word, target, background = (
        [_unpacked(v, kind) for v in packed[c].to_pylist()]
        for c, kind in (("before", np.int64), ("word", np.int64), ("target", np.uint32), ("background", np.uint32))
    )
    ends = np.cumsum([len(b) for b in before])[:-1]
    before, word = np.concatenate([np.cumsum(steps) for steps in before]), np.concatenate(word)
    order = np.lexsort((word, before))
    new = np.append(True, (np.diff(before[order]) != 0) | (np.diff(word[order]) != 0))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    out = []
    for counts in (target, background):
        ordered = np.concatenate(counts).astype(np.int64)[order]
        sums = np.add.reduceat(ordered, np.flatnonzero(new))[group]
        out.append(pa.array([_packed(s) for s in map(np.ascontiguousarray, np.split(sums, ends))], pa.binary()))
    return pa.table([packed["part"], packed["block"], *out], names=["part", "block", *MODELS])


def _scorer(parts: int, models: dict[str, tuple[str, float]], size: float, mass: float, pull: float):
    def score(rows: pa.Table, words: pa.Table) -> pa.Table:
        texts, sums = rows.filter(pc.is_null(rows["part"])), rows.filter(pc.is_valid(rows["part"])).sort_by("part")
        ids = [_unpacked(i, np.uint32) for i in texts["ids"].to_pylist()]
        _, before, word, at = _distinct(ids, _of_words(words, "number"), parts)
        lengths = np.array([len(i) for i in ids], np.int64)
        text = np.repeat(np.arange(len(ids)), lengths)
        losses = []
        for name, scale in models.values():
            counts = np.concatenate([np.empty(0, np.int64), *(_unpacked(v, np.int64) for v in sums[name].to_pylist())])
            single = (_of_words(words, f"word_{name}")[word] * scale + 1) / (mass + size)
            seen = (counts * scale + pull * single) / (_of_words(words, f"before_{name}")[before] * scale + pull)
            losses.append(np.bincount(text, -np.log2(seen)[at], len(ids)) / np.maximum(lengths, 1))
        return pa.table([texts["key"], texts["n_tokens"], *losses], names=["key", "n_tokens", *(f"{m}_loss" for m in models)])

    return score
