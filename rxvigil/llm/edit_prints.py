"""Document fingerprints by randomised edit embedding.

A walk over a text's characters writes the character it stands on and, by a random bit shared by all texts, stays or steps on.
Texts a few edits apart soon fall into step again, so the written sequences differ in few places: edit distance becomes
Hamming distance. A fingerprint samples places of the whole sequence. Bands of sampled digits, one more than may differ,
bring all near texts together, and the whole fingerprints verify them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.components import connected_components
from rxvigil.llm.words import in_blocks, rows_of
from rxvigil.session import written_table

SEED = 2021
#: Samples, each a hex digit of the fingerprint; steps after which the random bits repeat.
DIGITS, PERIOD = 128, 1 << 12
#: Characters that texts walked together hold; texts that still walk in step at least.
BLOCK, IN_STEP = 4 << 20, 48
#: Sampled digits of a band at most, and digits that are compared before all others.
BAND_DIGITS, MORE_DIGITS = 8, 48
#: Members up to which a group is compared pair by pair, and from about which on it is dealt over several tasks.
SMALL, HEAVY = 64, 1 << 14
#: Rows whose groups are compared together.
ROWS = 1 << 16
LONGEST = 1 << 40


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.8) -> DataFrame:
    """A row for every row of ``docs``: its fingerprint, that of an edited text, and how alike they are.

    The edited text is the text with its last ``n_chars // 3`` code points replaced by as many (or all there are) from the
    beginning of the next text, in descending order of the key; the first follows the last. Null keys come last; rows with
    equal keys follow each other by a hash of their texts, equal rows in any order. ``key``, ``n_chars``, ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and ``near_next`` (likeness to the edited and to the next text),
    and ``component_id``, the smallest key among the texts linked by :func:`near_components` at ``least`` or more. A null
    text is empty. A single row is its own next one. Other columns are not used. An empty table gives an empty result.

    The texts are range-partitioned by key once; each task walks its texts in order and needs the next text alone, so only
    the texts at the partitions' ends are paired by a join.
    """
    kind = docs.select(F.col(key)).schema[0].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
        "near_next double, part int, is_first boolean, is_last boolean, edge binary"
    )
    wanted = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("tie"), F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("row")]
    # A partition's only row is both its first and its last.
    in_order = wanted.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = written_table(in_order.mapInArrow(_in_turn, schema), "edit-prints")
    # One row a partition.
    parts = sorted(r["part"] for r in walked.filter("is_first").select("part").collect())
    following = docs.sparkSession.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part int, next_part int")
    firsts = walked.filter("is_first").select(F.col("part").alias("next_part"), F.col("edge").alias("next"))
    lasts = walked.filter("is_last").select("doc_id", F.col("edge").alias("text"), "part")
    ends = lasts.join(following, "part").join(firsts, "next_part").select("doc_id", "text", "next")
    inside = walked.filter("NOT is_last")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    whole = written_table(inside.select(columns).unionByName(ends.mapInArrow(_pairs_walked, schema).select(columns)), "edit-prints")
    named = near_components(whole.select("doc_id", "fingerprint"), least)
    return whole.join(named, "fingerprint").select(F.col("doc_id").alias(key), *columns[1:], "component_id")


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with a string column ``name``, a hex digit for each sample of the whole text's walk.

    Null texts are empty. A column of that name, in any case, is replaced. Equal texts have equal fingerprints.
    """
    kept = [c for c in (carry or docs.columns) if c.lower() != name.lower()]
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary").alias("__text")
    wanted = docs.select(*(F.col(f"`{c}`") for c in kept), own)

    def printed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py().decode("utf-8", "replace") for t in batch.column(batch.num_columns - 1)]
            found = []
            for block in in_blocks(((t, t) for t in texts), 0, BLOCK):
                found += [_hex(d) for d in _digits([t for t, _ in block])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string())], [*kept, name])

    return wanted.mapInArrow(printed, wanted.drop("__text").withColumn(name, F.lit("")).schema)


def likeness(a: Column, b: Column) -> Column:
    """The share of equal digits of two fingerprints, less what chance gives, between 0 and 1."""
    equal = F.aggregate(
        F.sequence(F.lit(1), F.lit(DIGITS)), F.lit(0), lambda n, i: n + F.when(F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)), 1).otherwise(0)
    )
    return F.greatest(F.lit(0.0), (equal / F.lit(DIGITS) - 1 / 16) / (15 / 16))


def near_components(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """``fingerprint`` and ``component_id`` for each distinct fingerprint of ``prints`` (``doc_id``, ``fingerprint``).

    Fingerprints with a likeness of ``least`` or more are linked, all of them: the digits are cut into one band more than
    may differ, so they are equal in a band at least, and all that are equal in a band are compared as a whole. Groups of
    ``HEAVY`` members or more are dealt into blocks, each pair of which is a group of its own. Of a group's links so many
    are given as connect it. ``component_id`` is the smallest key reachable by links, null if there is none but null keys.
    """
    nodes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    nodes = written_table(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct-prints")
    most = _most_different(least)
    keys = nodes.select("node", "fingerprint").mapInArrow(_banded(most + 1), "key long, node long, print binary")
    # A sixteenth of the nodes tells which groups are large. That deals the work only: any dealing gives the same links.
    some = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(16)) == 0).select("node", "fingerprint")
    some = some.mapInArrow(_banded(most + 1), "key long, node long, print binary")
    large = some.groupBy("key").agg(F.ceil(F.count("*") * 16 / HEAVY).cast("int").alias("blocks")).filter("blocks > 1")
    dealt = keys.join(F.broadcast(large), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own, other = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select("key", "node", "print", own.alias("own"), other.alias("other"))
    dealt = dealt.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "print")
    group = ["key", "low", "high"]
    links = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_linked(most), "a long, b long")
    roots = connected_components(links)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fingerprint", "component_id")


def _most_different(least: float) -> int:
    """Digits that may differ at a likeness of ``least``; -1 if none reaches it."""
    alike = [max(0.0, (n / DIGITS - 1 / 16) / (15 / 16)) >= least for n in range(DIGITS + 1)]
    return sum(alike) - 1


def _banded(bands: int):
    """A row for each band of a node: the band's digits, and all digits packed."""

    def banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = [own[:BAND_DIGITS] for own in np.array_split(np.arange(DIGITS), bands)] if bands else []
        for batch in batches:
            for some in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
                packed = [bytes.fromhex(f) for f in some.column(1).to_pylist()]
                digits = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, DIGITS // 2)
                digits = np.stack([digits >> 4, digits & 15], axis=2).reshape(-1, DIGITS).astype(np.int64)
                for band, own in enumerate(places):
                    key = np.zeros(len(digits), np.int64)
                    for place in own:
                        key = key << 4 | digits[:, place]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(band << 4 * BAND_DIGITS | key), some.column(0), pa.array(packed, pa.binary())], ["key", "node", "print"]
                    )

    return banded


def _linked(most: int):
    """Links that connect the near ones of each group; the rows come group by group."""

    def linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < ROWS:
                continue
            rows = pa.Table.from_batches(held)
            group = _group_of(rows)
            # The last group may go on in the next batch.
            last = int((group < group[-1]).sum())
            if last:
                yield _links(rows.slice(0, last), group[:last], most)
            held, count = rows.slice(last).to_batches(), 0
        if held:
            rows = pa.Table.from_batches(held)
            if rows.num_rows:
                yield _links(rows, _group_of(rows), most)

    return linked


def _group_of(rows: pa.Table) -> np.ndarray:
    """Numbers of the rows' groups, from 0 on."""
    changes = np.zeros(rows.num_rows, bool)
    for name in ("key", "low", "high"):
        values = rows.column(name).to_numpy()
        changes[1:] |= values[1:] != values[:-1]
    return changes.cumsum()


def _links(rows: pa.Table, group: np.ndarray, most: int) -> pa.RecordBatch:
    node = rows.column("node").to_numpy()
    prints = np.frombuffer(b"".join(rows.column("print").to_pylist()), "<u8").reshape(len(node), -1)
    sizes = np.bincount(group)
    first, past = [], []
    # All small groups together: each row with the next one, with the one after that, and so on.
    small = np.flatnonzero((sizes > 1)[group] & (sizes <= SMALL)[group])
    for step in range(1, SMALL):
        a = small[: len(small) - step]
        b = small[step:]
        same = group[a] == group[b]
        if not same.any():
            break
        a, b = a[same], b[same]
        near = _near(prints, a, b, most)
        first.append(a[near])
        past.append(b[near])
    starts = sizes.cumsum() - sizes
    for n in np.flatnonzero(sizes > SMALL):
        for a, b in _links_of_many(prints, np.arange(starts[n], starts[n] + sizes[n]), most):
            first.append(a)
            past.append(b)
    a, b = (np.concatenate([np.empty(0, np.int64), *ends]) for ends in (first, past))
    # Every row's smallest reachable one stands for its links.
    root = np.arange(len(node))
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
    at = np.flatnonzero(root != np.arange(len(node)))
    return pa.RecordBatch.from_arrays([pa.array(node[root[at]]), pa.array(node[at])], ["a", "b"])


def _links_of_many(prints: np.ndarray, rows: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect a large group: those near its first one stand together, then those near the first one left, and so on.

    Of two that are near and stand apart, each is at most twice ``most`` from the other's first one.
    """
    stands, around, left = [], np.full(len(rows), -1), np.arange(len(rows))
    while len(left):
        near = _near(prints, rows[left[:1]], rows[left], most)
        around[left[near]] = len(stands)
        stands.append(left[near])
        left = left[~near]
    for n, own in enumerate(stands):
        yield np.full(len(own) - 1, rows[own[0]]), rows[own[1:]]
        if len(own) == 1:
            continue
        later = np.flatnonzero(around > n)
        later = later[_near(prints, rows[own[:1]], rows[later], 2 * most)]
        for one in own[1:]:
            if not len(later):
                break
            near = later[_near(prints, rows[[one]], rows[later], most)]
            if len(near):
                yield np.full(len(near), rows[one]), rows[near]
                later = later[~np.isin(around[later], around[near])]


def _near(prints: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Whether at most so many digits differ, of rows ``a`` and ``b`` of the packed prints."""
    head = max(1, MORE_DIGITS // 16)
    near = _different(prints[a, :head], prints[b, :head]) <= most
    at = np.flatnonzero(near)
    near[at] = _different(prints[a if len(a) == 1 else a[at]], prints[b[at]]) <= most
    return near


def _different(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of different hex digits."""
    bits = a ^ b
    bits |= bits >> np.uint64(2)
    bits |= bits >> np.uint64(1)
    return np.bitwise_count(bits & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def _in_turn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in order, each with the next; the last row is left to be paired, with its text."""
    part, kind = TaskContext.get().partitionId(), None

    def rows() -> Iterator[tuple]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            # Invalid bytes become U+FFFD.
            yield from ((key, text.decode("utf-8", "replace")) for key, text in rows_of([batch]))

    before, first = None, True
    for block in in_blocks(rows(), 1, BLOCK):
        own = [before, *block] if before else block
        before = own[-1]
        if len(own) > 1:
            yield _results(own[:-1], [t for _, t in own[1:]], kind, part, first)
            first = False
    if before:
        text = before[1].encode()
        yield _batch([(before[0], *6 * [None], part, first, True, text)], kind)


def _pairs_walked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text, following in rows_of([batch]):
            yield _results([(key, text.decode())], [following.decode()], batch.schema.field(0).type)


def _results(rows: list[tuple], following: list[str], kind: pa.DataType, part: int = 0, first: bool = False) -> pa.RecordBatch:
    edited, texts = [], [t for _, t in rows]
    for text, other in zip(texts, following):
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + other[:cut])
    # In a block each text is the next of the one before it, and walked once.
    chained = following[:-1] == texts[1:]
    walked = _digits(texts + edited + (following[-1:] if chained else following))
    count, out = len(rows), []
    own, changed, more = walked[:count], walked[count : 2 * count], walked[2 * count :]
    after = np.concatenate([own[1:], more]) if chained else more
    for i, (key, text) in enumerate(rows):
        opens = first and i == 0
        out.append((
            key, len(text), hashlib.sha256(edited[i].encode()).hexdigest(), _hex(own[i]), _hex(changed[i]),
            _alike(own[i], changed[i]), _alike(own[i], after[i]), part, opens, False, text.encode() if opens else None,
        ))
    return _batch(out, kind)


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), *3 * [pa.string()], *2 * [pa.float64()], pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "is_first",
        "is_last", "edge",
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _hex(digits: np.ndarray) -> str:
    return (digits[::2] << 4 | digits[1::2]).tobytes().hex()


def _alike(a: np.ndarray, b: np.ndarray) -> float:
    return max(0.0, (int((a == b).sum()) / DIGITS - 1 / 16) / (15 / 16))


class _Walk:
    """The shared randomness: steps that a character stays, and the places that are sampled from a sequence.

    ``stays`` has for each place, modulo the period, and class of characters the number of places written before the walk
    steps on: the gap to the next random bit that is 1. Samples are the records of priorities shared by all texts: the
    last record before a sequence's end is a uniform place in it, and the same one for sequences of about equal length.
    """

    def __init__(self) -> None:
        draw = np.random.default_rng(SEED)
        steps = draw.integers(0, 2, (PERIOD, 256), np.int8)
        steps[-1] = 1
        stays = np.ones((PERIOD, 256), np.uint8)
        for at in range(PERIOD - 2, -1, -1):
            stays[at] = np.where(steps[at] == 1, 1, stays[at + 1] + 1)
        self.stays = stays.ravel()
        self.stays_bytes = self.stays.tobytes()
        records = [np.zeros(DIGITS, np.int64)]
        while records[-1].min() < LONGEST:
            records.append(np.minimum(((records[-1] + 1) / draw.uniform(1e-9, 1, DIGITS)).astype(np.int64), 2 * LONGEST))
        self.records = np.array(records)
        self.salt = draw.integers(1, 1 << 62, (len(records) + 1, DIGITS), np.int64).astype(np.uint64)

    def places(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        """For each text the places in its sequence at which its characters begin, and the sequence's length."""
        order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
        lengths = np.array([len(codes[i]) for i in order], np.int64)
        starts = np.cumsum(np.append(0, lengths + 1))
        flat = np.concatenate([np.append(codes[i], np.uint8(0)) for i in order]) if order else np.empty(0, np.uint8)
        begins = np.zeros(len(flat), np.int64)
        at = np.zeros(len(order), np.int64)
        step = 0
        active = int((lengths > 0).sum())
        while active >= IN_STEP:
            here = starts[:active] + step
            at[:active] += self.stays[(at[:active] & (PERIOD - 1)) << 8 | flat[here]]
            begins[here + 1] = at[:active]
            step += 1
            while active and lengths[active - 1] <= step:
                active -= 1
        stays, mask = self.stays_bytes, PERIOD - 1
        for i in range(active):  # few texts left: each walks on alone
            rest = flat[starts[i] + step : starts[i] + lengths[i]].tobytes()
            walked = accumulate(rest, lambda place, code: place + stays[(place & mask) << 8 | code], initial=int(at[i]))
            begins[starts[i] + step : starts[i + 1]] = np.fromiter(walked, np.int64, len(rest) + 1)
        found = [None] * len(codes)
        for n, i in enumerate(order):
            found[i] = begins[starts[n] : starts[n + 1]]
        return found

    def digits(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """A number from 0 to 15 for each sample: a hash of the sample and the character written there."""
        if not len(codes):
            return self._mixed(np.full(DIGITS, len(self.records)), np.zeros(DIGITS, np.uint64))
        record = (self.records < begins[-1]).sum(axis=0) - 1
        place = self.records[record, np.arange(DIGITS)]
        written = codes[np.searchsorted(begins, place, side="right") - 1]
        return self._mixed(record, written.astype(np.uint64))

    def _mixed(self, record: np.ndarray, written: np.ndarray) -> np.ndarray:
        mixed = (written + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ self.salt[record, np.arange(DIGITS)]
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(60)).astype(np.uint8)


_WALKS: list[_Walk] = []


def _digits(texts: list[str]) -> np.ndarray:
    """The fingerprints' digits, a row a text; the texts are walked together."""
    if not _WALKS:
        _WALKS.append(_Walk())
    walk, codes = _WALKS[0], [_classes(t) for t in texts]
    return np.array([walk.digits(c, p) for c, p in zip(codes, walk.places(codes))], np.uint8).reshape(-1, DIGITS)


def _classes(text: str) -> np.ndarray:
    """Characters as one of 256 classes: ASCII as it is, others by a hash."""
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    return np.where(points < 128, points, points * np.uint32(2654435761) >> np.uint32(24)).astype(np.uint8)
