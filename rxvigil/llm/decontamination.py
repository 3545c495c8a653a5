"""Benchmark decontamination with a distributed positional inverted index.

The index is a table of segments. A segment holds the postings of every word of some whole documents: for each term
the sorted places where it stands. Test windows are looked up in every segment, rarest term first: its places, moved
back by its offset in the window, are intersected with the next rarest term's, until the phrase is proved or gone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.words import in_blocks, plain_words, rows_of
from rxvigil.session import written_table

SEGMENTS = "segment long, doc_ids array<long>, starts binary, terms binary, ends binary, places binary"
SPAN = "struct<first:int,past:int>"
MATCHES = (
    f"segment long, nth int, doc_id long, n_words long, hits array<{SPAN}>, "
    "phrases array<struct<item_id:string,first:int,past:int>>, near array<struct<item_id:string,first:int,past:int>>"
)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", segment_bytes: int = 4 << 20) -> DataFrame:
    """The positional index of whole documents, as a table of segments of about ``segment_bytes`` of text.

    Postings are little-endian 32-bit places in the segment's word stream; documents are kept apart in that stream by
    a gap wider than any window, so no match crosses them. Documents without words are indexed without postings.
    """
    wanted = docs.select(F.col(key).cast("long"), F.col(text).cast("string").cast("binary"))

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        segment = TaskContext.get().partitionId() << 33
        for block in in_blocks(rows_of(batches), 1, segment_bytes):
            yield _segment(segment, block)
            segment += 1

    return wanted.mapInArrow(segments, SEGMENTS)


GAP = 64


def _segment(segment: int, block: list[tuple]) -> pa.RecordBatch:
    term_ids: dict[bytes, int] = {}
    known, stream, starts, at = term_ids.setdefault, [], [0], 0
    places = []
    for _, text in block:
        words = plain_words(text)
        stream.append(np.fromiter((known(w, len(term_ids)) for w in words), np.int32, len(words)))
        places.append(np.arange(at, at + len(words), dtype=np.int32))
        at += len(words) + GAP
        starts.append(at)
    ids, place = np.concatenate(stream), np.concatenate(places)
    order = np.argsort(ids, kind="stable")
    ends = np.cumsum(np.bincount(ids, minlength=len(term_ids)), dtype=np.int64)
    row = {
        "segment": [segment], "doc_ids": [[doc for doc, _ in block]],
        "starts": [np.array(starts, "<i4").tobytes()], "terms": [b" ".join(term_ids)],
        "ends": [ends.astype("<i4").tobytes()], "places": [place[order].astype("<i4").tobytes()],
    }
    types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))


def search(
    index: DataFrame, benchmark: DataFrame, window: int = 10, slop: int = 5, item: str = "item_id", text: str = "text",
    slice_bytes: int = 16 << 20,
) -> DataFrame:
    """One row per indexed document: its exact phrase and proximity matches with the benchmark.

    A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one window.
    ``hits`` are the document's words inside any exact match, as merged spans ``[first, past)`` of word places.
    ``phrases`` are these spans by item. ``near`` are proximity matches: places where each word of a window stands at
    most ``slop`` words from where the phrase would have it, and the phrase itself does not occur there. Items with
    a null id take part in ``hits``; in the lists their id is null. Equal ids are one item. The benchmark is read
    and sent to the tasks in slices of about ``slice_bytes``; further slices are further passes over the index.
    """
    total = benchmark.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    passes = max(1, -(-total // slice_bytes))
    items = benchmark.select(F.col(item).cast("string"), F.col(text).cast("string").cast("binary"))
    if passes > 1:
        index = written_table(index, "positional-index")  # a segment's number is told by the task that makes it
    number = F.pmod(F.xxhash64(*items.columns), F.lit(passes))
    found = None
    for nth in range(passes):
        part = _windows(items.filter(number == nth).toLocalIterator(), window)
        shared = index.sparkSession.sparkContext.broadcast(part)
        one = index.mapInArrow(_searcher(shared, slop), MATCHES)
        found = one if found is None else found.unionByName(one)
    if passes == 1:
        return found.drop("segment", "nth")
    merged = found.groupBy("segment", "nth").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        merged_spans(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.flatten(F.collect_list("phrases")).alias("phrases"),
        F.flatten(F.collect_list("near")).alias("near"),
    )
    return merged.drop("segment", "nth")


def merged_spans(spans: Column) -> Column:
    """The spans in order, with overlapping and touching ones made one."""

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["past"], span["past"]).alias("past"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["past"] >= span["first"])
        return F.when(
            joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))
        ).otherwise(F.concat(done, F.array(span)))

    last_safe = F.array_sort(spans)
    return F.aggregate(last_safe, F.expr(f"cast(array() as array<{SPAN}>)"), add)


def _windows(items: Iterable, size: int) -> tuple[list[bytes], np.ndarray, np.ndarray, list]:
    """Terms, windows as rows of term numbers (-1 past a short one's end), the item of each, and item ids."""
    terms: dict[bytes, int] = {}
    rows, owners, names = set(), [], {}
    for name, text in items:
        words = [terms.setdefault(w, len(terms)) for w in plain_words(text)]
        owner = names.setdefault(name, len(names))
        for i in range(max(1, len(words) - size + 1) if words else 0):
            rows.add((owner, *words[i : i + size], *[-1] * (size - len(words))))
    table = np.array(sorted(rows), np.int32).reshape(-1, size + 1)
    return list(terms), np.ascontiguousarray(table[:, 1:]), table[:, 0], list(names)


def _searcher(shared, slop: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def matches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, windows, owners, names = shared.value
        for segment, doc_ids, starts, *postings in rows_of(batches):
            starts = np.frombuffer(starts, "<i4")
            exact, near = _match(*postings, terms, windows, slop)
            yield _documents(segment, doc_ids, starts, exact, near, owners, names, windows)

    return matches


def _match(stored: bytes, ends: bytes, places: bytes, terms, windows, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact and proximity matches as rows of window number and place."""
    ends, places = np.frombuffer(ends, "<i4"), np.frombuffer(places, "<i4")
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    number = {t: i for i, t in enumerate(stored.split(b" "))} if stored else {}
    at = np.array([number.get(t, -1) for t in terms] + [-1], np.int64)
    frequency = np.append(ends - begins, 0)[at] if len(ends) else np.zeros(len(at), np.int64)
    used = windows >= 0
    counts = np.where(used, frequency[windows], np.iinfo(np.int32).max)
    exact, near = [], []
    for w in np.flatnonzero(counts.min(axis=1) > 0) if len(windows) else ():
        rarest_first = np.argsort(counts[w], kind="stable")[: used[w].sum()]
        start = place = None
        for offset in rarest_first:
            term = at[windows[w, offset]]
            listed = places[begins[term] : ends[term]] - np.int32(offset)
            if place is None:
                place, start = listed, listed
                continue
            low, high = np.searchsorted(listed, place - slop), np.searchsorted(listed, place + slop, "right")
            place = place[high > low]
            if len(start):
                i = np.searchsorted(listed, start)
                start = start[listed[np.minimum(i, len(listed) - 1)] == start]
            if not len(place):
                break
        if len(place):
            exact += [(w, p) for p in start.tolist()]
            near += [(w, p) for p in np.setdiff1d(place, start).tolist()]
    return np.array(exact, np.int64).reshape(-1, 2), np.array(near, np.int64).reshape(-1, 2)


def _merged(first: np.ndarray, past: np.ndarray) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(first.tolist(), past.tolist())):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _documents(segment, doc_ids, starts, exact, near, owners, names, windows) -> pa.RecordBatch:
    lengths = (windows >= 0).sum(axis=1)
    rows = {n: [] for n in ("segment", "nth", "doc_id", "n_words", "hits", "phrases", "near")}
    sides = []
    for found in (exact, near):
        document = np.searchsorted(starts, found[:, 1], "right") - 1
        # A proximity match may begin a few words before its document does.
        document = np.clip(document, 0, len(doc_ids) - 1)
        order = np.lexsort((owners[found[:, 0]], document)) if len(found) else np.empty(0, np.int64)
        sides.append((document[order], found[order]))
    for nth, doc_id in enumerate(doc_ids):
        n_words = int(starts[nth + 1] - starts[nth]) - GAP
        spans = []
        for document, found in sides:
            mine = found[np.searchsorted(document, nth) : np.searchsorted(document, nth, "right")]
            first = mine[:, 1] - starts[nth]
            past = first + lengths[mine[:, 0]]
            spans.append((owners[mine[:, 0]], np.maximum(first, 0), np.minimum(past, n_words)))
        by_item = [
            [
                {"item_id": names[o], "first": a, "past": b}
                for o in np.unique(owner).tolist()
                for a, b in _merged(first[owner == o], past[owner == o])
            ]
            for owner, first, past in spans
        ]
        hits = [{"first": a, "past": b} for a, b in _merged(spans[0][1], spans[0][2])]
        for name, value in zip(rows, (segment, nth, doc_id, n_words, hits, *by_item)):
            rows[name].append(value)
    span = [("first", pa.int32()), ("past", pa.int32())]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.struct(span))]
    types += 2 * [pa.list_(pa.struct([("item_id", pa.string()), *span]))]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types)], list(rows))
