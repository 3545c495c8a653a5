"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

A bounded sample of labelled texts is held in a block-max inverted index with every term of theirs: for each term its
postings and, for each block of examples, the largest weight in it. A text opens the blocks whose bounds are largest, then all
others whose bound on the cosine reaches the k-th nearest example found, so the neighbours are exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxvigil.llm.words import plain_words
from rxvigil.session import written_table

EVIDENCE = "array<struct<example:long,label:int,cosine:double>>"
#: Blocks that are opened before any is left out.
OPENED_FIRST = 2


@dataclass
class Settings:
    """Bounds of the fitted part: example texts a class, texts to calibrate with, neighbours, examples a block.

    No term is left out. A term's weight is its TF-IDF times a relevance between ``least_relevance`` and 1, which grows with
    the chi-square by which the examples' classes differ in it, and is a quarter at ``halfway``: texts share thousands of words that
    say nothing about their label, and would drown the others in the cosine.
    """

    per_class: int = 500
    to_calibrate: int = 6000
    nearest: int = 15
    block: int = 32
    halfway: float = 20.0
    least_relevance: float = 1e-4


def _learn(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """The sampled texts with their label and part: the first of each class by hash to be examples, others to calibrate.

    ``labels`` holds ``key``, ``label`` and ``calibrates``. Repeated keys are labelled 1 if any of their rows is; of several
    texts with a labelled key the first by bytes is learnt from.
    """
    known = labels.filter("key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(
        F.max("label").cast("int").alias("label"), F.max("calibrates").alias("calibrates")
    )
    order = (F.xxhash64("key"), F.col("key"))
    parts = [known.filter(F.col("calibrates")).orderBy(*order).limit(settings.to_calibrate)]
    for label in (0, 1):
        one = known.filter((F.col("label") == label) & ~F.col("calibrates"))
        parts.append(one.orderBy(*order).limit(settings.per_class))
    # Bounded by the settings, so it may be sent to every task.
    chosen = written_table(parts[0].union(parts[1]).union(parts[2]), "labelled-sample")
    texts = docs.join(F.broadcast(chosen), "key").groupBy("key", "label", "calibrates").agg(F.min("text").alias("text"))
    return written_table(texts, "labelled-texts")


def fit(
    docs: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> Model:
    """The index of labelled examples and the calibration of its votes; bounded by ``settings``.

    ``labels`` holds the key, the label and optionally a boolean ``calibrates``, which marks rows that set the
    calibration instead of serving as examples. Terms are the examples' words; their document frequencies are counted
    over all documents. The driver holds the examples' terms, never other texts.
    """
    settings = settings or Settings()
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").cast("binary").alias("text"))
    marks = F.col("calibrates") if "calibrates" in labels.columns else F.pmod(F.xxhash64(F.col(key)), F.lit(3)) == 0
    known = labels.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), marks.alias("calibrates"))
    learnt = _learn(source, known, settings)

    bags = learnt.filter("NOT calibrates").mapInArrow(_bags, "key long, label int, terms array<binary>, n array<int>")
    examples = sorted(zip(*(column.to_pylist() for column in bags.toArrow().columns)))
    classes, of_class = Counter(e[1] for e in examples), (Counter(), Counter())
    for _, one, terms, _ in examples:
        of_class[one].update(terms)
    names = sorted(of_class[0] | of_class[1])
    number = {t: i for i, t in enumerate(names)}
    spark = docs.sparkSession
    counted = source.select("text").mapInArrow(_document_frequencies(spark.sparkContext.broadcast(number)), "term int, n long")
    totals = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(names) + 1)
    frequency[totals["term"].to_numpy()] = totals["n"].to_numpy()
    idf = np.log((frequency[-1] + 1) / (frequency[:-1] + 1)) + 1
    idf *= _relevance(*(np.array([c[t] for t in names], float) for c in of_class), classes[0], classes[1], settings)

    weighed = [(k, one, *_weigh([number[t] for t in terms], n, idf)) for k, one, terms, n in examples]
    index = Index.build(weighed, len(names), settings.block)
    model = Model(number, idf, index, settings.nearest, np.zeros(0), np.zeros(0), 0.5)
    voted = learnt.filter("calibrates").mapInArrow(_voter(spark.sparkContext.broadcast(model.plain())), "label int, vote double")
    return model.calibrated(list(zip(*(column.to_pylist() for column in voted.toArrow().columns))))


def _relevance(b: np.ndarray, a: np.ndarray, n0: int, n1: int, settings: Settings) -> np.ndarray:
    """From the examples of label 0 (``b`` of ``n0``) and label 1 (``a`` of ``n1``) that hold each term."""
    below = (a + b) * (n1 + n0 - a - b) * n1 * n0
    chi2 = (a * (n0 - b) - b * (n1 - a)) ** 2 * (n1 + n0) / np.maximum(below, 1)
    return np.maximum((chi2 / (chi2 + settings.halfway)) ** 2, settings.least_relevance)


def apply(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``score`` and ``evidence``, the nearest labelled examples.

    ``score`` lies between 0 and 1, higher: label 1 likelier. The ``nearest`` examples by exact cosine vote with weight
    1 / distance; an isotonic fit on the calibrating rows turns the vote into a rate. Texts without any known term,
    null and empty ones included, get the rate of such texts. Ties go to the smaller example key. Rows are scored
    one by one, repeated ones too; input columns named ``score`` or ``evidence`` are replaced.
    """
    kept = [c for c in (carry or docs.columns) if c.lower() not in ("score", "evidence")]
    wanted = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(text).cast("string").cast("binary").alias("__text"))
    empty = wanted.drop("__text").withColumn("score", F.lit(0.0)).withColumn("evidence", F.lit(None).cast(EVIDENCE))
    shared = docs.sparkSession.sparkContext.broadcast(model.plain())

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Model.of(shared.value)
        counts = _Counts(fitted.number)
        struct = pa.struct([("example", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())])
        for batch in batches:
            scores, evidence = [], []
            for value in batch.column(batch.num_columns - 1):
                rate, near = fitted.score(*counts.of(value.as_py()))
                scores.append(rate)
                evidence.append([{"example": k, "label": y, "cosine": c} for c, k, y in near])
            columns = [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(struct))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "evidence"])

    return wanted.mapInArrow(scored, empty.schema)


class _Counts:
    """The known terms of a text and how often each occurs."""

    def __init__(self, number: dict[bytes, int]):
        self.number = number

    def of(self, text: bytes | None) -> tuple[list[int], list[int]]:
        found = sorted((self.number[w], n) for w, n in Counter(plain_words(text)).items() if w in self.number)
        return [t for t, _ in found], [n for _, n in found]


def _bags(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [sorted(Counter(plain_words(t)).items()) for t in batch.column("text").to_pylist()]
        terms, n = ([[pair[i] for pair in bag] for bag in held] for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("label"), pa.array(terms, pa.list_(pa.binary())), pa.array(n, pa.list_(pa.int32()))],
            ["key", "label", "terms", "n"],
        )


def _document_frequencies(shared):
    """Documents of a task that hold each term; the number after the last term counts them all."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        seen = np.zeros(len(number) + 1, np.int64)
        for batch in batches:
            seen[-1] += batch.num_rows
            for value in batch.column(0):
                held = [number[w] for w in set(plain_words(value.as_py())) if w in number]
                seen[held] += 1
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(seen[terms])], ["term", "n"])

    return count


def _voter(shared):
    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model.of(shared.value)
        counts = _Counts(model.number)
        for batch in batches:
            near = [model.near(*counts.of(t)) for t in batch.column("text").to_pylist()]
            votes = [model.vote(found) if found else None for found in near]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(votes, pa.float64())], ["label", "vote"])

    return vote


def _weigh(terms: list[int], n: list[int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers and their TF-IDF weights, scaled to unit length."""
    ids = np.array(terms, np.int64)
    weights = (1 + np.log(np.array(n, np.float64))) * idf[ids]
    return ids, weights / np.sqrt((weights**2).sum()) if len(ids) else weights


def _ranges(first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    lengths = past - first
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - lengths), lengths)


@dataclass
class Index:
    """Block-max inverted index.

    A term has the entries ``of_term[t]`` to ``of_term[t + 1]``, one for each block that holds it: the block, the bounds of its
    postings there, and the largest weight among them. A posting is an example's place and the term's weight in it.
    """

    keys: np.ndarray
    labels: np.ndarray
    place: np.ndarray
    weight: np.ndarray
    of_term: np.ndarray
    block_of: np.ndarray
    first: np.ndarray
    past: np.ndarray
    most: np.ndarray
    block: int

    @staticmethod
    def build(examples: list[tuple], terms: int, block: int) -> Index:
        """Examples with the same heaviest term stand together, which keeps the blocks' bounds tight."""
        used = [e for e in examples if len(e[2])]
        used.sort(key=lambda e: (int(e[2][np.argmax(e[3])]), e[0]))
        keys, labels = np.array([e[0] for e in used], np.int64), np.array([e[1] for e in used], np.int64)
        place = np.repeat(np.arange(len(used)), [len(e[2]) for e in used])
        term = np.concatenate([e[2] for e in used]) if used else np.zeros(0, np.int64)
        weight = np.concatenate([e[3] for e in used]) if used else np.zeros(0)
        order = np.lexsort((place, term))
        place, term, weight = place[order], term[order], weight[order]
        blocks = place // block
        opens = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (blocks[1:] != blocks[:-1]))) if len(term) else term
        past = np.append(opens[1:], len(term)) if len(term) else term
        most = np.maximum.reduceat(weight, opens) if len(term) else weight
        of_term = np.searchsorted(term[opens], np.arange(terms + 1))
        return Index(keys, labels, place, weight, of_term, blocks[opens], opens, past, most, block)

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int, int]]:
        """The ``k`` examples of largest cosine above 0: cosine, key, label; ties by key."""
        first, past = self.of_term[ids], self.of_term[ids + 1]
        entries, query = _ranges(first, past), np.repeat(weights, past - first)
        if not len(entries):
            return []
        blocks = self.block_of[entries]
        bound = np.bincount(blocks, query * self.most[entries])
        opened = np.zeros(len(bound), bool)
        opened[np.argsort(-bound, kind="stable")[:OPENED_FIRST]] = True
        cosine = self._cosines(entries[opened[blocks]], query[opened[blocks]])
        least = np.partition(cosine, -k)[-k] if len(cosine) >= k else 0.0
        rest = (bound > 0) & (bound >= least - 1e-12) & ~opened
        if rest.any():
            cosine = cosine + self._cosines(entries[rest[blocks]], query[rest[blocks]])
            least = np.partition(cosine, -k)[-k] if len(cosine) >= k else 0.0
        at = np.flatnonzero((cosine > 0) & (cosine >= least))
        best = sorted((-float(cosine[i]), int(self.keys[i]), int(self.labels[i])) for i in at)[:k]
        return [(-c, key, label) for c, key, label in best]

    def _cosines(self, entries: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Cosines with all examples, those outside the entries' blocks 0."""
        first, past = self.first[entries], self.past[entries]
        postings = _ranges(first, past)
        return np.bincount(self.place[postings], np.repeat(query, past - first) * self.weight[postings], len(self.keys))


@dataclass
class Model:
    """Term numbers, their idf times relevance, the example index and the calibration: rates at votes, and of texts without known terms."""

    number: dict[bytes, int]
    idf: np.ndarray
    index: Index
    k: int
    votes: np.ndarray
    rates: np.ndarray
    bare: float

    def plain(self) -> dict:
        """Plain values, as a worker need not find this module."""
        return {**vars(self), "index": vars(self.index)}

    @staticmethod
    def of(plain: dict) -> Model:
        return Model(**{**plain, "index": Index(**plain["index"])})

    def near(self, terms: list[int], n: list[int]) -> list[tuple[float, int, int]]:
        return self.index.nearest(*_weigh(terms, n, self.idf), self.k)

    def vote(self, near: list[tuple[float, int, int]]) -> float:
        weights = [1 / (1.05 - c) for c, _, _ in near]
        return sum(w * label for w, (_, _, label) in zip(weights, near)) / sum(weights)

    def score(self, terms: list[int], n: list[int]) -> tuple[float, list[tuple[float, int, int]]]:
        near = self.near(terms, n)
        if not near:
            return self.bare, []
        vote = self.vote(near)
        rate = float(np.interp(vote, self.votes, self.rates)) if len(self.votes) else vote
        return min(1.0, max(0.0, rate)), near

    def calibrated(self, rows: list[tuple]) -> Model:
        """With votes mapped to rates by an isotonic fit on rows of label and vote; a step's mean is smoothed by half a row."""
        bare = [label for label, vote in rows if vote is None]
        steps: list[tuple] = []  # first and last vote, labels' sum, rows
        for vote, label in sorted((vote, label) for label, vote in rows if vote is not None):
            step = (vote, vote, label, 1)
            while steps and steps[-1][2] * step[3] >= step[2] * steps[-1][3]:
                first, _, labels, rows_ = steps.pop()
                step = (first, step[1], labels + step[2], rows_ + step[3])
            steps.append(step)
        # Between two steps the rate goes over from one to the other.
        votes = np.array([v for step in steps for v in step[:2]])
        rates = np.maximum.accumulate(np.array([(s[2] + 0.5) / (s[3] + 1) for s in steps for _ in range(2)] or [0.0]))
        rate = (sum(bare) + 0.5) / (len(bare) + 1)
        return Model(self.number, self.idf, self.index, self.k, votes, rates, rate)
