"""Approximate nearest neighbours with balanced posting lists.

Centroids come from balanced clustering of a bounded sample and are searched through a graph held in memory. Every vector
is stored in the list of its nearest centroid and, if it lies near a boundary, in those of a few more. A query reads the
lists whose centroids are about as near as the nearest one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxvigil.session import written_table

AT_ONCE = 256


@dataclass
class Settings:
    """``sample`` rows fit the centroids; ``closure`` is a ratio to the nearest centroid's distance. ``recall`` is aimed at:
    ``trials`` queries compared with all rows tell how far from the nearest centroid lists must be read."""

    list_rows: int = 256
    most_lists: int = 16384
    sample: int = 40_000
    replicas: int = 4
    closure: float = 1.05
    recall: float = 0.97
    trials: int = 64
    degree: int = 16
    beam: int = 64
    rows_at_once: int = 8192
    queries_at_once: int = 1024


def usable(vector: Column) -> Column:
    """Whether a vector can take part: not null, no null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def search(
    vectors: DataFrame, queries: Column, k: int = 10, settings: Settings | None = None, key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's ``k`` nearest found by Euclidean distance.

    ``queries`` is a condition on the rows of ``vectors``; candidates are all rows but those with the query's key.
    Distances are exact, in double precision on the stored values; ties go to the smaller key. Rows with a null key or a
    vector that is not usable take no part, nor do vectors whose length is not the commonest one. Repeated keys are one
    candidate, at its nearest row. A query reads lists until they hold more than ``k`` rows at least, so it gets ``k``
    neighbours whenever there are as many. An empty table gives an empty result.
    """
    settings = settings or Settings()
    rows = vectors.withColumn("__query", F.coalesce(queries, F.lit(False))).select(
        F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), "__query"
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    spark = vectors.sparkSession
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("vector") == sizes["n"])
    sample = rows.select("vector", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.sample)
    lists = min(settings.most_lists, max(1, sizes["count"] // settings.list_rows))
    graph = Graph.build(_matrix(sample.select("vector").toArrow()["vector"].combine_chunks()), lists, settings)
    shared = spark.sparkContext.broadcast(vars(graph))

    postings = rows.mapInArrow(
        _assigner(shared, settings), "list int, home boolean, vec_id long, vector array<double>, query boolean"
    )
    postings = written_table(postings, "posting-lists")
    at_home = F.count_distinct(F.when(F.col("home"), F.col("vec_id")))
    held = postings.groupBy("list").agg(F.count("*").alias("n"), at_home.alias("homes")).collect()
    homes = np.zeros(len(graph.centroids), np.int64)
    for row in held:
        homes[row["list"]] = row["homes"]
    homes = spark.sparkContext.broadcast(homes)
    asked = postings.filter("query AND home").select("vec_id", "vector")
    reach, beam = _tuned(asked, postings, graph, settings, k)
    asked = written_table(
        asked.mapInArrow(_prober(shared, homes, reach, beam, k), "list int, query_id long, vector array<double>"), "probes"
    )
    asking = asked.groupBy("list").count().collect()

    # A list with many rows or queries is compared in parts; both tables have a row for each list at most.
    parts = spark.createDataFrame([(r["list"], -(-r["n"] // settings.rows_at_once)) for r in held], "list int, parts int")
    turns = [(r["list"], -(-r["count"] // settings.queries_at_once)) for r in asking]
    turns = spark.createDataFrame(turns, "list int, turns int")
    spread = parts.join(turns, "list")
    stored = postings.select("list", "vec_id", "vector").join(F.broadcast(spread), "list").select(
        "list", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "vec_id", "vector",
    )
    asked = asked.join(F.broadcast(spread), "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("query_id"), "turns").cast("int").alias("turn"), "query_id", "vector",
    )
    keys = ("list", "part", "turn")
    near = asked.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(
        _comparer(k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _tuned(asked: DataFrame, postings: DataFrame, graph: Graph, settings: Settings, k: int) -> tuple[float, int]:
    """The ratio of centroid distances, and the number of centroids to look at, that reach the recall on trial queries.

    Each trial query is compared with every row, task by task; of its true neighbours only the lists are needed.
    """
    trials = asked.orderBy(F.xxhash64("vec_id", F.lit("trial")), "vec_id").limit(settings.trials).collect()
    if not trials:
        return 1.0, settings.beam
    ids, points = np.array([r["vec_id"] for r in trials]), np.array([r["vector"] for r in trials])
    given = asked.sparkSession.sparkContext.broadcast((ids, points))
    near = postings.select("list", "vec_id", "vector").mapInArrow(_trial(given, k), "query_id long, vec_id long, score double, list int")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"), F.collect_set("list").alias("lists"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    far = np.sqrt(_distances(points, graph.centroids))
    place, row = np.argsort(np.argsort(far, axis=1), axis=1), {int(q): i for i, q in enumerate(ids)}
    ratios, places = [], []
    for found in near.select("query_id", "lists").collect():
        i = row[found["query_id"]]
        ratios.append(min(far[i, c] for c in found["lists"]) / max(far[i].min(), 1e-12))
        places.append(min(place[i, c] for c in found["lists"]))
    if not ratios:
        return 1.0, settings.beam
    return float(np.quantile(ratios, settings.recall)), max(settings.beam, int(np.quantile(places, 0.99)) + 32)


def _trial(given, k: int):
    def nearest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, points = given.value
        for batch in batches:
            ids, lists, vectors = batch.column(1).to_numpy(), batch.column(0).to_numpy(), _matrix(batch.column(2))
            for query, point in zip(queries, points):
                score = ((vectors - point) ** 2).sum(1)
                score[ids == query] = np.inf
                # Replicas of a row are the same distance away; all that may be among the nearest are kept.
                distinct = np.unique(score[np.isfinite(score)])
                if not len(distinct):
                    continue
                at = np.flatnonzero(score <= distinct[min(k, len(distinct)) - 1])
                at = at[np.lexsort((ids[at], score[at]))]
                at = at[np.isin(ids[at], list(dict.fromkeys(ids[at].tolist()))[:k])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), query)), pa.array(ids[at]), pa.array(score[at]), pa.array(lists[at])],
                    ["query_id", "vec_id", "score", "list"],
                )

    return nearest


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    values = np.asarray(vectors.flatten(), np.float64)
    return values.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0)


def _balanced(points: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` clusters of near-equal size, by repeated splits at the middle along the widest direction."""
    rng = np.random.default_rng(0)
    clusters, open_ = [], [(np.arange(len(points)), lists)]
    while open_:
        rows, n = open_.pop()
        if n == 1 or len(rows) < 2:
            clusters.append(points[rows].mean(axis=0))
            continue
        own = points[rows]
        ends = own[rng.choice(len(rows), 2, replace=False)]
        for _ in range(4):
            nearer = _distances(own, ends).argmin(1)
            ends = np.array([own[nearer == i].mean(axis=0) if (nearer == i).any() else ends[i] for i in (0, 1)])
        cut = len(rows) * (n // 2) // n
        order = np.argpartition(own @ (ends[1] - ends[0]), cut)
        open_ += [(rows[order[:cut]], n // 2), (rows[order[cut:]], n - n // 2)]
    return np.array(clusters)


@dataclass
class Graph:
    """Centroids, each one's nearest others and a few far ones, and the places where a search begins."""

    centroids: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    @staticmethod
    def build(sample: np.ndarray, lists: int, settings: Settings) -> Graph:
        points = np.unique(sample, axis=0)
        centroids = np.unique(_balanced(points, min(lists, len(points))), axis=0)
        n, rng = len(centroids), np.random.default_rng(1)
        degree = min(settings.degree, n)
        near = [np.argsort(_distances(centroids[i : i + AT_ONCE], centroids), axis=1)[:, :degree] for i in range(0, n, AT_ONCE)]
        far = rng.integers(0, n, (n, 4))
        return Graph(centroids, np.hstack([np.vstack(near), far]), rng.permutation(n)[:32])

    def nearest(self, points: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each point up to ``beam`` centroids by distance, nearest first; missing ones are at infinity."""
        n = len(points)
        row = np.arange(n)[:, None]
        seen = np.zeros((n, len(self.centroids)), bool)
        ids = np.tile(self.entries, (n, 1))
        seen[row, ids] = True
        reach, opened = self._to(points, ids), np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(reach, axis=1, kind="stable")[:, :beam]
            ids, reach, opened = ids[row, order], reach[row, order], opened[row, order]
            waiting = np.where(opened, np.inf, reach)
            step = np.argsort(waiting, axis=1, kind="stable")[:, :4]
            live = np.isfinite(waiting[row, step])
            if not live.any():
                return ids, reach
            opened[row, step] = True
            found = np.where(live[:, :, None], self.edges[ids[row, step]], -1).reshape(n, -1)
            found.sort(axis=1)
            fresh = found >= 0
            fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
            fresh &= ~seen[row, found]
            safe = np.where(fresh, found, 0)
            far = np.where(fresh, self._to(points, safe), np.inf)
            at, which = np.nonzero(fresh)
            seen[at, found[at, which]] = True
            ids, reach = np.hstack([ids, safe]), np.hstack([reach, far])
            opened = np.hstack([opened, ~fresh])

    def _to(self, points: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.sqrt(((points[:, None, :] - self.centroids[ids]) ** 2).sum(2))


def _assigner(shared, settings: Settings):
    most, closure, beam = settings.replicas, settings.closure, settings.beam

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = Graph(**shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                ids, reach = graph.nearest(_matrix(batch.column(1)), beam)
                # Lists whose centroids are about as near as the nearest one.
                near = reach[:, :most] <= closure * reach[:, :1]
                rows, nth = np.nonzero(near)
                copied = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows, nth].astype(np.int32)), pa.array(nth == 0), copied.column(0), copied.column(1), copied.column(2)],
                    ["list", "home", "vec_id", "vector", "query"],
                )

    return assign


def _prober(shared, homes, ratio: float, beam: int, k: int):
    def probe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, held = Graph(**shared.value), homes.value
        for whole in batches:
            for at in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                points = _matrix(batch.column(1))
                ids, reach = graph.nearest(points, beam)
                rows, lists = [], []
                for i in range(batch.num_rows):
                    known = np.isfinite(reach[i])
                    order, far = ids[i][known], reach[i][known]
                    if held[order].sum() <= k:
                        order = np.argsort(_distances(points[i : i + 1], graph.centroids)[0], kind="stable")
                        far = np.full(len(order), np.inf)
                    enough = int(np.searchsorted(np.cumsum(held[order]), k, "right")) + 1
                    wanted = max(enough, int(np.searchsorted(far, ratio * max(far[0], 1e-12) * (1 + 1e-9), "right")))
                    lists += order[:wanted].tolist()
                    rows += [i] * len(order[:wanted])
                copied = batch.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists, pa.int32()), copied.column(0), copied.column(1)], ["list", "query_id", "vector"]
                )

    return probe


def _comparer(k: int):
    names = ["query_id", "vec_id", "score"]

    def compare(asked: pa.Table, stored: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if asked.num_rows and stored.num_rows:
            queries, points = (_matrix(t["vector"].combine_chunks()) for t in (asked, stored))
            ids = stored["vec_id"].to_numpy()
            for query, point in zip(asked["query_id"].to_pylist(), queries):
                rough = ((points - point) ** 2).sum(1)
                rough[ids == query] = np.inf
                # Rows that repeat a key count once, at the nearest; so more rows are taken until there are k keys.
                last = min(k, len(rough)) - 1
                while True:
                    inside = np.flatnonzero((rough <= np.partition(rough, last)[last]) & np.isfinite(rough))
                    best = inside[np.lexsort((ids[inside], rough[inside]))]
                    best = best[np.sort(np.unique(ids[best], return_index=True)[1])][:k]
                    if len(best) >= k or last == len(rough) - 1:
                        break
                    last = min(4 * (last + 1), len(rough)) - 1
                for column, values in zip(found, (np.full(len(best), query), ids[best], np.sqrt(rough[best]))):
                    column.append(values)
        arrays = [np.concatenate(c) if c else np.empty(0) for c in found]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(a.astype(t.to_pandas_dtype())) for a, t in zip(arrays, kinds)], names)

    return compare
