"""A keyed table fed by a stream, kept as files next to the query's checkpoint."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxvigil.operators.latest import latest_by_key
from rxvigil.streaming.files import create_once, names, read_text, remove

_BATCH = "arrived_in"
_LAYOUT = T.StructType([
    T.StructField("set", T.LongType()), T.StructField("attempt", T.StringType()), T.StructField("bucket", T.IntegerType()),
])


class ChangeTable:
    """Latest value per key, in buckets of keys: for each a compacted base plus the change sets since.

    A batch writes its own changes, one file a bucket, and then one manifest, which names the sets of files that make up the
    table and the buckets each of them still counts for. Manifests appear whole and are never replaced, so a
    retried batch leaves the table as if it had run once, and any number of other queries can read the table while one
    writes it: each sees one version. A bucket with ``compact_every`` change sets is merged into a new base by the batch that brings
    the last of them, the others are left alone. Reading for given keys opens their buckets only. Arrival decides: a
    change of a later batch replaces those of earlier ones whatever its time, and within a batch ``order_by`` counts.
    Deletes are kept as rows. ``vacuum`` removes what no version from a given one on needs.
    """

    def __init__(
        self,
        root: str,
        columns: Sequence[str],
        key: str = "key",
        order_by: Sequence[str] = ("ts", "offset"),
        delete: str = "is_delete",
        compact_every: int = 50,
        buckets: int = 16,
    ):
        self.root = root.rstrip("/")
        self.key = key
        self.order_by = list(order_by)
        self.delete = delete
        self.compact_every = compact_every
        self.buckets = buckets
        self.columns = list(dict.fromkeys([key, *order_by, delete, *columns]))

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        """Add a batch's changes. A batch that is in the table already is left as it is."""
        spark = changes.sparkSession
        versions = self.versions(spark)
        if batch_id in versions:
            return
        before = self._manifest(spark, max((v for v in versions if v < batch_id), default=None))
        newest = self._newest(changes.select(*self.columns), self.order_by)
        newest = newest.withColumn(_BATCH, F.lit(batch_id).cast("long"))
        sets = [*before["sets"], self._write(newest, 2 * batch_id)]
        held = [b for s in sets for b in s["buckets"]]
        due = [b for b in sets[-1]["buckets"] if held.count(b) > self.compact_every]
        if due:
            merged = self._newest(self._rows(spark, sets, newest.schema, due), self._arrival)
            sets = [{**s, "buckets": [b for b in s["buckets"] if b not in due]} for s in sets]
            sets.append(self._write(merged, 2 * batch_id + 1))
        manifest = {"buckets": self.buckets, "sets": [s for s in sets if s["buckets"]]}
        create_once(spark, f"{self.root}/manifests/{batch_id}", json.dumps(manifest))

    def as_of(
        self, spark: SparkSession, batch_id: int | None, schema, keys: DataFrame | None = None
    ) -> DataFrame:
        """The table after ``batch_id`` (-1: empty, None: its newest version), optionally only the rows of ``keys``.

        The keys' buckets are asked for first, one small job over the keys; the files of other buckets are not opened.
        """
        stored = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType())])
        versions = [v for v in self.versions(spark) if batch_id is None or v <= batch_id]
        sets = self._manifest(spark, max(versions, default=None))["sets"]
        asked = None
        if keys is not None and sets:
            asked = [r[0] for r in keys.select(self._bucket().alias("bucket")).distinct().collect()]
        rows = self._rows(spark, sets, stored, asked)
        if keys is not None:
            rows = rows.join(keys.select(self.key).distinct(), self.key, "left_semi")
        return latest_by_key(rows, self.key, self._arrival, self.delete).drop(_BATCH)

    def schema_of(self, changes: DataFrame):
        return changes.select(*self.columns).schema

    def versions(self, spark: SparkSession) -> list[int]:
        """The batches after which the table can be read."""
        return sorted(int(n) for n in names(spark, f"{self.root}/manifests") if n.isdigit())

    def vacuum(self, spark: SparkSession, oldest: int) -> None:
        """Remove the files and manifests that no version from ``oldest`` on needs; readers of earlier ones must have ended.

        A version that has no manifest of its own is read through the one before it, which then stays. Files of
        attempts that were never committed go as well, unless their batch may still be at work.
        """
        versions = self.versions(spark)
        first = max((v for v in versions if v <= oldest), default=None)
        if first is None:
            return
        kept = [v for v in versions if v >= first]
        needed = {(s["set"], s["attempt"]) for v in kept for s in self._manifest(spark, v)["sets"]}
        for version in versions:
            if version < first:
                remove(spark, f"{self.root}/manifests/{version}")
        for one in names(spark, f"{self.root}/data"):
            number = int(one.removeprefix("set="))
            if number // 2 > versions[-1]:
                continue
            for attempt in names(spark, f"{self.root}/data/{one}"):
                if (number, attempt.removeprefix("attempt=")) not in needed:
                    remove(spark, f"{self.root}/data/{one}/{attempt}")

    @property
    def _arrival(self) -> list[str]:
        return [_BATCH, *self.order_by]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _newest(self, rows: DataFrame, order_by: Sequence[str]) -> DataFrame:
        return latest_by_key(rows, self.key, order_by, self.delete, keep_deletes=True)

    def _write(self, rows: DataFrame, number: int) -> dict:
        """Write rows as a set of files, one a bucket. The set's folder is new, whatever earlier attempts have left."""
        attempt = f"a{uuid.uuid4().hex}"
        path = f"{self.root}/data/set={number}/attempt={attempt}"
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.partitionBy("bucket").parquet(path)
        held = [int(n.removeprefix("bucket=")) for n in names(rows.sparkSession, path) if n.startswith("bucket=")]
        return {"set": number, "attempt": attempt, "buckets": sorted(held)}

    def _manifest(self, spark: SparkSession, version: int | None) -> dict:
        if version is None:
            return {"buckets": self.buckets, "sets": []}
        manifest = json.loads(read_text(spark, f"{self.root}/manifests/{version}"))
        if manifest["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {manifest['buckets']} buckets, not {self.buckets}")
        return manifest

    def _rows(self, spark: SparkSession, sets: list[dict], schema, asked: list[int] | None) -> DataFrame:
        """The rows of the sets in the buckets that were asked for; folders of other buckets are pruned."""
        wanted = range(self.buckets) if asked is None else asked
        # For each bucket the first set that counts: its base, or its first changes.
        first: dict[int, int] = {}
        for one in sets:
            for bucket in one["buckets"]:
                first[bucket] = min(first.get(bucket, one["set"]), one["set"])
        first = {b: n for b, n in first.items() if b in wanted}
        if not first:
            return spark.createDataFrame([], schema)
        sets = [s for s in sets if any(b in first for b in s["buckets"])]
        paths = [f"{self.root}/data/set={s['set']}/attempt={s['attempt']}" for s in sets]
        rows = spark.read.schema(T.StructType([*schema.fields, *_LAYOUT.fields])).option("basePath", f"{self.root}/data").parquet(*paths)
        since = F.create_map(*(F.lit(x) for pair in sorted(first.items()) for x in pair))
        counts = F.col("bucket").isin(sorted(first)) & (F.col("set") >= F.element_at(since, F.col("bucket")))
        return rows.where(counts).drop(*_LAYOUT.names)
