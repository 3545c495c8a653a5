import random

import pytest
from pyspark.sql import functions as F

from rxvigil.operators import asof_join, latest_by_key, lookup_join
from tests.builders import at, change, changelog

EVENT = "key string, topic string, partition int, offset bigint, ts timestamp"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def events(spark, rows):
    return spark.createDataFrame([(k, "t", 0, i, at(s)) for i, (k, s) in enumerate(rows)], EVENT)


def lookup_fixture(spark):
    keys = ["hot"] * 500 + [None] * 200 + [f"k{i % 40}" for i in range(300)]
    table = spark.createDataFrame(
        [("hot", 1)] + [(f"k{i}", i) for i in range(0, 40, 2)] + [("unused", 7)], "key string, v int"
    )
    return events(spark, [(k, 0) for k in keys]), table, keys


def expected_lookup(keys):
    values = {"hot": 1, **{f"k{i}": i for i in range(0, 40, 2)}}
    return [(i, values.get(k), k in values) for i, k in enumerate(keys)]


def test_lookup_without_broadcast(spark, no_broadcast):
    left, table, keys = lookup_fixture(spark)
    got = lookup_join(left, table)
    assert got.columns == ["key", "topic", "partition", "offset", "ts", "v", "matched"]
    assert sorted((r.offset, r.v, r.matched) for r in got.collect()) == expected_lookup(keys)


@pytest.mark.parametrize("hot", ["'hot'", "cast(null as string)"])
def test_heavy_keys_are_split_at_run_time(spark, no_broadcast, hot):
    """Adaptive execution splits a heavy key's events, also those without a key."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    left = spark.range(0, 40_000, 1, 8).selectExpr(
        f"case when id % 4 <> 0 then {hot} else concat('k', id) end AS key", "id AS offset", "uuid() AS filler"
    )
    table = spark.range(0, 40_000, 1, 8).selectExpr("concat('k', id) AS key", "uuid() AS v")
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        joined = lookup_join(left, table.unionByName(spark.sql("SELECT 'hot' AS key, '1' AS v")))
        found = joined.selectExpr("matched").collect()
        joined._jdf.queryExecution().toRdd().count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(found) == 40_000
    assert "skew=true" in plan


def test_small_table_is_joined_without_shuffling(spark):
    left, table, keys = lookup_fixture(spark)
    got = lookup_join(left, table)
    assert sorted((r.offset, r.v, r.matched) for r in got.collect()) == expected_lookup(keys)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def asof_fixture(seed):
    rng = random.Random(seed)
    sizes = {"hot": 400, "warm": 40, "cold": 3}
    table, stream = [], []
    for key, n in sizes.items():
        for _ in range(n):
            table.append((key, len(table), rng.randrange(60), rng.random() < 0.2))
            stream.append((key, rng.randrange(60)))
    stream += [("missing", 5), (None, 5)]
    return table, stream


def loop_asof(table, stream):
    answers = []
    for i, (key, s) in enumerate(stream):
        seen = [(ts, off, gone) for k, off, ts, gone in table if k == key and ts <= s]
        newest = max(seen) if seen else None
        hit = newest is not None and not newest[2]
        answers.append((i, float(newest[1]) if hit else None, hit))
    return answers


@pytest.mark.parametrize("rows_per_task", [15, 120, 100_000])
def test_asof_join_equals_the_loop(spark, rows_per_task):
    table, stream = asof_fixture(rows_per_task)
    log = changelog(spark, [
        change(k, off, "ACTIVE", delete=gone, public=float(off), ts=at(s)) for k, off, s, gone in table
    ])
    got = asof_join(
        events(spark, stream), log, ["publicPriceCHF"], rows_per_task=rows_per_task
    )
    rows = sorted((r.offset, r.publicPriceCHF, r.matched) for r in got.collect())
    assert rows == loop_asof(table, stream)


def test_asof_table_row_comes_before_event_of_equal_time(spark):
    log = changelog(spark, [change("k", 0, public=1.0, ts=at(10)), change("k", 1, public=2.0, ts=at(10)),
                            change("k", 2, public=3.0, ts=at(11))])
    [row] = asof_join(events(spark, [("k", 10)]), log, ["publicPriceCHF"]).collect()
    assert row.publicPriceCHF == 2.0


def test_asof_null_value_of_a_found_row_stays_found(spark):
    log = changelog(spark, [change("k", 0, public=1.0), change("k", 1, public=None)])
    [row] = asof_join(events(spark, [("k", 5)]), log, ["publicPriceCHF"]).collect()
    assert row.publicPriceCHF is None and row.matched


def test_latest_by_key(spark):
    log = changelog(spark, [
        change("a", 2, public=2.0, ts=at(5)), change("a", 1, public=1.0, ts=at(5)),
        change("b", 3), change("b", 4, delete=True), change("c", 9, delete=True, ts=at(1)),
        change("c", 5, public=3.0, ts=at(2)), change(None, 6),
    ])
    got = {r.key: r.publicPriceCHF for r in latest_by_key(log).collect()}
    assert got == {"a": 2.0, "c": 3.0}
    arrival = {r.key: r.offset for r in latest_by_key(log, order_by=["offset"], keep_deletes=True).collect()}
    assert arrival == {"a": 2, "b": 4, "c": 9}
