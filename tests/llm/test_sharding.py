import random
import zlib

import pytest

from rxvigil.llm import queries, sharding
from tests.llm.samples import awkward, awkward_rng, frame, prose, rows

SF = "/root/testdata/sf0.001"


def check(found, given, shards, tolerance):
    sizes = sorted(len((t or "").encode()) + 1 for _, t in given)
    assert sorted(r["size"] for r in found) == sizes
    by_shard = {}
    for r in found:
        by_shard.setdefault(r["shard"], []).append(r)
    assert set(by_shard) <= set(range(shards))
    ordered = []
    for shard in sorted(by_shard):
        part = sorted(by_shard[shard], key=lambda r: r["slot"])
        assert [r["slot"] for r in part] == list(range(len(part)))
        ordered += part
    keys = [-(2**63) if r["doc_id"] is None else r["doc_id"] for r in ordered]
    assert keys == sorted(keys)
    for shard in range(shards):
        held = sum(r["size"] for r in by_shard.get(shard, []))
        assert abs(held - sum(sizes) / shards) <= tolerance * sum(sizes) / shards + max(sizes)


def test_shards_of_the_whole_table(spark):
    found = rows(queries.op8_sharding(spark, SF))
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check(found, given, 16, 0.01)
    sums = {i: zlib.crc32((t or "").encode()) for i, t in given}
    assert all(r["text_crc32"] == sums[r["doc_id"]] for r in found)


def test_awkward_rows(spark):
    given = awkward(awkward_rng())
    found = rows(sharding.shard_by_bytes(frame(spark, given), shards=3, tolerance=0.05))
    check(found, given, 3, 0.05)


@pytest.mark.parametrize("keys", [[7] * 400, [0] * 200 + list(range(-100, 100)), [-(2**63), 2**63 - 1] * 100])
def test_hot_keys_are_split(spark, keys):
    rng = random.Random(1)
    given = [(k, prose(rng, rng.randint(1, 9))) for k in keys]
    check(rows(sharding.shard_by_bytes(frame(spark, given), shards=4, tolerance=0.1)), given, 4, 0.1)


def test_clashing_columns_and_an_empty_table(spark):
    clash = frame(spark, [(1, "a"), (2, "b")]).selectExpr("*", "'x' AS Shard", "'y' AS cell", "'z' AS k")
    found = sharding.shard_by_bytes(clash, shards=2)
    assert sorted(found.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "cell", "k", "size", "shard", "slot"])
    assert {(r["cell"], r["k"]) for r in rows(found)} == {("y", "z")}
    assert rows(sharding.shard_by_bytes(clash.limit(0))) == []


def test_no_python_on_the_main_path(spark, capsys):
    queries.op8_sharding(spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "ExistingRDD"))


def test_rows_equal_in_key_and_text_are_parted(spark):
    """Half of all rows are one row; shards are still within a row of equal bytes, and slots gapless."""
    table = frame(spark, [(7, "x" * 14)] * 2000 + [(i, "y" * 10) for i in range(100, 2100)]).repartition(9)
    found = rows(sharding.shard_by_bytes(table))
    held = {s: [r for r in found if r["shard"] == s] for s in range(16)}
    total = sum(r["size"] for r in found)
    assert len(found) == 4000 and total == 2000 * 15 + 2000 * 11
    assert all(abs(sum(r["size"] for r in own) - total / 16) <= 15 + 0.01 * total / 16 for own in held.values())
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in held.values())


def test_a_single_repeated_row_fills_every_shard(spark):
    found = rows(sharding.shard_by_bytes(frame(spark, [(None, None)] * 160)))
    assert sorted(r["shard"] for r in found) == sorted(list(range(16)) * 10)


def test_no_task_needs_a_whole_cell(spark):
    """The rows are dealt by ranges alone: no window or hash exchange stands above the texts."""
    table = frame(spark, [(i, "z" * i) for i in range(50)])
    plan = sharding.shard_by_bytes(table)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "Python" not in plan
